"""Text of feeds and web pages."""

from html import unescape

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Parts of a page that are never shown.  One alternation, so that whichever opens first wins; one left
# open reaches to the end of the page.
HIDDEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"|<script\b.*?(?:</script\s*>|\z)"
    r"|<style\b.*?(?:</style\s*>|\z)"
    r"|<head\b.*?</head\s*>"
    r"|<title\b.*?(?:</title\s*>|\z)"
)
# A tag ends at the first ``>`` outside quotes, or, if its quotes are left open, at the first of all.
TAG = r"""(?s)</?[a-zA-Z!?](?:(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*>)"""


@F.pandas_udf(T.StringType())
def resolved(text: pd.Series) -> pd.Series:
    """Text with every named and numbered character reference as its character."""
    return text.map(unescape, na_action="ignore")


def visible_text(html):
    """Text a reader of the page sees, with white space collapsed to single spaces."""
    out = F.regexp_replace(F.regexp_replace(html, HIDDEN, " "), TAG, " ")
    return F.trim(F.regexp_replace(resolved(out), r"[\s\u00a0]+", " "))


def ascii_text(col, limit=None):
    """The text, each non-ASCII character as a question mark; with ``limit`` its first characters only."""
    return F.regexp_replace(col if limit is None else F.substring(col, 1, limit), r"[^\x00-\x7F]", "?")


def feed_time(col):
    """Timestamp of ``Tue, 03 Jul 2018 07:00:00 GMT``; the weekday is not checked."""
    return F.try_to_timestamp(F.substring_index(col, ", ", -1), F.lit("d MMM yyyy HH:mm:ss z"))
