"""Participation counters from a packed list of election codes."""

from pyspark.sql import functions as F

from civicmill.functions.people import is_recent
from civicmill.operators.lookup import single_valued
from civicmill.operators.sizes import is_small, small_side

COUNTERS = ("FiveYearElections", "FiveYearPrimaries")


def _recent_codes(codes, as_of):
    """(Election, primary): codes with a date in the window, one row per code."""
    known = single_valued(codes, ["Election"], ["Date", "Type"])
    primary = F.coalesce(F.contains(F.col("Type"), F.lit("Primary")), F.lit(False))
    listed = (F.col("Election") != "") & is_recent(F.col("Date"), as_of)
    return known.where(listed).select("Election", primary.alias("primary"))


def _listed(tokens, codes):
    """SQL for the tokens that are among the codes: one text, where a literal each would be slow to plan."""
    if not codes:
        return "cast(array() AS array<string>)"
    quoted = ", ".join("'%s'" % code.replace("\\", "\\\\").replace("'", "\\'") for code in codes)
    return f"filter({tokens}, code -> code IN ({quoted}))"


def _with_flags(df):
    return df.withColumn("Prime", F.col(COUNTERS[1]) > 0)


def count_history(df, codes, as_of, history="VoterHistory"):
    """Add five-year elections, five-year primaries and the prime flag.

    The history is split on semicolons; empty and unknown codes do not count, repeated codes
    count again.  The code table becomes two hash-set filters on the split history, each one
    expression however long the table is, so voters are not shuffled.  Recent codes beyond the size check are refused; for them there is
    ``count_history_by_join``.
    """
    recent = _recent_codes(codes, as_of)
    if not is_small(recent):
        raise ValueError("the recent election codes are too many for literals: use count_history_by_join")
    known = recent.collect()
    every = [row["Election"] for row in known]
    primaries = [row["Election"] for row in known if row["primary"]]
    tokens = F.split(F.coalesce(history, F.lit("")), ";")
    found = df.withColumn("__tokens", tokens).withColumn("__recent", F.expr(_listed("__tokens", every)))
    counted = found.withColumns(
        {
            COUNTERS[0]: F.size("__recent").cast("long"),
            COUNTERS[1]: F.size(F.expr(_listed("__recent", primaries))).cast("long"),
        }
    )
    return _with_flags(counted.drop("__tokens", "__recent"))


def count_history_by_join(df, codes, as_of, history="VoterHistory"):
    """The same counters by joins, for code tables of any size.

    Each distinct history is counted once and joined back, so copies cost nothing.
    """
    recent = _recent_codes(codes, as_of)
    distinct = df.select(F.col(history).alias("__history")).where(F.col(history) != "").distinct()
    tokens = distinct.select("__history", F.explode(F.split("__history", ";")).alias("token"))
    counted = (
        tokens.join(small_side(recent), tokens["token"] == recent["Election"])
        .groupBy("__history")
        .agg(F.count("*").alias(COUNTERS[0]), F.count_if("primary").alias(COUNTERS[1]))
    )
    joined = df.join(counted, df[history] == counted["__history"], "left").drop("__history")
    return _with_flags(joined.fillna(0, list(COUNTERS)))
