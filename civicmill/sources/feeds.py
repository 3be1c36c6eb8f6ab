"""Landed RSS feeds."""

from pyspark.sql import functions as F

FEED = "channel struct<item: array<struct<title: string, link: string, pubDate: string>>>"


def rss_items(feeds, feed="feed"):
    """One row per item of each feed; the other columns are kept, a feed without items gives none.

    A feed that is not well-formed fails the job, so its items are not lost unseen.

    Feeds are reduced to ASCII before parsing.
    """
    plain = F.regexp_replace(F.col(feed), r"[^\x00-\x7F]", "?")
    kept = [c for c in feeds.columns if c != feed]
    parsed = feeds.select(*kept, F.from_xml(plain, FEED, {"mode": "FAILFAST"}).alias("parsed"))
    return parsed.select(*kept, F.inline("parsed.channel.item"))


ITEM_END = "</item>"
# From the first opening tag of an item on; one that closes itself has no content.
ITEM = r"(?s)<item(?:\s[^>]*)?(?<!/)>.*"
READ_ITEM = "title string, link string, pubDate string, unread string"


def read_feed_items(spark, path):
    """(file, title, link, pubDate, unread): one row per item of landed feed files of any size.

    Files are read as text that is cut behind each closing item tag, so a large feed is split over
    many tasks and a row is never larger than an item.  Items are reduced to ASCII before parsing.
    An item that is not well-formed, among them one whose closing tag is missing or which holds one in a
    CDATA part, has nulls and its text in ``unread``, which is null elsewhere.  A file that ends inside an item
    gives what it has of it if that is well-formed.
    """
    pieces = spark.read.option("lineSep", ITEM_END).text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    items = pieces.select("file", F.regexp_extract("value", ITEM, 0).alias("item")).where(F.col("item") != "")
    plain = F.concat(F.regexp_replace("item", r"[^\x00-\x7F]", "?"), F.lit(ITEM_END))
    parsed = F.from_xml(plain, READ_ITEM, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "unread"})
    rows = items.select("file", parsed.alias("item")).select("file", "item.*")
    read = lambda name: F.when(F.col("unread").isNull(), F.col(name)).alias(name)
    return rows.select("file", read("title"), read("link"), read("pubDate"), "unread")
