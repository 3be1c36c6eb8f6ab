"""Landed feeds and pages to News.Semantic; legislation differs by its keywords only."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from civicmill import schemas
from civicmill.functions.casts import conform
from civicmill.functions.text import ascii_text, feed_time, visible_text
from civicmill.operators.entities import entity_sentiment, keyword_articles
from civicmill.plans.warehouse import append_table
from civicmill.session import remove_path, scratch_path
from civicmill.sources.feeds import read_feed_items, rss_items

# The news table holds texts of this many characters at most (fixed value).
TEXT_LIMIT = 64 * 1024

# Names that are followed (fixed values).
KEYWORDS = [
    "Lee Zeldin", "Jeff Klein", "John Faso", "Marisol Alcantara", "David Valesky",
    "David Carlucci", "Diane Savino", "Tony Avella", "Jose Peralta", "Jesse Hamilton",
]


def with_page_text(items, pages, landed="landed"):
    """Add the visible text of the page each item links to; null where it has not landed.

    Only linked pages are cleaned, each once however many items link to it.  Of pages landed
    twice under one address the latest by the column ``landed`` counts, if there is one; of several
    the one whose content has the smallest hash.  Pages are ranked before they move, and a task
    sends one of each address.
    """
    when = F.col(landed) if landed in pages.columns else F.lit(None).cast("timestamp")
    landed = pages.select(F.col("url").alias("__url"), F.col("html").alias("__html"), when.alias("__when"))
    linked = landed.join(items.select(F.col("link").alias("__url")), "__url", "left_semi")
    latest = Window.partitionBy("__url").orderBy(F.col("__when").desc_nulls_last(), F.xxhash64("__html"))
    single = linked.withColumn("__place", F.row_number().over(latest)).where("__place = 1")
    cleaned = single.select("__url", visible_text(F.col("__html")).alias("text"))
    joined = items.join(cleaned, items["link"] == cleaned["__url"], "left")
    return joined.select(*[items[c] for c in items.columns], "text")


def articles(feeds, pages):
    """Items of landed feeds (keyword, feed) with page text."""
    return with_page_text(rss_items(feeds), pages)


def semantic(rows, gazetteer, lexicon, longest=2):
    """Article rows (keyword, title, link, pubDate, text) to the news table; nothing is shuffled."""
    scored = entity_sentiment(rows, gazetteer, lexicon, longest=longest)
    plain = scored.select(
        "keyword",
        ascii_text(F.col("title")).alias("title"),
        ascii_text(F.col("link")).alias("url"),
        feed_time(F.col("pubDate")).alias("pubdate"),
        ascii_text(F.col("text"), TEXT_LIMIT).alias("text"),
        "entities",
    )
    return conform(plain, schemas.NEWS)


def tag_landed(landed, keywords=KEYWORDS):
    """Keyword rows of articles that were landed without a search keyword.

    A keyword counts in the text, and in the title of articles that have one.
    """
    searched = landed.withColumn("__searched", F.concat_ws("\n", *[c for c in ("title", "text") if c in landed.columns]))
    return keyword_articles(searched, keywords, "__searched").drop("__searched")


def load_news(spark, feeds, pages, gazetteer, lexicon, table="News.Semantic"):
    """The whole job; it adds to the table."""
    append_table(semantic(articles(feeds, pages), gazetteer, lexicon), table)


def load_news_files(
    spark, path, pages, gazetteer, lexicon, keywords=KEYWORDS, table="News.Semantic", rejected="News.Rejected"
):
    """The job for feed files of any size that were landed without a search keyword; it adds to both tables.

    Each item is written under every keyword in its title or page text; items that cannot be
    read go to ``rejected`` (file, item).  The files are read once.
    """
    landed = scratch_path(spark, "feed-items")
    read_feed_items(spark, path).write.parquet(landed)
    items = spark.read.parquet(landed)
    found = with_page_text(items.where("unread is null").drop("unread"), pages)
    append_table(semantic(tag_landed(found, keywords), gazetteer, lexicon), table)
    append_table(items.where("unread is not null").select("file", F.col("unread").alias("item")), rejected)
    remove_path(spark, landed)
