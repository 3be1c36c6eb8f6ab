"""Feeds, pages, articles and their entities."""

from pyspark.sql import functions as F

from civicmill.functions.text import ascii_text, feed_time, visible_text
from civicmill.operators.entities import entity_sentiment, keyword_articles as tag_keywords
from civicmill.plans.news import with_page_text
from civicmill.session import scratch_path
from civicmill.sources.feeds import read_feed_items, rss_items as read_items
from entryqueries.tables import every, read

c, lit = F.col, F.lit
FEED_TIME = "EEE, dd MMM yyyy HH:mm:ss 'GMT'"


def _feeds(spark, sf_dir, title=None):
    """A feed per event: two items, one, or none."""
    item = lambda title, when: F.concat(
        lit("<item><title>"), title, lit("</title><link>http://news.example/"), c("event_id"), lit("?a=1&amp;b=2</link><guid>x</guid>"),
        lit("<pubDate>"), when, lit("</pubDate></item>"),
    )
    when = F.date_format("ts", FEED_TIME)
    items = F.when(every("event_id", 10), lit("")).otherwise(F.concat(
        item(F.concat(c("event_type"), lit(" é &lt;b&gt;") if title is None else title), when),
        F.when(every("event_id", 3), item(F.concat(lit("user "), c("user_id")), when)).otherwise(lit("")),
    ))
    feed = F.concat(lit("<rss><channel><title>feed</title>"), items, lit("</channel></rss>"))
    return read(spark, sf_dir, "events").select("event_id", feed.alias("feed"))


def rss_items(spark, sf_dir):
    return read_items(_feeds(spark, sf_dir))


RSS_ITEMS = """
WITH i AS (SELECT event_id, event_type || ' ? <b>' AS title, ts FROM events WHERE event_id % 10 <> 0
           UNION ALL SELECT event_id, 'user ' || user_id, ts FROM events WHERE event_id % 10 <> 0 AND event_id % 3 = 0)
SELECT event_id, title, 'http://news.example/' || event_id || '?a=1&b=2' AS link, strftime(ts, '%a, %d %b %Y %H:%M:%S GMT') AS "pubDate" FROM i"""


def feed_files(spark, sf_dir):
    """The items of feed files that hold all feeds, with the text of those that cannot be read."""
    title = F.when(every("event_id", 7), lit(" é <b>")).otherwise(lit(" é &lt;b&gt;"))
    path = scratch_path(spark, "feeds")
    _feeds(spark, sf_dir, title).select("feed").write.text(path)
    return read_feed_items(spark, path).drop("file")


FEED_FILES = """
WITH i AS (SELECT event_id, event_type || CASE WHEN event_id % 7 = 0 THEN ' ? <b>' ELSE ' ? &lt;b&gt;' END AS told, event_type || ' ? <b>' AS title,
                  event_id % 7 = 0 AS bad, ts FROM events WHERE event_id % 10 <> 0
           UNION ALL SELECT event_id, '', 'user ' || user_id, false, ts FROM events WHERE event_id % 10 <> 0 AND event_id % 3 = 0),
t AS (SELECT *, strftime(ts, '%a, %d %b %Y %H:%M:%S GMT') AS day FROM i)
SELECT CASE WHEN NOT bad THEN title END AS title, CASE WHEN NOT bad THEN 'http://news.example/' || event_id || '?a=1&b=2' END AS link,
       CASE WHEN NOT bad THEN day END AS "pubDate",
       CASE WHEN bad THEN '<item><title>' || told || '</title><link>http://news.example/' || event_id || '?a=1&amp;b=2</link><guid>x</guid><pubDate>'
                          || day || '</pubDate></item>' END AS unread
FROM t"""


def pubdate_parse(spark, sf_dir):
    text = F.when(every("event_id", 7), lit("yesterday")).otherwise(F.date_format("ts", FEED_TIME))
    return read(spark, sf_dir, "events").select("event_id", F.unix_timestamp(feed_time(text)).alias("seconds"))


PUBDATE_PARSE = """
SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN CAST(floor(epoch(ts)) AS BIGINT) END AS seconds FROM events"""


def html_visible_text(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", visible_text(c("html")).alias("text"))


# The same cleaning in RE2: hidden parts, then tags, then references, then white space.
_VISIBLE = "html"
for _pattern in (
    r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>|<title\b.*?</title\s*>",
    r"(?s)</?[a-zA-Z!?][^>]*>",
):
    _VISIBLE = f"regexp_replace({_VISIBLE}, '{_pattern}', ' ', 'g')"
for _name, _char in (
    ("nbsp", " "), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("apos", "''"), ("copy", "©"), ("middot", "·"), ("amp", "&"),
):
    _VISIBLE = f"replace({_VISIBLE}, '&{_name};', '{_char}')"
_VISIBLE = f"trim(regexp_replace({_VISIBLE}, '\\s+', ' ', 'g'))"

HTML_VISIBLE_TEXT = f"SELECT page_id, {_VISIBLE} AS text FROM pages"


def tagged_text(spark, sf_dir):
    """A page around known values; its tags hold quoted ``>``, quotes in quotes, and one left open."""
    page = F.concat(
        lit("<!DOCTYPE html><title>x</title><body class='a>b'><p title=\"x > y\" lang='>'>"), c("c_name"), lit("</p><img alt='a \"> b' src=q>"),
        c("c_mktsegment"), lit("<br/>&lt;"), c("c_custkey").cast("string"), lit("&gt; 3 < 4 <a href=\"open>"), c("c_nationkey").cast("string"), lit("</a>"))
    return read(spark, sf_dir, "customer").select("c_custkey", visible_text(page).alias("text"))


TAGGED_TEXT = """
SELECT c_custkey, c_name || ' ' || c_mktsegment || ' <' || c_custkey || '> 3 < 4 ' || c_nationkey AS text FROM customer"""


def article_text(spark, sf_dir):
    """Two items per page; some link to pages that never landed."""
    pages = read(spark, sf_dir, "pages")
    link = F.when(every("page_id", 4), F.concat("url", lit("/gone"))).otherwise(c("url"))
    items = pages.select(c("page_id").alias("item"), link.alias("link"))
    again = pages.select((-c("page_id") - 1).alias("item"), c("url").alias("link"))
    return with_page_text(items.unionByName(again), pages)


ARTICLE_TEXT = f"""
SELECT page_id AS item, CASE WHEN page_id % 4 = 0 THEN url || '/gone' ELSE url END AS link,
       CASE WHEN page_id % 4 <> 0 THEN {_VISIBLE} END AS text FROM pages
UNION ALL SELECT -page_id - 1, url, {_VISIBLE} FROM pages"""


def text_ascii(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", ascii_text(c("text")).alias("text"))


TEXT_ASCII = r"SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', '?', 'g') AS text FROM documents"

KEYWORDS = ["the and", "tion", "eau", "Nicht", "pour", "ment", "of the", "que", "para", "zzzz"]


def keyword_articles(spark, sf_dir):
    documents = read(spark, sf_dir, "documents")
    return tag_keywords(documents, KEYWORDS).select("keyword", "doc_id", "lang", "n_chars")


KEYWORD_ARTICLES = f"""
SELECT keyword, doc_id, lang, n_chars
FROM documents JOIN (SELECT unnest({KEYWORDS}) AS keyword) ON contains(text, keyword)"""


def many_keywords(spark, sf_dir):
    """Documents under every word of four letters or more that a benchmark item holds."""
    words = read(spark, sf_dir, "benchmark").select(F.explode(F.split("text", "[^A-Za-z]+")).alias("word")).where(F.length("word") > 3).distinct()
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return tag_keywords(documents, [row["word"] for row in words.collect()]).select("keyword", "doc_id")


MANY_KEYWORDS = """
SELECT keyword, doc_id
FROM (SELECT DISTINCT keyword FROM (SELECT unnest(string_split_regex(text, '[^A-Za-z]+')) AS keyword FROM benchmark) WHERE length(keyword) > 3)
JOIN documents ON contains(text, keyword)"""

GAZETTEER = [
    ("Rest", "http://wiki.example/Rest"), ("That", None), ("Of The", "http://wiki.example/Of_The"), ("Eau", None), ("Nicht", "http://wiki.example/Nicht"),
    ("This", "http://wiki.example/This"), ("Para", None), ("Pour", None), ("Est", None),
]
LEXICON = [("the", 0.5), ("of", -1.0), ("und", 0.25), ("les", 1.0), ("que", -0.5), ("with", 1.0), ("this", -0.75)]


def entities(spark, sf_dir):
    """Entities of every document, unnested."""
    gazetteer = spark.createDataFrame(GAZETTEER, "name string, wikipedia_url string")
    lexicon = spark.createDataFrame(LEXICON, "term string, polarity double")
    scored = entity_sentiment(read(spark, sf_dir, "documents"), gazetteer, lexicon, longest=2)
    return scored.select("doc_id", F.inline("entities")).select(
        "doc_id", "name", "wikipedia_url", *[F.round(n, 10).alias(n) for n in ("salience", "score", "magnitude")]
    )


def _values(rows):
    quoted = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else repr(v)
    return ", ".join("(" + ", ".join(quoted(v) for v in row) + ")" for row in rows)


ENTITY_SENTIMENT = rf"""
WITH names(name, wikipedia_url) AS (VALUES {_values(GAZETTEER)}), lexicon(term, polarity) AS (VALUES {_values(LEXICON)}),
sentences AS (SELECT doc_id, generate_subscripts(parts, 1) AS sentence, unnest(parts) AS line
              FROM (SELECT doc_id, string_split_regex(lower(text), '[.!?\n]+') AS parts FROM documents)),
words AS (SELECT doc_id, sentence, list_filter(string_split_regex(line, '[^\p{{L}}\p{{N}}'']+'), lambda w: w <> '') AS w FROM sentences),
runs AS (SELECT doc_id, sentence, unnest(w) AS word FROM words
         UNION ALL SELECT doc_id, sentence, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words),
rated AS (SELECT doc_id, sentence, avg(polarity) AS polarity FROM runs JOIN lexicon ON term = word GROUP BY ALL),
named AS (SELECT doc_id, sentence, name, wikipedia_url, count(*) AS n FROM runs JOIN names ON lower(name) = word GROUP BY ALL),
scored AS (SELECT doc_id, name, wikipedia_url, sum(n) AS n, avg(coalesce(polarity, 0)) AS score, sum(abs(coalesce(polarity, 0))) AS magnitude
           FROM named LEFT JOIN rated USING (doc_id, sentence) GROUP BY ALL)
SELECT doc_id, name, wikipedia_url, round(n / sum(n) OVER (PARTITION BY doc_id), 10) AS salience, round(score, 10) AS score, round(magnitude, 10) AS magnitude
FROM scored QUALIFY n / sum(n) OVER (PARTITION BY doc_id) > 0.001"""

QUERIES = {
    "rss_items": rss_items,
    "feed_files": feed_files,
    "pubdate_parse": pubdate_parse,
    "html_visible_text": html_visible_text,
    "tagged_text": tagged_text,
    "article_text": article_text,
    "text_ascii": text_ascii,
    "keyword_articles": keyword_articles,
    "many_keywords": many_keywords,
    "entity_sentiment": entities,
}

ORACLES = {
    "rss_items": RSS_ITEMS,
    "feed_files": FEED_FILES,
    "pubdate_parse": PUBDATE_PARSE,
    "html_visible_text": HTML_VISIBLE_TEXT,
    "tagged_text": TAGGED_TEXT,
    "article_text": ARTICLE_TEXT,
    "text_ascii": TEXT_ASCII,
    "keyword_articles": KEYWORD_ARTICLES,
    "many_keywords": MANY_KEYWORDS,
    "entity_sentiment": ENTITY_SENTIMENT,
}
