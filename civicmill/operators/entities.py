"""Entity sentiment and keyword tags of articles, from a gazetteer and a polarity lexicon."""

import re
from collections import Counter

import ahocorasick
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from civicmill.operators.lookup import single_valued
from civicmill.operators.sizes import is_small, small_side

MIN_SALIENCE = 0.001
# Up to here looking for each keyword in the JVM is as fast as one automaton in Python.
FEW_KEYWORDS = 50
# Texts whose entities are held as Python values at once.
SLICE_ROWS, SLICE_BYTES = 256, 1 << 20
SENTENCE_END = r"[.!?\n]+"
BETWEEN_WORDS = r"[^\p{L}\p{N}']+"
SENTENCES = re.compile(SENTENCE_END)
WORDS = re.compile(r"(?:[^\W_]|')+")
ENTITIES = T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()), T.StructField("salience", T.DoubleType()), T.StructField("score", T.DoubleType()),
    T.StructField("magnitude", T.DoubleType()), T.StructField("wikipedia_url", T.StringType())]))


def _known_words(gazetteer, lexicon):
    """(word, name, wikipedia_url, polarity): one row per lower-case word or run of words."""
    names = single_valued(gazetteer.select(F.lower("name").alias("word"), "name", "wikipedia_url"), ["word"], ["name", "wikipedia_url"])
    terms = single_valued(lexicon.select(F.lower("term").alias("word"), "polarity"), ["word"], ["polarity"])
    return names.join(terms, "word", "full").where(F.col("word").isNotNull())


def _entities(text, known, firsts, longest, min_salience):
    """Scored entities of one lower-case text, most salient first; ``firsts`` are the words known runs begin with."""
    found = {}
    for line in SENTENCES.split(text):
        words = WORDS.findall(line)
        if firsts.isdisjoint(words):
            continue
        named, polarities = Counter(), []
        for at, word in enumerate(words):
            if word not in firsts:
                continue
            for size in range(1, min(longest, len(words) - at) + 1):
                run = word if size == 1 else " ".join(words[at:at + size])
                if run in known:
                    name, _, polarity = known[run]
                    named[run] += name is not None
                    if polarity is not None:
                        polarities.append(polarity)
        mean = sum(polarities) / len(polarities) if polarities else 0.0
        for run in +named:
            found.setdefault(run, []).append((named[run], mean))
    mentions = {run: sum(n for n, _ in seen) for run, seen in found.items()}
    total = sum(mentions.values())
    rows = [
        (known[run][0], mentions[run] / total, sum(m for _, m in seen) / len(seen), sum(abs(m) for _, m in seen), known[run][1])
        for run, seen in found.items()
    ]
    return sorted((r for r in rows if r[1] > min_salience), key=lambda r: (-r[1], r[0]))


def _scored_slices(texts, score):
    """Entities of an Arrow array of texts; only a slice of them is held in Python at a time."""
    kind, made, start = to_arrow_schema(T.StructType([T.StructField("entities", ENTITIES)])).types[0], [], 0
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    while start < len(texts):
        held = sizes[start:start + SLICE_ROWS].cumsum()
        stop = start + max(int(held.searchsorted(SLICE_BYTES, side="right")), 1)
        made.append(pa.array([
            [dict(zip(ENTITIES.elementType.names, e)) for e in score(t.as_py() or "")] for t in texts[start:stop]
        ], kind))
        start = stop
    return pa.concat_arrays(made) if made else pa.array([], kind)


def entity_sentiment(articles, gazetteer, lexicon, text="text", longest=1, min_salience=MIN_SALIENCE):
    """Articles with text, plus ``entities``: their scored entities, most salient first.

    ``gazetteer`` has (name, wikipedia_url), ``lexicon`` (term, polarity); both match lower-case
    words.  A sentence's polarity is the mean over its lexicon words, 0 without any.  Salience
    is the entity's share of all mentions in the article, score the mean and magnitude the sum
    of the absolute polarities of the sentences that name it.  Articles without text are left
    out, as are entities whose salience does not exceed ``min_salience``.

    Everything follows from one article, so nothing is shuffled: the words of both tables are
    sent to the tasks once.  Tables beyond the size check are refused; for them there is
    ``score_entities_by_join``.
    """
    words = _known_words(gazetteer, lexicon)
    if not is_small(words):
        raise ValueError("the gazetteer and lexicon are too large to broadcast: use score_entities_by_join")
    rows = {r["word"]: (r["name"], r["wikipedia_url"], r["polarity"]) for r in words.collect()}
    shared = articles.sparkSession.sparkContext.broadcast((rows, {word.split(" ")[0] for word in rows}))

    @F.arrow_udf(ENTITIES)
    def score(texts: pa.Array) -> pa.Array:
        return _scored_slices(texts, lambda t: _entities(t, *shared.value, longest, min_salience))

    # Spark would copy a deterministic function into the filter that unnesting implies, and run it twice.
    once = score.asNondeterministic()
    return articles.where(F.length(text) > 0).withColumn("entities", once(F.lower(text)))


def word_runs(words, longest):
    """All runs of one to ``longest`` neighbouring words, joined by spaces; pairs that would
    reach past the end are null."""
    runs = grown = words
    for size in range(2, longest + 1):
        following = F.slice(words, size, F.size(words))
        grown = F.zip_with(grown, following, lambda run, word: F.concat(run, F.lit(" "), word))
        runs = F.concat(runs, grown)
    return runs


def score_entities_by_join(articles, gazetteer, lexicon, key, text="text", longest=1, min_salience=MIN_SALIENCE):
    """(key, name, salience, score, magnitude, wikipedia_url) per entity an article names.

    The same scores as ``entity_sentiment`` for a gazetteer and lexicon of any size: the words of
    the articles are joined with them, and one shuffle by article serves every grouping.  ``key``
    must be unique per article.
    """
    known = _known_words(gazetteer, lexicon)
    sentences = articles.where(F.length(text) > 0).select(key, F.posexplode(F.split(F.lower(text), SENTENCE_END)).alias("sentence", "line"))
    # Splitting between words leaves empty strings at the ends of a line only; they match nothing.
    words = sentences.select(key, "sentence", F.split("line", BETWEEN_WORDS).alias("words"))
    runs = word_runs(F.col("words"), longest)
    found = words.select(key, "sentence", F.explode(runs).alias("word"))
    found = found.join(small_side(known), "word").select(key, "sentence", "name", "wikipedia_url", "polarity")

    by_article = found.repartition(F.col(key))
    mentions = by_article.groupBy(key, "sentence", "name", "wikipedia_url").agg(
        F.count("*").alias("n"), F.sum("polarity").alias("total"), F.count("polarity").alias("rated")
    )
    # One sentence, one row: its polarity and its distinct names with their counts.
    rated = mentions.groupBy(key, "sentence").agg(
        F.coalesce(F.try_divide(F.sum("total"), F.sum("rated")), F.lit(0.0)).alias("polarity"),
        F.collect_list(F.when(F.col("name").isNotNull(), F.struct("name", "wikipedia_url", "n"))).alias("named"),
    )
    entities = rated.select(key, "polarity", F.inline("named")).groupBy(key, "name", "wikipedia_url").agg(
        F.sum("n").alias("n"), F.avg("polarity").alias("score"), F.sum(F.abs("polarity")).alias("magnitude")
    )
    everything = entities.groupBy(key).agg(
        F.sum("n").alias("total"),
        F.collect_list(F.struct("name", "n", "score", "magnitude", "wikipedia_url")).alias("all"),
    )
    flat = everything.select(key, "total", F.inline("all"))
    salience = F.col("n") / F.col("total")
    flat = flat.select(key, "name", salience.alias("salience"), "score", "magnitude", "wikipedia_url")
    return flat.where(F.col("salience") > min_salience)


def keyword_articles(articles, keywords, text="text", few=FEW_KEYWORDS):
    """One row per keyword and article whose text contains it; a keyword listed twice counts once.

    The keywords are a configured list.  Up to ``few`` are looked for one by one inside the row.  More
    become one automaton, which is sent to the tasks once, so a text is scanned once however many there are.
    Nothing is joined.  An empty keyword is in every text; an article whose text is null has no rows.
    """
    listed = sorted(set(keywords))
    if len(listed) <= few:
        literals = F.array(*[F.lit(k) for k in listed]).cast("array<string>")
        tagged = F.filter(literals, lambda k: F.contains(F.col(text), k))
    else:
        tagged = _words_within(articles.sparkSession, listed)(F.col(text))
    return articles.select(F.explode(tagged).alias("keyword"), *articles.columns)


def _words_within(spark, words):
    """Function from a text to the sorted words it contains."""
    automaton = ahocorasick.Automaton()
    for word in filter(None, words):
        automaton.add_word(word, word)
    automaton.make_automaton()
    everywhere = {""} & set(words)
    shared = spark.sparkContext.broadcast(automaton)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def within(texts: pd.Series) -> pd.Series:
        found = lambda t: (shared.value.iter(t) if len(shared.value) else ())
        return texts.map(lambda t: sorted(everywhere | {k for _, k in found(t)}), na_action="ignore")

    return within
