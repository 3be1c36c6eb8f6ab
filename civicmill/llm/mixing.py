"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, repeated up to ``most`` times.  A copy
of a document has the virtual finish time of its last word: the words of its source up to there,
divided by the weight of the source, which is its share of the budget.  Weights add up to one, so
virtual time is the number of words that all queues have served together, and the budget is used up
at the virtual time that equals it.  Copies are sorted by finish time over all tasks; the order is
cut at the budget, and the copy that a source has in service there gives its first words.
"""

from pyspark.sql import functions as F

from civicmill.llm.common import pick, words_of
from civicmill.llm.running import running
from civicmill.session import cut

WEIGHTS, SHARE, MOST = (1, 2, 3), 1, 3


def sized_documents(docs):
    """(row, doc_id, source, size): words of the whole text."""
    size = F.size(words_of(F.coalesce("text", F.lit("")))).cast("long")
    return pick(docs, "doc_id", "source", "text").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "source", size.alias("size"))


def source_targets(sized, weights=WEIGHTS, share=SHARE, most=MOST):
    """(source, place, source_size, weight, target) of every source.

    Sources in code point order, null last, take ``weights`` in turn.  They share ``share`` times all
    words by weight; a target stops at ``most`` times the words of its source and the excess goes to
    the others by weight.  With the sources in the order in which they reach that stop, the level
    (words for a weight of one) is the first that the next source in the order can still take.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("one", F.lit(1).cast("long"))
    ranked = running(sources, [], [F.col("source").asc_nulls_last()], {"place": ("sum", F.col("one"))})
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("stop", most * F.col("source_size"))
    ranked = ranked.withColumn("stop_level", F.col("stop") / F.col("weight"))
    filled = running(ranked, [], ["stop_level", "place"], {
        "stopped": ("sum", F.col("stop")), "stopped_weight": ("sum", F.col("weight"))})
    words, weight_sum = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (share * F.lit(words).cast("double") - F.col("stopped")) / (F.lit(weight_sum) - F.col("stopped_weight"))
    row = filled.select("stop_level", "place", level.alias("level")).where("level <= stop_level").agg(
        F.min_by("level", F.struct("stop_level", "place"))).first()
    target = F.col("stop").cast("double")
    if row[0] is not None:
        target = F.least(target, F.col("weight") * F.lit(row[0]))
    return filled.select("source", "place", "source_size", "weight", target.alias("target"))


def serve_copies(docs, weights=WEIGHTS, share=SHARE, most=MOST):
    """Every copy that begins before the budget is used up, and the first copy of every other row:
    (row, doc_id, source, size, source_size, target, copy, finish, position, words)."""
    sized = cut(sized_documents(docs))  # the texts are read once
    targets = source_targets(sized, weights, share, most)
    known = targets.withColumnRenamed("source", "named")
    queued = sized.join(known, F.col("source").eqNullSafe(F.col("named"))).drop("named").withColumn(
        "shuffled", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    queued = running(queued, ["place"], ["shuffled", "doc_id", "size", "row"], {"ahead": ("sum", F.col("size"))})
    copies = queued.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    copies = copies.withColumn("begin", F.col("copy") * F.col("source_size") + F.col("ahead"))
    copies = copies.where((F.col("copy") == 0) | (F.col("begin") < F.col("target")))
    budget = share * targets.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    served = F.greatest(F.lit(0), F.least(F.col("size"), F.floor(F.col("target") - F.col("begin")))).cast("long")
    # a copy in service when the budget is used up ends there
    finish = F.least(F.when(F.col("target") > 0, (F.col("begin") + F.col("size")) / (F.col("target") / F.lit(float(budget)))),
                     F.lit(float(budget)))
    copies = copies.withColumn("served", served).withColumn("finish", finish)
    mixed = running(copies, [], ["finish", "place", "copy", "shuffled", "doc_id", "size", "row"], {"position": ("sum", F.col("served"))})
    words = F.least("served", F.greatest(F.lit(0), F.floor(F.lit(budget) - F.col("position")))).cast("long")
    return mixed.select("row", "doc_id", "source", "size", "source_size", "target", "copy", "finish", "position", words.alias("words"))


def mix_sources(docs, weights=WEIGHTS, share=SHARE, most=MOST):
    """The mix: (doc_id, source, copy, finish, position, words), a row for each copy it takes.

    ``docs`` has doc_id, source and text.  ``position`` counts the words of the mix before the copy, ``words`` those
    it gives, from its beginning; all but the last copy of a source are whole.  A null text has no
    words, and rows without words are never taken.  A null source is one of its own.  Repeated rows are
    documents like others; documents are shuffled by a hash of their id, ties and null ids by size.  An
    empty table gives no rows.  Other columns, whatever their names, are not read.
    """
    taken = serve_copies(docs, weights, share, most).where("words > 0")
    return taken.select("doc_id", "source", "copy", "finish", "position", "words")


def mixing_digest(docs):
    """(doc_id, size, source_size, target, taken), one row per row of ``docs``."""
    per_row = serve_copies(docs).groupBy("row", "doc_id", "size", "source_size", "target")
    return per_row.agg(F.sum("words").alias("taken")).drop("row")
