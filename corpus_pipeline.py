"""From raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's ``docs``.  All but the last return the columns of ``documents``.
"""

from civicmill.llm.common import table
from civicmill.llm.decontaminate import scan_documents
from civicmill.llm.line_dedup import drop_recurring_lines
from civicmill.llm.packing import pack_documents
from civicmill.llm.simhash import one_of_each_group
from civicmill.llm.site_quality import posteriors
from civicmill.session import remove_path, scratch_path
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def classify_quality(spark, docs, sf_dir):
    """Documents that the quality classifier rejects go; every copy of a rejected row goes with it."""
    scored = posteriors(docs, table(spark, sf_dir, "labels"))
    rejected = scored.where("rejected").select("row_key").distinct()
    keyed = docs.select(*COLUMNS, F.xxhash64("doc_id", "text", "lang", "source").alias("row_key"))
    return keyed.join(rejected, "row_key", "left_anti").select(*COLUMNS)


def dedup_lines(spark, docs, sf_dir):
    """Lines whose template stands in an earlier document go; a document without words left goes with them."""
    cleaned = drop_recurring_lines(docs, "lang", "source", "n_chars").where("emptied is null or not emptied")
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(*COLUMNS)


def dedup_documents(spark, docs, sf_dir):
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return one_of_each_group(docs).select(*COLUMNS)


def decontaminate(spark, docs, sf_dir):
    """Documents that hold a window of a benchmark item go."""
    scanned = scan_documents(docs, table(spark, sf_dir, "benchmark"), ["lang", "source", "n_chars"])
    return scanned.where(F.size("ranges") == 0).select(*COLUMNS)


def pack(spark, docs, sf_dir):
    return pack_documents(docs)


STAGES = [
    ("quality classifier", classify_quality),
    ("line dedup", dedup_lines),
    ("simhash near-dedup", dedup_documents),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]

# Three stages learn or decode bits, which SQL does not express; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; returns what the last one does.

    What a stage writes is removed as soon as the next one has been written.  The last stage keeps
    what it needs in a checkpoint.
    """
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        if last:
            remove_path(spark, last)
        docs, last = spark.read.parquet(path), path
    packed = STAGES[-1][1](spark, docs, sf_dir)
    remove_path(spark, last)
    return packed
