"""Helpers that several operators share."""

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# A word is a run of anything but a blank and these; ``WORD`` is the same as a pattern.
OTHER_BLANKS = "\t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"
SPREAD = 32                 # tasks that thin the rows of one key


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df, *names):
    """Only the named columns, found by exact name; a second column of the same name, or of one
    that differs in case only, is not looked at and cannot make the name ambiguous."""
    places = [df.columns.index(n) for n in names]
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{i}").alias(n) for i, n in zip(places, names)])


def held_out(doc_id):
    """True for documents whose labels must not be learned; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def blanked(text):
    """The text with a blank for every character between words; much cheaper than a pattern."""
    for c in OTHER_BLANKS:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def words_of(text):
    return F.array_remove(F.split(blanked(text), " "), "")


def bind(expr, body):
    """``body(x)`` with ``x`` evaluated once, however often the body reads it."""
    return F.element_at(F.transform(F.array(expr), body), 1)


def first_of_each(df, key, per_key, *order):
    """At most ``per_key`` rows of each key, the first in ``order``.

    The row number is tested right above its window, so Spark keeps no more than that many rows
    of a key in any task before the shuffle.  What the tasks keep is thinned by ``SPREAD`` tasks for
    each key first, so the last task of a key reads at most ``SPREAD * per_key`` rows however many tasks there are.
    """
    rows = df.withColumn("spread", F.spark_partition_id() % SPREAD)
    for keys in ([key, "spread"], [key]):
        window = Window.partitionBy(*keys).orderBy(*order)
        rows = rows.withColumn("place_in_key", F.row_number().over(window)).where(
            F.col("place_in_key") <= per_key).drop("place_in_key")
    return rows.drop("spread")


def learnable(docs, labels, label):
    """(doc_id, value) of the ids whose label may be learned; of several labels the largest counts."""
    known = pick(labels, "doc_id", label).where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    return known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(label).alias("value"))


def labelled_sample(docs, labels, label, per_value, max_chars):
    """A bounded sample of labelled documents for training: (doc_id, text, value).

    At most ``per_value`` documents of each value, with texts of up to ``max_chars`` characters.
    The ids are chosen first, so the broadcast side has a fixed bound; the texts are read once.
    Of several texts of one id the smallest counts, so repeated rows do not enlarge the sample.
    """
    ids = first_of_each(learnable(docs, labels, label), "value", per_value, F.xxhash64("doc_id"), "doc_id")
    texts = pick(docs, "doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
    return texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "value").agg(F.min("text").alias("text"))


def map_batches(df, keep, fields, start):
    """The ``keep`` columns, passed on as Arrow arrays untouched, and new columns.

    ``fields`` are (name, Spark type) pairs.  ``start()`` runs once per task and returns a function
    from an Arrow batch to one list or array per field.
    """
    added = T.StructType([T.StructField(n, t) for n, t in fields])
    schema = T.StructType([df.schema[k] for k in keep] + added.fields)
    names = schema.names

    def run(batches):
        compute = start()
        types = to_arrow_schema(added).types
        for batch in batches:
            made = [pa.array(v, type=t) for v, t in zip(compute(batch), types)]
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + made, names=names)

    return df.mapInArrow(run, schema)
