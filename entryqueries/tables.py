"""Access to the given tables."""

from pyspark.sql import functions as F

from civicmill.session import scratch_path
from civicmill.sources.lines import read_lines


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def every(col, n):
    """True for one row in ``n``: used to put dirt into rows, never to leave rows out."""
    return F.col(col) % n == 0


def cents(col):
    return F.round(F.col(col) * 100).cast("long")


def landed_lines(rows, line, label):
    """Write a line per row as text files and read them as a landed file would be."""
    path = scratch_path(rows.sparkSession, label)
    rows.select(line.alias("value")).write.text(path)
    return read_lines(rows.sparkSession, path)
