"""Running totals in an order over all tasks, whatever share of the rows one group holds."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from civicmill.session import cut

# An aggregate and how two partial results of it are put together.
JOINED = {"sum": (F.sum, lambda a, b: a + b), "xor": (F.bit_xor, lambda a, b: a.bitwiseXOR(b))}


def range_parts(df, *order):
    """The rows with ``part``, the number of the range of ``order`` they stand in.

    Rows of an earlier part sort before those of a later one, and equal rows share a part.
    """
    return cut(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))


def running(df, by, order, totals):
    """The rows of ``df`` with the totals of all rows before them in their group.

    ``by`` names columns without nulls, ``order`` columns, and ``totals`` maps a new name to
    (``sum`` or ``xor``, a long column).  Rows equal in ``order`` come in any order.  Rows are dealt out by
    ranges of group and order, so a group of any size spreads over many tasks; each task adds up
    within its range, and the totals of the ranges, a row for each range and group, are added up after.
    """
    parts = range_parts(df, *by, *order)
    here = Window.partitionBy("part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy("part", *by).agg(*[JOINED[how][0](of).alias(f"{n}_part") for n, (how, of) in totals.items()])
    sums = sums.select("part", *by, *[
        F.coalesce(JOINED[how][0](f"{n}_part").over(ahead), F.lit(0)).alias(f"{n}_ahead") for n, (how, _) in totals.items()])
    rows = parts.select("*", *[
        F.coalesce(JOINED[how][0](of).over(here), F.lit(0)).alias(f"{n}_here") for n, (how, of) in totals.items()])
    made = [JOINED[how][1](F.col(f"{n}_here"), F.col(f"{n}_ahead")).alias(n) for n, (how, _) in totals.items()]
    return rows.join(sums, ["part", *by]).select(*df.columns, *made)
