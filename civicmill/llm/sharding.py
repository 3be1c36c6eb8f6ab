"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns a number of virtual nodes on a ring of cells.  A document hashes to a cell and
belongs to the next virtual node clockwise.  A shard holds no more rows than its share; documents
that find their shard full continue clockwise to the next virtual node whose shard has room.  All
documents are first offered to their own shard, then the overflow is placed in clockwise order.

The placement is decided on counts: rows per cell, then rows per arc between two virtual nodes.
Both tables have a size fixed by the parameters.  A row only needs its rank within its arc, which
comes from the cells, so no task sees more than one cell and no shard is ever sorted as a whole.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from civicmill.llm.common import pick
from civicmill.session import cut

SHARDS, VNODES, CELLS = 16, 128, 16384


def ring_points(spark, shards=SHARDS, vnodes=VNODES, cells=CELLS):
    """(cell, shard): where the virtual nodes stand.  Of two in one cell the smaller shard's counts."""
    node = spark.range(shards * vnodes).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("vnode"))
    cell = F.pmod(F.xxhash64("shard", "vnode"), F.lit(cells)).alias("cell")
    return node.select(cell, "shard").groupBy("cell").agg(F.min("shard").alias("shard"))


def keyed_rows(docs, cells=CELLS):
    """Rows with their hash and cell; equal rows are one row with a number of copies."""
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    rows = pick(docs, "doc_id", "text").select("doc_id", size, crc)
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    rows = rows.withColumn("key_hash", F.xxhash64("doc_id", "size", "text_crc32"))
    return rows.withColumn("cell", F.pmod("key_hash", F.lit(cells)))


def ring_layout(points, counts, cells=CELLS):
    """(cell, arc, shard, offset, n) of every cell: its arc ends at the next virtual node."""
    spark = points.sparkSession
    named = points.withColumnsRenamed({"shard": "point_shard"}).withColumn("point", F.col("cell"))
    all_cells = spark.range(cells).withColumnRenamed("id", "cell")
    ahead = Window.orderBy("cell").rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def next_point(name):
        # behind the last virtual node the ring starts again at the first
        return F.coalesce(F.first(name, True).over(ahead), F.first(name, True).over(whole))

    cells_of = all_cells.join(named, "cell", "left").join(counts, "cell", "left").select(
        "cell", F.coalesce("n", F.lit(0)).alias("n"), next_point("point").alias("arc"),
        next_point("point_shard").alias("shard"))
    before = Window.partitionBy("arc").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    return cells_of.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))


def place_arcs(layout, shards=SHARDS):
    """(arc, lo, n, shard, base): ranks [lo, lo + n) of an arc go to slots from ``base`` of a shard."""
    arcs = layout.groupBy("arc", "shard").agg(F.sum("n").alias("n"))
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("n").over(everything)
    capacity = F.floor(total / shards) + (F.col("shard") < F.pmod(total, F.lit(shards))).cast("long")
    before = Window.partitionBy("shard").orderBy("arc").rowsBetween(Window.unboundedPreceding, -1)
    homes = arcs.withColumn("capacity", capacity).withColumn(
        "home", F.greatest(F.lit(0), F.least("n", F.col("capacity") - F.coalesce(F.sum("n").over(before), F.lit(0)))))
    homes = homes.select("arc", "shard", "n", "home", "capacity", total.alias("total"))

    one = homes.agg(
        F.array_sort(F.collect_list(F.struct("arc", "shard", "n", "home"))).alias("ring"),
        F.max("total").alias("total"))
    shard_list = F.sequence(F.lit(0), F.lit(shards - 1))

    def room(shard):
        share = F.floor(F.col("total") / shards) + (shard < F.pmod(F.col("total"), F.lit(shards))).cast("long")
        held = F.aggregate("ring", F.lit(0).cast("long"),
                           lambda sum_, a: sum_ + F.when(a["shard"] == shard, a["home"]).otherwise(0))
        return share - held

    # the shards in clockwise order behind each arc that overflows
    around = F.col("ring")["shard"]
    overflow = F.filter(
        F.transform("ring", lambda a, i: F.struct(
            a["arc"].alias("arc"), a["home"].alias("lo"), (a["n"] - a["home"]).alias("left"),
            F.array_distinct(F.concat(
                F.slice(around, i + 2, F.size(around)), F.slice(around, F.lit(1), i + 1))).alias("order"))),
        lambda a: a["left"] > 0)
    one = one.select("ring", F.transform(shard_list, room).alias("room"), overflow.alias("overflow"))

    def offer(state, shard):
        """As many as are left and fit go to the shard; the rest goes on."""
        take = F.least(state["left"], F.element_at(state["room"], shard + 1))
        return F.struct(
            state["arc"].alias("arc"), (state["lo"] + take).alias("lo"), (state["left"] - take).alias("left"),
            F.transform(state["room"], lambda r, i: F.when(i == shard, r - take).otherwise(r)).alias("room"),
            F.when(take > 0, F.concat(state["parts"], F.array(F.struct(
                state["arc"].alias("arc"), state["lo"].alias("lo"), take.alias("n"), shard.alias("shard")))))
            .otherwise(state["parts"]).alias("parts"))

    def walk(state, a):
        start = F.struct(a["arc"].alias("arc"), a["lo"].alias("lo"), a["left"].alias("left"),
                         state["room"].alias("room"), state["parts"].alias("parts"))
        return F.aggregate(a["order"], start, offer, lambda end: F.struct(
            end["room"].alias("room"), end["parts"].alias("parts")))

    empty = F.expr("cast(array() as array<struct<arc: bigint, lo: bigint, n: bigint, shard: int>>)")
    moved = F.aggregate("overflow", F.struct(F.col("room").alias("room"), empty.alias("parts")), walk,
                        lambda end: end["parts"])
    kept = F.transform("ring", lambda a: F.struct(
        a["arc"].alias("arc"), F.lit(0).cast("long").alias("lo"), a["home"].alias("n"), a["shard"].alias("shard")))
    parts = one.select(F.inline(F.concat(kept, moved))).where("n > 0")
    in_shard = Window.partitionBy("shard").orderBy("arc", "lo").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("base", F.coalesce(F.sum("n").over(in_shard), F.lit(0)))


def shard_documents(docs, shards=SHARDS, vnodes=VNODES, cells=CELLS):
    """(doc_id, size, text_crc32, home_shard, shard, slot), one row per row of ``docs`` (doc_id, text).

    The row counts of any two shards differ by at most one.  A document's place on the ring follows
    from its id and text; null ids and null texts hash like any other value, a null text has size 1.
    Equal rows are ranked one after the other.  An empty table gives no rows.  Other columns of
    ``docs``, whatever their names, are not read.
    """
    spark = docs.sparkSession
    keyed = cut(keyed_rows(docs, cells))
    counts = keyed.groupBy("cell").agg(F.sum("copies").alias("n"))
    layout = cut(ring_layout(ring_points(spark, shards, vnodes, cells), counts, cells))
    parts = place_arcs(layout, shards).groupBy("arc").agg(
        F.collect_list(F.struct("lo", "n", "shard", "base")).alias("parts"))
    cell_plan = layout.select("cell", "arc", "offset", F.col("shard").alias("home_shard")).join(parts, "arc").drop("arc")

    before = Window.partitionBy("cell").orderBy("key_hash", "doc_id", "size", "text_crc32").rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = keyed.withColumn("before", F.coalesce(F.sum("copies").over(before), F.lit(0)))
    # one row per cell, and there are ``cells`` of them whatever the input
    placed = ranked.join(F.broadcast(cell_plan), "cell")
    first = F.col("offset") + F.col("before")
    placed = placed.withColumn("rank", F.explode(F.sequence(first, first + F.col("copies") - 1)))
    part = F.element_at(F.filter("parts", lambda p: (F.col("rank") >= p["lo"]) & (F.col("rank") < p["lo"] + p["n"])), 1)
    placed = placed.withColumn("part", part)
    return placed.select(
        "doc_id", "size", "text_crc32", "home_shard", F.col("part")["shard"].alias("shard"),
        (F.col("part")["base"] + F.col("rank") - F.col("part")["lo"]).alias("slot"))
