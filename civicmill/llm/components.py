"""Connected components of an edge table, with nothing collected."""

from pyspark.sql import functions as F

from civicmill.session import cut

MOST_ROUNDS = 60


def _both_ways(edges):
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges):
    """Every neighbour larger than the node is linked to the smallest of the node and its neighbours."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root"))
    return near.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))


def _small_star(edges):
    """The node and its smaller neighbours are linked to the smallest neighbour."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    least = down.groupBy("a").agg(F.min("b").alias("root"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return moved.unionByName(least.select("a", F.col("root").alias("b"))).where("a != b")


def _state(edges):
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges):
    """(node, root): the smallest node reachable, for every node of ``edges`` (a, b: long).

    Alternates large and small stars until the edges no longer change.  Each round is two
    groupings and two joins over the edges and ends in a reliable checkpoint; long chains shorten
    by a constant factor a round.  Loops and repeated edges are allowed, and nulls are ignored.
    """
    edges = edges.where("a is not null and b is not null and a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut(edges)
    before = _state(edges)
    for _ in range(MOST_ROUNDS):
        if not before[0]:
            break
        edges = cut(_small_star(_large_star(edges).distinct()).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
