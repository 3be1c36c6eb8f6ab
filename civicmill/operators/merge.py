"""Merge of several files on a record key, and one-to-many nesting."""

from functools import reduce

from pyspark.sql import functions as F


def merge_records(sides, key):
    """One row per key with the attributes of all sides; of a shared attribute the last side
    that has the key wins, even with a null.

    Sides are stacked and grouped once, so each input is shuffled once, repeated keys combine
    before the shuffle, unmatched rows stay, and null keys form one group.  If a side repeats
    a key, its greatest row counts.
    """
    attributes = [[c for c in side.columns if c != key] for side in sides]
    types = [side.select(*names).schema for side, names in zip(sides, attributes)]
    stacked = []
    for i, (side, names) in enumerate(zip(sides, attributes)):
        packed = F.struct(*[F.col(f"`{c}`") for c in names])
        entries = [packed if j == i else F.lit(None).cast(types[j]) for j in range(len(sides))]
        stacked.append(side.select(key, *[e.alias(f"side{j}") for j, e in enumerate(entries)]))
    union = reduce(lambda a, b: a.unionByName(b), stacked)
    merged = union.groupBy(key).agg(*[F.max(f"side{i}").alias(f"side{i}") for i in range(len(sides))])
    columns = {}
    for i, names in enumerate(attributes):
        for name in names:
            cell = F.col(f"side{i}.`{name}`")
            earlier = columns.get(name)
            columns[name] = cell if earlier is None else F.when(F.col(f"side{i}").isNotNull(), cell).otherwise(earlier)
    return merged.select(key, *[cell.alias(name) for name, cell in columns.items()])


def attach_many(df, many, on, take):
    """Flat form of the one-to-many lookup: a row per match, or one row of nulls without any."""
    names = {f"__{k}": k for k in on.values()}
    side = many.select(
        *[F.col(source).alias(alias) for alias, source in names.items()],
        *[F.col(source).alias(target) for target, source in take.items()],
    )
    condition = reduce(lambda a, b: a & b, [df[left] == side[f"__{right}"] for left, right in on.items()])
    return df.join(side, condition, "left").drop(*names)


def nest_many(df, many, on, take, into):
    """Nested form: the matches of a row as an array of structs, one all-null struct without any.

    A row of ``df`` stays one row, whatever the number of its matches, so sums over the result do
    not depend on it.  An array holds all matches of its row: use this for relations whose groups
    are bounded by their nature, like the districts of a place, and ``attach_many`` for others.
    Null keys match nothing and are dropped before the grouping.
    """
    keys = list(on.values())
    item = F.struct(*[F.col(source).alias(target) for target, source in take.items()])
    side = many.select(*[F.col(k).alias(f"__{k}") for k in keys], item.alias("item")).dropna(subset=[f"__{k}" for k in keys])
    arrays = side.groupBy(*[f"__{k}" for k in keys]).agg(F.sort_array(F.collect_list("item")).alias(into))
    condition = reduce(lambda a, b: a & b, [df[left] == arrays[f"__{right}"] for left, right in on.items()])
    joined = df.join(arrays, condition, "left").drop(*[f"__{k}" for k in keys])
    empty = F.array(F.struct(*[F.lit(None).cast(side.schema["item"].dataType[t].dataType).alias(t) for t in take]))
    return joined.withColumn(into, F.coalesce(F.col(into), empty))
