"""Lookup joins: at most one value per key, rows are never multiplied or lost.

How a side is joined is left to Spark: it broadcasts one whose files are below
``spark.sql.autoBroadcastJoinThreshold``, and one that turns out to be small while it runs below
``spark.sql.adaptive.autoBroadcastJoinThreshold``.  Nothing runs while a lookup is planned.
"""

from pyspark.sql import functions as F


def single_valued(lookup, keys, values):
    """One row per key; of duplicates the greatest value row survives, so runs agree."""
    best = F.max(F.struct(*[F.col(f"`{v}`") for v in values])).alias("best")
    return lookup.groupBy(*keys).agg(best).select(*keys, "best.*")


def left_lookup(df, lookup, on, take, fixed=False):
    """Add lookup values to every row; null where the key is missing.

    ``on`` maps columns of ``df`` to key columns of ``lookup``, ``take`` maps new column
    names to lookup columns.  ``fixed`` marks literal tables, which are always broadcast.
    """
    keys = [F.col(f"`{k}`").alias(f"__key{i}") for i, k in enumerate(on.values())]
    values = [F.col(f"`{v}`").alias(f"__value{i}") for i, v in enumerate(take.values())]
    side = lookup.select(*keys, *values)
    side = single_valued(side, [f"__key{i}" for i in range(len(on))], [f"__value{i}" for i in range(len(take))])
    condition = F.lit(True)
    for i, name in enumerate(on):
        condition = condition & (df[name] == side[f"__key{i}"])
    joined = df.join(F.broadcast(side) if fixed else side, condition, "left")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in take]
    return joined.select(*kept, *[F.col(f"__value{i}").alias(name) for i, name in enumerate(take)])


def attach_overriding(df, owner, key):
    """Inner join that gives each row its owner's columns; on a name clash the owner's value
    wins, even when it is null."""
    own = [c for c in owner.columns if c != key]
    return df.drop(*own).join(owner, key)


def expand_with(df, extra, key, replace):
    """Keep every row and add, per match in ``extra``, a copy with some columns replaced.

    ``replace`` maps columns of ``df`` to columns of ``extra``; the other columns are
    inherited.
    """
    new = {f"__{target}": source for target, source in replace.items()}
    side = extra.select(F.col(f"`{key}`").alias("__owner"), *[F.col(s).alias(n) for n, s in new.items()])
    # each row once as it is and once to be matched, so ``df`` is read once
    twice = df.withColumn("__copy", F.explode(F.array(F.lit(False), F.lit(True))))
    matched = twice.join(side, (F.col(f"`{key}`") == F.col("__owner")) & F.col("__copy"), "left")
    kept = matched.where(~F.col("__copy") | F.col("__owner").isNotNull())
    return kept.select(
        *[F.when(F.col("__copy"), F.col(f"__{c}")).otherwise(F.col(f"`{c}`")).alias(c) if c in replace else F.col(f"`{c}`") for c in df.columns]
    )
