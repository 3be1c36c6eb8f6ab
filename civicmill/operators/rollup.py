"""Grouped counts and sums; all of them combine before their one shuffle."""

from pyspark.sql import functions as F


def conditional_counts(df, code, listed, when_listed, otherwise, others, count="Count"):
    """Count rows by keys that depend on a code.

    Where ``code`` is listed the key columns ``when_listed`` count and ``otherwise`` are
    null; elsewhere the reverse.  ``others`` always belong to the key.  Null keys form groups.
    """
    inside = F.coalesce(F.col(code).isin(listed), F.lit(False))
    keyed = df.select(
        *[F.when(inside, F.col(c)).alias(c) for c in when_listed],
        *[F.when(~inside, F.col(c)).alias(c) for c in otherwise],
        *others,
    )
    keys = [*when_listed, *otherwise, *others]
    return keyed.groupBy(*keys).agg(F.count("*").alias(count))


def total_by(df, keys, value, total):
    return df.groupBy(*keys).agg(F.sum(value).alias(total))


# No string of Spark holds more bytes than an array of the JVM (fixed value).
LONGEST = 2**31 - 16


def joined_values(df, keys, value, into, separator=", ", **totals):
    """Values of a group as one sorted string with copies kept and nulls left out, plus sums.

    Copies are counted before the shuffle, so a group travels as its distinct values.
    ``totals`` maps new columns to the columns they sum.
    """
    sums = [F.sum(source).alias(name) for name, source in totals.items()]
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("__n"), *sums)
    return joined_counts(counted, keys, value, "__n", into, separator, **{name: name for name in totals})


def joined_counts(counted, keys, value, copies, into, separator=", ", **totals):
    """``joined_values`` of rows that stand for ``copies`` of themselves; their ``totals`` are summed as they are.

    The string is made when its length is known.  One that no row can hold fails the job and says so; a
    group has no string then, but its counted values are there to be used as they are.
    """
    present = F.col(value).isNotNull()
    # The last separator is cut off again, so it counts here.
    size = F.sum(F.when(present, F.col(copies) * (F.octet_length(value) + len(separator.encode()))))
    grouped = counted.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(present, F.struct(F.col(value).alias("v"), F.col(copies).alias("n"))))).alias("__runs"),
        size.alias("__size"), *[F.sum(source).alias(name) for name, source in totals.items()],
    )
    runs = F.transform("__runs", lambda run: F.call_function("repeat", F.concat(run["v"], F.lit(separator)), run["n"].cast("int")))
    whole = F.array_join(runs, "")
    text = F.substring(whole, F.lit(1), F.greatest(F.length(whole) - len(separator), F.lit(0)))
    refused = F.raise_error(F.concat(
        F.lit("joined values of a group take "), F.col("__size").cast("string"), F.lit(f" bytes, a string holds {LONGEST}: use the counted values")))
    checked = F.when(F.col("__size") > LONGEST, refused.cast("string")).otherwise(text)
    return grouped.select(*keys, checked.alias(into), *totals)
