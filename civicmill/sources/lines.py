"""Parsers of text lines: quoted CSV, fixed width, and wide unquoted CSV."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicmill.functions.casts import strip, text, to_long

MAX_FIELDS = 1 << 20  # of a line that the parser takes; those beyond the schema are ignored


def read_lines(spark, path):
    """UTF-8 text, one row per line, in a column ``value``."""
    return spark.read.text(path)


def _comma_count(line):
    unquoted = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit("")))


def unreadable(line):
    """Why a line cannot be parsed, or null."""
    # only a line of that many characters can have that many commas
    crowded = F.when(F.length(line) < MAX_FIELDS, False).otherwise(_comma_count(line) >= MAX_FIELDS)
    return F.when(F.contains(line, F.lit("\0")), "NUL").when(crowded, "too many fields")


def rejected_lines(lines, value="value"):
    """(value, reason) of the lines ``parse_delimited`` leaves out: with its rows, they are all lines."""
    reason = unreadable(F.col(value))
    return lines.where(F.col(value).isNotNull()).select(value, reason.alias("reason")).where("reason is not null")


def parse_delimited(lines, schema, value="value", tally=None):
    """Headerless quoted CSV lines to typed columns.

    Every field is trimmed; integers that do not parse and fields the line does not have
    are null, fields beyond the schema are ignored, fields of any length are kept.  A line that
    holds a NUL or more than ``MAX_FIELDS`` fields is found by ``rejected_lines`` instead.
    ``tally``, an ``Observation``, gets the number of ``lines`` and of those ``rejected`` when the rows are written.
    """
    line = F.col(value)
    fields = ", ".join(f"f{i} string" for i in range(len(schema)))
    judged = lines.where(line.isNotNull()).select(line.alias(value), unreadable(line).alias("reason"))
    if tally is not None:
        judged = judged.observe(tally, F.count("*").alias("lines"), F.count("reason").alias("rejected"))
    parsed = judged.where(F.col("reason").isNull()).select(
        F.from_csv(line, fields, {"escape": '"', "maxColumns": str(MAX_FIELDS), "maxCharsPerColumn": "-1"}).alias("cells"),
        F.when(line == "", 0).otherwise(_comma_count(line) + 1).alias("n"),
    )
    columns = []
    for i, field in enumerate(schema.fields):
        cell = F.col(f"cells.f{i}")
        if isinstance(field.dataType, T.LongType):
            cell = to_long(cell)
        else:
            cell = F.when(F.col("n") > i, strip(text(cell)))
        columns.append(cell.alias(field.name))
    return parsed.select(*columns)


def parse_fixed_width(lines, layout, value="value"):
    """Half-open character slices, trimmed; integers that do not parse are null."""
    columns = []
    for name, start, end, kind in layout:
        cell = strip(F.substring(F.col(value), start + 1, end - start))
        if isinstance(kind, T.LongType):
            cell = to_long(cell)
        columns.append(cell.alias(name))
    return lines.select(*columns)


def parse_ranges(lines, record_cell, ranges, value="value", record="LOGRECNO"):
    """Wide CSV without quoting: the record number and, per range, its cells joined by commas."""
    cells = F.col("cells")
    packed = [
        F.array_join(F.slice(cells, start + 1, end - start), ",").alias(name)
        for name, (start, end) in ranges.items()
    ]
    split = lines.select(F.split(F.col(value), ",", -1).alias("cells"))
    return split.select(to_long(F.get(cells, F.lit(record_cell))).alias(record), *packed)


def packed_cell(packed, index):
    """Cell ``index`` of a packed range as a long; null when it is not there."""
    return to_long(F.get(F.split(packed, ",", -1), F.lit(index)))


def packed_cells(packed):
    """All cells of a packed range as an array of longs."""
    return F.transform(F.split(packed, ",", -1), lambda c: to_long(c))
