"""Sets of CSV files: one schema, another encoding, or headers that differ per file."""

import csv
import re
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicmill.functions.casts import conform
from civicmill.operators.sizes import small_side
from civicmill.session import cut


def _header_reader(spark, multiline):
    return spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)


def read_csv_set(spark, path, schema, multiline=False):
    """Many header CSVs of one declared schema, read as one table of tolerant text casts.

    ``multiline`` allows line ends inside quotes; a file is then read by one task.
    """
    names = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    return conform(_header_reader(spark, multiline).schema(names).csv(path), schema)


def read_lookup(spark, path, schema, header=False, encoding="UTF-8"):
    """A small lookup CSV with a declared schema."""
    return (
        spark.read.option("header", header)
        .option("encoding", encoding)
        .option("escape", '"')
        .schema(schema)
        .csv(path)
    )


def read_encoded_lines(spark, path, encoding="ISO-8859-1"):
    """Every line of a file that is not UTF-8, decoded; blank lines stay."""
    return spark.read.text(path).select(F.decode(F.col("value").cast("binary"), encoding).alias("value"))


def decoded(file):
    """A path as Spark's file metadata has it, without percent encoding."""
    return F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))


def select_files(files, folder, excluded=(), path="path"):
    """Keep CSV files; ``excluded`` names files or folders by their exact path below ``folder``."""
    keep = F.contains(F.col(path), F.lit(".csv"))
    root = re.sub(r"^[\w+.-]+:(//[^/]*)?", "", folder).rstrip("/")
    for name in excluded:
        whole = F.lit(f"{root}/{name}")
        keep = keep & ~(F.endswith(F.col(path), whole) | F.contains(F.col(path), F.concat(whole, F.lit("/"))))
    return files.where(keep)


def _first_lines(spark, folder, excluded=()):
    """(file, path, header): the first line with text of every CSV file under a folder.

    One task reads the first split of a file in order, so the line of the smallest row id is the
    header; each task sends one row per file that it began.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(folder).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
        F.monotonically_increasing_id().alias("row"),
    )
    begun = lines.where((F.col("start") == 0) & (F.trim("value") != ""))
    first = begun.groupBy("file").agg(F.min_by("value", "row").alias("value"))
    header = F.regexp_replace("value", r"^\x{FEFF}|\r$", "")
    named = first.select("file", decoded(F.col("file")).alias("path"), header.alias("header"))
    return select_files(named, folder, excluded)


def header_columns(header):
    """Column names of a header line."""
    return [name.strip() for name in next(csv.reader([header]), [])]


def distinct_names(names):
    """Of a repeated column name the last one keeps it."""
    return [f"_{i}_{name}" if name in ("", *names[i + 1 :]) else name for i, name in enumerate(names)]


def rename_aliases(columns, aliases):
    """Header names after alias repair.

    ``aliases`` maps a declared name to the spellings that override it.  A spelling present
    in the header always wins, the last one over the others, even where its cells are null.
    Returns (name to read, name to use) pairs.
    """
    chosen = {name: name for name in columns}
    for target, spellings in aliases.items():
        for spelling in spellings:
            if spelling in columns:
                chosen[target] = spelling
    return [(source, target) for target, source in chosen.items()]


def read_header_groups(spark, path, schema, aliases=None, excluded=(), filename="filename", multiline=False):
    """Union by column name of all CSV files under a folder, as text columns of ``schema``.

    Only the distinct headers come to the driver.  One scan reads the cells of all files by their
    place in the line; the header of a row's file, looked up by its path, says which place holds
    which column.  Columns that no header names are left out.
    """
    files = cut(_first_lines(spark, path, excluded))
    headers = sorted(row["header"] for row in files.select("header").distinct().collect())
    if not headers:
        fields = [T.StructField(f.name, T.StringType()) for f in schema.fields]
        return spark.createDataFrame([], T.StructType(fields))
    forms_of, width = {}, 0  # {column: {place: forms}}
    for form, header in enumerate(headers, 1):
        unique = distinct_names(header_columns(header))
        width = max(width, len(unique))
        for source, target in rename_aliases(unique, aliases or {}):
            forms_of.setdefault(target, {}).setdefault(unique.index(source), []).append(form)
    cells = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    rows = _header_reader(spark, multiline).option("recursiveFileLookup", True).schema(cells).csv(path)
    rows = rows.select("*", F.col("_metadata.file_path").alias("file"))
    form = F.array_position(F.array(*[F.lit(h) for h in headers]), F.col("header"))
    known = files.select("file", "path", form.alias("form"))
    found = [
        F.coalesce(*[F.when(F.col("form").isin(forms), F.col(f"c{place}")) for place, forms in forms_of[name].items()]).alias(name)
        for name in schema.names if name in forms_of
    ]
    return rows.join(small_side(known), "file").select(*found, F.col("path").alias(filename))
