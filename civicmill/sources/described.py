"""CSV files described by a JSON schema file."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicmill.functions.casts import conform

# Type names of schema files (fixed values).
KINDS = {
    "string": T.StringType(), "bytes": T.BinaryType(),
    "integer": T.LongType(), "int64": T.LongType(),
    "float": T.DoubleType(), "float64": T.DoubleType(),
    "numeric": T.DecimalType(38, 9),
    "boolean": T.BooleanType(), "bool": T.BooleanType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "datetime": T.TimestampNTZType(),
}
RECORDS = ("record", "struct")


def struct_of(fields):
    """``StructType`` of a list of (name, type, mode, fields) objects.

    The mode is NULLABLE, REQUIRED or REPEATED; records nest.  An unknown type or mode is an error.
    """
    made = []
    for field in fields:
        kind, mode = field["type"].lower(), field.get("mode", "NULLABLE").upper()
        if kind not in KINDS and kind not in RECORDS:
            raise ValueError(f"{field['name']}: unknown type {field['type']}")
        if mode not in ("NULLABLE", "REQUIRED", "REPEATED"):
            raise ValueError(f"{field['name']}: unknown mode {field['mode']}")
        told = struct_of(field["fields"]) if kind in RECORDS else KINDS[kind]
        made.append(T.StructField(field["name"], T.ArrayType(told) if mode == "REPEATED" else told, mode != "REQUIRED"))
    return T.StructType(made)


def read_schema(spark, path):
    """``StructType`` of a JSON schema file, in any store Spark reads."""
    text = "\n".join(row["value"] for row in spark.read.text(path, wholetext=True).collect())
    return struct_of(json.loads(text))


def read_described(spark, path, schema, header=False, encoding="UTF-8"):
    """A CSV file as a schema file describes it.

    Cells that are not of their type, and fields the line does not have, are null; a null in a required
    field stops the job.  Cells of records and repeated fields are JSON.
    """
    names = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    cells = spark.read.option("header", header).option("encoding", encoding).option("escape", '"').schema(names).csv(path)
    nested = {
        f.name: F.from_json(F.col(f"`{f.name}`"), f.dataType)
        for f in schema.fields if isinstance(f.dataType, (T.StructType, T.ArrayType))
    }
    return conform(cells.withColumns(nested) if nested else cells, schema)
