"""Tolerant casts: a value that does not parse becomes null, never an error."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = " \t\r\n\f\u000b"

# What a decimal or special float may look like.  Spark alone would also take Java
# spellings such as 5d or 0x1p3.
FLOAT_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:nan|inf|infinity)$"


def strip(col):
    """Remove leading and trailing white space of every kind."""
    return F.btrim(col, F.lit(BLANKS))


def text(col):
    """Null as the empty string."""
    return F.coalesce(col, F.lit(""))


def to_long(col):
    return strip(col).try_cast("bigint")


def to_double(col):
    bare = strip(col)
    return F.when(bare.rlike(FLOAT_PATTERN), bare.try_cast("double"))


def amount(col):
    """Money text such as ``1,250.00``."""
    return to_double(F.replace(col, F.lit(","), F.lit("")))


def _conformed(df, field):
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType)
    col, source = F.col(f"`{field.name}`"), df.schema[field.name].dataType
    if not isinstance(source, T.StringType):
        if isinstance(field.dataType, T.StringType):
            return strip(col.cast("string"))
        return col.cast(field.dataType)
    if isinstance(field.dataType, T.LongType):
        return to_long(col)
    if isinstance(field.dataType, T.DoubleType):
        return to_double(col)
    if isinstance(field.dataType, T.StringType):
        return strip(col)
    return strip(col).try_cast(field.dataType)


def conform(df, schema):
    """Project to a declared schema: cast tolerantly, null for absent columns.

    A null in a required field stops the job, as a table with that schema would.
    """
    columns = []
    for field in schema.fields:
        col = _conformed(df, field)
        if not field.nullable:
            col = F.coalesce(col, F.raise_error(F.lit(f"{field.name} is required")).cast(field.dataType))
        columns.append(col.alias(field.name))
    return df.select(*columns)
