"""Tables of the warehouse as sources."""


def read_table(spark, name):
    return spark.table(name)


def read_query(spark, sql, **params):
    """The result of a SQL text; filters in it reach the scan because it stays in the plan."""
    return spark.sql(sql, args=params or None)


def seed_rows(spark, rows, schema):
    """A short literal list as a table."""
    return spark.createDataFrame(rows, schema)
