"""Civic data warehouse jobs on Spark: landed files in, typed tables and SQL out."""
