"""Lookup tables from CSV files and the JSON files that describe them."""

from civicmill.plans.warehouse import overwrite_table
from civicmill.sources.described import read_described, read_schema

# Tables and the stems of their files (fixed values).
LOOKUPS = {
    "Voter.CountyCodes": "CountyCodes",
    "Voter.ElectionCodes": "ElectionCodes",
    "Census.SummaryLevels": "SummaryLevels",
}


def load_lookup(spark, data, schema, table, header=False, encoding="UTF-8"):
    """One table from a CSV file and its schema file."""
    return overwrite_table(read_described(spark, data, read_schema(spark, schema), header, encoding), table)


def load_lookups(spark, folder, lookups=LOOKUPS):
    """The whole job: ``<stem>.data.csv`` and ``<stem>.schema.json`` of every table, in one folder."""
    for table, stem in lookups.items():
        load_lookup(spark, f"{folder}/{stem}.data.csv", f"{folder}/{stem}.schema.json", table)
