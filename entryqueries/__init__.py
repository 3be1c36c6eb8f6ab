"""Every operator bound to the given tables, each with the SQL it must agree with."""

from entryqueries import finance, ingest, people, records, text, usersql

MODULES = (ingest, people, records, finance, text, usersql)


def all_queries():
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def all_oracles():
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
