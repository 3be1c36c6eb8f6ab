"""Compare registered queries with their SQL in DuckDB.

    python -m tests.oracle [sf_dir] [query ...]
"""

import math
import sys
import time
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql):
    """(equal, message) of a DataFrame and a SQL text."""
    ours = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} / {sorted(names)}"
    if ours != theirs:
        only, missing = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
        return False, f"{sum(ours.values())} / {sum(theirs.values())} rows\n   spark {only}\n   sql   {missing}"
    return True, f"{sum(ours.values())} rows"


def main(argv):
    import __spark_entry__ as entry
    from tests.conftest import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = local_session(), duck(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if argv[1:] and name not in argv[1:]:
            continue
        started = time.time()
        try:
            ok, message = compare(run(spark, sf_dir), con, oracles[name]) if name in oracles else (True, f"{run(spark, sf_dir).count()} rows, no SQL")
        except Exception as error:
            ok, message = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name:28s} {time.time() - started:6.2f}s {message}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main(sys.argv[1:])
