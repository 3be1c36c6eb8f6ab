"""Election results: CSV files with differing headers to Results.OpenElections."""

from pyspark.sql import functions as F

from civicmill import schemas
from civicmill.functions.casts import conform
from civicmill.plans.warehouse import overwrite_table
from civicmill.sources.csv_sets import read_header_groups

# Misspelled or older headers and the column they override (fixed values).
ALIASES = {
    "absentee_military_votes": ["absentee", "absentee_hc"],
    "affidavit_votes": ["affidavit"],
    "district": ["disctrict"],
}

EXCLUDED = ["county_matrix.csv"]

# Folder year, then date, state and scope, as in 2000/20001107__ny__general.csv (fixed values).
FILE_NAME = r"^.*/\d{4}/(\d{8})__(\w{2})__(.*)\.csv"


def filename_fields(filename):
    """(date, state, scope) told by a file name; all null where it has another form."""
    found = lambda i: F.nullif(F.regexp_extract(filename, FILE_NAME, i), F.lit(""))
    fits = F.regexp_like(filename, F.lit(FILE_NAME))
    return (
        F.try_to_date(found(1), "yyyyMMdd"),
        F.upper(found(2)),
        F.when(fits, F.regexp_extract(filename, FILE_NAME, 3)),
    )


def format_results(rows, loaded_at):
    """Declared columns of the united files, with the columns told by the file name."""
    day, state, scope = filename_fields(F.col("filename"))
    named = rows.drop("election_date", "state", "scope").withColumns(
        {"election_date": day, "state": state, "scope": scope, "update_timestamp": F.lit(loaded_at)}
    )
    return conform(named, schemas.RESULTS)


def load_results(spark, path, loaded_at, excluded=EXCLUDED):
    """The whole job; ``loaded_at`` is the one load time of the run."""
    rows = read_header_groups(spark, path, schemas.RESULTS, ALIASES, excluded)
    overwrite_table(format_results(rows, loaded_at), "Results.OpenElections")
