"""Sinks of the warehouse and the example queries its users run."""

import uuid
from datetime import date

from pyspark.sql import functions as F

from civicmill.functions.casts import conform
from civicmill.operators.rollup import joined_values, total_by


def _prepared(spark, name):
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")


def _versions_folder(spark, name):
    """Where the versions of a table lie, beside the folders of its database."""
    database, _, table = name.rpartition(".")
    return f"{spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri}/{table.lower()}.versions"


def _location(spark, name):
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    return told["data_type"] if told else None


def _point_to(spark, name, schema, folder):
    """Let the table be the files in ``folder``; one catalog change where its columns stay the same."""
    plain = lambda fields: [(f.name, f.dataType) for f in fields]
    if spark.catalog.tableExists(name):
        described = spark.table(name)
        listed = spark.catalog.listColumns(name)
        if plain(described.schema) == plain(schema) and not any(c.isPartition for c in listed):
            quoted = folder.replace("'", "\\'")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{quoted}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, folder, "parquet", schema)


def _remove_older(spark, base, kept):
    """Remove finished versions but those in ``kept``; one still being written has no mark of success."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(base)
    files = root.getFileSystem(conf)
    names = {k.rstrip("/").rsplit("/", 1)[-1] for k in kept if k}
    for entry in files.listStatus(root):
        folder = entry.getPath()
        done = files.exists(jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS"))
        if folder.getName().startswith("version-") and folder.getName() not in names and done:
            files.delete(folder, True)


def overwrite_table(df, name, schema=None, cluster_by=None, path=None):
    """Replace a table, or create it.  With ``schema`` the rows are first made to conform.

    The rows are written as a new version in a folder of its own, and then the table's location
    is changed, so a run that fails leaves the table as it was, and ``df`` may read the
    table it replaces.  The version before stays for queries that are still reading it; older ones are
    removed.  A table whose columns change is dropped and created again.
    ``cluster_by`` sorts the files by a column, so that filters on it skip most of them; a value that holds
    much of the data is written by several tasks.  The table keeps the order of the columns.
    ``path`` keeps the versions outside the warehouse folder.
    """
    spark = df.sparkSession
    _prepared(spark, name)
    out = conform(df, schema) if schema is not None else df
    if cluster_by:
        out = out.hint("rebalance", cluster_by).sortWithinPartitions(cluster_by)
    base = path or _versions_folder(spark, name)
    folder = f"{base.rstrip('/')}/version-{uuid.uuid4().hex}"
    out.write.parquet(folder)
    before = _location(spark, name) if spark.catalog.tableExists(name) else None
    _point_to(spark, name, out.schema, folder)
    _remove_older(spark, base, (folder, before))
    return spark.table(name)


def append_table(df, name, schema=None, path=None):
    """Add rows to a table, or create it; running twice adds the rows twice."""
    _prepared(df.sparkSession, name)
    out = conform(df, schema) if schema is not None else df
    writer = out.write.mode("append").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


# The documented user queries in Spark SQL (fixed values: tables, columns and conditions); what a user
# asks for is a named parameter.
EXAMPLES = {
    "first_voters": """
        SELECT FullName, Gender, DateOfBirth FROM {Formatted} LIMIT 10""",
    "voter_by_name": """
        SELECT FullName, Gender, Enrollment, DateOfBirth, FiveYearElections, FiveYearPrimaries
        FROM {Formatted}
        WHERE FullName = :name AND County = :county""",
    "enrollment_of_district": """
        SELECT Enrollment, COUNT(*) AS Num
        FROM {Formatted}
        WHERE SenateDistrict = :district
        GROUP BY Enrollment""",
    "overlapping_districts": """
        SELECT SD, COUNT(*) AS Num
        FROM {Raw}
        WHERE AD = :district AND STATUS = 'ACTIVE'
        GROUP BY 1""",
    "turnout_of_election_type": """
        WITH cast_by AS (
            SELECT ENROLLMENT, explode(split(VoterHistory, ';')) AS code
            FROM {Raw}
            WHERE TOWNCITY = :town AND ED = :district),
        ballots AS (SELECT ENROLLMENT, code, COUNT(*) AS n FROM cast_by GROUP BY ENROLLMENT, code),
        elections AS (SELECT Election AS code, Date, Type FROM {ElectionCodes} WHERE Type = :type AND Date > :since)
        SELECT ENROLLMENT, Date, Type, SUM(n) AS Num
        FROM ballots JOIN elections USING (code)
        GROUP BY ALL
        ORDER BY ENROLLMENT, Date, Type""",
    "census_of_district": """
        SELECT CountyName, CousubName, TotalOver18, HispanicOver18, WhiteNonHispanicOver18,
               BlackNonHispanicOver18, TotalHousingUnits, OccupiedHousingUnits,
               VacantHousingUnits, e.AD, e.ED
        FROM {VTDFormatted} LATERAL VIEW inline(ElectionDistricts) e AS WARD, AD, ED
        WHERE e.AD = :district""",
    "voters_of_district": """
        SELECT * FROM {Raw} WHERE SD = :district AND STATUS = 'ACTIVE'""",
    "funds_raised": """
        SELECT FilingYear, FilerID, FilerName, concat('$', format_number(SUM(Amt), 0)) AS Raised
        FROM {State}
        WHERE FilingYear > :year AND Office = :office AND Dist = :district
        GROUP BY 1, 2, 3
        ORDER BY 1, 2, 3""",
}


# What the documentation asks for where the caller names nothing else (fixed values).
USUAL = {"turnout_of_election_type": {"since": date(2016, 1, 1)}}
NO_CANDIDATES = ["Blank", "Scattering", "Void", "Total"]
DONATION = ["FilingYear", "ContributorName", "ContributorAddr1", "ContributorAddr2", "FilerID", "FilerName", "FilerCommittee", "Office"]


def results_of_county(curated, county, day, districts=(1, 2, 3), left_out=NO_CANDIDATES):
    """Votes and party lines of the candidates of a county on a day."""
    wanted = (F.col("county") == county) & (F.col("election_date") == day) & F.col("district").isin(*districts)
    rows = curated.where(wanted & ~F.col("candidate").isin(*left_out))
    keys = ["office", "district", "candidate"]
    return joined_values(rows, keys, "party", "Parties", Votes="votes").orderBy(*keys)


def donor_totals(contributions):
    """What each donor gave to each filer in a year, as total."""
    return total_by(contributions, DONATION, "Amt", "TotalDonation")


# Examples that are operators of the library, with the table each runs on.
OPERATORS = {
    "results_of_county": ("Curated", results_of_county),
    "donor_totals": ("State", lambda state: donor_totals(state).orderBy(*DONATION)),
}

# Where the names in braces are found.
TABLES = {
    "Formatted": "Voter.Formatted",
    "Raw": "Voter.Raw",
    "ElectionCodes": "Voter.ElectionCodes",
    "VTDFormatted": "Census.VTDFormatted",
    "Curated": "Results.Curated",
    "State": "Finance.State",
}


def run_example(spark, example, tables=None, /, **params):
    """Run an example on the warehouse, or on DataFrames given under the table names."""
    tables = tables or {}
    found = lambda name: tables[name] if name in tables else spark.table(TABLES[name])
    if example in OPERATORS:
        name, operator = OPERATORS[example]
        return operator(found(name), **params)
    text, values = EXAMPLES[example], {**USUAL.get(example, {}), **params}
    return spark.sql(text, args=values or None, **{name: found(name) for name in TABLES if "{%s}" % name in text})
