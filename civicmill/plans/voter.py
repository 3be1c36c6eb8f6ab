"""Voter roll: raw lines to Voter.Raw, Voter.Counts and Voter.Formatted."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from civicmill import schemas
from civicmill.functions import people
from civicmill.functions.casts import conform
from civicmill.operators.history import count_history
from civicmill.operators.lookup import left_lookup
from civicmill.operators.rollup import conditional_counts
from civicmill.plans.warehouse import overwrite_table
from civicmill.sources.csv_sets import read_encoded_lines
from civicmill.sources.lines import parse_delimited, read_lines, rejected_lines

# Counties that count by assembly district; the others count by ward (fixed values).
ASSEMBLY_COUNTIES = [3, 24, 30, 31, 41, 43]

# Columns kept under a new name (fixed values).
KEPT = {
    "GENDER": "Gender",
    "ENROLLMENT": "Enrollment",
    "OTHERPARTY": "OtherPartyEnrollment",
    "ED": "ElectionDistrict",
    "LD": "LegislativeDistrict",
    "TOWNCITY": "TownCityCode",
    "WARD": "Ward",
    "CD": "CongressionalDistrict",
    "SD": "SenateDistrict",
    "AD": "AssemblyDistrict",
    "PREVNAME": "PreviousName",
    "COUNTYVRNUMBER": "CountyVoterNumber",
    "VRSOURCE": "VoterRegistrationSource",
    "IDREQUIRED": "IDRequired",
    "IDMET": "IDMet",
    "SBOEID": "SBOEID",
}


def parse_voters(lines, tally=None):
    return parse_delimited(lines, schemas.VOTER_RAW, tally=tally)


def with_county(voters, counties):
    return left_lookup(voters, counties, {"COUNTYCODE": "Code"}, {"County": "Name"})


def count_voters(voters, counties):
    """Voters of every status per county, district, and party.

    The county name depends on the county code alone, so it is looked up on the few counted
    rows and not on the voters.
    """
    counted = conditional_counts(
        voters, "COUNTYCODE", ASSEMBLY_COUNTIES, ["AD"], ["WARD"], ["COUNTYCODE", "ED", "ENROLLMENT"]
    )
    return conform(with_county(counted, counties), schemas.VOTER_COUNTS)


def format_voters(voters, elections, counties, as_of):
    """Active voters with readable names, addresses, dates and participation counters."""
    c = F.col
    active = voters.where(c("STATUS") == "ACTIVE")
    counted = with_county(count_history(active, elections, as_of), counties)
    birth = people.compact_date(c("DOB"))
    street = [c(n) for n in ("RADDNUMBER", "RHALFCODE", "RPREDIRECTION", "RSTREETNAME", "RPOSTDIRECTION")]
    made = {
        "FullName": people.full_name(c("FIRSTNAME"), c("MIDDLENAME"), c("LASTNAME"), c("NAMESUFFIX")),
        "DateOfBirth": birth,
        "LastVotedDate": people.compact_date(c("LASTVOTEDDATE")),
        "Age": people.age(birth, as_of),
        "Address": people.residence_address(*street, c("RAPARTMENT"), c("RCITY"), c("RZIP5")),
        "StreetAddress": people.street_address(*street, c("RCITY"), c("RZIP5")),
    }
    formatted = counted.select(
        *[c(old).alias(new) for old, new in KEPT.items()],
        *[col.alias(name) for name, col in made.items()],
        "County", "Prime", "FiveYearElections", "FiveYearPrimaries",
    )
    # Already typed: only the declared order and widths are left to set.
    return formatted.select(*[c(f.name).cast(f.dataType) for f in schemas.VOTER_FORMATTED.fields])


def write_raw(lines, raw, rejected):
    """Lines to the raw table, and those that cannot be parsed to (line, reason); returns the raw table.

    Lines are counted in the pass that parses them, and only if some are rejected are they looked for
    once more.  The job stops if the two tables do not hold all lines.
    """
    spark, tally = lines.sparkSession, Observation()
    written = overwrite_table(parse_voters(lines, tally), raw, cluster_by="COUNTYCODE")
    none = spark.createDataFrame([], schemas.REJECTED)
    found = rejected_lines(lines).withColumnRenamed("value", "line") if tally.get["rejected"] else none
    refused = overwrite_table(found, rejected)
    held = written.count() + refused.count()
    # a task that ran twice may have counted twice, so another number is looked at again
    if held != tally.get["lines"] and held != lines.where("value is not null").count():
        raise RuntimeError(f"{raw} and {rejected} hold {held} lines, which are not all")
    return written


def load_voters(spark, path, as_of, raw="Voter.Raw", counts="Voter.Counts", formatted="Voter.Formatted",
                rejected="Voter.Rejected", encoding="UTF-8"):
    """The whole job, from a file in any encoding Java knows.  Lines are parsed once; the other tables read the written one."""
    lines = read_lines(spark, path) if encoding.upper() in ("UTF-8", "UTF8") else read_encoded_lines(spark, path, encoding)
    written = write_raw(lines, raw, rejected)
    counties = spark.table("Voter.CountyCodes")
    overwrite_table(count_voters(written, counties), counts)
    overwrite_table(format_voters(written, spark.table("Voter.ElectionCodes"), counties, as_of), formatted)
