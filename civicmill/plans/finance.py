"""Campaign finance: landed pages and reference tables to Finance.State."""

from pyspark.sql import functions as F

from civicmill import schemas
from civicmill.functions import people
from civicmill.functions.casts import amount, conform
from civicmill.operators.lookup import attach_overriding, expand_with, left_lookup
from civicmill.plans.warehouse import overwrite_table
from civicmill.sources.html_tables import html_table_rows

# Races that are followed (fixed values); * stands for every Senate district.
RACES = [
    ("Governor", ""),
    ("Lt. Governor", ""),
    ("State Senator", "*"),
    ("Member of Assembly", "9"),
    ("Member of Assembly", "75"),
    ("District Leader", "75"),
    ("District Leader", "67"),
    ("City Council", "3"),
    ("City Council", "6"),
]

# Office codes of the elections board (fixed values); of an office listed twice the last code counts.
OFFICE_CODES = [
    ("Governor", "04"),
    ("Lt. Governor", "05"),
    ("Comptroller", "06"),
    ("Attorney General", "07"),
    ("U.S. Senator", "08"),
    ("Sup. Court Justice", "09"),
    ("State Senator", "11"),
    ("Member of Assembly", "12"),
    ("State Committee", "13"),
    ("Judicial Delegate", "16"),
    ("Alt Judicial Del.", "17"),
    ("Chairperson", "18"),
    ("City Manager", "19"),
    ("Council President", "20"),
    ("County Executive", "21"),
    ("Mayor", "22"),
    ("President", "23"),
    ("Supervisor", "24"),
    ("Sheriff", "25"),
    ("District Attorney", "26"),
    ("County Legislator", "27"),
    ("County Court Judge", "28"),
    ("Surrogate Court Judge", "29"),
    ("Family Court Judge", "30"),
    ("Party Committee Member", "31"),
    ("City Council", "32"),
    ("Village Trustee", "33"),
    ("Village Justice", "34"),
    ("Clerk", "35"),
    ("Town Justice", "36"),
    ("Town Council", "37"),
    ("Receiver of Taxes", "38"),
    ("Highway Superintendent", "39"),
    ("Alderperson", "40"),
    ("Treasurer", "41"),
    ("Assessor", "42"),
    ("Borough President", "43"),
    ("District Leader", "44"),
    ("Comptroller", "45"),
    ("Coroner", "46"),
    ("County Representative", "47"),
    ("Public Advocate", "49"),
    ("Councilman", "50"),
    ("Trustee", "51"),
    ("Town Board", "52"),
    ("Legislator", "53"),
    ("Legislative District", "54"),
    ("City Chamberlain", "55"),
    ("City Council President", "56"),
    ("City Court Judge", "57"),
    ("Pres. Common Council", "58"),
    ("Clerk/Collector", "59"),
    ("Civil Court Judge", "60"),
    ("Trustee of School Funds", "61"),
    ("County Committee", "62"),
    ("Commissioner of Education", "63"),
    ("Commissioner of Public Works", "64"),
    ("Common Council", "65"),
    ("District Court Judge", "66"),
    ("Commissioner of Finance", "67"),
    ("Citizen's Review Board Member", "68"),
    ("Town Clerk/Tax Collector", "69"),
    ("Town Tax Collector", "70"),
    ("Controller", "71"),
    ("City School Board", "72"),
    ("Collector", "73"),
    ("Commissioner of Schools", "74"),
    ("County Clerk", "75"),
    ("Town Clerk", "76"),
    ("Village Clerk", "77"),
    ("County Treasurer", "78"),
    ("Town Treasurer", "79"),
    ("Village Treasurer", "80"),
    ("City Treasurer", "81"),
    ("Town Supervisor", "82"),
]

SENATE_DISTRICTS = 63
FIRST_YEAR, LAST_YEAR = 2012, 2018
TOTAL_ROW = "Total Contributions Received"

# What the board's filer pages say (fixed values).
STATUS_PATTERN = r"Status = (\w+)"
COMMITTEE_ID_PATTERN = r'getfiler2_loaddates\?filerid_in=(.*)"'
COMMITTEE_NAME_PATTERN = r"Authorized Committee = (.*)\n"


def office_codes(spark):
    return spark.createDataFrame(list(dict(OFFICE_CODES).items()), "Office string, Code string")


def expand_races(races, office="office", district="district"):
    """One row per district searched, with the board's office code and county filter."""
    every = F.transform(F.sequence(F.lit(1), F.lit(SENATE_DISTRICTS)), lambda i: i.cast("string"))
    wild = (F.col(district) == "*") & (F.col(office) == "State Senator")
    wanted = F.when(wild, every).otherwise(F.array(district))
    kept = [c for c in races.columns if c != district]
    expanded = races.select(*kept, F.explode(wanted).alias(district))
    expanded = left_lookup(expanded, office_codes(races.sparkSession), {office: "Office"}, {"office_code": "Code"}, fixed=True)
    return expanded.withColumn("county", F.when(F.col(office) == "City Council", "31").otherwise("ALL"))


def captured(text, pattern):
    """First group of the first match, null without one."""
    return F.when(F.regexp_like(text, F.lit(pattern)), F.regexp_extract(text, pattern, 1))


def filer_rows(pages):
    """Filers listed on landed search pages: Filer ID from the button, the rest as cells."""
    return html_table_rows(pages, button="FilerID")


def with_status(filers, status_pages):
    """Add the registration status told by each filer's landed page."""
    told = status_pages.select("FilerID", captured(F.col("html"), STATUS_PATTERN).alias("Status"))
    return left_lookup(filers, told, {"FilerID": "FilerID"}, {"Active": "Status"})


def committees_of(pages):
    """(FilerID, committee id, committee name) of the pages that name both."""
    found = pages.select(
        "FilerID",
        F.trim(captured(F.col("html"), COMMITTEE_ID_PATTERN)).alias("CommitteeID"),
        F.trim(captured(F.col("html"), COMMITTEE_NAME_PATTERN)).alias("CommitteeName"),
    )
    return found.where(F.col("CommitteeID").isNotNull() & F.col("CommitteeName").isNotNull())


def with_committees(filers, committees):
    """Every filer, and a copy under its authorized committee's id and name."""
    filers = filers if "FilerCommittee" in filers.columns else filers.withColumn("FilerCommittee", F.lit(None).cast("string"))
    return expand_with(filers, committees, "FilerID", {"FilerID": "CommitteeID", "FilerCommittee": "CommitteeName"})


def filing_years(filers):
    """Each filer once per reporting year."""
    return filers.withColumn("year", F.explode(F.sequence(F.lit(FIRST_YEAR), F.lit(LAST_YEAR)).cast("array<bigint>")))


def report_rows(pages):
    """Contribution rows of landed report pages, without the total row."""
    return html_table_rows(pages, separator="\n", total=TOTAL_ROW)


def with_amounts(rows, date="Date", amt="Amt"):
    return rows.withColumns({date: people.report_date(F.col(date)), amt: amount(F.col(amt))})


def with_contributor(rows, block="Contributor"):
    name, addr1, addr2 = people.contributor_parts(F.col(block))
    return rows.withColumns({"ContributorName": name, "ContributorAddr1": addr1, "ContributorAddr2": addr2})


def standardize_addresses(rows, reference, state="NY"):
    """Replace contributor addresses by those of a reference table of known addresses.

    ``reference`` has (address, city, state, std_address, std_city, std_state, std_zip5).
    Rows it does not know keep what they have.
    """
    keyed = rows.withColumns({"__city": people.city_of(F.col("ContributorAddr2")), "__state": F.lit(state)})
    found = left_lookup(
        keyed,
        reference,
        {"ContributorAddr1": "address", "__city": "city", "__state": "state"},
        {"__a": "std_address", "__c": "std_city", "__s": "std_state", "__z": "std_zip5"},
    )
    second = F.concat(F.col("__c"), F.lit(", "), F.col("__s"), F.lit(" "), F.col("__z"))
    known = F.col("__a").isNotNull() & second.isNotNull()
    return found.withColumns(
        {
            "ContributorAddr1": F.coalesce("__a", "ContributorAddr1"),
            "ContributorAddr2": F.when(known, second).otherwise(F.col("ContributorAddr2")),
        }
    ).drop("__city", "__state", "__a", "__c", "__s", "__z")


def contributions(report_pages, filers, reference):
    """Report pages (FilerID, html) and filers to the contribution table.

    Cells of a report row become columns by their heading; the filer's attributes win.
    """
    wanted = [f.name for f in schemas.FINANCE.fields if not f.name.startswith("Contributor")]
    rows = report_rows(report_pages).select(
        "FilerID",
        *[F.col("cells")[n].alias(n) for n in [*wanted, "Contributor"] if n != "FilerID"],
    )
    rows = with_contributor(with_amounts(attach_overriding(rows, filers, "FilerID")))
    return conform(standardize_addresses(rows, reference), schemas.FINANCE)


def load_finance(spark, search_pages, filer_pages, report_pages, reference):
    """The whole job over landed pages: searches, filers (FilerID, html), reports (FilerID, html)."""
    cells = filer_rows(search_pages)
    filers = cells.select(
        F.col("cells")["FilerID"].alias("FilerID"),
        F.col("cells")["FilerName"].alias("FilerName"),
        F.col("cells")["Office"].alias("Office"),
        F.col("cells")["Dist"].alias("Dist"),
    )
    filers = with_committees(with_status(filers, filer_pages), committees_of(filer_pages))
    overwrite_table(contributions(report_pages, filers, reference), "Finance.State")
