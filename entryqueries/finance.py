"""Campaign finance over customers, suppliers and line items."""

from pyspark.sql import functions as F

from civicmill.operators.lookup import attach_overriding
from civicmill.plans import finance as plan
from civicmill.plans.matching import donor_totals
from entryqueries.tables import every, read

c, lit = F.col, F.lit


def contributor_split(spark, sf_dir):
    block = F.concat(
        lit("\n"), c("c_name"),
        F.when(~every("c_custkey", 3), F.concat(lit("\n"), c("c_custkey"), lit(" MAIN ST"))).otherwise(lit("")),
        lit("\nTOWN, NY 1"), c("c_nationkey").cast("string"),
        F.when(every("c_custkey", 4), lit("\nUSA\n")).otherwise(lit("")),
    )
    rows = read(spark, sf_dir, "customer").select("c_custkey", block.alias("Contributor"))
    return plan.with_contributor(rows).select("c_custkey", "ContributorName", "ContributorAddr1", "ContributorAddr2")


CONTRIBUTOR_SPLIT = """
WITH b AS (
  SELECT c_custkey, c_custkey % 3 AS m, c_custkey % 4 AS k, c_name, c_custkey || ' MAIN ST' AS street,
         'TOWN, NY 1' || c_nationkey AS town FROM customer)
SELECT c_custkey,
       CASE WHEN (m = 0) = (k = 0) THEN c_name
            ELSE chr(10) || c_name || CASE WHEN m <> 0 THEN chr(10) || street ELSE '' END || chr(10) || town
                 || CASE WHEN k = 0 THEN chr(10) || 'USA' || chr(10) ELSE '' END END AS "ContributorName",
       CASE WHEN m = 0 AND k = 0 THEN town WHEN m <> 0 AND k <> 0 THEN street END AS "ContributorAddr1",
       CASE WHEN m = 0 AND k = 0 THEN 'USA' WHEN m <> 0 AND k <> 0 THEN town END AS "ContributorAddr2"
FROM b"""


def amount_date_parse(spark, sf_dir):
    day = F.upper(F.date_format("o_orderdate", "dd-MMM-yy"))
    rows = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(every("o_orderkey", 8), lit("31-FEB-98")).otherwise(day).alias("Date"),
        F.when(every("o_orderkey", 9), lit("n/a")).otherwise(F.format_number(c("o_totalprice").cast("decimal(18,2)"), 2)).alias("Amt"),
    )
    return plan.with_amounts(rows)


AMOUNT_DATE_PARSE = """
SELECT o_orderkey, CASE WHEN o_orderkey % 8 <> 0 THEN CAST(o_orderdate AS DATE) END AS "Date",
       CASE WHEN o_orderkey % 9 <> 0 THEN round(o_totalprice, 2) END AS "Amt" FROM orders"""


def district_expand(spark, sf_dir):
    offices = ["State Senator", "City Council", "Comptroller", "Dog Catcher"]
    office = F.element_at(F.array(*[lit(o) for o in offices]), (c("c_custkey") % 4 + 1).cast("int"))
    district = F.when(every("c_custkey", 8) | every("c_custkey", 3), lit("*")).otherwise((c("c_custkey") % 90).cast("string"))
    rows = read(spark, sf_dir, "customer").select("c_custkey", office.alias("office"), district.alias("district"))
    return plan.expand_races(rows)


DISTRICT_EXPAND = """
WITH r AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'State Senator' WHEN 1 THEN 'City Council' WHEN 2 THEN 'Comptroller'
                  ELSE 'Dog Catcher' END AS office,
                  CASE WHEN c_custkey % 8 = 0 OR c_custkey % 3 = 0 THEN '*' ELSE CAST(c_custkey % 90 AS VARCHAR) END AS district FROM customer),
e AS (SELECT c_custkey, office, CAST(g AS VARCHAR) AS district FROM r, generate_series(1, 63) t(g) WHERE office = 'State Senator' AND district = '*'
      UNION ALL SELECT c_custkey, office, district FROM r WHERE NOT (office = 'State Senator' AND district = '*'))
SELECT *, CASE office WHEN 'State Senator' THEN '11' WHEN 'City Council' THEN '32' WHEN 'Comptroller' THEN '45' END AS office_code,
       CASE WHEN office = 'City Council' THEN '31' ELSE 'ALL' END AS county FROM e"""


def filer_years(spark, sf_dir):
    return plan.filing_years(read(spark, sf_dir, "customer").select("c_custkey", "c_name"))


FILER_YEARS = "SELECT c_custkey, c_name, year FROM customer, generate_series(2012, 2018) t(year)"


def _pages(spark, sf_dir):
    """A landed page per customer with its status and, for some, a committee."""
    html = F.concat(
        lit("<html>Filer\nStatus = "), c("c_mktsegment"), lit(" since then\n"),
        F.when(c("c_acctbal") > 0, F.concat(
            lit("Authorized Committee = FRIENDS OF "), c("c_name"), lit(" \n"),
            lit('<a href="getfiler2_loaddates?filerid_in= C'), c("c_custkey"), lit('">open</a>\n'),
        )).otherwise(lit("Authorized Committee = none")),
    )
    return read(spark, sf_dir, "customer").select(c("c_custkey").cast("string").alias("FilerID"), html.alias("html"))


def committee_expand(spark, sf_dir):
    filers = read(spark, sf_dir, "customer").select(
        c("c_custkey").cast("string").alias("FilerID"), c("c_name").alias("FilerName"), c("c_nationkey").alias("Dist")
    )
    return plan.with_committees(filers, plan.committees_of(_pages(spark, sf_dir)))


COMMITTEE_EXPAND = """
SELECT CAST(c_custkey AS VARCHAR) AS "FilerID", c_name AS "FilerName", c_nationkey AS "Dist", CAST(NULL AS VARCHAR) AS "FilerCommittee" FROM customer
UNION ALL
SELECT 'C' || c_custkey, c_name, c_nationkey, 'FRIENDS OF ' || c_name FROM customer WHERE c_acctbal > 0"""


def filer_status(spark, sf_dir):
    filers = read(spark, sf_dir, "orders").select("o_orderkey", c("o_custkey").cast("string").alias("FilerID"))
    return plan.with_status(filers, _pages(spark, sf_dir))


FILER_STATUS = """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS "FilerID", c_mktsegment AS "Active"
FROM orders LEFT JOIN customer ON c_custkey = o_custkey"""


def filer_contributions(spark, sf_dir):
    filers = read(spark, sf_dir, "supplier").select(
        c("s_suppkey").alias("FilerID"), c("s_name").alias("FilerName"),
        F.when(~every("s_suppkey", 3), c("s_nationkey")).alias("Dist"),
    )
    rows = read(spark, sf_dir, "lineitem").select(
        c("l_suppkey").alias("FilerID"), lit("as typed").alias("FilerName"), c("l_linenumber").alias("Dist"),
        c("l_orderkey").alias("order"), c("l_linenumber").alias("line"), F.round("l_extendedprice", 2).alias("Amt"),
    )
    return attach_overriding(rows, filers, "FilerID")


FILER_CONTRIBUTIONS = """
SELECT l_suppkey AS "FilerID", l_orderkey AS "order", l_linenumber AS line, round(l_extendedprice, 2) AS "Amt",
       s_name AS "FilerName", CASE WHEN s_suppkey % 3 <> 0 THEN s_nationkey END AS "Dist"
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey"""


def address_enrich(spark, sf_dir):
    """Customers' addresses against a reference of the parts' addresses."""
    city = F.concat(lit("TOWN"), c("c_nationkey"))
    rows = read(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(~every("c_custkey", 12), F.concat(c("c_custkey"), lit(" main st"))).alias("ContributorAddr1"),
        F.when(every("c_custkey", 2), F.concat(city, lit(", NY 10001"))).otherwise(F.concat(city, lit(" NY"))).alias("ContributorAddr2"),
    )
    reference = read(spark, sf_dir, "part").select(
        F.concat("p_partkey", lit(" main st")).alias("address"), F.concat(lit("TOWN"), c("p_partkey") % 25).alias("city"), lit("NY").alias("state"),
        F.concat("p_partkey", lit(" MAIN STREET")).alias("std_address"), F.upper("p_brand").alias("std_city"), lit("NY").alias("std_state"),
        F.lpad(c("p_size").cast("string"), 5, "1").alias("std_zip5"),
    )
    moved = reference.withColumn("city", F.concat(lit("TOWN"), (F.length("address") * 3) % 25))
    return plan.standardize_addresses(rows, reference.unionByName(moved))


ADDRESS_ENRICH = """
WITH r AS (SELECT p_partkey, 'TOWN' || (p_partkey % 25) AS city, * EXCLUDE (p_partkey) FROM part),
two AS (SELECT p_partkey, city, p_brand, p_size FROM r UNION
        SELECT p_partkey, 'TOWN' || ((length(p_partkey || ' main st') * 3) % 25), p_brand, p_size FROM r)
SELECT c_custkey,
       CASE WHEN c_custkey % 12 <> 0 THEN c_custkey || CASE WHEN p_partkey IS NULL THEN ' main st' ELSE ' MAIN STREET' END END AS "ContributorAddr1",
       CASE WHEN p_partkey IS NOT NULL THEN upper(p_brand) || ', NY ' || lpad(CAST(p_size AS VARCHAR), 5, '1')
            WHEN c_custkey % 2 = 0 THEN 'TOWN' || c_nationkey || ', NY 10001' ELSE 'TOWN' || c_nationkey || ' NY' END AS "ContributorAddr2"
FROM customer LEFT JOIN two ON p_partkey = c_custkey AND c_custkey % 12 <> 0 AND city = 'TOWN' || c_nationkey"""


def contributions_of_orders(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer"), c("o_custkey") == c("c_custkey"))
    return rows.select(
        F.year("o_orderdate").alias("FilingYear"), c("c_name").alias("ContributorName"), c("c_mktsegment").alias("ContributorAddr1"),
        F.when(~every("c_custkey", 3), c("c_nationkey").cast("string")).alias("ContributorAddr2"), c("o_orderstatus").alias("FilerID"),
        c("o_orderpriority").alias("FilerName"), lit(None).cast("string").alias("FilerCommittee"), lit("Governor").alias("Office"),
        c("o_totalprice").cast("decimal(18,2)").alias("Amt"),
    )


def totals(spark, sf_dir):
    summed = donor_totals(contributions_of_orders(spark, sf_dir))
    return summed.withColumn("TotalDonation", F.col("TotalDonation").cast("double"))


DONOR_TOTALS = """
SELECT CAST(year(o_orderdate) AS INT) AS "FilingYear", c_name AS "ContributorName", c_mktsegment AS "ContributorAddr1",
       CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS "ContributorAddr2", o_orderstatus AS "FilerID",
       o_orderpriority AS "FilerName", CAST(NULL AS VARCHAR) AS "FilerCommittee", 'Governor' AS "Office",
       CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS "TotalDonation"
FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL"""


QUERIES = {
    "contributor_split": contributor_split,
    "amount_date_parse": amount_date_parse,
    "district_expand": district_expand,
    "filer_years": filer_years,
    "committee_expand": committee_expand,
    "filer_status": filer_status,
    "filer_contributions": filer_contributions,
    "address_enrich": address_enrich,
    "donor_totals": totals,
}

ORACLES = {
    "contributor_split": CONTRIBUTOR_SPLIT,
    "amount_date_parse": AMOUNT_DATE_PARSE,
    "district_expand": DISTRICT_EXPAND,
    "filer_years": FILER_YEARS,
    "committee_expand": COMMITTEE_EXPAND,
    "filer_status": FILER_STATUS,
    "filer_contributions": FILER_CONTRIBUTIONS,
    "address_enrich": ADDRESS_ENRICH,
    "donor_totals": DONOR_TOTALS,
}
