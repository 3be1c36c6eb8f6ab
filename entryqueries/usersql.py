"""The documented user queries, run on the given tables under the warehouse's column names."""

from datetime import date

from pyspark.sql import functions as F

from civicmill.operators.rollup import joined_values
from civicmill.plans.warehouse import run_example
from entryqueries.finance import DONOR_TOTALS, contributions_of_orders
from entryqueries.tables import every, read

c, lit = F.col, F.lit


def _formatted(spark, sf_dir):
    customer = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), c("c_nationkey") == c("n_nationkey"), "left")
    return customer.select(
        c("c_name").alias("FullName"), F.when(every("c_custkey", 2), lit("F")).otherwise(lit("M")).alias("Gender"),
        c("c_mktsegment").alias("Enrollment"), c("n_name").alias("County"), c("c_nationkey").alias("SenateDistrict"),
        F.date_add(lit(date(1950, 1, 1)), c("c_custkey").cast("int")).alias("DateOfBirth"),
        (c("c_custkey") % 11).alias("FiveYearElections"), (c("c_custkey") % 5).alias("FiveYearPrimaries"),
    )


def sql_point_lookup(spark, sf_dir):
    tables = {"Formatted": _formatted(spark, sf_dir)}
    return run_example(spark, "voter_by_name", tables, name="Customer#000000002", county="NATION_16")


SQL_POINT_LOOKUP = """
SELECT c_name AS "FullName", CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS "Gender", c_mktsegment AS "Enrollment",
       CAST(DATE '1950-01-01' + CAST(c_custkey AS INT) AS DATE) AS "DateOfBirth", c_custkey % 11 AS "FiveYearElections", c_custkey % 5 AS "FiveYearPrimaries"
FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_name = 'Customer#000000002' AND n_name = 'NATION_16'"""


def sql_group_count(spark, sf_dir):
    return run_example(spark, "enrollment_of_district", {"Formatted": _formatted(spark, sf_dir)}, district=11)


SQL_GROUP_COUNT = """SELECT c_mktsegment AS "Enrollment", count(*) AS "Num" FROM customer WHERE c_nationkey = 11 GROUP BY 1"""


def _raw(spark, sf_dir):
    month = lambda day: F.date_format(day, "yyyyMM")
    return read(spark, sf_dir, "orders").select(
        c("o_orderpriority").alias("ENROLLMENT"), c("o_orderstatus").alias("TOWNCITY"), (c("o_custkey") % 3).alias("ED"),
        (c("o_custkey") % 63).alias("SD"), (c("o_custkey") % 150).alias("AD"),
        F.when(c("o_orderstatus") == "F", lit("PURGED")).otherwise(lit("ACTIVE")).alias("STATUS"),
        F.concat_ws(";", month("o_orderdate"), month(F.add_months("o_orderdate", 1)), lit("")).alias("VoterHistory"),
    )


def sql_overlapping_districts(spark, sf_dir):
    return run_example(spark, "overlapping_districts", {"Raw": _raw(spark, sf_dir)}, district=75)


SQL_OVERLAPPING_DISTRICTS = """
SELECT o_custkey % 63 AS "SD", count(*) AS "Num" FROM orders WHERE o_custkey % 150 = 75 AND o_orderstatus <> 'F' GROUP BY 1"""


def sql_history_by_type(spark, sf_dir):
    months = read(spark, sf_dir, "orders").select(F.trunc(c("o_orderdate").cast("date"), "month").alias("Date")).distinct()
    codes = months.select(
        F.date_format("Date", "yyyyMM").alias("Election"), "Date",
        F.when(F.month("Date") == 4, lit("Presidential Primary")).otherwise(lit("General")).alias("Type"),
    )
    # The example asks for days after 2016; the orders are older, so the codes are dated later.
    codes = codes.withColumn("Date", F.add_months("Date", 12 * 19))
    tables = {"Raw": _raw(spark, sf_dir), "ElectionCodes": codes}
    return run_example(spark, "turnout_of_election_type", tables, town="O", district=1, type="Presidential Primary")


SQL_HISTORY_BY_TYPE = """
WITH h AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders WHERE o_orderstatus = 'O' AND o_custkey % 3 = 1
           UNION ALL SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) FROM orders WHERE o_orderstatus = 'O' AND o_custkey % 3 = 1),
known AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders)
SELECT o_orderpriority AS "ENROLLMENT", CAST(d + INTERVAL 19 YEAR AS DATE) AS "Date", 'Presidential Primary' AS "Type", count(*) AS "Num"
FROM h JOIN known USING (d) WHERE month(d) = 4 AND d + INTERVAL 19 YEAR > DATE '2016-01-01' GROUP BY ALL"""


def sql_unnest_districts(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    pair = F.array(*[
        F.struct(c("p_size").cast("long").alias("WARD"), (c("p_partkey") % n).alias("AD"), c("p_partkey").alias("ED")) for n in (90, 70)
    ])
    number = lambda k: (c("p_partkey") % k)
    table = part.select(
        c("p_brand").alias("CountyName"), c("p_name").alias("CousubName"), number(1000).alias("TotalOver18"), number(100).alias("HispanicOver18"),
        number(99).alias("WhiteNonHispanicOver18"), number(98).alias("BlackNonHispanicOver18"), number(97).alias("TotalHousingUnits"),
        number(96).alias("OccupiedHousingUnits"), number(95).alias("VacantHousingUnits"), pair.alias("ElectionDistricts"),
    )
    return run_example(spark, "census_of_district", {"VTDFormatted": table}, district=67)


_VTD = """
SELECT p_brand AS "CountyName", p_name AS "CousubName", p_partkey % 1000 AS "TotalOver18", p_partkey % 100 AS "HispanicOver18",
       p_partkey % 99 AS "WhiteNonHispanicOver18", p_partkey % 98 AS "BlackNonHispanicOver18", p_partkey % 97 AS "TotalHousingUnits",
       p_partkey % 96 AS "OccupiedHousingUnits", p_partkey % 95 AS "VacantHousingUnits", p_partkey % {0} AS "AD", p_partkey AS "ED"
FROM part WHERE p_partkey % {0} = 67"""
SQL_UNNEST_DISTRICTS = _VTD.format(90) + " UNION ALL " + _VTD.format(70)


def _curated(spark, sf_dir):
    candidate = F.when(every("o_custkey", 40), lit("Blank")).when(~every("o_custkey", 41), F.concat(lit("C"), c("o_custkey")))
    return read(spark, sf_dir, "orders").select(
        lit("U.S. House").alias("office"), (c("o_custkey") % 5).alias("district"), candidate.alias("candidate"),
        F.when(~every("o_orderkey", 8), c("o_orderpriority")).alias("party"),
        F.when(c("o_orderstatus") != "F", lit("Suffolk")).otherwise(lit("Kings")).alias("county"),
        F.floor("o_totalprice").cast("double").alias("votes"), lit(date(2016, 11, 8)).alias("election_date"),
    )


def sql_results_parties(spark, sf_dir):
    tables = {"Curated": _curated(spark, sf_dir)}
    return run_example(spark, "results_of_county", tables, county="Suffolk", day=date(2016, 11, 8))


SQL_RESULTS_PARTIES = """
SELECT 'U.S. House' AS office, o_custkey % 5 AS district, 'C' || o_custkey AS candidate,
       coalesce(string_agg(CASE WHEN o_orderkey % 8 <> 0 THEN o_orderpriority END, ', ' ORDER BY o_orderpriority), '') AS "Parties",
       sum(floor(o_totalprice)) AS "Votes"
FROM orders
WHERE o_orderstatus <> 'F' AND o_custkey % 5 IN (1, 2, 3) AND o_custkey % 40 <> 0 AND o_custkey % 41 <> 0
GROUP BY 1, 2, 3"""


def joined_parties(spark, sf_dir):
    """The same string aggregate as a DataFrame operator, per customer and over all orders."""
    rows = _curated(spark, sf_dir)
    return joined_values(rows, ["district", "candidate"], "party", "parties", votes="votes")


JOINED_PARTIES = """
SELECT o_custkey % 5 AS district, CASE WHEN o_custkey % 40 = 0 THEN 'Blank' WHEN o_custkey % 41 <> 0 THEN 'C' || o_custkey END AS candidate,
       coalesce(string_agg(CASE WHEN o_orderkey % 8 <> 0 THEN o_orderpriority END, ', ' ORDER BY o_orderpriority), '') AS parties,
       sum(floor(o_totalprice)) AS votes
FROM orders GROUP BY 1, 2"""


def sql_money_summary(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "supplier"), c("l_suppkey") == c("s_suppkey"))
    table = rows.select(
        (F.year("l_shipdate") + 16).alias("FilingYear"), c("l_suppkey").alias("FilerID"), c("s_name").alias("FilerName"),
        F.when(c("l_returnflag") == "A", lit("State Senator")).otherwise(lit("Governor")).alias("Office"),
        (c("s_nationkey") % 3).alias("Dist"), c("l_extendedprice").cast("decimal(18,2)").alias("Amt"),
    )
    return run_example(spark, "funds_raised", {"State": table}, year=2012, office="State Senator", district=2)


SQL_MONEY_SUMMARY = """
SELECT CAST(year(l_shipdate) + 16 AS INT) AS "FilingYear", l_suppkey AS "FilerID", s_name AS "FilerName",
       '$' || format('{:,}', CAST(round_even(sum(CAST(l_extendedprice AS DECIMAL(18, 2))), 0) AS BIGINT)) AS "Raised"
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
WHERE year(l_shipdate) + 16 > 2012 AND l_returnflag = 'A' AND s_nationkey % 3 = 2 GROUP BY ALL"""


def sql_voters_of_district(spark, sf_dir):
    return run_example(spark, "voters_of_district", {"Raw": _raw(spark, sf_dir)}, district=31)


SQL_VOTERS_OF_DISTRICT = """
SELECT o_orderpriority AS "ENROLLMENT", o_orderstatus AS "TOWNCITY", o_custkey % 3 AS "ED", o_custkey % 63 AS "SD", o_custkey % 150 AS "AD",
       'ACTIVE' AS "STATUS",
       strftime(o_orderdate, '%Y%m') || ';' || strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%Y%m') || ';' AS "VoterHistory"
FROM orders WHERE o_custkey % 63 = 31 AND o_orderstatus <> 'F'"""


def sql_donor_totals(spark, sf_dir):
    totals = run_example(spark, "donor_totals", {"State": contributions_of_orders(spark, sf_dir)})
    return totals.withColumn("TotalDonation", c("TotalDonation").cast("double"))


def sql_limit(spark, sf_dir):
    """The first ten rows; ordered first, so that they are always the same."""
    table = _formatted(spark, sf_dir).orderBy("FullName")
    return run_example(spark, "first_voters", {"Formatted": table})


SQL_LIMIT = """
SELECT c_name AS "FullName", CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS "Gender",
       CAST(DATE '1950-01-01' + CAST(c_custkey AS INT) AS DATE) AS "DateOfBirth" FROM customer ORDER BY c_name LIMIT 10"""

QUERIES = {
    "sql_point_lookup": sql_point_lookup,
    "sql_group_count": sql_group_count,
    "sql_overlapping_districts": sql_overlapping_districts,
    "sql_history_by_type": sql_history_by_type,
    "sql_unnest_districts": sql_unnest_districts,
    "sql_results_parties": sql_results_parties,
    "joined_parties": joined_parties,
    "sql_money_summary": sql_money_summary,
    "sql_voters_of_district": sql_voters_of_district,
    "sql_donor_totals": sql_donor_totals,
    "sql_limit": sql_limit,
}

ORACLES = {
    "sql_point_lookup": SQL_POINT_LOOKUP,
    "sql_group_count": SQL_GROUP_COUNT,
    "sql_overlapping_districts": SQL_OVERLAPPING_DISTRICTS,
    "sql_history_by_type": SQL_HISTORY_BY_TYPE,
    "sql_unnest_districts": SQL_UNNEST_DISTRICTS,
    "sql_results_parties": SQL_RESULTS_PARTIES,
    "joined_parties": JOINED_PARTIES,
    "sql_money_summary": SQL_MONEY_SUMMARY,
    "sql_voters_of_district": SQL_VOTERS_OF_DISTRICT,
    "sql_donor_totals": DONOR_TOTALS,
    "sql_limit": SQL_LIMIT,
}
