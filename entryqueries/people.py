"""Names, addresses, dates and participation counters of voters."""

from datetime import date

from pyspark.sql import functions as F

from civicmill import schemas
from civicmill.functions import people as fn
from civicmill.operators.history import count_history, count_history_by_join
from civicmill.plans.voter import count_voters, format_voters, parse_voters
from entryqueries.tables import every, landed_lines, read

c, lit = F.col, F.lit
AS_OF = date(1999, 6, 15)

# Title case in DuckDB, for ASCII text.
TITLE = """array_to_string(list_transform(regexp_extract_all(lower({0}), '[a-z]+|[^a-z]+'),
           lambda w: upper(w[1]) || w[2:]), '')"""


def full_name(spark, sf_dir):
    rows = read(spark, sf_dir, "part")
    first = F.concat(lit("O'"), F.upper("p_name"))
    middle = F.when(every("p_partkey", 3), lit("")).when(~every("p_partkey", 4), c("p_type"))
    last = F.concat(c("p_brand"), lit("-smith"))
    suffix = F.when(every("p_partkey", 5), lit("3RD "))
    return rows.select("p_partkey", fn.full_name(first, middle, last, suffix).alias("full_name"))


_NAME = """replace('O''' || upper(p_name) || ' ' || CASE WHEN p_partkey % 3 = 0 OR p_partkey % 4 = 0 THEN '' ELSE p_type END
  || ' ' || p_brand || '-smith ' || CASE WHEN p_partkey % 5 = 0 THEN '3RD ' ELSE '' END, '  ', ' ')"""
FULL_NAME = f"SELECT p_partkey, trim({TITLE.format(_NAME)}) AS full_name FROM part"


def _address_parts():
    number = F.when(every("p_partkey", 6), lit("")).otherwise(c("p_size").cast("string"))
    half = F.when(every("p_partkey", 8), lit("1/2"))
    pre = F.when(every("p_partkey", 3), lit("W")).otherwise(lit(""))
    unit = (
        F.when(every("p_partkey", 2), F.concat(lit("apt "), c("p_size"))).when(every("p_partkey", 5), lit(""))
        .when(every("p_partkey", 7), F.concat(lit("Unit"), c("p_size"))).when(every("p_partkey", 11), lit("PH2"))
        .when(~every("p_partkey", 13), F.concat(c("p_size"), lit("e")))
    )
    return number, half, pre, c("p_name"), c("p_type"), unit


_PARTS = """
WITH a AS (
  SELECT p_partkey, p_name AS street, p_type AS post, p_brand AS city, CAST(10000 + p_size AS VARCHAR) AS zip,
         CASE WHEN p_partkey % 6 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS number,
         CASE WHEN p_partkey % 8 = 0 THEN '1/2' ELSE '' END AS half,
         CASE WHEN p_partkey % 3 = 0 THEN 'W' ELSE '' END AS pre,
         CASE WHEN p_partkey % 2 = 0 THEN 'apt ' || p_size WHEN p_partkey % 5 = 0 THEN ''
              WHEN p_partkey % 7 = 0 THEN 'Unit' || p_size WHEN p_partkey % 11 = 0 THEN 'PH2'
              WHEN p_partkey % 13 <> 0 THEN p_size || 'e' ELSE '' END AS unit
  FROM part)"""


def format_address(spark, sf_dir):
    number, half, pre, street, post, unit = _address_parts()
    city, zip5 = c("p_brand"), (c("p_size") + 10000).cast("string")
    return read(spark, sf_dir, "part").select(
        "p_partkey",
        fn.residence_address(number, half, pre, street, post, unit, city, zip5).alias("address"),
        fn.street_address(number, half, pre, street, post, city, zip5).alias("street_address"),
        fn.match_address(number, street, unit).alias("match_line"),
    )


FORMAT_ADDRESS = _PARTS + """
SELECT p_partkey,
       upper(trim(replace(number || ' ' || half || ' ' || pre || ' ' || street || ' ' || post || ' ' ||
         CASE WHEN unit = '' OR upper(unit) LIKE '%APT%' OR upper(unit) LIKE '%UNIT%' THEN unit ELSE 'APT ' || unit END,
         '  ', ' '))) || ', ' || city || ', NY ' || zip AS address,
       upper(trim(number || ' ' || half || ' ' || pre || ' ' || street || ' ' || post)) || ', ' || city || ', NY ' || zip AS street_address,
       number || ' ' || street || ' ' ||
         CASE WHEN unit = '' OR unit LIKE '%APT%' OR unit LIKE '%UNIT%' OR unit LIKE '%PH%' THEN unit ELSE 'APT ' || unit END AS match_line
FROM a"""


def _messy_date(col="o_orderdate", key="o_orderkey"):
    text = F.date_format(col, "yyyyMMdd")
    return (
        F.when(every(key, 6), lit("19560231")).when(every(key, 7), lit("")).when(every(key, 11), lit("n/a"))
        .when(every(key, 5), F.concat(text, lit("0000"))).otherwise(text)
    )


def date_age(spark, sf_dir):
    born = fn.compact_date(_messy_date())
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", born.alias("born"), fn.age(born, lit(AS_OF)).alias("age"),
        fn.is_recent(born, lit(date(2002, 1, 1))).alias("recent"),
    )


DATE_AGE = """
WITH d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0
                                   THEN CAST(o_orderdate AS DATE) END AS born FROM orders)
SELECT o_orderkey, born, CAST(floor(date_diff('day', born, DATE '1999-06-15') / 365.0) AS BIGINT) AS age,
       date_diff('day', born, DATE '2002-01-01') < 1825 AS recent FROM d"""


def _codes(orders):
    """Election codes: one per month of the orders, with repeated keys, and missing dates and types."""
    month = F.date_format("o_orderdate", "yyyyMM")
    months = orders.select(month.alias("m"), F.trunc(c("o_orderdate").cast("date"), "month").alias("d")).distinct()
    kind = (
        F.when(F.month("d") == 4, lit("Presidential Primary")).when(F.month("d") == 9, lit("Primary"))
        .when(F.month("d") != 1, lit("General"))
    )
    rows = months.select(
        F.concat(lit("E"), c("m")).alias("Election"), F.month("d").cast("long").alias("Num"),
        kind.alias("Type"), F.when(F.month("d") != 2, c("d")).alias("Date"),
    )
    return rows.unionByName(rows.withColumn("Date", F.date_sub("Date", 4000)))


def _history():
    """Codes of the month and the one after it, with a repeat, an unknown code and blanks."""
    code = F.concat(lit("E"), F.date_format("o_orderdate", "yyyyMM"))
    after = F.concat(lit("E"), F.date_format(F.add_months("o_orderdate", 1), "yyyyMM"))
    return F.when(every("o_orderkey", 9), lit("")).when(
        ~every("o_orderkey", 10), F.concat_ws(";", code, after, lit(""), code, lit("nowhere"))
    )


_HISTORY = """
months AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders),
recent AS (
  SELECT d, CASE WHEN month(d) IN (4, 9) THEN 1 ELSE 0 END AS prim FROM months
  WHERE month(d) <> 2 AND date_diff('day', d, DATE '1999-06-15') < 1825),
counters AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 9 = 0 OR o_orderkey % 10 = 0 THEN 0
              ELSE 2 * (a.d IS NOT NULL)::BIGINT + (b.d IS NOT NULL)::BIGINT END AS elections,
         CASE WHEN o_orderkey % 9 = 0 OR o_orderkey % 10 = 0 THEN 0
              ELSE 2 * coalesce(a.prim, 0) + coalesce(b.prim, 0) END AS primaries
  FROM orders
  LEFT JOIN recent a ON a.d = CAST(date_trunc('month', o_orderdate) AS DATE)
  LEFT JOIN recent b ON b.d = CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE))"""


def _history_counts(spark, sf_dir, count):
    orders = read(spark, sf_dir, "orders")
    voters = orders.select("o_orderkey", _history().alias("VoterHistory"))
    counted = count(voters, _codes(orders), lit(AS_OF))
    return counted.select(
        "o_orderkey", c("FiveYearElections").alias("elections"), c("FiveYearPrimaries").alias("primaries"),
        c("Prime").alias("prime"),
    )


def history_counts(spark, sf_dir):
    return _history_counts(spark, sf_dir, count_history)


def history_counts_by_join(spark, sf_dir):
    """The form for code tables too long for the plan."""
    return _history_counts(spark, sf_dir, count_history_by_join)


HISTORY_COUNTS = f"""
WITH {_HISTORY}
SELECT o_orderkey, CAST(elections AS BIGINT) AS elections, CAST(primaries AS BIGINT) AS primaries, primaries > 0 AS prime
FROM counters"""


def voters_of_orders(orders):
    """Every order as a voter record of the full raw schema."""
    key = c("o_orderkey")
    made = {
        "FIRSTNAME": F.upper("o_orderpriority"), "LASTNAME": F.concat(lit("o'cust-"), c("o_custkey")),
        "MIDDLENAME": F.when(every("o_orderkey", 3), lit("q")), "NAMESUFFIX": lit(""),
        "RADDNUMBER": c("o_custkey").cast("string"), "RSTREETNAME": c("o_orderpriority"),
        "RAPARTMENT": F.when(every("o_orderkey", 2), F.concat(lit("Apt "), key % 90)).otherwise((key % 70).cast("string")),
        "RCITY": F.concat(lit("Town"), key % 40), "RZIP5": (key % 900 + 10000).cast("string"),
        "DOB": _messy_date(), "LASTVOTEDDATE": F.date_format("o_orderdate", "yyyyMMdd"),
        "GENDER": F.when(every("o_custkey", 2), lit("F")).otherwise(lit("M")), "ENROLLMENT": c("o_orderpriority"),
        "STATUS": F.when(c("o_orderstatus") == "O", lit("ACTIVE")).otherwise(lit("PURGED")),
        "COUNTYCODE": c("o_custkey") % 30, "SD": key % 63, "AD": key % 150, "ED": key % 20, "WARD": key % 9,
        "SBOEID": F.concat(lit("NY"), F.lpad(key.cast("string"), 12, "0")), "VoterHistory": _history(),
    }
    return orders.select(
        *[made.get(f.name, lit(None)).cast(f.dataType).alias(f.name) for f in schemas.VOTER_RAW.fields]
    )


def county_names(spark, sf_dir):
    nations = read(spark, sf_dir, "nation")
    return nations.select(c("n_nationkey").cast("long").alias("Code"), c("n_name").alias("Name"))


def voter_formatted(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    return format_voters(voters_of_orders(orders), _codes(orders), county_names(spark, sf_dir), lit(AS_OF))


_VOTER_NAME = """replace(upper(o_orderpriority) || ' ' || CASE WHEN o_orderkey % 3 = 0 THEN 'q' ELSE '' END
  || ' o''cust-' || o_custkey || ' ', '  ', ' ')"""
VOTER_FORMATTED = f"""
WITH {_HISTORY},
v AS (SELECT *, CASE WHEN o_orderkey % 6 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0
                     THEN CAST(o_orderdate AS DATE) END AS born,
             ', Town' || (o_orderkey % 40) || ', NY ' || (o_orderkey % 900 + 10000) AS place
      FROM orders JOIN counters USING (o_orderkey) LEFT JOIN nation ON n_nationkey = o_custkey % 30
      WHERE o_orderstatus = 'O')
SELECT trim({TITLE.format(_VOTER_NAME)}) AS "FullName",
       CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS "Gender", o_orderpriority AS "Enrollment",
       CAST(NULL AS VARCHAR) AS "OtherPartyEnrollment", n_name AS "County", o_orderkey % 20 AS "ElectionDistrict",
       CAST(NULL AS BIGINT) AS "LegislativeDistrict", CAST(NULL AS VARCHAR) AS "TownCityCode", o_orderkey % 9 AS "Ward",
       CAST(NULL AS BIGINT) AS "CongressionalDistrict", o_orderkey % 63 AS "SenateDistrict", o_orderkey % 150 AS "AssemblyDistrict",
       CAST(NULL AS VARCHAR) AS "PreviousName", CAST(NULL AS VARCHAR) AS "CountyVoterNumber",
       CAST(NULL AS VARCHAR) AS "VoterRegistrationSource", CAST(NULL AS VARCHAR) AS "IDRequired",
       CAST(NULL AS VARCHAR) AS "IDMet", 'NY' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS "SBOEID", born AS "DateOfBirth",
       CAST(o_orderdate AS DATE) AS "LastVotedDate",
       CAST(floor(date_diff('day', born, DATE '1999-06-15') / 365.0) AS BIGINT) AS "Age",
       upper(replace(o_custkey || '   ' || o_orderpriority || '  ' ||
         CASE WHEN o_orderkey % 2 = 0 THEN 'Apt ' || (o_orderkey % 90) ELSE 'APT ' || (o_orderkey % 70) END, '  ', ' ')) || place AS "Address",
       upper(o_custkey || '   ' || o_orderpriority) || place AS "StreetAddress",
       primaries > 0 AS "Prime", CAST(elections AS BIGINT) AS "FiveYearElections", CAST(primaries AS BIGINT) AS "FiveYearPrimaries"
FROM v"""


def conditional_counts(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(
        c("l_suppkey").alias("COUNTYCODE"), (c("l_partkey") % 10).alias("AD"), (c("l_orderkey") % 8).alias("WARD"),
        c("l_linenumber").cast("long").alias("ED"), F.when(c("l_returnflag") != "R", c("l_returnflag")).alias("ENROLLMENT"),
    )
    return count_voters(rows, county_names(spark, sf_dir))


CONDITIONAL_COUNTS = """
SELECT l_suppkey AS "COUNTYCODE", n_name AS "County",
       CASE WHEN l_suppkey IN (3, 24, 30, 31, 41, 43) THEN l_partkey % 10 END AS "AD",
       CASE WHEN l_suppkey NOT IN (3, 24, 30, 31, 41, 43) THEN l_orderkey % 8 END AS "WARD",
       CAST(l_linenumber AS BIGINT) AS "ED", CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS "ENROLLMENT",
       count(*) AS "Count"
FROM lineitem LEFT JOIN nation ON n_nationkey = l_suppkey
GROUP BY ALL"""


def voter_counts(spark, sf_dir):
    """From raw voter lines to the count table: parse, count, look up the county."""
    rows = read(spark, sf_dir, "lineitem")
    cell = {
        "LASTNAME": F.concat(lit('"SMITH, '), c("l_orderkey"), lit('"')), "COUNTYCODE": c("l_suppkey"),
        "ED": F.concat(lit(" "), c("l_linenumber")), "WARD": c("l_orderkey") % 8, "AD": c("l_partkey") % 10,
        "ENROLLMENT": F.concat(lit('"'), c("l_returnflag"), lit(' "')), "STATUS": c("l_linestatus"),
    }
    line = F.concat_ws(",", *[cell.get(n, lit("")).cast("string") for n in schemas.VOTER_RAW.names])
    return count_voters(parse_voters(landed_lines(rows, line, "voters")), county_names(spark, sf_dir))


VOTER_COUNTS = CONDITIONAL_COUNTS.replace("CASE WHEN l_returnflag <> 'R' THEN l_returnflag END", "l_returnflag")

QUERIES = {
    "full_name": full_name,
    "format_address": format_address,
    "date_age": date_age,
    "history_counts": history_counts,
    "history_counts_by_join": history_counts_by_join,
    "voter_formatted": voter_formatted,
    "conditional_counts": conditional_counts,
    "voter_counts": voter_counts,
}

ORACLES = {
    "full_name": FULL_NAME,
    "format_address": FORMAT_ADDRESS,
    "date_age": DATE_AGE,
    "history_counts": HISTORY_COUNTS,
    "history_counts_by_join": HISTORY_COUNTS,
    "voter_formatted": VOTER_FORMATTED,
    "conditional_counts": CONDITIONAL_COUNTS,
    "voter_counts": VOTER_COUNTS,
}
