"""Sources and sinks: the tables are written in a messy form and read back."""

import json
import uuid

from pyspark.sql import functions as F

from civicmill import schemas
from civicmill.functions.casts import conform
from civicmill.plans.lookups import load_lookup
from civicmill.plans.results import ALIASES, filename_fields
from civicmill.plans.warehouse import append_table, overwrite_table
from civicmill.session import scratch_path
from civicmill.sources.csv_sets import read_csv_set, read_encoded_lines, read_header_groups, read_lookup
from civicmill.sources.html_tables import html_table_rows
from civicmill.sources.lines import packed_cell, packed_cells, parse_delimited, parse_fixed_width, parse_ranges, rejected_lines
from entryqueries.tables import cents, every, landed_lines, read

c, lit = F.col, F.lit
ROWS_PER_FILE = 100_000


def delimited_parse(spark, sf_dir):
    rows = read(spark, sf_dir, "customer")
    line = F.concat(
        lit("  "), c("c_custkey"), lit(' ,"'), c("c_name"), lit(', ""'), c("c_mktsegment"), lit('""",'),
        F.when(every("c_custkey", 7), lit("N/A")).otherwise(c("c_nationkey").cast("string")), lit(","),
        F.when(every("c_custkey", 11), lit("")).otherwise(F.concat(lit('"\t'), c("c_mktsegment"), lit(' "'))),
        F.when(every("c_custkey", 5), lit("")).otherwise(F.concat(lit(","), cents("c_acctbal"), lit(",spare"))),
    )
    schema = schemas.schema(
        (schemas.LONG, "custkey"), (schemas.STRING, "name"), (schemas.LONG, "nation"),
        (schemas.STRING, "segment"), (schemas.LONG, "cents"),
    )
    return parse_delimited(landed_lines(rows, line, "delimited"), schema)


DELIMITED_PARSE = """
SELECT c_custkey AS custkey, c_name || ', "' || c_mktsegment || '"' AS name,
       CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_nationkey AS BIGINT) END AS nation,
       CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_mktsegment END AS segment,
       CASE WHEN c_custkey % 5 <> 0 THEN CAST(round(c_acctbal * 100) AS BIGINT) END AS cents
FROM customer"""


def fixed_width_parse(spark, sf_dir):
    rows = read(spark, sf_dir, "orders")
    price = F.when(every("o_orderkey", 9), lit("ZZZZZZ")).otherwise(cents("o_totalprice").cast("string"))
    line = F.concat(
        lit("##"), F.lpad(c("o_orderkey").cast("string"), 12, " "), F.rpad("o_orderpriority", 16, " "),
        F.lpad(price, 14, " "), F.rpad("o_orderstatus", 3, " "), lit("tail"),
    )
    layout = [
        ("orderkey", 2, 14, schemas.LONG),
        ("priority", 14, 30, schemas.STRING),
        ("cents", 30, 44, schemas.LONG),
        ("status", 44, 47, schemas.STRING),
        ("beyond", 60, 70, schemas.STRING),
    ]
    return parse_fixed_width(landed_lines(rows, line, "fixed"), layout)


FIXED_WIDTH_PARSE = """
SELECT o_orderkey AS orderkey, o_orderpriority AS priority,
       CASE WHEN o_orderkey % 9 <> 0 THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS cents,
       o_orderstatus AS status, '' AS beyond
FROM orders"""


def packed_ranges(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem")
    cells = [
        lit("PL"), lit("NY"), lit("000"), c("l_linenumber"), c("l_orderkey"), c("l_partkey"), c("l_suppkey"),
        c("l_quantity").cast("long"), cents("l_extendedprice"), cents("l_discount"), cents("l_tax"),
    ]
    line = F.concat_ws(",", *[x.cast("string") for x in cells])
    packed = parse_ranges(landed_lines(rows, line, "wide"), 4, {"keys": (5, 7), "amounts": (7, 11)})
    total = F.aggregate(packed_cells(c("amounts")), lit(0).cast("long"), lambda a, x: a + x)
    return packed.select(
        "LOGRECNO", "keys", "amounts",
        packed_cell(c("keys"), 1).alias("suppkey"), packed_cell(c("amounts"), 0).alias("quantity"),
        packed_cell(c("amounts"), 9).alias("missing"), total.alias("total"),
    )


PACKED_RANGES = """
SELECT l_orderkey AS "LOGRECNO", l_partkey || ',' || l_suppkey AS keys,
       CAST(l_quantity AS BIGINT) || ',' || CAST(round(l_extendedprice * 100) AS BIGINT) || ','
         || CAST(round(l_discount * 100) AS BIGINT) || ',' || CAST(round(l_tax * 100) AS BIGINT) AS amounts,
       l_suppkey AS suppkey, CAST(l_quantity AS BIGINT) AS quantity, CAST(NULL AS BIGINT) AS missing,
       CAST(l_quantity AS BIGINT) + CAST(round(l_extendedprice * 100) AS BIGINT)
         + CAST(round(l_discount * 100) AS BIGINT) + CAST(round(l_tax * 100) AS BIGINT) AS total
FROM lineitem"""


def conform_cast(spark, sf_dir):
    rows = read(spark, sf_dir, "orders")
    key = c("o_orderkey").cast("string")
    messy = rows.select(
        F.concat(lit(" \t"), key, lit("\n")).alias("orderkey"),
        F.when(every("o_orderkey", 3), F.concat(lit("1,"), key))
        .when(every("o_orderkey", 5), F.concat(key, lit(".0")))
        .when(every("o_orderkey", 7), lit("  "))
        .otherwise(F.concat(lit("+"), key)).alias("number"),
        F.when(every("o_orderkey", 4), F.concat(c("o_totalprice").cast("decimal(18,2)").cast("string"), lit("d")))
        .otherwise(F.concat(lit(" "), c("o_totalprice").cast("decimal(18,2)").cast("string"))).alias("price"),
        F.when(every("o_orderkey", 6), lit("1998-02-30")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.concat(c("o_orderpriority"), lit("  ")).alias("priority"),
        c("o_orderstatus").alias("not_declared"),
    )
    declared = schemas.schema(
        (schemas.LONG, "orderkey number"), (schemas.DOUBLE, "price"), (schemas.DATE, "day"),
        (schemas.STRING, "priority absent"),
    )
    return conform(messy, declared)


CONFORM_CAST = """
SELECT o_orderkey AS orderkey,
       CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey END AS number,
       CASE WHEN o_orderkey % 4 <> 0 THEN round(o_totalprice, 2) END AS price,
       CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderdate AS DATE) END AS day,
       o_orderpriority AS priority, CAST(NULL AS VARCHAR) AS absent
FROM orders"""


def redist_load(spark, sf_dir):
    """Many header CSVs of one schema."""
    rows = read(spark, sf_dir, "lineitem").select(
        lit(2010).alias("YR"), lit("36").alias("STATE"), c("l_suppkey").alias("COUNTY"), c("l_partkey").alias("COUSUB"),
        F.when(every("l_linenumber", 3), lit("")).otherwise(c("l_linenumber").cast("string")).alias("WARD"),
        F.concat(lit(" "), c("l_quantity").cast("long"), lit(" ")).alias("AD"),
        c("l_linenumber").alias("ED"), c("l_orderkey").alias("VTD08"),
    )
    path = scratch_path(spark, "redist")
    rows.write.option("header", True).option("maxRecordsPerFile", ROWS_PER_FILE).csv(path)
    return read_csv_set(spark, path, schemas.REDIST_EQUIV)


REDIST_LOAD = """
SELECT CAST(2010 AS BIGINT) AS "YR", CAST(36 AS BIGINT) AS "STATE", l_suppkey AS "COUNTY", l_partkey AS "COUSUB",
       CASE WHEN l_linenumber % 3 <> 0 THEN CAST(l_linenumber AS BIGINT) END AS "WARD",
       CAST(l_quantity AS BIGINT) AS "AD", CAST(l_linenumber AS BIGINT) AS "ED", l_orderkey AS "VTD08"
FROM lineitem"""


def header_union(spark, sf_dir):
    """Part rows landed under three headers, one of them misspelled, with an excluded file."""
    rows = read(spark, sf_dir, "part").select(
        c("p_partkey").cast("string").alias("precinct"), c("p_name").alias("candidate"),
        c("p_size").cast("string").alias("size"), cents("p_retailprice").cast("string").alias("paid"), "p_partkey",
    )
    path = scratch_path(spark, "headers")
    forms = [
        ["precinct", "candidate", c("size").alias("votes"), c("size").alias("district"), c("paid").alias("absentee")],
        [
            c("paid").alias("affidavit"), c("size").alias("affidavit_votes"), "candidate", "precinct",
            F.when(every("p_partkey", 2), c("size")).alias("disctrict"), lit("kept out").alias("district"),
        ],
        [
            "precinct", c("paid").alias("absentee"), c("size").alias("absentee_hc"), lit("1,234").alias("votes"),
            F.concat(c("candidate"), lit(', "x"')).alias("candidate"),
        ],
    ]
    for number, form in enumerate(forms):
        part = rows.where(c("p_partkey") % len(forms) == number).select(*form)
        target = f"{path}/2000/2000110{number + 1}__ny__general.csv"
        part.write.option("header", True).option("escape", '"').option("maxRecordsPerFile", ROWS_PER_FILE).csv(target)
        if number == 0:
            part.write.option("header", True).csv(f"{path}/county_matrix.csv")
    united = read_header_groups(spark, path, schemas.RESULTS, ALIASES, excluded=["county_matrix.csv"])
    day, state, _ = filename_fields(c("filename"))
    typed = united.withColumns({"election_date": day, "state": state})
    names = ["precinct", "candidate", "district", "votes", "absentee_military_votes", "affidavit_votes", "election_date", "state"]
    return conform(typed, type(schemas.RESULTS)([schemas.RESULTS[n] for n in names]))


HEADER_UNION = """
WITH p AS (SELECT p_partkey % 3 AS form, CAST(p_partkey AS VARCHAR) AS precinct, p_name AS candidate, p_partkey,
                  CAST(p_size AS BIGINT) AS size, CAST(round(p_retailprice * 100) AS BIGINT) AS paid FROM part)
SELECT precinct, candidate, CAST(size AS VARCHAR) AS district, size AS votes, paid AS absentee_military_votes,
       CAST(NULL AS BIGINT) AS affidavit_votes, DATE '2000-11-01' AS election_date, 'NY' AS state
FROM p WHERE form = 0
UNION ALL
SELECT precinct, candidate, CASE WHEN p_partkey % 2 = 0 THEN CAST(size AS VARCHAR) END, NULL, NULL, paid, DATE '2000-11-02', 'NY'
FROM p WHERE form = 1
UNION ALL
SELECT precinct, candidate || ', "x"', NULL, NULL, size, NULL, DATE '2000-11-03', 'NY'
FROM p WHERE form = 2"""


def filename_columns(spark, sf_dir):
    rows = read(spark, sf_dir, "orders")
    day = F.when(every("o_orderkey", 13), lit("19981399")).otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    name = F.concat(
        lit("landed/"), F.year("o_orderdate"), lit("/"), day,
        F.when(every("o_orderkey", 10), lit("_")).otherwise(lit("__")),
        F.lower("o_orderstatus"), lit("y__"), F.lower("o_orderpriority"), lit(".csv"),
    )
    election_date, state, scope = filename_fields(name)
    return rows.select("o_orderkey", election_date.alias("election_date"), state.alias("state"), scope.alias("scope"))


FILENAME_FIELDS = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 10 <> 0 AND o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS election_date,
       CASE WHEN o_orderkey % 10 <> 0 THEN o_orderstatus || 'Y' END AS state,
       CASE WHEN o_orderkey % 10 <> 0 THEN lower(o_orderpriority) END AS scope
FROM orders"""


def _order_rows(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", cents("o_totalprice").alias("cents"),
        c("o_orderdate").cast("date").alias("day"),
    )


def overwrite_roundtrip(spark, sf_dir):
    rows, path = _order_rows(spark, sf_dir), scratch_path(spark, "overwrite")
    name = f"overwritten_{uuid.uuid4().hex}"
    overwrite_table(rows.withColumn("cents", lit(0).cast("long")), name, path=path)
    return overwrite_table(rows, name, cluster_by="o_orderstatus", path=path)


def overwrite_self(spark, sf_dir):
    """A table replaced by what a query over itself gives."""
    rows, path = _order_rows(spark, sf_dir), scratch_path(spark, "overwrite-self")
    name = f"overwritten_self_{uuid.uuid4().hex}"
    stored = overwrite_table(rows, name, path=path)
    per_status = stored.groupBy("o_orderstatus").agg(F.max("cents").alias("most"))
    return overwrite_table(stored.join(per_status, "o_orderstatus").where("2 * cents > most").drop("most"), name, path=path)


def append_roundtrip(spark, sf_dir):
    rows, path = _order_rows(spark, sf_dir), scratch_path(spark, "append")
    name = f"appended_{uuid.uuid4().hex}"
    append_table(rows, name, path=path)
    return append_table(rows, name, path=path)


_ORDER_ROWS = """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
       CAST(o_orderdate AS DATE) AS day FROM orders"""


OVERWRITE_SELF = f"""
SELECT * FROM ({_ORDER_ROWS}) QUALIFY 2 * cents > max(cents) OVER (PARTITION BY o_orderstatus)"""


def html_rows(spark, sf_dir):
    """A page per customer with two tables; the larger one has a short row and a total row."""
    rows = read(spark, sf_dir, "customer")
    cell = lambda *parts: F.concat(lit("<td>"), *parts, lit("</td>"))
    head = "<html><body><table><tr><th>x</th></tr><tr><td>1</td></tr></table><p>text</p>" \
        "<table><tr><th>Filer Name</th><th>Contributor</th><th>Amt</th></tr>"
    html = F.concat(
        lit(head),
        lit("<tr>"), cell(c("c_name")), cell(c("c_mktsegment"), lit("<br>&amp; Co<br>Rome")), cell(c("c_custkey").cast("string")), lit("</tr>"),
        lit("<tr>"), cell(c("c_name")), cell(lit("<b>"), c("c_nationkey").cast("string"), lit("</b>")), lit("<td>7"),
        lit("<tr>"), cell(lit("short")), cell(lit("row")), lit("</tr>"),
        lit("<tr>"), cell(lit("")), cell(lit("Total Contributions Received")), cell(lit("9")), lit("</tr>"),
        lit("</table></body></html>"),
    )
    found = html_table_rows(
        rows.select(F.when(~every("c_custkey", 9), c("c_custkey") + (1 << 53)).alias("c_custkey"), html.alias("html")), separator="\n", total="Total Contributions Received"
    )
    return found.select(
        "c_custkey", "row_no",
        *[F.col("cells")[heading].alias(name) for heading, name in (("FilerName", "filer"), ("Contributor", "contributor"), ("Amt", "amt"))],
    )


_HTML_KEY = "CASE WHEN c_custkey % 9 <> 0 THEN c_custkey + 9007199254740992 END AS c_custkey"
HTML_TABLE_ROWS = f"""
SELECT {_HTML_KEY}, CAST(0 AS BIGINT) AS row_no, c_name AS filer, c_mktsegment || chr(10) || '& Co' || chr(10) || 'Rome' AS contributor,
       CAST(c_custkey AS VARCHAR) AS amt FROM customer
UNION ALL
SELECT {_HTML_KEY}, CAST(1 AS BIGINT), c_name, CAST(c_nationkey AS VARCHAR), '7' FROM customer"""


def lookup_load(spark, sf_dir):
    """A lookup CSV without header, written and loaded with its declared schema."""
    path = scratch_path(spark, "lookup")
    read(spark, sf_dir, "nation").select("n_nationkey", F.concat(c("n_name"), lit(', "the"'))).write.option("escape", '"').csv(path)
    return read_lookup(spark, path, schemas.COUNTY_CODES)


LOOKUP_LOAD = """SELECT CAST(n_nationkey AS BIGINT) AS Code, n_name || ', "the"' AS Name FROM nation"""


def lookup_by_schema_file(spark, sf_dir):
    """A lookup CSV, written and loaded as its JSON schema file says, with bad numbers, dates and a repeated field."""
    data, described = scratch_path(spark, "lookup-data"), scratch_path(spark, "lookup-schema")
    rows = read(spark, sf_dir, "supplier").select(
        F.when(every("s_suppkey", 9), lit("none")).otherwise(c("s_suppkey").cast("string")), F.concat(c("s_name"), lit(', "Ltd"')),
        F.when(every("s_suppkey", 4), lit("2016-02-30")).otherwise(F.concat(lit("2016-02-0"), (c("s_nationkey") % 9 + 1).cast("string"))),
        F.concat(lit("["), c("s_nationkey").cast("string"), lit(", 7]")))
    rows.write.option("escape", '"').csv(data)
    told = [{"name": "Key", "type": "integer"}, {"name": "Name", "type": "STRING", "mode": "REQUIRED"}, {"name": "Since", "type": "date"},
            {"name": "Nations", "type": "INTEGER", "mode": "REPEATED"}]
    spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.text(described)
    table = load_lookup(spark, data, described, f"described_{uuid.uuid4().hex}")
    return table.select("Key", "Name", "Since", c("Nations")[0].alias("first"), F.size("Nations").alias("many"))


LOOKUP_BY_SCHEMA_FILE = """
SELECT CASE WHEN s_suppkey % 9 <> 0 THEN CAST(s_suppkey AS BIGINT) END AS "Key", s_name || ', "Ltd"' AS "Name",
       CASE WHEN s_suppkey % 4 <> 0 THEN make_date(2016, 2, CAST(s_nationkey % 9 + 1 AS BIGINT)) END AS "Since",
       CAST(s_nationkey AS BIGINT) AS first, 2 AS many
FROM supplier"""


def refused_lines(spark, sf_dir):
    """Parsed and rejected lines of one landed file; every thirteenth line holds a NUL."""
    line = F.concat(c("c_custkey").cast("string"), F.when(every("c_custkey", 13), lit("\0")).otherwise(lit("")), lit(","), c("c_name"))
    lines = landed_lines(read(spark, sf_dir, "customer"), line, "refused")
    parsed = parse_delimited(lines, schemas.schema((schemas.LONG, "custkey"), (schemas.STRING, "name")))
    found = rejected_lines(lines).select(F.regexp_replace("value", "\0.*", "").cast("long").alias("custkey"), lit(None).cast("string").alias("name"), "reason")
    return parsed.withColumn("reason", lit(None).cast("string")).unionByName(found)


REFUSED_LINES = """
SELECT CAST(c_custkey AS BIGINT) AS custkey, CASE WHEN c_custkey % 13 <> 0 THEN c_name END AS name,
       CASE WHEN c_custkey % 13 = 0 THEN 'NUL' END AS reason
FROM customer"""


def encoded_lines(spark, sf_dir):
    """Bytes read as Latin-1, blank lines and control characters included, counted after decoding.

    The writer makes two bytes of an accented letter, and each is a character of Latin-1.
    """
    path = scratch_path(spark, "encoded")
    line = F.when(every("c_custkey", 10), lit("")).otherwise(F.concat(c("c_name"), lit("\u0001é, ü"), c("c_mktsegment")))
    read(spark, sf_dir, "customer").select(line).write.text(path)
    return read_encoded_lines(spark, path).groupBy("value").agg(F.count("*").alias("n"))


ENCODED_LINES = """
SELECT CASE WHEN c_custkey % 10 = 0 THEN '' ELSE c_name || chr(1) || 'Ã©, Ã¼' || c_mktsegment END AS value, count(*) AS n
FROM customer GROUP BY 1"""


def shared_input_tables(spark, sf_dir):
    """One input written to a table as it is and to another one counted; both read back."""
    rows, name = _order_rows(spark, sf_dir), uuid.uuid4().hex
    raw = overwrite_table(rows, f"shared_raw_{name}", path=scratch_path(spark, "shared-raw"))
    counted = overwrite_table(raw.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("cents").alias("cents")),
                              f"shared_counts_{name}", path=scratch_path(spark, "shared-counts"))
    return raw.join(counted.withColumnsRenamed({"cents": "all_cents"}), "o_orderstatus")


SHARED_INPUT_TABLES = f"""
WITH rows AS ({_ORDER_ROWS})
SELECT r.*, n, all_cents FROM rows r JOIN (
  SELECT o_orderstatus, count(*) AS n, CAST(sum(cents) AS BIGINT) AS all_cents FROM rows GROUP BY 1) USING (o_orderstatus)"""


QUERIES = {
    "lookup_load": lookup_load,
    "lookup_by_schema_file": lookup_by_schema_file,
    "refused_lines": refused_lines,
    "overwrite_self": overwrite_self,
    "encoded_lines": encoded_lines,
    "shared_input_tables": shared_input_tables,
    "delimited_parse": delimited_parse,
    "fixed_width_parse": fixed_width_parse,
    "packed_ranges": packed_ranges,
    "conform_cast": conform_cast,
    "redist_load": redist_load,
    "header_union": header_union,
    "filename_fields": filename_columns,
    "overwrite_roundtrip": overwrite_roundtrip,
    "append_roundtrip": append_roundtrip,
    "html_table_rows": html_rows,
}

ORACLES = {
    "lookup_load": LOOKUP_LOAD,
    "lookup_by_schema_file": LOOKUP_BY_SCHEMA_FILE,
    "refused_lines": REFUSED_LINES,
    "overwrite_self": OVERWRITE_SELF,
    "encoded_lines": ENCODED_LINES,
    "shared_input_tables": SHARED_INPUT_TABLES,
    "delimited_parse": DELIMITED_PARSE,
    "fixed_width_parse": FIXED_WIDTH_PARSE,
    "packed_ranges": PACKED_RANGES,
    "conform_cast": CONFORM_CAST,
    "redist_load": REDIST_LOAD,
    "header_union": HEADER_UNION,
    "filename_fields": FILENAME_FIELDS,
    "overwrite_roundtrip": _ORDER_ROWS,
    "append_roundtrip": f"{_ORDER_ROWS} UNION ALL {_ORDER_ROWS}",
    "html_table_rows": HTML_TABLE_ROWS,
}
