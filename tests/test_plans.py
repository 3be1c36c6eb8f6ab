"""Shape of the physical plans: where data is shuffled, and what reaches the scan."""

import re
from datetime import date

from pyspark.sql import functions as F

from civicmill.plans import voter
from civicmill.plans.matching import voters_to_match
from civicmill.operators.merge import merge_records
from entryqueries.people import _codes, county_names, voters_of_orders

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def landed_voters(spark, tmp_path):
    path = f"{tmp_path}/raw"
    voters_of_orders(spark.read.parquet(f"{SF}/orders.parquet")).write.parquet(path)
    return spark.read.parquet(path)


def voter_side(text):
    """The plan without its broadcast sides."""
    kept, skip = [], None
    for line in text.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth > skip:
            continue
        skip = None
        kept.append(line)
        if "BroadcastExchange" in line:
            skip = depth
    return "\n".join(kept)


def test_formatting_voters_shuffles_no_voter(spark, tmp_path):
    raw = landed_voters(spark, tmp_path)
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    text = plan(voter.format_voters(raw, _codes(orders), county_names(spark, SF), F.lit(date(1999, 1, 1))))
    assert "hashpartitioning" not in voter_side(text)
    assert "PushedFilters: [IsNotNull(STATUS), EqualTo(STATUS,ACTIVE)]" in text
    assert "MAILADD1" not in text


def test_counts_shuffle_once_and_read_six_columns(spark, tmp_path):
    raw = landed_voters(spark, tmp_path)
    text = voter_side(plan(voter.count_voters(raw, county_names(spark, SF))))
    assert text.count("hashpartitioning") == 1 and text.count("partial_count") == 1
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"COUNTYCODE", "AD", "WARD", "ED", "ENROLLMENT"}


def test_match_voters_push_their_filter(spark, tmp_path):
    text = plan(voters_to_match(landed_voters(spark, tmp_path)))
    assert "EqualTo(SD,31)" in text and "EqualTo(STATUS,ACTIVE)" in text and "Exchange" not in text


def test_many_election_codes_plan_fast_and_shuffle_no_voter(spark, tmp_path):
    import time

    from civicmill.operators.history import count_history

    path = f"{tmp_path}/codes"
    code = F.concat(F.lit("E'\\"), F.col("id").cast("string"))
    kind = F.when(F.col("id") % 2 == 0, "Primary").otherwise("General")
    spark.range(50_000).select(code.alias("Election"), kind.alias("Type"), F.lit(date(2019, 1, 1)).alias("Date")).write.parquet(path)
    codes = spark.read.parquet(path)
    voters = spark.createDataFrame([(1, "E'\\4;E'\\7;E'\\4;none"), (2, None)], "id long, VoterHistory string")
    count_history(voters, codes.limit(10), F.lit(date(2020, 1, 1))).collect()
    counted = count_history(voters, codes, F.lit(date(2020, 1, 1)))
    started = time.time()
    text = voter_side(counted._jdf.queryExecution().optimizedPlan().toString())
    assert time.time() - started < 6 and "Join" not in text
    assert sorted((r["id"], r["FiveYearElections"], r["FiveYearPrimaries"], r["Prime"]) for r in counted.collect()) == [(1, 3, 2, True), (2, 0, 0, False)]


def test_committees_read_filers_once(spark, tmp_path):
    from civicmill.operators.lookup import expand_with

    spark.createDataFrame([("A", "x"), ("B", "y"), (None, "z")], "id string, name string").write.parquet(f"{tmp_path}/filers")
    filers = spark.read.parquet(f"{tmp_path}/filers")
    extra = spark.createDataFrame([("A", "A1", "c1"), ("A", "A2", None), (None, "N", "n")], "owner string, other string, c string")
    found = expand_with(filers, extra.withColumnRenamed("owner", "id"), "id", {"id": "other", "name": "c"})
    assert plan(found).count("FileScan parquet") == 1
    assert sorted(map(str, found.collect())) == sorted(map(str, spark.createDataFrame(
        [("A", "x"), ("B", "y"), (None, "z"), ("A1", "c1"), ("A2", None)], "id string, name string").collect()))


def test_no_job_runs_while_lookups_are_planned(spark, tmp_path):
    from civicmill.operators.lookup import attach_overriding
    from civicmill.plans import finance

    words = lambda *names: spark.createDataFrame([tuple(names)], ", ".join(f"{n} string" for n in names))
    for name, df in {
        "filers": words("FilerID", "FilerName", "Dist"), "pages": words("FilerID", "html"),
        "rows": words("FilerID", "ContributorAddr1", "ContributorAddr2"),
        "reference": words("address", "city", "state", "std_address", "std_city", "std_state", "std_zip5"),
    }.items():
        df.write.parquet(f"{tmp_path}/{name}")
    filers, pages, given, reference = [spark.read.parquet(f"{tmp_path}/{n}") for n in ("filers", "pages", "rows", "reference")]
    spark.sparkContext.setJobGroup("planned", "lookups")
    try:
        built = [
            finance.with_status(filers, pages), finance.with_committees(filers, finance.committees_of(pages)),
            attach_overriding(given, filers, "FilerID"), finance.standardize_addresses(given, reference),
        ]
        texts = [plan(df) for df in built]
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planned")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert all("BroadcastHashJoin" in text and "SortMergeJoin" not in text for text in texts)
    assert [df.count() for df in built] == [1, 1, 1, 1]


def test_merge_shuffles_each_side_once(spark):
    a = spark.read.parquet(f"{SF}/orders.parquet").select(F.col("o_orderkey").alias("k"), "o_custkey")
    b = spark.read.parquet(f"{SF}/customer.parquet").select(F.col("c_custkey").alias("k"), "c_name")
    text = plan(merge_records([a, b], "k"))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
