"""Whole jobs, from landed files to warehouse tables and user queries."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from civicmill import schemas
from civicmill.plans import census, finance, matching, news, results, voter, warehouse
from tests.test_operators import rows
from tests.test_sources import write


def voter_line(**cells):
    return ",".join('"%s"' % cells.get(name, "") for name in schemas.VOTER_RAW.names)


VOTERS = [
    dict(LASTNAME="NIEVES", FIRSTNAME="LYDIA", RADDNUMBER="5210", RAPARTMENT="12E", RSTREETNAME="BROADWAY", RCITY="MANHATTAN", RZIP5="10463",
         DOB="19560227", COUNTYCODE="31", AD="75", WARD="1", ED="1", SD="31", STATUS="ACTIVE", ENROLLMENT="DEM", SBOEID="NY1", COUNTYVRNUMBER="C1",
         TOWNCITY="BROOKHAVEN", VoterHistory="P16;G16;;X", GENDER="F"),
    dict(LASTNAME="O'NEIL", FIRSTNAME="JOHN", MIDDLENAME="Q", NAMESUFFIX="JR", COUNTYCODE="5", AD="75", WARD="2", ED="1", SD="31", STATUS="ACTIVE",
         ENROLLMENT="REP", SBOEID="NY2", DOB="19560231", VoterHistory="P16", TOWNCITY="BROOKHAVEN", RADDNUMBER="1", RSTREETNAME="ELM", RCITY="TROY", RZIP5="12180"),
    dict(LASTNAME="GONE", COUNTYCODE="31", AD="75", WARD="9", ED="1", SD="28", STATUS="PURGED", ENROLLMENT="DEM", SBOEID="NY3"),
    dict(LASTNAME="FAR", COUNTYCODE="bad", AD="75", WARD="9", ED="1", SD="27", STATUS="ACTIVE", ENROLLMENT="DEM", SBOEID="NY4"),
]
AS_OF = date(2020, 4, 16)


@pytest.fixture(scope="module")
def voter_tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("voters")
    path = write(folder, "voters.csv", "\n".join(voter_line(**v) for v in VOTERS) + "\n")
    counties = spark.createDataFrame([(31, "New York"), (5, "Erie")], schemas.COUNTY_CODES)
    codes = [("P16", 1, "Presidential Primary", date(2016, 4, 19)), ("G16", 2, "General", date(2016, 11, 8))]
    warehouse.overwrite_table(counties, "Voter.CountyCodes")
    warehouse.overwrite_table(spark.createDataFrame(codes, schemas.ELECTION_CODES), "Voter.ElectionCodes")
    for _ in range(2):  # running again replaces the tables
        voter.load_voters(spark, path, F.lit(AS_OF))


def test_voter_tables(spark, voter_tables):
    assert spark.table("Voter.Raw").count() == 4
    assert sorted(spark.table("Voter.Raw").columns) == sorted(schemas.VOTER_RAW.names)
    assert rows(spark.table("Voter.Counts"), "COUNTYCODE") == [
        (None, None, None, 9, 1, "DEM", 1), (5, "Erie", None, 2, 1, "REP", 1), (31, "New York", 75, None, 1, "DEM", 2),
    ]
    formatted = spark.table("Voter.Formatted")
    assert [(f.name, f.dataType) for f in formatted.schema.fields] == [(f.name, f.dataType) for f in schemas.VOTER_FORMATTED.fields]
    got = {r["SBOEID"]: r for r in formatted.collect()}
    assert set(got) == {"NY1", "NY2", "NY4"}
    lydia = got["NY1"]
    assert (lydia["FullName"], lydia["County"], lydia["DateOfBirth"], lydia["Age"]) == ("Lydia Nieves", "New York", date(1956, 2, 27), 64)
    assert lydia["Address"] == "5210  BROADWAY APT 12E, MANHATTAN, NY 10463"
    assert (lydia["Prime"], lydia["FiveYearElections"], lydia["FiveYearPrimaries"]) == (True, 2, 1)
    assert (got["NY2"]["FullName"], got["NY2"]["Age"], got["NY2"]["DateOfBirth"]) == ("John Q O'Neil Jr", None, None)


def test_raw_table_keeps_the_declared_order(spark, voter_tables):
    assert spark.sql("SELECT * FROM Voter.Raw").columns == schemas.VOTER_RAW.names
    assert warehouse.run_example(spark, "voters_of_district", district=31).columns == schemas.VOTER_RAW.names
    assert spark.table("Voter.Rejected").count() == 0


def test_rejected_lines_and_encoding(spark, tmp_path):
    good = [voter_line(LASTNAME=name, COUNTYCODE="5") for name in ("PEÑA", "Ó'NEIL", "LEE")]
    bad = [voter_line(LASTNAME="A\0B"), "x," * ((1 << 20) + 1)]
    file = tmp_path / "voters.csv"
    file.write_bytes("\n".join([good[0], bad[0], good[1], bad[1], good[2]]).encode("latin-1"))
    lines = voter.read_encoded_lines(spark, str(file))
    written = voter.write_raw(lines, "Voter.OldRaw", "Voter.OldRejected")
    assert sorted(r["LASTNAME"] for r in written.collect()) == ["LEE", "PEÑA", "Ó'NEIL"]
    assert sorted((r["line"] in bad, r["reason"]) for r in spark.table("Voter.OldRejected").collect()) == [(True, "NUL"), (True, "too many fields")]


def test_overwrite_keeps_the_old_table_when_it_fails(spark):
    rows_ = spark.createDataFrame([(i, f"v{i % 3}") for i in range(90)], "b long, a string")
    name = "Voter.Staged"
    warehouse.overwrite_table(rows_, name, cluster_by="a")
    with pytest.raises(Exception):
        warehouse.overwrite_table(rows_.withColumn("b", F.when(F.col("b") == 89, F.raise_error(F.lit("broken"))).otherwise(F.col("b"))), name)
    assert spark.table(name).count() == 90 and spark.table(name).columns == ["b", "a"]
    for left in (60, 60):   # a table that replaces itself
        warehouse.overwrite_table(spark.table(name).where("a != 'v0'"), name)
        assert spark.table(name).count() == left
    warehouse.append_table(rows_.limit(1), name)
    assert spark.table(name).count() == 61
    versions = warehouse._versions_folder(spark, name)
    import os
    kept = [f for f in os.listdir(versions.removeprefix("file:")) if f.startswith("version-")]
    assert len(kept) == 3   # the present one, the one before, and the one that failed
    warehouse.overwrite_table(rows_.select("a"), name)
    assert spark.table(name).columns == ["a"] and spark.table(name).count() == 90


def test_lookups_by_schema_files(spark, tmp_path):
    from civicmill.plans.lookups import load_lookups
    from civicmill.sources.described import struct_of

    write(tmp_path, "CountyCodes.data.csv", '31,New York\nx,"Odd, one"\n')
    write(tmp_path, "CountyCodes.schema.json", '[\n {"name": "Code", "type": "integer"},\n {"name": "Name", "type": "string"}]')
    load_lookups(spark, str(tmp_path), {"Voter.OtherCounties": "CountyCodes"})
    table = spark.table("Voter.OtherCounties")
    assert table.schema == schemas.COUNTY_CODES and rows(table) == [(None, "Odd, one"), (31, "New York")]
    nested = struct_of([{"name": "a", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "b", "type": "float", "mode": "REQUIRED"}]}])
    assert nested.simpleString() == "struct<a:array<struct<b:double>>>" and not nested["a"].dataType.elementType["b"].nullable
    for odd in ([{"name": "a", "type": "shape"}], [{"name": "a", "type": "string", "mode": "MANY"}]):
        with pytest.raises(ValueError):
            struct_of(odd)


def test_voter_examples(spark, voter_tables):
    run = warehouse.run_example
    assert run(spark, "voter_by_name", name="Lydia Nieves", county="New York").first()["FiveYearElections"] == 2
    assert rows(run(spark, "enrollment_of_district", district=31)) == [("DEM", 1), ("REP", 1)]
    assert rows(run(spark, "overlapping_districts", district=75)) == [(27, 1), (31, 2)]
    assert [tuple(r) for r in run(spark, "turnout_of_election_type", town="BROOKHAVEN", district=1, type="Presidential Primary").collect()] == [
        ("DEM", date(2016, 4, 19), "Presidential Primary", 1), ("REP", date(2016, 4, 19), "Presidential Primary", 1),
    ]
    assert run(spark, "first_voters").count() == 3


def geo_line(**cells):
    line = [" "] * 400
    for name, start, end, _ in schemas.CENSUS_GEO_LAYOUT:
        text = str(cells.get(name, ""))[: end - start]
        line[start : start + len(text)] = text
    return "".join(line)


def wide_line(record, width, **cells):
    out = ["PL", "NY", "000", "01", str(record)] + ["0"] * (width - 5)
    for at, value in cells.items():
        out[int(at[1:])] = str(value)
    return ",".join(out)


def test_census_tables(spark, tmp_path):
    geo = [
        geo_line(SUMLEV=50, LOGRECNO=1, COUNTY=1, NAME="Albany County"), geo_line(SUMLEV=60, LOGRECNO=2, COUNTY=1, COUSUB=100, NAME="Berne town"),
        geo_line(SUMLEV=60, LOGRECNO=3, COUNTY=3, COUSUB=100, NAME="Other town"),
        geo_line(SUMLEV=710, LOGRECNO=4, COUNTY=1, COUSUB=100, VTD=7), geo_line(SUMLEV=710, LOGRECNO=5, COUNTY=3, COUSUB=100, VTD="ZZZZZZ"),
        geo_line(SUMLEV=710, LOGRECNO=6, COUNTY=9, COUSUB=9, VTD=8),
    ]
    geo_path = write(tmp_path, "geo", "\n".join(geo))
    part1 = write(tmp_path, "p1", "\n".join(wide_line(n, 149) for n in (1, 4, 77)))
    part2 = write(tmp_path, "p2", "\n".join([wide_line(4, 152, c76=100, c77=20, c80=30, c81=40, c149=9, c150=8, c151=1), wide_line(5, 150, c149=3)]))
    header = "YR,STATE,COUNTY,COUSUB,WARD,AD,ED,VTD08\n"
    write(tmp_path, "map/a.csv", header + "2010,36,1,100,,67,48,7\n2010,36,1,100,2,67,12,7\n")
    write(tmp_path, "map/b.csv", header + "2010,36,1,100,3,67,5,7\n2010,36,1,101,3,67,5,8\n")
    census.load_census(spark, geo_path, part1, part2, f"{tmp_path}/map")
    raw = spark.table("Census.Raw")
    assert raw.count() == 7 and spark.table("Census.RedistEquiv").count() == 4
    assert raw.where("LOGRECNO = 77 AND SUMLEV IS NULL AND P1_RACE IS NOT NULL").count() == 1
    table = spark.table("Census.VTDFormatted")
    assert table.schema.names == schemas.VTD_FORMATTED.names
    got = {r["LOGRECNO"]: r for r in table.collect()}
    assert set(got) == {4, 5, 6}
    assert tuple(got[4])[:13] == (1, "Albany County", 100, "Berne town", 4, 7, 100, 20, 30, 40, 9, 8, 1)
    assert sorted(tuple(e)[1:] for e in got[4]["ElectionDistricts"]) == [(67, 5), (67, 12), (67, 48)]
    assert (got[5]["CountyName"], got[5]["CousubName"], got[5]["TotalHousingUnits"], got[5]["VacantHousingUnits"]) == (None, "Other town", 3, None)
    assert [tuple(e) for e in got[6]["ElectionDistricts"]] == [(None, None, None)]
    assert warehouse.run_example(spark, "census_of_district", district=67).count() == 3


def test_results_tables(spark, tmp_path):
    write(tmp_path, "2000/20001107__ny__general.csv", "county,votes\nKings,5\n")
    results.load_results(spark, str(tmp_path), datetime(2020, 1, 1, tzinfo=timezone.utc))
    row = spark.table("Results.OpenElections").first()
    assert (row["county"], row["votes"], row["state"], row["scope"]) == ("Kings", 5, "NY", "general")
    assert row["filename"].endswith("/2000/20001107__ny__general.csv")
    curated = [("U.S. House", 1, c, p, "Suffolk", v, date(2016, 11, 8)) for c, p, v in
               [("Zeldin", "REP", 3.0), ("Zeldin", "CON", 4.0), ("Zeldin", None, 1.0), ("Void", "REP", 9.0), (None, "REP", 9.0)]]
    warehouse.overwrite_table(spark.createDataFrame(curated, schemas.RESULTS_CURATED), "Results.Curated")
    got = warehouse.run_example(spark, "results_of_county", county="Suffolk", day=date(2016, 11, 8))
    assert rows(got) == [("U.S. House", 1, "Zeldin", "CON, REP", 8.0)]


SEARCH = """<table><tr><th>Filer ID</th><th>Filer Name</th><th>Office</th><th>Dist</th></tr>
<tr><td><input type="SUBMIT" value="A1"/></td><td>ANN FOR NY</td><td>State Senator</td><td>22</td></tr></table>"""
FILER = 'Status = ACTIVE\nAuthorized Committee = FRIENDS OF ANN \n<a href="getfiler2_loaddates?filerid_in=C9">x</a>'
REPORT = """<table><tr><th>Contributor</th><th>Date</th><th>Amt</th><th>Filing Year</th><th>Report Code</th><th>Sched</th><th>Office</th></tr>
<tr><td>NIEVES LYDIA<br>5210 BROADWY<br>MANHATTAN, NY 10463</td><td>05-JAN-18</td><td>1,250.00</td><td>2018</td><td>K</td><td>A</td><td>typed</td></tr>
<tr><td>SOMEBODY<br>ELSE</td><td>06-JAN-18</td><td>10</td><td>2018</td><td>K</td><td>A</td><td>typed</td></tr>
<tr><td></td><td>Total Contributions Received</td><td>1,260.00</td><td></td><td></td><td></td><td></td></tr></table>"""


def test_finance_and_match_tables(spark, voter_tables):
    page = lambda *found: spark.createDataFrame(list(found), "FilerID string, html string")
    search = spark.createDataFrame([("u", SEARCH)], "url string, html string")
    reference = spark.createDataFrame(
        [("5210 BROADWY", "MANHATTAN", "NY", "5210 BROADWAY", "NEW YORK", "NY", "10463")],
        "address string, city string, state string, std_address string, std_city string, std_state string, std_zip5 string",
    )
    finance.load_finance(spark, search, page(("A1", FILER)), page(("A1", REPORT), ("C9", REPORT), ("Z9", REPORT)), reference)
    got = rows(spark.table("Finance.State").select(
        "FilerID", "Active", "Dist", "FilerCommittee", "Office", "Amt", "ContributorName", "ContributorAddr1", "ContributorAddr2", "Date", "FilingYear"), "FilerID", "Amt")
    shared = lambda f, c: [(f, "ACTIVE", 22, c, "State Senator", 10.0, "SOMEBODY\nELSE", None, None, date(2018, 1, 6), 2018),
                           (f, "ACTIVE", 22, c, "State Senator", 1250.0, "NIEVES LYDIA", "5210 BROADWAY", "NEW YORK, NY 10463", date(2018, 1, 5), 2018)]
    assert got == shared("A1", None) + shared("C9", "FRIENDS OF ANN")
    raised = warehouse.run_example(spark, "funds_raised", year=2016, office="State Senator", district=22)
    assert [r["Raised"] for r in raised.collect()] == ["$1,260", "$1,260"]

    matching.load_matches(spark)
    table = spark.table("Finance.Match")
    assert table.schema.names == schemas.MATCH.names and table.count() == 4
    hit = table.where("FilerID = 'A1' AND ratio IS NOT NULL").first()
    assert (hit["SBOEID"], hit["COUNTYVRNUMBER"], hit["TotalDonation"]) == ("NY1", "C1", 1250.0)
    assert hit["voter_match_string"] == "NIEVES LYDIA, 5210 BROADWAY APT 12E, MANHATTAN, NY 10463"
    miss = table.where("FilerID = 'A1' AND ratio IS NULL").first()
    assert (miss["SBOEID"], miss["voter_match_string"], miss["donor_match_string"]) == (None, None, None)
    voters = matching.voters_to_match(spark.table("Voter.Raw"), reference.select(
        F.lit("5210 BROADWAY APT 12E").alias("address"), "city", "state", "std_address", "std_city", "std_state", "std_zip5"))
    assert voters.where("SBOEID = 'NY1'").first()["match_string"] == "NIEVES LYDIA, 5210 BROADWAY, NEW YORK, NY 10463"


def test_races_and_years(spark):
    assert len(finance.OFFICE_CODES) - 1 == finance.office_codes(spark).select("Office").distinct().count() == 74
    races = spark.createDataFrame(finance.RACES, "office string, district string")
    got = finance.expand_races(races)
    assert got.count() == 8 + 63 and got.where("office = 'State Senator'").agg(F.max(F.col("district").cast("int"))).first()[0] == 63
    assert set(rows(got.where("office_code = '32'").select("district", "county"))) == {("3", "31"), ("6", "31")}
    assert finance.expand_races(spark.createDataFrame([("Comptroller", "*")], races.schema)).first()["office_code"] == "45"
    assert [r["year"] for r in finance.filing_years(races.limit(1)).collect()] == list(range(2012, 2019))


def test_news_table_appends(spark):
    item = lambda n: f"<item><title>T{n} é</title><link>http://a/{n}</link><pubDate>Tue, 03 Jul 2018 07:00:00 GMT</pubDate></item>"
    feed = lambda *ns: "<rss><channel>" + "".join(map(item, ns)) + "</channel></rss>"
    feeds = spark.createDataFrame([("Ann Lee", feed(1, 2)), ("Bo", feed(1)), ("No", feed())], "keyword string, feed string")
    pages = spark.createDataFrame([("http://a/1", "<body>Ann Lee is good. Café</body>"), ("http://a/3", "<p>x</p>")], "url string, html string")
    names = spark.createDataFrame([("Ann Lee", "http://w")], "name string, wikipedia_url string")
    terms = spark.createDataFrame([("good", 0.5)], "term string, polarity double")
    assert news.articles(feeds, pages).where("link = 'http://a/2'").first()["text"] is None
    for times in (1, 2):
        news.load_news(spark, feeds, pages, names, terms)
        table = spark.table("News.Semantic")
        assert table.count() == 2 * times
    row = table.where("keyword = 'Bo'").first()
    assert table.schema.names == schemas.NEWS.names
    assert (row["title"], row["url"], row["text"]) == ("T1 ?", "http://a/1", "Ann Lee is good. Caf?")
    assert row["pubdate"].isoformat()[:19] in ("2018-07-03T07:00:00",) and [tuple(e) for e in row["entities"]] == [("Ann Lee", 1.0, 0.5, 0.5, "http://w")]
    assert news.tag_landed(pages.withColumnRenamed("html", "text"), ["Ann Lee"]).count() == 1


def test_feed_files_are_tagged_and_unread_items_reported(spark, tmp_path):
    item = lambda n, title: f"<item><title>{title}</title><link>http://f/{n}</link><pubDate>Tue, 03 Jul 2018 07:00:00 GMT</pubDate></item>"
    (tmp_path / "all.xml").write_text(
        "<rss><channel>" + item(1, "Ann Lee wins") + item(2, "Other") + item(3, "a <b") + item(4, "Nobody") + "</channel></rss>")
    pages = spark.createDataFrame([("http://f/1", "<p>good Bo</p>"), ("http://f/2", "<p>By Ann Lee</p>"), ("http://f/4", "<p>x</p>")], "url string, html string")
    names = spark.createDataFrame([("Ann Lee", "http://w")], "name string, wikipedia_url string")
    terms = spark.createDataFrame([("good", 0.5)], "term string, polarity double")
    news.load_news_files(spark, str(tmp_path), pages, names, terms, ["Ann Lee", "Bo"], "News.Tagged", "News.Rejected")
    assert rows(spark.table("News.Tagged").select("keyword", "url")) == [("Ann Lee", "http://f/1"), ("Ann Lee", "http://f/2"), ("Bo", "http://f/1")]
    rejected = spark.table("News.Rejected").collect()
    assert len(rejected) == 1 and "http://f/3" in rejected[0]["item"] and rejected[0]["file"].endswith("all.xml")


def test_latest_page_counts(spark):
    items = spark.createDataFrame([("l1",), ("l2",), ("l3",)], "link string")
    pages = spark.createDataFrame(
        [("l1", "<p>old, but greater</p>", 1), ("l1", "<p>new</p>", 2), ("l1", "<p>undated</p>", None), ("l2", "<p>one</p>", 1), ("l2", "<p>one</p>", 1)],
        "url string, html string, landed long")
    found = news.with_page_text(items, pages)
    assert rows(found) == [("l1", "new"), ("l2", "one"), ("l3", None)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "max(" not in plan
    assert rows(news.with_page_text(items, pages.drop("landed")))[1:] == [("l2", "one"), ("l3", None)]


def test_lookup_files(spark, tmp_path):
    from civicmill.sources.csv_sets import read_lookup

    path = write(tmp_path, "levels.csv", '50,State-County\r\n60,"State-County-County Subdivision"\r\n')
    warehouse.overwrite_table(read_lookup(spark, path, schemas.SUMMARY_LEVELS), "Census.SummaryLevels")
    assert rows(spark.table("Census.SummaryLevels")) == [(50, "State-County"), (60, "State-County-County Subdivision")]
