"""Readers over small landed files."""

import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicmill import schemas
from civicmill.plans import results
from civicmill.sources import csv_sets, feeds, html_tables, lines, tables


def write(folder, name, text, encoding="utf-8"):
    path = os.path.join(str(folder), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


def test_delimited_lines(spark, tmp_path):
    kinds = schemas.schema((schemas.STRING, "name"), (schemas.LONG, "n"), (schemas.STRING, "town"))
    text = '"SMITH, J",5,"a ""b"""\n  pad , 7 ,\t\nx,bad,y\nshort\nlong,1,t,extra,more\n\nquoted,"","",z\n'
    path = write(tmp_path, "v.csv", text + "nul\0,1,x\n" + "y" * 140000 + ",1,x\n" + "b," + "1,x" + "," * 140000 + "\n")
    got = [tuple(r) for r in lines.parse_delimited(lines.read_lines(spark, path), kinds).collect()]
    assert got == [
        ("SMITH, J", 5, 'a "b"'), ("pad", 7, ""), ("x", None, "y"), ("short", None, None), ("long", 1, "t"),
        (None, None, None), ("quoted", None, ""), ("y" * 140000, 1, "x"), ("b", 1, "x"),
    ]


def test_fixed_width_lines(spark):
    df = spark.createDataFrame([("ab  12 x",), ("cd  ZZ",), ("",)], "value string")
    layout = [("s", 0, 2, schemas.STRING), ("n", 3, 7, schemas.LONG), ("t", 7, 9, schemas.STRING)]
    assert [tuple(r) for r in lines.parse_fixed_width(df, layout).collect()] == [("ab", 12, "x"), ("cd", None, ""), ("", None, "")]


def test_packed_ranges(spark):
    df = spark.createDataFrame([("a,b,1,2,3,4",), ("a,b,x,9",), ("a",)], "value string")
    got = lines.parse_ranges(df, 2, {"p": (3, 5), "q": (5, 7)})
    assert [tuple(r) for r in got.collect()] == [(1, "2,3", "4"), (None, "9", ""), (None, "", "")]
    cells = got.select(lines.packed_cell(F.col("p"), 1), lines.packed_cells(F.col("p")))
    assert [tuple(r) for r in cells.collect()] == [(3, [2, 3]), (None, [9]), (None, [None])]


def test_csv_set_and_encoded_lookup(spark, tmp_path):
    write(tmp_path, "set/a.csv", "YR,STATE,COUNTY,COUSUB,WARD,AD,ED,VTD08\n2010,36,1,2,,4,5,6\n")
    write(tmp_path, "set/b.csv", "YR,STATE,COUNTY,COUSUB,WARD,AD,ED,VTD08\n2010,36,1,2,3, 4 ,x,6\n")
    got = csv_sets.read_csv_set(spark, f"{tmp_path}/set", schemas.REDIST_EQUIV).orderBy("ED").collect()
    assert [tuple(r) for r in got] == [(2010, 36, 1, 2, 3, 4, None, 6), (2010, 36, 1, 2, None, 4, 5, 6)]
    path = write(tmp_path, "codes.csv", "3,Bronx\r\n24,Montréal", "latin-1")
    lookup = csv_sets.read_lookup(spark, path, schemas.COUNTY_CODES, encoding="ISO-8859-1")
    assert [tuple(r) for r in lookup.orderBy("Code").collect()] == [(3, "Bronx"), (24, "Montréal")]
    raw = csv_sets.read_encoded_lines(spark, path)
    assert [r[0] for r in raw.collect()] == ["3,Bronx", "24,Montréal"]
    path = write(tmp_path, "lines.txt", "a\x01b\n\né\nlast", "latin-1")
    assert [r[0] for r in csv_sets.read_encoded_lines(spark, path).collect()] == ["a\x01b", "", "é", "last"]


def test_rejected_lines_and_rows_are_all_lines(spark):
    long = "x" * 200_000
    df = spark.createDataFrame([(f"{long},2",), ("a\0b,1",), ("," * (1 << 20),), ("c,3",)], "value string")
    parsed = lines.parse_delimited(df, T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.LongType())]))
    assert sorted((len(r["a"]), r["b"]) for r in parsed.collect()) == [(1, 3), (200_000, 2)]
    assert sorted(r["reason"] for r in lines.rejected_lines(df).collect()) == ["NUL", "too many fields"]


def test_header_groups(spark, tmp_path):
    base = tmp_path / "master one"
    write(base, "2000/20001107__ny__general.csv", "county,office,votes,absentee\nKings,Mayor,\"1,234\",5\nBronx,Mayor,12,\n")
    write(base, "2000/20001108__ny__general{a}[1].csv", "county,office,votes,absentee\nErie,Clerk,7,8\n")
    write(base, "2001/20011399__ny__town.csv", "﻿votes,disctrict,district,county,absentee,absentee_hc,absentee_military_votes\r\n12.0,9,1,Lake,1,,3\r\n")
    write(base, "other/notes.csv", "affidavit,county,,affidavit_votes,county\n3,Nowhere,,4,Ulster\n")
    write(base, "county_matrix.csv", "county\nKept out\n")
    write(base, "2016/county_matrix.csv", "county\nOneida\n")
    write(base, "county_matrix.csv.v2.csv", "\ncounty\nMonroe\n")
    write(base, "readme.txt", "county\nNot a csv\n")
    loaded = datetime(2020, 1, 2, tzinfo=timezone.utc)
    rows = csv_sets.read_header_groups(spark, f"{base}", schemas.RESULTS, results.ALIASES, results.EXCLUDED)
    table = results.format_results(rows, loaded)
    assert table.schema.names == schemas.RESULTS.names
    got = {r["county"]: r for r in table.collect()}
    assert set(got) == {"Kings", "Bronx", "Erie", "Lake", "Ulster", "Oneida", "Monroe"}
    pick = lambda county, *names: tuple(got[county][n] for n in names)
    assert pick("Kings", "votes", "absentee_military_votes", "election_date", "state", "scope") == (None, 5, date(2000, 11, 7), "NY", "general")
    assert pick("Bronx", "votes", "absentee_military_votes") == (12, None)
    assert pick("Erie", "office", "election_date") == ("Clerk", date(2000, 11, 8))
    assert got["Erie"]["scope"] == "general{a}[1]"
    # The misspelled header wins over the right one, the later alias over the earlier, even when null.
    assert pick("Lake", "votes", "district", "absentee_military_votes", "election_date", "scope") == (None, "9", None, None, "town")
    assert pick("Ulster", "affidavit_votes", "state", "scope") == (3, None, None)


def test_line_ends_inside_quotes(spark, tmp_path):
    kinds = schemas.schema((schemas.STRING, "a"), (schemas.LONG, "b"))
    write(tmp_path, "m/x.csv", 'a,b\n"one\ntwo",3\n')
    assert [tuple(r) for r in csv_sets.read_csv_set(spark, f"{tmp_path}/m", kinds, multiline=True).collect()] == [("one\ntwo", 3)]
    got = csv_sets.read_header_groups(spark, f"{tmp_path}/m", kinds, multiline=True).collect()
    assert [(r["a"], r["b"]) for r in got] == [("one\ntwo", "3")]


def test_feed_files_are_cut_into_items(spark, tmp_path):
    item = lambda n, more="": f"<item>\n <title>T{n} é &amp; {more}</title>\n<link>http://a/{n}</link><media:x a='1'/><pubDate>d</pubDate>\n"
    many = "".join(item(n) + "</item>\n" for n in range(3000))
    (tmp_path / "a.xml").write_text(f"<rss xmlns:media='m'><channel><title>items &lt;item></title>{many}</channel></rss>", encoding="utf-8")
    odd = [item(9001) + "</item>", item(9002, "<b>") + "</item>", "<item/>", item(9003), item(9004) + "</item>", "<items>x</items>",
           "<item a='1'><title><![CDATA[<b>]]></title></item>", "<item></item>", "<item><title>cut"]
    (tmp_path / "b.xml").write_text("<rss><channel>" + "".join(odd), encoding="utf-8")
    (tmp_path / "c.xml").write_text("")
    read = lambda: feeds.read_feed_items(spark, str(tmp_path)).withColumn("file", F.substring_index("file", "/", -1))
    got = read().where("file = 'a.xml'").collect()
    assert sorted(r["link"] for r in got) == sorted(f"http://a/{n}" for n in range(3000)) and got[0]["title"].endswith("? &")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        split = read()
        assert split.rdd.getNumPartitions() > 20 and sorted(split.collect(), key=str) == sorted(read().collect(), key=str)
        assert sorted(map(str, split.where("file = 'a.xml'").collect())) == sorted(map(str, got))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rest = read().where("file <> 'a.xml'").collect()
    assert sorted((r["title"] or "", r["link"] or "") for r in rest if r["unread"] is None) == [("", ""), ("<b>", ""), ("T9001 ? &", "http://a/9001")]
    unread = sorted(r["unread"] for r in rest if r["unread"])
    assert len(unread) == 3 and "T9002" in unread[0] and "T9003" in unread[1] and "T9004" in unread[1] and "cut" in unread[2]


def test_rss(spark):
    feed = "<rss><channel><item><title>A &amp; é</title><link>u</link><pubDate>d</pubDate></item><item><link>w</link></item></channel></rss>"
    df = spark.createDataFrame([("k", feed), ("none", "<rss><channel></channel></rss>")], "keyword string, feed string")
    got = [tuple(r) for r in feeds.rss_items(df).collect()]
    assert got == [("k", "A & ?", "u", "d"), ("k", None, "w", None)]
    bad = spark.createDataFrame([("bad", feed[:-20])], df.schema)
    with pytest.raises(Exception, match="MALFORMED"):
        feeds.rss_items(bad).collect()


HEAD = "<tr><th>Filer Name</th><th>Id</th></tr>"


def found(spark, html, **options):
    df = spark.createDataFrame([("p", html)], "page string, html string")
    return [(r["row_no"], r["cells"]) for r in html_tables.html_table_rows(df, **options).orderBy("row_no").collect()]


def test_largest_table_wins_and_the_last_of_equals(spark):
    table = lambda v: f"<table>{HEAD}<tr><td>{v}</td><td>1</td></tr></table>"
    assert found(spark, "<table><tr><td>x</td></tr></table>" + table("a") + table("b")) == [(0, {"FilerName": "b", "Id": "1"})]
    nested = f"<table><tr><td><table>{HEAD}<tr><td>in</td><td>2</td></tr></table></td></tr></table>"
    assert found(spark, nested) == [(0, {"FilerName": "in", "Id": "2"})]
    assert found(spark, "<p>no table</p>") == [] and found(spark, "<table><tr><td>no heading</td></tr></table>") == []


def test_table_rows_buttons_and_totals(spark):
    button = '<tr><td><form><input type="SUBMIT" value="A123"/></form></td><td>x</td></tr>'
    direct = '<tr><td><input type="SUBMIT" value="A124"/></td><td>y &amp; z</td></tr>'
    html = f"<table>{HEAD}{direct}<tr><td>one cell</td></tr><tr><td>s</td><td>Total</td></tr><tr><td>a<br>b<td>open</table>"
    got = found(spark, html, separator="|", button="FilerID", total="Total")
    assert got == [(0, {"FilerID": "A124", "Id": "y & z"}), (2, {"FilerName": "a|b", "Id": "open"})]
    assert found(spark, f"<table>{HEAD}{button}</table>", button="FilerID")[0][1]["Id"] == "x"


def test_tables_as_sources(spark):
    tables.seed_rows(spark, [("Governor", "")], "office string, district string").createOrReplaceTempView("seeds")
    assert tables.read_table(spark, "seeds").count() == 1
    assert tables.read_query(spark, "SELECT office FROM seeds WHERE district = :d", d="").first()[0] == "Governor"
