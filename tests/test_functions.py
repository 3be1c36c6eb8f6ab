"""Casts, names, addresses, dates, text and similarity on hand-made rows."""

import random
from datetime import date

import numpy as np
from pyspark.sql import functions as F

from civicmill.functions import casts, people, similarity as sim, text
from civicmill.schemas import DATE, DOUBLE, LONG, STRING, schema


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_to_long_takes_what_an_integer_parser_takes(spark):
    values = [" 5 ", "\t7\n", "+3", "-2", "5.0", "1,234", "", "x", None, "9" * 30]
    assert column(spark, values, casts.to_long) == [5, 7, 3, -2, None, None, None, None, None, None]


def test_to_double_rejects_java_spellings(spark):
    values = ["1.5", " .5 ", "1e3", "5.", "5d", "0x1p3", "1,0", "", "-inf"]
    assert column(spark, values, casts.to_double) == [1.5, 0.5, 1000.0, 5.0, None, None, None, None, float("-inf")]


def test_amount_drops_commas(spark):
    assert column(spark, ["1,250.00", "7", "n/a", None], casts.amount) == [1250.0, 7.0, None, None]


def test_conform_pads_casts_and_requires(spark):
    df = spark.createDataFrame([(" a ", "3", "x", "2018-02-30")], "s string, n string, d string, day string")
    row = casts.conform(df, schema((STRING, "s"), (LONG, "n"), (DOUBLE, "d"), (DATE, "day"), (STRING, "gone"))).first()
    assert tuple(row) == ("a", 3, None, None, None)


def test_title_case_follows_any_non_letter(spark):
    assert column(spark, ["O'NEIL", "SMITH-JONES", "3RD", "élan vital", ""], people.title_case) == [
        "O'Neil", "Smith-Jones", "3Rd", "Élan Vital", "",
    ]


def test_full_name_squeezes_once(spark):
    df = spark.createDataFrame(
        [("JOHN", "", "O'NEIL", "JR"), ("ANN", None, "LEE", None), (None, None, "X", None), ("A", "", "", "B")],
        "f string, m string, l string, s string",
    )
    names = [r[0] for r in df.select(people.full_name(*[F.col(c) for c in "fmls"])).collect()]
    # Three neighbouring blanks become two: the squeeze is one pass.
    assert names == ["John O'Neil Jr", "Ann Lee", "X", "A  B"]


def test_addresses(spark):
    rows = [
        ("12", "", "W", "MAIN ST", "", "12E"), ("12", "1/2", "", "main st", "N", ""), ("12", None, None, "MAIN ST", None, None),
        ("12", "", "", "MAIN ST", "", "apt 3"), ("12", "", "", "MAIN ST", "", "UNIT 4"), ("12", "", "", "MAIN ST", "", "PH2"),
    ]
    df = spark.createDataFrame(rows, "n string, h string, pre string, st string, post string, unit string")
    c = F.col
    got = df.select(
        people.residence_address(c("n"), c("h"), c("pre"), c("st"), c("post"), c("unit"), F.lit("Troy"), F.lit("12180")).alias("full"),
        people.street_address(c("n"), c("h"), c("pre"), c("st"), c("post"), F.lit("Troy"), F.lit("12180")).alias("street"),
        people.match_address(c("n"), c("st"), c("unit")).alias("match"),
    ).collect()
    tail = ", Troy, NY 12180"
    assert [r["full"] for r in got] == [
        "12 W MAIN ST APT 12E" + tail, "12 1/2 MAIN ST N" + tail, "12  MAIN ST" + tail,
        "12  MAIN ST APT 3" + tail, "12  MAIN ST UNIT 4" + tail, "12  MAIN ST APT PH2" + tail,
    ]
    assert got[0]["street"] == "12  W MAIN ST" + tail
    assert [r["match"] for r in got] == [
        "12 MAIN ST APT 12E", "12 main st ", "12 MAIN ST ", "12 MAIN ST APT apt 3", "12 MAIN ST UNIT 4", "12 MAIN ST PH2",
    ]


def test_dates(spark):
    assert column(spark, ["19560227", "19560231", "195602271200", "", "abc", "00000101"], people.compact_date) == [
        date(1956, 2, 27), None, date(1956, 2, 27), None, None, None,
    ]
    assert column(spark, ["05-JAN-18", "5-Feb-72", "31-FEB-18", "05-JAN-68", None], people.report_date) == [
        date(2018, 1, 5), date(1972, 2, 5), None, date(2068, 1, 5), None,
    ]


def test_age_and_recency_count_365_day_years(spark):
    as_of = F.lit(date(2020, 6, 30))
    days = [date(2019, 7, 1), date(2019, 6, 30), date(2021, 1, 1), date(2015, 7, 2), date(2015, 7, 1), None]
    assert column(spark, days, lambda d: people.age(d, as_of), "date") == [1, 1, -1, 5, 5, None]
    assert column(spark, days, lambda d: people.is_recent(d, as_of), "date") == [True, True, True, False, False, None]


def test_contributor_and_city(spark):
    blocks = ["A\nB\nC", "\nA\nB\nC\n", "A\nB", "A\nB\nC\nD"]
    df = spark.createDataFrame([(b,) for b in blocks], "b string")
    got = [tuple(r) for r in df.select(*people.contributor_parts(F.col("b"))).collect()]
    assert got == [("A", "B", "C"), ("A", "B", "C"), ("A\nB", None, None), ("A\nB\nC\nD", None, None)]
    assert column(spark, ["New York, NY 10001", "Troy NY", "Troy"], people.city_of) == ["New York", "Troy", "Troy"]


def test_visible_text(spark):
    page = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>top</header>"
        "<!-- no <b>x</b> --><script>if (a<b) '</p>'</script><p>One<b>two</b> &amp; &lt;3\n\n 1 < 2</p></body>"
    )
    assert column(spark, [page, None, "<p>&amp;lt;</p>"], text.visible_text) == ["top One two & <3 1 < 2", None, "&lt;"]


def test_ascii_text_truncates_and_replaces(spark):
    got = column(spark, ["aé漢😀b", "x" * 70000], text.ascii_text)
    assert got[0] == "a???b" and len(got[1]) == 70000
    assert len(column(spark, ["x" * 70000], lambda c: text.ascii_text(c, 65536))[0]) == 65536


def test_references_and_parts_left_open(spark):
    pages = ["a &mdash; &#8217;&eacute;&#x27;&nbsp;b<script>x", "c<!-- d", "e <style>f</style>&amp;lt;", None]
    assert column(spark, pages, text.visible_text) == ["a \u2014 \u2019é' b", "c", "e &lt;", None]


def test_feed_time(spark):
    got = column(spark, ["Tue, 03 Jul 2018 07:00:00 GMT", "Tue, 3 Jul 2018 07:00:00 GMT", "yesterday", None], lambda c: F.unix_timestamp(text.feed_time(c)))
    assert got == [1530601200, 1530601200, None, None]


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above = 0
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], above + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def words(seed, count, letters, longest):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, longest))) for _ in range(count)]


def test_kernel_equals_the_textbook_table():
    for letters, longest in (("ab", 10), ("abcdefgh", 70), ("abcdefghijklmnop é漢", 200)):
        a, b = words(1, 300, letters, longest), words(2, 300, letters, longest)
        left, a_len = sim.encode(a)
        right, b_len = sim.encode(b)
        index = np.arange(300)
        truth = np.array([slow_lcs(x, y) for x, y in zip(a, b)])
        assert (sim.lcs_lengths(left, right, index, index) == truth).all()
        need = sim.needed(a_len + b_len, 70)
        pruned = sim.lcs_lengths(left, right, index, index, need)
        good = truth >= need
        assert (pruned[good] == truth[good]).all() and (pruned[~good] < need[~good]).all()
        shared = ["prefix9 x" + s for s in a], ["prefix9 x" + s for s in b]
        ours = sim.lcs_lengths(sim.encode(shared[0])[0], sim.encode(shared[1])[0], index, index, None, 9)
        assert (ours == truth + 9).all()


def test_shared_letters_bound_the_lcs():
    for letters, longest in (("ab", 12), ("abcdefgh é漢", 60), ("a", 0)):
        a, b = words(3, 50, letters, longest), words(4, 60, letters, longest)
        bound = sim.shared_letters(sim.encode(a)[0], sim.encode(b)[0])
        exact = [[sum(min(x.count(c), y.count(c)) for c in set(x)) for y in b] for x in a]
        assert (bound == np.array(exact)).all()
        assert all(bound[i, j] >= slow_lcs(x, y) for i, x in enumerate(a) for j, y in enumerate(b))


def test_threshold_sits_on_rounding():
    for total in range(1, 500):
        least = sim.needed(total, 70)
        assert sim.rounded_score(np.array(least), np.array(total)) >= 70
        assert sim.rounded_score(np.array(least - 1), np.array(total)) < 70


def similarity_builtin(a, b):
    """The same score from SQL functions alone; slow, kept as a cross-check."""
    letters, width = F.split(a, ""), F.length(b)
    blank = F.array_repeat(F.lit(0), width + 1)

    def next_row(row, letter):
        cell = lambda line, j: F.when(
            F.substring(b, j, 1) == letter, F.get(row, j - 1) + 1
        ).otherwise(F.greatest(F.get(row, j), F.element_at(line, -1)))
        start = F.array(F.lit(0))
        return F.aggregate(F.sequence(F.lit(1), width), start, lambda line, j: F.concat(line, F.array(cell(line, j))))

    lcs = F.element_at(F.aggregate(letters, blank, next_row), -1)
    total = F.length(a) + F.length(b)
    score = F.floor((400 * lcs + total) / (2 * total)).cast("long")
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0).cast("long")).otherwise(score)


def test_similarity_column(spark):
    pairs = [("kitten", "sitting"), ("same", "same"), ("", "x"), (None, "x"), ("abc", "xyz"), ("x" * 3000 + "y", "x" * 3000)]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select(sim.similarity("a", "b").alias("s"), similarity_builtin(F.substring("a", 1, 60), F.substring("b", 1, 60)).alias("t"))
    rows = got.collect()
    assert [r["s"] for r in rows] == [62, 100, 0, None, 0, 100]
    assert [r["t"] for r in rows][:5] == [62, 100, 0, None, 0]
