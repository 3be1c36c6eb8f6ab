"""Joins, merge, nesting, history counters, matching and entities against brute force."""

import random
import re
from datetime import date

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from civicmill.functions import similarity
from civicmill.operators import entities, history, lookup, match, merge, rollup, sizes
from tests.test_functions import slow_lcs


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_size_check(spark):
    df = spark.range(10)
    assert sizes.is_small(df) and sizes.is_small(df.where("id < 0"))
    assert not sizes.is_small(df, rows=9) and not sizes.is_small(df, size=20)


@pytest.fixture(params=["32m", "-1"])
def join_bound(spark, request):
    """Lookups broadcast when small, or always shuffled."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, request.param)
    yield request.param
    for name in names:
        spark.conf.set(name, before[name])


def test_left_lookup_keeps_rows_and_takes_one_value(spark, join_bound):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (9, "e")], "k int, v string")
    codes = spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (None, "n")], "Code int, Name string")
    got = lookup.left_lookup(df, codes, {"k": "Code"}, {"name": "Name"})
    assert rows(got, "v") == [(1, "a", "y"), (1, "b", "y"), (2, "c", None), (None, "d", None), (9, "e", None)]
    joined = got.join(got, "k")  # no leftover columns that would be ambiguous
    assert joined.columns == ["k", "v", "name", "v", "name"]


def test_overriding_and_expanding(spark, join_bound):
    filers = spark.createDataFrame([("A", None, 5), ("B", "bee", 6)], "id string, name string, dist int")
    given = spark.createDataFrame([("A", "typed", 1), ("C", "typed", 2)], "id string, name string, amt int")
    assert rows(lookup.attach_overriding(given, filers, "id").select("id", "name", "dist", "amt")) == [("A", None, 5, 1)]
    extra = spark.createDataFrame([("A", "C1", "Friends")], "id string, cid string, cname string")
    got = lookup.expand_with(filers, extra, "id", {"id": "cid", "name": "cname"})
    assert rows(got) == [("A", None, 5), ("B", "bee", 6), ("C1", "Friends", 5)]


def test_merge_records(spark):
    a = spark.createDataFrame([(1, "a1", 10), (2, "a2", 20), (2, "a9", 21), (None, "an", 30)], "k int, name string, x int")
    b = spark.createDataFrame([(2, 7), (3, 8), (None, 9)], "k int, y int")
    c = spark.createDataFrame([(1, None, 1), (4, "c4", 4)], "k int, name string, z int")
    assert rows(merge.merge_records([a, b, c], "k"), "k") == [
        (None, "an", 30, 9, None), (1, None, 10, None, 1), (2, "a9", 21, 7, None), (3, None, None, 8, None), (4, "c4", None, None, 4),
    ]


@pytest.mark.parametrize("copies", [1, 500])
def test_nesting_keeps_one_row_per_parent(spark, copies):
    df = spark.createDataFrame([(1, "one", 100), (2, "two", 10), (3, "three", 1), (None, "none", 1000)], "k int, label string, measure int")
    pairs = [(1, i % 4, None) for i in range(23 * copies)] + [(2, 5, 6)] + [(7, 0, 0)] + [(None, 9, 9)] * 200
    many = spark.createDataFrame(pairs, "code int, ward int, ed int")
    nested = merge.nest_many(df, many, {"k": "code"}, {"WARD": "ward", "ED": "ed"}, "items")
    assert nested.agg({"measure": "sum"}).first()[0] == 1111
    got = {r["k"]: r["items"] for r in nested.collect()}
    assert len(got) == 4 and len(got[1]) == 23 * copies
    assert [tuple(i) for i in got[2]] == [(5, 6)]
    assert [tuple(i) for i in got[3]] == [tuple(i) for i in got[None]] == [(None, None)]


def test_conditional_counts(spark):
    df = spark.createDataFrame([(3, 7, 1, "x"), (3, 7, 2, "x"), (5, 7, 1, "x"), (None, 7, 1, None), (None, 8, 1, None)], "c int, ad int, ward int, p string")
    got = rollup.conditional_counts(df, "c", [3, 24], ["ad"], ["ward"], ["c", "p"], "n")
    assert rows(got) == [(None, 1, None, None, 2), (None, 1, 5, "x", 1), (7, None, 3, "x", 2)]


def test_joined_values(spark):
    df = spark.createDataFrame([("a", "REP", 1), ("a", "CON", 2), ("a", "REP", 3), ("a", None, 4), ("b", None, 5)], "k string, p string, v int")
    assert rows(rollup.joined_values(df, ["k"], "p", "ps", total="v")) == [("a", "CON, REP, REP", 10), ("b", "", 5)]
    assert rollup.joined_values(df.where("false"), ["k"], "p", "ps").count() == 0


def test_joined_values_beyond_a_string_are_refused(spark):
    counted = spark.createDataFrame([("a", "REP", 3, 1), ("a", None, 2, 2), ("b", "CON", 3_000_000_000, 5)], "k string, p string, n long, v int")
    fits = rollup.joined_counts(counted.where("k = 'a'"), ["k"], "p", "n", "ps", "", total="v")
    assert rows(fits) == [("a", "REPREPREP", 3)]
    with pytest.raises(Exception, match="take 15000000000 bytes"):
        rollup.joined_counts(counted, ["k"], "p", "n", "ps").collect()


CODES = [
    ("G1", 1, "General", date(2018, 11, 6)), ("P1", 2, "Presidential Primary", date(2016, 4, 19)), ("OLD", 3, "Primary", date(2009, 1, 1)),
    ("NODATE", 4, "Primary", None), ("NOTYPE", 5, None, date(2017, 1, 1)), ("DUP", 6, "General", date(2001, 1, 1)), ("DUP", 6, "Primary", date(2019, 1, 1)),
    ("", 7, "Primary", date(2019, 1, 1)), ("LATER", 8, "Primary", date(2030, 1, 1)),
]


@pytest.mark.parametrize("form", [history.count_history, history.count_history_by_join])
def test_history_counters(spark, form):
    codes = spark.createDataFrame(CODES, "Election string, Num long, Type string, Date date")
    given = ["G1;P1;;P1", "OLD;NODATE;NOWHERE", "NOTYPE", "DUP", "", None, ";", "LATER", "G1;P1;;P1"]
    df = spark.createDataFrame(list(enumerate(given)), "i int, VoterHistory string")
    got = form(df, codes, F.lit(date(2020, 1, 1))).orderBy("i").select("FiveYearElections", "FiveYearPrimaries", "Prime").collect()
    assert [tuple(r) for r in got] == [
        (3, 2, True), (0, 0, False), (1, 0, False), (1, 1, True), (0, 0, False), (0, 0, False), (0, 0, False), (1, 1, True), (3, 2, True),
    ]


def test_code_tables_of_any_size_are_joined(spark):
    codes = spark.createDataFrame(CODES, "Election string, Num long, Type string, Date date")
    df = spark.createDataFrame([(1, "G1;P1")], "i int, VoterHistory string")
    got = history.count_history_by_join(df, codes, F.lit(date(2020, 1, 1)))
    assert tuple(got.select("FiveYearElections", "FiveYearPrimaries").first()) == (2, 1)
    assert "Join" in got._jdf.queryExecution().executedPlan().toString()


def test_code_tables_beyond_the_size_check_are_refused(spark):
    codes = spark.range(sizes.BROADCAST_ROWS + 1).selectExpr("concat('E', id) Election", "id Num", "'General' Type", "date'2019-01-01' Date")
    df = spark.createDataFrame([(1, "E1;E2")], "i int, VoterHistory string")
    with pytest.raises(ValueError, match="count_history_by_join"):
        history.count_history(df, codes, F.lit(date(2020, 1, 1)))


def backing_off(donor, voters, threshold=70):
    """The definition, literally: lengths 8 to 1, best score, smallest id."""
    for length in range(8, 0, -1):
        best = None
        for text, ident in voters:
            if text[:length] == donor[:length] and text and donor:
                total = len(text) + len(donor)
                score = (400 * slow_lcs(donor, text) + total) // (2 * total)
                if score >= threshold and (best is None or (-score, ident) < best[0]):
                    best = ((-score, ident), text)
        if best:
            return best[1], best[0][1], -best[0][0]
    return None


def noisy(rng, text):
    out = list(text)
    for _ in range(rng.randint(0, 6)):
        at = rng.randrange(len(out) + 1)
        if rng.random() < 0.5 and out:
            del out[min(at, len(out) - 1)]
        else:
            out.insert(at, rng.choice("ab cd"))
    return "".join(out)


@pytest.mark.parametrize("tile, lengths", [(3, (8, 4, 2, 1)), (5, (8, 7, 6, 5, 4, 3, 2, 1)), (2048, (1,)), (2048, (8, 4, 1))])
def test_best_match_equals_backing_off(spark, tile, lengths):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcd ") for _ in range(rng.randint(1, 24))) for _ in range(40)] + ["abcd abcd hot"] * 20
    voters = [(noisy(rng, t), f"{i:03d}") for i, t in enumerate(base)] + [("abcd abcd hot", "900"), ("abcd abcd hot", "100"), ("", "000")]
    donors = [noisy(rng, rng.choice(base)) for _ in range(60)] + ["abcd abcd hot", "zzzz", "", "a", "abc"]
    d = spark.createDataFrame([(t,) for t in donors + donors], "text string")
    v = spark.createDataFrame(voters, "text string, id string")
    found = match.best_matches(d, v, "text", "text", "id", tile=tile, block_lengths=lengths).collect()
    got = {r["donor"]: (r["voter"], r["voter_id"], r["score"]) for r in found}
    assert len(got) == len(found)
    want = {t: backing_off(t, voters) for t in donors}
    assert got == {t: w for t, w in want.items() if w}
    assert len(got) > 20


def test_scores_at_the_threshold(spark):
    # 2 * 7 / 20 is 70 exactly; 2 * 8 / 23 is 69.57 and rounds up; 2 * 9 / 26 is 69.2 and fails.
    pairs = [("abcdefgXYZ", "abcdefg123"), ("bbcdefghXYZ", "bbcdefgh1234"), ("cbcdefghiXYZV", "cbcdefghi1234")]
    d = spark.createDataFrame([(a,) for a, _ in pairs], "t string")
    v = spark.createDataFrame([(b, i) for i, (_, b) in enumerate(pairs)], "t string, id long")
    assert {r["donor"]: r["score"] for r in match.best_matches(d, v, "t", "t", "id").collect()} == {pairs[0][0]: 70, pairs[1][0]: 70}


def test_entities(spark):
    articles = spark.createDataFrame(
        [(1, "Ann Lee won. Good day for Ann Lee! Bad BAD Bo; bo's"), (2, ""), (3, None), (4, "nothing here"), (5, "Bo")], "id int, text string"
    )
    names = spark.createDataFrame([("Ann Lee", "http://w/a"), ("Bo", None)], "name string, wikipedia_url string")
    terms = spark.createDataFrame([("good", 1.0), ("bad", -0.5), ("won", 0.25)], "term string, polarity double")
    got = entities.entity_sentiment(articles, names, terms, longest=2).orderBy("id").collect()
    assert [(r["id"], [tuple(e) for e in r["entities"]]) for r in got] == [
        (1, [("Ann Lee", 2 / 3, 0.625, 1.25, "http://w/a"), ("Bo", 1 / 3, -0.5, 0.5, None)]), (4, []), (5, [("Bo", 1.0, 0.0, 0.0, None)]),
    ]


def test_salience_bound_is_exclusive_and_both_ways_agree(spark):
    articles = spark.createDataFrame([(1, "x " * 999 + "y"), (2, "x_y bad. 'Tis bad É é x! y z"), (3, "z")], "id int, text string")
    names = spark.createDataFrame([("x", None), ("y", "u"), ("É é", "v"), (None, "w")], "name string, wikipedia_url string")
    terms = spark.createDataFrame([("bad", -0.5), ("x", 1.0), ("'tis", 0.25)], "term string, polarity double")
    nested = entities.entity_sentiment(articles, names, terms, longest=2)
    flat = nested.select("id", F.inline("entities"))
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
    plain = sorted(map(tuple, flat.collect()), key=str)
    assert [r[1:3] for r in plain if r[0] == 1] == [("x", 0.999)]
    joined = entities.score_entities_by_join(articles, names, terms, "id", longest=2)
    assert plain == sorted(map(tuple, joined.collect()), key=str)


def test_large_vocabularies_are_refused_by_the_broadcast_form(spark, monkeypatch):
    monkeypatch.setattr(entities, "is_small", lambda df: False)
    empty = spark.createDataFrame([], "name string, wikipedia_url string, term string, polarity double, text string")
    with pytest.raises(ValueError, match="score_entities_by_join"):
        entities.entity_sentiment(empty, empty, empty)


@pytest.mark.parametrize("few", [-1, 50])
def test_keywords(spark, few):
    df = spark.createDataFrame([(1, "Ann met Bo"), (2, "nobody"), (3, None)], "id int, text string")
    got = entities.keyword_articles(df, ["Ann", "Bo", "bo", "Bo"], few=few).select("keyword", "id")
    assert rows(got, "id", "keyword") == [("Ann", 1), ("Bo", 1), ("bo", 2)]
    assert entities.keyword_articles(df, [], few=few).count() == 0
    assert rows(entities.keyword_articles(df, ["", "zz"], few=few).select("keyword", "id")) == [("", 1), ("", 2)]


def test_many_keywords_equal_a_search_for_each(spark):
    rng = random.Random(5)
    word = lambda least, most: "".join(rng.choice("ab. (é😀") for _ in range(rng.randint(least, most)))
    keywords = [word(1, 6) for _ in range(2000)] + ["a", "ab", "aba", "\n", "\\"]
    texts = [word(0, 60) for _ in range(200)] + ["", None, "x\ny\\", "ab" * 30_000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {tuple(r) for r in entities.keyword_articles(df, keywords).select("keyword", "id").collect()}
    assert got == {(k, i) for i, t in enumerate(texts) if t is not None for k in keywords if k in t}


def test_donors_are_sent_only_where_their_length_can_match(spark):
    rng = random.Random(3)
    # strings of one block, from very short to very long
    word = lambda n: "S" + "".join(rng.choice("ABCDE ") for _ in range(n - 1))
    voters = sorted({word(rng.choice((4, 5, 9, 20, 21, 60, 61, 140))) for _ in range(130)})
    donors = sorted({v[:-2] + "xy" if rng.random() < 0.5 else word(len(v)) for v in voters} | {word(900), word(2)})
    d = spark.createDataFrame([(t,) for t in donors], "donor string")
    v = spark.createDataFrame([(t, i) for i, t in enumerate(voters)], "voter string, voter_id long")
    sides = {}
    keep = match._tiled
    def noted(side, own, other, *rest):
        sides[own] = keep(side, own, other, *rest)
        return sides[own]
    match._tiled = noted
    try:
        got = match._one_pass(d, v, 1, None, 70, 8, 24).collect()
    finally:
        match._tiled = keep
    best = {}
    for a in donors:
        for i, b in enumerate(voters):
            lcs = slow_lcs(a, b)
            total = len(a) + len(b)
            score = (400 * lcs + total) // (2 * total)
            level = next((k for k in range(min(8, len(a), len(b))) if a[k] != b[k]), min(8, len(a), len(b)))
            if score >= 70:
                best[a] = min(best.get(a, (1, 0, 0)), (-level, -score, i))
    assert {r["donor"]: (-r["level"], -r["score"], r["voter_id"]) for r in got} == best
    sent = {k: s.count() for k, s in sides.items()}
    tiles = sides["voter"].select("voter_tile").distinct().count()
    assert sent["donor"] < 0.7 * len(donors) * tiles
    lengths = sides["donor"].select(F.length("donor").alias("n"), "slot", "donor_tile", "voter_tile").distinct().join(
        sides["voter"].select(F.length("voter").alias("m"), "slot", "donor_tile", "voter_tile"), ["slot", "donor_tile", "voter_tile"])
    per_tile = lengths.groupBy("slot", "donor_tile", "voter_tile").agg(
        F.max((400 * F.least("n", "m") >= 139 * (F.col("n") + F.col("m"))).cast("int")).alias("some")).collect()
    assert per_tile and all(r["some"] for r in per_tile)
    assert sides["donor"].where(F.length("donor") == 900).count() == 0


def test_blocks_without_a_new_pair_are_left_out(spark):
    """A pass over blocks whose strings all share what the pass before looked at does nothing."""
    d = spark.createDataFrame([("red ring 0123",), ("red bolt 4567",), ("bluebell 89",)], "donor string")
    v = spark.createDataFrame([("red ring 0124", 1), ("red bolt 45", 2), ("red", 3), ("bluebell 88", 4)], "voter string, voter_id long")
    longer = v.where("voter_id != 3")
    assert match._one_pass(d, longer, 1, 4, 70, 8, 2) is None
    # "red" has less than four characters, so its pairs are new in the block "r", and in no other
    lengths = match._lengths(*(df.withColumn("block", F.substring(n, 1, 1)) for df, n in ((d, "donor"), (v, "voter"))), 4)
    got = sorted(tuple(r) for r in lengths.select("block", "length", "donors", "voters", "donors_before", "voters_before").collect())
    assert got == [("r", 3, 0, 1, 0, 0), ("r", 11, 0, 1, 0, 1), ("r", 13, 2, 1, 0, 2)]
    settled = d.limit(0).selectExpr("donor", "donor AS voter", "1L AS voter_id", "1 AS level", "70L AS score")
    near = spark.createDataFrame([("rex bolt 4567", 7)], v.schema)
    got = match._one_pass(d, longer.unionByName(near), 1, 4, 70, 8, 2, settled).collect()
    assert [tuple(r) for r in got] == [("red bolt 4567", "rex bolt 4567", 7, 2, 92)]


def test_a_pass_takes_few_jobs(spark):
    """What the driver holds grows with the jobs, joins and tasks of a pass, not with the rows."""
    rng = random.Random(6)
    word = lambda n: "S" + "".join(rng.choice("ABCDE ") for _ in range(n))
    d = spark.createDataFrame([(word(n % 9 + 9),) for n in range(300)], "donor string")
    v = spark.createDataFrame([(word(n % 9 + 9), n) for n in range(300)], "voter string, voter_id long")
    context = spark.sparkContext
    context.setJobGroup("one pass", "one pass")
    try:
        found = match._one_pass(d, v, 1, None, 70, 8, 8)
        jobs = len(context.statusTracker().getJobIdsForGroup("one pass"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert jobs <= 12 and text.count("Join") == 2
    # 2,812 tasks with tiles of 8 strings; larger tiles make fewer
    assert max(int(n) for n in re.findall(r"hashpartitioning\(slot#.*?, (\d+)\), REPARTITION_BY_NUM", text)) <= 1000


def test_a_tile_without_matches_is_ruled_out_by_products(monkeypatch):
    """Strings like those of one block: alike in their names, with other addresses; few pairs come to be scored one by one."""
    rng = random.Random(4)
    address = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(64))
    donors = [f"old ring , {address()}" for _ in range(60)]
    voters = [f"old bolt , {address()}" for _ in range(80)] + [donors[7][:40] + donors[7][44:]]
    one_by_one = []
    whole = match.lcs_lengths
    monkeypatch.setattr(match, "lcs_lengths", lambda *args: one_by_one.append(len(args[2])) or whole(*args))
    d = pd.DataFrame({"donor": donors, "block": "old "})
    v = pd.DataFrame({"voter": voters, "voter_id": [f"{i:02d}" for i in range(len(voters))], "block": "old "})
    tile = match._best_of_tile(70, 8, 4, None)
    got = tile(d, v)
    assert list(got[["donor", "voter", "level", "score"]].itertuples(index=False, name=None)) == [(donors[7], voters[80], 8, 97)]
    assert sum(one_by_one) < 100
    # what is known is kept to: an equal pair is found again, a better one would be, a lesser one is not
    for level, score, rows in ((8, 97, 1), (5, 99, 1), (8, 98, 0)):
        known = d.assign(known_level=[level if t == donors[7] else None for t in donors], known_score=[score if t == donors[7] else None for t in donors])
        assert len(tile(known, v)) == rows


@pytest.mark.parametrize("letters, longest", [("ab c", 200), ("abcdefgh", 90), ("é😀x", 10)])
def test_bounds_of_full_products(letters, longest):
    rng = random.Random(longest)
    word = lambda: "qq" + "".join(rng.choice(letters) for _ in range(rng.randint(0, longest)))
    one, other = [word() for _ in range(30)] + ["qq"], [word() for _ in range(40)] + ["qqq"]
    bound = similarity.lcs_bounds(similarity.encode(one)[0], similarity.encode(other)[0], 2)
    exact = np.array([[slow_lcs(a, b) for b in other] for a in one])
    assert (bound >= exact).all() and (bound - exact).max() <= similarity.SPARE
    some = similarity.lcs_bounds(similarity.encode(one)[0], similarity.encode(other)[0], 2, longest // 2)
    assert (some >= exact).all() and (some[bound >= longest // 2] == bound[bound >= longest // 2]).all()


def test_entities_are_made_slice_by_slice(monkeypatch):
    """Only a slice of a batch is held as Python values, bounded by rows and by bytes."""
    texts = ["bo"] * 7 + [None, "", "é" * 40, "bo bo", "x" * 100, "bo"]
    sizes = []
    made = entities.pa.array
    monkeypatch.setattr(entities, "pa", type("Noted", (), {
        "array": staticmethod(lambda v, kind=None: sizes.append(len(v)) or made(v, kind)), "concat_arrays": staticmethod(pa.concat_arrays)}))
    monkeypatch.setattr(entities, "SLICE_ROWS", 4)
    monkeypatch.setattr(entities, "SLICE_BYTES", 50)
    score = lambda t: [(t, 1.0, 0.5, 0.25, None)] * t.count("bo")
    got = entities._scored_slices(made(texts, pa.string()), score).to_pylist()
    assert [[tuple(e.values()) for e in row] for row in got] == [score(t or "") for t in texts]
    assert sizes == [4, 4, 1, 1, 1, 1, 1] and entities._scored_slices(made([], pa.string()), score).to_pylist() == []
