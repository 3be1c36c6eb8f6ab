"""Operators for training text against brute force, held-out labels and the case list of the docstrings."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from civicmill.llm import (
    common, components, decontaminate, html_main, languages, line_dedup, packing, quality_rules, sharding, simhash, site_quality, toxicity)

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, shard string"


def documents(spark, rows):
    """(doc_id, text) pairs with columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", "y") for i, t in rows], DOCS)


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


ODD = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other text"), (2, None), (None, "no id here"), (None, None), (3, ""), (4, " \n\t"),
       (5, "Ünïcödé ☃ " * 30), (6, "word " * 5000), (7, " ".join(f"w{i % 7919}" for i in range(150_000))), (8, "x" * 300_000)]
# names that operators use for columns of their own
INNER = ["words", "cell", "fp", "doc_key", "row_key", "spread", "place_in_key", "value", "h", "root", "line", "place", "size", "host"]


def everything(docs):
    """Every operator on the same documents; one result row for each, or pieces."""
    labels = docs.sparkSession.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = docs.sparkSession.createDataFrame([(1, "a b c"), (2, None), (None, "no id")], "item_id long, text string")
    yield sharding.shard_documents(docs)
    yield line_dedup.drop_recurring_lines(docs)
    yield languages.language_digest(docs)
    yield toxicity.toxicity_digest(docs, labels)
    yield quality_rules.apply_rules(docs)
    yield decontaminate.decontamination_digest(docs, bench)
    yield site_quality.quality_digest(docs, labels)
    yield simhash.simhash_digest(docs)
    yield packing.pack_documents(docs)


def test_odd_rows_and_empty_tables(spark):
    docs = documents(spark, ODD)
    wider = docs.select("*", F.lit(7).alias("TEXT"), F.lit("z").alias("Doc_Id"), *[F.lit(0).alias(name) for name in INNER])
    assert len(wider.columns) == len(docs.columns) + 2 + len(INNER)
    for result in everything(wider):
        rows = result.collect()
        assert Counter(r["doc_id"] for r in rows if "piece" not in r or r["piece"] == 0) == Counter(i for i, _ in ODD), result.columns
    for result in everything(docs.limit(0)):
        assert result.collect() == [], result.columns
    assert html_main.extract_pages(spark.createDataFrame([(1, "u", None), (None, None, "")], "page_id long, url string, html string")).agg(
        F.sum("n_chars")).first()[0] == 0


def placed(points, rows, shards, cells):
    """Rows (cell, rank key, id) to shards, one after the other: home first, then clockwise."""
    stops = sorted(points.items())
    arc_of = {c: next((s for s in stops if s[0] >= c), stops[0]) for c in range(cells)}
    base, extra = divmod(len(rows), shards)
    room = [base + (s < extra) for s in range(shards)]
    by_arc = defaultdict(list)
    for cell, key, name in sorted(rows):
        by_arc[arc_of[cell]].append(name)
    found, waiting = {}, []
    for arc in stops:
        names = by_arc[arc]
        take = min(len(names), room[arc[1]])
        room[arc[1]] -= take
        found.update(dict.fromkeys(names[:take], arc[1]))
        waiting.append((arc, names[take:]))
    for arc, names in waiting:
        at = stops.index(arc)
        for name in names:
            shard = next(s for _, s in stops[at + 1:] + stops[:at + 1] if room[s])
            room[shard] -= 1
            found[name] = shard
    return found


def test_sharding_follows_the_ring(spark):
    docs = documents(spark, [(i, "t" * (i % 90)) for i in range(700)])
    got = {r["doc_id"]: r for r in sharding.shard_documents(docs, 5, 3, 64).collect()}
    points = {r["cell"]: r["shard"] for r in sharding.ring_points(spark, 5, 3, 64).collect()}
    rows = [(r["cell"], r["key_hash"], r["doc_id"]) for r in sharding.keyed_rows(docs, 64).collect()]
    expected = placed(points, rows, 5, 64)
    assert {i: r["shard"] for i, r in got.items()} == expected
    assert all(r["size"] == i % 90 + 1 and r["text_crc32"] == zlib.crc32(b"t" * (i % 90)) for i, r in got.items())
    slots = defaultdict(list)
    for r in got.values():
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(140)) for s in slots.values())
    moved = sum(r["shard"] != r["home_shard"] for r in got.values())
    assert 0 < moved < 350


def test_lines(spark):
    line = "Posted by user{} on page 12 of the {} archive today"
    docs = documents(spark, [(1, "one\n" + line.format(7, "main")), (2, line.format(8, "main") + "\nnew words stand here alone"),
                             (3, line.format(9, "old") + "\n\nend"), (4, "Posted by hand and nothing else on this day at all"), (5, line.format(1, "main"))])
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"], r["emptied"]) for r in line_dedup.drop_recurring_lines(docs).collect()}
    assert got[1][0] == "one\n" + line.format(7, "main")
    assert got[2] == ("new words stand here alone", 2, 1, False)
    assert got[3] == ("\nend", 3, 1, False)
    assert got[4][2] == 0 and got[5] == ("", 1, 1, True)


def test_short_lines_of_the_pipeline(spark):
    docs = documents(spark, [(1, "All rights reserved.\nPage 3\nalone"), (2, "All rights reserved.\n\nPage 14\nother"), (3, "All rights reserved")])
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.dedup_lines(spark, docs, None).collect()}
    assert got == {1: "All rights reserved.\nPage 3\nalone", 2: "\nother", 3: "All rights reserved"}


def test_long_lines_of_the_pipeline_vote_token_by_token(spark):
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60)]
    changed = lambda places: " ".join("other" + w if i in places else w for i, w in enumerate(words))
    lines = [" ".join(words), changed({8, 22, 36, 50}), changed({10, 24, 38, 52, 58}), "unlike " + changed({59})]
    docs = documents(spark, enumerate(lines))
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.drop_recurring_lines(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 0}


def test_templates_of_one_leaf(spark):
    names = [chr(97 + i // 26) + chr(97 + i % 26) + "x" for i in range(100)]
    shared = [f"Share this page with {n} today" for n in names] + [f"Share this page on {n}.org now" for n in names]
    unlike = [f"Share this page u{n} v{n} w{n}" for n in names]
    few = [f"One two three {n} five {n}s seven eight" for n in names[:9]]
    loose = [f"So it was a {n}" for n in names[:9]]
    texts = shared + unlike + few + loose
    rows = line_dedup.drop_recurring_lines(documents(spark, enumerate(texts))).collect()
    kept = {texts[r["doc_id"]] for r in rows if not r["n_dropped"]}
    assert kept == {shared[0], shared[100], few[0], *unlike, *loose}


def test_languages_on_held_out_documents(spark):
    docs = table(spark, "documents")
    got = languages.language_digest(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 150 and np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97
    model = languages.fit(docs)
    assert languages.predict("12 34 !", model) == ("und", 0.0) and languages.predict(None, model) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_toxicity(spark):
    rng = np.random.default_rng(0)
    model = toxicity.empty_model()
    x = rng.normal(size=(5, 3, toxicity.INPUTS)).astype(np.float32)
    mask = np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0], [1, 0, 0]], np.float32)
    y = np.array([1, 0, 1], np.float32)

    def loss():
        p = x @ model["wx"] + model["b"]
        h = toxicity.HIDDEN * 3
        states = np.concatenate([toxicity.one_way(p[:, :, :h], mask, model["uf"], False),
                                 toxicity.one_way(p[:, :, h:], mask, model["ub"], True)], axis=2)
        q = toxicity.sigmoid(toxicity.pooled(states, mask, model)[1] @ model["out"] + model["bias"][0])
        return -np.mean(y * np.log(q) + (1 - y) * np.log(1 - q))

    g, _ = toxicity.gradients(x, mask, y, model)
    for name in ("wx", "uf", "ub", "att", "query", "out", "b"):
        place = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        keep = model[name][place]
        model[name][place] = keep + 1e-2
        up = loss()
        model[name][place] = keep - 1e-2
        down = loss()
        model[name][place] = keep
        assert (up - down) / 2e-2 == pytest.approx(float(g[name][place]), rel=0.08, abs=1e-4), name
    docs, labels = table(spark, "documents"), table(spark, "labels")
    got = toxicity.toxicity_digest(docs, labels).join(labels, "doc_id").join(docs, "doc_id").where("held_out and lang = 'en'").collect()
    toxic = [r["predicted"] for r in got if r["toxic"]]
    assert len(toxic) >= 8 and np.mean(toxic) > 0.7 and np.mean([r["predicted"] for r in got if not r["toxic"]]) < 0.06


def test_toxicity_windows(spark):
    assert toxicity.windows(0).tolist() == toxicity.windows(24).tolist() == [0]
    assert toxicity.windows(38).tolist() == [0, 4, 8, 12, 14]
    for n in range(22, 120):        # every passage of up to 21 words is whole in a window
        firsts = toxicity.windows(n)
        assert all(any(f <= a and a + 21 <= f + toxicity.WINDOW for f in firsts) for a in range(n - 20))


def test_toxicity_scores_are_those_of_the_plain_network(spark):
    rng = np.random.default_rng(3)
    model = toxicity.empty_model()
    model["odds"] = rng.normal(size=toxicity.BUCKETS).astype(np.float32)
    model["calibration"] = np.array([1.0, 0.2, -0.5])
    words = ["".join(rng.choice(list("abcdefg"), 4)) for _ in range(300)]
    texts = [" ".join(rng.choice(words, n)) for n in (1, 5, 23, 24, 25, 30, 31, 400, 3000)] + ["", None, " \n"]

    def plain(text):
        chunks = (text or "").split()
        logits = []
        for f in toxicity.windows(len(chunks)):
            part = [toxicity.normal(c) for c in chunks[f:f + toxicity.WINDOW]]
            mask = np.zeros((toxicity.WINDOW, 1), np.float32)
            mask[:len(part)] = 1
            x = np.zeros((toxicity.WINDOW, 1, toxicity.INPUTS), np.float32)
            x[:len(part), 0] = toxicity.word_inputs(part, model["odds"], model)
            p, h = x @ model["wx"] + model["b"], toxicity.HIDDEN * 3
            states = np.concatenate([toxicity.one_way(p[:, :, :h], mask, model["uf"], False),
                                     toxicity.one_way(p[:, :, h:], mask, model["ub"], True)], axis=2)
            pool = toxicity.pooled(states, mask, model)[1]
            logits.append(float((pool @ model["out"])[0] + model["bias"][0]))
        a, b, c = model["calibration"]
        return 1 / (1 + np.exp(-(a * max(logits) + b * np.log(len(logits)) + c)))

    expected = [plain(t) for t in texts]
    for most in (100_000, 50, 0):       # words that are remembered
        scorer = toxicity.Scorer(model, most)
        assert np.allclose(scorer.score(texts), expected, atol=1e-4)
        assert np.allclose([scorer.score([t])[0] for t in texts], expected, atol=1e-4)
        assert len(scorer.known) <= most
    # what is remembered is read in place, not copied for every few hundred texts
    scorer = toxicity.Scorer(model, 100_000)
    assert all(scorer.rows([t.split() for t in texts if t])[0] is scorer.table for _ in range(2))
    assert toxicity.train(["", " "], [0, 1]) is None


def test_first_of_each_over_many_tasks(spark):
    rows = spark.range(0, 20_000, 1, 80).withColumn("label", (F.col("id") % 10 > 2).cast("int")).withColumn("h", F.xxhash64("id"))
    got = common.first_of_each(rows, "label", 70, "h")
    assert got.columns == rows.columns
    kept = rows.collect()
    for label in (0, 1):
        expected = sorted(r["h"] for r in kept if r["label"] == label)[:70]
        assert sorted(r["h"] for r in got.collect() if r["label"] == label) == expected


def test_only_the_most_frequent_languages_are_learned(spark):
    docs = spark.createDataFrame([(i, f"{w} wort text {i}", lang) for i, (w, lang) in enumerate(
        [("the", "en")] * 30 + [("der", "de")] * 20 + [("odd", f"x{k}") for k in range(9)])], "doc_id long, text string, lang string")
    model = languages.fit(docs, most_langs=2)
    assert sorted(lang for m in model["members"].values() for lang in m) == ["de", "en"]


def repeat_words(words):
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    return len({i + k for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for k in range(5)})


def test_quality_rules(spark):
    texts = ["", "a b c d e a b c d e", "x " * 40, "a b c d e f g a b c d e f g h a b c d e", "the and of " * 3 + "# $ %", "One.\nOne.\n\nTwo."]
    got = {r["doc_id"]: r for r in quality_rules.apply_rules(documents(spark, enumerate(texts))).collect()}
    for i, text in enumerate(texts):
        words = text.split()
        assert (got[i]["n_words"], got[i]["word_chars"], got[i]["n_repeat_words"]) == (len(words), sum(map(len, words)), repeat_words(words))
        assert got[i]["base_failed"] == (len(words) < 10 or 100 * repeat_words(words) > 20 * len(words))
    assert got[5]["n_dup_lines"] == 1 and got[4]["failed_rules"] == ["symbols to words"]
    labels = table(spark, "labels")
    kept = quality_rules.apply_rules(table(spark, "documents")).join(labels, "doc_id").where("quality = 1 and not base_failed")
    assert kept.agg(F.avg(F.col("kept").cast("int"))).first()[0] > 0.99


def test_html():
    page = """<html><body><nav><a href=a>Home</a></nav><div class="cookie-notice">We use cookies</div><div id=content><h1>Title &amp; more</h1>
    <p>First para with <a href=q>a link</a> that is long enough to be dense, and goes on.<p>Second &eacute; &#x27;q&#39;   <b>bold
    text</b>, also long, really long for a paragraph.<ul><li>one<li>two</ul><script>var t="</p>";</script></div>
    <div class=comments><p>A reader says much here, so much that it would be the densest part of the whole page by far, if counted.</div>
    <footer>&copy;</footer>"""
    assert html_main.main_text(page).split("\n") == [
        "Title & more", "First para with a link that is long enough to be dense, and goes on.",
        "Second é 'q' bold text, also long, really long for a paragraph.", "one", "two"]
    for odd in (None, "", "   ", "<p>", "<script>never closed", "<!-- never closed", "</p></div>", "<" * 500):
        assert isinstance(html_main.main_text(odd), str)
    assert html_main.main_text("just text &amp; no tags") == "just text & no tags"


def test_html_names_of_wrappers_and_sections_drop_nothing():
    text = "A paragraph of the article that is long enough to count as its text, with more words to come. " * 3
    wrappers = ['<div class="content has-sidebar">', '<div id="page" class="layout sidebar-right">', '<div class="widget-content">',
                '<form action="/all">', '<div class="widget">']
    for wrapper in wrappers:
        for around in ("<article>", "<div>"):
            page = f"<body>{wrapper}{around}<p>{text}</p><p>{text}</p>"
            assert html_main.main_text(page).split("\n") == [text.strip()] * 2, page
    inside = '<body><article><h2 id="search">Search</h2><section id="related-work"><p>{0}</p></section><p id="notice-of-intent">{0}</p><div class="share">Tell</div>'
    assert html_main.main_text(inside.format(text)).split("\n") == ["Search", text.strip(), text.strip()]
    beside = "<body><article><p>{0}</p></article><div class='comments'><p>{0}{0}</p></div><form><p>{0}</p></form>"
    assert html_main.main_text(beside.format(text)) == text.strip()


def test_html_sections_beside_each_other():
    text = "Some link free words of the article in this paragraph, which go on and on without an end. " * 3
    paragraphs = [f"{i} {text}".strip() for i in range(12)]
    sections = ["".join(f"<p>{p}</p>" for p in half) for half in (paragraphs[:6], paragraphs[6:])]
    links = "<ul>" + "".join(f"<li><a href=x>Another page {i} with a long title</a></li>" for i in range(30)) + "</ul>"
    for open_, close in (("<div><h1>Title</h1>", "</div>"), ("<h1>Title</h1>", "")):
        for section in ("<section>{}</section>", "<div class=column><div>{}</div></div>"):
            first, second = map(section.format, sections)
            page = f"<body><div>{links}</div>{open_}{first}<h2>Next</h2><p>Yes.</p>{second}{close}<div>{links}</div><div>Copyright</div>"
            assert html_main.main_text(page).split("\n") == ["Title", *paragraphs[:6], "Next", "Yes.", *paragraphs[6:]], page
    assert html_main.main_text(f"<body><div>{links}</div><div>{sections[0]}</div>").split("\n") == paragraphs[:6]


def brute_hits(text, items):
    words = decontaminate.TOKEN.findall((text or "").translate(decontaminate.LOWER))
    hit, found = set(), set()
    for name, item in items:
        for w in decontaminate.windows_of(item):
            for i in range(len(words) - len(w) + 1):
                if words[i:i + len(w)] == w:
                    hit.update(range(i, i + len(w)))
                    found.add(name)
    return hit, found


def test_decontamination(spark):
    items = [(10, "one two THREE"), (9, "x " * 14), (8, "!!"), (7, None), (6, "a b c d e f g h i j k")]
    texts = ["zero One, two-three four", "x " * 12, "a b c d e f g h i j k l a b c d e f g h i j", "twone two threes", None, ""]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (1, 1 << 20):
        rows = decontaminate.scan_documents(documents(spark, enumerate(texts)), bench, block_bytes=block).collect()
        for r in rows:
            hit, found = brute_hits(r["text"], [(str(i), t) for i, t in items])
            assert {k for a in r["ranges"] for k in range(a["first"], a["last"] + 1)} == hit and r["items"] == sorted(found)
    assert decontaminate.character_ranges(texts[0], [(1, 3)]) == [(5, 19)]


def test_site_quality(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    rows = site_quality.posteriors(docs, labels).collect()
    p = {id(r): round(1 / (1 + np.exp(-r["evidence"])) * 1e6) / 1e6 for r in rows}
    prior = np.mean(list(p.values()))
    hosts, paths = defaultdict(list), defaultdict(list)
    for r in rows:
        hosts[r["host"]].append(p[id(r)])
        paths[r["host"], r["path"]].append(p[id(r)])
    to_prior, to_host = plain_strengths(paths, hosts)
    for r in rows[:200]:
        host = (sum(hosts[r["host"]]) + to_prior * prior) / (len(hosts[r["host"]]) + to_prior)
        path = (sum(paths[r["host"], r["path"]]) + to_host * host) / (len(paths[r["host"], r["path"]]) + to_host)
        logit = lambda q: np.log(q / (1 - q))
        score = 1 / (1 + np.exp(-(r["evidence"] + 0.5 * (logit(path) - logit(prior)))))
        assert r["path_rate"] == pytest.approx(path, abs=1e-4) and r["score"] == pytest.approx(score, abs=1e-3)
    judged = site_quality.quality_digest(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["rejected"] for r in judged if not r["quality"]]) > 0.9
    assert np.mean([r["rejected"] for r in judged if r["quality"]]) < 0.03


def plain_strengths(paths, hosts):
    """Within variance over between variance, for hosts around the mean and for paths around their hosts."""
    everything = np.concatenate([np.array(v) for v in paths.values()])
    within = sum(((np.array(v) - np.mean(v)) ** 2).sum() for v in paths.values()) / (len(everything) - len(paths))
    n, sizes = len(everything), {h: len(v) for h, v in hosts.items()}
    between = sum(len(v) * (np.mean(v) - everything.mean()) ** 2 for v in hosts.values()) - (len(hosts) - 1) * within
    inner = sum(len(v) * (np.mean(v) - np.mean(hosts[k[0]])) ** 2 for k, v in paths.items()) - (len(paths) - len(hosts)) * within
    sizes_of = (n - sum(m * m for m in sizes.values()) / n, n - sum(len(v) ** 2 / sizes[k[0]] for k, v in paths.items()))
    return [within / (b / s) if b > 0 else 1e9 for b, s in zip((between, inner), sizes_of)]


def test_site_strengths(spark):
    rng = np.random.default_rng(0)
    for spread, less in ((0.25, 10), (0.0, None)):
        rows = [(f"h{h}", f"p{q}", float(p)) for h in range(12) for q in range(4)
                for p in np.clip(rng.normal(0.5 + spread * np.sin(h) + spread * np.cos(7 * h + q) / 2, 0.1, 40), 0, 1)]
        df = spark.createDataFrame(rows, "host string, path string, p double")
        whole = lambda v: F.sum(F.round(v * 1_000_000).cast("long"))
        paths = df.groupBy("host", "path").agg(F.count("*").alias("path_n"), whole(F.col("p")).alias("path_sum"), whole(F.col("p") * F.col("p")).alias("path_squares"))
        hosts = paths.groupBy("host").agg(F.sum("path_n").alias("host_n"), F.sum("path_sum").alias("host_sum"))
        got = site_quality.site_strengths(paths, hosts)
        by_host, by_path = defaultdict(list), defaultdict(list)
        for h, q, p in rows:
            by_host[h].append(p)
            by_path[h, q].append(p)
        assert got == pytest.approx(plain_strengths(by_path, by_host), rel=1e-3)
        assert max(got) < less if less else max(got) > 100


def brute_fingerprint(text):
    from xxhash import xxh64_intdigest

    words = simhash.TOKEN.findall((text or "").translate(simhash.LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if linked(a, b):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


def test_golay_keys_meet_within_two_bits():
    table_ = simhash.error_patterns()
    assert (table_[:, 0] >= 0).all() and ((table_ >= 0).sum(1)[np.bitwise_count(table_[:, 0]) == 3] == 6).all()
    words = np.random.default_rng(1).integers(0, 1 << 23, 300)
    keys = simhash.fuzzy_keys(words, table_)
    for i in range(23):
        for j in range(i, 23):
            other = simhash.fuzzy_keys(words ^ (1 << i) ^ ((1 << j) if j != i else 0), table_)
            common = (keys[:, :, None] == other[:, None, :]) & (keys >= 0)[:, :, None]
            assert common.any((1, 2)).all()
            if i == j:
                assert common[:, 0, :].any(1).all() and common[:, :, 0].any(1).all()


@pytest.mark.parametrize("bucket", [1 << 14, 3])
def test_simhash_components(spark, bucket):
    rng = np.random.default_rng(3)
    fps = set()
    for _ in range(12):
        centre = int(rng.integers(0, 1 << 63)) * 2 + 1
        for _ in range(25):
            bits = rng.choice(64, rng.integers(0, 5), replace=False)
            fps.add(centre ^ sum(1 << int(b) for b in bits))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {r["node"]: r["root"] for r in simhash.fingerprint_components(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket=bucket).collect()}
    expected = brute_components(sorted(signed), lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)
    assert {n: got.get(n, n) for n in signed} == expected


def test_simhash_documents(spark):
    docs = table(spark, "documents").where("doc_id < 150")
    rows = {r["doc_id"]: r for r in simhash.simhash_digest(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    prints = {i: brute_fingerprint(t) for i, t in texts.items()}
    assert {i: int(r["fingerprint"], 16) for i, r in rows.items()} == prints
    expected = brute_components(sorted(texts), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert {i: r["component_id"] for i, r in rows.items()} == expected
    kept = simhash.one_of_each_group(docs.unionByName(docs))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected.values())) and kept.columns == docs.columns


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001), (5, 5)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(301), 0), 1000: 1000, 1001: 1000}


def test_packing_is_an_exact_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    odd = "İstanbul ǅ Σας don't I'LL x y\tz <|endoftext|> ab<|startoftext|>cd \x1cq ²³ １２ é ﬁ 漢字 한국어 👩‍👩‍👧 'S It'S 12a3 __a_b -- ...!?"
    docs = table(spark, "documents").select("doc_id", "text").unionByName(documents(spark, [(-1, odd), (-2, None), (-3, "")]).select("doc_id", "text"))
    rows = packing.pack_documents(docs, with_ids=True).collect()
    encoder = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for r in docs.collect():
        pieces = sorted(by_doc[r["doc_id"]], key=lambda p: p["piece"])
        ids = np.frombuffer(b"".join(bytes(p["ids"]) for p in pieces), "<u4").tolist()
        assert ids == encoder.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        assert [p["piece"] for p in pieces] == list(range(len(pieces))) and all(p["length"] == 2048 for p in pieces[:-1])
        assert [p["start"] for p in pieces] == [2048 * i for i in range(len(pieces))]
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(r["length"] for r in rows) // 2048)
    assert len(by_sequence) <= 1.01 * least + 1


def test_fractional_solution_and_rounding():
    histogram = np.zeros(11, np.int64)
    histogram[[3, 4, 6, 7]] = 40, 25, 25, 40
    amounts, bound = packing.solve_configurations(histogram, 10)
    assert 64.9 < bound < 65.1
    chosen = packing.round_configurations(histogram, amounts, 10)
    used = Counter()
    for configuration, number in chosen:
        assert sum(configuration) <= 10
        for length in configuration:
            used[length] += number
    assert used == {3: 40, 4: 25, 6: 25, 7: 40} and sum(n for _, n in chosen) == 65


def test_repeated_rows_do_not_enlarge_the_labelled_sample(spark):
    docs = documents(spark, [(i % 9, f"text {i % 2}") for i in range(600)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)] * 3, "doc_id long, toxic int")
    rows = common.labelled_sample(docs, labels, "toxic", 50, 1000).collect()
    assert len(rows) == len({r["doc_id"] for r in rows}) and {r["text"] for r in rows} == {"text 0"}
