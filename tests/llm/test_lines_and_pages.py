"""Line dedup against a plain version, and pages of known text in random arrangements."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from civicmill.llm import html_main, line_dedup, packing, simhash

DOCS = "doc_id long, text string"


def plain_templates(lines):
    """{line (tuple of words): template}; a leaf is parted until its lines agree."""
    found = {line: line for line in lines}

    def part(group, path):
        if len(group) < 2:
            return
        rest = {line: line[3:] for line in group}
        width = len(next(iter(rest.values())))
        template, forks = [], []
        for slot in range(width):
            value, most = Counter(w[slot] for w in rest.values()).most_common(1)[0]
            major = 2 * most > len(group)
            template.append(value if major else None)
            forks.append((major, most if major else len({w[slot] for w in rest.values()}), slot))
        constant = sum(v is not None for v in template)
        open_, fork = defaultdict(list), min(forks)[2]
        for line, w in rest.items():
            equal = sum(a == b for a, b in zip(w, template) if b is not None)
            if 100 * equal >= 70 * constant and 100 * (width - constant) <= 40 * width:
                found[line] = (path, tuple(template))
            else:
                open_[w[fork]].append(line)
        for value, some in open_.items():
            part(some, (path, fork, value))

    leaves = defaultdict(list)
    for line in set(lines):
        leaves[len(line), line[:3]].append(line)
    for leaf, group in leaves.items():
        part(group, leaf)
    return found


def plain_dedup(docs):
    words = lambda line: tuple(re.sub(line_dedup.VARIABLE, "<*>", line).split())
    lines = [(i, n, words(line)) for i, text in docs for n, line in enumerate((text or "").split("\n")) if words(line)]
    template = plain_templates([w for _, _, w in lines])
    first = {}
    for i, _, w in lines:
        first[template[w]] = min(i, first.get(template[w], i))
    gone = {(i, n) for i, n, w in lines if first[template[w]] != i}
    return {i: None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if (i, n) not in gone) for i, text in docs}


def test_line_dedup_equals_a_plain_version(spark):
    rng = random.Random(5)
    names = [f"n{a}{b}" for a in "abcdefgh" for b in "klmnop"]
    shapes = ["Share this page with {} today", "Share this page on {} now", "Share this page {} {} {}", "All rights reserved.", "{}", "{} {}",
              "one two three four five {} seven {} nine ten", "one two three four {} {} {} eight nine ten", "Page 12 of 30 in {}", "\t "]
    docs = []
    for i in range(120):
        lines = [rng.choice(shapes) for _ in range(rng.randint(0, 9))]
        docs.append((i, "\n".join(re.sub("{}", lambda _: rng.choice(names), s) for s in lines)))
    docs += [(500, None), (501, "")]
    got = line_dedup.drop_recurring_lines(spark.createDataFrame(docs, DOCS))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == plain_dedup(docs)


def test_planted_templates_are_found(spark):
    """Recall on templates of known lines: one name in 100 documents, at each place behind the leading words."""
    words = "the quick report of this county board was read aloud before noon".split()
    name = lambda k: "n" + chr(97 + k // 26) + chr(97 + k % 26)
    docs, planted = [], 0
    for place in range(3, len(words)):
        for k in range(100):
            line = [f"t{chr(97 + place)}", *words]
            line[place + 1] = name(k)
            docs.append((place * 1000 + k, " ".join(line)))
            planted += 1
    dropped = line_dedup.drop_recurring_lines(spark.createDataFrame(docs, DOCS)).agg(F.sum("n_dropped")).first()[0]
    assert dropped >= 0.95 * (planted - (len(words) - 3))


def test_odd_documents(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, None), (3, ""), (4, "w " * 30_000 + "\nx")], DOCS)
    for rows in (docs, docs.select("*", *[F.lit("x").alias(n) for n in ("words", "pos", "leaf", "line_key", "doc_key", "fp", "root", "cell")])):
        got = line_dedup.drop_recurring_lines(rows).collect()
        assert Counter(r["doc_id"] for r in got) == Counter([None, 1, 1, 2, 3, 4])
        assert [r["n_dropped"] for r in got if r["doc_id"] == 1] == [1, 1]
        kept = simhash.one_of_each_group(rows)
        assert kept.columns == rows.columns and kept.count() == 3
    assert line_dedup.drop_recurring_lines(docs.limit(0)).collect() == []


PROSE = "The council met on the evening of the first day, and the members spoke at length about the road, the bridge and the school."


def test_pages_of_comments_adverts_and_teasers():
    rng = random.Random(9)
    comment_parts = [
        '<div class="comments">{}</div>', '<div id="comments">{}</div>', '<section id="comments">{}</section>', '<ol class="comment-list">{}</ol>',
        '<div class="comments-area">{}</div>', '<div class="comment-thread js-x">{}</div>', '<section class="reader replies">{}</section>']
    comments = ['<article class="comment"><p>{}</p></article>', '<article class="comment-body"><p>{}</p></article>', '<div class="comment"><p>{}</p></div>',
                '<article><p>{}</p></article>', '<p>{}</p>']
    beside = ['<div class="ad-slot"><p>{}</p></div>', '<div class="advert-box"><p>{}</p></div>', '<div class="sidebar-widget-area"><p>{}</p></div>',
              '<div class="related"><article class="teaser"><p>{}</p></article></div>', '<aside><article><p>{}</p></article></aside>',
              '<form><p>{}</p></form>']
    for trial in range(300):
        body = [f"{k} {PROSE * rng.randint(1, 4)}" for k in range(rng.randint(1, 6))]
        noise = lambda: f"noise {PROSE * rng.randint(1, 4)}"
        inside = [rng.choice(comment_parts).format("".join(rng.choice(comments).format(noise()) for _ in range(rng.randint(1, 5))))]
        inside += [rng.choice(beside).format(noise()) for _ in range(rng.randint(0, 2))]
        article = "".join(f"<p>{p}</p>" for p in body)
        around = rng.choice(["<article>{}</article>", "<main>{}</main>", "<main><article class='post comments-open'>{}</article></main>", "<div class='layout sidebar-right'><article>{}</article></div>"])
        rng.shuffle(inside)
        where = rng.randint(0, 2)
        page = around.format(article + "".join(inside)) if where == 0 else around.format(article) + "".join(inside) if where == 1 else inside[0] + around.format(article) + "".join(inside[1:])
        page = f"<html><body><nav><a href=/>Home</a></nav><div>{page}</div><footer>foot</footer></body></html>"
        assert html_main.main_text(page).split("\n") == body, page


def test_comments_without_an_article_element():
    page = f"<body><div class='content'><p>{PROSE}</p><p>{PROSE}</p></div><div class='comments-area'><p>{PROSE * 3}</p><p>{PROSE * 3}</p></div>"
    assert html_main.main_text(page).split("\n") == [PROSE] * 2
    labelled = f"<body><article><p>{PROSE} <label>Marked</label> so.</p></article>"
    assert html_main.main_text(labelled) == f"{PROSE} Marked so."


def test_program_against_its_bound_and_best_fit():
    rng = np.random.default_rng(0)
    for trial in range(6):
        histogram = np.zeros(2049, np.int64)
        if trial < 4:
            histogram[rng.choice(np.arange(200, 1500), 8, replace=False)] = rng.integers(50, 400, 8)
        else:
            histogram = np.bincount(np.minimum(2047, rng.lognormal(5.8, 0.9, 3000).astype(int) + 1), minlength=2049)
        amounts, bound = packing.solve_configurations(histogram)
        assert all(sum(c) <= 2048 for c in amounts)
        alone = sum(n for _, n in packing.round_configurations(histogram, {}))
        keys, bases, offsets = packing.plan_sequences(histogram)
        used = sum(n for _, n in min((packing.round_configurations(histogram, a) for a in (amounts, {})), key=lambda c: sum(n for _, n in c)))
        assert np.ceil(bound - 1e-6) <= used <= alone and bases.max() + 1 <= used
        if trial >= 4:
            assert used <= 1.01 * bound + 1


def test_forest_joins_what_is_near():
    rng = np.random.default_rng(1)
    for size in (1, 2, 60, 700):
        centres = rng.integers(0, 1 << 63, 1 + size // 40)
        fps = np.array([int(rng.choice(centres)) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(size)], dtype=np.uint64)
        root = list(range(size))

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        links = simhash.forest(fps, 4)
        for a, b in links:
            assert int(fps[a] ^ fps[b]).bit_count() <= 4
            root[top(a)] = top(b)
        assert len(links) < size
        for a in range(size):
            for b in range(a):
                if int(fps[a] ^ fps[b]).bit_count() <= 4:
                    assert top(a) == top(b)
