"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all benchmark items.

Texts are normalised to lower-case words.  A window is ten consecutive words of an item, or the
whole item if it is shorter.  The automaton holds every window as its words between blanks, so one
pass over a text finds all of them, overlapping ones included; where the words stand in the
normalised text maps a hit back to words, and to characters of the original.
"""

import re

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicmill.llm.common import map_batches, pick

WINDOW = 10
BLOCK_BYTES = 32 << 20      # text of benchmark items in one automaton; more items make more automata
# Fixed value: letters, digits and everything outside ASCII make words; A-Z are lowered before.
TOKEN = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FIELDS = [
    ("n_words", T.LongType()),
    ("ranges", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))),
    ("items", T.ArrayType(T.StringType())),
]
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def windows_of(text, size=WINDOW):
    words = TOKEN.findall((text or "").translate(LOWER))
    if not words:
        return []
    return [words[i:i + size] for i in range(max(1, len(words) - size + 1))]


def build_automaton(items, size=WINDOW):
    """Automaton of (item number, text) pairs; each window carries the numbers of its items."""
    import ahocorasick

    owners = {}
    for number, text in items:
        for window in windows_of(text, size):
            owners.setdefault(f" {' '.join(window)} ", (len(window), set()))[1].add(number)
    automaton = ahocorasick.Automaton()
    for key, (length, numbers) in owners.items():
        automaton.add_word(key, (length, tuple(sorted(numbers))))
    if owners:
        automaton.make_automaton()
    return automaton


def scan(text, automaton):
    """(number of words, [(first, last) word ranges that are hit, merged], item numbers)."""
    words = TOKEN.findall((text or "").translate(LOWER))
    if not words or not len(automaton):
        return len(words), [], set()
    line = f" {' '.join(words)} "
    hits = list(automaton.iter(line))
    if not hits:
        return len(words), [], set()
    # place of the blank behind each word, in the normalised line
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    last_words = np.searchsorted(ends, [end for end, _ in hits])
    found, ranges = set(), []
    for last, first, numbers in sorted((int(w), int(w) - v[0] + 1, v[1]) for w, (_, v) in zip(last_words, hits)):
        found.update(numbers)
        while ranges and first <= ranges[-1][1] + 1:
            first = min(first, ranges.pop()[0])
        ranges.append((first, last))
    return len(words), ranges, found


def character_ranges(text, ranges):
    """The (start, end) characters of the original text that word ranges stand for."""
    spans = [m.span() for m in TOKEN.finditer((text or "").translate(LOWER))]
    return [(spans[a][0], spans[b][1]) for a, b in ranges]


def merge_ranges(a, b):
    merged = []
    for first, last in sorted(a + b):
        if merged and first <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(last, merged[-1][1]))
        else:
            merged.append((first, last))
    return merged


def item_blocks(benchmark, block_bytes=BLOCK_BYTES):
    """Lists of (item_id, text): the stated query set, cut into blocks of bounded size.

    Rows come one partition at a time.  Nothing is left out: more items make more blocks.
    """
    block, size = [], 0
    for row in pick(benchmark, "item_id", "text").where("text is not null").toLocalIterator():
        block.append((None if row["item_id"] is None else str(row["item_id"]), row["text"]))
        size += len(row["text"])
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def scan_documents(docs, benchmark, extra=(), block_bytes=BLOCK_BYTES):
    """(doc_id, text, ranges, items, n_words), one row per row of ``docs`` (doc_id, text).

    ``ranges`` are the merged (first, last) words inside windows of the benchmark, ``items`` the
    ids, as strings, of the items they belong to.  Several blocks are scanned one after the other
    over the same rows, without a shuffle.  A null text has no words.  Items of null or wordless
    text have no windows; a null item id marks its words but is not listed.  Repeated items and
    repeated rows count as they stand, an empty table gives no rows, and other columns are not read.
    """
    rows = pick(docs, "doc_id", "text", *extra)
    spark = docs.sparkSession
    scanned = False
    for block in item_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast({"items": block})
        rows = map_batches(rows, ["doc_id", "text", *extra], FIELDS, _scanner(shared, scanned))
        scanned = True
    if not scanned:
        rows = map_batches(rows, ["doc_id", "text", *extra], FIELDS, _scanner(None, False))
    return rows


def _scanner(shared, scanned):
    """Scan with one block's automaton; ``scanned`` says that earlier blocks left their findings."""
    def start():
        held = shared.value if shared else {"items": []}
        if "automaton" not in held:     # a worker builds it once and keeps it with the broadcast value
            held["automaton"] = build_automaton(enumerate(t for _, t in held["items"]))
            held["names"] = [name for name, _ in held["items"]]
        automaton, names = held["automaton"], held["names"]

        def compute(batch):
            n_words, all_ranges, all_items = [], [], []
            earlier = zip(batch.column("ranges").to_pylist(), batch.column("items").to_pylist()) if scanned else None
            for text in batch.column("text").to_pylist():
                n, ranges, numbers = scan(text, automaton)
                listed = {names[i] for i in numbers if names[i] is not None}
                if earlier:
                    known, ids = next(earlier)
                    ranges = merge_ranges([(r["first"], r["last"]) for r in known], ranges)
                    listed.update(ids)
                n_words.append(n)
                all_ranges.append([{"first": a, "last": b} for a, b in ranges])
                all_items.append(sorted(listed))
            return n_words, all_ranges, all_items

        return compute

    return start


def decontamination_digest(docs, benchmark):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row per row of ``docs``."""
    scanned = scan_documents(docs, benchmark)
    n_hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    return scanned.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
