"""Language identification in two steps: the family first, then the language within it.

Character n-grams of the whole text are hashed into one vector.  Linear support vector machines,
one for each pair of families, vote for the family; those of each pair of languages within that
family vote for the language.  They are trained here, in numpy, on a bounded sample.
"""

import itertools

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicmill.llm.common import first_of_each, held_out, map_batches, pick

BUCKETS = 4096
SAMPLE_ROWS = 2400          # training documents of all languages together
MOST_LANGS = 64             # languages that are learned
UNDETERMINED = "und"
CHARS_AT_ONCE = 1 << 20
# ISO 639 codes by family.  A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk bs",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tt",
    "indo-aryan": "hi ur bn mr gu pa ne",
    "semitic": "ar he mt am",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_LETTERS = None


def family(lang):
    return FAMILY_OF.get(lang.split("-")[0].lower(), lang)


def _letter_table():
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def grams(text):
    """Counts of hashed 1- to 3-grams of letters, words set apart by one blank; None without letters."""
    if not text:
        return None
    counts, any_letter = np.zeros(BUCKETS, np.float32), False
    for at in range(0, len(text), CHARS_AT_ONCE):
        codes = np.frombuffer(text[at:at + CHARS_AT_ONCE].lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        letter = _letter_table()[codes]
        any_letter |= bool(letter.any())
        codes = np.r_[0, np.where(letter, codes, 0), 0]
        inside = codes != 0
        keep = inside | np.r_[True, inside[:-1]]        # of several others in a row the first
        codes, inside = codes[keep], inside[keep]
        one = codes[inside] * 2654435761 % BUCKETS
        two = (codes[:-1] * 40503 + codes[1:] * 2654435761 + 7)[inside[:-1] | inside[1:]] % BUCKETS
        three = (codes[:-2] * 69069 + codes[1:-1] * 40503 + codes[2:] * 2654435761 + 13)[inside[1:-1]] % BUCKETS
        for hashed in (one, two, three):
            counts += np.bincount(hashed, minlength=BUCKETS)
    return counts if any_letter else None


def vector(counts):
    """Square roots of the counts, of unit length."""
    roots = np.sqrt(counts)
    return roots / np.linalg.norm(roots)


# support vector machines

def train_svm(x, y, c=10.0, epochs=30, seed=7):
    """Weights (with a bias at the end) of a linear SVM by dual coordinate descent; y is +1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    # both classes weigh the same
    costs = c * np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    norms = (x * x).sum(1)
    alpha, w, order = np.zeros(len(y)), np.zeros(x.shape[1]), np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(y)):
            gradient = y[i] * float(x[i] @ w) - 1
            fresh = min(max(alpha[i] - gradient / norms[i], 0.0), costs[i])
            if fresh != alpha[i]:
                w += (fresh - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(fresh - alpha[i]))
                alpha[i] = fresh
        if moved < 1e-3:
            break
    return w.astype(np.float32)


def train_pairs(x, names):
    """{(a, b): weights}: positive for a, for each pair of the classes in ``names``."""
    names = np.array(names)
    pairs = {}
    for a, b in itertools.combinations(sorted(set(names.tolist())), 2):
        rows = (names == a) | (names == b)
        pairs[a, b] = train_svm(x[rows], np.where(names[rows] == a, 1.0, -1.0))
    return pairs


def train(x, langs):
    """The model: families with their languages, and the machines of each level."""
    families = [family(lang) for lang in langs]
    members = {f: sorted({lang for lang, g in zip(langs, families) if g == f}) for f in sorted(set(families))}
    model = {"members": members, "families": train_pairs(x, families), "languages": {}}
    for f in members:
        rows = [i for i, g in enumerate(families) if g == f]
        model["languages"][f] = train_pairs(x[rows], [langs[i] for i in rows])
    return model


def vote(v, classes, pairs):
    """(class, confidence): most pairs won, then the largest sum of margins, then the first by name."""
    if len(classes) == 1:
        return classes[0], 1.0
    won = {c: [0, 0.0, np.inf] for c in classes}
    for (a, b), w in pairs.items():
        margin = float(v @ w[:-1] + w[-1])
        for c, m in ((a, margin), (b, -margin)):
            won[c][0] += m > 0
            won[c][1] += m
            won[c][2] = min(won[c][2], m)
    best = max(sorted(classes, reverse=True), key=lambda c: won[c][:2])
    return best, 1 / (1 + np.exp(-4 * np.clip(won[best][2], -8, 8)))


def predict(text, model):
    """(language, score) of a text; ``und`` and 0 without a letter or a trained language."""
    counts = grams(text)
    if counts is None or not model["members"]:
        return UNDETERMINED, 0.0
    v = vector(counts)
    best, first = vote(v, list(model["members"]), model["families"])
    lang, second = vote(v, model["members"][best], model["languages"][best])
    return lang, float(first * second)


# jobs

def fit(docs, sample_rows=SAMPLE_ROWS, most_langs=MOST_LANGS):
    """Train on a bounded sample of documents whose language may be learned.

    ``sample_rows`` is shared by the languages, the ``most_langs`` with the most such documents (of equal ones the first
    by name); codes beyond them are not learned.  The vectors are made where the texts are; the
    driver gets hashed counts, of fixed size per document.
    """
    known = pick(docs, "doc_id", "lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    langs = [r["lang"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_langs).collect()]
    per_lang = max(2, sample_rows // max(1, len(langs)))
    known = known.where(F.col("lang").isin(langs))
    ids = first_of_each(known.select("lang", F.xxhash64("doc_id", "text").alias("h")), "lang", per_lang, "h")
    chosen = known.withColumn("h", F.xxhash64("doc_id", "text")).join(F.broadcast(ids.distinct()), ["lang", "h"])
    chosen = chosen.dropDuplicates(["lang", "h"])

    def start():
        def compute(batch):
            found = [grams(t) for t in batch.column("text").to_pylist()]
            places = [None if c is None else np.flatnonzero(c).astype("<u2").tobytes() for c in found]
            return places, [None if c is None else c[c > 0].astype("<f4").tobytes() for c in found]
        return compute

    made = map_batches(chosen.select("lang", "h", "text"), ["lang", "h"],
                       [("places", T.BinaryType()), ("counts", T.BinaryType())], start)
    rows = sorted((r for r in made.collect() if r["places"] is not None), key=lambda r: (r["lang"], r["h"]))
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["places"], "<u2")] = np.frombuffer(r["counts"], "<f4")
        x[i] = vector(x[i])
    return train(x, [r["lang"] for r in rows])


def identify(docs, model):
    """(doc_id, lang_pred, score), one row per row of ``docs``; only the text decides.

    Null texts and texts without a letter are ``und`` with score 0, and so is everything if the
    model has learned no language.  Repeated rows and equal texts get equal results, null ids are kept, an empty
    table gives no rows, and columns other than doc_id and text are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        def compute(batch):
            found = [predict(t, shared.value) for t in batch.column("text").to_pylist()]
            return [f[0] for f in found], [f[1] for f in found]
        return compute

    return map_batches(pick(docs, "doc_id", "text"), ["doc_id"], [("lang_pred", T.StringType()), ("score", T.DoubleType())], start)


def language_digest(docs):
    return identify(docs, fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
