"""Quality rules: a threshold table compiled into one projection of built-in functions.

Every measure is an expression over one text, so rules need one pass over the table and no shuffle.
"""

from pyspark.sql import functions as F

from civicmill.llm.common import WORD, bind, blanked, pick

# Frequent function words of the languages in the corpus.
STOP_WORDS = """
the of and to in is that it for on with as was at by be this are from or an not a
der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als
de la le les et des en un une du que est pour dans qui par sur au pas elle il
el los las y del se con por para su al lo como más pero sus o
""".split()

STOP_FORMS = sorted({form for w in STOP_WORDS for form in (w, w.capitalize())})
SYMBOLS = "#*$%&|<>"

# name, numerator, denominator, least percent, most percent: null means no bound.  Percentages of
# whole numbers, compared without division.
RULES = [
    ("mean word length", "word_chars", "n_words", 150, 1500),
    ("symbols to words", "n_symbols", "n_words", None, 20),
    ("stop words", "n_stop", "n_words", 2, None),
    ("repeated lines", "n_dup_lines", "n_lines", None, 50),
]


def _repeat_words(windows):
    """Words inside five-word windows that occur twice or more, the first occurrence included."""
    def covered(windows):
        """Start places of repeated windows, in order; each covers five words or up to the next."""
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = bind(placed, lambda w: F.filter(
            F.transform(w, lambda x, k: F.when(
                (F.get(w, k - 1)["h"] == x["h"]) | (F.get(w, k + 1)["h"] == x["h"]), x["i"])),
            lambda i: i.isNotNull()))
        return bind(F.array_sort(repeated), lambda s: F.aggregate(
            F.transform(s, lambda i, k: F.least(F.lit(5), F.coalesce(F.get(s, k + 1) - i, F.lit(5)))),
            F.lit(0).cast("long"), lambda a, b: a + b))

    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(covered(windows))


def measures(docs):
    """(doc_id and all measures), one row per row of ``docs`` (doc_id, text).

    A null or empty text has no words and no lines; all its measures are 0.  Each step is a column
    of its own where later ones read it several times, so nothing is computed twice.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = pick(docs, "doc_id", "text").select(
        "doc_id", text.alias("text"), F.split(blanked(text), " ").alias("parts"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias("lines"))
    split = split.withColumn("words", F.array_remove("parts", ""))
    counted = split.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        (F.length("text") - F.size("parts") + 1).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("words", lambda w: w.isin(STOP_FORMS))).cast("long").alias("n_stop"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    names = [c for c in counted.columns if c != "hashes"]

    def joined(a, shift, b):
        """Hashes of each value of ``a`` with the value of ``b`` that stands ``shift`` places later."""
        n = F.greatest(F.size(b) - shift, F.lit(0))
        return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(shift + 1), n), lambda x, y: F.xxhash64(x, y))

    hashed = counted.withColumn("two", joined("hashes", 1, "hashes")).withColumn("four", joined("two", 2, "two"))
    hashed = hashed.select(*names, joined("four", 4, "hashes").alias("windows"))
    return hashed.select(*names, _repeat_words(F.col("windows")).alias("n_repeat_words"))


def passes(rule):
    _, part, whole, least, most = rule
    bounds = []
    if least is not None:
        bounds.append(100 * F.col(part) >= least * F.col(whole))
    if most is not None:
        bounds.append(100 * F.col(part) <= most * F.col(whole))
    return bounds[0] if len(bounds) == 1 else bounds[0] & bounds[1]


def apply_rules(docs, rules=tuple(RULES)):
    """Measures, ``base_failed``, ``failed_rules`` (names) and ``kept``, one row per row of ``docs``.

    The base fails texts of fewer than ten words and texts of which more than a fifth lies in
    repeated five-word windows.  Null and empty texts fail it.  Equal rows get equal results, and
    only ``doc_id`` and ``text`` are read.
    """
    measured = measures(docs)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    failed = F.filter(F.array(*[F.when(~passes(r), F.lit(r[0])) for r in rules]), lambda n: n.isNotNull())
    checked = measured.withColumn("base_failed", base).withColumn("failed_rules", failed)
    return checked.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
