"""The operators bound to the given tables, with production parameters, and the SQL of those that SQL can express."""

import corpus_pipeline
from civicmill.llm.common import table
from civicmill.llm.decontaminate import decontamination_digest
from civicmill.llm.html_main import extract_pages
from civicmill.llm.languages import language_digest
from civicmill.llm.line_dedup import drop_recurring_lines
from civicmill.llm.merkle import manifest_digest
from civicmill.llm.mixing import mixing_digest
from civicmill.llm.packing import pack_documents
from civicmill.llm.prefix_trie import prefix_trie
from civicmill.llm.quality_rules import RULES, STOP_FORMS, apply_rules
from civicmill.llm.sharding import shard_documents
from civicmill.llm.simhash import simhash_digest
from civicmill.llm.site_quality import quality_digest
from civicmill.llm.toxicity import toxicity_digest
from pyspark.sql import functions as F


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def op1_sharding(spark, sf_dir):
    """Every shard has the same number of rows, give or take one; equal texts need not meet."""
    return shard_documents(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_line_dedup(spark, sf_dir):
    """No SQL: a leaf is parted as often as its lines need, and a test does the same line by line."""
    return drop_recurring_lines(documents(spark, sf_dir))


def op3_language_id(spark, sf_dir):
    return language_digest(documents(spark, sf_dir))


def op4_toxicity(spark, sf_dir):
    return toxicity_digest(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op5_quality_rules(spark, sf_dir):
    return apply_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_stop")


def op6_html_extraction(spark, sf_dir):
    return extract_pages(table(spark, sf_dir, "pages"))


def op7_decontamination(spark, sf_dir):
    return decontamination_digest(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op8_quality_classifier(spark, sf_dir):
    return quality_digest(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op9_simhash_dedup(spark, sf_dir):
    return simhash_digest(documents(spark, sf_dir))


def op10_packing(spark, sf_dir):
    return pack_documents(documents(spark, sf_dir))


def op11_mixing(spark, sf_dir):
    return mixing_digest(documents(spark, sf_dir))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_manifest(spark, sf_dir):
    return manifest_digest(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_line_dedup, op3_language_id, op4_toxicity, op5_quality_rules, op6_html_extraction,
    op7_decontamination, op8_quality_classifier, op9_simhash_dedup, op10_packing,
    op11_mixing, op12_prefix_trie, op13_manifest)}
QUERIES["pipeline"] = corpus_pipeline.run

_WORD = r"[^\x20\x09-\x0D]+"

def _rule(name, part, whole, least, most):
    bounds = [f"100 * {part} >= {least} * {whole}"] * (least is not None) + [f"100 * {part} <= {most} * {whole}"] * (most is not None)
    return " AND ".join(bounds)


_RULES = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM base WHERE len(w) >= 5)
), repeated AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS times FROM windows) WHERE times > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, range(0, 5) AS r(k) GROUP BY doc_id
), measured AS (
  SELECT b.doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(lines) AS n_lines,
         len(list_filter(w, lambda x: x IN ({", ".join(f"'{s}'" for s in STOP_FORMS)}))) AS n_stop
  FROM base b LEFT JOIN covered c ON b.doc_id = c.doc_id
), failed AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(_rule(*r) for r in RULES)} AS kept, n_lines, n_stop
FROM failed
"""

_TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_LEAKS = rf"""
WITH items AS (
  SELECT item_id, w, least(len(w), 10) AS size
  FROM (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TOKEN}') AS w
        FROM benchmark WHERE text IS NOT NULL) WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT cast(item_id AS varchar) AS item, size, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM items)
), docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TOKEN}') AS w
  FROM documents
), grams AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)
), hits AS (
  SELECT g.doc_id, g.i, g.size, x.item FROM grams g JOIN windows x ON g.gram = x.gram AND g.size = x.size
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits WHERE item IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

_MIX = rf"""
WITH sized AS (
  SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size FROM documents
), sources AS (
  SELECT source, cast(sum(size) AS bigint) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sized GROUP BY source
), ranked AS (
  SELECT *, place % 3 + 1 AS weight, 3 * source_size AS stop, 3 * source_size / (place % 3 + 1) AS stop_level FROM sources
), levels AS (
  SELECT *, ((SELECT sum(size) FROM sized) - coalesce(sum(stop) OVER before, 0)) / ((SELECT sum(weight) FROM ranked) - coalesce(sum(weight) OVER before, 0)) AS level
  FROM ranked WINDOW before AS (ORDER BY stop_level, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
  SELECT level FROM levels WHERE level <= stop_level ORDER BY stop_level, place LIMIT 1
), targets AS (
  SELECT source, place, source_size, least(cast(stop AS double), weight * coalesce((SELECT level FROM chosen), 'inf'::double)) AS target FROM ranked
), queued AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, coalesce(sum(s.size) OVER (
    PARTITION BY t.place ORDER BY md5(coalesce(cast(s.doc_id AS varchar), '')), s.doc_id, s.size, s.r
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, cast(
  greatest(0, least(size, floor(target - ahead))) + greatest(0, least(size, floor(target - ahead - source_size)))
  + greatest(0, least(size, floor(target - ahead - 2 * source_size))) AS bigint) AS taken
FROM queued
"""


def _crc32(text):
    """CRC-32 of an ASCII text, bit by bit."""
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda s: cast(ascii(s) AS bigint))"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: {byte}), 4294967295)"


_TRIE = rf"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS head, {_crc32("cast(conv_id AS varchar)")} % 6 AS shared, max(place) AS own FROM turns GROUP BY conv_id
), rebuilt AS (
  SELECT c.conv_id, t.place AS depth, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.head AND t.place <= c.shared
  UNION ALL
  SELECT c.conv_id, t.place - c.shared + least(c.shared, coalesce(h.own, 0)), t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.shared LEFT JOIN convs h ON h.conv_id = c.head
), prefixes AS (
  SELECT conv_id, depth, length(text) AS points, string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (
    PARTITION BY conv_id ORDER BY depth) AS node
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), members AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(points) AS saved FROM prefixes GROUP BY node, depth
), ends AS (
  SELECT node, sha256(string_agg(cast(conv_id AS varchar), ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, max_by(node, depth) AS node FROM prefixes GROUP BY conv_id) GROUP BY node
), linked AS (
  SELECT m.*, p.node AS parent FROM members m LEFT JOIN prefixes p ON p.conv_id = m.conv_id AND p.depth = m.depth - 1
), children AS (
  SELECT parent, count(*) AS n FROM linked WHERE parent IS NOT NULL GROUP BY parent
), valued AS (
  SELECT l.*, coalesce(c.n, 0) AS n_children, CASE WHEN c.n IS NULL THEN 1 ELSE 0 END AS leaf FROM linked l LEFT JOIN children c ON c.parent = l.node
), rolled AS (
  SELECT p.node, sum(v.leaf) AS n_leaves, sum(v.saved) AS saved_tokens
  FROM valued v JOIN prefixes p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY p.node
)
SELECT v.conv_id, v.depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, cast(r.n_leaves AS bigint) AS n_leaves,
       cast(r.saved_tokens AS bigint) AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM valued v JOIN rolled r ON r.node = v.node LEFT JOIN members u ON u.node = v.parent LEFT JOIN ends e ON e.node = v.node
"""


def _levels(name, start, number):
    """Nodes and siblings of the levels of trees: ``start`` gives tree, idx, h and m, the nodes of the level."""
    parts = [f"{name}0 AS ({start})"]
    for k in range(number):
        side = "coalesce(string_agg(h, '') OVER (PARTITION BY tree, idx // 16 ORDER BY idx ROWS BETWEEN {}), '')"
        left, right = side.format("UNBOUNDED PRECEDING AND 1 PRECEDING"), side.format("1 FOLLOWING AND UNBOUNDED FOLLOWING")
        parts.append(f"{name}_sides{k} AS (SELECT tree, idx, m, {left} AS l, {right} AS r FROM {name}{k})")
        parts.append(f"{name}{k + 1} AS (SELECT tree, idx // 16 AS idx, CASE WHEN any_value(m) > 1 THEN sha256(string_agg(h, '' ORDER BY idx)) "
                     f"ELSE any_value(h) END AS h, (any_value(m) + 15) // 16 AS m FROM {name}{k} GROUP BY tree, idx // 16)")
    return ", ".join(parts)


def _folds(name, tree, idx, number, before):
    """The fold of every leaf through ``number`` levels; ``before`` is the table that it starts from."""
    parts = []
    for k in range(number):
        last = before if k == 0 else f"{name}_fold{k - 1}"
        parts.append(f"{name}_fold{k} AS (SELECT f.* EXCLUDE (cur, path), CASE WHEN s.m > 1 THEN sha256(s.l || f.cur || s.r) ELSE f.cur END AS cur, "
                     f"f.path || s.l || s.r AS path FROM {last} f JOIN {name}_sides{k} s ON s.tree = {tree} AND s.idx = {idx} // {16 ** k})")
    return ", ".join(parts)


_FIELD = "coalesce(strlen(cast({0} AS varchar)) || ':' || cast({0} AS varchar), '-')"
_HEAD = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# levels for up to 16 ** 6 leaves of a source and 16 ** 4 sources
_TREES = f"""
WITH leaves AS (
  SELECT row_number() OVER () AS r, doc_id, source, sha256({_HEAD} || {_FIELD.format("text")}) AS leaf,
         CASE WHEN {_crc32("cast(doc_id AS varchar)")} % 5 = 0 THEN sha256({_HEAD} || {_FIELD.format(_LOWERED)}) END AS tampered
  FROM documents
), trees AS (
  SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) AS n FROM leaves GROUP BY source
), placed AS (
  SELECT l.doc_id, l.leaf, l.tampered, t.tree, t.n, row_number() OVER (PARTITION BY t.tree ORDER BY l.doc_id NULLS FIRST, l.leaf, l.r) - 1 AS idx
  FROM leaves l JOIN trees t ON l.source IS NOT DISTINCT FROM t.source
), {_levels("low", "SELECT tree, idx, leaf AS h, n AS m FROM placed", 6)},
{_levels("top", "SELECT 0 AS tree, tree AS idx, h, (SELECT count(*) FROM trees) AS m FROM low6", 4)},
started AS (SELECT *, coalesce(tampered, leaf) AS cur, '' AS path FROM placed),
{_folds("low", "f.tree", "f.idx", 6, "started")},
{_folds("top", "0", "f.tree", 4, "low_fold5")}
SELECT f.doc_id, f.leaf, s.h AS subroot, t.h AS root, sha256(f.path) AS proof_sha256, f.cur AS folded_root, f.cur = t.h AS verified
FROM top_fold3 f JOIN low6 s ON s.tree = f.tree, top4 t
"""

ORACLES = {"op5_quality_rules": _RULES, "op7_decontamination": _LEAKS,
           "op11_mixing": _MIX, "op12_prefix_trie": _TRIE, "op13_manifest": _TREES}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
