"""Merkle manifest of a dataset as a persistent tree with path copying.

Every row is a leaf; the leaves of a source make a tree, and the roots of the sources make one above
them.  Trees are built in aligned blocks of ``FAN ** LEVELS`` nodes: a task makes the levels of a
block, and the tops of the blocks are the nodes of the next round.  On the way down every block
gets the siblings on the path from its top to the root, once for all of its nodes.

A tampered leaf makes a version of the tree.  It shares all nodes that are not above the leaf and
copies those that are: within its block, and then along the path that was sent down.  So the
versions of the upper nodes are made beside the leaves, and no task holds those of all leaves.
"""

from hashlib import sha256

import pandas as pd
from pyspark.sql import functions as F

from civicmill.llm.common import pick
from civicmill.llm.running import running
from civicmill.session import cut

FAN, LEVELS, DIGEST = 16, 3, 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf_hash(values):
    """SHA-256 of the values, each with its length in bytes before it, or ``-`` for null."""
    parts = []
    for value in values:
        value = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaves(docs):
    """(doc_id, source, leaf, tampered): ``tampered`` is null where the row is as it was."""
    *head, text = [F.col(f) for f in FIELDS]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tampered = F.when(changed, leaf_hash([*head, F.translate(text, UPPER, LOWER)]))
    return pick(docs, *FIELDS).select("doc_id", "source", leaf_hash([*head, text]).alias("leaf"), tampered.alias("tampered"))


def ordered_leaves(docs):
    """Leaves with ``tree`` (place of their source), ``n`` (leaves of the tree) and ``idx`` in it."""
    rows = cut(leaves(docs).withColumn("row", F.monotonically_increasing_id()))
    trees = rows.groupBy("source").agg(F.count("*").alias("n")).withColumn("one", F.lit(1).cast("long"))
    trees = running(trees, [], [F.col("source").asc_nulls_first()], {"tree": ("sum", F.col("one"))})
    named = trees.select(F.col("source").alias("named"), "n", "tree", "one")
    rows = rows.join(named, F.col("source").eqNullSafe(F.col("named"))).drop("named")
    placed = running(rows, ["tree"], [F.col("doc_id").asc_nulls_first(), "leaf", "row"], {"idx": ("sum", F.col("one"))})
    return cut(placed.select("doc_id", "tree", "n", "idx", "leaf", "tampered"))


def climb(hashes, n, most):
    """Up to ``most`` levels over the nodes of a block, as long as its tree of ``n`` nodes has several."""
    levels = [hashes]
    while n > 1 and len(levels) <= most:
        below, n = levels[-1], -(-n // FAN)
        levels.append([digest("".join(below[i:i + FAN])) for i in range(0, len(below), FAN)])
    return levels, n


def sides(levels, at):
    """The siblings left and right of node ``at`` of a block and of the nodes above it, level by level."""
    found = []
    for level in levels[:-1]:
        run, place = level[at // FAN * FAN:at // FAN * FAN + FAN], at % FAN
        found += ["".join(run[:place]), "".join(run[place + 1:])]
        at //= FAN
    return found


def fold(node, path):
    """The copies of the nodes above ``node``, the last one the root."""
    copies = []
    for left, right in zip(path[::2], path[1::2]):
        node = digest(left + node + right)
        copies.append(node)
    return copies


def block_of(idx, most):
    return F.floor(F.col(idx) / FAN ** most)


def block_tops(nodes, most):
    """The tops of the blocks of (tree, n, idx, hash): the nodes of the next round, in the same columns."""

    def build(key, rows):
        levels, n = climb(rows.sort_values("idx")["hash"].tolist(), int(rows["n"].iloc[0]), most)
        return pd.DataFrame({"tree": [key[0]], "n": [n], "idx": [key[1]], "hash": [levels[-1][0]]})

    return nodes.groupBy("tree", block_of("idx", most).alias("block")).applyInPandas(
        build, "tree long, n long, idx long, hash string")


def rounds_of(nodes, most):
    """The nodes of every round, (tree, n, idx, hash), up to the one node that each tree ends in."""
    rounds = [nodes]
    while (nodes.agg(F.max("n")).first()[0] or 1) > 1:
        nodes = cut(block_tops(nodes, most))
        rounds.append(nodes)
    return rounds


def block_groups(nodes, above, most):
    """Nodes beside the path of the top of their block."""
    above = above.toDF(*above.columns)  # a tree of one node is its own top
    return nodes.groupBy("tree", block_of("idx", most)).cogroup(above.groupBy("tree", "idx"))


def paths_down(rounds, above, most):
    """``above`` (tree, idx, path, subroot, root) carried from the last of the rounds to the first."""

    def descend(nodes, top):
        nodes = nodes.sort_values("idx")
        levels, _ = climb(nodes["hash"].tolist(), int(nodes["n"].iloc[0]), most)
        top = top.iloc[0]
        return pd.DataFrame({
            "tree": nodes["tree"], "idx": nodes["idx"], "path": [sides(levels, i) + list(top["path"]) for i in range(len(nodes))],
            "subroot": top["subroot"], "root": top["root"]})

    for nodes in rounds[-2::-1]:
        above = block_groups(nodes, above, most).applyInPandas(descend, "tree long, idx long, path array<string>, subroot string, root string")
    return above


def manifest(docs, levels=LEVELS):
    """(doc_id, tree, idx, leaf, subroot, root, proof_sha256, folded_root, verified, copies), a row for each row of ``docs``.

    ``docs`` has doc_id, source, lang, n_chars and text; a block has ``levels`` levels.  ``tree`` is the place of the source, null
    first, and ``idx`` that of the row in it, by doc_id, null first, then by leaf; so repeated rows
    stand beside each other and are leaves each.  ``copies`` holds the nodes above the leaf that its
    version copies, from the lowest to the root; it is null where the row is not tampered with, as
    a row without an id never is.  Null values hash as ``-``.  An empty table gives no rows.  Other
    columns, whatever their names, are not read.
    """
    rows = ordered_leaves(docs)
    rounds = rounds_of(rows.select("tree", "n", "idx", F.col("leaf").alias("hash")), levels)
    subroots = rounds[-1]
    n_trees = subroots.count()
    tops = rounds_of(subroots.select(F.lit(0).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("n"), F.col("tree").alias("idx"), "hash"), levels)
    none = F.array().cast("array<string>").alias("path")
    start = tops[-1].select("tree", "idx", none, F.lit("").alias("subroot"), F.col("hash").alias("root"))
    upper = paths_down(tops, start, levels).select(F.col("idx").alias("tree"), "path", "root")
    start = subroots.join(upper, "tree").select("tree", "idx", "path", F.col("hash").alias("subroot"), "root")
    above = paths_down(rounds[1:], start, levels)

    def finish(block, top):
        block = block.sort_values("idx")
        made_levels, _ = climb(block["leaf"].tolist(), int(block["n"].iloc[0]), levels)
        top = top.iloc[0]
        upper, proofs, folded, copies = list(top["path"]), [], [], []
        for at, (leaf, tampered) in enumerate(zip(block["leaf"], block["tampered"])):
            path = sides(made_levels, at) + upper
            made = fold(tampered or leaf, path)
            proofs.append(digest("".join(path)))
            folded.append(made[-1] if made else tampered or leaf)
            copies.append(made if tampered else None)
        return pd.DataFrame({
            "doc_id": block["doc_id"], "tree": block["tree"], "idx": block["idx"], "leaf": block["leaf"], "subroot": top["subroot"],
            "root": top["root"], "proof_sha256": proofs, "folded_root": folded, "copies": copies})

    # ids travel as text, because pandas would make long numbers beside nulls inexact
    done = block_groups(rows.withColumn("doc_id", F.col("doc_id").cast("string")), above, levels).applyInPandas(
        finish, "doc_id string, tree long, idx long, leaf string, subroot string, root string, proof_sha256 string, "
                "folded_root string, copies array<string>")
    return done.withColumn("doc_id", F.col("doc_id").cast(rows.schema["doc_id"].dataType)).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def version_nodes(made):
    """(doc_id, tree, idx, level, node): the nodes that the versions of ``manifest`` copy, levels from 1."""
    return made.select("doc_id", "tree", "idx", F.posexplode("copies").alias("level", "node")).withColumn("level", F.col("level") + 1)


def manifest_digest(docs):
    return manifest(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
