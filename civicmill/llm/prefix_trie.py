"""Trie of conversation prefixes with subtree totals by centroid decomposition.

A conversation is rebuilt from the first turns of the one it branches off and its own later turns.
The prefixes of all rebuilt conversations are the nodes of a trie; a prefix is known by its length and
128 bits over its turns and their places.  Totals over subtrees are rolled up on the parent edges:
a component is split at its centroid, a node whose removal leaves no part larger than half of it;
the total of what hangs at the centroid is added to the nodes on the path from the centroid to the
top of the component; then the parts are split in the same way.  So a chain of any length takes a
logarithmic number of rounds.  Components of more than ``COMPONENT`` nodes are split over all tasks,
and smaller ones whole inside a task, many to a task.
"""

from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from civicmill.llm.common import pick
from civicmill.llm.running import range_parts, running
from civicmill.session import cut

FAMILY, MOST_SHARED = 100, 6
COMPONENT, NODES_PER_TASK = 20_000, 50_000


def ordered_turns(conversations):
    """(conv_id, place, h1, h2, points): turns with their place from 1, null turns first."""
    blank = F.lit("")
    rows = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    rows = rows.select(
        "conv_id", "turn", "role", "text", F.lit(1).cast("long").alias("one"), F.length("text").cast("long").alias("points"),
        F.monotonically_increasing_id().alias("row"))
    placed = running(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), "role", "text", "row"], {"before": ("sum", F.col("one"))})
    return cut(placed.select("conv_id", (F.col("before") + 1).alias("place"), "role", "text", "points"))


def rebuilt_turns(turns):
    """(conv_id, depth, role, text, points, length): the first turns of the family's head, then the own ones behind as many."""
    head = F.col("conv_id") - F.col("conv_id") % FAMILY
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("own")).select(
        "conv_id", "own", head.alias("head"), shared.alias("shared"))
    heads = convs.where("conv_id = head").select("head", F.col("own").alias("head_own"))
    convs = convs.join(heads, "head", "left").withColumn("taken", F.least("shared", F.coalesce("head_own", F.lit(0))))
    convs = cut(convs.withColumn("length", F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("shared"))))
    # at most ``MOST_SHARED - 1`` turns of a head, and at most twice ``FAMILY`` conversations to a head
    first = turns.where((F.col("place") < MOST_SHARED) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "head")
    of_head = convs.select("conv_id", "head", "taken", "length").join(first, "head").where("place <= taken").select(
        "conv_id", F.col("place").alias("depth"), "role", "text", "points", "length")
    of_own = turns.join(convs, "conv_id").where("place > shared").select(
        "conv_id", (F.col("place") - F.col("shared") + F.col("taken")).alias("depth"), "role", "text", "points", "length")
    return of_head.unionByName(of_own), convs


def node_name(depth, one, two):
    return F.concat_ws(":", depth, F.hex(one), F.hex(two))


def prefixes(conversations):
    """(conv_id, depth, node, parent, points, length), a row for each prefix of each rebuilt conversation, and the empty one."""
    rows, convs = rebuilt_turns(ordered_turns(conversations))
    # the place is part of the hash, so the exclusive or over the turns so far tells their order
    rows = rows.select("conv_id", "depth", "points", "length", *[
        F.xxhash64(F.lit(seed), "depth", "role", "text").alias(name) for name, seed in (("h1", 1), ("h2", 2))])
    before = running(rows, ["conv_id"], ["depth"], {"p1": ("xor", F.col("h1")), "p2": ("xor", F.col("h2"))})
    node = node_name(F.col("depth"), F.col("p1").bitwiseXOR(F.col("h1")), F.col("p2").bitwiseXOR(F.col("h2")))
    deep = before.select(
        "conv_id", "depth", node.alias("node"), node_name(F.col("depth") - 1, F.col("p1"), F.col("p2")).alias("parent"), "points", "length")
    zero = F.lit(0).cast("long")
    roots = convs.select(
        "conv_id", zero.alias("depth"), node_name(zero, zero, zero).alias("node"), F.lit(None).cast("string").alias("parent"),
        zero.alias("points"), "length")
    return cut(deep.unionByName(roots))


def trie_nodes(rows):
    """(node, parent, conv_id, depth, n_convs, n_children, leaf, saved, size): ``size`` counts the nodes of the subtree."""
    nodes = rows.groupBy("node").agg(
        F.first("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        F.count("*").alias("n_convs"), F.first("points").alias("points"))
    nodes = cut(nodes)
    # a conversation owns the nodes it is the smallest member of, always its deepest ones
    owned = nodes.groupBy("conv_id").agg(F.count("*").alias("owned"))
    size = F.sum(F.least("owned", F.col("length") - F.col("depth") + 1))
    sizes = rows.join(owned, "conv_id").groupBy("node").agg(size.alias("size"))
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(sizes, "node").join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    return cut(nodes.select(
        "node", "parent", "conv_id", "depth", "n_convs", "n_children", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("points")).alias("saved"), "size"))


def split_forest(parents, values):
    """Subtree totals of a forest by centroid decomposition.

    ``parents`` holds the index of each node's parent, or -1; ``values`` is a list of lists, one value of
    each kind for each node.  Returns the totals in the shape of ``values``.
    """
    children = [[] for _ in parents]
    for node, parent in enumerate(parents):
        if parent >= 0:
            children[parent].append(node)
    totals = [[0] * len(parents) for _ in values]
    gone = [False] * len(parents)
    size = [0] * len(parents)
    tops = [node for node, parent in enumerate(parents) if parent < 0]
    while tops:
        top = tops.pop()
        order = [top]
        for node in order:
            order.extend(c for c in children[node] if not gone[c])
        for node in reversed(order):
            size[node] = 1 + sum(size[c] for c in children[node] if not gone[c])
        centre = top
        while (heavy := next((c for c in children[centre] if not gone[c] and 2 * size[c] >= len(order)), None)) is not None:
            centre = heavy
        part = [centre]
        for node in part:
            part.extend(c for c in children[node] if not gone[c])
        sums = [sum(kind[node] for node in part) for kind in values]
        node = centre
        while True:  # from the centroid to the top
            for kind, add in zip(totals, sums):
                kind[node] += add
            if node == top:
                break
            node = parents[node]
        gone[centre] = True
        tops.extend(c for c in children[centre] if not gone[c])
        if centre != top:
            tops.append(top)
    return totals


def split_large(state, rows):
    """One round over the components of ``state`` that are too large for a task.

    Returns (what is added to nodes, the new state).  A node is below the centroid if its smallest
    member has the centroid as a prefix, which is looked up once for each conversation of a component.
    """
    centres = state.where("2 * size >= members").groupBy("component").agg(
        F.max_by(F.struct("node", "conv_id", "depth", "size"), "depth").alias("c"))
    centres = cut(centres.select("component", F.col("c.node").alias("centre"), F.col("c.conv_id").alias("centre_conv"),
                                 F.col("c.depth").alias("centre_depth"), F.col("c.size").alias("cut_size")))
    at = rows.select("conv_id", F.col("depth").alias("centre_depth"), F.col("node").alias("prefix"))
    under = rows.select("conv_id", (F.col("depth") - 1).alias("centre_depth"), F.col("node").alias("branch"))
    chains = state.select("component", "conv_id").distinct().join(centres, "component")
    chains = chains.join(at, ["conv_id", "centre_depth"]).where("prefix = centre").join(under, ["conv_id", "centre_depth"], "left")
    chains = chains.select("component", "conv_id", "branch")
    marked = state.join(centres, "component").join(chains.withColumn("known", F.lit(True)), ["component", "conv_id"], "left")
    below = F.col("known").isNotNull() & (F.col("depth") >= F.col("centre_depth"))
    marked = cut(marked.withColumn("below", below))
    sums = marked.where("below").groupBy("component").agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved_sum"))
    path = centres.join(rows.select(F.col("conv_id").alias("centre_conv"), "depth", "node"), "centre_conv").where(
        "depth <= centre_depth").select("component", "node", "cut_size", "centre")
    path = cut(state.select("component", "node").join(path, ["component", "node"]).join(sums, "component"))
    added = path.select("node", "leaves", F.col("saved_sum").alias("saved_tokens"))
    lower = marked.where("below and node != centre").select(
        "node", "parent", "conv_id", "depth", "leaf", "saved", "size", F.col("branch").alias("component"))
    shorter = path.select("node", F.col("cut_size").alias("less"))
    upper = marked.where("not below").join(shorter, "node", "left").select(
        "node", "parent", "conv_id", "depth", "leaf", "saved", (F.col("size") - F.coalesce("less", F.lit(0))).alias("size"), "component")
    return added, lower.unionByName(upper)


def subtree_totals(nodes, rows, component=COMPONENT, per_task=NODES_PER_TASK):
    """(node, n_leaves, saved_tokens) of every node."""
    state = nodes.select("node", "parent", "conv_id", "depth", "leaf", "saved", "size", F.lit("all").alias("component"))
    added = []
    while True:
        members = state.groupBy("component").agg(F.max("size").alias("members"))
        state = cut(state.join(members, "component"))
        large = state.where(F.col("members") > component)
        if large.isEmpty():
            break
        more, parts = split_large(large, rows)
        added.append(more)
        state = parts.unionByName(state.where(F.col("members") <= component).drop("members"))
    tasks = max(1, -(-state.count() // per_task))

    def split(forest):
        place = {(c, n): i for i, (c, n) in enumerate(zip(forest["component"], forest["node"]))}
        parents = [place.get(key, -1) for key in zip(forest["component"], forest["parent"])]
        leaves, saved = split_forest(parents, [forest["leaf"].tolist(), forest["saved"].tolist()])
        return pd.DataFrame({"node": forest["node"], "leaves": leaves, "saved_tokens": saved})

    whole = state.withColumn("task", F.pmod(F.xxhash64("component"), F.lit(tasks))).groupBy("task").applyInPandas(
        split, "node string, leaves long, saved_tokens long")
    for more in added:
        whole = whole.unionByName(more)
    return whole.groupBy("node").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def hash_in_order(batches):
    """One digest for each node from its pieces of text, which come one after the other."""
    node, state, found = None, None, []
    for batch in batches:
        for name, first, piece in zip(*(batch.column(k).to_pylist() for k in ("node", "first", "piece"))):
            if name != node:
                if node is not None:
                    found.append((node, state.hexdigest()))
                node, state = name, sha256()
            state.update(("" if first else ",").encode() + piece.encode())
    if node is not None:
        found.append((node, state.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.string()) for k in (0, 1)], names=["node", "ends_sha256"])


def ends_of(rows):
    """(node, ends_sha256) of nodes where conversations end.

    The ids of a node are joined within each range of ids; only a node whose ids stand in several
    ranges has its pieces hashed one after the other, without holding them together.
    """
    ends = range_parts(rows.where("depth = length").select("node", "conv_id"), "node", "conv_id")
    pieces = ends.groupBy("node", "part").agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    pieces = cut(pieces.select("node", "part", F.array_join(F.col("ids").cast("array<string>"), ",").alias("piece")))
    spans = pieces.groupBy("node").agg(F.min("part").alias("from"), F.max("part").alias("to"))
    pieces = pieces.join(spans, "node")
    alone = pieces.where("from = to").select("node", F.sha2(F.col("piece").cast("binary"), 256).alias("ends_sha256"))
    long = pieces.where("from < to").repartition("node").sortWithinPartitions("node", "part").select(
        "node", (F.col("part") == F.col("from")).alias("first"), "piece")
    return alone.unionByName(long.mapInArrow(hash_in_order, "node string, ends_sha256 string"))


def prefix_trie(conversations, component=COMPONENT, per_task=NODES_PER_TASK):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), a row for each node.

    ``conversations`` has conv_id, turn, role and text.  Turns are ordered by turn, null first, and
    equal ones by role and text; repeated rows are turns of their own.  Null roles and texts are empty, and rows
    without a conv_id belong to no conversation.  An empty table gives no rows.  Other columns,
    whatever their names, are not read.
    """
    rows = prefixes(conversations)
    nodes = trie_nodes(rows)
    totals = subtree_totals(nodes, rows, component, per_task)
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    made = nodes.join(parents, "parent", "left").join(totals, "node").join(ends_of(rows), "node", "left")
    return made.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"))
