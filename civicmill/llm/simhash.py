"""Near-duplicates by SimHash, found with Golay codes.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits, each read as a word of the perfect
binary Golay code (23, 12, 7).  Every word lies within 3 bits of exactly one codeword; a word at
distance 3 also has five codewords at distance 4.  These one or six codeword indices are the
word's fuzzy keys: words that differ in one bit have their nearest codewords among each other's
keys, and words that differ in two bits share a key.

If at most four bits differ, the two segments without the worst one hold at most two of them.  For each pair of segments (i, j) a fingerprint therefore files under
(nearest of i, keys of j) and (keys of i, nearest of j): one bit in each is met by the first rule,
two bits in one of them by the second.  That is at most 33 keys, and no pair within four bits is lost.
Fingerprints under one key are compared in numpy inside a task; a task returns the links that join
them, never all pairs of a group.
"""

import re

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicmill.llm.common import map_batches, pick
from civicmill.llm.components import connected_components
from civicmill.session import cut

WORDS_PER_SHINGLE = 4
MOST_BITS = 4
SEED = 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))        # first bit and number of bits
GENERATOR = 0b101011100011                      # of the Golay code, as a polynomial over two elements
TOKEN = re.compile("[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
SHINGLES_AT_ONCE = 1 << 16
BUCKET = 1 << 14            # fingerprints of one key compared in one task


# fingerprints

def fingerprint(text, k=WORDS_PER_SHINGLE):
    """Unsigned 64-bit fingerprint; 0 for a text without words."""
    from xxhash import xxh64_intdigest

    words = TOKEN.findall((text or "").translate(LOWER))
    if not words:
        return 0
    line = " ".join(words).encode("utf-8", "surrogatepass")
    lengths = np.fromiter((len(w) if w.isascii() else len(w.encode("utf-8", "surrogatepass")) for w in words),
                          np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - k + 1)
    starts, ends = starts[:n].tolist(), ends[min(k, len(words)) - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        hashes = np.array([xxh64_intdigest(line[s:e], SEED) for s, e in zip(
            starts[at:at + SHINGLES_AT_ONCE], ends[at:at + SHINGLES_AT_ONCE])], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs, k=WORDS_PER_SHINGLE):
    """(doc_id, doc_key, fp), fp as a signed long, one row per row of ``docs`` (doc_id, text)."""
    def start():
        def compute(batch):
            made = [fingerprint(t, k) for t in batch.column("text").to_pylist()]
            return [np.array(made, dtype=np.uint64).view(np.int64)]
        return compute

    rows = pick(docs, "doc_id", "text").withColumn("doc_key", F.xxhash64("doc_id", "text"))
    return map_batches(rows, ["doc_id", "doc_key"], [("fp", T.LongType())], start)


# Golay keys

def syndromes(words):
    """Remainders of 23-bit words divided by the generator."""
    rest = np.array(words, dtype=np.int64)
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - 11), 0)
    return rest


def error_patterns():
    """[2048, 6]: by syndrome, the error of the nearest codeword and of those at distance 4, or -1."""
    ones = 1 << np.arange(23, dtype=np.int64)
    by_weight = [np.zeros(1, np.int64)]
    for _ in range(4):
        more = np.unique((by_weight[-1][:, None] | ones[None, :]).ravel())
        by_weight.append(more[np.bitwise_count(more) == len(by_weight)])
    table = np.full((2048, 6), -1, np.int64)
    for patterns in by_weight[:4]:
        table[syndromes(patterns), 0] = patterns
    filled = np.ones(2048, np.int64)
    for pattern, syndrome in zip(by_weight[4].tolist(), syndromes(by_weight[4]).tolist()):
        if np.bitwise_count(table[syndrome, 0]) == 3:
            table[syndrome, filled[syndrome]] = pattern
            filled[syndrome] += 1
    return table


def fuzzy_keys(words, table):
    """[n, 6] codeword indices (the upper 12 bits), the nearest first, -1 where there are fewer."""
    words = np.asarray(words, dtype=np.int64)
    errors = table[syndromes(words)]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> 11)


def keys_of(fps, table):
    """(keys, owners): all keys of unsigned fingerprints and the row that each belongs to."""
    indices = [fuzzy_keys((fps >> np.uint64(at)).astype(np.int64) & ((1 << width) - 1), table) for at, width in SEGMENTS]
    rows = np.arange(len(fps))
    keys, owners = [], []
    for number, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        pairs = [(indices[i][:, 0], indices[j][:, k]) for k in range(6)]
        pairs += [(indices[i][:, k], indices[j][:, 0]) for k in range(1, 6)]
        for a, b in pairs:
            there = (a >= 0) & (b >= 0)
            keys.append((number << 24 | a << 12 | b)[there])
            owners.append(rows[there])
    return np.concatenate(keys), np.concatenate(owners)


def key_rows(distinct):
    """(key, fp) of every key of every fingerprint."""
    import pyarrow as pa

    def run(batches):
        table = error_patterns()
        for batch in batches:
            signed = batch.column("fp").to_numpy()
            for at in range(0, len(signed), 20_000):
                part = signed[at:at + 20_000]
                keys, owners = keys_of(part.view(np.uint64), table)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[owners])], names=["key", "fp"])

    return distinct.select("fp").mapInArrow(run, "key long, fp long")


# links inside a key

def forest(fps, most_bits):
    """Links (places a, b) that join all fingerprints within ``most_bits``: at most one per fingerprint.

    A part grows from one fingerprint: those that it has reached last are compared with all that no
    part has reached, and link to what they find.
    """
    left, links = np.arange(len(fps)), []
    while len(left):
        reached, left = left[:1], left[1:]
        while len(reached) and len(left):
            some, reached = reached[:256], reached[256:]
            near = np.bitwise_count(fps[some, None] ^ fps[None, left]) <= most_bits
            found = near.any(axis=0)
            links += zip(some[near[:, found].argmax(axis=0)].tolist(), left[found].tolist())
            reached, left = np.concatenate([reached, left[found]]), left[~found]
    return links


def links_of_run(keys, fps, most_bits):
    """Links (fp a, fp b) among rows sorted by key, only whole keys."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    found = []
    # keys of few fingerprints: all rows at once, each with the next, the one after it, ...
    small = np.repeat(sizes <= 64, sizes)
    for step in range(1, int(min(64, sizes.max(initial=0)))):
        a = np.flatnonzero((keys[step:] == keys[:-step]) & small[step:])
        if not len(a):
            break
        a = a[np.bitwise_count(fps[a] ^ fps[a + step]) <= most_bits]
        found.append(np.stack([fps[a], fps[a + step]], axis=1))
    for start, size in zip(starts[sizes > 64].tolist(), sizes[sizes > 64].tolist()):
        group = fps[start:start + size]
        found.append(np.array([(group[a], group[b]) for a, b in forest(group, most_bits)], dtype=fps.dtype).reshape(-1, 2))
    return np.concatenate(found) if found else np.zeros((0, 2), fps.dtype)


def links_in_keys(keyed, most_bits):
    """(a, b): links among fingerprints of one key; the rows of a key stand together in a partition."""
    import pyarrow as pa

    def run(batches):
        held_keys, held_fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def out(keys, fps):
            links = np.unique(links_of_run(keys, fps, most_bits), axis=0).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

        for batch in batches:
            keys = np.concatenate([held_keys, batch.column("key").to_numpy()])
            fps = np.concatenate([held_fps, batch.column("fp").to_numpy().view(np.uint64)])
            if not len(keys):
                continue
            whole = np.searchsorted(keys, keys[-1])     # the last key may go on in the next batch
            yield out(keys[:whole], fps[:whole])
            held_keys, held_fps = keys[whole:], fps[whole:]
        if len(held_keys):
            yield out(held_keys, held_fps)

    together = keyed.repartition("key").sortWithinPartitions("key", "fp")
    return together.mapInArrow(run, "a long, b long")


def links_in_hot_keys(keyed, most_bits):
    """(a, b) for keys of very many fingerprints, without comparing them with each other.

    Two fingerprints within 2r bits have a word in common that is within r bits of both.  Each files
    under all words within r bits and is linked to the smallest that files under the same word.
    """
    radius = most_bits // 2
    flips, last = [0], [0]
    for _ in range(radius):
        last = sorted({m | 1 << b for m in last for b in range(64) if not m >> b & 1})
        flips += last
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in flips])
    near = keyed.select("fp").distinct().select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("word"))
    hubs = near.groupBy("word").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a != z")
    return near.join(hubs.select("word", "a"), "word").where("a != fp").select("a", F.col("fp").alias("b"))


def fingerprint_components(distinct, most_bits=MOST_BITS, bucket=BUCKET):
    """(node, root) of all distinct fingerprints (column fp) that have a link."""
    if most_bits not in (0, 2, 4):
        raise ValueError("the keys find every link of up to 4 bits; give an even number")
    keyed = key_rows(distinct)
    hot = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > bucket).select("key")
    edges = links_in_keys(keyed.join(hot, "key", "left_anti"), most_bits).unionByName(
        links_in_hot_keys(keyed.join(hot, "key", "left_semi"), most_bits))
    return connected_components(edges)


def near_duplicates(docs, k=WORDS_PER_SHINGLE, most_bits=MOST_BITS):
    """(doc_id, doc_key, fp, root, component_id), one row per row of ``docs`` (doc_id, text).

    ``doc_key`` is a hash of the id and the text.
    ``root`` names the group: documents have the same root if a chain of fingerprints leads from
    one to the other, each within ``most_bits`` bits of the next.  ``component_id`` is the smallest
    doc_id of the group, null only if all its ids are null.  Null, empty and blank texts have
    fingerprint 0 and are linked like any other.  Equal rows are in one group.  Other columns are
    not read.
    """
    found = cut(fingerprints(docs, k))
    distinct = cut(found.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    linked = fingerprint_components(distinct, most_bits).select(F.col("node").alias("fp"), "root")
    rooted = distinct.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    names = rooted.select("fp", "root").join(groups, "root")
    return found.join(names, "fp").select("doc_id", "doc_key", "fp", "root", "component_id")


def one_of_each_group(docs, k=WORDS_PER_SHINGLE, most_bits=MOST_BITS):
    """The rows of ``docs``, all their columns, that represent a group: one row per group.

    It is the row of the smallest id, null ids last; of equal ids the one of the smaller hash.
    """
    groups = near_duplicates(docs, k, most_bits)
    chosen = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "doc_key")).alias("least"))
    chosen = chosen.select(F.col("least")["doc_key"].alias("doc_key"))
    # joined and made distinct by the same key, so the texts move once
    name = "doc_key"
    while name in docs.columns:
        name += "_"
    rows = docs.withColumn(name, F.xxhash64("doc_id", "text"))
    return rows.join(chosen.withColumnRenamed("doc_key", name), name, "left_semi").dropDuplicates([name]).drop(name)


def simhash_digest(docs):
    """(doc_id, fingerprint, component_id): the fingerprint as 16 lowercase hex digits."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
