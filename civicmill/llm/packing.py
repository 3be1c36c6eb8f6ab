"""Best-fit packing by a configuration linear program over the length histogram.

Documents become token ids, each closed by an end id; longer ones are cut into pieces of a full
sequence.  A configuration is a multiset of lengths that fits into one sequence.  The linear
program asks for the least number of configurations that cover the histogram.  It is solved by
multiplicative weights: a length weighs its tokens times a factor that grows with the share of it
still uncovered, a knapsack dynamic program prices the best configuration around every length,
those priced close to the best are taken by a step, and the weights are updated.  The prices give a
lower bound.  The fractional solution is rounded down with its remainders carried
along, and what is left is filled up best-fit, largest first.

Only the histogram reaches the driver: its size is the sequence length.  Rows get their place
from their rank among the pieces of the same length.
"""

import re
import zlib

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicmill.llm.common import pick
from civicmill.session import cut

SEQUENCE = 2048
VOCABULARY = "word_bpe_49k.json"
END_ID = 0
ROUNDS = 200                # of multiplicative weights, at most; bounds the number of configurations
GAP = 0.01                  # share of the tokens that the program may leave uncovered
STEP = 0.5                  # share of the scarcest uncovered length that a configuration takes
RATE = 3.0                  # of the weights
SLACK = 0.03                # a configuration is taken if its price is that close to the best one's
CELL_ROWS = 50_000          # pieces of one length ranked in one task
CACHE = 1_000_000           # chunks of text whose ids a worker remembers


# tokens

class ChunkEncoder:
    """Token ids of whole texts, from remembered ids of their parts.

    The tokenizer drops white space and never joins what it separates, so the ids of a text are
    those of its parts between blanks, one after the other.  A part goes through the tokenizer's
    own normalizer, pre-tokenizer and model; both steps are remembered up to a fixed number.
    """

    ASCII = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")

    def __init__(self, path, most=CACHE):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.chunks, self.words, self.most = {"": b""}, {}, most

    def _word(self, word):
        ids = self.words.get(word)
        if ids is None:
            ids = np.array([t.id for t in self.tokenizer.model.tokenize(word)], dtype="<u4").tobytes()
            if len(self.words) < self.most:
                self.words[word] = ids
        return ids

    def _chunk(self, chunk):
        if "<|" in chunk:       # may hold a special token's string
            ids = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, dtype="<u4").tobytes()
        elif chunk.isascii() and chunk.isprintable():
            ids = b"".join(map(self._word, self.ASCII.findall(chunk.lower())))
        else:
            normal = self.tokenizer.normalizer.normalize_str(chunk)
            ids = b"".join(self._word(w) for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal))
        if len(self.chunks) < self.most:
            self.chunks[chunk] = ids
        return ids

    def encode(self, text):
        """Little-endian unsigned 32-bit ids as bytes."""
        parts = text.replace("\n", " ").split(" ")
        found = list(map(self.chunks.get, parts))
        if None in found:
            found = [self._chunk(p) if f is None else f for p, f in zip(parts, found)]
        return b"".join(found)


def tokenized_pieces(docs, sequence=SEQUENCE, path=None, end_id=END_ID, with_ids=False):
    """(doc_id, piece, start, length, ids_crc32, uid[, ids]): the pieces of every document.

    A null text is an empty one: a single end id.  ``uid`` tells pieces apart that are equal.
    ``ids`` are the piece's ids as little-endian unsigned 32-bit numbers.
    """
    rows = pick(docs, "doc_id", "text")
    kept = docs.sparkSession.sparkContext.broadcast({})     # a worker keeps its encoder with this value
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "uid"] + ["ids"] * with_ids
    schema = T.StructType([rows.schema["doc_id"]] + [
        T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()), T.StructField("uid", T.LongType())]
        + [T.StructField("ids", T.BinaryType())] * with_ids)

    def run(batches):
        import public_tokenizers
        import pyarrow as pa
        from pyspark import TaskContext

        held = kept.value
        if "encoder" not in held:
            held["encoder"] = ChunkEncoder(path or public_tokenizers.path(VOCABULARY))
        encoder = held["encoder"]
        end = np.array([end_id], dtype="<u4").tobytes()
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            owner, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                data = encoder.encode(text or "") + end
                for number, at in enumerate(range(0, len(data), 4 * sequence)):
                    part = data[at:at + 4 * sequence]
                    owner.append(row)
                    piece.append(number)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            made = [batch.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                    pa.array(np.arange(uid, uid + len(owner)))]
            uid += len(owner)
            yield pa.RecordBatch.from_arrays(made + [pa.array(ids, pa.binary())] * with_ids, names=names)

    return rows.mapInArrow(run, schema)


# the linear program

def best_fills(lengths, weights, sequence):
    """For every capacity the best value and the length that was put in last, or 0."""
    value, last = np.zeros(sequence + 1), np.zeros(sequence + 1, np.int64)
    for room in range(1, sequence + 1):
        fits = np.searchsorted(lengths, room, "right")
        value[room], last[room] = value[room - 1], 0
        if fits:
            options = value[room - lengths[:fits]] + weights[:fits]
            best = int(fits - 1 - options[::-1].argmax())       # of equal options the longest piece
            if options[best] > value[room]:
                value[room], last[room] = options[best], lengths[best]
    return value, last


def _fill(room, last):
    """The lengths of the best fill of a capacity."""
    chosen = []
    while room > 0:
        if last[room]:
            chosen.append(int(last[room]))
            room -= int(last[room])
        else:
            room -= 1
    return chosen


def solve_configurations(histogram, sequence=SEQUENCE, rounds=ROUNDS, step=STEP, rate=RATE, gap=GAP):
    """({configuration (lengths, largest first): fractional number}, bound).

    ``histogram[l]`` is the number of pieces of length l, for l below ``sequence``.  The amounts
    cover all but ``gap`` of the tokens, or what can be covered in ``rounds`` rounds by configurations priced
    close to the best; the rest is left to best-fit.  ``bound`` is the best dual value found: no
    packing has fewer sequences, because prices under which no configuration costs more than one
    value the histogram at no more than the least number of configurations.
    """
    need = histogram.astype(float)
    left, amounts, bound = need.copy(), {}, 0.0
    tokens = float(np.arange(len(need)) @ need)
    for _ in range(rounds):
        lengths = np.flatnonzero(left > 1e-9)
        if float(lengths @ left[lengths]) <= gap * tokens:
            break
        share = left[lengths] / need[lengths]
        weights = lengths / sequence * np.exp(rate * (share - share.mean()))
        value, last = best_fills(lengths, weights, sequence)
        bound = max(bound, float(need[lengths] @ weights) / value[sequence])
        price = weights + value[sequence - lengths]
        taken = 0.0
        # the lengths that are covered least come first
        for at in np.argsort(-share, kind="stable"):
            length = int(lengths[at])
            if left[length] <= 1e-9 or price[at] < (1 - SLACK) * value[sequence]:
                continue
            chosen = sorted([length, *_fill(sequence - length, last)], reverse=True)
            kinds, times = np.unique(chosen, return_counts=True)
            amount = step * float((left[kinds] / times).min())
            if amount * len(chosen) < 1e-6:
                continue
            left[kinds] -= amount * times
            amounts[tuple(chosen)] = amounts.get(tuple(chosen), 0.0) + amount
            taken += amount
        if taken <= 0:
            break
    return amounts, bound


def round_configurations(histogram, amounts, sequence=SEQUENCE):
    """[(configuration, whole number)] that holds every piece of the histogram exactly once."""
    left = histogram.astype(np.int64).copy()
    chosen, carried = [], 0.0
    for configuration, amount in sorted(amounts.items(), key=lambda x: (-sum(x[0]), -x[1], x[0])):
        kinds, times = np.unique(configuration, return_counts=True)
        carried += amount
        number = min(int(carried), int((left[kinds] // times).min()))
        carried = min(carried - number, 1.0)
        if number > 0:
            left[kinds] -= number * times
            chosen.append((configuration, number))
    # what is left, best-fit and largest first: every step uses up a length
    while (there := np.flatnonzero(left)).size:
        room, configuration, used = sequence, [], np.zeros_like(left)
        while True:
            fitting = there[(there <= room) & (left[there] > used[there])]
            if not len(fitting):
                break
            length = int(fitting[-1])
            used[length] += 1
            configuration.append(length)
            room -= length
        kinds = np.flatnonzero(used)
        number = int((left[kinds] // used[kinds]).min())
        left -= number * used
        chosen.append((tuple(configuration), number))
    return chosen


def places(chosen, sequence=SEQUENCE):
    """Arrays (key, base, offset), sorted by key = length << 44 | first rank.

    The pieces of a length with ranks from one entry to the next lie at ``offset`` of the sequences
    from ``base`` on, one in each.
    """
    taken = np.zeros(sequence + 1, np.int64)
    keys, bases, offsets, base = [], [], [], 0
    for configuration, number in chosen:
        offset = 0
        for length in configuration:
            keys.append(length << 44 | int(taken[length]))
            bases.append(base)
            offsets.append(offset)
            taken[length] += number
            offset += length
        base += number
    order = np.argsort(np.array(keys, np.int64))
    return tuple(np.array(v, np.int64)[order] for v in (keys, bases, offsets))


def plan_sequences(histogram, sequence=SEQUENCE, rounds=ROUNDS):
    """The places of all pieces; full pieces take a sequence each.

    With few pieces of many lengths most amounts are below one and rounding loses more than the
    program gains; the plan is then that of best-fit alone, so it is never worse.
    """
    below = histogram.copy()
    full, below[sequence] = int(histogram[sequence]), 0
    amounts, _ = solve_configurations(below, sequence, rounds)
    chosen = min((round_configurations(below, a, sequence) for a in (amounts, {})), key=lambda c: sum(n for _, n in c))
    return places(chosen + [((sequence,), full)] * (full > 0), sequence)


# rows

def ranked_pieces(pieces, histogram, cell_rows=CELL_ROWS):
    """``pieces`` with ``rank``, gapless from 0 within a length.

    A length is split into cells of about ``cell_rows`` rows by a hash of the piece, so a length
    that holds a third of all rows is ranked by many tasks.
    """
    spark = pieces.sparkSession
    cells = [(int(n), int(-(-histogram[n] // cell_rows))) for n in np.flatnonzero(histogram)]
    per_length = spark.createDataFrame(cells, "length long, cells long")      # one row per length
    celled = pieces.join(F.broadcast(per_length), "length").withColumn(
        "cell", F.pmod(F.xxhash64("uid"), F.col("cells"))).drop("cells")
    counts = celled.groupBy("length", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("cell_start"))
    inside = Window.partitionBy("length", "cell").orderBy("uid")
    return celled.withColumn("in_cell", F.row_number().over(inside)).join(offsets, ["length", "cell"]).withColumn(
        "rank", F.col("cell_start") + F.col("in_cell") - 1).drop("cell", "cell_start", "in_cell")


def pack_documents(docs, sequence=SEQUENCE, path=None, end_id=END_ID, rounds=ROUNDS, with_ids=False):
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]), one row per piece.

    Sequences hold at most ``sequence`` tokens, their pieces follow each other without gaps.  Null
    and empty texts have one piece, the end id.  Equal rows are packed as often as they stand.  An
    empty table gives no rows.  Of ``docs`` only doc_id and text are read.
    """
    pieces = cut(tokenized_pieces(docs, sequence, path, end_id, with_ids))
    histogram = np.zeros(sequence + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():      # at most ``sequence`` rows
        histogram[row["length"]] = row["count"]
    plan = docs.sparkSession.sparkContext.broadcast(plan_sequences(histogram, sequence, rounds))
    ranked = ranked_pieces(pieces, histogram)
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = T.StructType([ranked.schema[c] for c in kept[:5]] + [
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())] + [ranked.schema[c] for c in kept[5:]])

    def run(batches):
        import pyarrow as pa

        keys, bases, offsets = plan.value
        for batch in batches:
            key = batch.column("length").to_numpy() << 44 | batch.column("rank").to_numpy()
            at = np.searchsorted(keys, key, "right") - 1
            made = [pa.array(bases[at] + key - keys[at]), pa.array(offsets[at])]
            columns = [batch.column(c) for c in kept[:5]] + made + [batch.column(c) for c in kept[5:]]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return ranked.select(*kept, "rank").mapInArrow(run, schema)
