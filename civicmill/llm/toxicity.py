"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Every word has two inputs: what its whole form says and what its characters say.  Both are a log
odds learned from labelled documents plus a trained embedding, of the word and of its character
4- to 7-grams.  The network reads windows of words in both directions, attention weighs the
states, and a logistic unit scores the window.  A window begins at every fourth word, in training as
in scoring, so a passage of up to 21 words lies in one window as a whole; the largest score of a
text, calibrated by the number of windows, is the text's.

Labels are of documents, so training looks at the window that seems most toxic in each document,
by the log odds at first and by the network itself later, and at other windows of clean documents.
Log odds for training come from the other folds of the sample.
"""

import itertools

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicmill.llm.common import held_out, labelled_sample, map_batches, pick

WINDOW, STRIDE = 24, 4
HIDDEN, EMBED, BUCKETS = 8, 6, 1 << 18
SMALL = 4096                # rows of each embedding table
PER_LABEL = 1500            # training documents of each label at most
MAX_CHARS = 40_000          # longer documents are scored, but not learned from
THRESHOLD = 0.3
GRAMS = range(4, 8)
WORDS_KEPT = 200_000        # words whose inputs a worker remembers
PRODUCT = 512               # windows per matrix product; another number would round otherwise
AT_ONCE = 4 * PRODUCT       # windows that go through the steps together
SCORED_AT_ONCE = 8192       # windows held as rows of words
STATIC = 4
FOLDS = 4
RANDOM_CLEAN = 2            # random windows of each clean document, in each round
MOST_EPOCHS = 8             # over the sample, in each round
DECAY = 0.97                # of the embeddings, each step
INPUTS = STATIC + 2 * EMBED


# words

def normal(chunk):
    """The chunk in lower case, without what is neither letter nor digit at its ends."""
    word = chunk.lower()
    if word.isalnum():
        return word
    start, end = 0, len(word)
    while start < end and not word[start].isalnum():
        start += 1
    while end > start and not word[end - 1].isalnum():
        end -= 1
    return word[start:end]


def gram_hashes(words):
    """(hashes, starts): hashed character grams of each word between its marks, word by word.

    The first hash of a word is that of its whole form.
    """
    text = "".join(f"\x02{w}\x03" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    lengths = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    begins = np.cumsum(lengths) - lengths
    place = np.arange(len(codes)) - np.repeat(begins, lengths)
    after = np.repeat(lengths, lengths) - place             # characters from here to the word's end
    with np.errstate(over="ignore"):
        rolled = codes * np.uint64(0x9E3779B97F4A7C15)
        sums = np.cumsum(rolled * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)))
        whole = sums[begins + lengths - 1] - np.r_[np.uint64(0), sums[begins[1:] - 1]] if len(words) else sums
        whole = whole ^ whole >> np.uint64(29)
        owners, hashes = [np.arange(len(words))], [(whole * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(46)]
        word_of = np.repeat(np.arange(len(words)), lengths)
        mixed = rolled
        for n in range(2, GRAMS[-1] + 1):
            mixed = mixed[:-1] * np.uint64(0x100000001B3) ^ rolled[n - 1:]
            if n in GRAMS:
                inside = np.flatnonzero(after[:len(mixed)] >= n)
                owners.append(word_of[inside])
                hashes.append((mixed[inside] * np.uint64(0x94D049BB133111EB) + np.uint64(n)) >> np.uint64(46))
    owners, hashes = np.concatenate(owners), np.concatenate(hashes).astype(np.int64)
    order = np.argsort(owners, kind="stable")
    counts = np.bincount(owners, minlength=len(words))
    return hashes[order], np.cumsum(counts) - counts


def word_inputs(words, odds, model):
    """[n, INPUTS]: log odds of form and characters, then the two embeddings."""
    if not len(words):
        return np.zeros((0, INPUTS), np.float32)
    hashes, starts = gram_hashes(words)
    count = np.diff(np.r_[starts, len(hashes)])
    return np.hstack([odds_inputs(hashes, starts, count, odds), embeddings(hashes, starts, count, model)])


def odds_inputs(hashes, starts, count, odds):
    values = odds[hashes]
    form = values[starts]
    grams = values.copy()
    grams[starts] = -9.0
    most = np.maximum.reduceat(grams, starts)
    most = np.where(most < -8, 0, most)
    grams[starts] = 0.0
    mean = np.add.reduceat(grams, starts) / np.maximum(count - 1, 1)
    return np.stack([form, most, mean, np.minimum(count, 60) / 30], axis=1).astype(np.float32)


def embeddings(hashes, starts, count, model):
    by_word = model["word"][hashes[starts] % SMALL]
    chars = model["char"][hashes % SMALL].copy()
    chars[starts] = 0.0
    by_char = np.add.reduceat(chars, starts, axis=0) / np.maximum(count - 1, 1)[:, None]
    return np.hstack([by_word, by_char]).astype(np.float32)


def log_odds(docs, labels, positions):
    """[BUCKETS] log odds of toxic against clean documents that hold a gram, shrunk toward 0."""
    toxic, clean = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for i in positions:
        (toxic if labels[i] else clean)[docs[i]] += 1
    n_toxic, n_clean = max(1, sum(labels[i] for i in positions)), max(1, sum(1 - labels[i] for i in positions))
    odds = np.log((toxic / n_toxic + 0.5 / n_toxic) / (clean / n_clean + 0.5 / n_clean))
    # rare grams are not trusted; those that no document holds say nothing
    return (odds * (toxic + clean) / (toxic + clean + 3) * (toxic + clean > 0)).astype(np.float32)


# the network

def empty_model(seed=5):
    rng = np.random.default_rng(seed)

    def make(*shape):
        return (rng.normal(size=shape) * (1 / np.sqrt(shape[0]))).astype(np.float32)

    return {
        "word": (rng.normal(size=(SMALL, EMBED)) * 0.05).astype(np.float32),
        "char": (rng.normal(size=(SMALL, EMBED)) * 0.05).astype(np.float32),
        "wx": make(INPUTS, 6 * HIDDEN), "b": np.zeros(6 * HIDDEN, np.float32),
        "uf": make(HIDDEN, 3 * HIDDEN), "ub": make(HIDDEN, 3 * HIDDEN),
        "att": make(2 * HIDDEN, 2 * HIDDEN), "query": make(2 * HIDDEN, 1)[:, 0],
        "out": make(2 * HIDDEN, 1)[:, 0], "bias": np.zeros(1, np.float32),
    }


def sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def one_way(projected, mask, u, backwards, trace=None):
    """States [T, B, H] of one direction; ``projected`` is [T, B, 3H], ``mask`` [T, B]."""
    steps, batch, _ = projected.shape
    states = np.zeros((steps, batch, HIDDEN), np.float32)
    h = np.zeros((batch, HIDDEN), np.float32)
    for t in (range(steps - 1, -1, -1) if backwards else range(steps)):
        recurrent = h @ u
        gates = sigmoid(projected[t, :, :2 * HIDDEN] + recurrent[:, :2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        candidate = np.tanh(projected[t, :, 2 * HIDDEN:] + r * recurrent[:, 2 * HIDDEN:])
        move = (1 - z) * mask[t][:, None]
        if trace is not None:
            trace[t] = (h, z, r, candidate, recurrent[:, 2 * HIDDEN:])
        h = h + move * (candidate - h)
        states[t] = h
    return states


def pooled(states, mask, model):
    """(attention [T, B], pooled [B, 2H], hidden attention layer)."""
    hidden = np.tanh(states @ model["att"])
    weight = np.where(mask > 0, hidden @ model["query"], -30.0)
    weight = np.exp(weight - weight.max(0))
    weight /= weight.sum(0)
    return weight, np.einsum("tb,tbh->bh", weight, states), hidden


def both_ways(model):
    """One recurrent matrix for both directions; its rows are update, reset and candidate, each forwards then backwards."""
    u = np.zeros((3, 2, HIDDEN, 2, HIDDEN), np.float32)
    for way, name in ((0, "uf"), (1, "ub")):
        u[:, way, :, way] = model[name].T.reshape(3, HIDDEN, HIDDEN)
    return u.reshape(6 * HIDDEN, 2 * HIDDEN)


def projected(inputs, model):
    """[6H, words]: inputs times wx.  A sigmoid halves what it is given, so the rows of gates are halved here, which changes no bit."""
    rows = (inputs @ model["wx"] + model["b"]).astype(np.float32)
    half = np.tile(np.repeat(np.array([0.5, 0.5, 1], np.float32), HIDDEN), 2)
    return np.ascontiguousarray((rows * half).T)


def window_logits(table, ids, model):
    """Logits of windows; ``ids`` is [B, T] columns of ``table`` (as of ``projected``), -1 where there is no word.

    What ``one_way`` and ``pooled`` compute, with the windows in the last axis, so that each step works on long rows.
    """
    logits = np.empty(len(ids), np.float32)
    u, att = both_ways(model), np.ascontiguousarray(model["att"].T)
    u[:4 * HIDDEN] *= 0.5
    forward, backward = table.reshape(2, 3 * HIDDEN, -1)
    for at in range(0, len(ids), AT_ONCE):
        part = ids[at:at + AT_ONCE].T
        steps, batch = part.shape
        seen = part >= 0
        whole = bool(seen.all())
        # [update/reset/candidate, direction, H, T, B]; the backward half of a step is that of the step it meets
        given = np.empty((3, 2, HIDDEN, steps, batch), np.float32)
        given[:, 0] = np.take(forward, part, axis=1, mode="clip").reshape(3, HIDDEN, steps, batch)
        given[:, 1] = np.take(backward, part[::-1], axis=1, mode="clip").reshape(3, HIDDEN, steps, batch)
        given = given.reshape(6 * HIDDEN, steps, batch)
        states = np.empty((steps, 2 * HIDDEN, batch), np.float32)
        h = np.zeros((2 * HIDDEN, batch), np.float32)
        recurrent = np.empty((6 * HIDDEN, batch), np.float32)
        for t in range(steps):
            back = steps - 1 - t
            for k in range(0, batch, PRODUCT):
                np.matmul(u, h[:, k:k + PRODUCT], out=recurrent[:, k:k + PRODUCT])
            gates, candidate = recurrent[:4 * HIDDEN], recurrent[4 * HIDDEN:]
            gates += given[:4 * HIDDEN, t]
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            move, reset = gates[:2 * HIDDEN], gates[2 * HIDDEN:]
            np.subtract(1, move, out=move)
            if not whole:
                move[:HIDDEN] *= seen[t]
                move[HIDDEN:] *= seen[back]
            candidate *= reset
            candidate += given[4 * HIDDEN:, t]
            np.tanh(candidate, out=candidate)
            candidate -= h
            candidate *= move
            h += candidate
            states[t, :HIDDEN], states[back, HIDDEN:] = h[:HIDDEN], h[HIDDEN:]
        hidden = np.empty_like(states)
        for k in range(0, batch, PRODUCT):
            np.matmul(att, states[:, :, k:k + PRODUCT], out=hidden[:, :, k:k + PRODUCT])
        weight = model["query"] @ np.tanh(hidden, out=hidden)
        if not whole:
            weight = np.where(seen, weight, -30.0)
        weight -= weight.max(0)
        np.exp(weight, out=weight)
        weight /= weight.sum(0)
        weight *= model["out"] @ states
        logits[at:at + AT_ONCE] = weight.sum(0) + model["bias"][0]
    return logits


def gradients(inputs, mask, y, model):
    """Gradients of the log loss over a batch of windows; ``inputs`` is [T, B, INPUTS]."""
    projected = inputs @ model["wx"] + model["b"]
    traces = [{}, {}]
    ways = [one_way(projected[:, :, i * 3 * HIDDEN:(i + 1) * 3 * HIDDEN], mask, model["uf" if i == 0 else "ub"], i == 1, traces[i])
            for i in (0, 1)]
    states = np.concatenate(ways, axis=2)
    weight, pool, hidden = pooled(states, mask, model)
    p = sigmoid(pool @ model["out"] + model["bias"][0])
    d_logit = (p - y) / len(y)
    g = {"out": pool.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
    d_pool = d_logit[:, None] * model["out"]
    d_states = weight[:, :, None] * d_pool[None]
    d_weight = np.einsum("tbh,bh->tb", states, d_pool)
    d_score = weight * (d_weight - (weight * d_weight).sum(0))
    g["query"] = np.einsum("tbh,tb->h", hidden, d_score)
    d_hidden = d_score[:, :, None] * model["query"] * (1 - hidden ** 2)
    g["att"] = np.einsum("tbh,tbk->hk", states, d_hidden)
    d_states = d_states + d_hidden @ model["att"].T
    d_projected = np.zeros_like(projected)
    for i, name in ((0, "uf"), (1, "ub")):
        u, g[name] = model[name], np.zeros_like(model[name])
        d_h = np.zeros((len(y), HIDDEN), np.float32)
        steps = range(len(mask))
        for t in (steps if i else reversed(steps)):
            h, z, r, candidate, recurrent = traces[i][t]
            d_h = d_h + d_states[t, :, i * HIDDEN:(i + 1) * HIDDEN]
            m = mask[t][:, None]
            d_candidate = d_h * (1 - z) * m * (1 - candidate ** 2)
            d_z = d_h * (h - candidate) * m * z * (1 - z)
            d_r = d_candidate * recurrent * r * (1 - r)
            d_gates = np.concatenate([d_z, d_r, d_candidate], axis=1)
            d_recurrent = np.concatenate([d_z, d_r, d_candidate * r], axis=1)
            d_projected[t, :, i * 3 * HIDDEN:(i + 1) * 3 * HIDDEN] = d_gates
            g[name] += h.T @ d_recurrent
            d_h = d_h * (1 - (1 - z) * m) + d_recurrent @ u.T
    g["wx"] = np.einsum("tbi,tbk->ik", inputs, d_projected)
    g["b"] = d_projected.sum((0, 1))
    return g, d_projected @ model["wx"].T


def windows(n):
    """First words of the windows of a text of ``n`` words: each overlaps the next, the last ends with it."""
    return np.r_[np.arange(0, n - WINDOW, STRIDE), max(0, n - WINDOW)]


def window_rows(rows, firsts):
    """[windows, WINDOW]: the rows of the words of each window, -1 where there is no word."""
    at = firsts[:, None] + np.arange(WINDOW)
    return np.where(at < len(rows), rows[np.minimum(at, len(rows) - 1)], -1) if len(rows) else np.full(at.shape, -1)


# training

def train(texts, labels, rounds=3, steps=250, seed=11):
    """The model, from whole texts and 0/1 labels; None if a label is missing or no text has a word.

    Each round takes about ``steps`` batches, fewer for a small sample.
    """
    labels = [int(v) for v in labels]
    if len(set(labels)) < 2:
        return None
    rng, model = np.random.default_rng(seed), empty_model()
    vocabulary, docs = {}, []
    for text in texts:
        docs.append(np.array([vocabulary.setdefault(normal(c), len(vocabulary)) for c in text.split()], np.int64))
    words = list(vocabulary)
    if not words:
        return None
    hashes, starts = gram_hashes(words)
    ends = np.r_[starts[1:], len(hashes)]
    held = [np.unique(np.concatenate([hashes[starts[w]:ends[w]] for w in np.unique(d)])) if len(d) else np.zeros(0, np.int64)
            for d in docs]
    fold = rng.permutation(len(docs)) % FOLDS
    everything = range(len(docs))
    count = ends - starts
    static = np.stack([odds_inputs(hashes, starts, count, log_odds(held, labels, [i for i in everything if fold[i] != f]))
                       for f in range(FOLDS)])

    def table_of(f):
        inputs = np.hstack([static[f], embeddings(hashes, starts, count, model)])
        return projected(inputs, model)

    firsts = [windows(len(d)) for d in docs]
    ids = [window_rows(d, f) for d, f in zip(docs, firsts)]
    worst = [int(np.where(w >= 0, static[fold[i]][w][:, :, :2].sum(2), 0).max(1).argmax()) for i, w in enumerate(ids)]
    state = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.items()}
    step = 0
    y_all = np.array(labels, np.float32)
    toxic_share = y_all.mean()
    clean = np.flatnonzero(y_all == 0)
    for round_ in range(rounds):
        if round_:
            for f in range(FOLDS):
                table, mine = table_of(f), [i for i in everything if fold[i] == f]
                scored = window_logits(table, np.concatenate([ids[i] for i in mine]), model) if mine else np.zeros(0)
                at = 0
                for i in mine:
                    worst[i] = int(scored[at:at + len(ids[i])].argmax())
                    at += len(ids[i])
        # the worst window of every document, and random ones of every clean document
        chosen = [(i, worst[i]) for i in everything] + [(int(i), int(rng.integers(len(ids[i])))) for i in np.repeat(clean, RANDOM_CLEAN)]
        size = min(128, max(8, len(chosen) // 20))
        for _ in range(min(MOST_EPOCHS, -(-steps * size // len(chosen)))):
            order = rng.permutation(len(chosen))
            for at in range(0, len(order), size):
                batch = [chosen[k] for k in order[at:at + size]]
                rows = np.stack([ids[i][w] for i, w in batch]).T
                folds = np.array([fold[i] for i, _ in batch])
                mask = (rows >= 0).astype(np.float32)
                safe = np.maximum(rows, 0)
                used, inverse = np.unique(safe, return_inverse=True)
                inverse = inverse.reshape(safe.shape)
                spans = np.concatenate([hashes[starts[w]:ends[w]] for w in used])
                begins = np.cumsum(count[used]) - count[used]
                embedded = embeddings(spans, begins, count[used], model)
                # most windows show log odds only, so no document is learned by heart
                shown = (rng.random(len(batch)) < 0.25)[None, :, None]
                inputs = np.concatenate([static[folds[None, :], safe], embedded[inverse] * shown], axis=2) * mask[:, :, None]
                g, d_inputs = gradients(inputs, mask, y_all[[i for i, _ in batch]], model)
                d_inputs = d_inputs * mask[:, :, None]
                per_word = np.zeros((len(used), 2 * EMBED), np.float32)
                np.add.at(per_word, inverse, d_inputs[:, :, STATIC:] * shown)
                g["word"], g["char"] = np.zeros_like(model["word"]), np.zeros_like(model["char"])
                np.add.at(g["word"], hashes[starts[used]] % SMALL, per_word[:, :EMBED])
                of_chars = np.ones(len(spans), bool)
                of_chars[begins] = False        # the first hash of a word is its form's
                np.add.at(g["char"], spans[of_chars] % SMALL, np.repeat(
                    per_word[:, EMBED:] / np.maximum(count[used] - 1, 1)[:, None], count[used] - 1, axis=0))
                step += 1
                for k, v in g.items():      # Adam, with decay
                    model[k] *= DECAY if k in ("word", "char") else 1.0
                    m, s = state[k]
                    m += 0.1 * (v - m)
                    s += 0.001 * (v * v - s)
                    model[k] -= 0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-7)
    # calibration of the largest logit, on inputs whose log odds come from the other folds
    best = np.zeros(len(docs))
    for f in range(FOLDS):
        table = table_of(f)
        for i in everything:
            if fold[i] == f:
                best[i] = window_logits(table, ids[i], model).max()
    counts = np.log([len(f) for f in firsts])
    model["calibration"] = calibrate(best, counts, y_all, toxic_share)
    model["odds"] = log_odds(held, labels, everything)
    return model


def calibrate(best, counts, y, share):
    """Weights of (largest logit, log number of windows, 1) by Newton's method."""
    x = np.stack([np.clip(best, -12, 12), counts, np.ones(len(y))], axis=1)
    w = np.array([1.0, 0.0, np.log(share / (1 - share))])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + 0.1 * np.eye(3)
        move = np.linalg.solve(hessian, x.T @ (p - y) + 0.1 * (w - [1.0, 0.0, 0.0]))
        w -= move / max(1.0, np.abs(move).max())
    return w


# scoring

class Scorer:
    """Scores whole texts; remembers the projected inputs of words, up to a fixed number."""

    def __init__(self, model, most=WORDS_KEPT):
        self.model, self.most = model, most
        self.known, self.table = {}, np.zeros((6 * HIDDEN, max(1, most)), np.float32)  # a word to point at, if there is no word

    def rows(self, docs):
        """(table of the projected inputs of words, columns of it for each document).

        The words beyond the number remembered are put behind the others, for this call only.
        """
        known, fresh = self.known, {}
        for chunks in docs:
            fresh.update(dict.fromkeys(itertools.filterfalse(known.__contains__, chunks)))
        if not fresh:
            return self.table, [np.fromiter(map(known.__getitem__, chunks), np.int32, len(chunks)) for chunks in docs]
        names, at = list(fresh), len(known)
        inputs = [word_inputs([normal(c) for c in names[i:i + 20_000]], self.model["odds"], self.model) for i in range(0, len(names), 20_000)]
        made = np.concatenate([projected(i, self.model) for i in inputs], axis=1)
        room = self.most - at
        self.table[:, at:min(at + len(names), self.most)] = made[:, :room]
        known.update(zip(names[:room], range(at, self.most)))
        table = self.table
        if len(names) > room:
            place = dict(zip(names[room:], range(table.shape[1], table.shape[1] + len(names) - room)))
            table, known = np.concatenate([table, made[:, room:]], axis=1), known | place
        return table, [np.fromiter(map(known.__getitem__, chunks), np.int32, len(chunks)) for chunks in docs]

    def score(self, texts):
        """A probability for each text."""
        best = np.full(len(texts), -np.inf)
        counts = np.zeros(len(texts))
        table, rows = self.rows([(t or "").split() for t in texts])
        waiting, ids, owners = 0, [], []
        for i, d in enumerate(rows):
            firsts = windows(len(d))
            counts[i] = np.log(len(firsts))
            for at in range(0, len(firsts), SCORED_AT_ONCE):
                ids.append(window_rows(d, firsts[at:at + SCORED_AT_ONCE]))
                owners.append(np.full(len(ids[-1]), i))
                waiting += len(ids[-1])
                if waiting >= SCORED_AT_ONCE:
                    self._keep(best, table, ids, owners)
                    waiting, ids, owners = 0, [], []
        if ids:
            self._keep(best, table, ids, owners)
        a, b, c = self.model["calibration"]
        return 1 / (1 + np.exp(-np.clip(a * np.clip(best, -12, 12) + b * counts + c, -30, 30)))

    def _keep(self, best, table, ids, owners):
        np.maximum.at(best, np.concatenate(owners), window_logits(table, np.concatenate(ids), self.model))


# jobs

def fit(docs, labels, per_label=PER_LABEL):
    """Train on a bounded sample: at most ``per_label`` documents of each label, none held out."""
    rows = labelled_sample(docs, labels, "toxic", per_label, MAX_CHARS).collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["text"]))
    return train([r["text"] for r in rows], [r["value"] > 0 for r in rows])


def score_toxicity(docs, model):
    """(doc_id, score), one row per row of ``docs`` (doc_id, text); only the text decides.

    Null, empty and blank texts are one window without words.  Without a model (a label was
    missing, or no text to learn from had a word) every score is 0.  Repeated rows and equal texts get equal scores, null ids are kept, an empty
    table gives no rows, and columns other than doc_id and text are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        held = shared.value
        if held and "scorer" not in held:       # a worker keeps it, with the words it remembers, over its tasks
            held["scorer"] = Scorer(held)
        scorer = held["scorer"] if held else None

        def compute(batch):
            texts, scores = batch.column("text").to_pylist(), []
            for at in range(0, len(texts), 500):
                part = texts[at:at + 500]
                scores.append(scorer.score(part) if scorer else np.zeros(len(part)))
            return [np.concatenate(scores) if scores else np.zeros(0)]

        return compute

    return map_batches(pick(docs, "doc_id", "text"), ["doc_id"], [("score", T.DoubleType())], start)


def toxicity_digest(docs, labels, threshold=THRESHOLD):
    scored = score_toxicity(docs, fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
