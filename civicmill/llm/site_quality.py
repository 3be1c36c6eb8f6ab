"""Quality classifier: hierarchical empirical Bayes over documents, hosts and paths.

A logistic regression on measures of the text gives every document's evidence.  The mean of the
documents' probabilities is the global prior.  A host's rate is its own mean, shrunk toward the
global prior as if that had been seen on a number of documents, the strength, and a path's rate is
shrunk toward its host's in the same way.  The strengths are estimated from the sites by the method of moments:
the variance of documents within a path, over that of hosts around the prior, and over that of
paths around their hosts.  So sites that hardly differ get nearly the prior, and sites that differ
much keep their own rate.  The posterior adds the document's log odds to those of its path.

A document's ``source`` names its site: ``host/path...``, of which the first part is the host and the
first two are the path.  A source without a path has one path per language.
"""

import numpy as np
from pyspark.sql import functions as F

from civicmill.llm.common import WORD, held_out, labelled_sample, pick, words_of
from civicmill.session import cut

PER_LABEL = 3000            # training documents of each label at most
MAX_CHARS = 200_000         # longer documents are scored, but not learned from
MOST_STRENGTH = 1e9         # documents that a prior counts for where the sites do not differ
WEIGHT = 0.5                # of the site's log odds, relative to the document's
REJECT_BELOW = 0.5
FEATURES = ["log_words", "word_length", "symbols", "capitals", "marks", "short", "distinct", "same_next", "line_words",
            "repeat_lines", "bars"]


def with_features(rows):
    """``rows`` with ``x``, an array of doubles, one for each of ``FEATURES``; built-in functions only."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = rows.withColumns({
        "words": words_of(text), "lines": F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)),
        "capitals": F.length(F.regexp_replace(text, "[^A-Z\u00c0-\u00de]+", ""))})
    n = F.greatest(F.size("words"), F.lit(1)).cast("double")
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    n_lines = F.greatest(F.size("lines"), F.lit(1)).cast("double")

    def share(characters):
        return F.regexp_count(text, F.lit(f"[{characters}]")) / chars

    same_next = F.zip_with(F.col("words"), F.slice("words", F.lit(2), F.size("words")), lambda a, b: a == b)
    return split.withColumn("x", F.array(
        F.log(n + 1),
        F.least(chars / n, F.lit(30.0)) / 10,
        share("#*$%&<>"),
        F.col("capitals") / chars,
        share("!?"),
        F.size(F.filter("words", lambda w: F.length(w) <= 3)) / n,
        F.size(F.array_distinct("words")) / F.pow(n, F.lit(0.8)),
        F.size(F.filter(same_next, lambda same: same)) / n,
        F.least(n / n_lines, F.lit(200.0)) / 100,
        (F.size("lines") - F.size(F.array_distinct("lines"))) / n_lines,
        share("|"))).drop("words", "lines", "capitals")


def train_logistic(x, y, penalty=1e-3, steps=60):
    """Weights with a bias, by Newton's method on scaled features; both classes weigh the same."""
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 1).sum()))
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (weight * (p - y)) + penalty * w
        hessian = (z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + penalty * np.eye(len(w))
        move = np.linalg.solve(hessian, gradient)
        w -= move
        if np.abs(move).max() < 1e-6:
            break
    return np.r_[w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum()]


def quadratic(values):
    """The features and their squares."""
    return np.hstack([values, values * values])


def fit(docs, labels, per_label=PER_LABEL):
    """Weights from a bounded sample of labelled documents that are not held out.

    Without both labels in it nothing can be learned, and every document gets even odds.
    """
    sample = labelled_sample(docs, labels, "quality", per_label, MAX_CHARS)
    rows = with_features(sample).select("doc_id", "value", "x").orderBy("doc_id", "x").collect()
    y = np.array([float(r["value"] > 0) for r in rows])
    if len(set(y.tolist())) < 2:
        return np.zeros(2 * len(FEATURES) + 1)
    return train_logistic(quadratic(np.array([r["x"] for r in rows])), y)


def log_odds(weights):
    """The classifier as one expression over ``x``, within -12 and 12."""
    n = len(FEATURES)
    terms = [F.get("x", F.lit(i)) * float(weights[i]) + F.get("x", F.lit(i)) * F.get("x", F.lit(i)) * float(weights[n + i])
             for i in range(n)]
    return F.greatest(F.lit(-12.0), F.least(F.lit(12.0), sum(terms, F.lit(float(weights[-1])))))


def _logistic(x):
    return 1 / (1 + F.exp(-x))


def _site(source, lang):
    source = F.coalesce(source, F.lit(""))
    bare = F.regexp_replace(source, "^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    parts = F.split(bare, "[/?#]")
    second = F.get(parts, F.lit(1))
    return F.get(parts, F.lit(0)), F.when(second.isNotNull() & (second != ""), F.concat(F.lit("/"), second)).otherwise(
        F.concat(F.lit("lang:"), F.coalesce(lang, F.lit(""))))


def site_strengths(paths, hosts):
    """(strength of the prior, strength of a host's rate), by the method of moments.

    ``paths`` has host, path, path_n, path_sum and path_squares, ``hosts`` host, host_n and host_sum: counts and sums of
    the probabilities and of their squares, in millionths.  Only sums over all sites reach the driver.
    """
    million = 1_000_000
    nested = paths.join(hosts, "host")
    mean, own = F.col("path_sum") / F.col("path_n") / million, F.col("host_sum") / F.col("host_n") / million
    low = nested.agg(
        F.count("*"), F.sum("path_n"), F.sum(F.col("path_squares") / million - F.col("path_n") * mean * mean),
        F.sum(F.col("path_n") * (mean - own) * (mean - own)), F.sum(F.col("path_n") * (F.col("path_n") / F.col("host_n")))).first()
    n_paths, n, inside, between_paths, kept_paths = (float(v or 0) for v in low)
    top = hosts.agg(F.count("*"), F.sum("host_sum"), F.sum(F.col("host_n") * own * own), F.sum(F.col("host_n").cast("double") * F.col("host_n"))).first()
    n_hosts, all_sum, squares, kept_hosts = (float(v or 0) for v in top)
    if not n:
        return MOST_STRENGTH, MOST_STRENGTH
    within = max(0.0, inside) / max(1.0, n - n_paths)
    prior = all_sum / n / million

    def strength(between, degrees, size):
        variance = (between - degrees * within) / size if size > 0 else 0.0
        found = within / variance if variance > 0 else MOST_STRENGTH
        return float(f"{min(found, MOST_STRENGTH):.6g}")

    return (strength(squares - n * prior * prior, n_hosts - 1, n - kept_hosts / n),
            strength(between_paths, n_paths - n_hosts, n - kept_paths))


def posteriors(docs, labels, weight=WEIGHT):
    """(doc_id, row_key, evidence, host, path, host_rate, path_rate, score, rejected), one row per row.

    ``docs`` has doc_id, text, lang and source.  Null or empty texts have the features of an empty
    text, null sources and languages form a site of their own, equal rows get equal results.  An empty table
    gives no rows; other columns are not read.  Sums
    are of whole millionths, so they do not depend on the order of the rows.  Host and path sums
    are combined before the shuffle; a host that holds a third of all rows sends one row per task.
    """
    weights = fit(docs, labels)
    host, path = _site(F.col("source"), F.col("lang"))
    rows = with_features(pick(docs, "doc_id", "text", "lang", "source")).select(
        "doc_id", F.xxhash64("doc_id", "text", "lang", "source").alias("row_key"), host.alias("host"), path.alias("path"),
        log_odds(weights).alias("evidence"))
    rows = cut(rows)
    million = F.round(_logistic(F.col("evidence")) * 1_000_000).cast("long")
    square = F.round(F.pow(_logistic(F.col("evidence")), 2) * 1_000_000).cast("long")
    paths = rows.groupBy("host", "path").agg(F.count("*").alias("path_n"), F.sum(million).alias("path_sum"), F.sum(square).alias("path_squares"))
    paths = cut(paths)
    hosts = paths.groupBy("host").agg(F.sum("path_n").alias("host_n"), F.sum("path_sum").alias("host_sum"))
    to_prior, to_host = site_strengths(paths, hosts)
    whole = hosts.agg(F.sum("host_n"), F.sum("host_sum")).first()
    prior = F.lit(float(whole[1]) / whole[0] / 1_000_000 if whole[0] else 0.5)
    host_rate = (F.col("host_sum") / 1_000_000 + to_prior * prior) / (F.col("host_n") + to_prior)
    path_rate = (F.col("path_sum") / 1_000_000 + to_host * F.col("host_rate")) / (F.col("path_n") + to_host)
    rates = paths.join(hosts, "host").withColumn("host_rate", host_rate)
    rates = rates.withColumn("path_rate", path_rate).select("host", "path", "host_rate", "path_rate")

    def logit(p):
        held = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
        return F.log(held / (1 - held))

    score = _logistic(F.col("evidence") + weight * (logit(F.col("path_rate")) - logit(prior)))
    return rows.join(rates, ["host", "path"]).withColumn("score", F.round(score, 6)).withColumn(
        "rejected", F.col("score") < REJECT_BELOW).select(
        "doc_id", "row_key", "evidence", "host", "path", "host_rate", "path_rate", "score", "rejected")


def quality_digest(docs, labels):
    return posteriors(docs, labels).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "host", "path", F.round("evidence", 6).alias("evidence"),
        "score", "rejected")
