"""Quality classifier by hierarchical empirical Bayes: document evidence with host and path posteriors.

A logistic regression over text statistics, fitted on at most ``SAMPLE`` labelled rows, gives each document's own
probability of being good.  Those are summed by host and by path within host (grouped aggregation over all documents,
with map-side partial sums).  Beta priors are fitted by moments: hosts shrink toward the global mean, paths toward
their host, the more the fewer documents they have.  A document's posterior adds to its own log odds what its path's
posterior, without the document itself, says beyond the global mean, weighted by ``SITE_WEIGHT``.

Documents have no address here, so the host is ``source`` and the path ``lang`` within it; both are parameters.
Statistics of sites are written and meet documents in an equi-join: up to ``common.BROADCAST_ROWS`` sites are broadcast,
and the documents stay in place; more meet them in a shuffle by host and path, with hot sites split by Spark.

Edge cases: null or empty texts have all-zero statistics and are judged like other very short texts; null hosts or
paths are a site of their own; repeated rows count as often as they stand; labels that occur more than once count by
their smallest value; without labels of both kinds the evidence is neutral and all documents are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text_stats
from .common import Scratch, by_slice, col, shielded, sized
from .textops import IS_SPACE, Words

SAMPLE = 20_000
SITE_WEIGHT = 0.5
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[ord(c) for c in "!?;:=~^_{}[]()\\/\"'"]] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
FEATURES = 10


def features(text: pa.Array) -> np.ndarray:
    """One row of statistics per text, each of order one."""
    words = Words(text)
    n = np.maximum(words.count, 1)
    dup, lines = text_stats.dup_lines(words)
    held = text_stats.byte_counts(words)
    distinct = np.zeros(words.n)
    for d in range(words.n):
        distinct[d] = len(np.unique(words.hash[words.first[d] : words.first[d + 1]]))
    return np.stack([
        np.minimum(np.log1p(words.count), 5.0) / 5,
        text_stats.repeat_words(words) / n,
        dup / np.maximum(lines, 1),
        np.minimum(text_stats.symbols(held) / n, 2.0),
        10 * text_stats.share(_UPPER, held),
        10 * text_stats.share(_MARK, held),
        10 * text_stats.share(_DIGIT, held),
        np.minimum(text_stats.word_chars(held) / n, 20.0) / 10,
        np.where(words.count >= 20, distinct / n, 0.7),
        5 * text_stats.share(IS_SPACE, held),
    ], axis=1)


def train(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps with classes weighted equally; weights, the intercept last."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    if len(set(y.tolist())) < 2:
        return w
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) * len(y)
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty * w
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(texts: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Trains on the labelled rows with the least hashes, ``sample`` at most; only their statistics are collected."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = features(col(part, "text"))
        return pa.RecordBatch.from_arrays([col(part, "doc_id"), pa.array(list(rows), pa.list_(pa.float64())), col(part, "quality")], names=["doc_id", "x", "quality"])

    # the sample is bounded (16 bytes a row), so that broadcasting it is too, and texts aren't shuffled
    got = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", F.col("quality").cast("int").alias("quality"))
    # equal rows count once, and however many rows bear a doc_id, no more than the sample are collected
    rows = got.mapInArrow(by_slice(work), "doc_id long, x array<double>, quality int").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(sample).collect()
    if not rows:
        return np.zeros(FEATURES + 1)
    order = sorted((tuple(r["x"]), r["quality"]) for r in rows)
    return train(np.array([x for x, _ in order]), np.array([q for _, q in order]))


def evidence(docs: DataFrame, weights: np.ndarray, column: str = "_logit") -> DataFrame:
    """All columns of ``docs`` and the document's own log odds."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        logit = np.clip(features(col(part, "text")) @ weights[:-1] + weights[-1], -12, 12)
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(logit)], names=[*part.schema.names, column])

    from pyspark.sql.types import DoubleType, StructType

    return docs.mapInArrow(by_slice(work), StructType([*docs.schema.fields]).add(column, DoubleType()))


def strength(mean: float, weighted_var: float, sampling: float) -> float:
    """Prior strength of a beta distribution of group means by moments, between 1 and 10,000 documents."""
    between = max(weighted_var - sampling, 1e-9)
    return float(np.clip(mean * (1 - mean) / between - 1, 1.0, 1e4))


def posteriors(scored: DataFrame, scratch: Scratch) -> tuple[DataFrame, float, float]:
    """Site table (host, path, host_mean, path_n, path_sum), global mean and the paths' prior strength.

    ``scored`` has host, path and p.
    """
    paths = scratch.write(scored.groupBy("host", "path").agg(F.count("*").alias("path_n"), F.sum("p").alias("path_sum"), F.sum(F.expr("p * (1 - p)")).alias("path_var")))
    hosts = paths.groupBy("host").agg(F.sum("path_n").alias("host_n"), F.sum("path_sum").alias("host_sum"))
    total = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_sum").alias("s"), F.count("*").alias("k")).first()
    if not total["n"]:
        return paths.select("host", "path", F.lit(0.5).alias("host_mean"), "path_n", "path_sum"), 0.5, 1.0
    mean = min(max(total["s"] / total["n"], 1e-6), 1 - 1e-6)
    h = hosts.agg(F.sum(F.expr(f"host_n * pow(host_sum / host_n - {mean!r}D, 2)")).alias("v")).first()
    host_strength = strength(mean, h["v"] / total["n"], mean * (1 - mean) * total["k"] / total["n"])
    means = hosts.select(F.col("host").alias("of"), F.expr(f"(host_sum + {host_strength!r}D * {mean!r}D) / (host_n + {host_strength!r}D)").alias("host_mean"))
    # written, so that its size is known when the documents are joined: small, it is broadcast and texts stay in place
    sites = scratch.write(paths.join(means, F.expr("host <=> of")).select("host", "path", "host_mean", "path_n", "path_sum"))
    p = sites.agg(F.sum(F.expr("path_n * pow(path_sum / path_n - host_mean, 2)")).alias("v"), F.count("*").alias("k")).first()
    return sites, mean, strength(mean, p["v"] / total["n"], mean * (1 - mean) * p["k"] / total["n"])


def judged(scored: DataFrame, scratch: Scratch, sites_of: DataFrame) -> DataFrame:
    """Adds _host_mean, _path_mean, _doc_score, _quality and _kept to rows with _host, _path and _logit.

    ``sites_of`` has the _host, _path and _logit of all documents.
    """
    p = F.expr("1 / (1 + exp(-_logit))")
    sites, mean, kappa = posteriors(sites_of.select(F.col("_host").alias("host"), F.col("_path").alias("path"), p.alias("p")), scratch)
    sites = sites.select(F.col("host").alias("_h"), F.col("path").alias("_p"), F.col("host_mean").alias("_host_mean"), F.col("path_n").alias("_n"), F.col("path_sum").alias("_s"))
    out = scored.join(sized(sites), F.expr("_host <=> _h and _path <=> _p"), "left").withColumn("_doc_score", p)
    # the path's posterior without the document itself
    path_mean = F.expr(f"(_s - _doc_score + {kappa!r}D * _host_mean) / (_n - 1 + {kappa!r}D)")
    out = out.withColumn("_path_mean", F.least(F.greatest(path_mean, F.lit(1e-6)), F.lit(1 - 1e-6)))
    lift = F.log(F.col("_path_mean") / (1 - F.col("_path_mean"))) - F.lit(float(np.log(mean / (1 - mean))))
    out = out.withColumn("_quality", 1 / (1 + F.exp(-(F.col("_logit") + F.lit(SITE_WEIGHT) * lift))))
    return out.withColumn("_kept", F.col("_quality") >= 0.5).drop("_h", "_p", "_n", "_s")


def _sited(docs: DataFrame, host: str, path: str) -> DataFrame:
    return docs.withColumn("_host", F.col(host).cast("string")).withColumn("_path", F.col(path).cast("string"))


def good_documents(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns.  Texts are read twice rather than shuffled."""
    scratch = Scratch(docs.sparkSession)
    docs, restore = shielded(docs, *dict.fromkeys(["doc_id", "text", host, path]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    weights = fit(texts, labels, sample)
    rows = _sited(docs, host, path)
    narrow = scratch.write(evidence(rows.select("_host", "_path", "text"), weights).drop("text"))
    return restore(judged(evidence(rows, weights), scratch, narrow).where("_kept"))


def site_quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, host, path, doc_score, host_posterior, path_posterior, quality, kept) for every row."""
    scratch = Scratch(docs.sparkSession)
    rows = _sited(docs, host, path).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "_host", "_path")
    weights = fit(rows.select("doc_id", "text"), labels, sample)
    once = scratch.write(evidence(rows, weights).drop("text"))
    return judged(once, scratch, once).select(
        "doc_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_doc_score").alias("doc_score"),
        F.col("_host_mean").alias("host_posterior"), F.col("_path_mean").alias("path_posterior"), F.col("_quality").alias("quality"), F.col("_kept").alias("kept"),
    )
