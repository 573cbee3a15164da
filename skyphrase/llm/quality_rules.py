"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio of trusted target against raw corpus.

Words and word pairs of every text fall into ``BUCKETS`` hash buckets.  Two multinomials are estimated with add-one
smoothing: the raw one over all documents, the target one over all documents with a trusted label.  A document's
score is the mean of log(target / raw) over its n-grams, so it doesn't depend on length, and every document is
decided by the same fixed threshold, in nats per n-gram.

Each task adds up its own counts before anything is shuffled; the model that is collected and broadcast has
``BUCKETS`` doubles whatever the corpus.  No text is shuffled to meet the trusted ids: up to ``BLOCK`` of them are broadcast, more
are listed by file (``rowlists.py``), so that texts are read twice in all, once to count and once to score.  Only where
documents aren't the rows of files are more ids broadcast range by range, each with a pass over the texts in it.

Edge cases: null and empty texts have no words, fail the base and aren't kept; repeated rows count as often as they
stand; a label that occurs more than once counts once; null labels or doc_ids match nothing; with no trusted
documents both multinomials are flat or raw, scores are those of an untrained target and the base rules still hold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text_stats
from .common import Scratch, by_slice, col
from .rowlists import PLACE, listed, placed
from .textops import Words

BUCKETS = 1 << 16
THRESHOLD = -0.08
BLOCK = 1 << 20
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def buckets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the texts, words first, then pairs; and their texts' rows."""
    pairs, border = words.windows(2)
    row = np.arange(words.n)
    h = np.concatenate([words.hash, pairs])
    return (h >> np.uint64(48)).astype(np.int64), np.concatenate([np.repeat(row, words.count), np.repeat(row, np.diff(border))])


def count_task(batches):
    """Adds up one task's n-gram counts: (bucket, raw, target)."""
    total = np.zeros((2, BUCKETS), dtype=np.int64)

    def work(part: pa.RecordBatch) -> None:
        own, row = buckets(Words(col(part, "text")))
        trusted = col(part, "trusted").to_numpy(zero_copy_only=False).astype(bool)
        total[0] += np.bincount(own, minlength=BUCKETS)
        total[1] += np.bincount(own[trusted[row]], minlength=BUCKETS)

    for _ in by_slice(work)(batches):
        pass
    some = np.flatnonzero(total[0])
    if len(some):
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0][some]), pa.array(total[1][some])], names=["bucket", "raw", "target"])


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    n = len(raw)
    return np.log((target + 1) / (target.sum() + n)) - np.log((raw + 1) / (raw.sum() + n))


def ranges(ids: DataFrame, n: int, most: int) -> list[tuple[int, int]]:
    """Ranges of ids, ends included, that hold all ``n`` distinct ids between them and at most ``most`` each."""
    parts = -(-5 * n // (4 * most)) if n > most else 1
    while True:
        points = [k / parts for k in range(1, parts)]
        cuts = ids.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, points)), F.lit(100 * parts)).alias("c")).first()["c"] if points else []
        low, high = -(2**63), 2**63 - 1
        border = sorted({low, *[c + 1 for c in cuts if c < high]})
        out = list(zip(border, [c - 1 for c in border[1:]] + [high], strict=True))
        if parts == 1:
            return out
        held = ids.agg(*[F.count_if(F.col("doc_id").between(a, b)).alias(f"n{k}") for k, (a, b) in enumerate(out)]).first()
        if max(held) <= most:
            return out
        parts *= 2


def marked(docs: DataFrame, ids: DataFrame, n: int, most: int, scratch: Scratch) -> list[DataFrame]:
    """Tables (text, trusted) that hold every text and, marked, each trusted one, once; those after the first hold trusted
    texts only.  Up to ``most`` ids are broadcast.  More are listed by file for the tasks that scan it; where rows aren't
    those of files, they are broadcast range by range, each with a pass of its own."""
    table = placed(docs) if n > most else None
    if table is not None:
        lists = listed(table, "doc_id", ids, scratch)

        def mark(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([col(batch, "text"), pa.array(lists.holds(batch))], names=["text", "trusted"])

        return [table.select("text", *PLACE).mapInArrow(mark, "text string, trusted boolean")]
    out = []
    for k, (a, b) in enumerate(ranges(ids, n, most)):
        block = F.broadcast(ids.where(F.col("doc_id").between(a, b)).withColumn("trusted", F.lit(True)))
        # the first pass counts every text, the others only what their range adds to the target
        own = docs.join(block, "doc_id", "left") if not k else docs.where(F.col("doc_id").between(a, b)).join(block, "doc_id")
        out.append(own.select("text", F.coalesce("trusted", F.lit(False)).alias("trusted")))
    return out


def fit(docs: DataFrame, trusted: DataFrame, most: int = BLOCK) -> np.ndarray:
    """The log ratio of each bucket; ``trusted`` has the doc_ids of the target."""
    scratch = Scratch(docs.sparkSession)
    ids = scratch.write(trusted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct())
    total = np.zeros((2, BUCKETS))
    for k, rows in enumerate(marked(docs, ids, ids.count(), most, scratch)):
        counts = rows.mapInArrow(count_task, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        for r in counts.collect():  # at most BUCKETS rows
            total[:, r["bucket"]] += (0 if k else r["raw"]), r["target"]
    scratch.release()
    return log_ratio(total[0], total[1])


def base_counts(words: Words) -> dict[str, np.ndarray]:
    held = text_stats.byte_counts(words)
    return {
        "n_words": words.count.astype(np.int64),
        "word_chars": text_stats.word_chars(held),
        "n_symbols": text_stats.symbols(held),
        "n_dup_lines": text_stats.dup_lines(words)[0],
        "n_repeat_words": text_stats.repeat_words(words),
    }


def quality(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, base counts, base_failed, kept, score) for every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, trusted))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(col(part, "text"))
        base = base_counts(words)
        own, row = buckets(words)
        grams = np.bincount(row, minlength=words.n)
        score = np.bincount(row, weights=model.value[own], minlength=words.n) / np.maximum(grams, 1)
        failed = (base["n_words"] < 20) | (100 * base["n_repeat_words"] > 30 * base["n_words"])
        return pa.RecordBatch.from_arrays(
            [col(part, "doc_id"), *[pa.array(base[c]) for c in BASE], pa.array(failed), pa.array(~failed & (score >= threshold)), pa.array(score)],
            names=["doc_id", *BASE, "base_failed", "kept", "score"],
        )

    return docs.mapInArrow(by_slice(work), "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, kept boolean, score double")
