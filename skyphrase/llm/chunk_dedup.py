"""Substring dedup by content-defined chunks: a gear rolling hash cuts, digests tell which chunks repeat.

Cuts fall between words (inside very long ones also where the gear hash has four zero bits, and every ``CAP`` bytes
or up to three more).  The gear hash of a place sums table values of its last ``WINDOW`` bytes, each shifted once per
byte since; the text is cut at a word end whose hash is greater than those of the ``REACH`` word ends on either side.
A cut thus depends on the words around it alone: chunks vary in length, are hardly ever much longer than the usual,
and fall back into step ``REACH`` words after an insertion.  Where no hash stands out (``REACH`` equal words and more)
a chunk ends after ``MOST`` words.

Chunk rows are written once.  The first use counts, by digest, whether two documents hold the chunk (partial minimum
and maximum of doc_id, so a chunk that most documents share costs a row per task); these digests are written, and
joined back to the chunk rows as a table of one row per digest, so that Spark may split a hot digest on the side of
the rows.  Adjoining repeated chunks are merged, and runs of ``RUN`` words or more are reported.

What is found: the chunks of a run lie inside the passage that two documents share, so a run is never longer than that
passage, and none is reported that shares fewer than ``RUN`` words.  At either end up to a chunk and ``REACH`` words
of the passage can't be in step; of passages of 51 words, 99 in 100 keep ``RUN`` words in step, and 997 in 1000 of
those of 64 (measured on words of the test tables).  Of passages between 28 and 51 words some are reported.

Edge cases: null or empty texts, and texts of white space, have no chunks; rows with a null doc_id have no owner and
are left out; rows of one doc_id are one document, so that what only they share isn't a repeat, but each different
text of it is reported by itself, under its ``text_id``, and equal ones once; a repeat within one text isn't one
across documents; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, by_slice, col
from .textops import BLOCK_BYTES, U64, code_points, mix, payload, span_hash, word_bounds

WINDOW = 8
REACH = 3
MOST = 64
LONG = 32
CAP = 4096
RUN = 28
_GEAR = np.random.Generator(np.random.PCG64(32)).integers(0, 2**64, 256, dtype=U64)


def gear(buf: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte, over WINDOW bytes."""
    h = _GEAR[buf]
    s = 1
    while s < WINDOW:
        more = h.copy()
        more[s:] += h[:-s] << U64(s)
        h, s = more, 2 * s
    return h


def units(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a chunk may end (word ends, and some within long words), ascending, and the gear hash there."""
    start, end = word_bounds(buf, off)
    long = np.flatnonzero(end - start > LONG)
    begin, stop, point = start[long], end[long], code_points(buf)
    places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, U64)]
    for a in range(0, len(buf), BLOCK_BYTES):
        b = min(a + BLOCK_BYTES, len(buf))
        lead = min(a, WINDOW - 1)
        h = gear(buf[a - lead : b])[lead:]  # h[p - 1 - a]: the hash of the bytes before place p
        found = end[slice(*np.searchsorted(end, [a + 1, b + 1]))]
        lo, hi = np.searchsorted(stop, a, side="right"), np.searchsorted(begin, b)
        if lo < hi:  # places p, a < p <= b, within long words
            first = np.maximum(begin[lo:hi] + 1, a + 1)
            many = np.maximum(np.minimum(stop[lo:hi] - 1, b) - first + 1, 0)
            p = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
            inner = p - np.repeat(begin[lo:hi], many)
            over = inner % CAP
            ends = (((h[p - 1 - a] & U64(15)) == 0) & (inner >= WINDOW)) | (over == 0) | ((over <= 3) & ~point[p - over])
            found = np.sort(np.concatenate([found, p[ends & point[p]]]))
        places.append(found)
        hashes.append(mix(h[found - 1 - a]))
    place, value = np.concatenate(places), np.concatenate(hashes)
    value[place - off[np.searchsorted(off, place) - 1] < WINDOW] = 0  # the hash has seen another text
    return place, value


def chunks(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first byte, end, words) of all chunks of texts that lie end to end in ``buf``."""
    place, value = units(buf, off)
    if not len(place):
        return place, place, place, place
    doc = np.searchsorted(off, place) - 1
    cut = np.ones(len(place), dtype=bool)
    for d in range(1, REACH + 1):
        near = doc[d:] == doc[:-d]
        cut[d:] &= ~near | (value[d:] > value[:-d])
        cut[:-d] &= ~near | (value[:-d] >= value[d:])
    cut[-1] = True
    cut[:-1] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(cut)
    size = np.diff(at, prepend=-1)
    long = np.flatnonzero(size > MOST)
    if len(long):
        at = np.sort(np.concatenate([at, *[np.arange(at[k] - size[k] + MOST, at[k], MOST) for k in long]]))
        size = np.diff(at, prepend=-1)
    own = doc[at]
    end = place[at].copy()
    fresh = np.concatenate([[True], own[1:] != own[:-1]])
    begin = np.where(fresh, off[own], np.concatenate([[0], end[:-1]]))
    final = np.concatenate([fresh[1:], [True]])
    end[final] = off[own[final] + 1]  # what follows the last word is its chunk's
    return own, begin, end, size


def chunk_rows(part: pa.RecordBatch) -> pa.RecordBatch:
    """(digest, doc_id, text_id, span, words) of every chunk; span holds its first character and its end, 32 bits each."""
    buf, off = payload(col(part, "text"))
    doc, begin, end, size = chunks(buf, off)
    digest = span_hash(buf, begin, end)
    if len(doc):
        lengths = np.add.reduceat(np.append(code_points(buf), False), np.stack([begin, end], axis=1).ravel(), dtype=np.int64)[::2]
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        many = np.diff(np.append(first, len(doc)))
        after = np.cumsum(lengths)
        after -= np.repeat(after[first] - lengths[first], many)
        text = np.repeat(np.add.reduceat(mix(digest ^ mix(after.astype(U64))), first) >> U64(32), many)
    else:
        lengths = after = text = doc
    span = ((after - lengths) << 32) | after
    return pa.RecordBatch.from_arrays(
        [pa.array(digest.view(np.int64)), col(part, "doc_id").take(pa.array(doc)), pa.array(text.astype(np.int64)), pa.array(span), pa.array(size.astype(np.int32))],
        names=["digest", "doc_id", "text_id", "span", "words"],
    )


def repeated_spans(docs: DataFrame, run: int = RUN) -> DataFrame:
    """(doc_id, text_id, span_start, span_end, n_words, n_chunks, first_doc_id, is_first): character spans that other
    documents hold too.

    ``first_doc_id`` is the least document that holds a chunk of the span; a dedup keeps the spans with ``is_first``.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    scratch = Scratch(docs.sparkSession)
    rows = scratch.write(texts.mapInArrow(by_slice(chunk_rows, limit=1 << 20), "digest long, doc_id long, text_id long, span long, words int"))
    shared = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last")
    shared = scratch.write(shared.select("digest", "first"))
    found = scratch.write(rows.join(shared, "digest").select("doc_id", "text_id", "span", "words", "first").distinct())
    scratch.drop(rows, shared)
    order = Window.partitionBy("doc_id", "text_id").orderBy("a")
    found = found.withColumn("a", F.shiftright("span", 32)).withColumn("b", F.col("span").bitwiseAND(F.lit(2**32 - 1)))
    found = found.withColumn("new", (F.coalesce(F.lag("b").over(order), F.lit(-1)) != F.col("a")).cast("int")).withColumn("run", F.sum("new").over(order))
    runs = found.groupBy("doc_id", "text_id", "run").agg(
        F.min("a").alias("span_start"), F.max("b").alias("span_end"), F.sum("words").alias("n_words"), F.count("*").alias("n_chunks"), F.min("first").alias("first_doc_id")
    )
    return runs.where(F.col("n_words") >= run).drop("run").withColumn("is_first", F.col("first_doc_id") == F.col("doc_id"))
