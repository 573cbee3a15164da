"""Periodic runs of words by Karp-Miller-Rosenberg naming: which stretches of a text repeat a phrase over and over.

Words are named by number, equal words alike; a name of level k stands for 2^k words in a row and comes from the pair of
names of level k - 1 that lie side by side, numbered in sorted order.  Names are exact: there is no hash, and nothing
sorts suffixes.  What occurs once at a level gets no name, so each level handles only places that still repeat, and
naming ends at the first level on which nothing does.

The length of the longest common extension of two places, forward or backward, is found by going down the levels: where
the names agree, both places move on by 2^k words.

A run of period q holds two neighbouring points of the grid 0, q, 2q, ... of its text.  For every q up to half the words
each pair of neighbouring grid points that hold equal words is a candidate; it is extended both ways, and is a run if
it comes to ``2 * q`` words or more.  That makes n ln n pairs for n words, worked off in blocks.  A stretch found with
several periods has the smallest: the others are its multiples.

All texts of a slice are worked off together; between two of them stands a word without a name, which nothing extends
over.  Memory: four bytes for each word and level (a level per doubling of the longest repeat) beside a block.

Edge cases: null and empty texts have no words and no runs, and their collapsed text is empty; rows pass through one
to one, so repeated rows and null doc_ids stay; texts are read whole, whatever their length; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_slice, col
from .textops import IS_SPACE, payload, word_bounds

LEAST = 12
PAIRS = 1 << 19


def vocabulary(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of all texts, end to end, as bytes; their numbers, equal words alike; the n + 1 borders by text."""
    buf, off = payload(texts)
    start, end = word_bounds(buf, off)
    edge = np.concatenate([[0], np.cumsum(end - start)])
    inside = buf[~IS_SPACE[buf]]
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(edge.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(inside))])
    return words, words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(start, off)


def _shared(key: np.ndarray) -> np.ndarray:
    """Numbers of the keys that occur twice or more, in sorted order; -1 for the others."""
    _, place, many = np.unique(key, return_inverse=True, return_counts=True)
    again = many > 1
    number = np.where(again, np.cumsum(again) - 1, -1)
    return number[place].astype(np.int32)


def levels(row: np.ndarray) -> list[np.ndarray]:
    """Names of 2^k elements from each place on, for k = 0, 1, ...; -1 where no other place has the same."""
    named = np.full(len(row), -1, dtype=np.int32)
    named[row >= 0] = _shared(row[row >= 0])
    out = []
    while len(named) and named.max() >= 0:
        out.append(named)
        step = 1 << (len(out) - 1)
        at = np.flatnonzero((named[:-step] >= 0) & (named[step:] >= 0))
        key = named[at].astype(np.int64) * (int(named.max()) + 1) + named[at + step]
        named = np.full(len(row), -1, dtype=np.int32)
        named[at] = _shared(key)
    return out


def extend(names: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
    """How many elements agree from places a and b on (``back``: before them)."""
    size = np.zeros(len(a), dtype=np.int64)
    for k in range(len(names) - 1, -1, -1):
        named, step = names[k], 1 << k
        x, y = (a - size - step, b - size - step) if back else (a + size, b + size)
        fit = x >= 0 if back else y < len(named)
        own = named[np.where(fit, x, 0)]
        size += step * (fit & (own >= 0) & (own == named[np.where(fit, y, 0)]))
    return size


def _least_period(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(start, end, period), sorted, each stretch once with its smallest period."""
    start, end, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])])[: len(start)]
    return start[first], end[first], period[first]


def runs(row: np.ndarray, border: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """(start, end, period) of all runs of ``least`` words or more, sorted by start and period.  ``border`` has the ends
    of the texts in ``row``, whose elements are equal where words are; places count over all texts."""
    count, texts = np.diff(border), len(border) - 1
    # a place of its own before each text and after the last, without a name
    spread = np.full(len(row) + texts + 1, -1, dtype=np.int64)
    spread[np.arange(len(row)) + np.repeat(np.arange(texts), count) + 1] = row
    names = levels(spread)
    none = np.zeros(0, dtype=np.int64)
    found = [(none, none, none)]
    if names:
        half = np.where(count >= least, count // 2, 0)
        text = np.repeat(np.arange(texts), half)
        period = np.arange(1, len(text) + 1) - np.repeat(np.cumsum(half) - half, half)
        edge = np.concatenate([[0], np.cumsum((count[text] - 1) // period)])
        base = border[text] + text + 1
        for p in range(0, int(edge[-1]), PAIRS):
            q = min(p + PAIRS, int(edge[-1]))
            a, b = np.searchsorted(edge, p, side="right") - 1, np.searchsorted(edge, q, side="left")
            many = np.minimum(edge[a + 1 : b + 1], q) - np.maximum(edge[a:b], p)
            step = np.repeat(period[a:b], many)
            x = np.repeat(base[a:b], many) + (np.arange(p, q) - np.repeat(edge[a:b], many)) * step
            own = names[0][x]
            hit = (own >= 0) & (own == names[0][x + step])
            x, step = x[hit], step[hit]
            before, after = extend(names, x, x + step, back=True), extend(names, x, x + step)
            hit = before + after + step >= np.maximum(least, 2 * step)
            x, step, before, after = x[hit], step[hit], before[hit], after[hit]
            if len(x):
                found.append(_least_period([(x - before, x + step + after, step)]))
    start, end, period = _least_period(found)
    shift = np.searchsorted(border + np.arange(texts + 1), start, side="left")  # a text's places lie behind so many others
    start, end = start - shift, end - shift
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _worked(texts: pa.Array, least: int) -> list[pa.Array]:
    """Number of words, runs as offsets of lists and their values, and the text without what runs repeat, by text."""
    words, row, border = vocabulary(texts)
    start, end, period = runs(row, border, least)
    own = np.searchsorted(border, start, side="right") - 1
    lists = pa.StructArray.from_arrays([pa.array(start - border[own]), pa.array(end - start), pa.array(period)], names=["start", "length", "period"])
    step = np.zeros(len(row) + 1, dtype=np.int64)
    np.add.at(step, start + period, 1)
    np.add.at(step, end, -1)
    kept = np.flatnonzero(np.cumsum(step)[:-1] == 0)
    left = pa.LargeListArray.from_arrays(pa.array(np.searchsorted(kept, border)), words.take(pa.array(kept)))
    return [
        pa.array(np.diff(border)),
        pa.ListArray.from_arrays(pa.array(np.searchsorted(own, np.arange(len(border))), pa.int32()), lists),
        pc.binary_join(left, pa.scalar(b" ", pa.large_binary())).cast(pa.large_string()),
    ]


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, text): every run of ``least`` words or more that holds its phrase twice, as (start, length,
    period) in words, by start and period; and the text without the words that some run holds after its first period,
    words joined by one space.  One pass; nothing is shuffled."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = col(part, "text")
        return pa.RecordBatch.from_arrays([col(part, "doc_id"), *_worked(texts, least)], names=["doc_id", "n_words", "runs", "text"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(by_slice(work), "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, text string")


def planted(doc_id: Column, text: Column) -> Column:
    """The text, but in one of ten documents, by crc32 of its doc_id, a phrase is repeated from some word on to the end."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        place = lambda i: F.when(i >= a, a + (i - a) % p).otherwise(i)
        picked = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(words, place(i).cast("int")))
        return F.when(n > 0, F.array_join(picked, " ")).otherwise(text)

    # one binding of the words: within a lambda they are taken out of the text once
    words = F.array(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    return F.when(h % 10 == 0, F.get(F.transform(words, repeated), 0)).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256): the longest run (the earliest
    of them, then that of the smallest period) and digests of all runs and of the collapsed text."""
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("less")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    rows = found.withColumn("_top", F.array_max(order))
    start, length, period = -F.col("_top.before"), F.col("_top.length"), -F.col("_top.less")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("collapsed_sha256"),
    )
