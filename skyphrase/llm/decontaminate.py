"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by size into powers of two (their length in shingles, and their distinct shingles where those are
fewer).  For a partition of items of up to u shingles, every document is covered by windows of 2u consecutive shingles,
u apart, so a copy of an item lies whole in some window that is at most four times as large; that turns containment in
a document of any length into a Jaccard similarity of 0.17 or more (0.75 of an item, worst case).  Each window's
MinHash values, under FUNCTIONS functions, are looked up in the partition's table of item values; one agreement makes a
candidate, so a passage is missed with (1 - 0.17)^96, under 1e-7.  Of shingles that lie scattered over a document each
window holds some, and the chances of the windows add up to as much (300 of 300 scattered items are found in a test).
Candidates are verified by exact containment of the item's shingle set in the document's.

Items are hashed once, in tasks, and written.  They are indexed in blocks: a block's tables of minima and its sets have
``BLOCK_BYTES`` bytes together, or hold one item; one block at a time is collected, sorted, broadcast, used for a pass over
the documents whose hits are written, and given back.  What is held has a fixed bound whatever the number of items;
each block, of some 25,000 items, is one more pass, and no pass has more than one Python stage.

Edge cases: null or empty texts match nothing; an item of fewer than five words is one shingle, its whole sequence,
and matches documents that consist of that sequence; ids are of any type that can be ordered, null ids are reported as
null; repeated rows (documents or items) are each reported; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructType

from .common import Scratch, binaries, by_slice, col, shielded, sized
from .rowlists import PLACE, filtered, placed, written_lists
from .textops import U64, Words

FUNCTIONS = 96
BLOCK_BYTES = 64 << 20
ENTRY = 12  # bytes of a minimum and its item in a table
_MULT = np.random.Generator(np.random.PCG64(11)).integers(0, 2**64, FUNCTIONS, dtype=U64) | U64(1)


def item_rows(part: pa.RecordBatch) -> pa.RecordBatch:
    """(item_id, n_words, n_item, shingles, minima) of items that have a word."""
    words = Words(col(part, "text"), fold=True)
    h, border = words.shingles(5)
    some = np.flatnonzero(np.diff(border))
    low = np.zeros((len(some), FUNCTIONS), dtype=U64)
    for f, m in enumerate(_MULT if len(some) else ()):
        low[:, f] = np.minimum.reduceat(h * m, border[some])
    where = np.concatenate([[0], np.cumsum(np.diff(border)[some])])
    return pa.RecordBatch.from_arrays(
        [col(part, "item_id").take(pa.array(some)), pa.array(words.count[some]), pa.array(np.diff(border)[some]), binaries(h, where), binaries(low, np.arange(len(some) + 1) * FUNCTIONS)],
        names=["item_id", "n_words", "n_item", "shingles", "minima"],
    )


class Index:
    """MinHash tables of one block of items, by partition."""

    def __init__(self, items: pa.Table):
        items = items.combine_chunks()
        self.ids = pa.concat_arrays(items["item_id"].chunks) if items.num_rows else pa.array([])
        self.copies = items["copies"].to_numpy()
        self.sets = [np.frombuffer(x, dtype=U64) for x in items["shingles"].to_pylist()]
        low = np.frombuffer(b"".join(items["minima"].to_pylist()), dtype=U64).reshape(-1, FUNCTIONS)
        words, size = items["n_words"].to_numpy(), items["n_item"].to_numpy()
        self.short: dict[int, list[int]] = {}
        parts: dict[int, list[int]] = {}
        for k in range(len(self.sets)):
            if words[k] < 5:
                self.short.setdefault(int(self.sets[k][0]), []).append(k)
            else:  # by the length of its passage, and by its distinct shingles where they are fewer
                for own in {int(words[k] - 5).bit_length(), int(size[k] - 1).bit_length()}:
                    parts.setdefault(own, []).append(k)
        self.parts = {}
        for own, members in sorted(parts.items()):
            at = np.array(members)
            order = np.argsort(low[at], axis=0, kind="stable")
            self.parts[own] = np.ascontiguousarray(np.take_along_axis(low[at], order, axis=0).T), np.ascontiguousarray(at[order].T.astype(np.int32))

    def candidates(self, words: Words, h: np.ndarray, border: np.ndarray) -> set[tuple[int, int]]:
        """(document's row, item) pairs that share a window's minimum; short items by their whole sequence."""
        found: set[tuple[int, int]] = set()
        if self.short:
            from .textops import whole

            for d in np.flatnonzero((words.count > 0) & (words.count < 5)).tolist():
                key = int(whole(words.hash[words.first[d] : words.first[d + 1]])[0])
                found.update((d, k) for k in self.short.get(key, ()))
        if not len(h) or not self.parts:
            return found
        least = min(self.parts)
        levels = []
        for size in range(least, max(self.parts) + 1):
            many = -(-np.diff(border) // (1 << size))
            at = np.concatenate([[0], np.cumsum(many)])
            doc = np.repeat(np.arange(len(many)), many)
            inner = np.arange(at[-1]) - at[doc]
            levels.append((size, doc, inner, at))
        for f, m in enumerate(_MULT):
            low = None
            for size, doc, inner, at in levels:
                if low is None:
                    low = np.minimum.reduceat(h * m, border[doc] + (inner << least))
                else:
                    low = np.minimum.reduceat(low, below[doc] + inner * 2)
                below = at
                if size not in self.parts:
                    continue
                wide = low.copy()
                same = doc[1:] == doc[:-1]
                wide[:-1][same] = np.minimum(low[:-1], low[1:])[same]
                values, members = self.parts[size][0][f], self.parts[size][1][f]
                lo = np.searchsorted(values, wide)
                near = np.minimum(lo, len(values) - 1)
                for w in np.flatnonzero(values[near] == wide).tolist():
                    end = np.searchsorted(values, wide[w], side="right")
                    found.update((int(doc[w]), int(k)) for k in members[lo[w] : end])
        return found

    def search(self, text: pa.Array, percent: int) -> list[tuple[int, int, int]]:
        """(row, item, shared shingles), verified on the full sets."""
        words = Words(text, fold=True)
        h, border = words.windows(5)
        hits, last, own = [], -1, None
        for d, k in sorted(self.candidates(words, h, border)):
            if words.count[d] < 5:
                hits.append((d, k, len(self.sets[k])))
                continue
            if d != last:
                own, last = np.unique(h[border[d] : border[d + 1]]), d
            shared = int(np.isin(self.sets[k], own, assume_unique=True).sum())
            if 100 * shared >= percent * len(self.sets[k]):
                hits.append((d, k, shared))
        return hits


def hashed_items(items: DataFrame, scratch: Scratch, block_bytes: int) -> tuple[DataFrame, int]:
    """The items' sets and minima, equal ones once, and in how many blocks they are worked off."""
    kind = items.select("item_id").schema["item_id"].dataType
    schema = StructType().add("item_id", kind).add("n_words", LongType()).add("n_item", LongType()).add("shingles", BinaryType()).add("minima", BinaryType())
    hashed = items.select("item_id", F.col("text").cast("string").alias("text")).mapInArrow(by_slice(item_rows), schema)
    sets = scratch.write(hashed.groupBy(*schema.names).agg(F.count("*").alias("copies")))
    total = sets.agg(F.sum(F.col("n_item") * 8 + 2 * FUNCTIONS * ENTRY)).first()[0] or 0
    return sets, -(-total // block_bytes)


def index(sets: DataFrame, blocks: int, k: int):
    """The index of one block, broadcast."""
    own = sets if blocks == 1 else sets.where(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)) == k)
    return sets.sparkSession.sparkContext.broadcast(Index(own.orderBy("item_id", "shingles").toArrow()))


def indexes(items: DataFrame, block_bytes: int = BLOCK_BYTES):
    """Broadcast indexes, one block of items after the other."""
    scratch = Scratch(items.sparkSession)
    sets, blocks = hashed_items(items, scratch, block_bytes)
    for k in range(blocks):
        yield index(sets, blocks, k)
    scratch.drop(sets)


def contamination(docs: DataFrame, items: DataFrame, percent: int = 75, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment): items of which a document holds ``percent`` of the shingles."""
    scratch = Scratch(docs.sparkSession)
    kind = items.select("item_id").schema["item_id"].dataType
    schema = StructType().add("doc_id", LongType()).add("item_id", kind).add("n_item", LongType()).add("n_shared", LongType()).add("containment", DoubleType())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def hits(held) -> DataFrame:
        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            own = held.value
            found = [hit for hit in own.search(col(part, "text"), percent) for _ in range(own.copies[hit[1]])]
            rows, which, shared = (np.array([hit[k] for hit in found], dtype=np.int64) for k in range(3))
            sizes = np.array([len(own.sets[k]) for k in which], dtype=np.int64)
            return pa.RecordBatch.from_arrays(
                [col(part, "doc_id").take(pa.array(rows)), own.ids.take(pa.array(which)), pa.array(sizes), pa.array(shared), pa.array(shared / np.maximum(sizes, 1))], names=schema.names
            )

        return texts.mapInArrow(by_slice(work), schema)

    return _each_block(items, scratch, block_bytes, hits, docs.sparkSession.createDataFrame([], schema))


def _each_block(items: DataFrame, scratch: Scratch, block_bytes: int, hits, none: DataFrame) -> DataFrame:
    """``hits`` of all blocks.  Those of a lone block are left to the reader; of several, each block's are written, and its
    index is given back, before the next is built: no task ever holds two."""
    sets, blocks = hashed_items(items, scratch, block_bytes)
    out = none
    for k in range(blocks):
        held = index(sets, blocks, k)
        if blocks == 1:
            out = hits(held)
        else:
            out = out.unionByName(scratch.write(hits(held)))
            held.destroy()
    scratch.drop(sets)
    return out


def uncontaminated(docs: DataFrame, items: DataFrame, percent: int = 75, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item.

    With one block of items texts are searched as they pass.  With several, each block's pass writes what it finds, and that
    is dropped in one pass at the end: rows by file and place, or, where ``docs`` aren't the rows of files, texts by digest.
    """
    scratch = Scratch(docs.sparkSession)
    docs, restore = shielded(docs, "text")
    sets, blocks = hashed_items(items, scratch, block_bytes)
    if blocks == 1:
        held = index(sets, 1, 0)

        def clean(part: pa.RecordBatch) -> pa.RecordBatch:
            keep = np.ones(part.num_rows, dtype=bool)
            keep[[d for d, _, _ in held.value.search(col(part, "text"), percent)]] = False
            return part.filter(pa.array(keep))

        scratch.drop(sets)
        return restore(docs.mapInArrow(by_slice(clean), docs.schema))
    scratch.drop(sets)
    if not blocks:
        return restore(docs)

    table = placed(docs)
    if table is not None:  # what is found is listed by file, for the tasks that scan it

        def places(held) -> DataFrame:
            def work(part: pa.RecordBatch) -> pa.RecordBatch:
                rows = sorted({d for d, _, _ in held.value.search(col(part, "text"), percent)})
                return part.select(list(PLACE)).take(pa.array(rows, pa.int64()))

            return table.select(F.col("text").cast("string").alias("text"), *PLACE).mapInArrow(by_slice(work), "_f string, _r long")

        found = _each_block(items, scratch, block_bytes, places, docs.sparkSession.createDataFrame([], "_f string, _r long"))
        return restore(filtered(docs, table, written_lists(found, scratch), keep=False))

    def hits(held) -> DataFrame:
        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            rows = sorted({d for d, _, _ in held.value.search(col(part, "text"), percent)})
            texts = col(part, "text").take(pa.array(rows, pa.int64())).to_pylist()
            return pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(t.encode()).digest() for t in texts], pa.binary())], names=["_key"])

        return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(by_slice(work), "_key binary").distinct()

    found = _each_block(items, scratch, block_bytes, hits, docs.sparkSession.createDataFrame([], "_key binary"))
    keys = scratch.write(found.distinct().sort("_key"))
    marked = docs.withColumn("_own", F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)))
    return restore(marked.join(sized(keys), F.col("_own") == F.col("_key"), "left_anti").drop("_own"))
