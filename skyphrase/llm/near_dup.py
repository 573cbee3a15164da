"""Near-duplicate documents by a chosen-path set similarity join over MinHash vectors.

Each distinct shingle set (copies fall together by a 128-bit digest first) gets a vector of ``COORDS`` MinHash
values.  ``TREES`` independent trees start from one coordinate each; a node is the sets that agree on every chosen
coordinate of its path.  A node of at most ``NODE`` sets, of ``NODE_SHINGLES`` shingles together, is compared
exhaustively on the vectors; a larger one branches by ``BRANCHES`` further coordinates, chosen by the node's own hash,
down to ``DEPTH`` levels.  A node that is still larger then is done in blocks.  First every block is compared with
``LEADERS`` of the node's sets, which joins a group of near copies in time linear in its size.  Then pairs of blocks
are cells of their own, but for those of two blocks of the node's largest cluster: so no pair of different clusters is
lost, no task grows with a node, and the cells grow with what the leaders did not join, not with the square of a group.
Sets with a likely partner are compared again, node by node, on their full shingles.

No step makes a row per pair.  The comparison of vectors gives the rows that have a partner; the exact comparison
gives a spanning forest of each node's links, which leaves every component whole.  Links found by the first tree and
the leaders make clusters, and all else compares across clusters only, so a large group of near copies is done once.
Tables of minimums and of owners are written before they are joined, so that Spark may split a hot class.

Recall: a link of Jaccard J meets in a given tree with probability J, so eight trees miss (1 - J)^8, under 2e-5 at
0.75; links inside large nodes pass each further level with 1 - (1 - J)^2.  The vector estimate must be within
``SLACK`` of the threshold; that is over four standard deviations.

A class is known by 64 bits of its digest: among 10^10 different sets, some three pairs are taken for one.

Edge cases: null or empty texts and texts of white space have an empty set, are their own component and linked with
nothing; a null doc_id is never linked, its component is null and it is kept; each row is judged by its own text, so
repeated rows fall into one class and all rows that carry its smallest doc_id are kept; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from .common import Scratch, binaries, by_slice, col, shielded
from .graph import components
from .rowlists import among
from .textops import U64, Words, mix

COORDS = 64
TREES = 8
BRANCHES = 2
DEPTH = 4
NODE = 4096
NODE_SHINGLES = 4_000_000
LEADERS = 64
_COMMON = 64
SLACK = 0.25
_MULT = np.random.Generator(np.random.PCG64(7)).integers(0, 2**64, COORDS, dtype=U64) | U64(1)


def minhash(h: np.ndarray, border: np.ndarray) -> np.ndarray:
    """One row of COORDS 32-bit MinHash values per non-empty set."""
    filled = np.flatnonzero(np.diff(border))
    out = np.zeros((len(border) - 1, COORDS), dtype=np.uint32)
    if len(filled):
        at = border[filled]
        for j in range(COORDS):
            low = np.minimum.reduceat(h * _MULT[j], at)
            out[filled, j] = mix(low) >> U64(32)
    return out


def digests(h: np.ndarray, border: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that identify each set, as two signed longs."""
    filled = np.flatnonzero(np.diff(border))
    out = np.zeros((2, len(border) - 1), dtype=U64)
    if len(filled):
        at = border[filled]
        out[0, filled] = np.add.reduceat(mix(h ^ U64(0x5BF0)), at)
        out[1, filled] = np.add.reduceat(mix(h ^ U64(0xA1C3)), at)
    return out[0].view(np.int64), out[1].view(np.int64)


def sketch_rows(part: pa.RecordBatch) -> pa.RecordBatch:
    h, border = Words(col(part, "text"), fold=True).shingles(5)
    d1, d2 = digests(h, border)
    rows = minhash(h, border)
    return pa.RecordBatch.from_arrays(
        [col(part, "doc_id").cast(pa.int64()), pa.array(np.diff(border)), pa.array(d1), pa.array(d2), binaries(rows, np.arange(len(rows) + 1) * COORDS)],
        names=["doc_id", "n_shingles", "d1", "d2", "sketch"],
    )


def own_class(part: pa.RecordBatch) -> pa.RecordBatch:
    """(cid, text): the class that each text belongs to."""
    d1, _ = digests(*Words(col(part, "text"), fold=True).shingles(5))
    return pa.RecordBatch.from_arrays([pa.array(d1), col(part, "text")], names=["cid", "text"])


def _nodes(batches, emit):
    """Hands ``emit`` whole nodes of rows sorted by node: a table of several, and their borders."""
    rest = None
    for batch in batches:
        own = pa.Table.from_batches([batch])
        rows = own if rest is None else pa.concat_tables([rest, own])
        node = rows["node"].to_numpy()
        cut = np.flatnonzero(node[1:] != node[:-1]) + 1
        upto = int(cut[-1]) if len(cut) else 0
        rest = rows.slice(upto)
        if upto:
            yield from emit(rows.slice(0, upto).combine_chunks(), np.concatenate([[0], cut]))
    if rest is not None and rest.num_rows:
        yield from emit(rest.combine_chunks(), np.array([0, rest.num_rows]))


def alike_in_nodes(threshold: float):
    """mapInArrow: rows (node, cid) that have a partner in their node, of another cluster, with an agreeing vector."""

    def partners(n, cluster, side, vec) -> np.ndarray:
        hit = np.zeros(len(n), dtype=bool)
        for k in range(len(n) - 1):
            fits = (np.minimum(n[k + 1 :], n[k]) >= threshold * np.maximum(n[k + 1 :], n[k])) & (cluster[k + 1 :] != cluster[k])
            if side[k] >= 0:  # a cell of two blocks compares across them only
                fits &= side[k + 1 :] != side[k]
            at = np.flatnonzero(fits)
            if len(at):
                at = at[(vec[k + 1 + at] == vec[k]).mean(axis=1) >= threshold - SLACK]
                if len(at):
                    hit[k] = True
                    hit[k + 1 + at] = True
        return hit

    def emit(rows: pa.Table, border: np.ndarray):
        cluster, n, side = rows["cluster"].to_numpy(), rows["n"].to_numpy(), rows["side"].to_numpy()
        vec = np.frombuffer(b"".join(rows["sketch"].to_pylist()), dtype=np.uint32).reshape(-1, COORDS)
        hit = np.zeros(len(n), dtype=bool)
        for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True):
            if b - a > 1:
                hit[a:b] = partners(n[a:b], cluster[a:b], side[a:b], vec[a:b])
        if hit.any():
            yield from rows.select(["node", "cid"]).filter(pa.array(hit)).to_batches()

    return lambda batches: _nodes(batches, emit)


def links_in_nodes(percent: int):
    """mapInArrow: exact links of each node's full sets, thinned to a spanning forest of the node."""

    def emit(rows: pa.Table, border: np.ndarray):
        cid, text = rows["cid"].to_numpy(), rows["text"].chunk(0)
        out: list[tuple[int, int]] = []
        for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True):
            h, at = Words(text.slice(a, b - a), fold=True).shingles(5)
            out += [(int(cid[a + x]), int(cid[a + y])) for x, y in forest(h, at, percent) if cid[a + x] != cid[a + y]]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])

    return lambda batches: _nodes(batches, emit)


def forest(h: np.ndarray, border: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the links 100 * |intersection| >= percent * |union| between sets, exactly."""
    size = np.diff(border)
    many = len(size)
    _, ids, df = np.unique(h, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(many), size)
    order = np.argsort(ids, kind="stable")
    row, ids, df = row[order], ids[order], df[ids[order]]
    common = np.zeros((many, many), dtype=np.int32)
    # shingles of few sets: their pairs one by one; of many sets: a product of incidence matrices, in blocks
    few = df < _COMMON
    r, i = row[few & (df > 1)], ids[few & (df > 1)]
    for k in range(1, _COMMON - 1):
        at = np.flatnonzero(i[k:] == i[:-k]) if k < len(i) else ()
        if not len(at):
            break
        np.add.at(common, (r[at], r[at + k]), 1)
    common += common.T
    r, i = row[~few], np.cumsum(np.concatenate([[0], np.diff(ids[~few]) > 0])) if not few.all() else ids[:0]
    for lo in range(0, int(i[-1]) + 1 if len(i) else 0, 512):
        x, y = np.searchsorted(i, [lo, lo + 512])
        has = np.zeros((many, 512), dtype=np.float32)
        has[r[x:y], i[x:y] - lo] = 1
        for at in range(0, many, 512):  # a product counts up to 512, which 32-bit floats hold exactly
            common[at : at + 512] += (has[at : at + 512] @ has.T).astype(np.int32)
    out, left = [], np.ones(many, dtype=bool)
    for start in range(many):
        if not left[start]:
            continue
        left[start] = False
        todo = [start]
        while todo:
            own = todo.pop()
            shared = common[own].astype(np.int64)
            linked = left & (shared > 0) & (100 * shared >= percent * (size[own] + size - shared))
            for other in np.flatnonzero(linked).tolist():
                left[other] = False
                out.append((own, other))
                todo.append(other)
    return out


def tree_nodes(classes: DataFrame, scratch: Scratch, node_limit: int, depth: int) -> tuple[DataFrame, DataFrame | None]:
    """Leaf rows (tree, node, cid, side) of nodes within the limit, and rows (tree, node, cid, n, size, total) of those
    that are larger after all branching, if there are any."""
    value = lambda c: F.expr(f"substring(sketch, {4 * c} + 1, 4)")
    pick = lambda k: F.expr(f"substring(sketch, 4 * cast(pmod(xxhash64(node, {k}), {COORDS}) as int) + 1, 4)")
    rows = classes.select(F.posexplode(F.array(*[F.xxhash64(F.lit(t), value(t)) for t in range(TREES)])).alias("tree", "node"), "cid", "n")
    small = (F.col("size") <= node_limit) & (F.col("total") <= NODE_SHINGLES)
    leaves, large = None, None
    for level in range(depth + 1):
        size = rows.groupBy("node").agg(F.count("*").alias("size"), F.sum("n").alias("total")).where("size > 1")
        held = scratch.write(rows.join(size, "node").select("tree", "node", "cid", "n", "size", "total"))
        own = held.where(small).select("tree", "node", "cid", F.lit(-1).alias("side"))
        leaves = own if leaves is None else leaves.unionByName(own)
        large = held.where(~small)
        if large.isEmpty():
            return leaves, None
        if level < depth:
            rows = large.join(classes.select("cid", "sketch"), "cid").select(
                "tree", F.explode(F.array(*[F.xxhash64("node", F.lit(k), pick(k)) for k in range(BRANCHES)])).alias("node"), "cid", "n"
            )
    return leaves, large


def _blocks(sets, shingles, node_limit: int):
    """In how many blocks sets are dealt so that two blocks make a node within the limits."""
    return F.greatest(F.ceil(sets / (node_limit // 2)), F.ceil(shingles / (NODE_SHINGLES // 2)), F.lit(1)).cast("int")


def _upto(count):
    return F.explode(F.sequence(F.lit(0), count - 1))


def leader_cells(large: DataFrame, node_limit: int) -> DataFrame:
    """Every block of a large node with some LEADERS of the node's sets: (node, cid, side), the leaders' side is 1."""
    dealt = large.withColumn("blocks", _blocks(F.col("size"), F.col("total"), node_limit))
    cell = lambda k: F.xxhash64("node", F.lit("leaders"), k).alias("node")
    own = dealt.select(cell(F.pmod(F.xxhash64("cid"), "blocks").cast("int")), "cid", F.lit(0).alias("side"))
    led = dealt.where(F.pmod(F.xxhash64("cid", "node"), F.col("size")) < LEADERS).select("node", "cid", _upto(F.col("blocks")).alias("k"))
    return own.unionByName(led.select(cell(F.col("k")), "cid", F.lit(1).alias("side")))


def cluster_cells(large: DataFrame, clusters: DataFrame, scratch: Scratch, node_limit: int) -> DataFrame:
    """Cells (node, cid, side) of pairs of blocks of each large node, without those inside the node's largest cluster."""
    known = scratch.write(large.join(clusters, "cid", "left").select("node", "cid", "n", F.coalesce("cluster", "cid").alias("cluster")))
    each = known.groupBy("node", "cluster").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    top = each.groupBy("node").agg(F.max_by(F.struct("cluster", "c", "s"), "c").alias("top"), F.sum("c").alias("c"), F.sum("s").alias("s"))
    top = top.where("c > top.c").select(
        "node", F.col("top.cluster").alias("top"), _blocks(F.col("top.c"), F.col("top.s"), node_limit).alias("tops"), _blocks(F.col("c") - F.col("top.c"), F.col("s") - F.col("top.s"), node_limit).alias("rests")
    )
    dealt = known.join(scratch.write(top), "node").withColumn("is_top", F.col("cluster") == F.col("top"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("cid"), F.when(F.col("is_top"), F.col("tops")).otherwise(F.col("rests"))).cast("int"))
    across = lambda x, y: F.xxhash64("node", F.lit("across"), x, y).alias("node")
    inside = F.xxhash64("node", F.lit("inside"), F.least("own", "other"), F.greatest("own", "other")).alias("node")
    tops, rest = dealt.where("is_top"), dealt.where("not is_top")
    out = tops.select("node", "cid", "own", _upto(F.col("rests")).alias("other")).select(across(F.col("own"), F.col("other")), "cid", F.lit(0).alias("side"))
    out = out.unionByName(rest.select("node", "cid", "own", _upto(F.col("tops")).alias("other")).select(across(F.col("other"), F.col("own")), "cid", F.lit(1).alias("side")))
    return out.unionByName(rest.select("node", "cid", "own", _upto(F.col("rests")).alias("other")).select(inside, "cid", F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("side")))


def near_duplicates(docs: DataFrame, percent: int = 75, node_limit: int = NODE, depth: int = DEPTH) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text)."""
    return _judged(docs, percent, node_limit, depth).drop("d1")


def _judged(docs: DataFrame, percent: int, node_limit: int = NODE, depth: int = DEPTH) -> DataFrame:
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = scratch.write(texts.mapInArrow(by_slice(sketch_rows), "doc_id long, n_shingles long, d1 long, d2 long, sketch binary"))
    member = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    classes = scratch.write(
        sketches.where(member).groupBy(F.col("d1").alias("cid"), "d2", F.col("n_shingles").alias("n")).agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch"))
    )
    leaves, large = tree_nodes(classes, scratch, node_limit, depth)

    def alike(rows: DataFrame, clusters: DataFrame | None) -> DataFrame:
        """Rows of the nodes that may have a link to another cluster."""
        vectors = classes.select("cid", "n", "sketch", F.col("cid").alias("cluster"))
        if clusters is not None:
            vectors = vectors.drop("cluster").join(clusters, "cid", "left").withColumn("cluster", F.coalesce("cluster", "cid"))
        inside = rows.join(vectors, "cid").select("node", "cid", "n", "side", "cluster", "sketch")
        return scratch.write(inside.repartition("node").sortWithinPartitions("node").mapInArrow(alike_in_nodes(percent / 100), "node long, cid long"))

    def fetch(rows: DataFrame) -> DataFrame:
        """(cid, text) of the classes in ``rows``, by their least doc_ids; rows of other classes with such an id may
        come along.  The ids are written in order: a small file is broadcast, and texts aren't shuffled for it."""
        wanted = scratch.write(rows.select("cid").distinct().join(classes.select("cid", "rep"), "cid").select("rep").distinct().sort("rep"))
        found = among(texts, "doc_id", wanted, scratch).select("text")
        return scratch.write(found.mapInArrow(by_slice(own_class), "cid long, text string").dropDuplicates(["cid"]))

    def links(rows: DataFrame, bodies: DataFrame) -> DataFrame:
        inside = rows.join(bodies, "cid").select("node", "cid", "text")
        return scratch.write(inside.repartition("node").sortWithinPartitions("node").mapInArrow(links_in_nodes(percent), "a long, b long").distinct())

    # The first tree joins most near copies into clusters; the others then look for links between clusters only.
    start = leaves.where("tree = 0").select("node", "cid", "side")
    first = alike(start if large is None else start.unionByName(leader_cells(large, node_limit)), None)
    bodies = fetch(first)
    found = links(first, bodies)
    clusters = components(found, scratch).select(F.col("node").alias("cid"), F.col("root").alias("cluster"))
    others = leaves.where("tree > 0").select("node", "cid", "side")
    later = alike(others if large is None else others.unionByName(cluster_cells(large, clusters, scratch, node_limit)), clusters)
    new = fetch(later.join(bodies.select("cid"), "cid", "left_anti"))
    found = found.unionByName(links(later, bodies.unionByName(new)))
    comp = components(found, scratch)
    scratch.keep_only(sketches, classes, comp)
    roots = comp.select(F.col("root").alias("node")).distinct().select("node", F.col("node").alias("root"))
    named = scratch.write(comp.unionByName(roots).join(classes.select(F.col("cid").alias("node"), "rep"), "node"))
    least = scratch.write(named.groupBy("root").agg(F.min("rep").alias("component")))
    named = named.join(least, "root").select(F.col("node").alias("cid"), "component").distinct()
    # a class is named by both halves of its digest and its size, so that no row meets two
    owners = scratch.write(classes.select("cid", "d2", "n", "rep").join(named, "cid", "left").select(F.col("cid").alias("d1"), "d2", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component")))
    scratch.keep_only(sketches, owners)
    own = sketches.where(member).join(owners, ["d1", "d2", "n_shingles"]).select("doc_id", "n_shingles", "d1", F.col("component").alias("component_id"), (F.col("component") == F.col("doc_id")).alias("kept"))
    return own.unionByName(sketches.where(~member).select("doc_id", "n_shingles", "d1", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")))


def distinct_documents(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns; of repeated rows of a kept doc_id with the same words, one.

    Rows with no words are each their own component and stay, as do rows with a null doc_id.  Texts meet only ids in
    the joins: up to ``common.BROADCAST_ROWS`` of them are broadcast, more are listed by file (``rowlists.py``) for the tasks
    that scan it; only where ``docs`` aren't the rows of files do texts meet them in a shuffle by doc_id.  doc_ids that several rows bear are told apart by the digests of their texts.
    """
    scratch = Scratch(docs.sparkSession)
    docs, restore = shielded(docs, "doc_id", "text")
    judged = scratch.write(_judged(docs, percent).where("doc_id is not null and n_shingles > 0"))
    by_id = judged.groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("_rows"), F.max("kept").alias("_kept"))
    unsure = by_id.where("_rows > 1").select("_id")
    # written in order, for the same reason as the ids of texts to fetch
    leave = scratch.write(by_id.where("_rows > 1 or not _kept").select("_id").sort("_id"))
    out = among(docs, "doc_id", leave, scratch, keep=False)
    if unsure.isEmpty():
        return restore(out)

    def with_digest(part: pa.RecordBatch) -> pa.RecordBatch:
        h, border = Words(col(part, "text"), fold=True).shingles(5)
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(digests(h, border)[0]), pa.array(np.diff(border))], names=[*part.schema.names, "_d1", "_n"])

    schema = StructType([*docs.schema.fields]).add("_d1", LongType()).add("_n", LongType())
    rows = among(docs, "doc_id", scratch.write(unsure), scratch).mapInArrow(by_slice(with_digest), schema)
    kept = judged.where("kept").select(F.col("doc_id").alias("_id"), F.col("d1").alias("_key")).distinct()
    same = rows.where("_n > 0").join(kept, (F.col("doc_id") == F.col("_id")) & (F.col("_d1") == F.col("_key")), "left_semi").dropDuplicates(["doc_id", "_d1"])
    return restore(out.unionByName(same.select(*docs.columns)).unionByName(rows.where("_n = 0").select(*docs.columns)))
