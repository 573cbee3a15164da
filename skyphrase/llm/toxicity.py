"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input is its own vector, if ``KNOWN_IN`` or more sampled documents have it, or else that of unknown words, plus
the mean of the vectors of its hashed byte 3-grams and 5-grams (with a mark where the word begins), so unseen words are
read by their characters.  Windows of ``WINDOW`` words, ``STRIDE``
apart, the last one flush with the end, cover every whole text; the network reads each window in both directions,
attention pools its states, and a document's score is the highest of its windows.

Training sees labelled rows outside the held-out fifth only: of each label at most ``PER_CLASS`` texts, those with the
least hashes, as long as they have ``TRAIN_BYTES`` bytes together (a text that goes beyond is left out).  All windows of
these texts are read.  Each round learns from the window that scores highest in its document, for either label, so that
scores are calibrated as maxima; a window's part in the gradient stops growing where the network denies its label
strongly (``DENIED``), so that a few wrong labels don't lead.  The result is the same at each run over the same rows.
Scores depend on the text alone.

Edge cases: null and empty texts have one empty window and get the score of the bias; labels that are null or given
twice with different values don't train; rows pass one to one, so repeated rows are scored alike; a null doc_id isn't
held out; without labels of both kinds every score is the label's share, or 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, by_slice, col
from .textops import FOLDED_CODE, U64, Words, mix

WINDOW = 48
STRIDE = 32
PER_CLASS = 1500
TRAIN_BYTES = 8 << 20
HIDDEN = 8
DIM = 8
KNOWN_IN = 10
GRAMS = 1 << 16
EPOCHS = 8
STEPS = 300
DECAY = 0.5
DENIED = 0.8
BATCH = 128
SEED = 5
ROWS = 1024  # windows read at once
PIECE = 1 << 17  # bytes or n-grams worked off at once


def windows(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and first word (within it) of each window; an empty text has one window too."""
    many = np.where(count <= WINDOW, 1, 1 + -(-(count - WINDOW) // STRIDE))
    doc = np.repeat(np.arange(len(count)), many)
    inner = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    return doc, np.minimum(inner * STRIDE, np.maximum(count[doc] - WINDOW, 0))


class Lexicon:
    """Distinct words of some texts: hash of each, and the buckets of its byte n-grams."""

    def __init__(self, words: Words):
        _, at, self.id = np.unique(words.hash, return_index=True, return_inverse=True)
        self.hash = words.hash[at]
        begin, size = words.start[at], words.end[at] - words.start[at]
        # bytes of all distinct words, each after a mark, so that the first n-gram tells the beginning; PIECE at a time
        border = np.concatenate([[0], np.cumsum(size + 1)])
        parts, self.many = [np.zeros(0, np.uint16)], np.zeros(len(at), np.int64)
        for p in range(0, int(border[-1]), PIECE):
            gram, own = self._grams(words.buf, begin, border, p, min(p + PIECE, int(border[-1])))
            parts.append(gram)
            if len(own):
                count = np.bincount(own - own[0])
                self.many[own[0] : own[0] + len(count)] += count
        self.gram = np.concatenate(parts)
        self.first = np.cumsum(self.many) - self.many

    @staticmethod
    def _grams(buf: np.ndarray, begin: np.ndarray, border: np.ndarray, p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the 3- and 5-grams that begin at the places p to q, word by word, and their words."""
        stop = min(q + 4, int(border[-1]))
        a, b = np.searchsorted(border, p, side="right") - 1, np.searchsorted(border, stop)
        low = np.maximum(border[a:b], p)
        own = np.repeat(np.arange(a, b), np.minimum(border[a + 1 : b + 1], stop) - low)
        k = np.arange(p, stop) - border[own]
        code = np.where(k == 0, U64(0x51ED270B), FOLDED_CODE[buf[np.maximum(begin[own] + k - 1, 0)]])
        left = border[own + 1] - np.arange(p, stop)
        keys, owner = [], []
        for n in (3, 5):
            acc = code.copy()
            for j in range(1, n):
                acc[:-j] = acc[:-j] + code[j:] * U64(0x9E3779B97F4A7C15 + 2 * j * j * 0x1234567)
            at = np.flatnonzero(left[: q - p] >= n)
            keys.append((mix(acc[at] + U64(n)) >> U64(48)).astype(np.uint16))
            owner.append(own[at])
        key, own = np.concatenate(keys), np.concatenate(owner)
        order = np.argsort(own, kind="stable")
        return key[order], own[order]


class Network:
    """Parameters, scoring and training."""

    def __init__(self, seed: int = SEED, known: np.ndarray | None = None):
        self.known = np.zeros(0, U64) if known is None else known  # hashes of known words, ascending
        rng = np.random.Generator(np.random.PCG64(seed))
        normal = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p = {"word": normal(len(self.known) + 1, DIM, scale=0.1), "gram": normal(GRAMS, DIM, scale=0.1)}
        for d in "fb":
            self.p |= {f"w{d}": normal(DIM, 3 * HIDDEN, scale=0.5), f"u{d}": normal(HIDDEN, 3 * HIDDEN, scale=0.35), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"att": normal(2 * HIDDEN, scale=0.3), "out": normal(2 * HIDDEN, scale=0.5), "bias": np.zeros(1, np.float32)}

    def place(self, lex: Lexicon) -> np.ndarray:
        """Each distinct word's row of vectors; row 0 is for unknown words."""
        if not len(self.known):
            return np.zeros(len(lex.hash), np.int64)
        at = np.minimum(np.searchsorted(self.known, lex.hash), len(self.known) - 1)
        return np.where(self.known[at] == lex.hash, at + 1, 0)

    def vectors(self, lex: Lexicon) -> np.ndarray:
        """One input vector for each distinct word."""
        out = self.p["word"][self.place(lex)]
        border = np.concatenate([lex.first, [len(lex.gram)]])
        many = np.maximum(lex.many, 1)[:, None].astype(np.float32)
        for p in range(0, len(lex.gram), PIECE):
            q = min(p + PIECE, len(lex.gram))
            a, b = np.searchsorted(border, p, side="right") - 1, np.searchsorted(border, q)
            some = a + np.flatnonzero(np.minimum(border[a + 1 : b + 1], q) > np.maximum(border[a:b], p))
            out[some] += np.add.reduceat(self.p["gram"][lex.gram[p:q]], np.maximum(border[some], p) - p, axis=0) / many[some]
        return out

    def read(self, x: np.ndarray, mask: np.ndarray | None, d: str, keep: list | None = None) -> np.ndarray:
        """States of one direction over input projections x (steps, windows, 3 * HIDDEN), in reading order."""
        u = self.p[f"u{d}"]
        h = np.zeros((x.shape[1], HIDDEN), np.float32)
        states = np.empty((x.shape[0], x.shape[1], HIDDEN), np.float32)
        for t in range(x.shape[0]):
            g = h @ u
            zr = 1 / (1 + np.exp(-(x[t, :, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])))
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(x[t, :, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
            new = n + z * (h - n)
            if mask is not None:
                new = np.where(mask[t][:, None], new, h)
            if keep is not None:
                keep.append((h, z, r, n, g[:, 2 * HIDDEN :]))
            h = new
            states[t] = h
        return states

    def pool(self, s: np.ndarray, mask: np.ndarray | None):
        """Attention over states (steps, windows, 2 * HIDDEN): weights, pooled states, probability."""
        a = s @ self.p["att"]
        if mask is not None:
            a = np.where(mask, a, -1e4)
        a = np.exp(a - a.max(axis=0))
        if mask is not None:
            a *= mask
        a /= np.maximum(a.sum(axis=0), 1e-9)
        c = np.einsum("tn,tnh->nh", a, s)
        return a, c, 1 / (1 + np.exp(-(c @ self.p["out"] + self.p["bias"][0])))

    def score(self, ids: np.ndarray, vec: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
        """Probabilities of windows; ids (steps, windows) index ``vec``, the distinct words' vectors."""
        f = self.read((vec @ self.p["wf"] + self.p["cf"])[ids], mask, "f")
        b = self.read((vec @ self.p["wb"] + self.p["cb"])[ids[::-1]], None if mask is None else mask[::-1], "b")[::-1]
        return self.pool(np.concatenate([f, b], axis=2), mask)[2]

    def window_scores(self, words: Words, lex: Lexicon | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, first word, probability) of all windows of the texts."""
        lex = lex or Lexicon(words)
        vec = self.vectors(lex)
        doc, inner = windows(words.count)
        out = np.empty(len(doc), np.float32)
        short = words.count[doc] < WINDOW
        for some, padded in ((np.flatnonzero(~short), False), (np.flatnonzero(short), True)):
            if padded:
                some = some[np.argsort(words.count[doc[some]], kind="stable")]
            for k in range(0, len(some), ROWS):
                own = some[k : k + ROWS]
                steps = int(words.count[doc[own]].max()) if padded else WINDOW
                if not steps:
                    out[own] = 1 / (1 + np.exp(-self.p["bias"][0]))
                    continue
                at = words.first[doc[own]] + inner[own] + np.arange(steps)[:, None]
                mask = None
                if padded:
                    mask = np.arange(steps)[:, None] < words.count[doc[own]]
                    at = np.minimum(at, len(lex.id) - 1)
                out[own] = self.score(lex.id[at], vec, mask)
        return doc, inner, out

    def step(self, lex: Lexicon, ids: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted log loss over some windows."""
        vec = self.vectors(lex)
        kf, kb = [], []
        f = self.read((vec @ self.p["wf"] + self.p["cf"])[ids], mask, "f", kf)
        b = self.read((vec @ self.p["wb"] + self.p["cb"])[ids[::-1]], mask[::-1], "b", kb)
        s = np.concatenate([f, b[::-1]], axis=2)
        a, c, p = self.pool(s, mask)
        e = (weight * (p - y)).astype(np.float32)
        g = {"out": c.T @ e, "bias": e.sum(keepdims=True)}
        dc = e[:, None] * self.p["out"]
        ds = a[:, :, None] * dc
        da = np.einsum("tnh,nh->tn", s, dc)
        da = a * (da - (a * da).sum(axis=0))
        g["att"] = np.einsum("tn,tnh->h", da, s)
        ds = ds + da[:, :, None] * self.p["att"]
        dvec = np.zeros_like(vec)
        for d, kept, grad, order, m in (("f", kf, ds[:, :, :HIDDEN], ids, mask), ("b", kb, ds[::-1, :, HIDDEN:], ids[::-1], mask[::-1])):
            u = self.p[f"u{d}"]
            du, dx = np.zeros_like(u), np.zeros((*ids.shape, 3 * HIDDEN), np.float32)
            dh = np.zeros((ids.shape[1], HIDDEN), np.float32)
            for t in range(len(kept) - 1, -1, -1):
                h, z, r, n, gn = kept[t]
                dh = dh + grad[t]
                live = m[t][:, None]
                dn = dh * (1 - z) * (1 - n * n) * live
                dz = dh * (h - n) * z * (1 - z) * live
                dr = dn * gn * r * (1 - r)
                dg = np.concatenate([dz, dr, dn * r], axis=1)
                dx[t] = np.concatenate([dz, dr, dn], axis=1)
                du += h.T @ dg
                dh = np.where(live, dh * z, dh) + dg @ u.T
            flat, dflat = order.reshape(-1), dx.reshape(-1, 3 * HIDDEN)
            total = np.zeros((len(vec), 3 * HIDDEN), np.float32)
            np.add.at(total, flat, dflat)
            g[f"u{d}"], g[f"c{d}"], g[f"w{d}"] = du, dflat.sum(axis=0), vec.T @ total
            dvec += total @ self.p[f"w{d}"].T
        g["word"], g["gram"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["gram"])
        np.add.at(g["word"], self.place(lex), dvec)
        np.add.at(g["gram"], lex.gram, (dvec / np.maximum(lex.many, 1)[:, None].astype(np.float32))[np.repeat(np.arange(len(lex.many)), lex.many)])
        return g


def train(texts: list[list[str]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """``texts``: the windows of each document, as strings.  Classes weigh alike."""
    share = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or share in (0.0, 1.0):
        net = Network(seed)
        net.p["out"][:] = 0
        net.p["bias"][0] = {0.0: -6.0, 1.0: 6.0}.get(share, 0.0)
        return net
    rng = np.random.Generator(np.random.PCG64(seed))
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    words = Words(pa.array([w for t in texts for w in t], pa.string()), fold=True)
    lex = Lexicon(words)
    held = np.unique(np.stack([lex.id, np.repeat(owner, words.count)]), axis=1)[0]  # a row for each document and word
    net = Network(seed, lex.hash[np.bincount(held, minlength=len(lex.hash)) >= KNOWN_IN])
    balance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    rounds = 0
    total = max(epochs, -(-STEPS // -(-len(texts) // BATCH)))  # small samples are read more often
    for epoch in range(total):
        if epoch == 0:  # no score yet: any window of each document
            rank = rng.random(len(owner))
        else:
            doc, _, p = net.window_scores(words, lex)
            rank = np.zeros(words.n)
            np.maximum.at(rank, doc, p)
        order = np.lexsort((-rank, owner))
        best = order[np.concatenate([[True], owner[order][1:] != owner[order][:-1]])]
        if epoch < 2:  # and another one, while scores are coarse
            best = np.concatenate([best, rng.choice(len(owner), len(best), replace=False)]) if len(owner) > len(best) else best
        best = rng.permutation(best)
        for k in range(0, len(best), BATCH):
            own = best[k : k + BATCH]
            steps = int(min(max(words.count[own].max(), 1), WINDOW))
            mask = np.arange(steps)[:, None] < words.count[own]
            at = np.minimum(words.first[own] + np.arange(steps)[:, None], max(len(lex.id) - 1, 0))
            used, ids = np.unique(lex.id[at], return_inverse=True)
            y = labels[owner[own]].astype(np.float32)
            weight = balance[owner[own]] / len(own)
            if epoch >= total // 2:
                miss = np.abs(rank[own] - y)
                weight = weight * np.where(miss > DENIED, np.maximum(1 - miss, 0.02) / (1 - DENIED) * 0.5, 1.0)
            g = net.step(_Some(lex, used), ids.reshape(at.shape), mask, y, weight.astype(np.float32))
            rounds += 1
            rate = 0.01 * min(1.0, rounds / 10) * (1 - epoch / total)
            for name, grad in g.items():
                m, v = moments[name]
                m *= 0.9
                m += 0.1 * grad
                v *= 0.99
                v += 0.01 * grad * grad
                if name in ("word", "gram"):
                    net.p[name] *= np.float32(1 - rate * DECAY)
                net.p[name] -= (rate * (m / (1 - 0.9**rounds)) / (np.sqrt(v / (1 - 0.99**rounds)) + 1e-6)).astype(np.float32)
    return net


class _Some:
    """The part of a lexicon that one batch uses."""

    def __init__(self, lex: Lexicon, used: np.ndarray):
        self.hash, self.many = lex.hash[used], lex.many[used]
        self.first = np.cumsum(self.many) - self.many
        at = np.repeat(lex.first[used] - self.first, self.many) + np.arange(int(self.many.sum()))
        self.gram = lex.gram[at]


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def windows_of(texts: list[str]) -> list[list[str]]:
    """All windows of each text, as strings; an empty text has an empty one."""
    words = Words(pa.array(texts, pa.string()))
    doc, inner = windows(words.count)
    out: list[list[str]] = [[] for _ in texts]
    for d, k in zip(doc.tolist(), inner.tolist(), strict=True):
        a = words.first[d] + k
        b = min(a + WINDOW, words.first[d + 1])
        out[d].append(words.buf[words.start[a] : words.end[b - 1]].tobytes().decode(errors="replace") if b > a else "")
    return out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, train_bytes: int = TRAIN_BYTES) -> Network:
    """Trains on a bounded sample of the labelled rows outside the held-out fifth."""
    known = labels.where("doc_id is not null and toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other")
    pick = lambda k: known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    chosen = pick(0).unionByName(pick(1)).select("doc_id", "toxic")
    # at most 2 * per_class rows of 12 bytes are broadcast, so texts aren't shuffled; equal rows count once
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    scratch = Scratch(docs.sparkSession)
    key = F.xxhash64("text").alias("key")
    sizes = scratch.write(texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", key, F.octet_length("text").alias("n")).where(F.col("n") <= train_bytes))
    got = []
    for k in (0, 1):
        near = sizes.where(F.col("toxic") == k).select(F.xxhash64("doc_id").alias("rank"), "doc_id", "key", "n").distinct().orderBy("rank", "doc_id", "key").limit(per_class)
        total = F.sum("n").over(Window.orderBy("rank", "doc_id", "key").rowsBetween(Window.unboundedPreceding, 0))
        fits = near.withColumn("total", total).where(F.col("total") <= train_bytes).select("doc_id", F.col("key").alias("wanted"))
        own = texts.join(F.broadcast(fits), "doc_id").select("doc_id", key, "wanted", "text").where("key = wanted")
        got += [(r["doc_id"], r["key"], k, r["text"]) for r in own.dropDuplicates(["doc_id", "key"]).select("doc_id", "key", "text").collect()]
    scratch.drop(sizes)
    got.sort()
    return train(windows_of([text for *_, text in got]), np.array([toxic for _, _, toxic, _ in got]))


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted, worst_window) for every row; worst_window is the first word of the window."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, per_class))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        words = Words(col(part, "text"), fold=True)
        doc, inner, p = model.value.window_scores(words)
        order = np.lexsort((inner, -p, doc))
        best = order[np.concatenate([[True], doc[order][1:] != doc[order][:-1]])]
        score = np.clip(p[best].astype(np.float64), 0, 1)
        return pa.RecordBatch.from_arrays(
            [col(part, "doc_id"), col(part, "held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(inner[best].astype(np.int64))],
            names=["doc_id", "held_out", "score", "predicted", "worst_window"],
        )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = own.withColumn("held_out", held_out(F.col("doc_id")))
    return own.mapInArrow(by_slice(work, limit=1 << 20), "doc_id long, held_out boolean, score double, predicted int, worst_window long")
