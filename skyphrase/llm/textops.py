"""Vectorised text primitives over Arrow buffers (numpy, no per-word Python objects).

Texts are read as UTF-8 bytes straight from the Arrow data buffer.  Words are maximal runs of bytes
other than ``\\x20`` and ``\\x09-\\x0D``; every byte of a multi-byte code point belongs to a word, so this
equals the code-point pattern ``[^\\x20\\x09-\\x0D]+``.  Word identity is a 64-bit hash of the bytes: each block
of eight bytes is mixed with its place, non-linearly, and the mixed blocks are added up, so no exchange of bytes
or blocks leaves the hash as it is.

Memory is bounded by ``SLICE_BYTES`` (plus one text): a batch is worked off in slices of whole rows.  Words are found
in blocks of ``BLOCK_BYTES`` and hashed ``PIECE`` eight-byte blocks at a time, wherever those cut a word, so that a
very long text needs a copy of its bytes and about 24 bytes for each *word*, white space or not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
BLOCK_BYTES = 1 << 20
PIECE = 1 << 16

U64 = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240229))
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
BYTE_CODE = _RNG.integers(0, 2**64, 256, dtype=U64)
FOLDED_CODE = BYTE_CODE[FOLD]
_STEP = _RNG.integers(0, 2**64, 16, dtype=U64) | U64(1)
_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=U64)  # the lowest k bytes
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_PLACE = mix(np.arange(1, 1025, dtype=U64) * U64(0x9E3779B97F4A7C15))


def span_hash(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the spans buf[begin:end], none empty; spans may be of any length."""
    size = end - begin
    border = np.concatenate([[0], np.cumsum((size + 7) >> 3)])
    total = size.astype(U64) * U64(0xD6E8FEB86659FD93)
    if not len(begin):
        return total
    eights = np.zeros((len(buf) >> 3) + 2, dtype=U64)
    eights.view(np.uint8)[: len(buf)] = buf
    for p in range(0, int(border[-1]), PIECE):
        q = min(p + PIECE, int(border[-1]))
        a, b = np.searchsorted(border, p, side="right") - 1, np.searchsorted(border, q, side="left")
        low = np.maximum(border[a:b], p)
        many = np.minimum(border[a + 1 : b + 1], q) - low
        k = np.arange(p, q) - np.repeat(border[a:b], many)
        at = np.repeat(begin[a:b], many) + 8 * k
        word, shift = at >> 3, ((at & 7) << 3).astype(U64)
        x = (eights[word] >> shift) | ((eights[word + 1] << U64(1)) << (U64(63) - shift))
        x &= _TAIL[np.minimum(np.repeat(end[a:b], many) - at, 8)]
        place = _PLACE[k] if k.max() < len(_PLACE) else mix((k + 1).astype(U64) * U64(0x9E3779B97F4A7C15))
        total[a:b] += np.add.reduceat(mix(x ^ place), low - p)
    return mix(total)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows whose texts have at most ``limit`` bytes together (one longer text stands alone)."""
    col = batch.column(batch.schema.get_field_index(column))
    n = batch.num_rows
    if not n:
        return
    off = offsets(col)
    at = 0
    while at < n:
        to = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
        to = min(n, max(to, at + 1))
        yield batch.slice(at, to - at)
        at = to


def offsets(col: pa.Array) -> np.ndarray:
    """Byte offsets of the n + 1 text borders in the data buffer; null texts are empty there."""
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    if col.buffers()[1] is None:
        return np.zeros(len(col) + 1, dtype=np.int64)
    return np.frombuffer(col.buffers()[1], dtype=kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)


def payload(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a string column, end to end, and the n + 1 borders, from 0."""
    if col.null_count:
        col = col.fill_null("")
    off = offsets(col)
    data = col.buffers()[2]
    if data is None:
        return np.zeros(0, dtype=np.uint8), off - off[0]
    return np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]], off - off[0]


def word_bounds(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of texts that lie end to end in ``buf`` begin, and where they end."""
    starts, ends = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for a in range(0, len(buf), BLOCK_BYTES):
        b = min(a + BLOCK_BYTES, len(buf))
        inside = ~IS_SPACE[buf[a:b]]
        edge = np.zeros(b - a + 1, dtype=bool)  # text borders, before each byte and after the last
        lo, hi = np.searchsorted(off, [a, b + 1])
        edge[off[lo:hi] - a] = True
        before = a > 0 and not IS_SPACE[buf[a - 1]]  # a word may begin or end in another block
        after = b < len(buf) and not IS_SPACE[buf[b]]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        begins[0] &= not before or edge[0]
        stops[:-1] &= ~inside[1:] | edge[1:-1]
        stops[-1] &= not after or edge[-1]
        starts.append(np.flatnonzero(begins) + a)
        ends.append(np.flatnonzero(stops) + a + 1)
    return np.concatenate(starts), np.concatenate(ends)


class Words:
    """Words of a column of texts: byte ``start`` and ``end``, 64-bit ``hash``; ``first[d]:first[d+1]`` are text d's."""

    def __init__(self, col: pa.Array, fold: bool = False):
        self.buf, self.off = payload(col)
        self.n = len(self.off) - 1
        self.start, self.end = word_bounds(self.buf, self.off)
        self.hash = span_hash(FOLD[self.buf] if fold else self.buf, self.start, self.end)
        self.first = np.searchsorted(self.start, self.off)
        self.count = np.diff(self.first)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of k words of one text, in order, and the n + 1 borders by text."""
        many = np.maximum(self.count - k + 1, 0)
        border = np.concatenate([[0], np.cumsum(many)])
        h = self.hash
        if len(h) < k:
            return np.zeros(0, dtype=U64), border
        size = len(h) - k + 1
        acc = h[:size] * _STEP[0]
        for j in range(1, k):
            acc = acc + h[j : j + size] * _STEP[j]
        if border[-1] != size:
            keep = np.ones(size, dtype=bool)
            for d in range(1, min(k, size + 1)):
                cut = self.first[1:-1] - d
                keep[cut[(cut >= 0) & (cut < size)]] = False
            acc = acc[keep]
        return mix(acc), border

    def shingles(self, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Each text's distinct k-word shingles, ascending; a text of fewer words has its whole sequence as one."""
        h, border = self.windows(k)
        short = np.flatnonzero((self.count > 0) & (self.count < k))
        lone = {int(d): whole(self.hash[self.first[d] : self.first[d + 1]]) for d in short}
        parts = []
        for d in range(self.n):
            if d in lone:
                parts.append(lone[d])
            else:
                own = np.sort(h[border[d] : border[d + 1]])
                if len(own) > 1:
                    own = own[np.concatenate([[True], own[1:] != own[:-1]])]
                parts.append(own)
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        return (np.concatenate(parts) if parts else h), np.concatenate([[0], np.cumsum(sizes)])


def whole(h: np.ndarray) -> np.ndarray:
    """One hash for a whole sequence of fewer words than a shingle; it never meets a shingle's hash."""
    return mix((h * _STEP[8 : 8 + len(h)]).sum(keepdims=True) + U64(len(h)))


def code_points(buf: np.ndarray) -> np.ndarray:
    """True where a code point begins."""
    return (buf & 0xC0) != 0x80
