"""Per-text counts over a slice of texts, vectorised over all its bytes."""

from __future__ import annotations

import numpy as np

from .textops import BLOCK_BYTES, IS_SPACE, U64, Words, code_points, mix, span_hash

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
WINDOW = 8


def _per(mask: np.ndarray, border: np.ndarray) -> np.ndarray:
    """How many of mask[border[d]:border[d+1]] are true; borders ascend."""
    before, total = np.zeros(len(border), dtype=np.int64), 0
    for p in range(0, len(mask), BLOCK_BYTES):
        q = min(p + BLOCK_BYTES, len(mask))
        some = slice(*np.searchsorted(border, [p, q]))
        seen = np.cumsum(mask[p:q], dtype=np.int32)
        at = border[some] - p
        before[some] = total + np.where(at > 0, seen[at - 1], 0)
        total += int(seen[-1])
    before[np.searchsorted(border, len(mask)) :] = total
    return np.diff(before)


def byte_counts(words: Words) -> np.ndarray:
    """By text: how often it holds each of the 256 bytes."""
    out = np.zeros(words.n << 8, dtype=np.int64)
    for p in range(0, len(words.buf), BLOCK_BYTES):
        q = min(p + BLOCK_BYTES, len(words.buf))
        a, b = np.searchsorted(words.off, p, side="right") - 1, np.searchsorted(words.off, q)
        doc = np.repeat(np.arange(b - a, dtype=np.int64) << 8, np.minimum(words.off[a + 1 : b + 1], q) - np.maximum(words.off[a:b], p))
        out[a << 8 : b << 8] += np.bincount(doc + words.buf[p:q], minlength=(b - a) << 8)
    return out.reshape(-1, 256)


_WORD_START = code_points(np.arange(256, dtype=np.uint8)) & ~IS_SPACE


def word_chars(held: np.ndarray) -> np.ndarray:
    """Code points in words, of byte counts."""
    return held[:, _WORD_START].sum(axis=1)


def symbols(held: np.ndarray) -> np.ndarray:
    return held[:, _SYMBOL].sum(axis=1)


def dup_lines(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """By text: lines that hold a word and equal an earlier one; lines that hold a word."""
    buf, off = words.buf, words.off
    if not len(buf):
        return np.zeros(words.n, dtype=np.int64), np.zeros(words.n, dtype=np.int64)
    feed = np.flatnonzero(buf == 10)
    begin = np.union1d(off[:-1][off[:-1] < off[1:]], feed + 1)
    begin = begin[begin < len(buf)]
    end = np.minimum(np.concatenate([begin[1:], [len(buf)]]), len(buf))
    doc = np.searchsorted(off, begin, side="right") - 1
    end = end - (buf[end - 1] == 10)
    has = _per(~IS_SPACE[buf], np.concatenate([begin, [len(buf)]])) > 0
    begin, end, doc = begin[has], end[has], doc[has]
    lines = np.bincount(doc, minlength=words.n)
    if not len(begin):
        return np.zeros(words.n, dtype=np.int64), lines
    key = mix(span_hash(buf, begin, end) ^ mix(doc.astype(U64) + U64(1)))
    _, at = np.unique(key, return_index=True)
    return lines - np.bincount(doc[at], minlength=words.n), lines


def repeat_words(words: Words) -> np.ndarray:
    """By text: words inside 8-word windows that the text holds twice or more."""
    h, border = words.windows(WINDOW)
    doc = np.repeat(np.arange(words.n), np.diff(border))
    out = np.zeros(words.n, dtype=np.int64)
    if len(h) < 2:
        return out
    key = mix(h ^ mix(doc.astype(U64) + U64(1)))
    ranked = np.sort(key)
    twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    if not len(twice):
        return out
    at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    hit = np.flatnonzero(twice[at] == key)
    word = words.first[doc[hit]] + hit - border[doc[hit]]
    step = np.zeros(len(words.hash) + 1, dtype=np.int64)
    np.add.at(step, word, 1)
    np.add.at(step, word + WINDOW, -1)
    return _per(np.cumsum(step)[:-1] > 0, words.first)


def share(mask: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Share of each text's bytes that the mask has."""
    return held[:, mask].sum(axis=1) / np.maximum(held.sum(axis=1), 1)
