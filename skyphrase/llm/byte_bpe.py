"""Byte-level BPE encoding and decoding with the ``tokenizers`` library over Arrow batches.

A rank file (base64 token, rank) is turned into a byte-level BPE model: every way to split a token into two tokens
is a merge with the rank of the whole, and a piece that is itself a token is taken as such; this gives the ids that
merging by the lowest rank gives.  Texts are split by the pattern first, each match by itself; no special tokens.

Offsets come from our own byte table: token lengths in bytes add up to byte borders, and a byte-to-character map
turns those into characters.  A token that holds part of a character is given the whole character, so such a
character belongs to each token that has a byte of it.  Decoding joins the tokens' bytes, which restores characters
split over tokens; a cut sequence of ids decodes with U+FFFD for what is incomplete, and the raw bytes are kept.

Edge cases: null text is encoded as an empty one (no ids, empty bytes); rows pass through one to one, so repeated
rows and null doc_ids stay; texts are encoded whole, whatever their length; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_slice, col
from .textops import code_points, payload

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def vocabulary_path(name_or_path: str) -> str:
    if os.path.sep in name_or_path:
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


def byte_characters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Codec:
    """The vocabulary of one rank file, as encoder and decoder."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        shown = byte_characters()
        name = lambda token: "".join(shown[b] for b in token)
        merges = [
            (name(token[:k]), name(token[k:]))
            for token, _ in sorted(ranks.items(), key=lambda x: x[1])
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        ]
        self.tokenizer = Tokenizer(models.BPE(vocab={name(t): r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.token = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.token[rank] = token
        self.size = np.array([len(t) for t in self.token], dtype=np.int64)
        self.label = [str(k) for k in range(len(self.token))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def offsets(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of each token; both take in characters that a token has only in part."""
        starts, ends, _ = self.spans(np.frombuffer(text.encode(), dtype=np.uint8), [ids])
        return starts, ends

    def spans(self, buf: np.ndarray, ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Offsets of the tokens of texts that lie end to end in ``buf``, each counted from its own text's beginning, and
        the border of each text's tokens."""
        count = np.array([len(x) for x in ids], dtype=np.int64)
        border = np.concatenate([[0], np.cumsum(count)])
        size = self.size[np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=border[-1])]
        end = np.cumsum(size)
        char = np.cumsum(code_points(buf)) - 1
        starts, ends = char[end - size], char[end - 1] + 1
        some = np.flatnonzero(count)
        base = np.repeat(starts[border[some]], count[some])
        return starts - base, ends - base, border

    def digest(self, ids: list[int]) -> str:
        return hashlib.sha256(",".join(map(self.label.__getitem__, ids)).encode()).hexdigest()


@lru_cache(maxsize=4)
def codec(vocabulary: str = VOCABULARY, pattern: str | None = None) -> Codec:
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    return Codec(vocabulary_path(vocabulary), pattern)


def _texts(part: pa.RecordBatch) -> list[str]:
    return col(part, "text").fill_null("").to_pylist()


def _encoded(own: Codec, part: pa.RecordBatch, texts: list[str]) -> tuple[list[list[int]], list[tuple[np.ndarray, np.ndarray]]]:
    """Ids of each text, and the first character and end of each token."""
    ids = own.encode(texts)
    starts, ends, border = own.spans(payload(col(part, "text"))[0], ids)
    return ids, [(starts[a:b], ends[a:b]) for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True)]


def _decoded(own: Codec, ids: list) -> tuple[list[bytes], list[str]]:
    """Bytes of each list of ids, and their text."""
    raw = [own.decode(x or []) for x in ids]
    return raw, [x.decode(errors="replace") for x in raw]


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids, starts, ends): the ids of each whole text and the characters each token covers."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, spans = _encoded(codec(vocabulary, pattern), part, _texts(part))
        return pa.RecordBatch.from_arrays(
            [col(part, "doc_id").cast(pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array([s for s, _ in spans], pa.list_(pa.int32())), pa.array([e for _, e in spans], pa.list_(pa.int32()))],
            names=["doc_id", "ids", "starts", "ends"],
        )

    return _narrow(docs).mapInArrow(by_slice(work), "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode(tokens: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, bytes, text) from (doc_id, ids); null ids give empty bytes."""

    def run(batches):
        own = codec(vocabulary)
        for batch in batches:
            raw, text = _decoded(own, col(batch, "ids").to_pylist())
            yield pa.RecordBatch.from_arrays([col(batch, "doc_id"), pa.array(raw, pa.binary()), pa.array(text, pa.string())], names=["doc_id", "bytes", "text"])

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, bytes binary, text string")


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str | None = None, offsets: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, exact): encodes whole texts as ``encode`` does, decodes the ids as
    ``decode`` does, and digests both; ``exact`` where bytes and text come back.  With ``offsets`` also offsets_sha256, of
    the tokens' first characters and then their ends, as 8-byte little-endian integers."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "exact"] + ["offsets_sha256"] * offsets

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(vocabulary, pattern)
        texts = _texts(part)
        ids, spans = _encoded(own, part, texts)
        raw, back = _decoded(own, ids)
        columns = [
            col(part, "doc_id").cast(pa.int64()),
            pa.array([len(x) for x in ids], pa.int64()),
            pa.array([own.digest(x) for x in ids]),
            pa.array([hashlib.sha256(x).hexdigest() for x in raw]),
            pa.array([x == t.encode() and y == t for x, y, t in zip(raw, back, texts, strict=True)]),
            pa.array([hashlib.sha256(np.concatenate(x).astype("<i8").tobytes()).hexdigest() for x in spans]),
        ]
        return pa.RecordBatch.from_arrays(columns[: len(names)], names=names)

    return _narrow(docs).mapInArrow(by_slice(work, limit=1 << 18), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean" + ", offsets_sha256 string" * offsets)


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
