import base64
import hashlib
import random

import pytest

from skyphrase.llm import byte_bpe
from skyphrase.llm.queries import op2_byte_bpe

from .helpers import awkward, documents

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def judge():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(byte_bpe.VOCABULARY), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_bytes_of_awkward_rows(spark, judge):
    rows = [r[:2] for r in awkward()]
    got = byte_bpe.round_trip(documents(spark, rows, extra=True)).collect()
    def wanted(doc, text):
        ids = judge.encode_ordinary(text or "")
        return (doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest(), True)

    order = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in got), key=order) == sorted((wanted(*r) for r in rows), key=order)


def test_random_texts(judge):
    rng = random.Random(5)
    own = byte_bpe.codec()
    texts = ["".join(rng.choice("aab .  \n\t'-_=é,1!ñ😀s　\x00") for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += [rng.choice("aé .=-_\n\t*0") * rng.randint(1, 300) + rng.choice(["", "a", " b"]) for _ in range(1000)]
    texts += [f"a{chr(c)}{chr(c)} {chr(c)}1" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    assert own.encode(texts) == [judge.encode_ordinary(t) for t in texts]


def test_decoding_and_split_characters(spark):
    text = "a 😀é漢字"
    row = byte_bpe.encode(documents(spark, [(1, text), (2, None)])).orderBy("doc_id").collect()
    assert row[1]["ids"] == [] and row[1]["starts"] == []
    ids, starts, ends = row[0]["ids"], row[0]["starts"], row[0]["ends"]
    own = byte_bpe.codec()
    assert starts[0] == 0 and ends[-1] == len(text) and all(a < b for a, b in zip(starts, ends, strict=True))
    # every token's bytes lie within its characters, and neighbours overlap only in characters that are split
    at = 0
    for k, (i, a, b) in enumerate(zip(ids, starts, ends, strict=True)):
        size = len(own.token[i])
        assert len(text[:a].encode()) <= at and at + size <= len(text[:b].encode())
        at += size
        if k:
            assert starts[k] in (ends[k - 1], ends[k - 1] - 1)
    back = byte_bpe.decode(spark.createDataFrame([(1, ids), (2, ids[:-1]), (3, None)], "doc_id long, ids array<int>")).orderBy("doc_id").collect()
    assert back[0]["text"] == text and bytes(back[0]["bytes"]) == text.encode() and back[2]["text"] == ""
    assert bytes(back[1]["bytes"]) == own.decode(ids[:-1]) and back[1]["text"] == own.decode(ids[:-1]).decode(errors="replace")


def test_offsets_equal_the_librarys(spark):
    own = byte_bpe.codec()
    text = "Hello, wörld 12 漢字 😀."
    full = own.tokenizer.encode(text, add_special_tokens=False)
    starts, ends = own.offsets(text, full.ids)
    assert [(int(a), int(b)) for a, b in zip(starts, ends, strict=True)] == full.offsets


def test_query_digests_the_operators_offsets(spark, sf_dir):
    """The query's offsets are those of encode(), counted out here byte by byte."""
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).collect()}
    own = byte_bpe.codec()
    found = {r["doc_id"]: r for r in op2_byte_bpe(spark, sf_dir).collect()}
    for doc, text in texts.items():
        char = [k for k, c in enumerate(text) for _ in c.encode()]
        starts, ends, at = [], [], 0
        for i in own.encode([text])[0]:
            starts.append(char[at])
            at += len(own.token[i])
            ends.append(char[at - 1] + 1)
        assert found[doc]["offsets_sha256"] == hashlib.sha256(b"".join(x.to_bytes(8, "little") for x in starts + ends)).hexdigest()


def test_query_covers_every_row(spark, sf_dir):
    out = op2_byte_bpe(spark, sf_dir)
    assert out.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count() and out.where("not exact").count() == 0


def test_query_ids_equal_those_of_the_public_library(spark, sf_dir):
    """Digests of every whole text's ids and bytes, by the reference implementation of merging by rank."""
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    path = public_tokenizers.path(byte_bpe.VOCABULARY)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in op2_byte_bpe(spark, sf_dir).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode_bytes(ids)).hexdigest() == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
