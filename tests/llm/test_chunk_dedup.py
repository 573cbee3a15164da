import random
import re

import numpy as np
import pyarrow as pa

from skyphrase.llm import chunk_dedup
from skyphrase.llm.queries import op6_repeated_spans
from skyphrase.llm.textops import mix, payload

from .helpers import awkward, documents, prose


def pieces(text):
    buf, off = payload(pa.array([text]))
    return [buf[a:b].tobytes() for _, a, b, _ in zip(*chunk_dedup.chunks(buf, off), strict=True)]


def rolled(data):
    """The gear hash of the end of ``data``, byte by byte."""
    h = 0
    for c in data[-chunk_dedup.WINDOW :]:
        h = (2 * h + int(chunk_dedup._GEAR[c])) % 2**64
    return h


def test_gear_hash_is_the_rolling_hash():
    buf = np.frombuffer(prose(random.Random(1), 50).encode(), dtype=np.uint8)
    assert chunk_dedup.gear(buf).tolist() == [rolled(buf[: k + 1].tobytes()) for k in range(len(buf))]


def slow_pieces(text):
    """The same cuts in plain loops, for texts whose words are short."""
    data = text.encode()
    ends = [m.end() for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    value = [int(mix(np.array([rolled(data[:e])], dtype=np.uint64))[0]) if e >= chunk_dedup.WINDOW else 0 for e in ends]
    out, at, held = [], 0, 0
    for k, e in enumerate(ends):
        near = range(max(0, k - chunk_dedup.REACH), min(len(ends), k + chunk_dedup.REACH + 1))
        held += 1
        top = all(value[k] > value[j] if j < k else value[k] >= value[j] for j in near if j != k)
        if top or held == chunk_dedup.MOST or k == len(ends) - 1:
            stop = len(data) if k == len(ends) - 1 else e
            out.append(data[at:stop])
            at, held = stop, 0
    return out


def test_cuts_against_plain_loops():
    rng = random.Random(11)
    for text in [prose(rng, n) for n in (1, 2, 7, 40, 900)] + ["same " * 300, " \n a b ", "spam eggs " * 100 + prose(rng, 30), "été là ß " * 50]:
        assert pieces(text) == slow_pieces(text), text[:40]


def test_chunks_are_the_text_and_whole_characters():
    for text in ["", "short", "é" * 500, "x" * 3000, "a😀b" * 200, prose(random.Random(2), 400), "😀" * 3000]:
        own = pieces(text)
        assert b"".join(own) == text.encode() and all(len(p) <= chunk_dedup.MOST * (chunk_dedup.CAP + 3) for p in own)
        for p in own:
            p.decode()


def test_long_words_are_cut_by_content():
    rng = random.Random(12)
    blob = "".join(rng.choice("0123456789abcdef") for _ in range(20_000))
    same = set(pieces(blob)) & set(pieces("ff" + blob[:700] + "0" + blob[700:]))
    assert len(same) > 0.8 * len(pieces(blob)) > 20


def test_chunks_do_not_depend_on_other_texts():
    a, b = prose(random.Random(3), 300), prose(random.Random(4), 300)
    buf, off = payload(pa.array([b, None, a, ""]))
    assert [buf[x:y].tobytes() for d, x, y, _ in zip(*chunk_dedup.chunks(buf, off), strict=True) if d == 2] == pieces(a)


def test_chunks_resist_insertions():
    text = prose(random.Random(5), 400)
    same = set(pieces(text)) & set(pieces("inserted words " + text[:900] + "more" + text[900:]))
    assert len(same) > 0.8 * len(pieces(text))


def spans(df):
    return sorted((r["doc_id"], r["span_start"], r["span_end"], r["n_words"], r["n_chunks"], r["first_doc_id"]) for r in df.collect())


def brute(rows, run):
    held = {}
    for doc, text in rows:
        for p in pieces(text or ""):
            held.setdefault(p, set()).add(doc)
    for docs in held.values():
        docs.discard(None)
    out = []
    for doc, text in {r for r in rows if r[0] is not None}:
        now, at = [], 0
        for p in [*pieces(text or ""), None]:
            if p is not None and len(held[p]) > 1:
                now.append((at, p))
            elif now:
                whole = b"".join(x for _, x in now).decode()
                words = len(re.findall(r"[^\x20\x09-\x0D]+", whole))
                if words >= run:
                    out.append((doc, now[0][0], now[0][0] + len(whole), words, len(now), min(min(held[x]) for _, x in now)))
                now = []
            at += len(p.decode()) if p else 0
    return sorted(out)


def case():
    rng = random.Random(7)
    shared = [prose(rng, 60) for _ in range(4)] + ["ü" + prose(rng, 55)]
    rows = [r[:2] for r in awkward()]
    rows += [(100 + k, prose(rng, rng.randint(0, 80)) + " " + rng.choice(shared) + " " + prose(rng, 30)) for k in range(40)]
    return rows + [(200 + k, prose(rng, 100)) for k in range(20)]


def test_against_brute_force(spark):
    rows = case()
    assert spans(chunk_dedup.repeated_spans(documents(spark, rows, extra=True))) == brute(rows, chunk_dedup.RUN)


def test_planted_passages_are_found_and_clean_texts_left_alone(spark):
    found = {r["doc_id"] for r in chunk_dedup.repeated_spans(documents(spark, case())).collect()}
    assert {100 + k for k in range(40)} <= found and not found & {200 + k for k in range(20)}


def test_passages_of_51_words(spark):
    rng = random.Random(21)
    rows, want = [], set()
    for k in range(600):
        passage = prose(rng, 51)
        rows += [(2 * k, prose(rng, rng.randint(5, 60)) + "\n" + passage + " " + prose(rng, 9)), (2 * k + 1, prose(rng, rng.randint(5, 60)) + " " + passage + "\n" + prose(rng, 9))]
        want |= {2 * k, 2 * k + 1}
    short = []
    for k in range(300):
        passage = prose(rng, chunk_dedup.RUN - 1)
        short += [(5000 + 2 * k + j, prose(rng, 30) + " " + passage + " " + prose(rng, 30)) for j in (0, 1)]
    found = {r["doc_id"] for r in chunk_dedup.repeated_spans(documents(spark, rows + short)).collect()}
    assert len(want & found) >= 0.985 * len(want) and not found - want


def test_texts_of_one_doc_id_are_told_apart(spark):
    rng = random.Random(22)
    a, b, other = prose(rng, 80), prose(rng, 80), prose(rng, 20)
    rows = [(1, a + " " + other), (1, b), (1, b), (1, other + " " + a), (2, a), (3, prose(rng, 5) + " " + b)]
    got = chunk_dedup.repeated_spans(documents(spark, rows)).collect()
    assert spans(chunk_dedup.repeated_spans(documents(spark, rows))) == brute(rows, chunk_dedup.RUN)
    assert sum(r["doc_id"] == 1 for r in got) == 3 and len({r["text_id"] for r in got if r["doc_id"] == 1}) == 3
    assert chunk_dedup.repeated_spans(documents(spark, [(1, a), (1, a + " x")])).count() == 0  # one document


def test_any_partitioning(spark):
    df = documents(spark, case())
    assert spans(chunk_dedup.repeated_spans(df.repartition(7))) == spans(chunk_dedup.repeated_spans(df.coalesce(1)))


def test_empty(spark):
    assert chunk_dedup.repeated_spans(documents(spark, [])).count() == 0
    assert chunk_dedup.repeated_spans(documents(spark, [(1, None), (2, "")])).count() == 0


def test_query(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert spans(op6_repeated_spans(spark, sf_dir)) == brute(rows, chunk_dedup.RUN)
