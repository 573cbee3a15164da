import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from skyphrase.llm import periodic_runs as pr
from skyphrase.llm.queries import op13_periodic_runs

from .helpers import awkward, documents, prose


def slow_runs(words, least=12):
    """All runs in plain loops: maximal stretches by period, those whose smallest period it is."""
    n, out = len(words), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            e = i
            while e + q < n and words[e] == words[e + q]:
                e += 1
            s, e = i, e + q
            if e - s >= max(least, 2 * q) and not any(all(words[k] == words[k + p] for k in range(s, e - p)) for p in range(1, q)):
                out.add((s, e - s, q))
            i = max(i + 1, e - q + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, digest(listed), digest(" ".join(w for k, w in enumerate(words) if k not in gone)))


def fast_runs(texts):
    words, row, border = pr.vocabulary(pa.array(texts))
    start, end, period = pr.runs(row, border)
    own = np.searchsorted(border, start, side="right") - 1
    return [[(int(s - border[d]), int(e - s), int(q)) for s, e, q, o in zip(start, end, period, own, strict=True) if o == d] for d in range(len(texts))]


def test_runs_against_plain_loops():
    rng = random.Random(3)
    texts = []
    for _ in range(150):
        letters = "ab" if rng.random() < 0.5 else "abcd"
        words = [rng.choice(letters) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            phrase = [rng.choice(letters + "xyz") for _ in range(rng.randint(1, 14))]
            at = rng.randint(0, len(words))
            words[at:at] = (phrase * 6)[: rng.randint(1, 6 * len(phrase))]
        texts.append(" ".join(words))
    texts += [None, "", "same " * 40, "a b " * 30, "a b a " * 9, "same " * 11, "same " * 12, " ".join("a" * 13)]
    assert fast_runs(texts) == [slow_runs((t or "").split()) for t in texts]


@pytest.mark.parametrize("pairs", [7, 1000])
def test_blocks_of_any_size_find_the_same(monkeypatch, pairs):
    texts = ["x y z " * 20 + prose(random.Random(k), 50) + " u v" * 9 for k in range(5)]
    whole = fast_runs(texts)
    monkeypatch.setattr(pr, "PAIRS", pairs)
    assert fast_runs(texts) == whole and all(whole)


def test_extensions_against_plain_loops():
    rng = np.random.default_rng(5)
    row = rng.integers(0, 2, 200)
    row[60:140] = np.tile([0, 1, 1], 27)[:80]
    names = pr.levels(row)
    a = rng.integers(0, 199, 500)
    b = rng.integers(a + 1, 200)
    for back in (False, True):
        got = pr.extend(names, a, b, back)
        for x, y, n in zip(a, b, got, strict=True):
            plain = 0
            while (x - plain - 1 >= 0 and row[x - plain - 1] == row[y - plain - 1]) if back else (y + plain < 200 and row[x + plain] == row[y + plain]):
                plain += 1
            assert n == plain


def test_long_texts():
    n = 300_000
    (found,) = fast_runs(["spam " * n])
    assert found == [(0, n, 1)]
    rng = random.Random(2)
    phrase = [f"w{rng.random()}" for _ in range(40_000)]
    (found,) = fast_runs([" ".join(["head"] + phrase * 3 + ["tail"])])
    assert found == [(1, 120_000, 40_000)]


def test_query_against_plain_loops(spark, tmp_path):
    rng = random.Random(7)
    rows = awkward() + [(100 + k, prose(rng, rng.randint(0, 80)) + " na" * rng.randint(0, 20)) for k in range(120)] + [(5000, "a\tb\n" * 8), (5001, "z z " * 14), (5002, "\u0085 \x1c " * 14)]
    rows = [r for r in rows if r[0] != 12]  # too long for plain loops
    at = str(tmp_path)
    documents(spark, rows, extra=True).write.parquet(f"{at}/documents.parquet")
    got = op13_periodic_runs(spark, at)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((slow(*r) for r in rows), key=key)
    planted = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0 and len((r[1] or "").split()) > 40]
    assert len(planted) > 3
    assert "Exchange" not in got._jdf.queryExecution().toString()


def test_operator_returns_runs_and_text(spark):
    rows = [(1, "go " + "a b c " * 5 + "end"), (2, "one\n two"), (3, None)]
    got = {r["doc_id"]: r for r in pr.periodic_runs(documents(spark, rows)).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(1, 15, 3)] and got[1]["text"] == "go a b c end" and got[1]["n_words"] == 17
    assert got[2]["runs"] == [] and got[2]["text"] == "one two" and got[3]["text"] == "" and got[3]["n_words"] == 0


def test_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert op13_periodic_runs(spark, str(tmp_path)).count() == 0
