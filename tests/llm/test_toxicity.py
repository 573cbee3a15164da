import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from skyphrase.llm import textops, toxicity
from skyphrase.llm.queries import op8_toxicity
from skyphrase.llm.textops import Words

from .helpers import WORDS, awkward, documents, prose


def test_windows_cover_every_word_and_overlap():
    for n in [0, 1, 47, 48, 49, 80, 81, 500]:
        doc, first = toxicity.windows(np.array([n, 3]))
        own = first[doc == 0]
        covered = {k for f in own for k in range(f, min(f + toxicity.WINDOW, n))}
        assert covered == set(range(n)) and len(own) >= 1 and (n < toxicity.WINDOW or own[-1] + toxicity.WINDOW == n)
        assert all(b - a <= toxicity.STRIDE for a, b in zip(own, own[1:], strict=False))


def test_gradients_are_those_of_the_loss():
    net = toxicity.Network()
    for name in net.p:
        net.p[name] = net.p[name].astype(np.float64)
    words = Words(pa.array(["one two three four five", "idiot ö", ""]), fold=True)
    lex = toxicity.Lexicon(words)
    steps = int(words.count.max())
    mask = np.arange(steps)[:, None] < words.count
    ids = lex.id[np.minimum(words.first[:-1] + np.arange(steps)[:, None], len(lex.id) - 1)]
    y, weight = np.array([0.0, 1.0, 1.0]), np.array([0.5, 0.3, 0.2])
    grads = net.step(lex, ids, mask, y, weight)

    def loss():
        p = net.score(ids, net.vectors(lex), mask)
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()

    for name, value in net.p.items():
        at = np.unravel_index(np.abs(grads[name]).argmax(), value.shape)
        old = value[at]
        value[at] = old + 1e-4
        high = loss()
        value[at] = old - 1e-4
        low = loss()
        value[at] = old
        assert abs((high - low) / 2e-4 - grads[name][at]) < 1e-4, name


def test_scores_do_not_depend_on_other_texts():
    net = toxicity.Network()
    rng = random.Random(1)
    own = [prose(rng, n) for n in (3, 48, 130, 700)] + [""]
    def top(texts):
        doc, _, p = net.window_scores(Words(pa.array(texts), fold=True))
        return [float(p[doc == d].max()) for d in range(len(texts))]

    assert np.allclose(top(own), [top([t])[0] for t in own], atol=1e-5)


def case(n=240):
    rng = random.Random(2)
    rows = []
    for k in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randint(20, 160))]
        if k % 3 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vile", "nasty", "grimword"]) + rng.choice(["", "s", "ly"]))
        rows.append((1000 + k, " ".join(words)))
    return rows, [(d, 1, int(k % 3 == 0)) for k, (d, _) in enumerate(rows)]


def test_learns_and_holds_out(spark):
    rows, marks = case()
    extra = [r[:2] for r in awkward()]
    labels = spark.createDataFrame([*marks, (None, 1, 1), (1001, 1, None)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(documents(spark, rows + extra, extra=True), labels).collect()
    assert len(out) == len(rows) + len(extra)
    truth = {d: t for d, _, t in marks}
    for r in out:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [r["predicted"] == truth[r["doc_id"]] for r in out if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 20 and np.mean(held) > 0.9
    empty = {r["score"] for r in out if r["doc_id"] in (4, 5, 6)}
    assert len(empty) == 1


def test_held_out_labels_do_not_matter(spark):
    rows, marks = case(60)
    flip = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, q, t in marks]
    nets = [toxicity.fit(documents(spark, rows), spark.createDataFrame(m, "doc_id long, quality int, toxic int")) for m in (marks, flip)]
    assert all(np.array_equal(nets[0].p[k], nets[1].p[k]) for k in nets[0].p)


def test_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.toxicity(documents(spark, [(1, "a b"), (2, None)]), none).collect()} == {0.5}
    assert toxicity.toxicity(documents(spark, []), none).count() == 0


def test_held_out_accuracy_of_the_query(spark):
    d = "/root/testdata/sf0.01"
    rows = op8_toxicity(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.85


def plain_score(net, text):
    """The highest probability of a text's windows, in plain loops: word by word, one number after the other."""
    p = {k: v.astype(float).tolist() for k, v in net.p.items()}
    mask = 2**64 - 1

    def finish(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        return x ^ (x >> 31)

    def vector(word):
        data = word.encode()
        code = [0x51ED270B] + [int(textops.FOLDED_CODE[c]) for c in data]
        grams = []
        for n in (3, 5):
            for k in range(len(code) - n + 1):
                acc = code[k]
                for j in range(1, n):
                    acc += code[k + j] * (0x9E3779B97F4A7C15 + 2 * j * j * 0x1234567)
                grams.append(finish((acc + n) & mask) >> 48)
        own = int(textops.Words(pa.array([word]), fold=True).hash[0])
        known = [int(h) for h in net.known]
        out = list(p["word"][known.index(own) + 1 if own in known else 0])
        for i in range(len(out)):
            if grams:
                out[i] += sum(p["gram"][g][i] for g in grams) / len(grams)
        return out

    logistic = lambda x: 1 / (1 + math.exp(-x))
    H = toxicity.HIDDEN

    def direction(vectors, d):
        h, states = [0.0] * H, []
        for x in vectors:
            a = [p[f"c{d}"][j] + sum(x[i] * p[f"w{d}"][i][j] for i in range(len(x))) for j in range(3 * H)]
            g = [sum(h[i] * p[f"u{d}"][i][j] for i in range(H)) for j in range(3 * H)]
            z = [logistic(a[j] + g[j]) for j in range(H)]
            r = [logistic(a[H + j] + g[H + j]) for j in range(H)]
            n = [math.tanh(a[2 * H + j] + r[j] * g[2 * H + j]) for j in range(H)]
            h = [(1 - z[j]) * n[j] + z[j] * h[j] for j in range(H)]
            states.append(h)
        return states

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    starts = [0] if len(words) <= toxicity.WINDOW else sorted({*range(0, len(words) - toxicity.WINDOW, toxicity.STRIDE), len(words) - toxicity.WINDOW})
    best = 0.0
    for a in starts:
        vectors = [vector(w) for w in words[a : a + toxicity.WINDOW]]
        if not vectors:
            best = max(best, logistic(p["bias"][0]))
            continue
        f, b = direction(vectors, "f"), direction(vectors[::-1], "b")[::-1]
        states = [x + y for x, y in zip(f, b, strict=True)]
        att = [math.exp(sum(s[i] * p["att"][i] for i in range(2 * H))) for s in states]
        pooled = [sum(w * s[i] for w, s in zip(att, states, strict=True)) / sum(att) for i in range(2 * H)]
        best = max(best, logistic(p["bias"][0] + sum(c * o for c, o in zip(pooled, p["out"], strict=True))))
    return best


def test_scores_against_plain_loops():
    rng = random.Random(17)
    texts = ["", "one", "Two  words\n", prose(rng, 47), prose(rng, 48), prose(rng, 49), prose(rng, 130), "\u00e9t\u00e9 \U0001f600 " + prose(rng, 20)]
    words = textops.Words(pa.array(texts), fold=True)
    net = toxicity.Network(3, np.unique(words.hash)[::3])
    for name in net.p:
        net.p[name] = (np.random.default_rng(len(name)).normal(size=net.p[name].shape) * 0.5).astype(np.float32)
    doc, _, got = net.window_scores(words)
    for d, text in enumerate(texts):
        assert abs(float(got[doc == d].max()) - plain_score(net, text)) < 1e-4, text[:30]


def test_training_reads_all_windows_of_a_bounded_sample(spark, monkeypatch):
    """A toxic passage anywhere in a long text is among the windows; equal rows count once; bytes are bounded."""
    rng = random.Random(18)
    long = prose(rng, 3000) + " needle " + prose(rng, 3000)
    rows = [(k, prose(rng, 30)) for k in range(40)] + [(50, long), (50, long), (51, "z" * 200_000)]
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(40)] + [(50, 1, 1), (51, 1, 0)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, y: seen.append((texts, y)))
    monkeypatch.setattr(toxicity, "held_out", lambda c: F.lit(False))
    toxicity.fit(documents(spark, rows), labels, 1500, 100_000)
    texts, y = seen[0]
    assert len(texts) == 41 == len(y) and sum(len(t) for t in texts) == 40 + len(toxicity.windows_of([long])[0])
    assert any("needle" in w for t in texts for w in t) and not any("zzz" in w for t in texts for w in t)
    toxicity.fit(documents(spark, rows), labels, 5, 100_000)
    assert len(seen[1][1]) == 10 and seen[1][1].sum() == 5
    toxicity.fit(documents(spark, rows).repartition(7), labels, 1500, 1500)
    toxicity.fit(documents(spark, rows), labels, 1500, 1500)
    assert seen[2][0] == seen[3][0] and all(sum(len(" ".join(t).encode()) for t, v in zip(*seen[2], strict=True) if v == k) <= 1500 for k in (0, 1))
