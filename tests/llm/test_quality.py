import math
import random
import re

import numpy as np

from skyphrase.llm import quality_rules, site_quality
from skyphrase.llm.queries import op1_quality_rules, op10_site_quality
from skyphrase.llm.textops import Words

from .helpers import awkward, documents, prose
from .test_textops import WORD

import pyarrow as pa


def corpus(seed=1):
    rng = random.Random(seed)
    good = [(k, prose(rng, rng.randint(30, 200))) for k in range(60)]
    bad = [(100 + k, " | ".join(f"zz{rng.randint(0, 9)}" for _ in range(60))) for k in range(20)]
    return good, bad


def test_scores_are_the_log_likelihood_ratio(spark):
    good, bad = corpus()
    rows = good + bad + [r[:2] for r in awkward()]
    trusted = spark.createDataFrame([(k,) for k, _ in good[:40]] + [(good[0][0],), (None,), (99999,)], "doc_id long")
    out = {(r["doc_id"], r["n_words"], r["word_chars"]): r for r in quality_rules.quality(documents(spark, rows, extra=True), trusted).collect()}
    raw, target, grams = np.zeros(quality_rules.BUCKETS), np.zeros(quality_rules.BUCKETS), []
    names = {k for k, _ in good[:40]}
    for doc, text in rows:
        h, _ = quality_rules.buckets(Words(pa.array([text or ""])))
        grams.append(h)
        np.add.at(raw, h, 1)
        if doc in names:
            np.add.at(target, h, 1)
    weight = [math.log((t + 1) / (target.sum() + len(raw))) - math.log((r + 1) / (raw.sum() + len(raw))) for r, t in zip(raw, target, strict=True)]
    kept = 0
    for (doc, text), h in zip(rows, grams, strict=True):
        ws = WORD.findall(text or "")
        r = out[(doc, len(ws), sum(map(len, ws)))]
        score = sum(weight[k] for k in h) / max(len(h), 1)
        assert abs(r["score"] - score) < 1e-9
        windows = [tuple(ws[k : k + 8]) for k in range(len(ws) - 7)]
        count = {}
        for x in windows:
            count[x] = count.get(x, 0) + 1
        repeats = len({k + j for k, x in enumerate(windows) if count[x] > 1 for j in range(8)})
        failed = len(ws) < 20 or 100 * repeats > 30 * len(ws)
        assert r["n_repeat_words"] == repeats and r["base_failed"] == failed and r["kept"] == (not failed and r["score"] >= quality_rules.THRESHOLD)
        kept += r["kept"]
    assert kept > 40 and not any(out[k]["kept"] for k in out if k[0] is not None and k[0] >= 100)


def test_target_counts_all_trusted_documents(spark):
    """More trusted ids than a block holds, of any size and spread: all are counted, and the block size changes nothing."""
    rng = random.Random(4)
    ids = [-(2**63), 2**63 - 1, *rng.sample(range(-(10**15), 10**15), 300), *range(5000, 5100)]
    rows = [(k, f"w{n} shared w{n} tail") for n, k in enumerate(ids)] + [(10**16, "raw only"), (None, "w1 shared"), (ids[5], "a repeated row")]
    docs, trusted = documents(spark, rows).select("doc_id", "text"), spark.createDataFrame([(k,) for k in ids + ids[:9]] + [(None,), (77,)], "doc_id long")
    names = trusted.where("doc_id is not null").distinct()
    found = quality_rules.ranges(names, names.count(), 40)
    assert len(found) > 8 and all(b + 1 == c for (_, b), (c, _) in zip(found, found[1:]))
    assert max(names.where(f"doc_id between {a} and {b}").count() for a, b in found[:3] + found[-2:]) <= 40
    raw, target = np.zeros(quality_rules.BUCKETS), np.zeros(quality_rules.BUCKETS)
    for doc, text in rows:
        h, _ = quality_rules.buckets(Words(pa.array([text])))
        np.add.at(raw, h, 1)
        if doc in set(ids):
            np.add.at(target, h, 1)
    for most in (40, 10**6):
        assert np.allclose(quality_rules.fit(docs, trusted, most), quality_rules.log_ratio(raw, target), atol=1e-12, rtol=0)


def test_rules_on_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long")
    assert quality_rules.quality(documents(spark, []), none).count() == 0
    assert quality_rules.quality(documents(spark, [(1, None)]), none).first()["kept"] is False


def test_site_posteriors_by_brute_force(spark):
    good, bad = corpus(2)
    rng = random.Random(3)
    rows = [(k, t, rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", None, f"rare{k}"]), 1) for k, t in good + bad] + [(None, None, "en", "a", None), (1, good[1][1], "en", "b", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, 1, 0) for k, _ in good[:50]] + [(k, 0, 0) for k, _ in bad[:15]] + [(None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    out = site_quality.site_quality(df, labels).collect()
    assert len(out) == len(rows)
    p = [r["doc_score"] for r in out]
    mean = sum(p) / len(p)
    hosts, paths = {}, {}
    for r in out:
        hosts.setdefault(r["host"], []).append(r["doc_score"])
        paths.setdefault((r["host"], r["path"]), []).append(r["doc_score"])
    n = len(p)
    spread = sum(len(v) * (sum(v) / len(v) - mean) ** 2 for v in hosts.values()) / n
    kh = site_quality.strength(mean, spread, mean * (1 - mean) * len(hosts) / n)
    hm = {h: (sum(v) + kh * mean) / (len(v) + kh) for h, v in hosts.items()}
    spread = sum(len(v) * (sum(v) / len(v) - hm[h]) ** 2 for (h, _), v in paths.items()) / n
    kp = site_quality.strength(mean, spread, mean * (1 - mean) * len(paths) / n)
    for r in out:
        own = paths[r["host"], r["path"]]
        path_mean = (sum(own) - r["doc_score"] + kp * hm[r["host"]]) / (len(own) - 1 + kp)
        assert abs(r["host_posterior"] - hm[r["host"]]) < 1e-9 and abs(r["path_posterior"] - path_mean) < 1e-9
        odds = math.log(r["doc_score"] / (1 - r["doc_score"])) + 0.5 * (math.log(path_mean / (1 - path_mean)) - math.log(mean / (1 - mean)))
        assert abs(r["quality"] - 1 / (1 + math.exp(-odds))) < 1e-6 and r["kept"] == (r["quality"] >= 0.5)
    verdict = {r["doc_id"]: r["kept"] for r in out}
    assert not any(verdict[k] for k, _ in bad) and all(verdict[k] for k, _ in good)
    left = site_quality.good_documents(df, labels)
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect() if r["doc_id"] is not None} == {k for k, v in verdict.items() if v and k is not None}


def plain_features(text):
    """The ten statistics of a text, one after the other."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n, size = max(len(words), 1), max(len(text.encode()), 1)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    inside = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    share = lambda chars: sum(text.count(c) for c in chars) / size
    return [
        min(math.log1p(len(words)), 5) / 5, len(inside) / n, (len(lines) - len(set(lines))) / max(len(lines), 1), min(sum(text.count(c) for c in "#*$%&|<>") / n, 2),
        10 * share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), 10 * share("!?;:=~^_{}[]()\\/\"'"), 10 * share("0123456789"), min(sum(map(len, words)) / n, 20) / 10,
        len(set(words)) / n if len(words) >= 20 else 0.7, 5 * share(" \t\n\v\f\r"),
    ]


def test_classifier_against_plain_versions(spark):
    """Features in plain Python; weights where the penalised log loss has no slope; each document's own probability."""
    good, bad = corpus(5)
    rows = good + bad + [(9000, "Ünï çödé " * 30), (9001, ""), (9002, "a b\na b\n a b")]
    x = np.array([plain_features(t) for _, t in rows])
    assert np.allclose(site_quality.features(pa.array([t for _, t in rows])), x, atol=1e-9)
    known = {k: 1 for k, _ in good[:40]} | {k: 0 for k, _ in bad[:10]}
    labels = spark.createDataFrame([(k, q, 0) for k, q in known.items()], "doc_id long, quality int, toxic int")
    at = np.array([k for k, (d, _) in enumerate(rows) if d in known])
    y = np.array([known[rows[k][0]] for k in at])
    w = site_quality.fit(documents(spark, rows).select("doc_id", "text"), labels)
    z = np.column_stack([x[at], np.ones(len(at))])
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) * len(y)
    slope = z.T @ (weight * (1 / (1 + np.exp(-z @ w)) - y)) + np.r_[np.ones(10), 1e-6] * w
    assert np.abs(slope).max() < 1e-3
    again = site_quality.fit(documents(spark, rows + rows[:5]).select("doc_id", "text").repartition(5), labels)
    assert np.allclose(w, again, atol=1e-9)  # repeated rows count once
    out = {r["doc_id"]: r["doc_score"] for r in site_quality.site_quality(documents(spark, rows), labels).collect()}
    for k, (d, _) in enumerate(rows):
        assert abs(out[d] - 1 / (1 + math.exp(-max(-12, min(12, float(x[k] @ w[:-1] + w[-1])))))) < 1e-9


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert site_quality.site_quality(documents(spark, []), none).count() == 0
    rows = [r[:2] for r in awkward()]
    out = site_quality.site_quality(documents(spark, rows, extra=True).drop("path", "host"), none).collect()
    assert len(out) == len(rows) and all(r["kept"] for r in out)
    assert site_quality.good_documents(documents(spark, rows, extra=True), none).count() == len(rows)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    for query, out in (("rules", op1_quality_rules(spark, d).select("doc_id", "kept", "base_failed")), ("sites", op10_site_quality(spark, d).selectExpr("doc_id", "kept", "false as base_failed"))):
        rows = [(r["kept"], r["quality"]) for r in out.join(labels, "doc_id").collect() if not (r["base_failed"] and r["quality"] == 1)]
        assert np.mean([k == bool(q) for k, q in rows]) > 0.97, query
