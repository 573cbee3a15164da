import random
import re
import time
from collections import Counter
from pathlib import Path

import pytest

from skyphrase.llm import license_texts, licenses
from skyphrase.llm.queries import op9_license_scan

from ..compare import duck, same
from .helpers import awkward, documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall((text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER)))
    at = lambda p: [k for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
    base = {p: at(p) for p in licenses.BASE}
    starts = [k for v in base.values() for k in v]
    found = {licenses.BASE[p] for p, v in base.items() if v}
    labels, best = set(found), 0.0
    word = lambda k: words[k] if 0 <= k < len(words) else None
    for t, (label, own, key) in enumerate(licenses.TEMPLATES):
        votes = Counter(k - p for k, x in enumerate(words) for u, p in licenses.INDEX.get(x, ()) if u == t)
        begins = [b for b, n in votes.items() if n >= licenses.VOTES]
        for b in begins:
            low, high = max(b - licenses.SLACK, 0), max(b, 0) + len(own) + licenses.SLACK - len(key)
            if not any(low <= k <= high for k in at(" ".join(key))):
                continue
            near = [c for c in begins if abs(c - b) <= licenses.DRIFT]
            score = sum(any(word(c + k) == w for c in near) for k, w in enumerate(own)) / len(own)
            if score >= licenses.COVER:
                labels.add(label)
                best = max(best, score)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(found)), ",".join(sorted(labels)), best


def case():
    rng = random.Random(1)
    texts = [r[1] for r in awkward()] + ["MIT License mit license", "cc by", "cc-by-nc 4.0", "gnu General/Public license", "apache\x00license", "é license mit", "license", "cc", "mit"]
    for _, words, _ in licenses.TEMPLATES:
        texts.append(prose(rng, 20) + " " + " ".join(words).upper() + ". " + prose(rng, 5))
        edited = [w for w in words if rng.random() > 0.15]
        added = [x for w in words for x in ([w, "added"] if rng.random() < 0.03 else [w])]
        texts += [" ".join(edited), " ".join(added), " ".join(words[: len(words) * 2 // 3]), " ".join(words[3:]) + " mit license", " ".join(reversed(words))]
    texts.append(" ".join(" ".join(w) for _, w, _ in licenses.TEMPLATES) * 3)
    return list(enumerate(texts)) + [(0, "cc by"), (None, "cc by mit license")]


def test_index_is_of_the_rarest_words():
    held = Counter(w for _, words, _ in licenses.TEMPLATES for w in set(words))
    for t, (_, words, _) in enumerate(licenses.TEMPLATES):
        own = {w for w, found in licenses.INDEX.items() if t in {u for u, _ in found}}
        rest = set(words) - own
        assert len(own) >= min(licenses.LEAST, len(set(words))) and all(held[w] > licenses.RARE for w in rest)
        assert not rest or max(held[w] for w in sorted(own, key=held.get)[: licenses.LEAST]) <= min(held[w] for w in rest)
    assert all((t, p) in licenses.INDEX[w] for t, (_, words, _) in enumerate(licenses.TEMPLATES) for p, w in enumerate(words) if w in licenses.INDEX)


def test_whole_texts_are_told_apart(spark):
    """Each text, with a name before it and an insertion in it, gets its own label, and no other but those of its base."""
    rng = random.Random(2)
    inserted = lambda w: " ".join(w[:40] + ["(see", "below)"] * (len(w) > 60) + w[40:])
    rows = [(k, "Copyright (c) 2024 Somebody\n" + inserted(text.split())) for k, (_, _, text) in enumerate(licenses.TEXTS)]
    rows += [(1000 + k, prose(rng, 300)) for k in range(20)]
    out = {r["doc_id"]: set(r["labels"].split(",")) - {""} for r in licenses.license_scan(documents(spark, rows)).collect()}
    for k, (label, _, text) in enumerate(licenses.TEXTS):
        assert label in out[k] and out[k] - {label} <= set(brute(text)[4].split(",")), (label, out[k])
    assert not any(out[1000 + k] for k in range(20))


def test_against_brute_force(spark):
    rows = case()
    out = licenses.license_scan(documents(spark, rows, extra=True)).collect()
    order = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r) for r in out), key=order) == sorted(((d, *brute(t)) for d, t in rows), key=order)
    found = {d: brute(t)[5].split(",") for d, t in rows}
    assert all(any(label in v for v in found.values()) for label, _, _ in licenses.TEMPLATES)


def test_words_of_every_character(spark):
    """Each code point between two letters: part of the word or not, as the pattern says."""
    points = [*range(1, 0x300), 0x7FF, 0x800, 0x2028, 0x3000, 0xD7FF, 0xE000, 0xFFFD, 0xFFFF, 0x10000, 0x1F600, 0x10FFFF]
    rows = [(k, f"a{chr(k)}b \u00e9{chr(k)}") for k in points]
    out = {r["doc_id"]: r["n_words"] for r in licenses.license_scan(documents(spark, rows)).collect()}
    assert all(out[k] == len(WORD.findall(t.translate(str.maketrans(licenses.UPPER, licenses.LOWER)))) for k, t in rows)


def test_empty(spark):
    assert licenses.license_scan(documents(spark, [])).count() == 0


def test_plan_has_no_python_and_no_shuffle(spark, sf_dir):
    plan = op9_license_scan(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_query_against_sql(spark, sf_dir):
    from skyphrase.llm.oracle import oracle_sql

    same(op9_license_scan(spark, sf_dir), duck(sf_dir), oracle_sql()["op9_license_scan"])


OPENINGS = {
    "GPL-3": "gpl", "GPL-2": "gpl", "LGPL-3": "lgpl", "LGPL-2.1": "lgpl", "MPL-2.0": "mpl", "Apache-2.0": "apache",
}


@pytest.mark.parametrize("name", sorted(OPENINGS))
def test_license_files(spark, name):
    """The whole files that many systems carry, alone and behind other text."""
    path = Path("/usr/share/common-licenses") / name
    if not path.exists():
        pytest.skip("no such file here")
    text = path.read_text()
    rng = random.Random(3)
    rows = [(1, text), (2, prose(rng, 300) + "\n" + text), (3, text[: len(text) // 2])]
    for r in licenses.license_scan(documents(spark, rows)).collect():
        assert OPENINGS[name] in r["labels"].split(","), r
    others = set(OPENINGS.values()) - {OPENINGS[name], "gpl"}  # the base names GPL wherever it is mentioned
    assert not others & set(licenses.license_scan(documents(spark, rows[:1])).first()["labels"].split(","))


@pytest.mark.parametrize(("label", "name"), [("cc-by", "Attribution"), ("cc-by-sa", "Attribution-ShareAlike"), ("cc-by-nc", "Attribution-NonCommercial")])
def test_creative_commons_openings(spark, label, name):
    row = licenses.license_scan(documents(spark, [(1, "Intro words. " + license_texts._CC.format(name=name) + " Section 1 Definitions.")])).first()
    assert row["labels"] == label and row["score"] > 0.9


def test_agpl_opening(spark):
    text = "GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007\n" + license_texts._COPY + " Preamble. The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software."
    assert licenses.license_scan(documents(spark, [(1, text)])).first()["labels"] == "agpl"


def test_time_grows_with_the_file(spark):
    """Repeated licence text: eight times the length takes no more than some eleven times as long."""
    (mit,) = [text for label, _, text in license_texts.TEXTS if label == "mit" and len(text) > 500]
    took = []
    for many in (250, 250, 2000):
        rows = documents(spark, [(1, mit * many)])
        began = time.perf_counter()
        row = licenses.license_scan(rows).first()
        took.append(time.perf_counter() - began)
        assert row["labels"] == "mit" and row["n_words"] == many * len(re.findall(licenses.WORD, mit.lower()))
    assert took[2] < 11 * took[1] + 2, took
