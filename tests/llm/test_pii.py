import hashlib
import random
import re
import time

import pytest

from skyphrase.llm import pii
from skyphrase.llm.queries import op5_personal_data

from .helpers import awkward, documents

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_NO = "4111 1111 1111 1111"


def luhn(d):
    total = 0
    for k, c in enumerate(map(int, reversed(d))):
        total += c if k % 2 == 0 else sum(divmod(2 * c, 10))
    return total % 10 == 0


def brute(text):
    out = [(0, *m.span()) for m in EMAIL.finditer(text)] if "@" in text else []  # the pattern takes quadratic time
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_patterns():
    rng = random.Random(1)
    parts = ["@", ".", "a", "B9", "-", " ", "+", "(", ")", "1", "22", "255", "256", "1.2.3.4", "a@b.c", CARD_NO, "+1 (017) 555-7713", "é", "%", "\n", "4111111111111111", "0" * 20]
    for _ in range(20000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    began = time.time()
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "a@" * 100_000, "+1" * 100_000, "1-" * 150_000, "+1" + "(" * 200_000):
        pii.base_spans(text)
    assert time.time() - began < 10


def case():
    rows = [r[:2] for r in awkward()]
    filler = "some words between them here and there"
    rows += [(100 + k, f"call +1 (555) 010-{1000 + k} now. {filler} mail ann{k}@mail.example.com, ip 10.0.0.{k} card {CARD_NO}. 123 12-34 x5") for k in range(30)]
    twins = f"call +1 (555) 010-7713 now. {filler} ring 555-010-7713 again or (555) 010-7713 {filler} not 555-010-7714"
    return rows + [(200, twins), (201, f"{filler} ring 555-010-7713 alone"), (None, twins), (200, twins)]


def test_counts_digests_and_added_spans(spark):
    rows = case()
    out = pii.personal_data(documents(spark, rows, extra=True)).collect()
    def wanted(doc, text):
        base = brute(text or "")
        return (doc, *[sum(k == kind for k, _, _ in base) for kind in range(4)], hashlib.sha256(pii.render(base).encode()).hexdigest())

    order = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r)[:6] for r in out), key=order) == sorted((wanted(*r) for r in rows), key=order)
    texts = dict(rows)
    by = {r["doc_id"]: r for r in out}
    for r in out:
        text = texts.get(r["doc_id"]) or ""
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        if r["doc_id"] is not None:
            assert set(pii.render(brute(text)).split(",")) <= set(r["spans"].split(","))
        assert len(spans) == sum(tuple(r)[1:5]) + r["n_added"]
    found = [texts[200][int(a) : int(b)] for k, a, b in (s.split(":") for s in by[200]["spans"].split(",")) if k == "phone"]
    assert found == ["+1 (555) 010-7713", "555-010-7713", "(555) 010-7713"]
    assert by[201]["n_added"] == 0 and all(by[100 + k]["n_added"] == 0 for k in range(30))


def test_masking_stage(spark):
    rows = case()
    left = pii.masked(documents(spark, rows, extra=True))
    assert left.columns == documents(spark, [], extra=True).columns and left.count() == len(rows)
    texts = {r["doc_id"]: r for r in left.collect()}
    assert texts[200]["text"].count("[PHONE]") == 3 and "7713" not in texts[200]["text"] and "7714" in texts[200]["text"]
    assert texts[200]["n_chars"] == len(texts[200]["text"]) and texts[4]["text"] is None and texts[5]["text"] == ""
    assert texts[101]["text"].startswith("call [PHONE] now.") and "[EMAIL], ip [IP] card [CARD]." in texts[101]["text"]


def test_empty(spark):
    assert pii.personal_data(documents(spark, [])).count() == 0
    assert pii.masked(documents(spark, [(1, None)])).first()["text"] is None


def test_messages_reach_the_exact_marginals_on_a_tree():
    """On a chain, loopy message passing gives the marginals of full enumeration."""
    import itertools

    import numpy as np
    import pyarrow as pa

    field = pii.Field(pa.array(["12 34 56"]), 1)
    assert field.chain.tolist() == [[0, 1], [1, 2]] and not len(field.skip)
    model = pii.Model()
    rng = np.random.default_rng(1)
    model.node, model.chain = rng.normal(size=model.node.shape), rng.normal(size=(5, 5))
    unary = field.x @ model.node
    weight = {y: np.exp(sum(unary[k, y[k]] for k in range(3)) + model.chain[y[0], y[1]] + model.chain[y[1], y[2]]) for y in itertools.product(range(5), repeat=3)}
    total = sum(weight.values())
    for k, row in enumerate(model.marginals(field)):
        assert row == pytest.approx([sum(w for y, w in weight.items() if y[k] == label) / total for label in range(5)], abs=0.01)


def test_messages_run_until_they_rest():
    """A long chain with strong links: marginals are those of the forward-backward recursion, in any company."""
    import numpy as np
    import pyarrow as pa

    model = pii.Model()
    rng = np.random.default_rng(2)
    model.node, model.chain = rng.normal(size=model.node.shape) / 20, 4 * np.eye(5)
    model.node[8] = [6, 0, 0, 0, 0]
    text = "@ " + " ".join(str(k % 10) for k in range(80))
    field = pii.Field(pa.array([text]), 1)
    unary, n = np.exp(field.x @ model.node), len(field.doc)
    ahead, behind = [np.ones(5)], [np.ones(5)]
    for k in range(n - 1):
        ahead.append((ahead[-1] * unary[k]) @ np.exp(model.chain))
        behind.append(np.exp(model.chain) @ (behind[-1] * unary[n - 1 - k]))
        ahead[-1], behind[-1] = ahead[-1] / ahead[-1].sum(), behind[-1] / behind[-1].sum()
    wanted = np.array([f * u * b for f, u, b in zip(ahead, unary, behind[::-1], strict=True)])
    got = model.marginals(field)
    assert n == 81 and np.abs(got - wanted / wanted.sum(axis=1, keepdims=True)).max() < 1e-4
    both = model.marginals(pii.Field(pa.array(["1 2 3", text, "@ 4"]), 3))
    assert np.allclose(both[3:84], got, atol=1e-12, rtol=0)


def test_hundreds_of_repeats_follow_one_base_span(spark):
    """However many times a number or an address returns, before or after the form that the patterns catch."""
    filler = "some words between them here and there"
    many = f" {filler} ring 555-010-7713" * 400
    texts = {300: "call +1 (555) 010-7713 now." + many, 301: many + " call +1 (555) 010-7713 now.", 303: many + " call +1 (555) 010-7713 now." + many}
    left = {r["doc_id"]: r["text"] for r in pii.masked(documents(spark, case() + list(texts.items()))).collect()}
    for doc, count in ((300, 401), (301, 401), (303, 801)):
        assert left[doc].count("[PHONE]") == count and "7713" not in left[doc]


@pytest.mark.parametrize("lead", [1, 2, 3, 4, 5])
def test_every_repeat_is_sure_however_far_other_leads(lead):
    """One clamped number and 300 repeats, before and after it, at the least skip weight: all follow it."""
    import numpy as np
    import pyarrow as pa

    model = pii.Model()
    model.node[0, pii.O] = lead
    model.skip = 6.0 * np.eye(5)
    text = "ring 555-010-7713 " * 150 + "call +1 (555) 010-7713 now " + "ring 555-010-7713 " * 150
    field = pii.Field(pa.array([text]), 1)
    phone = model.marginals(field)[:, pii.KINDS.index("phone")]
    assert len(field.skip) + len(field.star) < 3 * len(field.doc)
    assert len(phone) == 303 and (phone >= pii.SURE).all()


def test_added_spans_depend_on_the_text_alone():
    """A form without a twin, that the patterns miss and the features give away, alone and beside texts with twins."""
    import numpy as np
    import pyarrow as pa

    model = pii.Model()
    model.node[9, 0], model.node[0, pii.O], model.trained = 12.0, 4.0, True
    model.skip = 6.0 * np.eye(5)
    texts = ["write to @name.site.org now", "", "no tokens", "call +1 (555) 010-7713 now, ring 555-010-7713", "x1 y2", "@a.site.org 12 34 @b.site.org"]
    alone = [model.spans(pa.array([t]))[0] for t in texts]
    assert alone[0] == ([], [(0, 10, 23)]) and len(alone[5][1]) == 2 and alone[1] == alone[2] == ([], [])
    assert model.spans(pa.array(texts)) == alone and model.spans(pa.array(texts[::-1])) == alone[::-1]
    assert pii.Model().spans(pa.array(texts[:1])) == [([], [])]


def plain_marginals(model, field):
    """Sum-product in plain loops, messages one by one, until none changes: the same fixed point."""
    import numpy as np

    n = len(field.doc)
    unary = [np.exp((field.x[k] * 1.0) @ model.node) for k in range(n)]
    for k in range(n):
        if field.y[k] != pii.O:
            unary[k] = np.full(5, 1e-300)
            unary[k][field.y[k]] = 1.0
    edges = [(a, b, np.exp(w)) for own, w in ((field.chain, model.chain), (field.skip, model.skip), (field.star, model.skip)) for a, b in own.tolist()]
    near = {k: [e for e, (a, b, _) in enumerate(edges) if k in (a, b)] for k in range(n)}
    message = {(e, to): np.ones(5) for e, (a, b, _) in enumerate(edges) for to in (a, b)}

    def incoming(k, but=None):
        out = unary[k].copy()
        for e in near[k]:
            if e != but:
                out = out * message[e, k]
        return out

    for _ in range(4000):
        most = 0.0
        for (e, to), old in list(message.items()):
            a, b, factor = edges[e]
            new = incoming(a, e) @ factor if to == b else factor @ incoming(b, e)
            new = (old / old.max()) ** 0.5 * (new / new.max()) ** 0.5
            most = max(most, float(np.abs(np.log(new / new.max()) - np.log(old / old.max())).max()))
            message[e, to] = new / new.max()
        if most < 1e-8:
            break
    return np.array([incoming(k) / incoming(k).sum() for k in range(n)])


def test_marginals_and_added_spans_against_plain_loops():
    import numpy as np
    import pyarrow as pa

    rng, dice = random.Random(3), np.random.default_rng(3)
    numbers = ["+1 (555) 010-7713", "555-010-7713", "(555) 010-7713", "5550107713", "010.7713", "555-010-7714", "x9 10", "ann@a.example.com", "ann@aexamplecom", "10.0.0.7", "999.1.1.1"]
    for _ in range(25):
        model = pii.Model()
        model.node, model.chain = dice.normal(size=model.node.shape) / 2, dice.normal(size=(5, 5)) / 2
        model.skip, model.trained = np.eye(5) * dice.uniform(1, 4), True
        texts = [" and ".join(rng.choice(numbers) for _ in range(rng.randint(1, 5))) for _ in range(4)]
        field = pii.Field(pa.array(texts), 4)
        slow = plain_marginals(model, field)
        assert np.abs(model.marginals(field) - slow).max() < 1e-3, texts
        found = model.spans(pa.array(texts))
        for d, text in enumerate(texts):  # every sure token outside base spans is in an added span of its kind, and no other
            base, more = found[d]
            assert base == brute(text)
            for k in (k for k in range(len(field.doc)) if field.doc[k] == d):
                kind, top = int(slow[k].argmax()), float(slow[k].max())
                if abs(top - pii.SURE) < 5e-3:
                    continue
                sure = field.y[k] == pii.O and kind != pii.O and top >= pii.SURE
                inside = [s for s in more if s[1] < field.end[k] and field.begin[k] < s[2]]
                assert (sure and inside and inside[0][0] == kind) or (not inside and (not sure or any(a < field.end[k] and field.begin[k] < b for _, a, b in base)))


def test_same_rows_on_any_partitioning(spark):
    rows = case() + [(400 + k, f"ip 999.1.1.{k} seen") for k in range(20)] + [(500 + k, f"call +1 (555) 010-77{10 + k} or 555-010-77{10 + k}") for k in range(20)]
    df = documents(spark, rows)
    own = lambda parts: sorted(map(str, pii.personal_data(df.repartition(parts, "text")).collect()))
    assert own(1) == own(7) == own(43)


def test_skip_potential_is_learned_from_twins(spark):
    texts = documents(spark, [r[:2] for r in case()])
    model = pii.fit(pii._narrow(texts))
    import numpy as np

    assert model.skip[0, 0] > 3 and (model.skip == model.skip[0, 0] * np.eye(5)).all()
    without = documents(spark, [(k, f"{k} words {k % 7} and no personal data") for k in range(30)])
    assert not pii.fit(pii._narrow(without)).trained


def test_crowds_of_numbers_that_are_nothing_stay_nothing(spark):
    """Twins without a base span among them: however often a number returns, no span is added."""
    crowd = " order 1234567 of batch 555-010-9999" * 300
    out = {r["doc_id"]: r["n_added"] for r in pii.personal_data(documents(spark, case() + [(600, crowd), (601, crowd + " call +1 (555) 010-7713 or 555-010-7713")])).collect()}
    assert out[600] == 0 and out[601] == 1


def test_sample_is_bounded_by_documents_and_tokens(spark):
    rows = [(k, " ".join(f"{k}{j}" for j in range(50))) for k in range(20)] + [(99, "1 " * 5000)] + [(1, f"+1 (555) 010-{1000 + k}") for k in range(300)]
    df = pii._narrow(documents(spark, rows))
    seen = []

    class Spy(pii.Model):
        def train(self, x, y, chain, skip, rounds=1):
            seen.append(len(y))
            assert not len(chain) or chain.max() < len(y)
            return self

    original = pii.Model
    try:
        pii.Model = Spy
        pii.fit(df, sample=10, tokens=200), pii.fit(df, sample=400, tokens=10**6), pii.fit(df.repartition(9), sample=10, tokens=200)
    finally:
        pii.Model = original
    assert seen[0] <= 200 and seen[0] == seen[2] and seen[1] > 5000


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in op5_personal_data(spark, sf_dir).collect():
        assert r["base_sha256"] == hashlib.sha256(pii.render(brute(texts[r["doc_id"]])).encode()).hexdigest()
