import random
import re

import numpy as np
import pyarrow as pa

from skyphrase.llm import graph, near_dup
from skyphrase.llm.common import Scratch
from skyphrase.llm.queries import op4_near_duplicates

from ..compare import duck, same
from .helpers import awkward, documents, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    ws = WORD.findall((text or "").translate(LOWER))
    return {tuple(ws[k : k + 5]) for k in range(len(ws) - 4)} or ({tuple(ws)} if ws else set())


def brute(rows):
    """Rows (doc_id, n_shingles, component_id, kept), each row by its own text."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(low.get(find(i), doc), doc)
    return [(doc, len(sets[i]), low[find(i)] if doc is not None else None, doc is None or low[find(i)] == doc) for i, (doc, _) in enumerate(rows)]


def got(df):
    return [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()]


def key(rows):
    return sorted(rows, key=lambda r: tuple(-1 if x is None else x for x in r))


def test_awkward_rows(spark):
    rows = [r[:2] for r in awkward()]
    assert key(got(near_dup.near_duplicates(documents(spark, rows, extra=True)))) == key(brute(rows))


def test_empty_table(spark):
    assert got(near_dup.near_duplicates(documents(spark, []))) == []
    assert near_dup.distinct_documents(documents(spark, [])).count() == 0


def near_copies(seed, base, n):
    rng = random.Random(seed)
    words = prose(rng, base).split()
    out = []
    for _ in range(n):
        own = list(words)
        for _ in range(rng.randint(0, 6)):
            own[rng.randrange(len(own))] = f"edit{rng.randint(0, 10**6)}"
        out.append(" ".join(own))
    return out


def test_large_group_in_small_nodes_and_blocks(spark):
    """Nodes over their limit branch, then go to blocks: the same components as brute force."""
    texts = near_copies(3, 80, 120) + near_copies(4, 80, 30)
    rows = list(enumerate(texts))
    wanted = key(brute(rows))
    for limit, depth in ((4096, 4), (16, 2), (16, 0)):
        assert key(got(near_dup.near_duplicates(documents(spark, rows), node_limit=limit, depth=depth))) == wanted, (limit, depth)


def test_forest_spans_all_links():
    rng = random.Random(2)
    for _ in range(20):
        base = [rng.getrandbits(60) for _ in range(40)]
        sets = [set(base[: rng.randint(0, 40)]) | {rng.getrandbits(9) for _ in range(rng.randint(0, 6))} for _ in range(rng.choice([2, 25, 140]))]
        h = np.concatenate([np.array(sorted(s), dtype=np.uint64) for s in sets])
        border = np.concatenate([[0], np.cumsum([len(s) for s in sets])])

        def comps(edges, many=len(sets)):
            parent = list(range(many))

            def find(x):
                while parent[x] != x:
                    x = parent[x]
                return x

            for a, b in edges:
                parent[max(find(a), find(b))] = min(find(a), find(b))
            return [find(x) for x in range(many)]

        links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
        own = near_dup.forest(h, border, 75)
        assert len(own) <= len(sets) and comps(own) == comps(links)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (201, 200), (200, 201)]
    out = graph.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()
    root = {r["node"]: r["root"] for r in out}
    assert all(root[k] == 0 for k in range(1, 61)) and all(root[k] == 100 for k in range(101, 140)) and root[201] == 200 and 7 in root


def test_stage_keeps_one_of_each_group(spark):
    rows = [r[:2] for r in awkward()] + [(20, "a b c d e f g h"), (20, "other words of the same id are kept too")]
    kept = near_dup.distinct_documents(documents(spark, rows, extra=True))
    ids = sorted((-1 if r["doc_id"] is None else r["doc_id"]) for r in kept.collect())
    judged = {(d, t): k for (d, t), (_, _, _, k) in zip(rows, brute(rows), strict=True)}
    wanted = {(d, t) for (d, t), k in judged.items() if k and d is not None}
    assert {(r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"] is not None} == wanted
    assert ids.count(1) == 1 and ids.count(-1) == 2 and kept.columns == documents(spark, [], extra=True).columns


def test_query_against_sql(spark, sf_dir):
    from skyphrase.llm.oracle import oracle_sql

    same(op4_near_duplicates(spark, sf_dir), duck(sf_dir), oracle_sql()["op4_near_duplicates"])


def test_long_words_of_the_same_bytes_are_different_documents(spark):
    a, b = "ab" * 512 + "ba" * 512, "ba" * 512 + "ab" * 512
    rows = near_dup.near_duplicates(documents(spark, [(1, a), (2, b), (3, a)])).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {1: 1, 2: 2, 3: 1}


def test_cells_of_several_clusters_lose_no_link(spark):
    """Large nodes at the last level: groups that leaders join, and chains that only cells of blocks can link."""
    rng = random.Random(31)
    words, chain = prose(rng, 90).split(), []
    for k in range(40):  # each is linked to its neighbours, the ends are far apart
        words[(7 * k) % 90] = f"step{k}"
        words[(7 * k + 3) % 90] = f"more{k}"
        chain.append(" ".join(words))
    rows = list(enumerate(chain + near_copies(8, 90, 60) + near_copies(9, 60, 25)))
    rng.shuffle(rows)
    assert key(got(near_dup.near_duplicates(documents(spark, rows), node_limit=8, depth=0))) == key(brute(rows))


def test_a_node_that_branches_at_the_production_limit(spark):
    """More near copies than a node may hold, all linked to the first: one component, and what isn't a copy stays out."""
    rng = random.Random(41)
    base = prose(rng, 80).split()
    rows = [(0, " ".join(base))]
    for k in range(1, near_dup.NODE + 400):
        own = list(base)
        for at in rng.sample(range(80), 2):
            own[at] = f"edit{rng.randint(0, 10**9)}"
        rows.append((k, " ".join(own)))
    rows += [(10_000 + k, prose(rng, 80)) for k in range(50)]
    linked = {k for k, t in rows[: near_dup.NODE + 400] if 100 * len(shingles(t) & shingles(rows[0][1])) >= 75 * len(shingles(t) | shingles(rows[0][1]))}
    out = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(documents(spark, rows)).collect()}
    assert len(linked) > near_dup.NODE and all(out[k] == 0 for k in linked) and all(out[10_000 + k] == 10_000 + k for k in range(50))


def test_classes_whose_digests_half_agree(spark, monkeypatch):
    """Where first halves collide, every row still comes out once."""
    real = near_dup.sketch_rows

    def half(part):
        out = real(part)
        at = out.schema.get_field_index("d1")
        return out.set_column(at, "d1", pa.array(out.column(at).to_numpy() % 3))

    monkeypatch.setattr(near_dup, "sketch_rows", half)
    rng = random.Random(4)
    rows = [(k, prose(rng, 30)) for k in range(12)] + [(20 + k, prose(rng, 9)) for k in range(4)]
    got = near_dup.near_duplicates(documents(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(k for k, _ in rows)


def test_counts_are_whole_numbers():
    rng = np.random.default_rng(2)
    common = np.sort(rng.choice(2**60, 3000, replace=False)).astype(np.uint64)
    sets = [np.sort(np.concatenate([common, rng.choice(2**62, 5, replace=False).astype(np.uint64)])) for _ in range(40)]
    h, border = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    assert len(near_dup.forest(h, border, 75)) == 39 and near_dup.forest(h, border, 100) == []
