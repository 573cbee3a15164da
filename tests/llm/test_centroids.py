import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from skyphrase.llm import centroids as ce
from skyphrase.llm.queries import op11_centroid_clusters

SCHEMA = "vec_id long, embedding array<double>, label int"


def slow(rows, k=40, rounds=5, dims=64, scale=256):
    """Lloyd's rounds in plain whole numbers over every row."""
    clamp = lambda v: max(-ce.BOUND, min(ce.BOUND, math.floor(v)))
    kept = [(i, [clamp(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    at = [q for _, q in sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)[:k]]

    def best(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), j) for j, c in enumerate(at))

    for _ in range(rounds):
        own = [best(q)[1] for _, q in kept]
        for j in range(len(at)):
            members = [q for (_, q), o in zip(kept, own, strict=True) if o == j]
            if members:
                at[j] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    last = [(i, *reversed(best(q))) for i, q in kept]
    of = [sum(d for _, j, d in last if j == c) for c in range(len(at))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    fits = lambda s: s if s < 1 << 63 else None
    return [(i, j, d, fits(of[j]), fits(sum(of)), digest[j]) for i, j, d in last]


def table(seed=1, n=400, copies=150):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(i % 6, 0.4) for _ in range(64)]) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(copies)]  # one vector holds a third of the rows
    rows += [(n + 500 + i, rows[i % 9][1]) for i in range(60)]
    rows += [(9000, None), (9001, []), (9002, [0.0] * 63), (9003, [0.0] * 65), (9004, [0.0] * 63 + [None]), (9005, [0.0] * 63 + [math.nan]), (9006, [math.inf] + [0.0] * 63), (9007, [0.0] * 64), (9008, [-0.0] * 64)]
    rows += [(None, rows[5][1]), (7, rows[7][1]), (7, rows[8][1])]
    return rows


def frame(spark, rows):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    for name in ("q", "n", "key", "cluster", "distance", "_x", "a.b"):
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: [(x is not None, x) for x in r])


def test_query_against_plain_loops(spark, tmp_path):
    rows = table()
    frame(spark, rows).repartition(7).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op11_centroid_clusters(spark, str(tmp_path))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert ordered(got.collect()) == ordered(slow(rows))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5] * 64)], [(1, [0.5] * 64), (1, [0.5] * 64), (None, [1.0] * 64)]], ids=["empty", "null", "one", "ties"])
def test_small_tables(spark, rows):
    assert ordered(ce.clusters(frame(spark, rows)).collect()) == ordered(slow(rows))


def test_large_components_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(0, 9) for _ in range(64)]) for i in range(80)]
    assert ordered(ce.clusters(frame(spark, rows)).collect()) == ordered(slow(rows))


def test_other_sizes(spark):
    rng = random.Random(5)
    rows = [(i, [rng.random(), rng.random()]) for i in range(100)]
    got = ce.clusters(frame(spark, rows), k=3, rounds=2, dimensions=2, scale=1000)
    assert ordered(got.collect()) == ordered(slow(rows, 3, 2, 2, 1000))


def test_ties_go_to_the_smaller_number():
    at = np.array([[4, 0], [0, 4], [0, 0]])
    own, gap = ce.nearest(np.array([[2, 2], [4, 4], [0, 2], [0, 1]]), at)
    assert own.tolist() == [0, 0, 1, 2] and gap.tolist() == [8, 16, 4, 1]


def test_rows_do_not_depend_on_partitions(spark):
    rows = table(2)
    one, many = frame(spark, rows).coalesce(1), frame(spark, rows).repartition(23)
    assert ordered(ce.clusters(one).collect()) == ordered(ce.clusters(many).collect())


def test_sql_agrees(spark):
    at = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{at}/embeddings.parquet')")
    assert ordered(con.execute(ce.oracle()).fetchall()) == ordered(op11_centroid_clusters(spark, at).collect())
