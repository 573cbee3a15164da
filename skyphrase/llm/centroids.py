"""Lloyd's clustering of vectors in whole numbers, run on distinct vectors that carry their multiplicity.

Components are turned into integers, ``floor(scale * x)``.  Equal vectors are grouped (partial counts in each task, so a
vector that a third of all rows share costs a row per task) and the distinct ones written once, with how often they
occur.  Each round reads that table: tasks find the nearest centroid of each vector and add up, by cluster, ``n`` and
``n`` times each component; Spark adds up the tasks' sums, and one row per centroid comes to the driver.  All sums
are whole numbers, so the result doesn't depend on how rows are dealt or in which order they are added.

The assignment is joined back to the ids by a digest of the vector (SHA-256 of its integers).  Vectors that hold a
1024th or more of all rows, at most ``HEAVY`` by that bound, are broadcast for it; the others meet their ids in a shuffle of
narrow rows, none of which has a hot key.

Edge cases: vectors that are null, of another length, or have a null or non-finite component are left out; a null vec_id
never starts a centroid but gets its cluster; rows that repeat a vec_id stay, each with its own vector, and of such ties
the lesser vector starts a centroid first; with fewer vectors than ``k`` there are as many centroids as vectors; an
empty table gives no rows; other columns are ignored.  Components beyond ``BOUND`` are taken as that (with a scale of 256,
x beyond 524,288), so that a squared distance always fits a long; sums of distances that don't fit one are null.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, col

K, ROUNDS, DIMENSIONS, SCALE, SALT = 40, 5, 64, 256, "2:"
BOUND = 1 << 27
HEAVY = 1024
#: Up to here products and their sums are whole numbers below 2^53, which doubles hold exactly.
_EXACT = 1 << 20


def quantised(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, q array<int>) of the vectors that are kept."""
    x = F.col("_x")
    narrow = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("_x"))
    kept = narrow.where((F.size(x) == dimensions) & F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf")))))
    whole = lambda v: F.floor(F.greatest(F.lit(-float(BOUND)), F.least(F.lit(float(BOUND)), F.lit(float(scale)) * v))).cast("int")
    return kept.select("vec_id", F.transform(x, whole).alias("q"))


def _key(q: str = "q"):
    return F.unhex(F.sha2(F.array_join(F.col(q).cast("array<string>"), ",").cast("binary"), 256))


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row: the nearest centroid, the smaller number on a tie, and its squared distance, exactly."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) <= _EXACT:
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        gap = (a * a).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c * c).sum(axis=1)
        gap = gap.astype(np.int64)
    else:
        gap = np.stack([((x - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    own = gap.argmin(axis=1)
    return own, gap[np.arange(len(x)), own]


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return col(batch, "q").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions).astype(np.int64)


def sums(distinct: DataFrame, centroids: np.ndarray) -> list:
    """(cluster, n, s0, s1, ...) of each cluster that has vectors: their number and the sums of their components."""
    k, dimensions = centroids.shape

    def run(batches):
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, dimensions), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, n = _matrix(batch, dimensions), col(batch, "n").to_numpy(zero_copy_only=False)
            own, _ = nearest(x, centroids)
            order = np.argsort(own, kind="stable")
            some, first = np.unique(own[order], return_index=True)
            total[some] += np.add.reduceat((x * n[:, None])[order], first)
            count[some] += np.add.reduceat(n[order], first)
        some = np.flatnonzero(count)
        if len(some):
            parts = pa.FixedSizeListArray.from_arrays(pa.array(total[some].ravel()), dimensions).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some]), parts], names=["cluster", "n", "s"])

    parts = distinct.mapInArrow(run, "cluster long, n long, s array<long>")
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[j]).alias(f"s{j}") for j in range(dimensions)]).collect()  # k rows at most


def moved(distinct: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floors of the means; a centroid without vectors stays."""
    out = centroids.copy()
    for row in sums(distinct, centroids):
        out[row["cluster"]] = [row[2 + j] // row["n"] for j in range(centroids.shape[1])]
    return out


def assigned(distinct: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(key, n, cluster, distance) of each distinct vector."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                own, gap = nearest(_matrix(batch, centroids.shape[1]), centroids)
                yield pa.RecordBatch.from_arrays([col(batch, "key"), col(batch, "n"), pa.array(own.astype(np.int32)), pa.array(gap)], names=["key", "n", "cluster", "distance"])

    return distinct.mapInArrow(run, "key binary, n long, cluster int, distance long")


def first_centroids(rows: DataFrame, k: int, salt: str = SALT) -> np.ndarray:
    """The vectors of the ``k`` least digests of the salted vec_id."""
    drawn = rows.where("vec_id is not null").select(F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256).alias("h"), "q")
    return np.array([r["q"] for r in drawn.orderBy("h", "q").limit(k).collect()], dtype=np.int64)


def clusters(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of each vector that is kept."""
    spark = vectors.sparkSession
    rows = quantised(vectors, dimensions, scale)
    at = first_centroids(rows, k)
    if not len(at):
        return rows.limit(0).select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    scratch = Scratch(spark)
    distinct = scratch.write(rows.groupBy("q").agg(F.count("*").alias("n")).select(_key().alias("key"), "q", "n"))
    for _ in range(rounds):
        at = moved(distinct, at)
    found = scratch.write(assigned(distinct, at))
    scratch.drop(distinct)
    wide = "decimal(38,0)"
    by = found.groupBy("cluster").agg(F.sum(F.col("n").cast("decimal(18,0)") * F.col("distance").cast("decimal(19,0)")).cast(wide).alias("s"), F.sum("n").alias("n")).collect()  # k rows at most
    fits = lambda s: int(s) if s is not None and s < 1 << 63 else None
    total = fits(sum(int(r["s"]) for r in by))
    facts = spark.createDataFrame(
        [(r["cluster"], fits(r["s"]), total, hashlib.sha256(",".join(map(str, at[r["cluster"]])).encode()).hexdigest()) for r in by],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    bound = max(2, -(-sum(r["n"] for r in by) // HEAVY))
    ids = rows.select("vec_id", _key().alias("key"))
    heavy = F.broadcast(found.where(F.col("n") >= bound).select("key", "cluster", "distance"))
    light = found.where(F.col("n") < bound).select("key", "cluster", "distance").hint("merge")
    out = ids.join(heavy, "key").unionByName(ids.join(heavy, "key", "left_anti").join(light, "key"))
    return out.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle() -> str:
    """DuckDB SQL of the query's rows, a stretch per round."""
    steps = [
        """kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, q) - 1 AS k, q FROM (SELECT sha256('2:' || vec_id) AS h, q FROM kept WHERE vec_id IS NOT NULL ORDER BY h, q LIMIT 40))"""
    ]
    for r in range(6):
        steps.append(
            f"""a{r} AS MATERIALIZED (
  SELECT rid, min({{'d': list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'k': k}}) AS m FROM kept v, c{r} c GROUP BY rid)"""
        )
        if r < 5:
            steps.append(
                f"""m{r} AS MATERIALIZED (
  SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS q FROM (
    SELECT a.m.k AS k, i, sum(v.q[i])::BIGINT AS s, count(*) AS n FROM a{r} a JOIN kept v USING (rid), range(1, 65) AS t(i) GROUP BY ALL) GROUP BY k),
c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.q, c.q) AS q FROM c{r} c LEFT JOIN m{r} m ON m.k = c.k)"""
            )
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, (a.m.k)::INT AS cluster, a.m.d AS distance, (sum(a.m.d) OVER (PARTITION BY a.m.k))::BIGINT AS cluster_inertia, (sum(a.m.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a5 a JOIN kept v USING (rid) JOIN c5 c ON c.k = a.m.k"""
