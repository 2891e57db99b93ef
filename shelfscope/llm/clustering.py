"""Operator 12, centroid clustering with a LAESA pivot table.

Vectors become integers.  The distances of every vector to a few fixed pivots are computed once and stored beside the
vector.  In each round the centroids' distances to the pivots are computed (a handful), and
``max over pivots |d(vector, pivot) - d(centroid, pivot)|`` bounds the distance of every vector to every centroid from
below.  The centroid with the smallest bound is measured first; only centroids whose bound does not exceed the best
distance so far are measured too, in exact integers.  Bounds only decide what is measured, never what is nearest.

A round is one pass over the stored table: each task adds up its vectors by cluster and hands on one row per cluster and
component, which Spark sums.  Centroids (k x components integers) are the only thing that comes to the driver or goes to
all tasks; a vector that a third of all rows repeat is only a larger count.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable, through_table

BOUND = 1 << 27       # integers are held within +-BOUND, so that a squared distance of 64 components fits a long
POOL = 64             # vectors from which the pivots are chosen: the first in hash order
TABLE = "key {key}, q array<int>, near array<double>"


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` from the vector ``b``."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def spread_pivots(pool: np.ndarray, n: int) -> np.ndarray:
    """``n`` vectors of the pool, each the farthest (by sum) from those before it; fewer if the pool holds fewer different ones."""
    if not len(pool):
        return pool
    chosen, total = [0], np.sqrt(squared(pool, pool[0]).astype(float))
    while len(chosen) < n:
        total[chosen] = -1
        i = int(np.argmax(total))
        if total[i] <= 0:
            break
        chosen.append(i)
        total = total + np.sqrt(squared(pool, pool[i]).astype(float))
    return pool[chosen]


def pivot_distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([squared(vectors, p) for p in pivots], axis=1).astype(float))


def nearest(vectors: np.ndarray, near: np.ndarray, centroids: np.ndarray, centroid_near: np.ndarray):
    """``(cluster, squared distance, distances measured)`` of every vector; ties go to the smaller number."""
    n, k = len(vectors), len(centroids)
    bound = np.zeros((n, k))
    for j in range(near.shape[1]):
        np.maximum(bound, np.abs(near[:, j:j + 1] - centroid_near[None, :, j]), out=bound)
    bound -= 1e-3 + 1e-9 * bound   # far above the rounding of the square roots
    best = np.argmin(bound, axis=1)
    dist = np.empty(n, np.int64)
    for c in np.unique(best):
        at = best == c
        dist[at] = squared(vectors[at], centroids[c])
    first, measured = best.copy(), np.ones(n, np.int64)
    for c in range(k):
        at = np.flatnonzero((bound[:, c] <= np.sqrt(dist.astype(float))) & (first != c))
        if len(at):
            d = squared(vectors[at], centroids[c])
            better = (d < dist[at]) | ((d == dist[at]) & (c < best[at]))
            best[at[better]], dist[at[better]] = c, d[better]
            measured[at] += 1
    return best, dist, measured


def _arrays(batch, dim: int, pivots: int):
    at = batch.schema.get_field_index
    q = batch.column(at("q")).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)
    near = batch.column(at("near")).flatten().to_numpy(zero_copy_only=False).reshape(-1, pivots) if "near" in batch.schema.names else None
    return q, near


def _lists(values: np.ndarray, kind) -> pa.Array:
    n, w = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * w, w, dtype=np.int32)), pa.array(values.ravel(), kind))


def _with_pivots(pivots: np.ndarray):
    def run(batches):
        for b in batches:
            q, _ = _arrays(b, pivots.shape[1], 0)
            if len(q):
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _lists(pivot_distances(q, pivots), pa.float64())], names=["key", "q", "near"])
    return run


def _sums(centroids: np.ndarray, pivots: np.ndarray):
    def run(batches):
        k, dim = centroids.shape
        near_c = pivot_distances(centroids, pivots)
        totals, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for b in batches:
            q, near = _arrays(b, dim, len(pivots))
            best = nearest(q, near, centroids, near_c)[0]
            for c in np.unique(best):
                at = best == c
                totals[c] += q[at].sum(axis=0)
                counts[c] += at.sum()
        c = np.flatnonzero(counts)
        if len(c):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(c, dim).astype(np.int32)), pa.array(np.tile(np.arange(dim, dtype=np.int32), len(c))),
                                              pa.array(totals[c].ravel()), pa.array(np.repeat(counts[c], dim))], names=["cluster", "component", "total", "n"])
    return run


def _assigned(centroids: np.ndarray, pivots: np.ndarray):
    def run(batches):
        near_c = pivot_distances(centroids, pivots)
        for b in batches:
            best, dist, measured = nearest(*_arrays(b, centroids.shape[1], len(pivots)), centroids, near_c)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best.astype(np.int32)), pa.array(dist), pa.array(measured)],
                                             names=["key", "cluster", "distance", "measured"])
    return run


def integers(rows: DataFrame, key: str, vector: str, dim: int, scale: int) -> DataFrame:
    """``(key, q)`` of the vectors with exactly ``dim`` components, none null or non-finite: floor(scale * x), held within +-BOUND."""
    x = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    held = lambda v: F.greatest(F.least(F.floor(v * F.lit(float(scale))), F.lit(BOUND)), F.lit(-BOUND))
    # the product is clipped before it is floored: floor of a huge double does not fit a long
    clip = lambda v: F.greatest(F.least(v, F.lit(2.0 * BOUND / scale)), F.lit(-2.0 * BOUND / scale))
    return (rows.where((F.size(x) == dim) & finite)
            .select(F.col(f"`{key}`").alias("key"), F.transform(x, lambda v: held(clip(v)).cast("int")).alias("q")))


def cluster(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", dim: int = 64, scale: int = 64, k: int = 16,
            rounds: int = 3, seed: str = "1", pivots: int = 8) -> tuple[DataFrame, np.ndarray]:
    """``((key, cluster, distance, measured), centroids)``: one row per kept vector.

    Start: the ``k`` kept vectors with the smallest sha256 of ``seed:key`` (a null key is no text), in that order; equal hashes
    (repeated keys) are ordered by their components.  With fewer kept vectors there are fewer centroids; equal start vectors stay
    centroids of their own and the smaller number wins every tie.  A round assigns all vectors and moves every centroid
    that has some to the floor of their exact mean.  Vectors that are null, of another length, or hold null or non-finite components are
    not kept.  Components beyond +-2**27 after scaling are held at that bound, as their squared distances would not fit a long.
    Repeated rows and null keys each give a row.  No kept vectors: no rows.  Other columns play no part.
    """
    spark = rows.sparkSession
    importable(spark)
    kept = integers(rows, key, vector, dim, scale)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    pool = np.array([r.q for r in kept.select("q", order.alias("h")).orderBy("h", "q").limit(max(k, POOL)).collect()], np.int64).reshape(-1, dim)
    kind = kept.schema["key"].dataType.simpleString()
    schema = f"key {kind}, cluster int, distance long, measured long"
    if not len(pool):
        return spark.createDataFrame([], schema), pool
    at = spread_pivots(pool, pivots)
    table = through_table(kept.mapInArrow(_with_pivots(at), TABLE.format(key=kind)), "laesa-table")
    centroids = pool[:k].copy()
    for _ in range(rounds):
        sums = (table.mapInArrow(_sums(centroids, at), "cluster int, component int, total long, n long").groupBy("cluster", "component")
                .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")))
        for r in sums.collect():  # k x dim rows at most
            centroids[r.cluster, r.component] = int(r.total) // r.n
    return table.mapInArrow(_assigned(centroids, at), schema), centroids


def query(embeddings: DataFrame) -> DataFrame:
    got, centroids = cluster(embeddings)
    got = through_table(got, "clusters")
    spark = got.sparkSession
    inertia = {r.cluster: int(r.s) for r in got.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    about = [(c, inertia.get(c, 0), sum(inertia.values()), hashlib.sha256(",".join(map(str, v.tolist())).encode()).hexdigest())
             for c, v in enumerate(centroids)]  # k rows
    about = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return got.join(F.broadcast(about), "cluster").select(
        F.col("key").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(k: int = 16, rounds: int = 3) -> str:
    parts = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), q) - 1 AS c, q AS m
  FROM kept QUALIFY c < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS MATERIALIZED (SELECT rid, vec_id, q, c,
  CAST(list_sum(list_transform(list_zip(q, m), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
  FROM kept, c{i} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, c) = 1)""")
        if i < rounds:
            parts.append(f"""u{i} AS (SELECT c, j, CAST(sum(q[j]) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n FROM a{i}, range(1, 65) t(j) GROUP BY c, j)""")
            parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(n.m, c{i}.m) AS m FROM c{i} LEFT JOIN
  (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS m FROM u{i} GROUP BY c) n ON n.c = c{i}.c)""")
    return f"""WITH {', '.join(parts)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} ON c{rounds}.c = a.c
"""


ORACLE = _oracle()
