import hashlib
import math

import numpy as np

from shelfscope.llm import clustering as c

ROWS = "vec_id long, embedding array<float>, q int, key string, near int, cluster string"


def brute(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    cents = [list(q) for _, q in start]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(q, m)), j) for j, m in enumerate(cents)) for _, q in kept]
    for _ in range(rounds):
        got = assign()
        for j in range(len(cents)):
            mine = [q for (_, q), (_, at) in zip(kept, got) if at == j]
            if mine:
                cents[j] = [sum(x) // len(mine) for x in zip(*mine)]
    got = assign()
    total = {j: sum(d for d, at in got if at == j) for j in range(len(cents))}
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in cents]
    return sorted([(i, at, d, total[at], sum(total.values()), sha[at]) for (i, _), (d, at) in zip(kept, got)], key=str)


def run(spark, rows):
    df = spark.createDataFrame([(i, v, 1, "k", 2, "c") for i, v in rows], ROWS).repartition(3)
    return sorted([tuple(r) for r in c.query(df).collect()], key=str)


def vectors(n, seed, spread=1.0):
    r = np.random.default_rng(seed)
    base = r.normal(size=(9, 64))
    return [[float(np.float32(x)) for x in base[i % 9] + spread * r.normal(size=64)] for i in range(n)]


def test_equals_plain_k_means(spark):
    rows = list(enumerate(vectors(300, 1))) + [(1000 + i, v) for i, v in enumerate(vectors(60, 2, 0.05))]
    same = [0.5] * 64
    rows += [(2000 + i, same) for i in range(150)] + [(5, rows[5][1]), (None, same), (None, rows[7][1])]  # copies, repeated and null ids
    rows += [(3000, None), (3001, []), (3002, [1.0] * 63), (3003, [None] + [0.0] * 63), (3004, [math.nan] + [0.0] * 63), (3005, [math.inf] + [0.0] * 63)]
    assert run(spark, rows) == brute(rows)


def test_few_equal_and_no_vectors(spark):
    for rows in ([(1, [0.0] * 64), (2, [-0.01] * 64), (3, [0.0] * 64)], [(i, [1.0] * 64) for i in range(40)], [(4, [1.0] * 3)], []):
        assert run(spark, rows) == brute(rows)


def test_huge_components_are_held(spark):
    rows = [(1, [1e30] + [0.0] * 63), (2, [-1e30] + [0.0] * 63), (3, [0.0] * 64)]
    got, cents = c.cluster(spark.createDataFrame([(i, v, 1, "k", 2, "c") for i, v in rows], ROWS), rounds=0)
    assert sorted(int(m[0]) for m in cents) == [-c.BOUND, 0, c.BOUND] and {r.distance for r in got.collect()} == {0}


def test_bounds_spare_measurements_and_change_nothing():
    r = np.random.default_rng(3)
    base = r.integers(-4000, 4000, size=(16, 64))
    v = (base[r.integers(0, 16, 5000)] + r.integers(-40, 40, size=(5000, 64))).astype(np.int64)
    pivots = c.spread_pivots(v[:64], 8)
    got = c.nearest(v, c.pivot_distances(v, pivots), base, c.pivot_distances(base, pivots))
    d = ((v[:, None, :] - base[None]) ** 2).sum(axis=2)
    assert (got[0] == d.argmin(axis=1)).all() and (got[1] == d.min(axis=1)).all()
    assert got[2].mean() < 4  # of 16
