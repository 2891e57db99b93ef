import math

import numpy as np

from shelfscope.llm import embeddings as e

ROWS = "vec_id long, embedding array<{}>, label int, k string, n int, row int, low string"


def brute(rows, dim, t=0.9):
    vec = [(i, None if v is None or len(v) != dim or any(x is None or not math.isfinite(x) for x in v) or not any(v)
            else np.array(v, float) / np.linalg.norm(v)) for i, v in rows]
    near = [[j for j, (_, w) in enumerate(vec) if j != a and v is not None and w is not None and v @ w >= t] for a, (_, v) in enumerate(vec)]
    label = [None] * len(vec)
    for a in range(len(vec)):
        if label[a] is None:
            stack, seen = [a], {a}
            while stack:
                for b in near[stack.pop()]:
                    if b not in seen:
                        seen.add(b)
                        stack.append(b)
            low = min((vec[x][0] for x in seen if vec[x][0] is not None), default=None)
            for x in seen:
                label[x] = low
    return sorted((str(i), len(n), str(c), i == c) for (i, _), n, c in zip(vec, near, label))


def run(spark, rows, kind="float"):
    df = spark.createDataFrame([(i, v, 1, "k", 2, 3, "l") for i, v in rows], ROWS.format(kind))
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in e.query(df).collect())


def clusters(dim, seed):
    rs = np.random.RandomState(seed)
    rows = []
    for c in range(12):
        mid = rs.normal(size=dim)
        mid /= np.linalg.norm(mid)
        for _ in range(rs.randint(1, 14)):
            v = mid + rs.normal(size=dim) * rs.choice([0.01, 0.2, 0.33, 0.4]) / math.sqrt(dim)
            rows.append([float(x) for x in np.float32(v * rs.choice([1, 3, 1e-3]))])
    return rows


def test_clusters_match_brute_force(spark, monkeypatch):
    rows = list(enumerate(clusters(16, 1)))
    rows += [(500 + i, rows[i][1]) for i in range(6)] + [(600, [2 * x for x in rows[0][1]])]  # copies, and one scaled
    assert run(spark, rows) == brute(rows, 16)
    monkeypatch.setattr(e, "TILE", 7)   # many tiles to a bin
    monkeypatch.setattr(e, "ROWS", 3)
    assert run(spark, rows) == brute(rows, 16)


def test_every_length_is_compared_with_its_own(spark, monkeypatch):
    short, middle, long = ([(at + i, v) for i, v in enumerate(clusters(dim, dim))] for at, dim in ((0, 3), (1000, 8), (2000, 16)))
    short, middle = short + [(900, short[0][1]), (901, short[0][1])], middle[:20] + [(1900, middle[0][1])]
    want = sorted(brute(short, 3) + brute(middle, 8) + brute(long, 16))
    assert all(any(n for _, n, *_ in brute(rows, dim)) for rows, dim in ((short, 3), (middle, 8), (long, 16)))
    assert run(spark, middle + short + long) == want
    monkeypatch.setattr(e, "TILE", 7)
    assert run(spark, short + long + middle, "double") == want
    ones = [(1, [2.0]), (2, [3.0]), (3, [2.0, 0.0]), (4, [2.0, 0.0, 0.0]), (5, [1.0, 0.0, 0.0])]
    assert [r[1] for r in run(spark, ones)] == [1, 1, 0, 1, 1]


def test_unusable_vectors_and_doubles(spark):
    good = clusters(5, 2)
    nan, inf = float("nan"), float("inf")
    rows = list(enumerate(good)) + [(700, None), (701, []), (702, [0.0] * 5), (703, [nan] * 5), (704, [inf, 1., 1., 1., 1.]), (705, [1.0, None, 1., 1., 1.]),
                                    (706, [1.0]), (None, good[0]), (None, None), (3, good[3]), (3, good[3])]
    assert run(spark, rows, "double") == brute(rows, 5)


def test_empty_and_tiny(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [("1", 0, "1", True)]
    rows = [(2, [1.0]), (1, [5.0]), (3, [-1.0])]  # one dimension: one block
    assert run(spark, rows) == brute(rows, 1)


def test_rotation_keeps_distances():
    q = e.rotation(64)
    assert np.allclose(q @ q.T, np.eye(64)) and e.block_edges(64) == [0, 16, 32, 48, 64] and e.block_edges(3) == [0, 1, 2, 3]
