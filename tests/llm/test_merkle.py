import hashlib
import zlib

import pytest

from shelfscope.llm import merkle as m

DOCS = "doc_id long, source string, lang string, n_chars long, text string, id long, tree string, place long, leaf string"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(d, s, g, n, t):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, s, g, n, t)))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def path(levels, i):
    out = []
    for lv in levels[:-1]:
        run = lv[i // 8 * 8:i // 8 * 8 + 8]
        out.append(("".join(run[:i % 8]), "".join(run[i % 8 + 1:])))
        i //= 8
    return out


def brute(rows):
    small = str.maketrans(m.CAPITALS, m.SMALL)
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0], leaf(*r), leaf(*r[:4], r[4] and r[4].translate(small))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = levels_of([x[1] for x in groups[g]])
    top = levels_of([trees[g][-1][0] for g in names])
    out = []
    for j, g in enumerate(names):
        for i, (d, lf, low) in enumerate(groups[g]):
            proof = path(trees[g], i) + path(top, j)
            at = low if d is not None and zlib.crc32(str(d).encode()) % 3 == 0 else lf
            for b, a in proof:
                at = h(b + at + a)
            out.append((d, lf, trees[g][-1][0], top[-1][0], h("".join(b + a for b, a in proof)), at, at == top[-1][0]))
    return sorted(out, key=str)


def rows_of(n, lang, start=0):
    return [(start + i, f"s{i % 3}", lang, i, f"Text Nr {i} Ü") for i in range(n)]


CASES = {
    "nulls, repeats, groups": rows_of(70, "en") + rows_of(9, "de", 1000) + rows_of(8, "", 2000) + [(7, "s", "fr", 1, "One")]
    + [(None, None, None, None, None)] * 3 + [(5, None, "en", None, None), (5, None, "en", None, None), (5, "b", "en", 2, "X" * 50000)]
    + [(-4, "s", "é", 0, ""), (2**60, "s", "v", 0, "AB")],
    "one row": [(3, "s", "en", 2, "AA")],
    "one group": rows_of(65, "en"),
    "nine groups": [r for g in range(9) for r in rows_of(g + 1, f"g{g}", 100 * g)],
}


@pytest.mark.parametrize("case", CASES)
def test_query_equals_trees_built_by_hand(spark, case):
    rows = CASES[case]
    df = spark.createDataFrame([(*r, 1, "t", 2, "l") for r in rows], DOCS).repartition(3)
    assert sorted([tuple(r) for r in m.query(df).collect()], key=str) == brute(rows)


def test_empty(spark):
    assert m.query(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("levels", [1, 2])
def test_small_leaf_partitions_need_upper_passes(spark, levels):
    """Trees of several leaf partitions and several passes give the proofs of the whole trees."""
    rows = rows_of(600, "en") + rows_of(64, "de", 1000) + [r for g in range(10) for r in rows_of(1, f"g{g}", 5000 + g)]
    df = spark.createDataFrame([(i, r[2], r[0], leaf(*r)) for i, r in enumerate(rows)], "id long, group string, key long, leaf string").repartition(5)
    got = {r.id: r for r in m.prove(df, levels).collect()}
    want = {r[0]: r for r in brute(rows)}
    assert len(got) == len(rows)
    for i, r in enumerate(rows):
        g = got[i]
        assert (g.leaf, g.subroot, g.root) == want[r[0]][1:4]
        assert h("".join(s.before + s.after for s in g.proof)) == want[r[0]][4]


@pytest.mark.parametrize("n", [513, 576, 4097])
def test_a_lone_last_node_above_its_leaf_partition(spark, n):
    """Above the last leaf partition's top a run may be one node: no sibling is fetched at that level."""
    rows = rows_of(n, "en") + rows_of(3, "de", 10000)
    df = spark.createDataFrame([(i, r[2], r[0], leaf(*r)) for i, r in enumerate(rows)], "id long, group string, key long, leaf string").repartition(5)
    got = {r.id: r for r in m.prove(df, 1).collect()}
    want = {r[0]: r for r in brute(rows)}
    assert len(got) == len(rows)
    for i, r in enumerate(rows):
        assert (got[i].leaf, got[i].subroot, got[i].root) == want[r[0]][1:4]
        assert h("".join(s.before + s.after for s in got[i].proof)) == want[r[0]][4]


def test_fold_and_octopus(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("x", [("a", "b"), ("", "c")])], "leaf string, proof array<struct<before:string,after:string>>")
    assert df.select(m.fold(F.col("leaf"), F.col("proof"))).first()[0] == h("" + h("axb") + "c")
    # leaves 0..7 of 100: their run is known, so the octopus has 7 siblings at level 1 and 1 at level 2
    assert m.octopus(range(8), 100) == [(1, i) for i in range(1, 8)] + [(2, 1)]
    assert m.octopus([0, 9], 10) == [(0, i) for i in range(1, 8)] + [(0, 8)]
    assert m.octopus([0], 1) == [] and m.octopus(range(9), 9) == []
