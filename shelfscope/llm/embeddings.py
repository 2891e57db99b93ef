"""Operator 10, embedding near-dedup: a subspace pigeonhole join.

Unit vectors with cosine >= t have a squared distance of at most D = 2 - 2t.
A fixed random rotation spreads that distance evenly; the rotated vector is cut
into four blocks.  If every block's part exceeded its share of D (in proportion
to its dimensions), the whole would exceed D: so each linked pair lies within
the share in some block.  Each block is range-joined under its share, and every
candidate is verified on the whole vectors in double precision.

Range join of a block: its first coordinate is cut into bins as wide as the
share's root, so partners are in the same or the next bin.  A bin's vectors are
dealt into tiles of bounded size (counts are measured first), and every pair of
tiles of equal or neighbouring bins is one small task: a matrix product over
the block's dimensions finds what is within the share.  A pair found in several
blocks counts only in the first of them, which both sides can tell, so the
union of the candidates needs no pair to be shuffled.  Tasks give, for each
vector, its number of partners and one link per merge of a union-find.

Copies are joined before: one row per distinct vector, with its count.

Only vectors of one length can be near, so every length has its own rotation,
shares, blocks and bins; all lengths go through the same join.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import importable, through_table
from .components import connected_components

BLOCKS = 4
TILE = 16384         # vectors in a tile, on average
ROWS = 256           # rows of a tile compared with the other tile at once
SLACK = 1e-9         # rounding of the rotation and the sums
SEED = 20240101


@lru_cache(4)
def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.RandomState(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def block_edges(dim: int) -> list[int]:
    n = min(BLOCKS, dim)
    return [dim * i // n for i in range(n + 1)]


def _shares(dim: int, threshold: float) -> np.ndarray:
    e = block_edges(dim)
    return (2 - 2 * threshold) * np.diff(e) / dim + SLACK


def _unit(vecs) -> np.ndarray:
    x = np.asarray(vecs, dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _tiles(threshold: float):
    """Every vector -> one row for each block: its length, its bin there and its bytes."""
    def run(batches):
        for batch in batches:
            for dim, pdf in batch.groupby(batch["vec"].map(len)):
                dim = int(dim)
                turn, edges, shares = rotation(dim), block_edges(dim), _shares(dim, threshold)
                x = np.stack(pdf["vec"].to_numpy())
                turned = _unit(x) @ turn
                raw = [r.tobytes() for r in x]
                for b in range(len(shares)):
                    bins = np.floor(turned[:, edges[b]] / (np.sqrt(shares[b]) * 1.0001)).astype(np.int32)
                    yield pd.DataFrame({"dim": np.int32(dim), "block": np.int32(b), "bin": bins, "k": pdf["k"].to_numpy(),
                                        "n": pdf["n"].to_numpy(), "raw": raw})
    return run


def _pairs(threshold: float, kind: str):
    def root(up: dict, x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        dim, block, (one, other) = int(key[0]), int(key[1]), key[2].split(":")
        turn, edges, shares = rotation(dim), block_edges(dim), _shares(dim, threshold)
        same = one == other
        left = rows[rows["side"] == 0]
        right = left if same else rows[rows["side"] == 1]
        if not len(left) or not len(right):
            return pd.DataFrame(columns=["k", "links", "root"])
        lu, ru = (_unit(np.frombuffer(b"".join(x["raw"]), kind).reshape(-1, dim)) for x in (left, right))
        lt, rt = lu @ turn, ru @ turn
        a, b = edges[block], edges[block + 1]
        lb, rb = (x[:, a:b].astype(np.float32) for x in (lt, rt))
        rn = (rb * rb).sum(axis=1)
        lk, rk = left["k"].to_numpy(), right["k"].to_numpy()
        ln, rn_ = left["n"].to_numpy(), right["n"].to_numpy()
        lc, rc = np.zeros(len(lk), np.int64), np.zeros(len(rk), np.int64)
        up: dict = {}
        for lo in range(0, len(lk), ROWS):
            x = lb[lo:lo + ROWS]
            near = (x * x).sum(axis=1)[:, None] + rn[None, :] - 2 * (x @ rb.T) <= np.float32(shares[block] + 1e-4)
            i, j = np.nonzero(near)
            i += lo
            if same:
                i, j = i[i < j], j[i < j]
            for at in range(0, len(i), 1 << 15):
                p, q = i[at:at + (1 << 15)], j[at:at + (1 << 15)]
                ok = np.einsum("ij,ij->i", lu[p], ru[q]) >= threshold
                p, q = p[ok], q[ok]
                if not len(p):
                    continue
                gap = (lt[p] - rt[q]) ** 2
                part = np.add.reduceat(gap, edges[:-1], axis=1) <= shares
                first = part.argmax(axis=1) == block  # counts in the first block within its share
                p, q = p[first], q[first]
                np.add.at(lc, p, rn_[q])
                np.add.at(rc, q, ln[p])
                for s, t in zip(lk[p], rk[q]):
                    s, t = root(up, s), root(up, t)
                    if s != t:
                        up[max(s, t)] = min(s, t)
        out = [(k, int(c), root(up, k)) for k, c in zip(lk, lc) if c] + [(k, int(c), root(up, k)) for k, c in zip(rk, rc) if c]
        return pd.DataFrame(out, columns=["k", "links", "root"])
    return run


def _floats(rows: DataFrame, vec: str):
    """Floats stay floats (half the bytes); every other kind becomes double."""
    kind = dict(rows.dtypes)[vec]
    return F.col(f"`{vec}`") if kind == "array<float>" else F.col(f"`{vec}`").cast("array<double>")


def usable(vec):
    """Vectors of finite components, not all zero."""
    v = F.col(vec)
    return F.forall(v, lambda x: x.isNotNull() & (F.abs(x) <= F.lit(1.7976931348623157e308)) & ~F.isnan(x)) & F.exists(v, lambda x: x != 0)


def near_links(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Distinct vectors (k string, vec array<float or double>, n) -> per vector with partners: k, links (partners, counted n times), root (a link)."""
    spark = vectors.sparkSession
    importable(spark)
    kind = "float32" if dict(vectors.dtypes)["vec"] == "array<float>" else "float64"
    placed = through_table(vectors.mapInPandas(_tiles(threshold), "dim int, block int, bin int, k string, n long, raw binary"), "tiles")
    # tiles of each bin: one row per bin; the unit cube has 2 / root(share) bins a block
    counts = placed.groupBy("dim", "block", "bin").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    grid = through_table(counts, "tile-grid")
    near = (grid.select("dim", "block", "bin", "tiles", F.explode(F.array(F.col("bin"), F.col("bin") + 1)).alias("to"))
            .join(grid.select("dim", "block", F.col("bin").alias("to"), F.col("tiles").alias("to_tiles")), ["dim", "block", "to"])
            .select("dim", "block", "bin", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("t"), "to", "to_tiles")
            .select("dim", "block", "bin", "t", "to", F.explode(F.sequence(F.lit(0), F.col("to_tiles") - 1)).alias("to_t"))
            .where("to > bin or to_t >= t")
            .withColumn("pair", F.format_string("%d.%d:%d.%d", "bin", "t", "to", "to_t")))
    dealt = placed.join(grid, ["dim", "block", "bin"]).withColumn("t", F.expr("pmod(xxhash64(k), tiles)").cast("int")).drop("tiles")
    near = through_table(near, "tile-pairs")
    sides = (near.select("dim", "block", "bin", "t", "pair", F.lit(0).alias("side"))
             .union(near.where("not (bin = to and t = to_t)").select("dim", "block", "to", "to_t", "pair", F.lit(1))))
    return (dealt.join(sides, ["dim", "block", "bin", "t"])
            .select(*[F.col(c).alias(c) for c in ("dim", "block", "pair", "side", "k", "n", "raw")])
            .groupBy("dim", "block", "pair").applyInPandas(_pairs(threshold, kind), "k string, links long, root string"))


def embedding_groups(rows: DataFrame, threshold: float = 0.9, key: str = "vec_id", vec: str = "embedding",
                     dim: int | None = None) -> DataFrame:
    """One row per row of ``rows``: key, n_links, component_id, kept.

    Vectors link at cosine >= ``threshold`` (0 to 1) in double precision.
    n_links counts the other rows linked directly, copies included.  Null,
    empty, zero vectors and vectors with null, NaN or infinite components link with
    nothing and are components of their own; so are, if ``dim`` is given, vectors of another length.
    Vectors of unequal length never link; those of equal length are compared whatever it is.  component_id is the smallest key reachable; null keys
    are no candidates (a component of null keys only has a null id, and a row with a null key is kept
    only then).  Repeated keys stay apart rows.  Extra columns play no part; an empty table gives no rows.
    """
    spark = rows.sparkSession
    importable(spark)
    base = through_table(rows.select(F.col(f"`{key}`").alias("id"), _floats(rows, vec).alias("v"))
                         .withColumn("row", F.monotonically_increasing_id()), "vectors")
    good = usable("v") if dim is None else usable("v") & (F.size("v") == dim)
    k = F.when(good, F.concat(F.hex(F.xxhash64(F.lit(1), "v")), F.lit("-"), F.hex(F.xxhash64(F.lit(2), "v"))))
    keyed = through_table(base.select("id", "row", k.alias("k"), F.when(good, F.col("v")).alias("v")), "vectors")
    distinct = through_table(keyed.where("k is not null").groupBy("k").agg(
        F.first("v").alias("vec"), F.count("*").alias("n"), F.min("id").alias("low")), "vectors")
    links = through_table(near_links(distinct.select("k", "vec", "n"), threshold), "links")
    totals = links.groupBy("k").agg(F.sum("links").alias("links"))
    roots = connected_components(links.select(F.col("k").alias("u"), F.col("root").alias("v")))
    info = (distinct.select("k", "n", "low").join(totals, "k", "left")
            .join(roots, F.col("k") == F.col("node"), "left")
            .select("k", "low", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "k").alias("root")))
    ids = info.groupBy("root").agg(F.min("low").alias("component_id"))
    info = info.join(ids, "root").select("k", "n_links", "component_id")
    linked = keyed.where("k is not null").select("id", "k").join(info, "k").select("id", "n_links", "component_id")
    alone = keyed.where("k is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).select(F.col("id").alias(key), "n_links", F.col("component_id"),
                                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def query(rows: DataFrame) -> DataFrame:
    return embedding_groups(rows).withColumn("component_id", F.col("component_id").cast("long"))
