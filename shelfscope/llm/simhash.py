"""Operator 4, SimHash near-dedup by meet-in-the-middle ball hashing.

Fingerprints a, b that differ in at most 3 bits meet halfway.  Cut the 64 bits
into four blocks of 16: whichever bits differ, one block holds at least one of
them when three differ, so outside that block at most two differ, and flipping
at most one bit on each side (half the radius) gives both the same 48 bits.
Every distinct fingerprint therefore emits, for each block left out, its other
48 bits and their 48 one-bit variants: 196 variants, whatever the data; the
full balls of radius two would be 2,081.  Fingerprints that share a variant
collide; every collision is verified on all 64 bits.  48-bit variants keep
chance collisions rare at any size that 64-bit fingerprints make sense for.

Shape: fingerprints in Arrow batches -> one row per distinct fingerprint
(combined map-side, so copies never meet) -> variants, packed and shuffled on
the variant -> per partition a sorted scan which verifies collisions and keeps
one link for each merge of a union-find (a spanning forest, never all pairs) ->
connected components -> join back.  A bucket cannot hold more than
49 x 65,536 fingerprints; within a bucket comparisons run in bounded tiles.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, importable, partitions, through_table
from .components import connected_components

SEED = 42
BITS, BLOCK = 64, 16
CHUNK = 1 << 18   # shingles hashed before their bits are counted: bounds memory for any text length
TILE = 2048       # fingerprints of a bucket compared at once


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """A-Z lower-cased; words are runs without ASCII white space; a bit is set
    if over half of the shingles' XXH64 (seed 42, UTF-8) have it.  Fewer words
    than a shingle: the whole sequence is one; no words, empty or null: 0."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        return int(xxhash.xxh64_intdigest(flat, SEED))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    n = len(starts)
    for i in range(0, n, CHUNK):
        total += _bit_counts(np.array([digest(flat[a:b], SEED) for a, b in zip(starts[i:i + CHUNK], stops[i:i + CHUNK])],
                                      dtype=np.uint64))
    return int(np.packbits(total * 2 > n, bitorder="little").view(np.uint64)[0])


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def with_fingerprint(docs: DataFrame, shingle: int = 3, text: str = "text", name: str = "fp") -> DataFrame:
    """Adds the fingerprint as a signed long."""
    importable(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([_signed(fingerprint(t, shingle)) for t in texts], dtype="int64")

    return docs.withColumn(name, fp(F.col(f"`{text}`")))


def _variants(batches):
    """(variant, rest) for every distinct fingerprint: the variant has the left-out
    block's bits at zero; rest holds those 16 bits, the flipped bit's number (0:
    none) and the block, so that the two give the fingerprint back."""
    import pyarrow as pa
    flips = []
    for b in range(BITS // BLOCK):
        out = [i for i in range(BITS) if i // BLOCK != b]
        flips.append((np.uint64((1 << 64) - 1) ^ np.uint64(0xFFFF << (16 * b)), np.uint64(16 * b),
                      np.array([0] + [1 << i for i in out], dtype=np.uint64),
                      (np.array([0] + [i + 1 for i in out], dtype=np.uint32) << np.uint32(16)) | np.uint32(b << 23)))
    for batch in batches:
        fps = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
        for lo in range(0, len(fps), 4096):
            f = fps[lo:lo + 4096]
            for mask, shift, flip, code in flips:
                keys = ((f & mask)[:, None] ^ flip[None, :]).ravel()
                left = ((f >> shift) & np.uint64(0xFFFF)).astype(np.uint32)
                rest = (left[:, None] | code[None, :]).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(rest.view(np.int32))], names=["key", "rest"])


def _fingerprints(key: np.ndarray, rest: np.ndarray) -> np.ndarray:
    key, rest = key.view(np.uint64), rest.view(np.uint32).astype(np.uint64)
    bit = (rest >> np.uint64(16)) & np.uint64(0x7F)
    flip = np.where(bit > 0, np.uint64(1) << ((bit - np.uint64(1)) & np.uint64(63)), np.uint64(0))
    return (key ^ flip) | ((rest & np.uint64(0xFFFF)) << ((rest >> np.uint64(23)) * np.uint64(16)))


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


class _Forest:
    """Union-find over the fingerprints of one partition that have links."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (p := up.setdefault(x, x)) != x:
            up[x] = up[p]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _links(radius: int):
    def run(batches):
        """Rows come sorted by key (chance collisions between blocks are
        verified like any other).  Yields (fingerprint, root) of the
        forest that the verified collisions of this partition span."""
        import pyarrow as pa
        forest = _Forest()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def pairs(group: np.ndarray) -> None:
            group = np.unique(group)
            for i in range(0, len(group), TILE):
                for j in range(i, len(group), TILE):
                    x, y = group[i:i + TILE], group[j:j + TILE]
                    for lo in range(0, len(x), 128):
                        near = _popcount(x[lo:lo + 128, None] ^ y[None, :]) <= radius
                        for a, b in zip(*np.nonzero(near)):
                            if x[lo + a] != y[b]:
                                forest.join(int(x[lo + a]), int(y[b]))

        def work(key, fp):
            new = np.flatnonzero(key[1:] != key[:-1]) + 1
            starts = np.concatenate(([0], new))
            sizes = np.diff(np.concatenate((starts, [len(key)])))
            two = starts[sizes == 2]
            ok = _popcount(fp[two] ^ fp[two + 1]) <= radius
            for a, b in zip(fp[two[ok]].tolist(), fp[two[ok] + 1].tolist()):
                if a != b:
                    forest.join(a, b)
            for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                pairs(fp[s:s + n])

        for batch in batches:
            key, rest = (batch.column(i).to_numpy() for i in range(2))
            if not len(key):
                continue
            fp = _fingerprints(key, rest)
            if held:
                key, fp = (np.concatenate(x) for x in zip(*held, (key, fp)))
                held = []
            # the last bucket may go on in the next batch
            last = np.flatnonzero(key != key[-1])
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                work(key[:cut], fp[:cut])
            held = [(key[cut:], fp[cut:])]
        if held:
            work(*held[0])
        nodes = np.array(list(forest.up), dtype=np.uint64)
        roots = np.array([forest.root(int(x)) for x in nodes], dtype=np.uint64)
        keep = nodes != roots
        yield pa.RecordBatch.from_arrays([pa.array(nodes[keep].view(np.int64)), pa.array(roots[keep].view(np.int64))],
                                         names=["u", "v"])
    return run


def fingerprint_links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Distinct fingerprints ``fp`` -> links (u, v) that span the same components as all pairs within ``radius``."""
    if not 0 <= radius <= 3:
        raise ValueError("four blocks and one flip a side cover at most 3 differing bits")
    importable(fps.sparkSession)
    # 196 rows come of each: spread them evenly first
    variants = fps.select("fp").repartition(partitions(fps.sparkSession)).mapInArrow(_variants, "key long, rest int")
    return (variants.repartition("key").sortWithinPartitions("key")
            .mapInArrow(_links(radius), "u long, v long"))


def components_of(fps: DataFrame, radius: int) -> DataFrame:
    """Distinct ``fp`` -> (fp, root), one row each; root names the component."""
    roots = connected_components(fingerprint_links(fps, radius))
    return fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, fp (signed long), component_id.

    component_id is the smallest key among all rows whose fingerprints are
    reachable over links of at most ``radius`` bits, the row itself included.
    Null, empty and wordless texts have fingerprint 0 and link like any other.
    Repeated keys stay apart rows; null keys are no candidates for the smallest
    (a component of null keys only has a null id).  Extra columns play no part;
    an empty table gives no rows.
    """
    rows = through_table(with_fingerprint(docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")), shingle, "t")
                         .select("k", "fp"), "simhash")
    distinct = rows.groupBy("fp").agg(F.min("k").alias("low"))
    own = distinct.join(components_of(distinct.select("fp"), radius), "fp")
    ids = own.groupBy("root").agg(F.min("low").alias("component_id"))
    named = own.join(ids, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(F.col("k").alias(key), "fp", "component_id")


def query(docs: DataFrame) -> DataFrame:
    g = simhash_groups(docs)
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, radius: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with exactly one row of each group: the one with the smallest key
    (null keys last; of equal keys the first in the table).  Columns are kept."""
    fp, row = fresh(docs, "_simhash_fp"), fresh(docs, "_simhash_row")
    rows = through_table(with_fingerprint(docs, shingle, text, fp).withColumn(row, F.monotonically_increasing_id()), "simhash")
    first = F.min(F.struct(F.col(f"`{key}`").isNull().alias("none"), F.col(f"`{key}`").alias("k"), F.col(row).alias("row")))
    per_fp = rows.groupBy(F.col(fp).alias("fp")).agg(first.alias("first"))
    roots = components_of(per_fp.select("fp"), radius)
    stay = per_fp.join(roots, "fp").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return rows.join(stay, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
