"""Operator 3, sharding: a hierarchical weighted hash tree.

A tree of regions, racks and shards; a node weighs the sum of its shards.  At
every node a key draws one child: each child has the clock
``-ln(u) / weight`` with ``u`` a hash of (child, key), the smallest wins.  A
changed weight only changes that child's clock, so rows move into or out of
that subtree alone.  ``grow`` opens a region of its own for a new shard, so
one more shard takes rows only into itself and no other row moves.

The descent is one expression without a shuffle.  Slots (gapless numbers within
a shard) need no group: rows are numbered within (scan partition, shard) as
they stream by, and the numbers are lifted by the counts of the partitions
before; those counts are one row per partition and shard.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import importable, through_table


@dataclass(frozen=True)
class Node:
    name: str
    children: tuple["Node", ...] = ()
    shard: int = -1      # leaves
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def tree(shards: int = 24, racks: int = 2, per_rack: int = 4) -> Node:
    """Regions of ``racks`` x ``per_rack`` equal shards, numbered from 0; the last ones may be smaller."""
    leaves = [Node(f"shard{i}", shard=i) for i in range(shards)]
    rack = [Node(f"rack{i}", tuple(leaves[i:i + per_rack])) for i in range(0, shards, per_rack)]
    return Node("root", tuple(Node(f"region{i}", tuple(rack[i:i + racks])) for i in range(0, len(rack), racks)))


def grow(root: Node, weight: float = 1.0) -> Node:
    """One more shard, in a region of its own."""
    n = 1 + max(_shards(root))
    leaf = Node(f"shard{n}", shard=n, own_weight=weight)
    return Node(root.name, (*root.children, Node(f"grown-region{n}", (Node(f"grown-rack{n}", (leaf,)),))))


def _shards(node: Node) -> list[int]:
    return [s for c in node.children for s in _shards(c)] if node.children else [node.shard]


def _levels(root: Node) -> list[list[list[tuple[str, float, int]]]]:
    """For each level and each node there: its children's names, weights and places in
    the next level.  A leaf above the last level goes on as its own only child."""
    out, level = [], [root]
    while any(n.children for n in level):
        below: list[Node] = []
        table = []
        for n in level:
            kids = [c for c in n.children if c.weight > 0] or [n]
            table.append([(c.name, c.weight, len(below) + i) for i, c in enumerate(kids)])
            below += kids
        out.append(table)
        level = below
    return out + [[[(n.name, 1.0, n.shard)] for n in level]]


def draw(root: Node, key: Column) -> Column:
    """The shard that ``key`` descends to.  Null keys are one key."""
    at = F.lit(0)
    for table in _levels(root):
        kids = F.array(*[F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("w"), F.lit(i).alias("i"))
                                   for n, w, i in node]) for node in table])
        at = F.array_min(F.transform(F.element_at(kids, at + 1), lambda c: F.struct(_clock(c["name"], c["w"], key), c["i"].alias("i"))))["i"]
    return at


def _clock(name: Column, weight: Column, key: Column) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(name, key), 12)  # 52 bits: exact as a double
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 52))) / weight


def _number(batches):
    """Numbers rows within (this partition, shard) in stream order."""
    import pyarrow as pa
    seen: dict[int, int] = {}
    for batch in batches:
        shard = batch.column(batch.schema.get_field_index("shard")).to_numpy(zero_copy_only=False)
        local = np.zeros(len(shard), dtype=np.int64)
        for s in np.unique(shard):
            at = np.flatnonzero(shard == s)
            local[at] = seen.get(int(s), 0) + np.arange(len(at))
            seen[int(s)] = seen.get(int(s), 0) + len(at)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local)], names=[*batch.schema.names, "local"])


def shard_rows(docs: DataFrame, root: Node, grown: Node | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, size, text_crc32, law, shard, slot, grown_shard.

    Size is the text's UTF-8 bytes (null: none) plus 8; a null text's crc32 is
    that of no bytes, 0.  Law ``key``: the key and the tree decide.  Null keys are one key.  Repeated
    keys share a shard and get slots of their own; equal rows stay apart rows.
    An empty table gives no rows; other columns of ``docs`` play no part.
    """
    importable(docs.sparkSession)
    k = F.col(f"`{key}`")
    t = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    rows = docs.select(k.alias(key), (F.octet_length(t) + 8).cast("long").alias("size"), F.crc32(t).alias("text_crc32"),
                       draw(root, k).cast("int").alias("shard"),
                       (draw(grown, k) if grown else F.lit(None)).cast("int").alias("grown_shard"),
                       F.spark_partition_id().alias("part"))
    # written once, so that counts and numbers see the same partitions
    rows = through_table(rows.mapInArrow(_number, _numbered(rows)), "shard-rows")
    counts = rows.groupBy("part", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    lift = counts.select("part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lift"))
    return rows.join(lift, ["part", "shard"]).select(
        key, "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("local") + F.col("lift")).cast("long").alias("slot"), "grown_shard")


def _numbered(rows: DataFrame):
    from pyspark.sql import types as T
    return T.StructType([*rows.schema.fields, T.StructField("local", T.LongType())])


def query(docs: DataFrame) -> DataFrame:
    root = tree()
    return shard_rows(docs, root, grow(root))
