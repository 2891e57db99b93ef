"""Connected components of a link table, by alternating large and small stars.

Every round is two joins and two aggregates over the links; nothing is
collected.  A hot node's links are combined map-side where its smallest
neighbour is found, and the join that hands that value to its neighbours is an
equi-join which Spark can split when skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import through_table


def _smallest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_smallest(both), "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _smallest(down)
    return (down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def _state(links: DataFrame):
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``links(u, v)`` of any orderable type -> ``(node, root)`` with one row for
    each node that has a link to another node; root is the component's smallest
    node.  Nulls, loops and repeated links are ignored; no links: no rows."""
    links = links.select("u", "v").where("u <> v").distinct()
    links = through_table(links, "links")
    state = _state(links)
    for _ in range(rounds):
        if not state[0]:
            break
        links = through_table(_small_star(_large_star(links)), "links")
        new = _state(links)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("components did not settle")
    # settled: every node points at its component's smallest node
    return (links.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(links.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
