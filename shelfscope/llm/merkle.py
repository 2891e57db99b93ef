"""Operator 13, a Merkle manifest of a dataset with octopus multiproofs.

Every row is a leaf; the leaves of one group (a language) ascend by key and form a tree of runs of ``ARITY``; the groups'
subroots, ordered by group, form one more tree, whose top is the root.

Leaves get their places from one range sort (rows numbered within a sorted partition, lifted by the counts of the partitions
before), so a group that holds most rows is spread like any other.  Places are cut into leaf partitions of 4096
consecutive leaves.  A first pass hashes each leaf partition up to its top node and states the octopus: the minimal union of node
coordinates that the proofs of its leaves need and that do not follow from them.  Passes over the top nodes (each
a 4096th of the one before) give the nodes above.  The coordinates are fetched once per leaf partition, by a join; then each
leaf partition derives its shared interior nodes again and expands every leaf's own proof locally.

A proof is a list of (before, after), from the leaf up: the digests, as hex text, of the run's other nodes on either side.
``fold`` recomputes a root from a leaf and its proof with SQL functions alone, so a proof can be checked without this code.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import importable, through_table

ARITY = 8
LEVELS = 4   # levels that one task builds: a leaf partition has ARITY ** LEVELS leaves
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def width(n: int, level: int) -> int:
    """Nodes at ``level`` of a tree of ``n`` leaves."""
    return -(-n // ARITY ** level)


def height(n: int) -> int:
    h = 0
    while width(n, h) > 1:
        h += 1
    return h


def octopus(places, n: int, level: int = 0) -> list[tuple[int, int]]:
    """The minimal union of (level, index) that the proofs of the nodes at ``places`` need and that do not follow from
    these nodes: at each level the missing members of their runs."""
    have, out = set(places), []
    while width(n, level) > 1:
        runs = {p // ARITY for p in have}
        out += [(level, i) for r in sorted(runs) for i in range(r * ARITY, min(r * ARITY + ARITY, width(n, level))) if i not in have]
        have, level = runs, level + 1
    return out


def climb(known: dict[int, str], n: int, level: int, top: int) -> dict[int, dict[int, str]]:
    """Nodes by level above whole runs ``known`` at ``level``, up to ``top`` or the tree's own top."""
    out = {level: known}
    while level < top and width(n, level) > 1:
        below = out[level]
        above: dict[int, list[str]] = {}
        for i in sorted(below):
            above.setdefault(i // ARITY, []).append(below[i])
        level += 1
        out[level] = {r: digest("".join(v).encode()) for r, v in above.items()}
    return out


LEAF = "tree string, place long, n long, chunk long, leaf string"
TOPS = "tree string, chunk long, n long, level int, digest string, need array<struct<level:int,idx:long>>"


def _leaf_partition(table: pa.Table, levels: int) -> pa.Table:
    n, chunk = table["n"][0].as_py(), table["chunk"][0].as_py()
    leaves = dict(zip(table["place"].to_pylist(), table["leaf"].to_pylist()))
    nodes = climb(leaves, n, 0, levels)
    level = max(nodes)
    need = [{"level": l, "idx": i} for l, i in octopus(leaves, n)]
    return pa.table({"tree": table["tree"].slice(0, 1), "chunk": [chunk], "n": [n], "level": pa.array([level], pa.int32()),
                     "digest": [nodes[level][chunk if level == levels else 0]],
                     "need": pa.array([need], pa.list_(pa.struct([("level", pa.int32()), ("idx", pa.int64())])))})


def _upper(table: pa.Table, levels: int) -> pa.Table:
    n, base = table["n"][0].as_py(), table["level"][0].as_py()
    nodes = climb(dict(zip(table["idx"].to_pylist(), table["digest"].to_pylist())), n, base, base + levels)
    rows = [(lv, i, d) for lv, at in nodes.items() if lv > base for i, d in at.items()]
    return pa.table({"tree": pa.array([table["tree"][0].as_py()] * len(rows), pa.string()), "n": pa.array([n] * len(rows), pa.int64()),
                     "level": pa.array([r[0] for r in rows], pa.int32()), "idx": pa.array([r[1] for r in rows], pa.int64()),
                     "digest": pa.array([r[2] for r in rows], pa.string())})


def _expand(leaves: pa.Table, fetched: pa.Table, levels: int) -> pa.Table:
    """Proofs of one leaf partition: shared interiors once, then each leaf's own siblings before the shared rest."""
    got = fetched.to_pylist()[0]
    n = got["n"]
    nodes = climb(dict(zip(leaves["place"].to_pylist(), leaves["leaf"].to_pylist())), n, 0, levels)
    for x in got["fetched"] or ():
        nodes.setdefault(x["level"], {})[x["idx"]] = x["digest"]
    # above its top the partition is one path: its own top and the fetched siblings
    rests: dict[tuple[int, int], tuple[list[str], list[str]]] = {}
    tops = [[x[s] for x in got["above"] or ()] for s in ("before", "after")]

    def rest(level: int, i: int):
        if width(n, level) == 1:
            return tops
        if (level, i) not in rests:
            start = i // ARITY * ARITY
            at = nodes.get(level, {})  # a run of one node has no siblings to fetch
            side = [[at[j] for j in range(a, b)] for a, b in ((start, i), (i + 1, min(start + ARITY, width(n, level))))]
            up = rest(level + 1, i // ARITY)
            rests[level, i] = (["".join(side[0]), *up[0]], ["".join(side[1]), *up[1]])
        return rests[level, i]

    before, after, ends = [], [], [0]
    for i in leaves["place"].to_pylist():
        b, a = rest(0, i)
        before += b
        after += a
        ends.append(len(before))
        if width(n, 0) > 1:
            del rests[0, i]  # a leaf's own proof is used once
    ends = pa.array(ends, pa.int32())
    m = leaves.num_rows
    return pa.table({"id": leaves["id"], "leaf": leaves["leaf"], "before": pa.ListArray.from_arrays(ends, pa.array(before, pa.string())),
                     "after": pa.ListArray.from_arrays(ends, pa.array(after, pa.string())),
                     "subroot": pa.array([got["subroot"]] * m, pa.string()), "root": pa.array([got["root"]] * m, pa.string())})


def placed(leaves: DataFrame, order: list[str], name: str, levels: int = LEVELS) -> DataFrame:
    """``leaves`` with (place, n, chunk): the place within ``tree`` by ``order`` and the tree's number of leaves."""
    spark = leaves.sparkSession
    rows = leaves.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    rows = through_table(rows.withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33).cast("int")
    counts = rows.groupBy("tree", part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("m"))
    of = Window.partitionBy("tree")
    lift = counts.select(F.col("tree").alias("t"), F.col("part"), (F.coalesce(F.sum("m").over(
        of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("first")).alias("lift"), F.sum("m").over(of).alias("n"))
    rows = rows.withColumn("p", part).join(lift, (F.col("tree") == F.col("t")) & (F.col("p") == F.col("part")))
    place = F.col("at") + F.col("lift")
    return rows.select(*leaves.columns, place.alias("place"), "n", F.floor(place / ARITY ** levels).cast("long").alias("chunk"))


def forest(leaves: DataFrame, name: str, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """``(tops, subroots)`` of placed leaves: the top node of every leaf partition with its octopus and the fetched nodes
    (tree, chunk, n, fetched), and (tree, subroot)."""
    tops = through_table(leaves.select("tree", "place", "n", "chunk", "leaf").groupBy("tree", "chunk").applyInArrow(lambda t: _leaf_partition(t, levels), TOPS), f"{name}-tops")
    nodes = through_table(tops.select("tree", "n", "level", F.when(F.col("level") == levels, F.col("chunk")).otherwise(0).cast("long").alias("idx"), "digest"), f"{name}-nodes")
    largest, base, level = tops.agg(F.max("n")).first()[0] or 0, nodes, levels
    while width(largest, level) > 1:  # one pass for each 4096 times as many leaves
        up = (base.where((F.col("level") == level) & (F.col("n") > ARITY ** level)).groupBy("tree", F.floor(F.col("idx") / ARITY ** levels).alias("block"))
              .applyInArrow(lambda t: _upper(t, levels), "tree string, n long, level int, idx long, digest string"))
        base = through_table(up, f"{name}-nodes")
        nodes, level = nodes.union(base), level + levels
    tree_top = F.col("n") <= F.expr(f"power({ARITY}, level)")
    subroots = nodes.where(tree_top & (F.col("idx") == 0)).groupBy("tree").agg(F.min_by("digest", "level").alias("subroot"))
    # a node near the top is needed by very many leaf partitions: both sides of that join are salted there
    salts = lambda lv: F.when(lv >= 2 * levels - 1, 64).otherwise(1)
    need = tops.select("tree", "chunk", F.explode("need").alias("x")).select("tree", "chunk", F.col("x.level").alias("level"), F.col("x.idx").alias("idx"))
    need = need.withColumn("salt", F.pmod(F.col("chunk"), salts(F.col("level")).cast("long")).cast("int"))
    given = nodes.select("tree", "level", "idx", "digest", F.explode(F.sequence(F.lit(0), salts(F.col("level")) - 1)).alias("salt"))
    fetched = (need.join(given, ["tree", "level", "idx", "salt"]).groupBy("tree", "chunk")
               .agg(F.collect_list(F.struct("level", "idx", "digest")).alias("fetched")))
    return tops.select("tree", "chunk", "n").join(fetched, ["tree", "chunk"], "left"), subroots


STEP = "array<struct<before:string,after:string>>"
PROOF = "id long, leaf string, before array<string>, after array<string>, subroot string, root string"


def expand(leaves: DataFrame, partitions: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``(id, leaf, proof, subroot, root)`` of the placed leaves, given their partitions' fetched nodes, subroot, root and steps above."""
    out = (leaves.select("id", "tree", "place", "chunk", "leaf").groupBy("tree", "chunk")
           .cogroup(partitions.groupBy("tree", "chunk")).applyInArrow(lambda a, b: _expand(a, b, levels), PROOF))
    return out.select("id", "leaf", F.arrays_zip("before", "after").alias("proof"), "subroot", "root")


def prove(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``leaves(id long, group, key, leaf)`` -> id, leaf, proof, subroot, root.

    Groups are ordered null first, then by the bytes of their text; leaves by key (null first), then leaf digest, then id,
    so equal keys have a fixed order and equal rows are interchangeable.  A lone leaf is its subroot, a lone
    subroot is the root: their proofs have no steps.  An empty table gives no rows.
    """
    importable(leaves.sparkSession)
    g = F.col("group").cast("string")
    rows = leaves.select("id", F.when(g.isNull(), "n").otherwise(F.concat(F.lit("v"), g)).alias("tree"), "key", "leaf")  # 'n' < 'v...'
    rows = placed(rows, ["key", "leaf", "id"], "merkle-leaves", levels)
    parts, subroots = forest(rows, "merkle", levels)
    subroots = through_table(subroots, "merkle-subroots")
    # the groups' subroots are the leaves of the upper tree, which is built by the same steps
    upper = subroots.select(F.xxhash64("tree").alias("id"), F.lit("groups").alias("tree"), F.col("tree").alias("member"), F.col("subroot").alias("leaf"))
    upper = placed(upper, ["member"], "merkle-groups", levels)
    upper_parts, root = forest(upper, "merkle-upper", levels)
    none = F.array().cast(STEP)
    upper_parts = upper_parts.join(root, "tree").select(
        "tree", "chunk", "n", "fetched", none.alias("above"), "subroot", F.col("subroot").alias("root"))
    steps = expand(upper, upper_parts, levels).select(F.col("id").alias("u"), "proof", F.col("root"))
    above = (upper.select("member", F.col("id").alias("u"), F.col("leaf").alias("subroot")).join(steps, "u")
             .select(F.col("member").alias("tree"), F.col("proof").alias("above"), "subroot", "root"))
    return expand(rows, parts.join(above, "tree").select("tree", "chunk", "n", "fetched", "above", "subroot", "root"), levels)


def field(c: Column) -> Column:
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def query(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.  A null doc_id comes before all others and is
    never tampered with; rows that repeat a doc_id are ordered by their leaves.  Only the five named columns are read."""
    names = ("doc_id", "source", "lang", "n_chars", "text")
    small = F.translate("text", CAPITALS, SMALL)
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    hashed = docs.select(*names).select(
        F.monotonically_increasing_id().alias("id"), F.col("doc_id").alias("key"), F.col("lang").alias("group"),
        leaf_digest(*[F.col(c) for c in names]).alias("leaf"),
        F.when(chosen, leaf_digest(*[F.col(c) for c in names[:-1]], small)).alias("tampered"))
    hashed = through_table(hashed, "merkle-digests")
    got = prove(hashed.select("id", "group", "key", "leaf"))
    # tampered digests meet the proofs by row number
    got = hashed.select("id", F.col("key").alias("doc_id"), "tampered").join(got, "id")
    got = got.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return got.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def _oracle(levels: int = 8, group_levels: int = 3) -> str:
    """Trees of up to 8**levels leaves and 8**group_levels groups."""
    def f(c):
        return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    same = " || ".join(f(c) for c in ("doc_id", "source", "lang", "n_chars"))
    parts = [f"""d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce('v' || lang, 'n') AS tree, sha256({same} || {f('text')}) AS leaf,
  sha256({same} || {f(f"translate(text, '{CAPITALS}', '{SMALL}')")}) AS tampered,
  coalesce(xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 3 = 0, false) AS chosen FROM documents)""",
             "l0 AS MATERIALIZED (SELECT tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS i, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM d)",
             "spot AS MATERIALIZED (SELECT rid, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS i FROM d)"]

    def climb_sql(p: str, top: int):
        for k in range(1, top + 1):
            parts.append(f"""{p}{k} AS MATERIALIZED (SELECT tree, i, h, count(*) OVER (PARTITION BY tree) AS n FROM (
  SELECT tree, i // 8 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {p}{k - 1} WHERE n > 1 GROUP BY tree, i // 8))""")
    climb_sql("l", levels)
    parts.append("sub AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT tree, h FROM l{k} WHERE n = 1" for k in range(levels + 1)) + ")")
    parts.append("g0 AS MATERIALIZED (SELECT 'groups' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, h, count(*) OVER () AS n, tree AS member FROM sub)")
    climb_sql("g", group_levels)
    parts.append("root AS (" + " UNION ALL ".join(f"SELECT h FROM g{k} WHERE n = 1" for k in range(group_levels + 1)) + ")")
    # a leaf's proof: for each level the run's nodes on either side, and the fold of a digest through them
    col, frm = "d.doc_id, d.leaf, sub.h AS subroot, root.h AS root", "d JOIN spot USING (rid) JOIN sub ON sub.tree = d.tree JOIN g0 ON g0.member = d.tree CROSS JOIN root"
    node, proof = "CASE WHEN chosen AND tampered IS NOT NULL THEN tampered ELSE d.leaf END", []
    steps = [("l", k, "d.tree", f"(spot.i // {8 ** k})") for k in range(levels)] + [("g", k, "'groups'", f"(g0.i // {8 ** k})") for k in range(group_levels)]
    runs = []
    for p, k, tree, i in steps:
        s = f"{p}s{k}"
        runs.append(f"""{s} AS MATERIALIZED (SELECT tree, i, coalesce(string_agg(h, '') OVER (PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
  coalesce(string_agg(h, '') OVER (PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a FROM {p}{k} WHERE n > 1)""")
        frm += f" LEFT JOIN {s} ON {s}.tree = {tree} AND {s}.i = {i}"
        proof.append(f"coalesce({s}.b || {s}.a, '')")
    folds = [f"f0 AS (SELECT {col}, sha256({' || '.join(proof)}) AS proof_sha256, {node} AS x, " +
             ", ".join(f"{p}s{k}.b AS {p}b{k}, {p}s{k}.a AS {p}a{k}" for p, k, _, _ in steps) + f" FROM {frm})"]
    for j, (p, k, _, _) in enumerate(steps):
        folds.append(f"f{j + 1} AS (SELECT * REPLACE (CASE WHEN {p}b{k} IS NULL THEN x ELSE sha256({p}b{k} || x || {p}a{k}) END AS x) FROM f{j})")
    return f"""WITH {', '.join([*parts, *runs, *folds])}
SELECT doc_id, leaf, subroot, root, proof_sha256, x AS folded_root, x = root AS verified FROM f{len(steps)}
"""


ORACLE = _oracle()
