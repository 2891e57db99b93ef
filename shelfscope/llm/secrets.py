"""Operator 11, secret scans: corpus-wide ownership frequency.

Native: DataFrame functions only.  Candidates are found in the whole text of every row: three base kinds (a named
assignment, an access key, a hex run) and ``bare`` tokens (long runs of token characters that look random and lie in
no base span).  Of a candidate's value only the hash goes on.  Hashes are counted over the corpus by distinct
repositories and distinct owners: a value that many owners hold is a widely copied example, a live-looking value that
one owner holds is taken for a real credential.  Base spans are always reported, with that verdict; a bare token is
reported only if its verdict is live, so it is the corpus, not the shape alone, that adds a span.

Positions come from the lengths of matches and of the texts between them, summed up in a window over the row's own
candidates, so no text is shuffled.  Counting is combined map-side by (hash, owner, repository) first; the verdicts
meet the candidates on (hash, salt), so a value that a third of all rows hold is spread over ``SALTS`` tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import through_table

# fixed values: the patterns of the base kinds and the least lengths of what they must hold
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"   # runs are taken whole, so a longer least run drops the same matches
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
BARE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
KINDS = ("assign", "access", "hex", "bare")
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|your|xxxx|test|1234|abcd"
SALTS = 16


@dataclass(frozen=True)
class Owners:
    """``wide``: a value that so many owners hold is an example; ``live``: one that at most so many hold may be live."""
    wide: int = 3
    live: int = 1


def looks_live(value: Column) -> Column:
    """Eight or more characters, eight or more different ones, a digit and a letter, no placeholder word."""
    return ((F.length(value) >= 8) & (F.size(F.array_distinct(F.split(value, ""))) >= 8)
            & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(PLACEHOLDER))


def looks_random(value: Column) -> Column:
    """A bare token has no name before it, so it must show more: small and capital letters, digits, twelve different ones."""
    return (looks_live(value) & value.rlike("[a-z]") & value.rlike("[A-Z]")
            & (F.size(F.array_distinct(F.split(value, ""))) >= 12) & (F.size(F.regexp_extract_all(value, F.lit("[0-9]"), 0)) >= 3))


def _found(kind: int, text: Column, matches: Column, pattern: str) -> Column:
    """Array of (kind, gap before, length, counts, looks, hash), in page order.  Matches that fail stay: they take up room."""
    def one(match: Column, piece: Column) -> Column:
        value = F.regexp_extract(match, ASSIGN, 2) if kind == 0 else match
        good = F.length(value) >= ASSIGN_LEAST if kind == 0 else looks_random(value) if kind == 3 else F.lit(True)
        return F.struct(F.lit(kind).alias("kind"), F.length(piece).cast("long").alias("gap"),
                        F.length(match).cast("long").alias("n"), good.alias("good"), looks_live(value).alias("looks"),
                        F.sha2(value, 256).alias("hash"))
    pieces = F.slice(F.split(text, pattern, -1), 1, F.size(matches))  # one more piece than matches
    return F.when(F.size(matches) > 0, F.zip_with(matches, pieces, one))


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source",
               repo: str = "source") -> tuple[DataFrame, DataFrame]:
    """``(rows, spans)``: one row per row of ``docs`` (row, key), and its candidates (row, key, owner, repo, kind, start,
    end, looks, hash), positions in code points, end exclusive.  Both come from one pass over the texts, written to the
    shared folder; ``row`` is a number of its own, so repeated and null keys stay apart rows."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    patterns = (ASSIGN, ACCESS, HEX, BARE)
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("key"),
                       F.col(f"`{owner}`").alias("owner"), F.col(f"`{repo}`").alias("repo"), t.alias("text"),
                       *[F.regexp_extract_all(t, F.lit(p), 0).alias(f"m{i}") for i, p in enumerate(patterns)])
    base = base.select("row", "key", "owner", "repo",
                       *[_found(i, F.col("text"), F.col(f"m{i}"), p).alias(f"f{i}") for i, p in enumerate(patterns)])
    base = through_table(base, "secret-rows")

    of_row = Window.partitionBy("row")
    so_far = of_row.partitionBy("row", "kind").orderBy("place")
    all_found = F.flatten(F.array_compact(F.array("f0", "f1", "f2", "f3")))
    hits = (base.where("f0 IS NOT NULL OR f1 IS NOT NULL OR f2 IS NOT NULL OR f3 IS NOT NULL")
            .select("row", "key", "owner", "repo", F.posexplode(all_found).alias("place", "c"))
            .select("row", "key", "owner", "repo", "place", "c.*")
            .repartition("row")  # serves both windows below
            .withColumn("end", F.sum(F.col("gap") + F.col("n")).over(so_far))
            .withColumn("start", F.col("end") - F.col("n")).where("good"))
    # a bare token that touches a base span is that span's value: keep the base span alone
    before = of_row.orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    after = of_row.orderBy("start").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    hits = (hits.withColumn("reach", F.max(F.when(F.col("kind") < 3, F.col("end"))).over(before))
            .withColumn("next", F.min(F.when(F.col("kind") < 3, F.col("start"))).over(after))
            .where("kind < 3 OR (coalesce(reach, 0) <= start AND (next IS NULL OR next >= end))"))
    spans = through_table(hits.select("row", "key", "owner", "repo", "kind", "start", "end", "looks", "hash"), "secret-spans")
    return base.select("row", "key"), spans


def ownership(spans: DataFrame, owners: Owners = Owners()) -> DataFrame:
    """One row per distinct value hash: n (occurrences), n_repos, n_owners.  A null owner or repository is one of its own;
    a repository belongs to an owner, so equal names under two owners are two."""
    return (spans.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
            .groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("n_repos"))
            .groupBy("hash").agg(F.sum("n").alias("n"), F.sum("n_repos").alias("n_repos"), F.count("*").alias("n_owners")))


def judge(spans: DataFrame, owners: Owners = Owners()) -> DataFrame:
    """``spans`` with n, n_repos, n_owners and a verdict: ``example`` (held by ``owners.wide`` owners or more), ``live``
    (live-looking and held by ``owners.live`` at most), else ``unclear``.  Bare tokens that are not live go."""
    salted = ownership(spans).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    verdict = (F.when(F.col("n_owners") >= owners.wide, "example")
               .when(F.col("looks") & (F.col("n_owners") <= owners.live), "live").otherwise("unclear"))
    return (spans.withColumn("salt", F.pmod(F.xxhash64("row", "start"), F.lit(SALTS)).cast("int"))
            .join(salted, ["hash", "salt"]).withColumn("verdict", verdict).where("kind < 3 OR verdict = 'live'").drop("salt"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repo: str = "source",
         owners: Owners = Owners()) -> DataFrame:
    """One row per row of ``docs``: key, n_assign, n_access, n_hex, n_bare, n_live, n_example and ``spans``, an array of
    (start, kind, end, verdict, n_owners, n_repos) ordered by start, then kind.

    A null text is empty; empty texts have no spans.  Texts of any length are read whole.  Rows with equal or null keys stay
    rows of their own.  Equal values at equal numbers of owners get equal verdicts (ties have no order to decide).
    An empty table gives no rows.  Only the four named columns are read, so other columns of any name play no part.
    """
    rows, spans = candidates(docs, key, text, owner, repo)
    found = judge(spans, owners).groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        "start", "kind", "end", "verdict", "n_owners", "n_repos"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,verdict:string,n_owners:bigint,n_repos:bigint>>")
    out = rows.join(found, "row", "left").select("key", F.coalesce("spans", none).alias("spans"))
    n = lambda test: F.size(F.filter("spans", test)).cast("long")
    of_kind = lambda i: n(lambda s: s["kind"] == i)
    return out.select(F.col("key").alias(key), *[of_kind(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                      n(lambda s: s["verdict"] == "live").alias("n_live"),
                      n(lambda s: s["verdict"] == "example").alias("n_example"), "spans")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(docs: DataFrame) -> DataFrame:
    """Owners are the sources; a repository is what a source holds in one language."""
    got = scan(docs, owner="source", repo="lang")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return got.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(_joined(base), 256).alias("base_sha256"),
                      _joined(F.col("spans")).alias("spans"), "n_bare", "n_live", "n_example",
                      _joined(F.filter("spans", lambda s: s["verdict"] == "live")).alias("live_spans"))


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _oracle() -> str:
    words = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _any_case("api") + "_?" + _any_case("key")
    head = f"""({words})["'']? *[:=] *["'']?"""
    rules = ((0, head + "([A-Za-z0-9+/_.=-]+)"), (1, "AKIA[A-Z0-9]+"), (2, "[0-9a-f]+"), (3, "[A-Za-z0-9+/_-]{20,}={0,2}"))
    found = "\n  UNION ALL ".join(
        f"""SELECT rid, {i} AS kind, unnest(regexp_extract_all(t, '{p}')) AS m, unnest(string_split_regex(t, '{p}')) AS piece,
    generate_subscripts(string_split_regex(t, '{p}'), 1) AS place FROM d""" for i, p in rules)
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, source, lang, coalesce(text, '') AS t FROM documents),
f AS ({found}),
p AS (SELECT *, sum(length(piece) + length(m)) OVER (PARTITION BY rid, kind ORDER BY place)::BIGINT AS "end",
  CASE WHEN kind = 0 THEN regexp_extract(m, '{rules[0][1]}', 2) ELSE m END AS v FROM f WHERE m IS NOT NULL),
l AS (SELECT *, "end" - length(m) AS start, len(list_distinct(string_split(v, ''))) AS kinds,
  length(v) >= 8 AND len(list_distinct(string_split(v, ''))) >= 8 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
    AND NOT regexp_matches(lower(v), 'example|sample|dummy|placeholder|changeme|your|xxxx|test|1234|abcd') AS looks FROM p
  WHERE CASE kind WHEN 0 THEN length(regexp_extract(m, '{rules[0][1]}', 2)) >= 6 WHEN 1 THEN length(m) >= 20 WHEN 2 THEN length(m) >= 24 ELSE true END),
b AS (SELECT * FROM l WHERE kind < 3),
c AS (SELECT rid, kind, start, "end", looks, v FROM b UNION ALL
  SELECT rid, kind, start, "end", looks, v FROM l WHERE kind = 3 AND looks AND kinds >= 12 AND regexp_matches(v, '[a-z]')
    AND regexp_matches(v, '[A-Z]') AND len(regexp_extract_all(v, '[0-9]')) >= 3
    AND NOT EXISTS (SELECT 1 FROM b WHERE b.rid = l.rid AND b.start < l."end" AND b."end" > l.start)),
o AS (SELECT v, count(*) AS n_owners FROM (SELECT DISTINCT v, source FROM c JOIN d USING (rid)) GROUP BY v),
j AS (SELECT c.*, ['assign', 'access', 'hex', 'bare'][kind + 1] || ':' || start || ':' || "end" AS span,
  CASE WHEN n_owners >= 3 THEN 'example' WHEN looks AND n_owners <= 1 THEN 'live' ELSE 'unclear' END AS verdict FROM c JOIN o USING (v)),
g AS (SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base,
  string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3 OR verdict = 'live') AS spans,
  count(*) FILTER (kind = 3 AND verdict = 'live') AS n_bare, count(*) FILTER (verdict = 'live') AS n_live,
  count(*) FILTER (kind < 3 AND verdict = 'example') AS n_example,
  string_agg(span, ',' ORDER BY start, kind) FILTER (verdict = 'live') AS live_spans FROM j GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_bare, 0) AS n_bare,
  coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example, coalesce(live_spans, '') AS live_spans
FROM d LEFT JOIN g USING (rid)
"""


ORACLE = _oracle()
