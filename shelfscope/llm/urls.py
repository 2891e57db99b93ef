"""Operator 6, URL filters: rules indexed by their rarest literal token.

Native: DataFrame functions only.  Every rule is a host, a path prefix and an
action.  The literal tokens of a rule are those alphanumeric runs which a
fitting URL must hold as whole runs.  How often URLs hold each of them is
counted over all URLs; the rarest one indexes the rule.  A URL's tokens then
fetch its candidate rules, and only those run their regular expression.

Shape: distinct URLs (combined map-side, so a hot URL is judged once) ->
tokens -> join with the index -> regular expression -> the longest rule per URL
-> left join back to the rows.  The index holds one row a rule; no hint is
given, Spark's own measure of its size decides between broadcast and shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    host: str    # fits itself and every subdomain
    path: str    # prefix of the URL's path


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty without."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``? #`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_regex(rule: Rule) -> str:
    quote = lambda s: re.sub(r"([^A-Za-z0-9/_-])", r"\\\1", s)
    return rf"(?s)^(?:[^/]*\.)?{quote(rule.host)}{quote(rule.path)}" + ("" if rule.path else r"(?:\z|/)")


def rule_tokens(rule: Rule) -> list[str]:
    """Runs that every fitting URL holds whole: a path prefix may end inside a
    run, so its last run counts only if a delimiter follows."""
    runs = re.findall(r"[A-Za-z0-9]+", rule.host)
    path = re.findall(r"[A-Za-z0-9]+(?=[^A-Za-z0-9])", rule.path)
    return sorted(set(runs + path))


def judge(urls: DataFrame, rules=RULES, default: str = "allow", url_col: str = "url") -> DataFrame:
    """Adds host, path, rule and verdict to every row of ``urls``.

    The longest fitting rule (characters of host and path) wins; at equal length
    block before allow, then the smaller text.  No fitting rule: rule null,
    verdict ``default``.  A null or empty URL or one without ``://`` has an empty host and
    path and fits no rule.  Repeated rows stay repeated; other columns are kept
    (columns named host, path, rule or verdict are replaced); an empty table
    gives an empty table; very long URLs are matched whole.
    """
    spark = urls.sparkSession
    rows = [(i, r.action, r.host + r.path, len(r.host + r.path), rule_regex(r), rule_tokens(r))
            for i, r in enumerate(rules)]
    table = spark.createDataFrame(rows, T.StructType([
        T.StructField("rule_no", T.IntegerType()), T.StructField("action", T.StringType()),
        T.StructField("rule", T.StringType()), T.StructField("size", T.IntegerType()),
        T.StructField("regex", T.StringType()), T.StructField("tokens", T.ArrayType(T.StringType()))]))

    one = (urls.select(F.col(f"`{url_col}`").alias("_url")).where("_url is not null").distinct()
           .withColumn("_at", F.concat(host_of(F.col("_url")), path_of(F.col("_url")))))
    # '' is a token of every URL: rules without a literal token are always candidates
    tokens = one.select("_url", "_at", F.explode(F.array_distinct(F.split("_at", "[^A-Za-z0-9]+"))).alias("token"))
    tokens = tokens.union(one.select("_url", "_at", F.lit("")).where(F.lit(any(not r[5] for r in rows))))

    literal = table.select("rule_no", F.explode("tokens").alias("token"))
    held = tokens.join(literal.select("token").distinct(), "token", "left_semi").groupBy("token").count()
    index = (literal.join(held, "token", "left")
             .groupBy("rule_no").agg(F.min_by("token", F.struct(F.coalesce("count", F.lit(0)), "token")).alias("token")))
    index = table.join(index, "rule_no", "left").select(
        F.coalesce("token", F.lit("")).alias("token"), "action", "rule", "size", "regex")

    best = (tokens.join(index, "token").where(F.expr("_at rlike regex"))
            .groupBy("_url").agg(F.min(F.struct((-F.col("size")).alias("n"), F.when(F.col("action") == "block", 0).otherwise(1)
                                                .alias("a"), "rule", "action")).alias("best"))
            .select("_url", "best.rule", "best.action"))
    keep = [c for c in urls.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    rows_ = urls.select(*[F.col(f"`{c}`") for c in keep])
    key, rule, action = (fresh(rows_, c) for c in ("_url", "_rule", "_action"))
    best = best.select(F.col("_url").alias(key), F.col("rule").alias(rule), F.col("action").alias(action))
    out = rows_.join(best, F.col(f"`{url_col}`") == F.col(key), "left")
    return out.select(*[F.col(f"`{c}`") for c in keep], host_of(F.col(f"`{url_col}`")).alias("host"),
                      path_of(F.col(f"`{url_col}`")).alias("path"), F.col(rule).alias("rule"),
                      F.coalesce(F.col(action), F.lit(default)).alias("verdict"))


def query(pages: DataFrame) -> DataFrame:
    return judge(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


_RULE_ROWS = ", ".join(f"('{r.action}', '{r.host}', '{r.path}')" for r in RULES)
ORACLE = f"""
WITH rules(action, h, p) AS (VALUES {_RULE_ROWS}),
u AS (SELECT page_id, row_number() OVER () AS row_no,
  coalesce(CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
    '{UPPER}', '{LOWER}') END, '') AS host,
  coalesce(CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) END, '') AS path
  FROM pages),
fit AS (SELECT row_no, h || p AS rule, action, row_number() OVER (PARTITION BY row_no ORDER BY length(h || p) DESC,
  action = 'allow', h || p) AS nth
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM u LEFT JOIN (SELECT * FROM fit WHERE nth = 1) USING (row_no)
"""
