"""Brand classification of ad campaigns (A2) and the ad-type code map.

A brand rule is ``(pattern, label)``.  A creative row gets the label of the
first rule (in list order) whose pattern occurs, case-insensitively, in any of
the searched fields; otherwise ``default``.  Rules are data, so the same code
serves the reference's list and any user list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sqlexpr import lit, qn

# Fixed values that must equal the reference's for the same results: the
# clean-room brand rules, in priority order (pattern searched in lower-cased
# advertiser, creative and campaign; first match wins).
REFERENCE_BRAND_RULES: list[tuple[str, str]] = [
    ("allegra", "Allegra"),
    ("aspercreme", "Aspercreme"),
    ("cortizone", "Cortizone 10"),
    ("dulcolax", "Dulcolax"),
    ("gold bond", "Gold Bond"),
    ("icy hot", "Icy Hot"),
    ("nasacort", "Nasacort"),
    ("selsun blue", "Selsun Blue"),
    ("unisom", "Unisom"),
    ("xyzal", "Xyzal"),
    ("zantac", "Zantac"),
    ("pharmaton", "Pharmaton"),
    ("initiv", "Initiv"),
    ("dulcosoft", "Dulcoease"),
    ("pton", "PTON"),
    ("bisolherbal", "Bisolherbal"),
    ("buscomint", "Buscomint"),
    ("allevia", "Allevia"),
    ("buscopan", "Buscopan"),
    ("dulcoease", "Dulcoease"),
    ("act", "ACT"),
]
UNCLASSIFIED = "UNCLASSIFIED"
BRAND_FIELDS = ("advertiser", "creative", "campaign")

# Rules used with the derived test views (their names are built from part names).
FIXTURE_BRAND_RULES: list[tuple[str, str]] = [
    ("red", "Red"), ("anvil", "Anvil"), ("widget", "Widget"), ("ring", "Ring"),
]

def _hit(field: str, pattern: str) -> str:
    # LIKE '%p%' on LOWER(field) == contains(lower(field), p) for wildcard-free p
    return f"contains(lower({qn(field)}), {lit(pattern)})"


def brand_case(rules: Sequence[tuple[str, str]] = REFERENCE_BRAND_RULES,
               fields: Sequence[str] = BRAND_FIELDS,
               default: str = UNCLASSIFIED) -> Column:
    """CASE form: one WHEN per (rule, field) in rule order, then field order
    (built as one SQL expression)."""
    whens = " ".join(f"WHEN {_hit(f, p)} THEN {lit(label)}" for p, label in rules for f in fields)
    return F.expr(f"CASE {whens} ELSE {lit(default)} END" if whens else lit(default))


def brand_array(rules: Sequence[tuple[str, str]] = REFERENCE_BRAND_RULES,
                fields: Sequence[str] = BRAND_FIELDS,
                default: str = UNCLASSIFIED) -> Column:
    """Array form for long rule lists: the rules are one literal array, the
    first matching element is taken (same priority semantics as the CASE)."""
    if not rules:
        return F.lit(default)
    arr = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(lab).alias("label")) for p, lab in rules])
    lowered = [F.lower(F.col(f)) for f in fields]

    def matches(r: Column) -> Column:
        cond = None
        for lf in lowered:
            c = lf.contains(r["p"])
            cond = c if cond is None else (cond | c)
        return cond

    first = F.get(F.filter(arr, matches), 0)
    return F.coalesce(first["label"], F.lit(default))


def classify_brand(rules: Sequence[tuple[str, str]] = REFERENCE_BRAND_RULES,
                   fields: Sequence[str] = BRAND_FIELDS,
                   default: str = UNCLASSIFIED, mode: str = "array") -> Column:
    """A2 for any number of rules (the array form); ``mode="case"`` gives the
    same labels as a CASE chain, whose generated code grows with the rules."""
    return brand_case(rules, fields, default) if mode == "case" else brand_array(rules, fields, default)


GRAMS = (12, 6, 3, 2, 1, 0)  # characters of an index entry: the most that a pattern has


def _grams(text: str, size: str) -> str:
    return (f"CASE WHEN {size} = 0 THEN array('') WHEN length({text}) >= {size} THEN "
            f"transform(sequence(1, length({text}) - {size} + 1), i -> substr({text}, i, {size})) ELSE array() END")


def classify_indexed(df: DataFrame, rules: DataFrame, fields: Sequence[str] = BRAND_FIELDS, default: str = UNCLASSIFIED,
                     out: str = "brand") -> DataFrame:
    """A2 for thousands of rules, as a join: adds ``out``, the label that
    ``brand_case`` gives with the rows of ``rules`` (``rule_no``, ``pattern``,
    ``label``) in ascending ``rule_no``.

    Every rule is filed under the rarest of its pattern's grams (of 12, 6, 3 or
    fewer characters, the most that it has), counted over the distinct field
    texts; a text looks up its grams, and only rules found there are searched in it.  A
    rule with a gram that no text holds is never searched.  Rows cost a join on
    their fields; work on text is per distinct text, so it does not grow with
    repeated rows or with rules that share nothing with a text.  Only grams of
    sizes that some rule is filed under are taken from texts.  All joins are
    merge joins: the planner sees the size of texts and rules before they are cut
    into grams, and would send many times that through the driver.

    NULL fields match nothing, an empty pattern every text, a NULL pattern
    nothing; of equal ``rule_no`` the smallest label wins; ``out`` replaces a
    column of that name."""
    names = [f"__field{i}" for i in range(len(fields))]
    rows = df.select(*[F.col(qn(f)).alias(n) for f, n in zip(fields, names)]).distinct()
    words = rows.select(*names, F.explode(F.array_distinct(F.array(*[F.lower(n) for n in names]))).alias("__text")).where("__text IS NOT NULL")
    rules = rules.select("rule_no", "pattern", "label").where(F.col("pattern").isNotNull())
    size = "CASE " + " ".join(f"WHEN length(pattern) >= {n} THEN {n}" for n in GRAMS) + " END"
    filed = rules.select("*", F.explode(F.array_distinct(F.expr(_grams("pattern", size)))).alias("__gram"))
    used = rules.agg(F.collect_set(F.expr(size))).scalar()
    cut = F.concat(*[F.when(F.array_contains(used, F.lit(n)), F.expr(_grams("__text", str(n)))).otherwise(F.array().cast("array<string>")) for n in GRAMS])
    held = words.select("__text").distinct().select("__text", F.explode(F.array_distinct(cut)).alias("__gram"))
    held = held.join(filed.select("__gram").distinct().hint("merge"), "__gram", "left_semi")
    often = held.groupBy("__gram").agg(F.count(F.lit(1)).alias("__n"))
    least = F.min(F.struct(F.coalesce(F.col("__n"), F.lit(0)).alias("n"), F.col("__gram").alias("gram"))).alias("__rarest")
    index = (filed.join(often.hint("merge"), "__gram", "left").groupBy("rule_no", "pattern", "label").agg(least).where("__rarest.n > 0")
             .select("rule_no", "pattern", "label", F.col("__rarest.gram").alias("__gram")))
    hit = held.hint("merge").join(index, "__gram").where(F.contains(F.col("__text"), F.col("pattern")))
    first = hit.groupBy("__text").agg(F.min(F.struct("rule_no", "label")).alias("__first"))
    of_row = words.hint("merge").join(first, "__text").groupBy(*names).agg(F.min("__first")["label"].alias("__label"))
    same = F.lit(True)
    for f, n in zip(fields, names):
        same = same & F.col(qn(f)).eqNullSafe(F.col(n))
    labelled = df.drop(*({out} - set(fields))).join(of_row.hint("merge"), same, "left")
    return labelled.withColumn(out, F.coalesce(F.col("__label"), F.lit(default))).drop("__label", *names)


# The ad product type codes of the clean-room reports.
AD_TYPE_CODES: list[tuple[str, str]] = [
    ("sponsored_products", "SP"),
    ("sponsored_display", "SD"),
    ("sponsored_brands", "SB"),
]


def map_ad_type(c: str | Column, keep_dsp: bool = False, default: str = "SA_other") -> Column:
    """A13.  ``keep_dsp`` passes 'DSP' through (campaign value report; its
    default is 'undefined_ad_type'); the overlap and path reports use
    default 'SA_other' and no DSP branch.  NULL falls to ``default``."""
    col = F.col(c) if isinstance(c, str) else c
    expr = F.when(col == "DSP", F.lit("DSP")) if keep_dsp else None
    for raw, code in AD_TYPE_CODES:
        expr = F.when(col == raw, F.lit(code)) if expr is None else expr.when(col == raw, F.lit(code))
    return expr.otherwise(F.lit(default))


def null_ad_type_as_dsp(c: str | Column) -> Column:
    """Attributed conversions carry NULL ad type for DSP traffic."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit("DSP"))
