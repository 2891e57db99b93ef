"""Flattening and schema normalisation.

Name rules are worked out on the driver from ``df.schema`` (metadata only, no
job) and applied in one ``select``; dotted names are back-quoted.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .setops import append_all


def q(name: str) -> Column:
    """Column by its literal name (dots are part of the name)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _flat_cols(schema: StructType, path: list[str], sep: str) -> list[Column]:
    out: list[Column] = []
    for f in schema.fields:
        p = path + [f.name]
        if isinstance(f.dataType, StructType):
            out += _flat_cols(f.dataType, p, sep)
        else:
            ref = F.col(".".join("`" + x.replace("`", "``") + "`" for x in p))
            out.append(ref.alias(sep.join(p)))
    return out


def flatten_structs(df: DataFrame, sep: str = ".") -> DataFrame:
    """every struct field becomes a column named by its dotted path;
    arrays are left as they are (like ``json_normalize``)."""
    return df.select(*_flat_cols(df.schema, [], sep))


def _walk(st: StructType, base: Column, path: list[str]) -> list[Column]:
    cols: list[Column] = []
    for f in st.fields:
        c = base.getField(f.name)
        if isinstance(f.dataType, StructType):
            cols += _walk(f.dataType, c, path + [f.name])
        else:
            cols.append(c.alias(".".join([*path, f.name])))
    return cols


def first_elems_flat(df: DataFrame, arrays: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """F2 for several arrays in one ``select`` (the reference joins the
    pieces back by row position; one projection makes that join unneeded)."""
    g = df.select(*[q(k) for k in keep], *[F.get(q(a), 0).alias(f"__g{i}") for i, a in enumerate(arrays)])
    cols: list[Column] = [q(k) for k in keep]
    for i, prefix in enumerate(arrays.values()):
        cols += _walk(g.schema[f"__g{i}"].dataType, F.col(f"__g{i}"), [prefix])
    return g.select(*cols)


def explode_struct(df: DataFrame, col: str) -> DataFrame:
    """one row per element of an array of structs, the parent's other
    columns repeated; an empty or NULL array keeps one row of NULLs.  A child
    field with the name of a parent column replaces it."""
    el = df.schema[col].dataType
    if not isinstance(el, ArrayType) or not isinstance(el.elementType, StructType):
        raise TypeError(f"{col} is not an array of structs")
    child = [f.name for f in el.elementType.fields]
    parent = [c for c in df.columns if c != col and c not in child]
    x = df.select(*[q(c) for c in parent], F.explode_outer(q(col)).alias("__el"))
    return x.select(*[q(c) for c in parent], *[F.col("__el").getField(n).alias(n) for n in child])


def explode_path(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """explode nested arrays level by level (campaigns -> coupons -> asins)."""
    for c in cols:
        df = explode_struct(df, c)
    return df


def upper_columns(df: DataFrame, trim: bool = False) -> DataFrame:
    """upper-case every column name (optionally trimmed)."""
    return df.toDF(*[(c.strip() if trim else c).upper() for c in df.columns])


def _select_renamed(df: DataFrame, plan: list[tuple[str, str, str | None]], strict: bool = True) -> DataFrame:
    """plan = [(source, target, cast)]; a later target replaces an earlier
    one with the same (case-insensitive) name.  ``strict=False`` casts with
    ``try_cast`` (bad text -> NULL)."""
    final: dict[str, tuple[str, str, str | None]] = {}
    for src, tgt, cast in plan:
        final.pop(tgt.upper(), None)
        final[tgt.upper()] = (src, tgt, cast)
    cols = []
    for src, tgt, cast in final.values():
        c = q(src)
        if cast:
            c = c.cast(cast) if strict else c.try_cast(cast)
        cols.append(c.alias(tgt))
    return df.select(*cols)


def normalize_report_names(df: DataFrame, kind: str = "report", strict_dates: bool = False) -> DataFrame:
    """F6-F10 in one pass.

    kind="report":  ``x.amount`` -> ``X`` (an existing ``x`` is dropped),
                    ``x.currencyCode`` -> ``X_CURRENCYCODE``, names containing
                    ``date`` -> upper-case and cast to date, others upper-case.
    kind="promo":   upper-case; names containing ``time`` cast to timestamp.
    kind="search":  names containing ``date`` cast to date; others get
                    spaces -> underscores; all upper-case.
    Date casts use ``try_cast`` unless ``strict_dates``."""
    dcast = "date"
    plan: list[tuple[str, str, str | None]] = []
    amount_bases = {c.split(".")[0].lower() for c in df.columns if ".amount" in c.lower()}
    for c in df.columns:
        lc = c.lower()
        if kind == "promo":
            plan.append((c, c.upper(), "timestamp_ntz" if "time" in lc else None))
        elif kind == "search":
            if "date" in lc:
                plan.append((c, c.upper(), dcast))
            else:
                plan.append((c, c.replace(" ", "_").upper(), None))
        elif kind == "report":
            if ".amount" in lc:
                plan.append((c, c.split(".")[0].upper(), None))
            elif ".currencycode" in lc:
                plan.append((c, c.replace(".", "_").upper(), None))
            elif lc in amount_bases:
                continue  # replaced by its .amount column
            elif "date" in lc:
                plan.append((c, c.upper(), dcast))
            else:
                plan.append((c, c.upper(), None))
        else:
            raise ValueError(f"unknown kind {kind!r}")
    return _select_renamed(df, plan, strict=strict_dates)


def cast_by_name(df: DataFrame, date_word: str = "date", strict: bool = False) -> DataFrame:
    """F8 on its own: every column whose name contains ``date`` becomes a
    date (``try_cast`` -> NULL on bad text unless ``strict``)."""
    cols = []
    for c in df.columns:
        if date_word in c.lower():
            cols.append((q(c).cast("date") if strict else q(c).try_cast("date")).alias(c)
                        if df.schema[c].dataType.simpleString() == "string" else q(c).cast("date").alias(c))
        else:
            cols.append(q(c))
    return df.select(*cols)


def strip_prefix(df: DataFrame, prefixes: Sequence[str] = ("summaries.", "vendorDetails.")) -> DataFrame:
    """drop the prefix, ``.`` -> ``_``, upper-case; when two columns end
    with the same name the later one wins."""
    plan = []
    for c in df.columns:
        tgt = c.upper()
        for p in prefixes:
            if p in c:
                tgt = c.split(p, 1)[1].replace('"', "").replace(".", "_").upper()
                break
        plan.append((c, tgt, None))
    return _select_renamed(df, plan)


def union_missing(dfs: Sequence[DataFrame]) -> DataFrame:
    """union by name, missing columns NULL."""
    return append_all(dfs, allow_missing=True)


def with_audit(df: DataFrame, country: str | Column, now: dt.datetime | str | None = None,
               filename: str | Column | None = None, ts_name: str = "LAST_UPDATED_TIMESTAMP") -> DataFrame:
    """COUNTRY_CODE, LAST_UPDATED_TIMESTAMP (``now`` is a parameter so
    reruns are repeatable; None = current time) and optionally FILENAME."""
    cc = country if isinstance(country, Column) else F.lit(country)
    ts = F.current_timestamp() if now is None else F.lit(str(now)).cast("timestamp_ntz")
    cols = {"COUNTRY_CODE": cc, ts_name: ts}
    if filename is not None:
        cols["FILENAME"] = filename if isinstance(filename, Column) else F.lit(filename)
    return df.withColumns(cols)


def ensure_columns(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """add a column with its default only when it is missing (the
    reference tests names captured before upper-casing and so overwrites real
    values; we add only if missing)."""
    present = {c.upper() for c in df.columns}
    add = {c: F.lit(v) for c, v in defaults.items() if c.upper() not in present}
    return df.withColumns(add) if add else df


def null_tokens(df: DataFrame, cols: Iterable[str], tokens: Sequence[str] = ("null",),
                replacement: str | None = None) -> DataFrame:
    """sentinel texts ('null', '[NULL]', '-') -> NULL or a replacement."""
    cols = set(cols)
    rep = F.lit(replacement) if replacement is not None else F.lit(None).cast("string")
    return df.select(*[
        (F.when(q(c).isin(list(tokens)), rep).otherwise(q(c)).alias(c) if c in cols else q(c))
        for c in df.columns])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """F16: rename by mapping; names not present are ignored."""
    m = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(m) if m else df


def sort_columns(df: DataFrame) -> DataFrame:
    """columns in alphabetical order."""
    return df.select(*[q(c) for c in sorted(df.columns)])


class ContractError(ValueError):
    pass


def assert_columns(df: DataFrame, contract: Sequence[str], strict: bool = True) -> DataFrame:
    """the sorted column names must equal the contract (metadata check
    on the driver, no job).  ``strict=False`` drops unknown extra columns and
    fails only on missing ones."""
    have = sorted(df.columns)
    want = sorted(contract)
    if have == want:
        return df
    missing = sorted(set(want) - set(have))
    if strict or missing:
        raise ContractError(f"column contract failed: missing={missing} extra={sorted(set(have) - set(want))}")
    return df.select(*[q(c) for c in want])


def with_period(df: DataFrame, start: str, end: str) -> DataFrame:
    """STARTDATE / ENDDATE constants as dates."""
    return df.withColumns({"STARTDATE": F.lit(start).cast("date"), "ENDDATE": F.lit(end).cast("date")})
