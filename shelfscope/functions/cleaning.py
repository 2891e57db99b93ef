"""Row-cleaning column functions and small DataFrame steps.

Per-value pandas lambdas of the reference become built-in expressions
(JVM-side, whole-stage codegen); row-order dependent steps take an explicit
order column (file position), never the order after a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.normalize import q


def _c(c: str | Column) -> Column:
    return q(c) if isinstance(c, str) else c


def code_list(c: str | Column) -> Column:
    """C1 (expression): leading digits of each comma-separated part; parts
    without leading digits are dropped."""
    parts = F.split(F.trim(_c(c)), ",")
    digits = F.transform(parts, lambda x: F.regexp_extract(F.trim(x), r"^(\d+)", 1))
    return F.filter(digits, lambda x: x != "")


def explode_codes(df: DataFrame, col: str, pos_name: str | None = None) -> DataFrame:
    """One row per extracted code; no code -> one row with NULL.
    ``pos_name`` keeps the code's index within the cell (for row order)."""
    others = [q(x) for x in df.columns if x != col]
    if pos_name:
        return df.select(*others, F.posexplode_outer(code_list(col)).alias(pos_name, col))
    return df.select(*others, F.explode_outer(code_list(col)).alias(col))


RANK_BUCKET = 1 << 16  # rows of one key numbered inside one task at most


def row_number_bucketed(df: DataFrame, keys: Sequence[str], pos: str, tiebreak: Sequence[str] = (),
                        out: str = "rn", bucket: int = RANK_BUCKET, total: str | None = None) -> DataFrame:
    """Exact ``row_number() over (partition by keys order by pos, tiebreak)``
    for a numeric position that keeps a hot key out of a single task: rows are
    cut into position buckets, numbered inside (key, bucket) windows of at
    most ``bucket`` positions, and shifted by the row counts of the key's
    earlier buckets (a prefix sum over one row per bucket).  ``total`` also
    returns the key's row count (from the same small count table)."""
    b = df.withColumn("__b", F.floor(q(pos) / bucket))
    counts = b.groupBy(*keys, "__b").agg(F.count(F.lit(1)).alias("__n"))
    w_prev = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    extra = [F.sum("__n").over(Window.partitionBy(*keys)).alias(total)] if total else []
    offsets = counts.select(*keys, "__b", F.coalesce(F.sum("__n").over(w_prev), F.lit(0)).alias("__off"), *extra)
    w_in = Window.partitionBy(*keys, "__b").orderBy(q(pos), *[q(t) for t in tiebreak])
    local = b.withColumn("__rn_local", F.row_number().over(w_in))
    # NULL keys are keys too: null-safe equality on both sides
    right = offsets.select(*[q(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__b").alias("__kb"), "__off",
                           *([total] if total else []))
    same = F.col("__b").eqNullSafe(F.col("__kb"))
    for i, k in enumerate(keys):
        same = same & q(k).eqNullSafe(F.col(f"__k{i}"))
    return (local.join(right, same).withColumn(out, F.col("__off") + F.col("__rn_local"))
            .drop("__b", "__kb", "__off", "__rn_local", *[f"__k{i}" for i in range(len(keys))]))


def suffix_duplicate_ids(df: DataFrame, id_col: str, pos: str, tiebreak: Sequence[str] = (),
                         file_col: str | None = None) -> DataFrame:
    """C2 (W2 + W3): ids that occur more than once (within a file) become
    ``id-1, id-2, ...`` in row order (``pos``, then ``tiebreak``); unique ids
    are unchanged.  The running number is bucketed (``row_number_bucketed``)
    and the occurrence count comes from the same per-bucket counts, so one
    very common id does not land in one task."""
    part = [file_col, id_col] if file_col else [id_col]
    x = row_number_bucketed(df, part, pos, tiebreak, out="__rn", total="__cnt")
    return x.withColumn(id_col, F.when(F.col("__cnt") > 1, F.concat(q(id_col), F.lit("-"), F.col("__rn").cast("string")))
                        .otherwise(q(id_col))).drop("__cnt", "__rn")


def unpivot_dates(df: DataFrame, ids: Sequence[str], var: str = "Date", value: str = "Value",
                  values: Sequence[str] | None = None, lenient: bool = False) -> DataFrame:
    """Wide -> long; id columns stay, every other column becomes a
    (Date, Value) row; NULL values are kept.  Numeric columns become DOUBLE;
    if any of them holds text, the values stay as they are, as text
    (``lenient``: text becomes DOUBLE, NULL where it is no number)."""
    vals = list(values) if values is not None else [c for c in df.columns if c not in ids]
    text = any(t == "string" for c, t in df.dtypes if c in vals)
    kind = (lambda c: numeric(c)) if lenient else (lambda c: q(c).cast("string" if text else "double"))
    cast = df.select(*[q(c) for c in ids], *[kind(c).alias(c) for c in vals])
    return cast.unpivot([q(c) for c in ids], [q(c) for c in vals], var, value)


def skip_footer(df: DataFrame, pos: str, file_col: str, n: int = 2) -> DataFrame:
    """Drop the last ``n`` rows of every file.  The per-file max position
    is an aggregate (one row per file) joined back, not a window over a
    whole file, so a very large file is not pulled into one task."""
    last = df.groupBy(file_col).agg(F.max(pos).alias("__last"))
    return df.join(last, file_col).where(q(pos) <= F.col("__last") - n).drop("__last")


def promote_embedded_header(df: DataFrame, file_col: str, pos: str, first_name: str = "PZN") -> DataFrame:
    """A file whose first row holds the column names (its first cell is
    ``first_name``) takes its names from that row, and the row goes.

    ``df`` may stack files of several layouts (a cell a file lacks is NULL);
    distinct name rows are few (metadata) and read once.  The result has the
    union of all names; a column a file lacks is NULL."""
    cols = [c for c in df.columns if c not in (file_col, pos)]
    lead = df.where((q(pos) == 1) & F.coalesce(*[q(c).cast("string") for c in cols]).eqNullSafe(F.lit(first_name)))
    names = [tuple(r) for r in lead.select(*[q(c).cast("string") for c in cols]).distinct().collect()]
    if not names:
        return df
    marks = lead.select(q(file_col).alias("__file"), F.struct(*[q(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)]).alias("__names"))
    x = df.join(marks, q(file_col) == F.col("__file"), "left")
    out = x.where(F.col("__names").isNull()).drop("__file", "__names")
    for row in names:
        mine = F.lit(True)
        for i, n in enumerate(row):
            mine = mine & F.col("__names")[f"c{i}"].eqNullSafe(F.lit(n))
        part = x.where(F.col("__names").isNotNull() & mine & (q(pos) > 1))
        part = part.select(*[q(c).alias(n) for c, n in zip(cols, row) if n], q(file_col), (q(pos) - 1).alias(pos))
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def skip_embedded_header(df: DataFrame, col: str) -> DataFrame:
    """Drop repeated header rows (first cell equals the column name)."""
    return df.where(~q(col).eqNullSafe(F.lit(col)))


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row (smallest ``order``) of each key;
    ``dropDuplicates`` would keep an arbitrary one.  Written as a ``min_by``
    aggregate (partial aggregation before the shuffle), not a window, so a
    key holding a large share of the rows is combined map-side."""
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[q(c) for c in others])
    first = df.groupBy(*[q(k) for k in keys]).agg(F.min_by(row, F.struct(*[q(o) for o in order])).alias("__r"))
    return first.select(*[q(k) for k in keys], *[F.col("__r").getField(c).alias(c) for c in others]).select(
        *[q(c) for c in df.columns])


def sum_suffix(df: DataFrame, suffix: str, out: str) -> DataFrame:
    """Row sum of every column whose name ends with ``suffix``; NULL
    counts as 0 (pandas ``sum(axis=1)``)."""
    cols = [c for c in df.columns if c.endswith(suffix)]
    total = F.lit(0.0)
    for c in cols:
        total = total + F.coalesce(q(c).cast("double"), F.lit(0.0))
    return df.withColumn(out, total)


def iso_date(c: str | Column, fmt: str = "yyyyMMdd", strict: bool = True) -> Column:
    """Date text in ``fmt`` -> 'yyyy-MM-dd' text.  Strict: a bad
    value fails the job (ANSI); lenient: NULL."""
    col = _c(c)
    d = F.try_to_date(col, fmt)
    if strict:  # fail the job on a bad value whatever the session's ANSI setting
        d = F.when(col.isNotNull() & d.isNull(),
                   F.raise_error(F.concat(F.lit(f"not a {fmt} date: "), col))).otherwise(d)
    return F.date_format(d, "yyyy-MM-dd")


def date_ddmmyy(c: str | Column) -> Column:
    """``dd.MM.yy`` text -> date with the POSIX two-digit-year rule the
    reference's parser uses (69-99 -> 19xx, 00-68 -> 20xx); Spark's ``yy``
    pattern would put every year in 20xx.  Substrings only (no regex);
    anything else, or an impossible day, gives NULL."""
    t = _c(c)
    yy = F.substring(t, 7, 2).try_cast("int")
    century = F.when(yy >= 69, F.lit("19")).otherwise(F.lit("20"))
    iso = F.concat(century, F.substring(t, 7, 2), F.lit("-"), F.substring(t, 4, 2), F.lit("-"), F.substring(t, 1, 2))
    ok = (F.length(t) == 8) & (F.substring(t, 3, 1) == ".") & (F.substring(t, 6, 1) == ".") & yy.isNotNull()
    return F.when(ok, F.try_to_date(iso, "yyyy-MM-dd"))


NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def numeric(c: str | Column) -> Column:
    """Number or number text -> DOUBLE; anything else ('nan', '5d', '') -> NULL."""
    text = _c(c).cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def require_numeric(df: DataFrame, col: str) -> DataFrame:
    """Numeric coercion; rows whose value is not numeric are dropped."""
    return df.withColumn(col, numeric(col)).where(q(col).isNotNull())


def zero_int(c: str | Column) -> Column:
    """NULL -> 0, then integer."""
    return F.coalesce(numeric(c), F.lit(0.0)).cast("int")


def require_key(df: DataFrame, col: str) -> DataFrame:
    """C14: trimmed key must not be NULL, '' or 'null' (any case)."""
    t = F.trim(_c(col))
    return df.withColumn(col, t).where(t.isNotNull() & (t != "") & (F.lower(t) != "null"))


def code_text(c: str | Column) -> Column:
    """Numeric code as text: NULL or 0 -> '', else the integer digits."""
    v = numeric(c)
    return F.when(F.coalesce(v, F.lit(0.0)) == 0, F.lit("")).otherwise(v.cast("bigint").cast("string"))


def code_right(c: str | Column, n: int = 6) -> Column:
    """Strip leading zeros, keep the last ``n`` characters."""
    return F.right(F.regexp_replace(_c(c).cast("string"), r"^0+", ""), F.lit(n))


def recode(c: str | Column, frm: str, to: str, when: Column | None = None, substring: bool = False) -> Column:
    """C17: value recode (``ZZ``->``CN`` when the country is CN); with
    ``substring`` a text replace (``UK``->``GB``)."""
    col = _c(c)
    new = F.replace(col, F.lit(frm), F.lit(to)) if substring else F.when(col == frm, F.lit(to)).otherwise(col)
    return new if when is None else F.when(when, new).otherwise(col)


def translate_values(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Dictionary translation of a column, unmapped values kept.  The
    dictionary is a literal map (its size is the config's)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, _c(c)), _c(c))


def project(df: DataFrame, cols: Sequence[str], defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Add missing columns with their default, then the fixed column
    list in order."""
    present = set(df.columns)
    add = {c: v for c, v in (defaults or {}).items() if c not in present}
    if add:
        df = df.withColumns(add)
    return df.select(*[q(c) for c in cols])


# Formats tried in order by ``format_date`` (C25): ISO first, then day-first
# dotted, month-first slashed, compact, and ISO with a time part.
DATE_FORMATS = ["yyyy-MM-dd", "dd.MM.yyyy", "MM/dd/yyyy", "yyyyMMdd", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd",
                "dd MMM yyyy", "MMM dd, yyyy"]


def format_date(c: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Free-form date text -> 'yyyy-MM-dd' (first format that parses)."""
    col = F.trim(_c(c))
    parsed = F.coalesce(*[F.try_to_date(col, f) for f in formats])
    return F.date_format(parsed, "yyyy-MM-dd")
