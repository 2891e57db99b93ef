"""Flat-file cleaning reports Q9-Q15.

Inputs are tables of landed files (read by ``sources.files``) with the file
name and the row position in the file kept as columns, so row-order rules
(duplicate-id suffixes, footers, keep-first) stay exact after shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as cl
from ..operators import normalize as nz
from ..operators.aggregates import sum_drop_null_keys
from ..operators.setops import append_all

# Brand names translated in the hero mapping (Japanese -> Latin).
JP_BRANDS_TRANSLATION = {
    "ハイチオール": "Hythiol",
    "スルーラック": "Surulac",
    "アレジオン": "Alesion",
    "イブ(EVE)": "EVE",
    "ドリエル": "Drewell",
    "アネロン": "Aneron",
    "ブロン(BRON)": "Bron",
    "エスタック": "S-Tac",
    "ガストール": "Gastol",
    "エスエス製薬": "Others",
    "エスカップ": "S-Cup",
    "ラカルト": "Medicated Lacalut New - 5",
}
# Column order of the CN promotions table.
PROMOTIONS_CN_COLUMNS = ["ASIN", "BRAND", "COUNTRY_CODE", "DISTRIBUTOR", "END_DATE", "EVENT_NAME", "GMID",
                         "PLATFORM", "PROMO_DISCOUNT_PERC", "START_DATE", "SUB_PLATFORM", "SKU"]
GMID_RIGHT_COUNTRIES = ["US", "GB", "CN", "ES", "DE"]


def media_plan(df: DataFrame, id_col: str = "ID", code_col: str = "PZN", file_col: str = "file_name",
               pos_col: str = "pos") -> DataFrame:
    """Q9: codes exploded (C1), duplicate ids suffixed per file in row order
    (C2), exact duplicates dropped per file (C7), files stacked (U3)."""
    x = cl.explode_codes(df, code_col, pos_name="__code_pos")
    x = cl.suffix_duplicate_ids(x, id_col, pos_col, ["__code_pos"], file_col)
    keep = [c for c in x.columns if c not in (pos_col, "__code_pos")]
    return x.select(*keep).dropDuplicates()


def sellout_long(wide: DataFrame, ids: Sequence[str], keys: Sequence[str] = ("Name", "PZN", "Hersteller"),
                 order: Sequence[str] = ("file_name", "pos")) -> DataFrame:
    """Q10: wide -> long (C3), then keep the first row per (keys, Date) in
    file order (C8)."""
    extra = [c for c in order if c not in ids]
    values = [c for c in wide.columns if c not in ids and c not in extra]
    long = cl.unpivot_dates(wide, [*ids, *extra], values=values)
    return cl.dedup_keep_first(long, [*keys, "Date"], list(order)).drop(*extra)


def sellout_files_long(groups: Sequence[DataFrame], n_ids: int = 7, lenient: bool = True,
                       keys: Sequence[str] = ("Name", "PZN", "Hersteller")) -> DataFrame:
    """Q10 over landed files (C4): each layout of ``read_two_row_header_csv`` is
    made long by itself, since files name their own dates; then the long
    forms are stacked and the first row per (keys, Date) in file order stays."""
    parts = []
    for g in groups:
        cols = [c for c in g.columns if c not in ("file_name", "pos")]
        parts.append(cl.unpivot_dates(g, [*cols[:n_ids], "file_name", "pos"], values=cols[n_ids:], lenient=lenient))
    long = append_all(parts, allow_missing=True)
    return cl.dedup_keep_first(long, [*keys, "Date"], ["file_name", "pos"]).drop("file_name", "pos")


def latest_inventory(df: DataFrame, file_col: str = "file_name",
                     keys: Sequence[str] = ("PZN", "Pck.", "Bezeichnung")) -> DataFrame:
    """Q11: rows of the files with the latest ``_dd.MM.yy`` date in the name
    (S9; the date is found from the distinct names), repeated header rows
    dropped, ``*Menge`` summed per row (C9) and per key with NULL keys dropped
    (A10), stamped with that date."""
    names = df.select(file_col).distinct().withColumn("__d", cl.date_ddmmyy(F.substring_index(F.col(file_col), "_", -1)))
    latest = names.agg(F.max("__d").alias("__d"))
    files = names.join(latest, "__d")
    x = df.join(files, file_col)
    return _inventory_sums(x, F.max("__d"), keys)


def _inventory_sums(x: DataFrame, date, keys: Sequence[str] = ("PZN", "Pck.", "Bezeichnung")) -> DataFrame:
    x = cl.skip_embedded_header(x, keys[0])
    x = cl.sum_suffix(x, "Menge", "ORDERED_UNITS")
    return sum_drop_null_keys(x, list(keys), ["ORDERED_UNITS"], extra=[date.alias("DATE")])


def latest_inventory_files(df: DataFrame, date) -> DataFrame:
    """Q11 over the files of the latest date, read with positions and paths:
    files whose first row holds the names take them from it (C6), then the sums."""
    x = cl.promote_embedded_header(df.drop("file_name"), "path", "pos")
    return _inventory_sums(x, F.lit(date))


def market_sellout(df: DataFrame, country: str, now) -> DataFrame:
    """Q12: ``*date`` yyyyMMdd -> ISO text (strict), '[NULL]' in ``*units`` /
    ``*value_eur`` -> NULL, audit columns, 'Year Month' NULL -> 0 int, rows
    with a non-numeric Year dropped, blank SKU dropped."""
    date_cols = [c for c in df.columns if c.endswith("date")]
    num_cols = [c for c in df.columns if c.endswith("units") or c.endswith("value_eur")]
    x = df.withColumns({c: cl.iso_date(c, strict=True) for c in date_cols})
    x = nz.null_tokens(x, num_cols, ["[NULL]"])
    x = nz.with_audit(x, country, now, ts_name="last_updated_timestamp")
    if "Year Month" in x.columns:
        x = x.withColumn("Year Month", cl.zero_int("Year Month"))
    if "Year" in x.columns:
        x = cl.require_numeric(x, "Year")
    if "SKU" in x.columns:
        x = cl.require_key(x, "SKU")
    return x


def promotions_table(df: DataFrame, country: str) -> DataFrame:
    """Q13: the three country branches of the promotions table."""
    if country == "US":
        return nz.upper_columns(df)
    x = nz.upper_columns(df, trim=True)
    if country != "CN":
        return x.withColumns({
            "COUNTRY_CODE": cl.recode("COUNTRY_CODE", "UK", "GB", substring=True),
            "START_DATE": nz.q("START_DATE").cast("string"),
            "END_DATE": nz.q("END_DATE").cast("string"),
            "GMID": cl.code_text("GMID")})
    start = cl.iso_date(F.col("CAMPAIGN_START_DATE").cast("string"), strict=False)
    end = cl.iso_date(F.col("CAMPAIGN_END_DATE").cast("string"), strict=False)
    x = x.withColumns({"ASIN": F.lit("NA"), "COUNTRY_CODE": F.lit("CN"),
                       "CAMPAIGN_START_DATE": start, "CAMPAIGN_END_DATE": end,
                       "START_DATE": start, "END_DATE": end, "EVENT_NAME": nz.q("EVENT NAME"),
                       "PROMO_DISCOUNT_PERC": F.lit(None).cast("double"), "GMID": cl.code_text("GMID")})
    return cl.project(x, PROMOTIONS_CN_COLUMNS)


def promotions_media(df: DataFrame, country: str) -> DataFrame:
    """Q13 media variant: CN campaign dates lenient yyyyMMdd -> ISO text."""
    if country != "CN":
        return df
    x = nz.upper_columns(df, trim=True)
    return x.withColumns({c: cl.iso_date(F.col(c).cast("string"), strict=False)
                          for c in ("CAMPAIGN_START_DATE", "CAMPAIGN_END_DATE")})


def sell_in(df: DataFrame, country: str) -> DataFrame:
    """Q14: upper-case names, MARKET ZZ -> CN for CN, GMID to its last six
    digits without leading zeros."""
    x = nz.upper_columns(df)
    if country == "CN" and "MARKET" in x.columns:
        x = x.withColumn("MARKET", cl.recode("MARKET", "ZZ", "CN"))
    if country in GMID_RIGHT_COUNTRIES and "GMID" in x.columns:
        x = x.withColumn("GMID", cl.code_right("GMID", 6))
    return x


def hero_mapping(df: DataFrame, columns: Sequence[str], filename: str,
                 translations: Mapping[str, str] = JP_BRANDS_TRANSLATION) -> DataFrame:
    """Q15: CATEGORY default NULL when absent, fixed projection (C19),
    '-' in SHIPPED_COGS -> '' (F15), brand translation (C18), FILENAME."""
    x = cl.project(df, columns, {"CATEGORY": F.lit(None).cast("string")})
    x = nz.null_tokens(x, ["SHIPPED_COGS"], ["-"], replacement="")
    x = x.withColumn("BRAND", cl.translate_values("BRAND", translations))
    return x.withColumn("FILENAME", F.lit(filename))
