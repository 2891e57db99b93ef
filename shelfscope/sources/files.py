"""Landed-file sources.

Readers are Spark's own (JSON, CSV, ORC, Parquet, binaryFile listings); gzip
is decoded by the codec from the file suffix.  The source file and the row
position inside it are kept as columns where later steps need file order.
Listings read paths only (``binaryFile`` with the ``content`` column pruned).
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.setops import append_all
from ..schemas import SEARCH_TERMS_FIELDS
from .splits import CsvFiles, first_lines, json_elements

FILE_COL = "file_name"
POS_COL = "pos"
# ``name_<date>.<ext>`` as a file or as the directory Spark writes it to
DATED_NAME = r"_([^_/]+?)\.(?:csv|parquet|orc|json|gz|xlsx)(?:/|$)"


def read_report_json(spark: SparkSession, path: str | Sequence[str], key: str | None = None,
                     schema: StructType | None = None, multi_line: bool = True) -> DataFrame:
    """Report documents (``.json`` or ``.json.gz``).  With ``key`` the
    array under that key is exploded to one row per record (record fields as
    columns); documents without records give no rows.  ``multi_line=False``
    reads JSON Lines (one document per line, splittable when uncompressed).

    With ``key`` and ``schema`` (that of the document, which holds the array) a document is cut into its elements
    by many tasks (see ``splits.json_elements``); without a schema Spark reads each document whole."""
    if key is not None and schema is not None and multi_line:
        element = schema[key].dataType.elementType
        return json_elements(spark, path, key).select(F.from_json("element", element).alias("__rec")).select("__rec.*")
    r = spark.read.option("multiLine", multi_line)
    if schema is not None:
        r = r.schema(schema)
    df = r.json(path if isinstance(path, str) else list(path))
    if key is None:
        return df
    return df.select(F.explode(F.col(key)).alias("__rec")).select("__rec.*")


def read_report_orc(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Columnar ORC report."""
    return spark.read.orc(path if isinstance(path, str) else list(path))


def _names(line: str) -> list[str]:
    import csv
    return next(csv.reader([line]), [])


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def _text_schema(names: Sequence[str]) -> str:
    return ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)


def read_report_csv(spark: SparkSession, path: str | Sequence[str], skiprows: int = 0,
                    schema: StructType | str | None = None, keep_position: bool = False,
                    path_col: str | None = None) -> DataFrame:
    """S3: CSV report with a header.  ``skiprows`` leading lines (before the
    header) are dropped.  Every file is read under its own header (files of
    one layout in one read) and the layouts are stacked by name.  With
    ``skiprows`` or ``keep_position`` (adds the file name and the 1-based
    data-row position; ``path_col`` also the whole path) rows are counted by split
    (``splits.CsvFiles``), so a large file is still read by many tasks."""
    if skiprows == 0 and not keep_position:
        if schema is not None:
            return spark.read.option("header", True).schema(schema).csv([path] if isinstance(path, str) else list(path))
        parts = [spark.read.schema(_text_schema(_names(head))).option("header", True).csv([unquote(f) for f in files])
                 for head, files in first_lines(spark, path).items()]
    else:
        parts, table = [], CsvFiles(spark, path, skiprows + 1)
        for head, files in table.layouts().items():
            if len(head) <= skiprows:
                raise ValueError(f"no header line in {files[0]}")
            names = schema if isinstance(schema, str) else _ddl(schema) if schema is not None else _text_schema(_names(head[skiprows]))
            parts.append(table.read(files, names, skip=skiprows + 1).withColumn(POS_COL, F.col(POS_COL) - (skiprows + 1))
                         .withColumnRenamed("path", path_col or "__path"))
    if not parts:
        raise FileNotFoundError(f"no rows under {path}")
    out = append_all(parts, allow_missing=True)
    out = out if path_col else out.drop("__path")
    return out if keep_position or skiprows == 0 else out.drop(FILE_COL, POS_COL)


def numbered(df: DataFrame, file_key: str = FILE_COL) -> DataFrame:
    """1-based row position within each source file (``file_key``: a column
    naming the file; use the full path when names can repeat across folders).

    Needs each file read whole and in order (``multiLine`` text sources):
    ``monotonically_increasing_id`` then grows along a file inside one task;
    subtracting the file's minimum (an aggregate with one row per file, not
    a window over the file) gives the position."""
    x = df.withColumn("__id", F.monotonically_increasing_id())
    first = x.groupBy(file_key).agg(F.min("__id").alias("__first"))
    j = x.join(first, file_key)
    return j.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__id") - F.col("__first") + 1).alias(POS_COL))


def read_report(spark: SparkSession, path: str, **kw) -> DataFrame:
    """Dispatch on the file suffix; an unknown suffix fails."""
    p = path.lower()
    if p.endswith(".orc"):
        return read_report_orc(spark, path)
    if p.endswith(".gz") or p.endswith(".json"):
        return read_report_json(spark, path, **kw)
    if p.endswith(".csv"):
        return read_report_csv(spark, path, **kw)
    raise ValueError(f"unsupported report file: {path}")


def read_table(spark: SparkSession, cfg: dict) -> DataFrame:
    """Warehouse table by ``database.schema.table`` from a config dict."""
    parts = [cfg[k] for k in ("database", "schema", "table") if cfg.get(k)]
    return spark.table(".".join(parts))


def run_country_sql(spark: SparkSession, cfg: dict, country: str, args: dict | None = None) -> DataFrame:
    """The per-country SQL text of a config, with bound parameters."""
    return spark.sql(cfg[country]["sql_query"], args=args or {})


def listing(spark: SparkSession, prefix: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Paths under a prefix (no file content is read)."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(prefix).select("path", "modificationTime", "length")


def latest_file(spark: SparkSession, prefix: str, glob: str | None = None) -> DataFrame:
    """The greatest path by *string* order (as the reference does) and
    the date text after its last ``_`` (one row)."""
    ls = listing(spark, prefix, glob)
    return ls.agg(F.max("path").alias("path")).select(
        "path", F.regexp_extract(F.col("path"), DATED_NAME, 1).alias("file_date"))


def read_all(spark: SparkSession, paths: str | Sequence[str], fmt: str = "csv", path_col: str | None = None, **options) -> DataFrame:
    """Every file of a table, the file name as a column (``path_col``: the
    whole path too).  CSV files are read under their own headers and stacked
    by name (a column that a file lacks is NULL there)."""
    extra = {path_col: F.col("_metadata.file_path")} if path_col else {}
    where = paths if isinstance(paths, str) else list(paths)
    if fmt != "csv" or str(options.get("header", True)).lower() == "false":
        return spark.read.format(fmt).options(**options).load(where).withColumns({FILE_COL: F.col("_metadata.file_name"), **extra})
    parts = [spark.read.options(**{**options, "header": True}).schema(_text_schema(_names(head))).csv([unquote(f) for f in files])
             .withColumns({FILE_COL: F.col("_metadata.file_name"), **extra})
             for head, files in first_lines(spark, where).items()]
    if not parts:
        raise FileNotFoundError(f"no rows under {paths}")
    return append_all(parts, allow_missing=True)


def dated_files(spark: SparkSession, prefix: str, fmt: str = "dd.MM.yy", glob: str | None = None) -> DataFrame:
    """File paths with the date at the end of their name (``name_<date>.ext``)."""
    from ..functions.cleaning import date_ddmmyy
    ls = listing(spark, prefix, glob)
    text = F.regexp_extract(F.col("path"), DATED_NAME, 1)
    d = date_ddmmyy(text) if fmt == "dd.MM.yy" else F.try_to_date(text, fmt)
    return ls.select("path", d.alias("file_date"))


def latest_dated_paths(spark: SparkSession, prefix: str, fmt: str = "dd.MM.yy", glob: str | None = None):
    """The latest date among the file names and the files that carry it (a
    listing: no file is opened; the list is metadata)."""
    files = dated_files(spark, prefix, fmt, glob)
    latest = files.agg(F.max("file_date")).first()[0]
    paths = [r.path for r in files.where(F.col("file_date") == latest).select("path").collect()]
    if not paths:
        raise FileNotFoundError(f"no dated files under {prefix}")
    return latest, sorted(paths)


def read_latest_dated(spark: SparkSession, prefix: str, fmt: str = "dd.MM.yy", reader: str = "csv",
                      glob: str | None = None, **options) -> DataFrame:
    """Only the files whose name carries the latest date, each under its own header."""
    latest, paths = latest_dated_paths(spark, prefix, fmt, glob)
    return read_all(spark, paths, reader, **options).withColumn("file_date", F.lit(latest))


def read_search_terms(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """The large search-terms document: only the eight projected fields
    of each ``dataByDepartmentAndSearchTerm`` element (the schema prunes the
    rest at parse time)."""
    from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField
    types = {"searchFrequencyRank": LongType(), "clickShareRank": LongType(), "clickShare": DoubleType(),
             "conversionShare": DoubleType()}
    el = StructType([StructField(f, types.get(f, StringType())) for f in SEARCH_TERMS_FIELDS])
    schema = StructType([StructField("dataByDepartmentAndSearchTerm", ArrayType(el))])
    return read_report_json(spark, path, key="dataByDepartmentAndSearchTerm", schema=schema, multi_line=multi_line)


def landed_dates(spark: SparkSession, prefix: str, exts: Sequence[str] = ("csv", "parquet")) -> DataFrame:
    """Dates already landed for a table: the text after the last ``_``
    of every ``.csv`` / ``.parquet`` file name under the prefix (a prefix
    match, so archived files under ``processed/`` count too)."""
    ls = listing(spark, prefix)
    ext_ok = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(list(exts))
    return (ls.where(ext_ok)
            .select(F.regexp_extract(F.col("path"), DATED_NAME, 1).alias("landed_date")).distinct())


def landed_names(spark: SparkSession, prefix: str, exts: Sequence[str] = ("csv", "parquet", "xlsx")) -> DataFrame:
    """S11, second form: the names (without suffix) of all files of a table,
    spreadsheets included; a folder that Spark wrote counts as its file."""
    name = F.regexp_extract(F.col("path"), r"([^/]+)\.(?:" + "|".join(exts) + r")(?:/[^/]*)?$", 1)
    return listing(spark, prefix).select(name.alias("name")).where("name <> ''").distinct()


def read_two_row_header_csv(spark: SparkSession, paths: str | Sequence[str], n_fixed: int = 7,
                            footer: int = 2, drop_last: bool = True) -> list[DataFrame]:
    """C4 + C5 on landed sell-out files: the first ``n_fixed`` columns are
    named by the second header row, the rest by the first; the second header
    row, the last ``footer`` rows of every file and (optionally) the last
    column are dropped.  One DataFrame for each pair of header rows that occurs, since
    files name their own dates; positions (``file_name``, ``pos``) are kept for
    keep-first rules downstream."""
    out, table = [], CsvFiles(spark, paths, 2)
    for head, files in table.layouts().items():
        if len(head) < 2:
            raise ValueError(f"no second header row in {files[0]}")
        first, second = _names(head[0]), _names(head[1])
        last = len(first) - 1 if drop_last else len(first)
        names = [(second[i] if i < n_fixed and i < len(second) and second[i] else first[i]) for i in range(last)]
        body = table.read(files, _text_schema([f"c{i}" for i in range(len(first))]), skip=2, footer=footer)
        out.append(body.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)], FILE_COL, POS_COL))
    return out
