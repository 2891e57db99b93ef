"""Report documents of unlike shape (S1, F1, F12) as one flat table.

Fields come and go between documents, and one field may be a text here and an object there.  Documents are parsed once
into VARIANT values, which need no schema, and kept in the shared folder; their common schema is an aggregate over
them, combined map-side, instead of an inference read of all text.  Where an object meets another kind of value, the
objects and the rest are summed up apart, one more aggregate for each level of nesting at which that happens.  The flat
table then is one projection: a column for each path, named with dots, NULL where a document lacks it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.normalize import q
from ..session import scratch_path
from .splits import json_elements

Path = tuple[str, ...]


def read_variant_documents(spark: SparkSession, paths: str | Sequence[str], key: str | None = None,
                           lines: bool = False) -> DataFrame:
    """One row a document: path, doc (a VARIANT object) and malformed (the text of what is no object, else NULL).

    A file is one document, or an array of them.  ``lines``: a document a line.  ``key``: the elements of the array
    under that key, cut out of documents of any size by many tasks (``splits.json_elements``, which leaves plain
    values out).  Not JSON, cut short, followed by more text, a repeated name within one object, no object, or beyond
    Spark's limit for a VARIANT: kept aside as malformed.  Blank lines and files are no documents; no files' rows: an empty table.  The text
    is parsed when this is called, the parsed table lies in the shared folder."""
    where = paths if isinstance(paths, str) else list(paths)
    if key is not None:
        text = json_elements(spark, where, key).select("path", F.col("element").alias("text"))
    else:
        text = spark.read.text(where, wholetext=not lines).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    # Spark's parser stops behind the first value; a mark that no text holds tells whether the text ends there
    mark = uuid.uuid4().hex
    wrapped = F.try_parse_json(F.concat(F.lit("["), "text", F.lit(f',"{mark}"]')))
    text = text.where(r"text RLIKE '\\S'").withColumn("all", wrapped)
    text = text.select("path", "text", F.when(F.try_variant_get("all", "$[1]", "string") == mark, F.variant_get("all", "$[0]", "variant")).alias("doc"))
    listed = F.col("doc").isNotNull() & F.col("text").rlike(r"^\s*\[")
    # a document is an array of one, an array of documents is itself
    each = F.explode_outer(F.when(listed, F.expr("try_cast(doc AS ARRAY<VARIANT>)")).otherwise(F.array("doc")))
    rows = text.withColumn("listed", listed).where(~F.col("listed") | F.expr("size(try_cast(doc AS ARRAY<VARIANT>)) > 0"))
    rows = rows.select("path", "listed", "text", each.alias("doc"))
    is_object = F.when(F.col("listed"), _is_object(F.col("doc"))).otherwise(F.col("doc").isNotNull() & F.col("text").rlike(r"^\s*\{"))
    raw = F.when(F.col("listed"), F.coalesce(F.to_json("doc"), F.lit("null"))).otherwise(F.col("text"))
    out = rows.select("path", F.when(is_object, F.col("doc")).alias("doc"), F.when(~F.coalesce(is_object, F.lit(False)), raw).alias("malformed"))
    table = scratch_path(spark, f"documents-{uuid.uuid4().hex}")
    out.write.parquet(table)
    return spark.read.schema(T.StructType([T.StructField(f.name, f.dataType) for f in out.schema.fields])).parquet(table)


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT<"), F.lit(False))


def _type(text: str | None) -> T.DataType:
    """The type that a schema text names; objects are structs."""
    if text is None:
        return T.NullType()
    return T.DataType.fromDDL(re.sub(r"(`(?:[^`]|``)*`)|OBJECT<", lambda m: m[1] or "STRUCT<", text))


def _steps(path: Path) -> str | None:
    """The path in Spark's path language; None where a name cannot be written in it."""
    out = "$"
    for name in path:
        if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
            out += f".{name}"
        elif not name or re.search(r"[?\\\x00-\x1f]", name) or ("'" in name and '"' in name):
            return None
        else:
            out += f'["{name}"]' if "'" in name else f"['{name}']"
    return out


def _at(doc: Column, path: Path) -> Column:
    """The VARIANT at ``path``, NULL where there is none."""
    steps = _steps(path)
    if steps is not None:
        return F.variant_get(doc, steps, "variant")
    for name in path:
        doc = F.try_element_at(doc.try_cast("map<string,variant>"), F.lit(name))
    return doc


def variant_leaves(docs: DataFrame, col: str = "doc", whole: Iterable[str] = ()) -> list[tuple[Path, T.DataType, bool]]:
    """Every path that holds a value other than an object, its type, and whether objects occur there as well.

    Types are those that hold all values of a path: BIGINT and DECIMAL widen, DECIMAL and DOUBLE are DOUBLE, unlike
    kinds are VARIANT; a path that only holds null is NullType.  Empty objects have no path.  Paths named in ``whole``
    (dotted; say, objects that are keyed by data) are not descended into: VARIANT.  The work is one aggregate over all
    documents, and one more for each level at which objects meet other values; the paths come back to the driver."""
    whole, doc = set(whole), q(col)
    found: list[tuple[Path, T.DataType, bool]] = []
    mixed: list[Path] = []

    def walk(kind: T.DataType, path: Path) -> None:
        if ".".join(path) in whole:
            found.append((path, T.VariantType(), False))
        elif isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f.dataType, (*path, f.name))
        elif isinstance(kind, T.VariantType):
            mixed.append(path)
        else:
            found.append((path, kind, False))

    top = docs.agg(F.schema_of_variant_agg(doc)).first()[0]
    kind = _type(top)
    if not isinstance(kind, (T.StructType, T.NullType)):
        raise TypeError(f"{col} holds values other than objects")
    if isinstance(kind, T.StructType):
        walk(kind, ())
    while mixed:
        paths, mixed = mixed, []
        aggs = []
        for p in paths:
            at = _at(doc, p)
            aggs += [F.schema_of_variant_agg(F.when(_is_object(at), at)), F.schema_of_variant_agg(F.when(~_is_object(at), at))]
        got = docs.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggs)]).first()
        for i, p in enumerate(paths):
            objects, rest = _type(got[2 * i]), _type(got[2 * i + 1])
            has = isinstance(objects, T.StructType)
            found.append((p, rest, has))
            if has:
                walk(objects, p)
    return sorted(found, key=lambda x: x[0])


def flatten_variant(docs: DataFrame, col: str = "doc", keep: Sequence[str] = (), whole: Iterable[str] = (),
                    arrays: str = "text") -> DataFrame:
    """F1 and F12 over VARIANT documents: the columns ``keep``, then one column a path in the order of the paths' names.

    Values of unlike kinds are text (strings as they are, others as JSON writes them); arrays are JSON text, or VARIANT
    with ``arrays='variant'`` (cast to ``array<variant>`` and explode to go on).  Of names that are equal but for case, or
    that a path shares with a kept column or another path (``a.b`` and ``b`` in ``a``), the later ones end in ``__2``,
    ``__3``.  A row without a document keeps its row; an empty table gives the kept columns."""
    if arrays not in ("text", "variant"):
        raise ValueError(f"unknown arrays {arrays!r}")
    taken, cols = {c.lower() for c in keep}, [q(c) for c in keep]
    for path, kind, objects in variant_leaves(docs, col, whole):
        at = _at(q(col), path)
        value = F.when(~_is_object(at), at) if objects else at
        if isinstance(kind, T.ArrayType):
            out = value if arrays == "variant" else F.variant_get(value, "$", "string")
        elif isinstance(kind, (T.VariantType, T.NullType)):
            out = F.variant_get(value, "$", "string")
        else:
            out = F.variant_get(value, "$", kind.simpleString())
        base = name = ".".join(path)
        n = 1
        while name.lower() in taken:
            n += 1
            name = f"{base}__{n}"
        taken.add(name.lower())
        cols.append(out.alias(name))
    return docs.select(*cols)
