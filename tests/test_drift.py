"""Documents of unlike shape against pandas' own flattening."""

import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfscope.sources.drift import flatten_variant, read_variant_documents, variant_leaves

DOCS = [
    {"id": 1, "a": {"x": 1, "y": None}, "tags": [1, {"q": 2}], "e": {}},
    {"id": "z", "a": "t", "d": 1.5},
    {"a": {"x": {"deep": True}}, "d": 1000.0, "n": None},
    {"id": 2.25, "a": {"x": [1, 2], "y": "w"}, "tags": []},
    {"a": ["u"], "o": {"p q": {"r.s": "dots"}, "it's": 3}},
    {},
]


def _land(tmp_dir, name, text):
    with open(os.path.join(tmp_dir, name), "w") as f:
        f.write(text)
    return os.path.join(tmp_dir, name)


def _text(v):
    if isinstance(v, (list, dict)):
        return json.dumps(v, separators=(",", ":"))
    if isinstance(v, bool):
        return str(v).lower()
    if v is None or v != v:
        return None
    try:  # pandas makes integers of a column with gaps floats
        return repr(float(v))
    except ValueError:
        return str(v)


def _same_as_pandas(df, docs):
    want = pd.json_normalize(docs)
    names = sorted(want.columns)
    assert sorted(df.columns) == names
    got = df.select(*[F.col(f"`{c}`").cast("double" if c == "d" else "string").cast("string") for c in names]).collect()
    expect = [tuple(_text(v) for v in row) for row in want[names].astype(object).itertuples(index=False)]
    order = lambda rows: sorted(rows, key=repr)
    assert order(tuple(_text(v) for v in r) for r in got) == order(expect)


@pytest.mark.parametrize("form", ["lines", "array", "files", "key"])
def test_equals_json_normalize(spark, tmp_dir, form):
    if form == "lines":
        df = read_variant_documents(spark, _land(tmp_dir, "d.jsonl", "\n\n".join(json.dumps(x) for x in DOCS)), lines=True)
    elif form == "array":
        df = read_variant_documents(spark, _land(tmp_dir, "d.json", json.dumps(DOCS, indent=2)))
    elif form == "files":
        df = read_variant_documents(spark, [_land(tmp_dir, f"d{i}.json", "\n " + json.dumps(x, indent=1)) for i, x in enumerate(DOCS)])
    else:
        df = read_variant_documents(spark, _land(tmp_dir, "d.json", json.dumps({"head": {"rows": 1}, "rows": DOCS})), key="rows")
    assert df.where("malformed IS NOT NULL").count() == 0
    _same_as_pandas(flatten_variant(df), DOCS)


def test_types_hold_all_values(spark, tmp_dir):
    lines = ['{"i":1,"m":1,"t":"x","b":true,"n":null,"v":1}', '{"i":9000000000,"m":2.5,"t":"","b":false,"v":"1"}', '{"m":1e3}']
    df = flatten_variant(read_variant_documents(spark, _land(tmp_dir, "d", "\n".join(lines)), lines=True))
    kinds = dict(df.dtypes)
    assert kinds == {"b": "boolean", "i": "bigint", "m": "double", "n": "string", "t": "string", "v": "string"}
    assert sorted(r.m for r in df.collect()) == [1.0, 2.5, 1000.0]


def test_malformed_documents_are_kept_aside(spark, tmp_dir):
    lines = ['{"a":1}', '{"a":', "5", "null", '"s"', '{"a":1,"a":2}', "  ", "{} x", '{"a":1}{"a":2}', '{"a":1},{"a":2}', '{"a":1}]', '[{"a":2}, 7, null]', "[]"]
    df = read_variant_documents(spark, _land(tmp_dir, "d", "\n".join(lines)), lines=True)
    assert sorted(r.malformed for r in df.where("malformed IS NOT NULL").collect()) == sorted(
        ['{"a":', "5", "null", '"s"', '{"a":1,"a":2}', "{} x", '{"a":1}{"a":2}', '{"a":1},{"a":2}', '{"a":1}]', "7", "null"])
    flat = flatten_variant(df, keep=["malformed"])
    assert flat.columns == ["malformed", "a"] and sorted(r.a for r in flat.where("malformed IS NULL").collect()) == [1, 2]


def test_names_that_clash_and_odd_names(spark, tmp_dir):
    doc = {"Id": 1, "id": "b", "a.b": 2, "a": {"b": 3, "": 4, "x?'\"": 5, "[0]": 6}, "path": "p", "0": 7, "`": 8, "back\\": 9}
    df = read_variant_documents(spark, _land(tmp_dir, "d", json.dumps(doc)), lines=True)
    flat = flatten_variant(df, keep=["path"])
    row = dict(zip(flat.columns, flat.toDF(*[f"c{i}" for i in range(len(flat.columns))]).first()))
    row.pop("path")
    assert row == {"0": 7, "Id": 1, "id__2": "b", "`": 8, "a.": 4, "a.[0]": 6, "a.b": 3, "a.x?'\"": 5, "a.b__2": 2, "back\\": 9, "path__2": "p"}


def test_whole_paths_arrays_and_empty_tables(spark, tmp_dir):
    docs = [{"by": {f"k{i}": i}, "rows": [{"n": i}, i]} for i in range(30)]
    df = read_variant_documents(spark, _land(tmp_dir, "d", json.dumps(docs)))
    assert [p for p, _, _ in variant_leaves(df, whole=["by"])] == [("by",), ("rows",)]
    assert len(variant_leaves(df)) == 31
    flat = flatten_variant(df, whole=["by"], arrays="variant")
    again = flat.select(F.explode(F.expr("CAST(rows AS ARRAY<VARIANT>)")).alias("doc")).where("schema_of_variant(doc) LIKE 'OBJECT%'")
    assert sorted(r.n for r in flatten_variant(again).collect()) == list(range(30))
    assert {r.by for r in flat.collect()} == {json.dumps(d["by"], separators=(",", ":")) for d in docs}
    none = read_variant_documents(spark, _land(tmp_dir, "none", "\n"), lines=True)
    assert flatten_variant(none, keep=["path"]).columns == ["path"] and none.count() == 0
    with pytest.raises(TypeError):
        variant_leaves(spark.sql("SELECT parse_json('5') AS doc"))
