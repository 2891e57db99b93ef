"""Large files cut into splits: results equal Spark's own whole-file readers."""
import json
import os
import random

import pytest

from shelfscope.sources import files as src
from shelfscope.sources import splits as sp
from pyspark.sql import functions as F


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes",
                                        "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # several pieces a split
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


WORDS = ['a}b', '{"k":[', 'q"uote', 'back\\slash', 'end\\', 'é漢😀', '', ']', '"dataBy":[{', 'x' * 900, '}\n{', '\\"', '},{"id":1}']


def element(r, depth=0):
    out = {"id": r.randrange(1000), "s": r.choice(WORDS), "t": r.choice(WORDS)}
    if depth < 2 and r.random() < 0.4:
        out["in"] = [element(r, depth + 1) for _ in range(r.randrange(3))]
    if r.random() < 0.2:
        out["dataBy"] = [{"id": -1, "s": "not the array"}]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_elements_of_one_document(small_splits, tmp_dir, seed):
    r = random.Random(seed)
    docs = []
    for k in range(3):
        items = [element(r) for _ in range(r.choice([0, 1, 40]))]
        doc = {"spec": {"type": "x", "list": [{"id": 5}], "dataBy": {"no": [1]}}, "dataBy": items, "tail": [{"id": 9}, "}"]}
        if seed % 2:
            doc = dict(reversed(list(doc.items())))
        with open(f"{tmp_dir}/d{k}.json", "w") as f:
            json.dump(doc, f, ensure_ascii=bool(k % 2), indent=k or None)
        docs += items
    got = sp.json_elements(small_splits, tmp_dir, "dataBy").collect()
    key = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(map(key, (json.loads(x.element) for x in got))) == sorted(map(key, docs))


def test_document_that_is_an_array_gz_empty_and_without_key(small_splits, tmp_dir):
    import gzip
    items = [{"id": i, "s": "}" * (i % 5)} for i in range(200)]
    os.mkdir(f"{tmp_dir}/a")
    with open(f"{tmp_dir}/a/x.json", "w") as f:
        f.write("\n " + json.dumps(items, indent=1) + "\n")
    got = sp.json_elements(small_splits, f"{tmp_dir}/a", None)
    assert sorted(json.loads(r.element)["id"] for r in got.collect()) == list(range(200))
    assert sp._text(small_splits, f"{tmp_dir}/a", "}").select("block").distinct().count() > 2  # read by many tasks
    small_splits.conf.set("spark.sql.files.maxPartitionBytes", "999")  # other splits from now on: the written ones count
    assert sorted(json.loads(r.element)["id"] for r in got.collect()) == list(range(200))
    with gzip.open(f"{tmp_dir}/y.json.gz", "wt") as f:
        json.dump({"rows": items}, f)
    assert sp.json_elements(small_splits, f"{tmp_dir}/y.json.gz", "rows").count() == 200
    for name, text in (("empty", ""), ("no", '{"other": [{"id": 1}]}'), ("none", '{"rows": []}'), ("null", '{"rows": null, "x": [{}]}'), ("plain", '{"rows": [1, "{", null]}')):
        with open(f"{tmp_dir}/{name}.json", "w") as f:
            f.write(text)
        assert sp.json_elements(small_splits, f"{tmp_dir}/{name}.json", "rows").collect() == []
    with open(f"{tmp_dir}/cut.json", "w") as f:
        f.write(json.dumps({"rows": items})[:2500])
    with pytest.raises(ValueError, match="ends inside"):
        sp.json_elements(small_splits, f"{tmp_dir}/cut.json", "rows")


@pytest.mark.parametrize("key", ["dataBy", None])
def test_gzip_documents_are_streamed_and_not_written_again(small_splits, tmp_dir, monkeypatch, key):
    """Several files a task, elements over the ends of pieces; beside plain documents only those are written."""
    import gzip
    r = random.Random(7)
    os.mkdir(f"{tmp_dir}/z")
    docs = []
    for k in range(6):
        items = [element(r) for _ in range((0, 1, 60, 40, 90, 3)[k])]
        doc = {"spec": {"list": [{"id": 5}], "dataBy": {"no": [1]}}, "dataBy": items, "tail": [{"id": 9}, "}"], "in": {"dataBy": [{"id": -2}]}}
        with gzip.open(f"{tmp_dir}/z/d{k}.json.gz", "wt") as f:
            json.dump(dict(reversed(list(doc.items()))) if k % 2 else doc, f, indent=k or None) if key else json.dump(items, f, indent=k or None)
        docs += items
    written = []
    real = sp._written
    monkeypatch.setattr(sp, "_written", lambda df, name: written.append(real(df, name)) or written[-1])
    same = lambda xs: sorted(json.dumps(x, sort_keys=True) for x in xs)
    got = lambda: same(json.loads(x.element) for x in sp.json_elements(small_splits, f"{tmp_dir}/z", key).collect())
    assert got() == same(docs) and not written
    more = [element(r) for _ in range(30)]
    with open(f"{tmp_dir}/z/plain.json", "w") as f:
        json.dump({"dataBy": more} if key else more, f)
    assert got() == same(docs + more) and {x.path[-10:] for x in written[0].select("path").distinct().collect()} == {"plain.json"}
    with gzip.open(f"{tmp_dir}/cut.json.gz", "wt") as f:
        f.write(json.dumps({"dataBy": docs} if key else docs)[:2500])
    with pytest.raises(Exception, match="ends inside"):
        sp.json_elements(small_splits, f"{tmp_dir}/cut.json.gz", key).collect()


def test_search_terms_document_equals_whole_file_reader(small_splits, tmp_dir):
    rows = [{"departmentName": f"d{i % 3}", "searchTerm": f'te"rm}} {i}', "searchFrequencyRank": i, "clickedAsin": f"A{i}", "clickShare": i / 7,
             "other": {"deep": ["}", {"x": 1}]}} for i in range(300)]
    with open(f"{tmp_dir}/t.json", "w") as f:
        json.dump({"reportSpecification": {"a": [{"b": 1}]}, "dataByDepartmentAndSearchTerm": rows}, f, indent=2)
    got = src.read_search_terms(small_splits, f"{tmp_dir}/t.json")
    whole = src.read_report_json(small_splits, f"{tmp_dir}/t.json", key="dataByDepartmentAndSearchTerm")
    cols = ["departmentName", "searchTerm", "searchFrequencyRank", "clickedAsin", "clickShare"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, whole.select(*cols).collect())) and got.count() == 300


def fields(r):
    return r.choice(["", "x", "plain text", 'say "hi"', '5" disk', '"quoted, with comma"', '"two\nlines"', '"three\n\nlines, of\n"', '"esc \\" aped"', '""', "é", '"a\\\\"',
                     '"un"escaped', "y" * 300])


@pytest.mark.parametrize("seed", range(3))
def test_csv_rows_and_positions_equal_the_whole_file_reader(small_splits, tmp_dir, seed):
    r = random.Random(seed)
    for k in range(3):
        with open(f"{tmp_dir}/f{k}.csv", "w", newline="") as f:
            for i in range(r.choice([1, 60, 150])):
                row = ",".join([str(i), fields(r), fields(r), fields(r)]) + "\n" + "\n" * (r.random() < 0.05)
                # Windows line ends: the whole-file reader keeps a return behind fields with stray quotes, which we do not
                f.write(row if k != 1 else row.replace('"un"escaped', "u").replace("\n\n", "\n").replace("\n", "\r\n"))
    schema = "c0 string, c1 string, c2 string, c3 string"
    whole = small_splits.read.schema(schema).option("multiLine", True).csv(tmp_dir).withColumn("path", F.col("_metadata.file_path"))
    want = src.numbered(whole, "path").select("path", "pos", "c0", "c1", "c2", "c3")
    table = sp.CsvFiles(small_splits, tmp_dir)
    got = table.read(sorted(table.rows), schema).select("path", "pos", "c0", "c1", "c2", "c3")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(got) == rows(want)
    assert table.rows == {x.path: x["count"] for x in want.groupBy("path").count().collect()}


def test_rfc_quotes_and_separator(small_splits, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        for i in range(80):
            f.write(f'{i};"a ""quoted"" word; and\na line {"z" * (i % 40)}";"back\\"\n')
    table = sp.CsvFiles(small_splits, tmp_dir, sep=";", escape='"')
    got = table.read(sorted(table.rows), "a int, b string, c string")
    assert got.count() == 80 and got.where("pos = a + 1 AND c = 'back\\\\' AND b LIKE 'a \"quoted\" word; and\na line%'").count() == 80


def test_skipped_rows_headers_and_footers(small_splits, tmp_dir):
    for k in range(2):
        with open(f"{tmp_dir}/x_{k} 0%.csv", "w") as f:
            f.write("title of the file\n" + ("ID,NAME\n" if k == 0 else "NAME,ID\n"))
            for i in range(100):
                f.write(f"{i},n{i}\n" if k == 0 else f"n{i},{i}\n")
    got = src.read_report_csv(small_splits, tmp_dir, skiprows=1, keep_position=True)
    assert got.count() == 200 and got.where("NAME = 'n' || ID AND pos = ID + 1").count() == 200
    assert {r.file_name for r in got.select("file_name").distinct().collect()} == {"x_0 0%.csv", "x_1 0%.csv"}
    table = sp.CsvFiles(small_splits, tmp_dir, 2)
    body = table.read(table.layouts()["title of the file", "ID,NAME"], "a string, b string", skip=2, footer=3)
    assert sorted(int(r.a) for r in body.collect()) == list(range(97))
    assert body.select(F.spark_partition_id()).distinct().count() > 1


def test_first_lines_come_from_the_start_of_a_file(small_splits, tmp_dir):
    for k in range(3):
        with open(f"{tmp_dir}/h {k}.csv", "w") as f:
            f.write("\n" * (k == 1) + f"A,B{k // 2}\n" + "1,2\n" * 1000)
    open(f"{tmp_dir}/none.csv", "w").close()
    got = sp.first_lines(small_splits, tmp_dir)
    assert {k: len(v) for k, v in got.items()} == {"A,B0": 2, "A,B1": 1}
    assert src.read_all(small_splits, tmp_dir).count() == 3000
