import glob

import duckdb
import pytest

from shelfscope.registry import load_all
from shelfscope.queries import landed

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name, table, odd, pattern, rows, extra", [
    ("q10_sellout_from_files", "part", "true", "sellout/1_january/**/part-*.csv", 50, 4),
    ("q11_latest_inventory_files", "lineitem", "l_suppkey % 2 = 1", "inventory/named/**/part-*.csv", 20, 2)])
def test_more_rows_make_more_files_of_bounded_size(spark, monkeypatch, tmp_path, name, table, odd, pattern, rows, extra):
    monkeypatch.setattr(landed, "ROWS_A_FILE", rows, raising=False)
    monkeypatch.setattr(landed, "_scratch", lambda _, what: f"{tmp_path}/{what}")
    con = duckdb.connect()
    some = f"l_shipdate > (SELECT max(l_shipdate) - INTERVAL 20 DAY FROM '{SF}/lineitem.parquet')" if table == "lineitem" else "true"
    con.execute(f"COPY (SELECT * FROM '{SF}/{table}.parquet' WHERE {some}) TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet'")
    entry = load_all()[name]
    got, want = entry.fn(spark, str(tmp_path)), con.sql(entry.oracle)
    text = lambda r: str([str(x) for x in r])
    assert sorted(text(r) for r in got.select(*[f"`{c}`" for c in want.columns]).collect()) == sorted(text(r) for r in want.fetchall())
    sizes = [sum(1 for _ in open(f)) - extra for f in glob.glob(f"{tmp_path}/{pattern}", recursive=True)]
    total = con.sql(f"SELECT count(*) FROM {table} WHERE {odd}").fetchall()[0][0]
    assert sum(sizes) == total and len(sizes) >= total / rows and max(sizes) <= 4 * rows
