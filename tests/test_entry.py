import duckdb

import __spark_entry__ as entry_mod
from shelfscope.fixtures import TABLES
from shelfscope.registry import load_all

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "reach" in df.columns and "cost_sum" in df.columns


def test_every_query_has_a_callable_and_oracles_are_subset():
    qs, orc = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(orc) <= set(qs)
    # every query of the registry carries a DuckDB oracle (the optional
    # subpackage has operators that SQL can't express)
    assert set(load_all()) <= set(orc)


def _rows(rows):
    def norm(v):
        if v is None:
            return (0, "")
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return (1, round(float(v), 6))
        return (2, str(v))
    return sorted(tuple(norm(v) for v in r) for r in rows)


def test_selected_queries_match_oracle_at_small_scale(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    qs, orc = entry_mod.queries(), entry_mod.oracle_sql()
    for name in ["q1_campaign_value", "q2_ad_type_overlap", "q3_path_to_purchase", "q4_subscription_sales",
                 "p7_last_saturday", "r2_attribution_windows", "q9_media_plan"]:
        sdf = qs[name](spark, SF)
        cols = sorted(sdf.columns)
        s_rows = _rows(sdf.select(*cols).collect())
        rel = con.sql(orc[name])
        d_rows = _rows(con.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM rel").fetchall())
        assert s_rows == d_rows, name


def test_plain_sql_equals_dataframe_form(spark):
    """Joins before aggregation and COUNT(DISTINCT), written in SQL over the
    same views, give the counts and sums of the re-planned DataFrame version."""
    from shelfscope import fixtures as fx
    from shelfscope.functions.brand import FIXTURE_BRAND_RULES
    from shelfscope.plans.clean_room import campaign_value
    base = fx.ad_base(spark, SF)
    t, c = fx.ad_traffic(spark, SF, base), fx.ad_conversions(spark, SF, base)
    t.createOrReplaceTempView("seen")
    c.createOrReplaceTempView("won")
    got = campaign_value(t, c, "2024-01-01", "2024-02-01", rules=FIXTURE_BRAND_RULES).groupBy("campaign_id_string").agg(
        {"impressions_sum": "sum", "clicks_sum": "sum", "units_sold_sum": "sum"}).collect()
    want = spark.sql("""
        WITH n AS (SELECT campaign_id_string AS cid, count(*) AS n FROM (SELECT DISTINCT advertiser, currency_iso_code, campaign,
                     campaign_id_string, ad_product_type FROM seen) GROUP BY 1),
        s AS (SELECT campaign_id_string AS cid, sum(impressions) AS i, sum(clicks) AS k FROM seen WHERE user_id IS NOT NULL GROUP BY 1),
        w AS (SELECT campaign_id_string AS cid, sum(units_sold) AS u FROM won WHERE user_id IS NOT NULL GROUP BY 1)
        SELECT n.cid, coalesce(i, 0) * n AS i, coalesce(k, 0) * n AS k, coalesce(u, 0) * n AS u
        FROM n LEFT JOIN s ON n.cid = s.cid LEFT JOIN w ON n.cid = w.cid WHERE i IS NOT NULL OR u IS NOT NULL""").collect()
    norm = lambda rows: sorted((r[0], *sorted(int(x) for x in r[1:])) for r in rows)
    assert norm(got) == norm(want)
    qs, orc = entry_mod.queries(), entry_mod.oracle_sql()
    for tab in TABLES:
        fx.table(spark, SF, tab).createOrReplaceTempView(tab)
    a = spark.sql(orc["q4_subscription_sales"].replace("VARCHAR", "STRING").replace("//", "DIV"))
    b = qs["q4_subscription_sales"](spark, SF)
    cols = sorted(b.columns)
    assert _rows(a.select(*cols).collect()) == _rows(b.select(*cols).collect())
