import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from shelfscope.plans import reports as r


def test_last_click_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    clicks, purchases = [], []
    for u in range(6):
        for _ in range(25):
            clicks.append((u, base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 5)), rnd.randrange(5)))
        for k in range(15):
            purchases.append((u * 100 + k, u, base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 5), seconds=30)))
    purchases.append((999, 42, base))  # a user without clicks
    cdf = spark.createDataFrame(clicks, "user_id int, click_ts timestamp_ntz, campaign_id int").withColumn(
        "advertised_sku", F.col("campaign_id"))
    pdf = spark.createDataFrame(purchases, "event_id int, user_id int, ts timestamp_ntz")
    got = {row.event_id: (row.click_ts, row.campaign_id) for row in r.last_click(pdf, cdf).collect()}
    for eid, u, ts in purchases:
        before = [c for c in clicks if c[0] == u and c[1] <= ts]
        want = max(before, key=lambda c: (c[1], c[2]))[1:] if before else (None, None)
        assert got[eid] == tuple(want), eid


def test_rank_desc_matches_sql_rank(spark):
    df = spark.createDataFrame([("a", 5), ("b", 9), ("c", 5), ("d", 1), ("e", 9)], "k string, v int")
    got = {row.k: row.rk for row in r.rank_desc(df, "v", "rk").collect()}
    assert got == {"b": 1, "e": 1, "a": 3, "c": 3, "d": 5}


def test_cumulative_reach_counts_each_user_once(spark):
    d = dt.date(2024, 1, 1)
    rows = [(1, "u1", d), (1, "u2", d), (1, "u1", d + dt.timedelta(1)), (1, "u3", d + dt.timedelta(2)),
            (1, "u1", d + dt.timedelta(2))]
    df = spark.createDataFrame(rows, "campaign_id int, user_id string, day date")
    out = [(row.cumulativeReach, row.impressionsFrequencyAverage)
           for row in r.cumulative_reach(df).orderBy("day").collect()]
    assert out == [(2, 1.0), (2, 1.5), (3, 5 / 3)]


def test_weekly_windows_equal_separate_runs(spark):
    from shelfscope import fixtures as fx
    from shelfscope.plans.clean_room import campaign_value
    from shelfscope.functions.brand import FIXTURE_BRAND_RULES
    d = "/root/testdata/sf0.001"
    base = fx.ad_base(spark, d)
    t, c = fx.ad_traffic(spark, d, base), fx.ad_conversions(spark, d, base)
    one = campaign_value(t, c, "2024-01-01", "2024-01-15", window_days=7, rules=FIXTURE_BRAND_RULES)
    parts = [campaign_value(t, c, s, e, rules=FIXTURE_BRAND_RULES)
             for s, e in (("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-15"))]
    norm = lambda df: sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())
    assert norm(one) == norm(parts[0].unionByName(parts[1]))


def test_report_runner_rejects_unknown_measures(spark):

    facts = spark.createDataFrame([(dt.date(2024, 1, 1), 1, 10, 2, 1.5)],
                                  "date date, campaign_id int, impressions bigint, clicks bigint, cost double")
    spec = r.ReportSpec(group_by=["campaignId"], columns=["date", "campaignId", "clicks", "clickThroughRate"])
    row = r.run_report(facts, spec).first()
    assert row.clicks == 2 and abs(row.clickThroughRate - 0.2) < 1e-12
    with pytest.raises(KeyError):
        r.run_report(facts, r.ReportSpec(group_by=[], columns=["kindleEditionNormalizedPagesRead14d"]))


def test_exact_percentiles_match_fraction_interpolation(spark):
    from fractions import Fraction
    rnd = random.Random(3)
    data = {k: [rnd.randrange(0, 50) for _ in range(rnd.randrange(1, 40))] for k in range(12)}
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "k int, v bigint")
    got = {row.k: (row.P70, row.P80, row.P90) for row in r.exact_percentiles(df, "k", "v").collect()}

    def pct(vs, p):
        s = sorted(vs)
        pos = (len(s) - 1) * Fraction(p)
        lo = int(pos)
        hi = s[lo + 1] if lo + 1 < len(s) else s[lo]
        return float(s[lo] + (hi - s[lo]) * (pos - lo))

    for k, vs in data.items():
        assert got[k] == (pct(vs, "0.7"), pct(vs, "0.8"), pct(vs, "0.9")), k


def test_view_through_credit_matches_brute_force(spark):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows, n = [], 0
    for u in (1, 2, 3, 4, None):
        for kind, k in (("click", 4), ("view", 12), (None, 15)):
            if (u, kind) in ((2, "click"), (3, "view")):
                continue
            for _ in range(k):
                n += 1
                rows.append((n, u, base + dt.timedelta(minutes=rnd.randrange(60 * 24 * 60), seconds=n), kind, 10 + n % 5))
    both = spark.createDataFrame(
        [(i, u, ts, kind, ts if kind else None, c if kind else None, c if kind else None, None if kind else c) for i, u, ts, kind, c in rows],
        "event_id int, user_id int, ts timestamp_ntz, touch string, click_ts timestamp_ntz, campaign_id int, advertised_sku int, sku int")
    got = {(x.event_id, x.by_view): (x.campaign_id, x.in_7d, x.same_sku) for x in r.attribute_views(both).collect()}
    want = {}
    for i, u, ts, kind, c in rows:
        if kind or u is None:
            continue
        last = {k: max(((t, cc) for _, uu, t, kk, cc in rows if uu == u and kk == k and t <= ts), default=None) for k in ("click", "view")}
        near = {k: last[k] is not None and ts - last[k][0] <= dt.timedelta(days=14) for k in last}
        if last["click"] and ts - last["click"][0] <= dt.timedelta(days=30):
            want[i, False] = (last["click"][1], ts - last["click"][0] <= dt.timedelta(days=7), c == last["click"][1])
        if near["view"] and not near["click"]:
            want[i, True] = (last["view"][1], ts - last["view"][0] <= dt.timedelta(days=7), c == last["view"][1])
    assert got == want and {v for _, v in got} == {True, False}
    assert any((i, True) in want and (i, False) in want for i, *_ in rows)  # a click too old for 14 days, and a view


def _lattice_input(spark):
    day = dt.date(2024, 1, 1)
    traffic = spark.createDataFrame(
        [(day, c, g, kind, 1.5, 60) for c, g in ((1, "a"), (1, "b"), (2, None)) for kind in ("view", "click", "view")]
        + [(day, 3, "a", "signup", 0.0, 0)],
        "day date, campaign_id int, ad_group string, event_type string, value double, progress int")
    won = spark.createDataFrame(
        [(day, 1, "a", 7, 10, 2, True, False), (day, 1, "a", None, 5, 1, False, False), (day, 2, None, 9, 3, 1, False, True)],
        "click_day date, campaign_id int, ad_group string, sku int, sales int, units int, same_sku boolean, by_view boolean")
    return traffic, won.select("*", *[F.lit(True).alias(f"in_{n}d") for n in r.WINDOW_DAYS]).withColumn(
        "sales", F.col("sales").cast("decimal(18,2)"))


def test_reports_of_a_lattice_equal_single_reports(spark, tmp_path):
    traffic, won = _lattice_input(spark)
    cols = ["date", "campaignId", "impressions", "clicks", "cost", "purchases", "sales7d"]
    specs = {"top": r.ReportSpec(["campaignId"], cols), "groups": r.ReportSpec(["campaignId", "adGroupName"], [*cols, "adGroupName"]),
             "one": r.ReportSpec(["campaignId"], cols, {"adGroupName": ["a"]}),
             "shown": r.ReportSpec(["campaignId"], cols, display=True),
             "bought": r.ReportSpec(["campaignId"], ["date", "campaignId", "purchasedAsin", "sales7d"])}
    made = r.run_reports(traffic, won, specs, str(tmp_path))
    rows = {n: sorted(map(tuple, df.collect()), key=str) for n, df in made.items()}
    day = dt.date(2024, 1, 1)
    assert rows["top"] == [(day, 1, 6, 2, 3.0, 2, 15.0), (day, 2, 3, 1, 1.5, 0, 0.0), (day, 3, 0, 0, 0.0, 0, 0.0)]
    assert rows["shown"] == [(day, 1, 6, 2, 3.0, 2, 15.0), (day, 2, 3, 1, 1.5, 1, 0.0), (day, 3, 0, 0, 0.0, 0, 0.0)]
    assert rows["one"] == [(day, 1, 3, 1, 1.5, 2, 15.0), (day, 3, 0, 0, 0.0, 0, 0.0)]
    assert rows["groups"][2][:6] == (day, 2, 3, 1, 1.5, 0)
    assert rows["bought"] == [(day, 1, 7, 10.0), (day, 1, None, 5.0)]  # what a view won is no row of a click report
    empty = r.run_reports(traffic.limit(0), won.limit(0), specs, str(tmp_path / "none"))
    assert [df.count() for df in empty.values()] == [0] * len(specs)


def test_facts_hold_only_what_a_report_reads(spark):
    traffic, won = _lattice_input(spark)
    spec = r.ReportSpec(["campaignId"], ["date", "campaignId", "clicks", "sales14d"])
    facts = r.ad_facts(traffic, won.drop("by_view"), spec.dims(), wanted=spec.needs())
    assert set(facts.columns) == {"date", "campaign_id", "clicks", "sales14d"}
    assert sorted(map(tuple, r.run_report(facts, spec, summed=True).collect())) == sorted(map(tuple, r.run_report(facts, spec).collect()))
    with pytest.raises(ValueError):
        r.run_report(facts, r.ReportSpec(["campaignId"], ["date", "campaignId", "cumulativeReach"]))
