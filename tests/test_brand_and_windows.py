import random

from pyspark.sql import functions as F

from shelfscope.functions.brand import (FIXTURE_BRAND_RULES, REFERENCE_BRAND_RULES, brand_array, brand_case, classify_indexed,
                                        map_ad_type)
from shelfscope.operators.windows import rank_first_touch
from shelfscope.plans.clean_room import brand_lookup


def _creatives(spark, rows):
    return spark.createDataFrame(
        [("2024-01-01", "2024-02-01", adv, "USD", camp, "1", cr, "sponsored_products") for adv, camp, cr in rows],
        "time_window_start string, time_window_end string, advertiser string, currency_iso_code string, "
        "campaign string, campaign_id_string string, creative string, ad_product_type string")


def test_max_label_quirk(spark):
    # 'UNCLASSIFIED' beats 'Allegra' but loses to 'Unisom'
    a = brand_lookup(_creatives(spark, [("x", "c", "allegra ad"), ("x", "c", "plain")])).first().brand
    u = brand_lookup(_creatives(spark, [("x", "c", "unisom ad"), ("x", "c", "plain")])).first().brand
    assert (a, u) == ("UNCLASSIFIED", "Unisom")
    p = brand_lookup(_creatives(spark, [("x", "c", "allegra ad"), ("x", "c", "plain")]),
                     prefer_classified=True).first().brand
    assert p == "Allegra"


def test_case_and_array_forms_agree(spark):
    df = spark.createDataFrame([("Allegra Inc", "act now", "c"), ("x", "y", "Red Widget"), (None, None, None),
                                ("icy hot", "", "z"), ("p", "xyzal", "act")],
                               "advertiser string, creative string, campaign string")
    for rules in (REFERENCE_BRAND_RULES, FIXTURE_BRAND_RULES):
        a = [r.b for r in df.select(brand_case(rules).alias("b")).collect()]
        b = [r.b for r in df.select(brand_array(rules).alias("b")).collect()]
        assert a == b
    assert [r.b for r in df.select(brand_case().alias("b")).collect()] == \
        ["Allegra", "UNCLASSIFIED", "UNCLASSIFIED", "Icy Hot", "Xyzal"]


def test_ad_type_maps(spark):
    df = spark.createDataFrame([("DSP",), ("sponsored_brands",), ("other",), (None,)], "t string")
    q1 = [r.x for r in df.select(map_ad_type("t", keep_dsp=True, default="undefined_ad_type").alias("x")).collect()]
    q2 = [r.x for r in df.select(map_ad_type("t").alias("x")).collect()]
    assert q1 == ["DSP", "SB", "undefined_ad_type", "undefined_ad_type"]
    assert q2 == ["SA_other", "SB", "SA_other", "SA_other"]


def test_first_touch_ties_are_repeatable(spark):
    df = spark.createDataFrame([("b", "u", "SP", 1), ("b", "u", "SB", 1), ("b", "u", "SD", 0)],
                               "brand string, user_id string, ad string, t int")
    out = rank_first_touch(df, ["brand", "user_id"], "t", ["ad"]).orderBy("rn").collect()
    assert [r.ad for r in out] == ["SD", "SB", "SP"]


def test_long_rule_lists_label_like_a_case_chain(spark):
    from shelfscope.functions.brand import classify_brand
    rules = [(f"kw{i:03d}", f"Brand{i:03d}") for i in range(150)]
    df = spark.createDataFrame([("x kw120 y", "", ""), ("", "kw007", "kw120"), ("none", None, "z")],
                               "advertiser string, creative string, campaign string")
    a = [r.b for r in df.select(classify_brand(rules).alias("b")).collect()]
    b = [r.b for r in df.select(classify_brand(rules, mode="case").alias("b")).collect()]
    assert a == b == ["Brand120", "Brand007", "UNCLASSIFIED"]


def test_indexed_rules_equal_the_case_chain(spark):
    rnd = random.Random(5)
    word = lambda n: "".join(rnd.choice("abAB xé") for _ in range(n))
    rows = [tuple(None if rnd.random() < .1 else word(rnd.randrange(30)) for _ in range(3)) for _ in range(300)]
    df = spark.createDataFrame(rows + rows[:50] + [("", "", ""), (None, None, None)], "advertiser string, creative string, campaign string")
    rules = [(word(rnd.randrange(1, 9)).lower(), f"label {i}") for i in range(80)] + [("AB", "upper case never matches"), ("zz", "not there")]
    rules += [(next(r[0][3:17].lower() for r in rows if r[0] and len(r[0]) > 20), "long")]
    for some in (rules[:1], rules, rules[40:] + [("", "all")], []):
        table = spark.createDataFrame([(i, p, lab) for i, (p, lab) in enumerate(some)] + [(99, None, "null")], "rule_no int, pattern string, label string")
        got = classify_indexed(df.withColumn("brand", F.lit("old")).withColumn("__n", F.lit(1)), table)
        want = df.withColumn("brand", brand_case(some)).withColumn("__n", F.lit(1))
        assert got.columns == want.columns or set(got.columns) == set(want.columns)
        assert got.select(*want.columns).exceptAll(want).isEmpty() and want.exceptAll(got.select(*want.columns)).isEmpty()
    assert classify_indexed(df.limit(0), table).count() == 0
