import zlib

import numpy as np

from shelfscope.llm import quality as q

DOCS = "doc_id long, text string, score double, p boolean, u int, _quality_score int"
LABELS = "doc_id long, quality int, toxic int"


def test_features_of_any_text():
    for t in (None, "", " ", "\n\n", "a", "É 😀", "x" * 100, "A B\nA B\n"):
        f = q.features(t)
        assert f.shape == (q.DIM,) and np.isfinite(f).all()
    assert not q.features(None).any()


def test_long_texts_in_chunks(monkeypatch):
    text = "some words, and more! " * 500
    whole = q.features(text)
    monkeypatch.setattr(q, "_CHUNK", 100)
    assert np.allclose(q.features(text), whole)


def test_prior_and_risk_on_two_clouds():
    rs = np.random.RandomState(0)
    pos = rs.normal(1, 1, (1500, 4))
    for prior in (0.3, 0.85):
        unl = np.where(rs.rand(3000, 1) < prior, rs.normal(1, 1, (3000, 4)), rs.normal(-2, 1, (3000, 4)))
        got = q.estimate_prior(pos, unl)
        assert abs(got - prior) < 0.12
        m = q.train(pos, unl, got)
        assert m.score(rs.normal(1, 1, (500, 4))).mean() > 0.85 and m.score(rs.normal(-2, 1, (500, 4))).mean() < 0.2


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = q.query(docs, labels).join(labels, "doc_id").toPandas()
    assert all((zlib.crc32(str(d).encode()) % 5 == 0) == h for d, h in zip(rows.doc_id, rows.held_out))
    held = rows[rows.held_out]
    good, bad = held[held.quality == 1], held[held.quality == 0]
    assert len(bad) > 50 and ((held.score >= 0) & (held.score <= 1)).all()
    rank = np.mean(good.score.to_numpy()[:, None] > bad.score.to_numpy()[None, :])
    assert rank > 0.97 and (good.predicted == 1).mean() > 0.99 and (bad.predicted == 0).mean() > 0.7


def test_edge_tables(spark):
    rows = [(1, "fine words here"), (1, "fine words here"), (None, None), (2, ""), (3, None)]
    df = spark.createDataFrame([(i, t, 0.5, True, 1, 2) for i, t in rows], DOCS)
    none = spark.createDataFrame([], LABELS)
    got = q.query(df, none).collect()  # nothing to learn from
    assert len(got) == 5 and all(r.score == 0.5 and r.predicted == 1 for r in got)
    lab = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (None, 1, 0), (9, None, 0), (2, 0, 0)], LABELS)
    assert q.query(df, lab).count() == 5
    assert q.keep_good(df, none).columns == df.columns and q.keep_good(df, none).count() == 5
    assert q.query(spark.createDataFrame([], DOCS), lab).count() == 0


def test_a_row_that_repeats_very_often_comes_to_the_driver_once(spark, monkeypatch):
    """Keys and texts repeated 30,000 times: the sample stays within its bound."""
    from pyspark.sql import functions as F
    docs = spark.range(30000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("good plain text.").alias("text"))
    docs = docs.unionByName(spark.range(2, 400).select(F.col("id").alias("doc_id"), F.concat(F.lit("words "), F.col("id").cast("string")).alias("text")))
    labels = spark.range(1, 300).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    taken = []
    monkeypatch.setattr(q, "train", lambda pos, unl, prior, **kw: taken.append((len(pos), len(unl))) or q.Model(np.zeros(q.DIM), np.zeros(q.DIM), np.ones(q.DIM), 0.0, 0.5))
    q.fit(docs, labels, positives=100, unlabelled=200)
    assert all(a <= 350 and b <= 350 for a, b in taken)
