"""Operator 8, quality classifier by positive-unlabelled learning.

Trusted positives are labelled good; everything else is unlabelled web text,
good and bad mixed.  A linear model is fitted by minimising the non-negative
unbiased risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

with the logistic loss, so its sigmoid is the chance of being good.  The class
prior (the share of good text among the unlabelled) is estimated from the
scores of a first model on positives it has not seen: above any score, the unlabelled
hold at least prior times the positives' share, so the prior is at most the smallest ratio
of the two tails (best-bin estimation).

Fitting uses a bounded sample (``POSITIVES`` labelled rows and about
``UNLABELLED`` rows chosen by a hash; parameters of ``fit``).  Scoring reads
every whole text.  Features come from the text alone: shares of bytes, of
hashed byte pairs, and the shape of words and lines.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, importable

POSITIVES, UNLABELLED = 8_000, 12_000
PAIRS = 512
DENSE = 16
DIM = 256 + PAIRS + DENSE
THRESHOLD = 0.3
_CHUNK = 1 << 22
_PAIR = ((np.arange(65536, dtype=np.uint32) * np.uint32(2654435761)) >> np.uint32(32 - 9)).astype(np.int64)


def features(text: str | None) -> np.ndarray:
    """A text's features (float32, DIM).  Null or empty: zeros."""
    out = np.zeros(DIM, np.float32)
    if not text:
        return out
    raw = text.encode("utf-8", "surrogatepass")
    b = np.frombuffer(raw, np.uint8)
    ones, twos = np.zeros(256), np.zeros(65536)
    for i in range(0, len(b), _CHUNK):  # bounded memory for any length
        part = b[i:i + _CHUNK + 1]
        ones += np.bincount(part[:_CHUNK], minlength=256)
        if len(part) > 1:
            twos += np.bincount(part[:-1].astype(np.int64) << 8 | part[1:], minlength=65536)
    n = len(b)
    out[:256] = np.sqrt(ones / n)
    out[256:256 + PAIRS] = np.sqrt(np.bincount(_PAIR, weights=twos, minlength=PAIRS) / max(1, n - 1))
    words, lines = raw.split(), raw.split(b"\n")
    k = max(1, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    upper = sum(1 for w in words if w.isupper())
    plain = sum(1 for w in words if w[-1:].isalnum() or w[-1] >= 128)
    full = [x for x in lines if x.strip()]
    rows = max(1, len(full))
    out[256 + PAIRS:] = (
        np.log1p(len(words)) / 8, np.log1p(len(lines)) / 5, sizes.mean() / 8, sizes.std() / 8, min(sizes.max(), 200) / 50,
        len(set(words)) / k, upper / k, plain / k, len(set(full)) / rows, np.log1p(len(words) / rows) / 4,
        sum(1 for x in full if x.rstrip()[-1:] in b".!?:") / rows, ones[48:58].sum() / n * 4, ones[65:91].sum() / n * 4,
        (ones[33:48].sum() + ones[58:65].sum() + ones[91:97].sum() + ones[123:127].sum()) / n * 4, ones[10] / n * 20, 1.0)
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    bias: float
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x.astype(np.float64)), -40, 40)))


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = 400, rate: float = 0.02, l2: float = 1e-4) -> Model:
    """Non-negative risk by Adam over the whole sample; where the bracket is negative, its gradient is turned
    around, as the non-negative estimator asks for."""
    n = len(pos) + len(unl)
    mean = (pos.sum(0, dtype=np.float64) + unl.sum(0, dtype=np.float64)) / n
    square = np.zeros(pos.shape[1])
    for x in (pos, unl):  # in pieces: the driver holds each sample once more, in single precision
        for i in range(0, len(x), 1024):
            square += ((x[i:i + 1024] - mean) ** 2).sum(0)
    scale = np.sqrt(square / n) + 0.02

    def standard(x):
        out = (x - mean.astype(np.float32)).astype(np.float32)
        out /= scale.astype(np.float32)
        return np.clip(out, -8, 8, out=out)

    p, u = standard(pos), standard(unl)
    w, b = np.zeros(p.shape[1]), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        w32 = w.astype(np.float32)
        zp, zu = (p @ w32).astype(np.float64) + b, (u @ w32).astype(np.float64) + b
        sp, su = _sigmoid(zp), _sigmoid(zu)
        bracket = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        minus_w = (su.astype(np.float32) @ u).astype(np.float64) / len(u) - prior * (sp.astype(np.float32) @ p) / len(p)
        minus_b = su.mean() - prior * sp.mean()
        plus_w, plus_b = prior * ((sp - 1).astype(np.float32) @ p).astype(np.float64) / len(p), prior * (sp - 1).mean()
        gw, gb = (plus_w + minus_w, plus_b + minus_b) if bracket >= 0 else (-minus_w, -minus_b)
        gw = gw + l2 * w
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        step = rate * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
        w = w - step * m / (np.sqrt(v) + 1e-8)
        b = b - step * mb / (np.sqrt(vb) + 1e-8)
    return Model(w, mean, scale, float(b), prior)


def estimate_prior(pos: np.ndarray, unl: np.ndarray, seed: int = 7) -> float:
    """Share of positives among the unlabelled, by best-bin estimation."""
    order = np.random.RandomState(seed).permutation(len(pos))
    cut = len(pos) // 2
    fit, held = pos[order[:cut]], pos[order[cut:]]
    order = np.random.RandomState(seed + 1).permutation(len(unl))
    fit_u, held_u = unl[order[:len(unl) // 2]], unl[order[len(unl) // 2:]]
    if not len(fit) or not len(held) or not len(fit_u) or not len(held_u):
        return 0.5
    first = train(fit, fit_u, 0.5, steps=150)
    sp, su = np.sort(first.score(held)), np.sort(first.score(held_u))
    at = np.unique(np.concatenate([sp, su]))
    tail_p = 1 - np.searchsorted(sp, at) / len(sp)
    tail_u = 1 - np.searchsorted(su, at) / len(su)
    ok = tail_p >= 0.05
    noise = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(sp)) + 1 / np.sqrt(len(su)))
    best = np.argmin((tail_u[ok] + noise) / tail_p[ok])
    return float(np.clip(tail_u[ok][best] / tail_p[ok][best], 0.05, 0.98))


def fold(key: Column) -> Column:
    """crc32 of the key as text (null: empty), modulo 5; 0 is held out."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED,
        key: str = "doc_id", text: str = "text") -> Model:
    """Fit on a bounded sample of rows that are not held out: the rows of ``positives`` keys labelled good, and about
    ``unlabelled`` of all rows by a hash of key and text, whatever their labels.  Equal rows count once, and
    positives + 1.25 * unlabelled rows, the first by that hash, are the most that the driver takes.  With no
    positives or no text at all, every text scores the prior 0.5."""
    importable(docs.sparkSession)
    k = F.col(f"`{key}`")
    good = (labels.where((F.col("quality") == 1) & (fold(F.col(f"`{key}`")) != 0)).select(k.alias("_k")).distinct()
            .orderBy(F.xxhash64("_k"), "_k").limit(positives))
    total = docs.where(fold(k) != 0).count()
    part = min(1.0, unlabelled / max(1, total))
    picked = F.pmod(F.xxhash64(k, F.col(f"`{text}`")), F.lit(1 << 30)) < F.lit(int(part * (1 << 30)))
    rows = docs.select(k.alias("_k"), F.col(f"`{text}`").alias("t"), picked.alias("u")).where(fold(F.col("_k")) != 0)
    # at most ``positives`` keys: a bounded broadcast
    rows = rows.join(F.broadcast(good.withColumn("p", F.lit(True))), "_k", "left").where("u or p")

    @F.pandas_udf("binary")
    def feats(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).tobytes() for t in texts], dtype=object)

    # equal rows count once; what comes to the driver is bounded whatever repeats, the first by hash
    rows = rows.select(F.coalesce("p", F.lit(False)).alias("p"), F.coalesce("u", F.lit(False)).alias("u"), "t",
                       F.xxhash64("_k", "t").alias("h")).dropDuplicates(["h"])
    got = rows.select("p", "u", feats("t").alias("x"), "h").orderBy("h").limit(positives + unlabelled * 5 // 4).toPandas()
    x = np.frombuffer(b"".join(got["x"]), np.float32).reshape(-1, DIM)
    is_pos, is_unl = got["p"].to_numpy(bool), got["u"].to_numpy(bool)
    del got
    pos, unl = x[is_pos], x[is_unl]
    del x
    if not len(pos) or not len(unl):
        return Model(np.zeros(DIM), np.zeros(DIM), np.ones(DIM), 0.0, 0.5)
    return train(pos, unl, estimate_prior(pos, unl))


def with_score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Adds the score (0 to 1) of every whole text; null texts score as empty ones."""
    spark = docs.sparkSession
    importable(spark)
    shared = spark.sparkContext.broadcast(model)  # a few kilobytes

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        m = shared.value
        out = [m.score(np.clip(features(t)[None, :], None, None))[0] for t in texts]
        return pd.Series(out, dtype="float64")

    return docs.withColumn(name, run(F.col(f"`{text}`")))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels)
    s = with_score(docs.select("doc_id", "text"), model)
    return s.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                    F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that the classifier rejects."""
    name = fresh(docs, "_quality_score")
    return with_score(docs, fit(docs, labels), name=name).where(F.col(name) >= threshold).select(
        *[F.col(f"`{c}`") for c in docs.columns])
