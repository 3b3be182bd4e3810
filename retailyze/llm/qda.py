"""Regularised quadratic discriminant over transformed document statistics.

Each class is a Gaussian over log-transformed text statistics. Means and
covariances come from one grouped pass of sums over all labelled training rows;
a covariance is shrunk towards the pooled one and towards its diagonal, and its
Cholesky factor is computed once. The score of a row is the posterior from the
difference of the two log densities: a Mahalanobis length through the cached
inverse factor, the log determinant and the class frequency.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, cut_lineage, once
from .textstats import fresh, with_text_stats

#: Share of the pooled covariance, then of the scaled identity.
POOLED, RIDGE = 0.15, 0.05
THRESHOLD = 0.3
DIMENSIONS = 9


def transformed(s: Column) -> list[Column]:
    """Log-transformed statistics; the added constants draw short texts to the
    middle instead of letting one character decide."""
    n, chars = s["n_words"] + F.lit(30.0), s["word_chars"] + F.lit(150.0)
    return [F.log(x) for x in (
        n, chars / n,
        (s["n_symbols"] + F.lit(1.0)) / n, (s["n_excl"] + F.lit(1.0)) / n,
        (s["n_upper"] + F.lit(2.0)) / chars, (s["n_digits"] + F.lit(2.0)) / chars,
        (s["n_punct"] + F.lit(3.0)) / n,
        (s["n_words"] - s["n_distinct"] + F.lit(4.0)) / n,
        (s["n_dup_lines"] + F.lit(1.0)) / (s["n_lines"] + F.lit(6.0)),
    )]


@dataclass(frozen=True)
class Gaussian:
    mean: np.ndarray
    factor: np.ndarray  # inverse of the Cholesky factor
    log_const: float    # log class frequency - half the log determinant


@dataclass(frozen=True)
class Model:
    bad: Gaussian | None
    good: Gaussian | None


def fit(rows: DataFrame, features: list[Column], label: Column, pooled: float = POOLED, ridge: float = RIDGE) -> Model:
    """Class Gaussians from sums over all rows with a label of 0 or 1."""
    d = len(features)
    x = rows.select(label.cast("int").alias("y"), *[f.alias(f"x{i}") for i, f in enumerate(features)])
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    sums = x.where(F.col("y").isin(0, 1)).groupBy("y").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(d)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i, j in pairs]).collect()
    got = {}
    for r in sums:
        mean = np.array([r[f"s{i}"] for i in range(d)]) / r["n"]
        second = np.zeros((d, d))
        for i, j in pairs:
            second[i, j] = second[j, i] = r[f"p{i}_{j}"]
        got[r["y"]] = (r["n"], mean, second - r["n"] * np.outer(mean, mean))
    total = sum(n for n, _, _ in got.values())
    if not total:
        return Model(None, None)
    common = sum(s for _, _, s in got.values()) / total
    out: dict = {0: None, 1: None}
    for y, (n, mean, scatter) in got.items():
        weight = n / (n + 2.0 * d)  # few rows: closer to the pooled covariance
        share = 1 - (1 - pooled) * weight
        cov = (1 - share) * scatter / n + share * common
        cov = (1 - ridge) * cov + ridge * np.diag(np.maximum(np.diag(common), 1e-4))
        chol = np.linalg.cholesky(cov)
        out[y] = Gaussian(mean, np.linalg.inv(chol), float(np.log(n / total) - np.log(np.diag(chol)).sum()))
    return Model(out[0], out[1])


def log_density(g: Gaussian, features: list[Column]) -> Column:
    """log(class frequency x density), up to the constant shared by classes."""
    centred = [f - F.lit(float(m)) for f, m in zip(features, g.mean)]
    length = F.lit(0.0)
    for i in range(len(features)):
        z = sum((centred[j] * F.lit(float(g.factor[i, j])) for j in range(i + 1)), F.lit(0.0))
        length = length + z * z
    return F.lit(g.log_const) - length / 2


def posterior(model: Model, features: list[Column]) -> Column:
    """Probability of label 1. A class that was never seen has probability 0;
    without any training row every score is 1 (nothing is known against it)."""
    if model.good is None and model.bad is not None:
        return F.lit(0.0)
    if model.bad is None or model.good is None:
        return F.lit(1.0)
    margin = log_density(model.good, features) - log_density(model.bad, features)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.greatest(F.least(-margin, F.lit(500.0)), F.lit(-500.0))))


def featured(docs: DataFrame, out: str) -> DataFrame:
    """``docs`` with ``out``: the array of transformed statistics of each whole text."""
    (stats,) = fresh(docs, "_stats")
    df = with_text_stats(docs, stats, windows=False)
    keep = [F.col(f"`{c}`") for c in docs.columns if c != out]
    return df.select(*keep, once(F.array(*transformed(F.col(stats)))).alias(out))


def _entries(feats: str) -> list[Column]:
    return [F.col(feats)[i] for i in range(DIMENSIONS)]


def learn_quality(rows: DataFrame, feats: str, labels: DataFrame, folds: int = 5) -> Model:
    """Fit on the labelled rows (doc_id and ``feats``) whose crc32(doc_id) mod ``folds``
    is not 0. Only ids and statistics are joined, never texts."""
    y = labels.where(crc_fold("doc_id", folds) != 0).select(
        F.col("doc_id").alias("_key"), F.col("quality").alias("_quality"))
    known = rows.select("doc_id", feats).join(y, F.col("doc_id") == F.col("_key"))
    return fit(known, _entries(feats), F.col("_quality"))


def score_quality(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with ``out``, the probability of label 1. A null text is scored as an
    empty one; equal texts get equal scores; an input column named ``out`` is
    replaced and all others stay."""
    (feats,) = fresh(docs, "_feats")
    df = featured(docs, feats)
    keep = [F.col(f"`{c}`") for c in docs.columns if c != out]
    return df.select(*keep, posterior(model, _entries(feats)).alias(out))


def op5(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """Scores of all documents; the texts are read once."""
    rows = cut_lineage(featured(docs.select("doc_id", "text"), "_feats").drop("text"))
    model = learn_quality(rows, "_feats", labels, folds)
    scored = rows.withColumn("score", posterior(model, _entries("_feats")))
    return scored.select("doc_id", F.coalesce(crc_fold("doc_id", folds) == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
