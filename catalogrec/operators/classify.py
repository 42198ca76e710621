"""Label classifiers over vectors: nearest centroid, k-NN, their blend, and MLlib models."""

from __future__ import annotations

import time
from math import sqrt

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .metrics import evaluate
from .similarity import nearest

ALPHA = 0.6
BETA = 0.4
NEIGHBOURS = 5


def fit_scaler(df: DataFrame, vec: str = "embedding") -> tuple[list[float], list[float]]:
    """Per-position mean and population deviation (0 replaced by 1), combined map-side.

    Like any fitted scaler, the result is one number per vector position.
    """
    summary = Summarizer.metrics("mean", "variance", "count").summary(array_to_vector(vec))
    row = df.agg(summary.alias("s")).select("s.mean", "s.variance", "s.count").first()
    if not row or not row[2]:
        return [], []
    # Summarizer gives the sample variance; the scaler divides by the population deviation.
    shrink = (row[2] - 1) / row[2]
    deviation = [sqrt(max(0.0, float(v)) * shrink) or 1.0 for v in row[1]]
    return [float(m) for m in row[0]], deviation


def standardize(df: DataFrame, vec: str = "embedding", fit_on: DataFrame | None = None) -> DataFrame:
    """Replace the vectors by their standardised form; ``fit_on`` restricts the fit."""
    mean, deviation = fit_scaler(fit_on if fit_on is not None else df, vec)
    centred = F.zip_with(F.col(vec), F.lit(mean), lambda x, m: x.cast("double") - m)
    return df.withColumn(vec, F.zip_with(centred, F.lit(deviation), lambda x, d: x / d))


def centroids(df: DataFrame, label: str = "label", vec: str = "embedding") -> DataFrame:
    """(label, embedding): the mean vector per label, combined map-side."""
    return df.groupBy(label).agg(
        vector_to_array(Summarizer.mean(array_to_vector(vec))).alias("embedding")
    )


def centroid_scores(
    rows: DataFrame,
    profiles: DataFrame,
    id_col: str,
    label: str = "label",
    vec: str = "embedding",
    best: int | None = None,
) -> DataFrame:
    """(id, label, score, rank): similarity of every row to every centroid, or to the ``best`` ones.

    Labels are ranked best first, ties by label, so rank 1 is the nearest-centroid prediction.
    """
    # One entry per class: the labels become literals that number the centroids in label order.
    names = [r[0] for r in profiles.select(label).orderBy(label).collect()]
    listed = F.array(*[F.lit(n) for n in names])
    numbered = profiles.withColumn("_pos", F.array_position(listed, F.col(label)))
    found = nearest(rows, numbered, k=best or len(names), left_id=id_col, right_id="_pos", left_vec=vec)
    return found.select(
        F.col("left_id").alias(id_col),
        F.get(listed, (F.col("right_id") - 1).cast("int")).alias(label),
        F.col("similarity").alias("score"),
        "rank",
    )


def knn_votes(
    rows: DataFrame,
    train: DataFrame,
    id_col: str,
    label: str = "label",
    vec: str = "embedding",
    k: int = NEIGHBOURS,
) -> DataFrame:
    """(id, label, vote): share of the k nearest training rows that carry the label."""
    found = nearest(rows, train, k, left_id=id_col, right_id=id_col, left_vec=vec, right_vec=vec)
    named = found.join(train.select(F.col(id_col).alias("right_id"), F.col(label).alias(label)), "right_id")
    return named.groupBy(F.col("left_id").alias(id_col), label).agg(
        (F.count(F.lit(1)) / F.lit(float(k))).alias("vote")
    )


def _argmax(scores: DataFrame, id_col: str, label: str, score: str) -> DataFrame:
    """Best label per row; equal scores (9 digits) go to the lower label."""
    best = F.min(F.struct((-F.round(score, 9)).alias("s"), F.col(label).alias("l")))
    return scores.groupBy(id_col).agg(best["l"].alias("predicted"))


def centroid_predict(scores: DataFrame, id_col: str, label: str = "label") -> DataFrame:
    return scores.where(F.col("rank") == 1).select(id_col, F.col(label).alias("predicted"))


def knn_predict(votes: DataFrame, id_col: str, label: str = "label") -> DataFrame:
    return _argmax(votes, id_col, label, "vote")


def hybrid_scores(
    scores: DataFrame,
    votes: DataFrame,
    id_col: str,
    label: str = "label",
    alpha: float = ALPHA,
    beta: float = BETA,
) -> DataFrame:
    """``alpha * centroid + beta * vote`` for every label of every row."""
    joined = scores.join(votes, [id_col, label], "left")
    blend = F.lit(alpha) * F.col("score") + F.lit(beta) * F.coalesce("vote", F.lit(0.0))
    return joined.select(id_col, label, blend.alias("score"))


def hybrid_predict(scores: DataFrame, votes: DataFrame, id_col: str, label: str = "label", **weights) -> DataFrame:
    return _argmax(hybrid_scores(scores, votes, id_col, label, **weights), id_col, label, "score")


def _features(df: DataFrame, label: str, names: list, vec: str) -> DataFrame:
    """Vector column plus the label as its index in ``names``."""
    index = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(label)) - 1
    return df.withColumn("_features", array_to_vector(vec)).withColumn("_y", index.cast("double"))


def _named(predicted: DataFrame, id_col: str, names: list) -> DataFrame:
    listed = F.array(*[F.lit(n) for n in names])
    return predicted.select(id_col, F.get(listed, F.col("prediction").cast("int")).alias("predicted"))


def fit_logistic(train: DataFrame, label: str, names: list, vec: str = "embedding", max_iter: int = 1000):
    """L2 logistic regression equal to a unit inverse penalty on the summed loss."""
    data = _features(train, label, names, vec)
    return LogisticRegression(
        featuresCol="_features",
        labelCol="_y",
        maxIter=max_iter,
        regParam=1.0 / max(1, train.count()),
        elasticNetParam=0.0,
        standardization=False,
        family="multinomial",
    ).fit(data)


def fit_forest(
    train: DataFrame, label: str, names: list, vec: str = "embedding", trees: int = 100, depth: int = 10, seed: int = 42
):
    data = _features(train, label, names, vec)
    return RandomForestClassifier(
        featuresCol="_features", labelCol="_y", numTrees=trees, maxDepth=depth, seed=seed
    ).fit(data)


def model_predict(model, rows: DataFrame, id_col: str, label: str, names: list, vec: str = "embedding") -> DataFrame:
    return _named(model.transform(_features(rows, label, names, vec)), id_col, names)


def compare_models(
    train: DataFrame,
    test: DataFrame,
    id_col: str,
    label: str = "label",
    vec: str = "embedding",
    k: int = NEIGHBOURS,
    trees: int = 100,
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Score table of the five classifiers and the predictions of each.

    ``train`` and ``test`` should be materialised; they are read once per model.
    """
    names = [r[0] for r in train.select(label).distinct().orderBy(label).collect()]
    width = train.select(F.size(vec)).first()[0]
    n_train = train.count()
    truth = test.select(id_col, F.col(label).alias("actual"))

    def scored(name: str, predictions: DataFrame, fit_s: float, size_kb: float) -> tuple[DataFrame, DataFrame]:
        started = time.perf_counter()
        joined = truth.join(predictions, id_col)
        row = evaluate(joined).collect()[0].asDict()
        row = {
            "name": name,
            **row,
            "fit_time_s": round(fit_s, 3),
            "predict_time_s": round(time.perf_counter() - started, 3),
            "model_size_kb": round(size_kb, 1),
        }
        return row, joined

    profiles = centroids(train, label, vec)
    scores = centroid_scores(test, profiles, id_col, label, vec)
    votes = knn_votes(test, train, id_col, label, vec, k)
    profile_kb = len(names) * width * 8 / 1024
    train_kb = n_train * width * 8 / 1024

    started = time.perf_counter()
    logistic = fit_logistic(train, label, names, vec)
    logistic_s = time.perf_counter() - started
    started = time.perf_counter()
    forest = fit_forest(train, label, names, vec, trees)
    forest_s = time.perf_counter() - started
    entries = [
        ("centroid", centroid_predict(scores, id_col, label), 0.0, profile_kb),
        ("knn", knn_predict(votes, id_col, label), 0.0, train_kb),
        ("hybrid", hybrid_predict(scores, votes, id_col, label), 0.0, profile_kb + train_kb),
        (
            "logistic_regression",
            model_predict(logistic, test, id_col, label, names, vec),
            logistic_s,
            len(names) * (width + 1) * 8 / 1024,
        ),
        (
            "random_forest",
            model_predict(forest, test, id_col, label, names, vec),
            forest_s,
            forest.totalNumNodes * 4 * 8 / 1024,
        ),
    ]
    rows, predictions = [], {}
    for name, predicted, fit_s, size_kb in entries:
        row, joined = scored(name, predicted, fit_s, size_kb)
        rows.append(row)
        predictions[name] = joined
    schema = (
        "name string, accuracy double, precision_weighted double, recall_weighted double, "
        "f1_weighted double, fit_time_s double, predict_time_s double, model_size_kb double"
    )
    table = train.sparkSession.createDataFrame([tuple(r.values()) for r in rows], schema)
    return table, predictions


def retained_model(comparison: DataFrame) -> DataFrame:
    """Name of the model with the best weighted F1; ties go to the first in name order."""
    return comparison.agg(F.min(F.struct(-F.col("f1_weighted"), F.col("name")))["name"].alias("retained_model"))
