"""How well do vectors separate labels? Sample, split, fit five models, report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import UNKNOWN_GENRE
from ..operators.classify import compare_models, retained_model, standardize
from ..operators.metrics import class_report, confusion, confusion_percent, one_vs_rest
from ..operators.sampling import min_support, stratified_cap, stratified_split
from ..session import scratch_path
from ..sources.storage import materialize

MAX_PER_LABEL = 400
MIN_PER_LABEL = 100
TEST_FRACTION = 0.25
SEED = 42


def known_labels(df: DataFrame, label: str = "genre_clean") -> DataFrame:
    return df.where(F.col(label) != UNKNOWN_GENRE)


def sample_for_benchmark(
    df: DataFrame,
    label: str,
    id_col: str,
    cap: int = MAX_PER_LABEL,
    support: int = MIN_PER_LABEL,
    seed: int = SEED,
) -> DataFrame:
    """At most ``cap`` rows per label, labels below ``support`` rows dropped."""
    return min_support(stratified_cap(df, label, id_col, cap, seed), label, support)


def split_standardized(
    sample: DataFrame, label: str, id_col: str, vec: str = "embedding", fit_on: str = "all", seed: int = SEED
) -> DataFrame:
    """Standardised vectors with ``is_test``; the scaler is fitted on all rows or on train."""
    split = stratified_split(sample, label, id_col, TEST_FRACTION, seed)
    return standardize(split, vec, split.where(~F.col("is_test")) if fit_on == "train" else None)


def kpi_tables(predictions: DataFrame, actual: str = "actual", predicted: str = "predicted", labels: list | None = None) -> dict[str, DataFrame]:
    """Confusion matrix (counts, percent), one-vs-rest rates and the class report."""
    matrix = confusion(predictions, actual, predicted, labels)
    rates = one_vs_rest(matrix)
    return {
        "confusion": matrix,
        "confusion_percent": confusion_percent(matrix),
        "one_vs_rest": rates,
        "class_report": class_report(rates),
    }


def benchmark_labels(
    vectors: DataFrame,
    label: str = "label",
    id_col: str = "vec_id",
    vec: str = "embedding",
    cap: int = MAX_PER_LABEL,
    support: int = MIN_PER_LABEL,
    fit_on: str = "all",
    trees: int = 100,
    seed: int = SEED,
) -> dict[str, DataFrame]:
    """Comparison table, retained model, its KPI tables and the one-row summary document.

    The sample, test rows included, is bounded by ``cap`` rows per label: scores are measured on the
    capped rows, not on the rest of the table. It is written once and every model reads
    that table.
    """
    spark = vectors.sparkSession
    sample = sample_for_benchmark(vectors.select(id_col, label, vec), label, id_col, cap, support, seed)
    data = materialize(
        spark,
        scratch_path(spark, "benchmark-sample"),
        lambda: split_standardized(sample, label, id_col, vec, fit_on, seed),
    )
    train, test = data.where(~F.col("is_test")), data.where("is_test")
    comparison, predictions = compare_models(train, test, id_col, label, vec, trees=trees)
    best = retained_model(comparison).first()[0]
    tables = kpi_tables(predictions[best])
    tables["comparison"] = comparison
    tables["summary"] = _summary(comparison, tables, data, label, best, vectors.count())
    return tables


def _summary(comparison: DataFrame, tables: dict, data: DataFrame, label: str, best: str, n_corpus: int) -> DataFrame:
    """One row with all results, ready for ``write_json``; sizes depend on the labels only."""
    sizes = data.agg(
        F.count(F.lit(1)).alias("n_books_sampled"),
        F.count_if(~F.col("is_test")).alias("n_train"),
        F.count_if("is_test").alias("n_test"),
        F.count_distinct(label).alias("n_genres"),
    )
    models = comparison.agg(
        F.array_sort(F.collect_list(F.struct(*comparison.columns))).alias("m")
    ).scalar()
    report = tables["class_report"]
    listed = report.agg(F.array_sort(F.collect_list(F.struct(*report.columns))).alias("r")).scalar()
    matrix = tables["confusion"]
    # Rows of the matrix by actual label, cells of a row by predicted label.
    cells = matrix.groupBy("actual").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("predicted", "count"))), lambda c: c["count"]).alias("row")
    )
    ordered = cells.agg(F.array_sort(F.collect_list(F.struct("actual", "row"))).alias("m"))
    rows = ordered.select(F.transform("m", lambda c: c["row"]).alias("rows")).scalar()
    names = ordered.select(F.transform("m", lambda c: c["actual"].cast("string")).alias("names")).scalar()
    winner = comparison.where(F.col("name") == best).select(
        F.struct("accuracy", "precision_weighted", "recall_weighted", "f1_weighted").alias("s")
    ).scalar()
    return sizes.select(
        F.current_timestamp().alias("generated_at"),
        F.lit(best).alias("method"),
        F.lit(n_corpus).cast("long").alias("n_books_corpus"),
        *sizes.columns,
        *[winner[c].alias(c) for c in ("accuracy", "precision_weighted", "recall_weighted", "f1_weighted")],
        names.alias("genres"),
        listed.alias("classification_report"),
        rows.alias("confusion_matrix"),
        models.alias("model_comparison"),
        F.lit(best).alias("retained_model"),
    )
