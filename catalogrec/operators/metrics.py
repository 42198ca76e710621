"""Multi-class evaluation from (actual, predicted) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


# Classes a confusion matrix may have; a column with more distinct values holds no classes.
MAX_CLASSES = 1000


def confusion(
    predictions: DataFrame,
    actual: str = "actual",
    predicted: str = "predicted",
    labels: list | None = None,
) -> DataFrame:
    """(actual, predicted, count) for the full label grid, zero cells kept.

    Rows are counted at once (map-side combined) and the matrix, one row per pair of classes, is held
    as a local table: whatever is derived from it does not read the predictions again. More than
    ``MAX_CLASSES`` distinct values are an error. A null actual or predicted label is a class of its
    own, listed last, so the cells add up to the rows (with ``labels`` given, rows of other labels
    are left out as before, but a null is kept).
    """
    spark = predictions.sparkSession
    counts = predictions.groupBy(
        F.col(actual).alias("actual"), F.col(predicted).alias("predicted")
    ).agg(F.count(F.lit(1)).alias("count"))
    cells = counts.limit(MAX_CLASSES * MAX_CLASSES + 1).collect()
    known = {(r["actual"], r["predicted"]): r["count"] for r in cells}
    # A missing label is a class of its own (listed last), so that every row is counted.
    found = {v for pair in known for v in pair} if labels is None else set(labels) | {v for pair in known for v in pair if v is None}
    if len(found) > MAX_CLASSES or len(cells) > MAX_CLASSES * MAX_CLASSES:
        raise ValueError(f"columns {actual} and {predicted} have more than {MAX_CLASSES} classes")
    dtype = counts.schema["actual"].dataType
    ordered = sorted(found, key=lambda v: (v is None, v if v is not None else 0))
    rows = [(a, p, known.get((a, p), 0)) for a in ordered for p in ordered]
    schema = StructType([StructField("actual", dtype), StructField("predicted", dtype), StructField("count", LongType())])
    return spark.createDataFrame(rows, schema)


def confusion_percent(matrix: DataFrame) -> DataFrame:
    """Each cell as a percentage of its row, one digit; an empty row gives zeros."""
    total = F.sum("count").over(Window.partitionBy("actual"))
    share = F.bround(F.col("count") / F.nullif(total, F.lit(0)) * 100, 1)
    return matrix.select("actual", "predicted", F.coalesce(share, F.lit(0.0)).alias("percent"))


def one_vs_rest(matrix: DataFrame) -> DataFrame:
    """(label, tp, fp, fn, tn) of every class against all others."""
    sides = matrix.select(
        F.explode(
            F.array(
                F.struct(F.col("actual").alias("label"), F.lit(1).alias("is_row")),
                F.struct(F.col("predicted").alias("label"), F.lit(0).alias("is_row")),
            )
        ).alias("_s"),
        F.col("actual").eqNullSafe(F.col("predicted")).alias("_hit"),
        "count",
    )
    row = F.col("_s.is_row") == 1
    sums = sides.groupBy(F.col("_s.label").alias("label")).agg(
        F.sum(F.when(row & F.col("_hit"), F.col("count")).otherwise(0)).alias("tp"),
        F.sum(F.when(row, F.col("count")).otherwise(0)).alias("_row"),
        F.sum(F.when(~row, F.col("count")).otherwise(0)).alias("_col"),
    )
    total = matrix.agg(F.sum("count").alias("n")).scalar()
    return sums.select(
        "label",
        "tp",
        (F.col("_col") - F.col("tp")).alias("fp"),
        (F.col("_row") - F.col("tp")).alias("fn"),
        (total - F.col("_row") - F.col("_col") + F.col("tp")).alias("tn"),
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def class_scores(rates: DataFrame) -> DataFrame:
    """(label, precision, recall, f1_score, support); a zero denominator gives 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return rates.select(
        "label",
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        (tp + fn).alias("support"),
    )


def weighted_scores(rates: DataFrame) -> DataFrame:
    """One row: accuracy and support-weighted precision, recall and F1."""
    scored = class_scores(rates).join(rates.select("label", "tp"), "label")
    n = F.nullif(F.sum("support"), F.lit(0))
    return scored.agg(
        F.coalesce(F.sum("tp") / n, F.lit(0.0)).alias("accuracy"),
        F.coalesce(F.sum(F.col("precision") * F.col("support")) / n, F.lit(0.0)).alias("precision_weighted"),
        F.coalesce(F.sum(F.col("recall") * F.col("support")) / n, F.lit(0.0)).alias("recall_weighted"),
        F.coalesce(F.sum(F.col("f1_score") * F.col("support")) / n, F.lit(0.0)).alias("f1_weighted"),
    )


def class_report(rates: DataFrame) -> DataFrame:
    """Per-class scores plus the rows ``accuracy``, ``macro avg`` and ``weighted avg``."""
    per_class = class_scores(rates).withColumn("label", F.col("label").cast("string"))
    total = weighted_scores(rates)
    support = per_class.agg(F.sum("support").alias("n")).scalar()
    accuracy = total.select(
        F.lit("accuracy").alias("label"),
        F.col("accuracy").alias("precision"),
        F.col("accuracy").alias("recall"),
        F.col("accuracy").alias("f1_score"),
        support.alias("support"),
    )
    macro = per_class.agg(
        F.lit("macro avg").alias("label"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1_score").alias("f1_score"),
        F.sum("support").alias("support"),
    )
    weighted = total.select(
        F.lit("weighted avg").alias("label"),
        F.col("precision_weighted").alias("precision"),
        F.col("recall_weighted").alias("recall"),
        F.col("f1_weighted").alias("f1_score"),
        support.alias("support"),
    )
    return per_class.unionByName(accuracy).unionByName(macro).unionByName(weighted)


def evaluate(
    predictions: DataFrame, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """``weighted_scores`` straight from prediction rows."""
    return weighted_scores(one_vs_rest(confusion(predictions, actual, predicted)))
