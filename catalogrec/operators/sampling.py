"""Seeded, repeatable sampling and splitting by a hash order of the row id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Leading hex digits of the hash that form a bucket when ranks are located.
_BUCKET_DIGITS = 3
# Groups of tasks whose rows are cut to the cap before the final cut.
_TASK_GROUPS = 64


def hash_order(id_col: str, seed: int) -> Column:
    """md5 of ``seed:id`` - the same pseudo-random order in any SQL engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def stratified_cap(df: DataFrame, label: str, id_col: str, cap: int = 400, seed: int = 42) -> DataFrame:
    """At most ``cap`` rows per label, the first ones in hash order.

    Each task keeps ``cap`` rows per label before the shuffle. A label spread over very many tasks
    is still too much for one of them, so groups of tasks are cut to ``cap`` first and their
    survivors second; the first rows of a whole are among the first rows of its parts.
    """
    tasks = F.pmod(F.spark_partition_id(), F.lit(_TASK_GROUPS))
    parts = df.withColumn("_h", hash_order(id_col, seed)).withColumn("_g", tasks)

    def cut(rows: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy("_h", id_col)
        return rows.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= cap).drop("_r")

    return cut(cut(parts, label, "_g"), label).drop("_h", "_g")


def min_support(df: DataFrame, label: str, n: int = 100) -> DataFrame:
    """Rows of the labels that have at least ``n`` rows."""
    large = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= n)
    return df.join(large, label, "left_semi").select(*df.columns)


def stratified_split(
    df: DataFrame, label: str, id_col: str, test_fraction: float = 0.25, seed: int = 42
) -> DataFrame:
    """Add BOOLEAN ``is_test``: per label the first ``round(fraction * n)`` rows in hash order.

    No label is ever ordered as a whole. Rows are counted per (label, hash bucket), which tells
    for each label the one bucket where the quota runs out; rows of earlier buckets are test,
    rows of later ones are train, and only the rows of that bucket (1/4096 of the label) are
    ranked against each other.
    """
    hashed = df.withColumn("_h", hash_order(id_col, seed)).withColumn(
        "_b", F.substring("_h", 1, _BUCKET_DIGITS)
    )
    counts = hashed.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(label)
    running = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    border = (
        counts.withColumn("_quota", F.floor(F.sum("_n").over(whole) * F.lit(test_fraction) + F.lit(0.5)))
        .withColumn("_upto", F.sum("_n").over(running))
        .where((F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_n") < F.col("_quota")))
        .select(
            F.col(label).alias("_label"),
            F.col("_b").alias("_border"),
            (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_left"),
        )
    )
    placed = hashed.join(border, F.col(label).eqNullSafe(F.col("_label")), "left")
    inside = F.col("_b") == F.col("_border")
    settled = placed.where(F.coalesce(~inside, F.lit(True))).withColumn(
        "is_test", F.coalesce(F.col("_b") < F.col("_border"), F.lit(False))
    )
    ranked = placed.where(inside).withColumn(
        "is_test",
        F.row_number().over(Window.partitionBy(label).orderBy("_h", id_col)) <= F.col("_left"),
    )
    columns = [*df.columns, "is_test"]
    return settled.select(*columns).unionByName(ranked.select(*columns))


def seeded_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in hash order; each task keeps its own first ``n``."""
    return (
        df.withColumn("_h", hash_order(id_col, seed)).orderBy("_h", id_col).limit(n).drop("_h")
    )


def first_rows(df: DataFrame, id_col: str, n: int = 10) -> DataFrame:
    return df.orderBy(id_col).limit(n)
