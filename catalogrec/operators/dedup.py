"""Merge rows that describe the same item, and exact-copy removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import author_key, title_key

FILL_COLUMNS = ("authors", "year", "series", "language", "pages", "rating", "genres_raw")


def _missing(name: str, dtype: str) -> Column:
    c = F.col(name)
    if dtype == "string":
        return c.isNull() | (c == "")
    if dtype in ("double", "float"):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def dedup_merge(
    df: DataFrame,
    id_col: str = "book_id",
    title: str = "title",
    authors: str = "authors",
    description: str = "description",
    fill: tuple[str, ...] = FILL_COLUMNS,
    author_rule=author_key,
) -> DataFrame:
    """One row per title when at most one known author uses it, else all rows of the title.

    The surviving row has the longest description (lowest id on ties); its missing ``fill``
    columns take the first present value in id order.

    The group decision is one hash/sort aggregation over narrow columns (the description enters
    only as its length), combined map-side, so a title shared by a third of all rows reaches the
    shuffle as one partial row per task. Its result holds merged titles only and is joined back
    once; a hot title can only be on the left of that left join, which AQE may split freely
    because the right side has one row per title.
    """
    types = dict(df.dtypes)
    keyed = df.withColumn("_title", title_key(title))
    # The author key is read twice below, which keeps this projection in front of the aggregation:
    # the description is gone before rows are sorted or shuffled.
    narrow = keyed.select(
        "_title",
        id_col,
        author_rule(authors).alias("_author"),
        F.coalesce(F.length(description), F.lit(0)).alias("_length"),
        *fill,
    )
    groups = (
        narrow.groupBy("_title")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("_author").alias("_first_author"),
            F.max("_author").alias("_last_author"),
            F.max_by(F.col(id_col), F.struct("_length", -F.col(id_col))).alias("_best"),
            *[
                F.min_by(F.col(c), F.when(~_missing(c, types[c]), F.col(id_col))).alias(f"_fill_{c}")
                for c in fill
            ],
        )
        .where((F.col("_n") > 1) & F.col("_first_author").eqNullSafe(F.col("_last_author")))
        .drop("_n", "_first_author", "_last_author")
    )
    joined = keyed.join(groups, "_title", "left").where(
        F.col("_best").isNull() | (F.col("_best") == F.col(id_col))
    )
    filled = {
        c: F.when(_missing(c, types[c]), F.coalesce(F.col(f"_fill_{c}"), F.col(c)))
        .otherwise(F.col(c))
        .alias(c)
        for c in fill
    }
    return joined.select(*[filled.get(c, F.col(c)) for c in df.columns])


def _short(name: str, dtype: str) -> Column:
    """The value itself, or the SHA-256 of a text of 64 characters or more (never as short).

    Values with maps in them, which cannot be grouped, are compared as JSON.
    """
    c = F.col(f"`{name}`")
    if "map<" in dtype:
        return F.to_json(F.struct(F.map_entries(c).alias("m") if dtype.startswith("map<") else c))
    return F.when(F.length(c) >= 64, F.sha2(c, 256)).otherwise(c) if dtype == "string" else c


def exact_duplicate_count(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row: per distinct row its copies minus one.

    Long texts are compared by digest, so a row costs the shuffle a few bytes, and copies are
    combined map-side.
    """
    types = dict(df.dtypes)
    keys = [_short(c, types[c]).alias(f"k{i}") for i, c in enumerate(columns or df.columns)]
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicated_rows"))


def drop_exact_duplicates(df: DataFrame, columns: list[str], id_col: str) -> DataFrame:
    """Distinct rows over ``columns``; each keeps the lowest id of its copies."""
    return df.groupBy(*columns).agg(F.min(id_col).alias(id_col))
