"""One call for the exploratory profile of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.dedup import exact_duplicate_count
from ..operators.statistics import (
    column_profile,
    describe,
    distinct_counts,
    null_counts,
    row_count,
    value_counts,
)

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def profile(df: DataFrame, categories: list[str] | None = None, top_n: int = 20) -> dict[str, DataFrame]:
    """Row count, column profile, nulls, distinct values, duplicates, summaries, top values.

    Rows are duplicates if they agree in all columns, nested ones included.
    """
    plain = [c for c, t in df.dtypes if not t.startswith(("array", "map", "struct"))]
    numeric = [c for c, t in df.dtypes if t in NUMERIC or t.startswith("decimal")]
    tables = {
        "row_count": row_count(df),
        "columns": column_profile(df),
        "nulls": null_counts(df),
        "unique": distinct_counts(df, plain),
        "duplicates": exact_duplicate_count(df),
    }
    if numeric:
        tables["summary"] = describe(df, numeric)
    for c in categories or []:
        tables[f"top_{c}"] = value_counts(df, c, top_n)
    return tables
