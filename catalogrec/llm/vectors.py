"""What the vector operators share: cleaning the vectors and cutting them into blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, embedding array<double>, usable) with one row per id.

    Unusable are vectors that are null, empty, zero or hold null or non-finite components. Rows with
    a null id are left out. If an id occurs more than once, the usable vector that is smallest
    component by component stands for it.
    """
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    nonzero = F.exists("embedding", lambda x: x != 0)
    rows = rows.where("vec_id is not null").withColumn("usable", F.coalesce(finite & nonzero, F.lit(False)))
    one = F.min(F.struct((~F.col("usable")).alias("u"), "embedding")).alias("s")
    return rows.groupBy("vec_id").agg(one).select("vec_id", "s.embedding", (~F.col("s.u")).alias("usable"))


def widths(usable: DataFrame) -> int:
    """The common number of components; vectors of different widths cannot be compared: an error."""
    low, high = usable.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if low != high:
        raise ValueError(f"vectors have {low} to {high} components")
    return low or 0
