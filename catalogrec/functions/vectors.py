"""Vector arithmetic on ARRAY columns as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def norm(a: Column | str) -> Column:
    return F.sqrt(
        F.aggregate(_col(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    )


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; a zero vector gives 0."""
    size = norm(a) * norm(b)
    return F.when(size == 0, F.lit(0.0)).otherwise(dot(a, b) / F.nullif(size, F.lit(0.0)))


def weighted_score(similarity: Column, likert_part: Column) -> Column:
    """0.8 of the similarity plus 0.2 of the normalised Likert mean."""
    return F.lit(0.8) * similarity + F.lit(0.2) * likert_part


def axis_level(similarity: Column) -> Column:
    """Similarity rescaled from [-0.1, 0.4] to [0, 100], clipped, one digit."""
    scaled = (similarity + F.lit(0.1)) / F.lit(0.5)
    return F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled)) * 100, 1)
