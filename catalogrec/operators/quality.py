"""Checks of generated summaries: coherence with the top item, invented titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.questionnaire import is_usable_summary, suggested_titles, suggestion_text
from ..functions.text import lookup_key
from ..functions.vectors import cosine


def split_suggestions(df: DataFrame, raw: str = "raw_summary") -> DataFrame:
    """Add ``summary`` (text before the suggestion line) and ``suggested_titles``."""
    return df.withColumn("summary", suggestion_text(raw)).withColumn("suggested_titles", suggested_titles(raw))


def title_index(catalog: DataFrame, title: str = "title") -> DataFrame:
    """Distinct lookup keys of the catalogue titles."""
    return catalog.select(lookup_key(title).alias("title_key")).where("title_key is not null").distinct()


def verify_titles(df: DataFrame, catalog: DataFrame, id_col: str, title: str = "title") -> DataFrame:
    """(id, titles_verified_count, titles_total_count, hallucination_rate).

    Suggestions are counted per (id, key) before the lookup. The lookup is a left join on keys
    that are distinct on the right, so a title everybody suggests can be split freely by AQE.
    """
    wanted = df.select(
        id_col, F.explode_outer("suggested_titles").alias("_t")
    ).select(id_col, lookup_key("_t").alias("title_key"))
    # Only suggested keys are looked for, so a small batch is broadcast against the catalogue scan
    # and no catalogue row without a match is shuffled.
    suggested = wanted.where("title_key is not null").select("title_key").distinct()
    offered = catalog.select(lookup_key(title).alias("title_key"))
    known = offered.join(suggested, "title_key", "left_semi").distinct().withColumn("_known", F.lit(1))
    counted = wanted.groupBy(id_col, "title_key").agg(F.count("title_key").alias("_n"))
    n = F.sum("_n")
    verified = F.sum(F.when(F.col("_known") == 1, F.col("_n")).otherwise(0))
    return (
        counted.join(known, "title_key", "left")
        .groupBy(id_col)
        .agg(
            verified.alias("titles_verified_count"),
            n.alias("titles_total_count"),
            F.bround((1 - verified / F.nullif(n, F.lit(0))) * 100, 1).alias("hallucination_rate"),
        )
    )


def coherence(pairs: DataFrame, summary_vec: str, item_vec: str) -> DataFrame:
    """Add ``coherence_score``: cosine of the two vectors in percent, one digit."""
    return pairs.withColumn("coherence_score", F.bround(cosine(summary_vec, item_vec) * 100, 1))


def summary_quality(
    summaries: DataFrame,
    catalog: DataFrame,
    vectors: DataFrame,
    encode,
    id_col: str = "query_id",
    top_item: str = "top_book_id",
    raw: str = "raw_summary",
) -> DataFrame:
    """Quality row of every usable summary.

    ``encode(df, text_col)`` adds an ``embedding`` column with the encoder of ``vectors``.
    """
    parsed = split_suggestions(summaries, raw).where(is_usable_summary("summary"))
    encoded = encode(parsed, "summary").withColumnRenamed("embedding", "_summary_vec")
    items = vectors.select(F.col("book_id").alias(top_item), F.col("embedding").alias("_item_vec"))
    scored = coherence(encoded.join(items, top_item), "_summary_vec", "_item_vec")
    checks = verify_titles(parsed, catalog, id_col)
    return scored.select(id_col, "summary", "suggested_titles", "coherence_score").join(checks, id_col)
