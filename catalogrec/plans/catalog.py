"""Build the clean catalogue: merge, de-duplicate, clean, label, extract keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import period_bucket, with_genre
from ..functions.text import clean_authors, clean_text, truncate_words
from ..operators.dedup import dedup_merge
from ..operators.keywords import extract_keywords
from ..session import scratch_path, spread
from ..sources.catalog_csv import load_source_1, load_source_2, load_source_3, merge_sources
from ..sources.storage import materialize

DISPLAY_WORDS = 150
EMBEDDING_WORDS = 200
BENCHMARK_WORDS = 100


def drop_incomplete(df: DataFrame, columns: tuple[str, ...] = ("title", "description")) -> DataFrame:
    return df.na.drop(subset=list(columns))


def clean_columns(df: DataFrame, embedding_max_words: int = EMBEDDING_WORDS) -> DataFrame:
    """Add the derived columns that need no other row; a narrow projection."""
    cleaned = with_genre(
        df.withColumns(
            {
                "title_clean": clean_text("title"),
                "authors_clean": clean_authors("authors"),
                "desc_clean": clean_text("description"),
            }
        )
    )
    return (
        cleaned.withColumn("period", period_bucket("year"))
        .withColumn("desc_display", truncate_words("description", DISPLAY_WORDS))
        .withColumn("desc_embedding", truncate_words("desc_clean", embedding_max_words))
        .withColumn("text_full", F.concat_ws(". ", "title_clean", "genre_clean", "desc_embedding"))
    )


def clean_rows(merged: DataFrame, embedding_max_words: int = EMBEDDING_WORDS, observed: list | None = None) -> DataFrame:
    """De-duplicated, complete and cleaned rows of a merged table; all of the catalogue but keywords.

    With ``observed`` (a list), three observations are added to it that count the rows entering,
    leaving the merge of duplicates and leaving the drop of incomplete rows, while the rows are
    computed: the counts come from the job that writes the rows, with no read of their own.
    """
    if observed is None:
        return clean_columns(drop_incomplete(dedup_merge(merged)), embedding_max_words)
    seen = [Observation("merged"), Observation("deduped"), Observation("complete")]
    observed.extend(seen)
    count = F.count(F.lit(1)).alias("n")
    deduped = dedup_merge(merged.observe(seen[0], count)).observe(seen[1], count)
    return clean_columns(drop_incomplete(deduped).observe(seen[2], count), embedding_max_words)


def observed_steps(spark: SparkSession, observed: list) -> DataFrame:
    """(step, rows_before, rows_after, rows_removed) from the observations of ``clean_rows``, once
    the rows were computed."""
    m, d, c = (int(o.get["n"]) for o in observed)
    rows = [("dedup", m, d, m - d), ("drop_incomplete", d, c, d - c)]
    return spark.createDataFrame(rows, "step string, rows_before long, rows_after long, rows_removed long")


def leak_free_text(max_words: int = BENCHMARK_WORDS):
    """Title and description without the genre, for judging how well text predicts it."""
    return F.concat_ws(" ", "title_clean", truncate_words("desc_clean", max_words))


def build_catalog_from(
    merged: DataFrame,
    embedding_max_words: int = EMBEDDING_WORDS,
    stop_words: list[str] | None = None,
    stage: str | None = None,
) -> DataFrame:
    """Clean catalogue of an already merged table.

    The cleaned rows feed three readers (vocabulary, weights, final join), so they are written
    once to ``stage`` (a folder under the session's checkpoint folder if not given).
    """
    spark = merged.sparkSession
    stage = stage or scratch_path(spark, "clean-rows")
    rows = materialize(spark, stage, lambda: clean_rows(spread(merged, "book_id"), embedding_max_words))
    keywords = extract_keywords(rows, text_col="desc_clean", stop_words=stop_words)
    return rows.join(keywords, "book_id", "left").withColumn(
        "keywords", F.array_join(F.coalesce("keywords", F.array().cast("array<string>")), ", ")
    )


def build_catalog(
    spark: SparkSession,
    source_1: str,
    source_2: str,
    source_3: str,
    cache_path: str,
    embedding_max_words: int = EMBEDDING_WORDS,
    stop_words: list[str] | None = None,
    force_rebuild: bool = False,
) -> DataFrame:
    """Read, build and store the catalogue at ``cache_path``; later calls with the same input files
    and parameters reuse it, other files or parameters rebuild it."""

    def build() -> DataFrame:
        # Book ids follow file positions, so they are fixed by writing the merged rows once.
        merged = materialize(
            spark,
            scratch_path(spark, "merged-rows"),
            lambda: merge_sources(
                [load_source_1(spark, source_1), load_source_2(spark, source_2), load_source_3(spark, source_3)]
            ),
        )
        return build_catalog_from(merged, embedding_max_words, stop_words)

    params = {"embedding_max_words": embedding_max_words, "stop_words": stop_words}
    return materialize(spark, cache_path, build, force_rebuild, inputs=[source_1, source_2, source_3], params=params)


def step_counts(merged: DataFrame) -> DataFrame:
    """(step, rows_before, rows_after, rows_removed) of the de-duplication and drop steps."""
    deduped = dedup_merge(merged)
    complete = F.col("title").isNotNull() & F.col("description").isNotNull()
    after = deduped.agg(F.count(F.lit(1)).alias("d"), F.count_if(complete).alias("c"))
    before = merged.agg(F.count(F.lit(1)).alias("m")).scalar()
    steps = F.array(
        F.struct(F.lit("dedup").alias("step"), before.alias("rows_before"), F.col("d").alias("rows_after")),
        F.struct(F.lit("drop_incomplete").alias("step"), F.col("d").alias("rows_before"), F.col("c").alias("rows_after")),
    )
    return (
        after.select(F.explode(steps).alias("_s"))
        .select("_s.*")
        .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
    )
