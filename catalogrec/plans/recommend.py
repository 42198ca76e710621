"""Rank the catalogue for many questionnaires at once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import format_genre, format_number, format_text
from ..functions.questionnaire import (
    AXIS_LIKERT,
    AXIS_SENTENCES,
    LIKERT_COLUMNS,
    favourite_keys,
    likert_mean,
    likert_value,
    query_text,
    read_keys,
    user_profile,
)
from ..functions.vectors import axis_level, cosine, weighted_score
from ..operators.encoder import encode_text, fit_encoder
from ..operators.similarity import nearest, unique_rows
from ..session import scratch_path, spread
from ..sources.storage import materialize

TOP_K = 5
# Fixed value: shown in place of a missing description.
NO_DESCRIPTION = "Description non disponible"
PREFERENCES_SCHEMA = (
    "query_id long, description string, favorite_books string, avoid string, "
    + ", ".join(f"{c} int" for c in LIKERT_COLUMNS)
    + ", timestamp timestamp"
)

Encode = Callable[[DataFrame, str], DataFrame]


def split_valid(preferences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) questionnaires; a missing score is valid and counts as the default."""
    ok = F.lit(True)
    for c in LIKERT_COLUMNS:
        ok = ok & (F.col(c).isNull() | likert_value(c).isNotNull())
    valid = preferences.where(ok).withColumns(
        {c: F.coalesce(likert_value(c), F.lit(3)) for c in LIKERT_COLUMNS}
    )
    return valid, preferences.where(~ok)


def with_query_text(preferences: DataFrame) -> DataFrame:
    return preferences.withColumn("query_text", query_text("description", "favorite_books"))


def default_encoder(catalog: DataFrame, text_col: str = "text_full") -> Encode:
    """Encoder fitted on the catalogue text, for corpus and questions alike."""
    model = fit_encoder(catalog, text_col)
    return lambda df, col: encode_text(model, df, col)


def build_vectors(
    spark: SparkSession, catalog: DataFrame, encode: Encode, path: str, force_rebuild: bool = False
) -> DataFrame:
    """(book_id, read_keys, embedding) table, written once.

    The already-read keys of a title travel with its vector, so ranking needs no join.
    """
    return materialize(
        spark,
        path,
        lambda: encode(
            catalog.select("book_id", "text_full", read_keys("title").alias("read_keys")), "text_full"
        ).select("book_id", "read_keys", "embedding"),
        force_rebuild,
    )


def already_read(
    catalog: DataFrame, favourites: DataFrame, title: str = "title", id_col: str = "book_id"
) -> DataFrame:
    """(query_id, book_id) of the books each questionnaire already names.

    An equality join of title prefixes with favourite titles; no pair is tested that does not
    match. Favourites meet the distinct titles (a title's keys tell its readers), so the pairs of
    books are never compared with each other: an id on several rows with other titles alone needs
    that.
    """
    wanted = favourites.select(
        "query_id", F.explode(favourite_keys("favorite_books")).alias("_key")
    ).distinct()
    offered = spread(catalog.select(id_col, F.array_sort(read_keys(title)).alias("_keys")), id_col)
    keyed = offered.select("_keys").distinct().select("_keys", F.explode("_keys").alias("_key"))
    # Dealt before they are counted once, so that no task holds more than its part of the pairs.
    readers = keyed.join(wanted, "_key").select("_keys", "query_id").repartition("_keys", "query_id").distinct()
    books = offered.groupBy(id_col).agg(F.min("_keys").alias("_keys"), F.max("_keys").alias("_last"))
    alike = F.col("_keys") == F.col("_last")
    single = books.where(alike).join(readers, "_keys").select("query_id", id_col)
    mixed = books.where(~alike).select(F.col(id_col).alias("_mixed"))
    rest = offered.join(mixed, F.col(id_col).eqNullSafe(F.col("_mixed")), "left_semi")
    several = rest.join(readers, "_keys").select("query_id", id_col).distinct()
    return single.unionByName(several)


def exclude_read(catalog: DataFrame, favourites: str, title: str = "title") -> DataFrame:
    """The catalogue without the books one reader names."""
    if not favourites.strip():
        return catalog
    named = F.lit(favourites)
    return catalog.where(~F.arrays_overlap(read_keys(title), favourite_keys(named)))


def rank_books(
    questions: DataFrame, vectors: DataFrame, k: int = TOP_K, **options
) -> DataFrame:
    """(query_id, book_id, rank, similarity, score, score_pct) of the k best unread books.

    ``questions`` needs query_id, embedding, favorite_books and the Likert columns; ``vectors``
    needs book_id, embedding and read_keys. The Likert part of the score is one number per
    question, so ranking by similarity is ranking by score, and it is added to winners only. A
    ``query_id`` on several rows is one question, the smallest row by its columns in order.
    """
    spark = questions.sparkSession
    needed = ["query_id", "embedding", "favorite_books", *LIKERT_COLUMNS]
    # Read by the measuring, the search and the score: written once.
    unique = unique_rows(questions, "query_id").select(*needed)
    questions = materialize(spark, scratch_path(spark, "questions"), lambda: unique)
    asked = questions.withColumn("_fav", favourite_keys("favorite_books"))
    found = nearest(
        asked, vectors, k, "query_id", "book_id", left_keys="_fav", right_keys="read_keys", unique_left=True, **options
    )
    likert = questions.select(F.col("query_id").alias("left_id"), likert_mean().alias("_likert"))
    score = weighted_score(F.col("similarity"), F.col("_likert"))
    return found.join(likert, "left_id").select(
        F.col("left_id").alias("query_id"),
        F.col("right_id").alias("book_id"),
        "rank",
        "similarity",
        score.alias("score"),
        (score * 100).alias("score_pct"),
    )


def axis_profile(vector: Column | str, anchors: DataFrame) -> Column:
    """Level of a book on each axis; ``anchors`` is (axis, embedding), one row per axis."""
    # Four vectors, whatever the catalogue: they become literals of the projection.
    wanted = anchors.where(F.col("axis").isin(list(AXIS_LIKERT))).select("axis", "embedding").limit(len(AXIS_LIKERT))
    known = {r["axis"]: [float(x) for x in r["embedding"]] for r in wanted.collect()}
    return F.struct(
        *[axis_level(cosine(vector, F.lit(known[axis]))).alias(axis) for axis in AXIS_LIKERT]
    )


def axis_anchors(spark: SparkSession, encode: Encode) -> DataFrame:
    """(axis, embedding) of the anchor sentences."""
    sentences = spark.createDataFrame(list(AXIS_SENTENCES.items()), "axis string, sentence string")
    return encode(sentences, "sentence").select("axis", "embedding")


def describe_books(
    ranked: DataFrame, catalog: DataFrame, vectors: DataFrame | None = None, anchors: DataFrame | None = None
) -> DataFrame:
    """Display columns of ranked books, with the axis profile if anchors are given.

    ``ranked`` holds k rows per question. The catalogue side is read with the shown columns only.
    """
    shown = catalog.select(
        "book_id",
        "title",
        format_text("authors_clean").alias("author"),
        format_genre("genre_clean").alias("genre"),
        format_number("year").alias("year"),
        format_text("series").alias("series"),
        format_text("language").alias("language"),
        format_number("pages").alias("pages"),
        format_number("rating").alias("rating"),
        F.coalesce(F.nullif(F.col("desc_display"), F.lit("")), F.lit(NO_DESCRIPTION)).alias("description"),
    )
    out = ranked.join(shown, "book_id")
    if vectors is not None and anchors is not None:
        out = out.join(vectors.select("book_id", "embedding"), "book_id")
        out = out.withColumn("axis_profile", axis_profile("embedding", anchors)).drop("embedding")
    return out


def recommend(
    preferences: DataFrame,
    catalog: DataFrame,
    vectors: DataFrame,
    encode: Encode,
    k: int = TOP_K,
    anchors: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Recommendations of every valid questionnaire, one row per (query_id, rank)."""
    spark = preferences.sparkSession
    valid, _ = split_valid(preferences)
    questions = encode(with_query_text(valid), "query_text")
    # The winners are few; written once, their size is known and scoring is not repeated, so the
    # planner can broadcast them to the catalogue scan instead of shuffling the catalogue.
    winners = materialize(spark, scratch_path(spark, "winners"), lambda: rank_books(questions, vectors, k, **options))
    return describe_books(winners, catalog, vectors, anchors)


def session_results(
    preferences: DataFrame, recommendations: DataFrame, quality: DataFrame | None = None
) -> DataFrame:
    """One document per questionnaire: answers, query text, wanted profile, ranked books.

    ``quality`` adds the checked summary of a questionnaire where there is one.
    """
    # At most k books per questionnaire are collected into its list.
    books = F.struct("rank", *[c for c in recommendations.columns if c not in ("query_id", "rank")])
    listed = recommendations.groupBy("query_id").agg(F.array_sort(F.collect_list(books)).alias("recommendations"))
    answers = with_query_text(preferences)
    out = answers.join(listed, "query_id").select(
        "query_id",
        F.struct(*preferences.columns).alias("preferences"),
        "query_text",
        user_profile().alias("user_profile"),
        "recommendations",
    )
    if quality is None:
        return out
    checks = F.struct(*[c for c in quality.columns if c not in ("query_id", "summary")])
    return out.join(quality.select("query_id", "summary", checks.alias("genai_quality")), "query_id", "left")
