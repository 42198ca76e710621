"""TF-IDF keywords over a capped vocabulary."""

from __future__ import annotations

from string import ascii_letters, digits

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank
from ..session import scratch_path
from ..sources.storage import materialize

# ASCII letters and digits are listed too: a table lookup each, before the Unicode classes are asked.
TOKEN_PATTERN = rf"[{ascii_letters}{digits}_\p{{L}}\p{{N}}]{{2,}}"
MAX_TERMS = 5000


def default_stop_words() -> list[str]:
    """MLlib's English list (needs a running session)."""
    return StopWordsRemover.loadDefaultStopWords("english")


def term_counts(text: Column) -> Column:
    """Array of (term, tf) of one text.

    Tokens are sorted and each run of equal tokens is measured, so counting is local to the row:
    no per-document shuffle. Intermediate arrays are bound to lambda variables to be built once.
    """
    tokens = F.sort_array(F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0)))

    def runs(s: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(1), F.size(s)),
            lambda i: (i == 1) | (F.get(s, i - 1) != F.get(s, i - 2)),
        )
        return F.transform(
            F.array(starts),
            lambda st: F.transform(
                st,
                lambda p, j: F.struct(
                    F.get(s, p - 1).alias("term"),
                    (F.coalesce(F.get(st, j + 1), F.size(s) + 1) - p).alias("tf"),
                ),
            ),
        )[0]

    return F.transform(
        F.array(tokens), lambda s: F.when(F.size(s) > 0, runs(s))
    )[0]


def document_terms(
    df: DataFrame, id_col: str, text_col: str, stop_words: list[str] | None = None, nested: bool = False
) -> DataFrame:
    """(id, term, tf) of every non-blank document, stop words removed; no shuffle.

    ``nested``: one row (id, _terms) per document instead, with its (term, tf) as an array.
    """
    stop = stop_words if stop_words is not None else default_stop_words()
    found = F.filter(term_counts(F.col(text_col)), lambda t: ~t["term"].isin(stop))
    rows = df.where(~is_blank(text_col)).select(F.col(id_col), found.alias("_terms"))
    return rows if nested else rows.select(id_col, F.inline("_terms"))


def vocabulary(
    terms: DataFrame, documents: DataFrame, text_col: str, max_terms: int = MAX_TERMS
) -> DataFrame:
    """The ``max_terms`` most frequent terms with their smoothed idf.

    Partial aggregation leaves one row per term and task before the shuffle.
    """
    total = documents.where(~is_blank(text_col)).agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        terms.groupBy("term")
        .agg(F.sum("tf").alias("corpus_count"), F.count(F.lit(1)).alias("document_count"))
        .orderBy(F.desc("corpus_count"), "term")
        .limit(max_terms)
        .withColumn("idf", F.log((1 + total) / (1 + F.col("document_count"))) + 1)
    )


def keyword_weights(
    df: DataFrame,
    id_col: str = "book_id",
    text_col: str = "desc_clean",
    top_n: int = 5,
    max_terms: int = MAX_TERMS,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """Best ``top_n`` vocabulary terms per document: (id, term, weight, rank).

    The vocabulary holds at most ``max_terms`` rows, which bounds its broadcast. All terms of a
    document sit in one input partition, so the ranking window drops everything beyond
    ``top_n`` before its shuffle. Vocabulary and weights both read the terms, which are found once
    and written.
    """
    spark = df.sparkSession
    terms = materialize(
        spark, scratch_path(spark, "terms"), lambda: document_terms(df, id_col, text_col, stop_words, nested=True)
    ).select(id_col, F.inline("_terms"))
    vocab = vocabulary(terms, df, text_col, max_terms).select("term", "idf")
    weighted = terms.join(F.broadcast(vocab), "term").select(
        id_col, "term", F.round(F.col("tf") * F.col("idf"), 6).alias("weight")
    )
    ranked = Window.partitionBy(id_col).orderBy(F.desc("weight"), "term")
    return weighted.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top_n)


def extract_keywords(df: DataFrame, id_col: str = "book_id", **options) -> DataFrame:
    """(id, keywords) with the keywords of a document as an array in rank order."""
    best = F.sort_array(F.collect_list(F.struct("rank", "term")))
    return (
        keyword_weights(df, id_col, **options)
        .groupBy(id_col)
        .agg(F.transform(best, lambda t: t["term"]).alias("keywords"))
    )
