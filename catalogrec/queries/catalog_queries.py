"""Catalogue building over stand-in sources derived from part, documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dedup import dedup_merge
from ..operators.keywords import keyword_weights
from ..operators.statistics import corpus_statistics
from ..plans.catalog import build_catalog_from, clean_rows, observed_steps
from ..plans.recommend import already_read, exclude_read
from ..session import scratch_path
from ..sources.catalog_csv import (
    from_source_1,
    from_source_2,
    from_source_3,
    load_source_1,
    load_source_2,
    load_source_3,
    merge_sources,
    read_csv,
    source_counts,
)
from . import sql as q
from .tables import table, texts
from .text_queries import category_of, category_sql

# Stop words passed to the keyword queries (the operator's default needs a session to load).
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "it", "on", "for", "by", "with", "as", "at", "or", "was", "are"]


def raw_source_1(spark, d):
    """Parts as a catalogue without authors: 384 titles, so most rows are copies of a title."""
    stars = F.when(F.col("p_size") % 9 == 0, F.lit("n/a")).otherwise((F.col("p_size") / 10).cast("string"))
    description = F.concat_ws(" ", "p_name", "p_brand", F.when(F.col("p_size") > 25, F.concat(F.lit("by "), F.col("p_type"))))
    return texts(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size").select(
        "p_partkey",
        F.concat_ws(" ", F.initcap("p_name"), "p_type").alias("Title"),
        F.when(F.col("p_partkey") % 23 != 0, description).alias("Book_Description"),
        stars.alias("Stars"),
        category_of(F.col("p_partkey")).alias("Category"),
    )


def raw_source_2(spark, d):
    """Documents titled by their first three words; every third source has no author."""
    words = F.split("text", r"\s+", 4)
    number = F.substring("source", 4, 10).cast("int")
    return texts(spark, d, "documents", "doc_id", "text", "source", "lang").select(
        "doc_id",
        F.concat_ws(" ", F.slice(words, 1, 3)).alias("Title"),
        F.when(number % 3 != 0, F.concat(F.lit("By "), F.col("source"), F.lit(", X"))).alias("Authors"),
        F.col("text").alias("Description"),
        F.when(F.col("doc_id") % 4 != 0, (F.col("doc_id") % 140 + 1880).cast("string")).alias("Publish Date (Year)"),
        F.when(F.col("doc_id") % 6 != 0, F.concat(F.lit("Fiction , "), F.col("lang"))).alias("Category"),
    )


def raw_source_3(spark, d):
    """Web pages: title tag, site as author, html as description."""
    site = F.regexp_extract("url", r"https?://([^/]+)/", 1)
    return texts(spark, d, "pages", "page_id", "url", "html").select(
        "page_id",
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.concat(site, F.lit(" (Site), Web")).alias("author"),
        F.col("html").alias("description"),
        F.concat(F.lit("Saga "), (F.col("page_id") % 5).cast("string")).alias("series"),
        F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("language"),
        F.concat((F.col("page_id") % 900).cast("string"), F.lit(" pages")).alias("pages"),
        F.lit("4.25").alias("rating"),
        F.concat(F.lit("['Young Adult', '"), F.col("page_id").cast("string"), F.lit("']")).alias("genres"),
        F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("June "), (F.col("page_id") % 60 + 1960).cast("string"))).alias("firstPublishDate"),
        F.lit("09/14/2008").alias("publishDate"),
    )


_N = "CAST(NULL AS {})".format
MERGED_SQL = f"""
    s1 AS (
      SELECT p_partkey AS book_id,
        array_to_string([upper(substr(w, 1, 1)) || substr(w, 2) for w in string_split(p_name, ' ')], ' ') || ' ' || p_type AS title,
        {_N('VARCHAR')} AS authors,
        CASE WHEN p_partkey % 23 <> 0 THEN concat_ws(' ', p_name, p_brand, CASE WHEN p_size > 25 THEN 'by ' || p_type END) END AS description,
        {_N('DOUBLE')} AS year, {_N('VARCHAR')} AS series, {_N('VARCHAR')} AS language, {_N('DOUBLE')} AS pages,
        CASE WHEN p_size % 9 <> 0 THEN CAST(p_size AS DOUBLE) / 10.0::DOUBLE END AS rating,
        {category_sql('p_partkey')} AS genres_raw, 'book_dataset_1' AS source FROM part),
    s2 AS (
      SELECT 576460752303423488 + doc_id AS book_id,
        array_to_string(list_slice(string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' '), 1, 3), ' ') AS title,
        CASE WHEN CAST(substr(source, 4) AS INTEGER) % 3 <> 0 THEN 'By ' || source || ', X' END AS authors,
        text AS description,
        CASE WHEN doc_id % 4 <> 0 THEN CAST(doc_id % 140 + 1880 AS DOUBLE) END AS year,
        {_N('VARCHAR')} AS series, {_N('VARCHAR')} AS language, {_N('DOUBLE')} AS pages, {_N('DOUBLE')} AS rating,
        CASE WHEN doc_id % 6 <> 0 THEN 'Fiction , ' || lang END AS genres_raw, 'books_dataset_clean' AS source FROM documents),
    s3 AS (
      SELECT 2 * 576460752303423488 + page_id AS book_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
        regexp_extract(url, 'https?://([^/]+)/', 1) || ' (Site), Web' AS authors, html AS description,
        CASE WHEN page_id % 2 = 0 THEN CAST(page_id % 60 + 1960 AS DOUBLE) ELSE 2008.0::DOUBLE END AS year,
        'Saga ' || page_id % 5 AS series, regexp_extract(html, 'lang="([a-z]+)"', 1) AS language,
        CAST(page_id % 900 AS DOUBLE) AS pages, 4.25::DOUBLE AS rating,
        'Young Adult, ' || page_id AS genres_raw, 'best_books_ever' AS source FROM pages),
    merged AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3)"""

_FILL = {"authors": "''", "year": None, "series": "''", "language": "''", "pages": None, "rating": None, "genres_raw": "''"}


def _filled_sql(c: str, empty: str | None) -> str:
    present = f"{c} IS NOT NULL" + (f" AND {c} <> {empty}" if empty else "")
    return f"arg_min({c}, book_id) FILTER (WHERE {present}) OVER (PARTITION BY tk) AS fill_{c}"


DEDUP_SQL = f"""
    keyed AS (
      SELECT *, {q.title_key('title')} AS tk, {q.author_key('authors')} AS ak,
        coalesce(length(description), 0) AS dl FROM merged),
    grouped AS (
      SELECT tk, count(*) AS n, count(DISTINCT ak) AS n_authors FROM keyed GROUP BY tk),
    windowed AS (
      SELECT *, row_number() OVER (PARTITION BY tk ORDER BY dl DESC, book_id) AS place,
        {', '.join(_filled_sql(c, e) for c, e in _FILL.items())} FROM keyed),
    deduped AS (
      SELECT w.book_id, title,
        {', '.join(
            (f"CASE WHEN n > 1 AND n_authors <= 1 AND ({c} IS NULL" + (f" OR {c} = {e}" if e else "")
             + f") THEN coalesce(fill_{c}, {c}) ELSE {c} END AS {c}") for c, e in _FILL.items())},
        description, source
      FROM windowed w JOIN grouped g USING (tk) WHERE n = 1 OR n_authors > 1 OR place = 1)"""

_MERGED_COLUMNS = "book_id, title, authors, description, year, series, language, pages, rating, genres_raw, source"


def merged(spark, d):
    frames = [
        from_source_1(raw_source_1(spark, d), F.col("p_partkey")),
        from_source_2(raw_source_2(spark, d), F.col("doc_id")),
        from_source_3(raw_source_3(spark, d), F.col("page_id")),
    ]
    return merge_sources(frames)


def _source_counts(spark, d):
    return source_counts(merged(spark, d))


def _dedup(spark, d):
    return dedup_merge(merged(spark, d))


def _step_counts(spark, d):
    """The counts observed while the clean rows are computed, as the build computes them."""
    observed = []
    clean_rows(merged(spark, d), observed=observed).write.format("noop").mode("overwrite").save()
    return observed_steps(spark, observed)


def _keywords(spark, d):
    docs = texts(spark, d, "documents", "doc_id", "text")
    return keyword_weights(docs, "doc_id", "text", stop_words=STOP_WORDS).select("doc_id", "rank", "term", "weight")


CATALOG_COLUMNS = (
    "book_id, title, source, year, series, language, pages, rating, title_clean, authors_clean, desc_clean, "
    "genre_clean, period, desc_display, keywords, text_full"
)
CATALOG_SQL = f"""{MERGED_SQL}, {DEDUP_SQL},
    cleaned AS (
      SELECT *, {q.clean('title')} AS title_clean, {q.clean_authors('authors')} AS authors_clean,
        {q.clean('description')} AS desc_clean, {q.genre('genres_raw')} AS genre_clean,
        {q.period('year')} AS period, {q.truncated('description', 150)} AS desc_display
      FROM deduped WHERE title IS NOT NULL AND description IS NOT NULL),
    {q.keywords('cleaned', 'book_id', 'desc_clean', STOP_WORDS)},
    tags AS (SELECT book_id, string_agg(term, ', ' ORDER BY rank) AS keywords FROM best GROUP BY book_id),
    catalog AS (
      SELECT cleaned.*, coalesce(keywords, '') AS keywords,
        title_clean || '. ' || genre_clean || '. ' || {q.truncated('desc_clean', 200)} AS text_full
      FROM cleaned LEFT JOIN tags USING (book_id))"""


def catalog(spark, d):
    return build_catalog_from(merged(spark, d), stop_words=STOP_WORDS)


def _build_catalog(spark, d):
    return catalog(spark, d).select(*[c.strip() for c in CATALOG_COLUMNS.split(",")])


def _corpus_stats(spark, d):
    stats = corpus_statistics(clean_rows(merged(spark, d)))
    return stats.select("metric", "key", F.round("value", 6).alias("value"))


_CORPUS_SQL = f"""WITH {CATALOG_SQL},
    counts AS (
      SELECT 'sources' AS metric, source AS key, CAST(count(*) AS DOUBLE) AS value FROM catalog GROUP BY source
      UNION ALL SELECT 'period_distribution', period, CAST(count(*) AS DOUBLE) FROM catalog GROUP BY period
      UNION ALL (SELECT 'top_genres', genre_clean, CAST(count(*) AS DOUBLE) AS n FROM catalog
        GROUP BY genre_clean ORDER BY n DESC, genre_clean LIMIT 15)
      UNION ALL (SELECT 'language_distribution', language, CAST(count(*) AS DOUBLE) AS n FROM catalog
        WHERE language IS NOT NULL GROUP BY language ORDER BY n DESC, language LIMIT 10)
      UNION ALL SELECT 'total_books', NULL, CAST(count(*) AS DOUBLE) FROM catalog
      UNION ALL SELECT 'unique_genres', NULL, CAST(count(DISTINCT genre_clean) AS DOUBLE) FROM catalog
      UNION ALL SELECT 'missing_authors', NULL, CAST(count(*) FILTER (WHERE trim(authors_clean) = '') AS DOUBLE) FROM catalog
      UNION ALL SELECT 'missing_year', NULL, CAST(count(*) - count(year) AS DOUBLE) FROM catalog
      UNION ALL SELECT 'average_description_length_words', NULL, avg({q.word_count('desc_clean')}) FROM catalog)
    SELECT metric, key, round(value, 6) AS value FROM counts"""


def _csv_sources(spark, d):
    """Write the raw sources as CSV, read them with the loaders, count and compare by content."""
    folder = scratch_path(spark, "csv")
    raw = {"1": raw_source_1(spark, d), "2": raw_source_2(spark, d), "3": raw_source_3(spark, d)}
    keys = {"1": "p_partkey", "2": "doc_id", "3": "page_id"}
    for name, df in raw.items():
        # Written in key order, so that a row's place in the files (its book_id) is known to SQL.
        df = df.orderBy(keys[name])
        # Latin-1 for the first file, as its loader expects.
        encoding = "ISO-8859-1" if name == "1" else "UTF-8"
        (
            df.write.option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("encoding", encoding)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(f"{folder}/{name}")
        )
    frames = [
        load_source_1(spark, f"{folder}/1"),
        load_source_2(spark, f"{folder}/2"),
        load_source_3(spark, f"{folder}/3"),
    ]
    return merge_sources(frames)


def _csv_inferred(spark, d):
    """Orders as CSV with missing cells in a number column, types inferred on reading."""
    path = scratch_path(spark, "csv-inferred")
    price = F.when(F.col("o_orderkey") % 5 == 0, F.lit("NA")).otherwise(F.col("o_totalprice").cast("string"))
    table(spark, d, "orders").withColumn("o_totalprice", price).write.option("header", True).csv(path)
    return read_csv(spark, path, infer=True).withColumns(
        {"o_orderkey": F.col("o_orderkey").cast("long"), "o_custkey": F.col("o_custkey").cast("long")}
    )


# --- already-read exclusion --------------------------------------------------------------------


def titled_parts(spark, d):
    """Parts with four title shapes: bare, bracketed edition, subtitle, longer name."""
    shape = F.col("p_partkey") % 4
    title = (
        F.when(shape == 0, F.initcap("p_name"))
        .when(shape == 1, F.concat("p_name", F.lit(" (Edition "), "p_brand", F.lit(")")))
        .when(shape == 2, F.concat("p_name", F.lit(": "), "p_type"))
        .otherwise(F.concat("p_name", F.lit(" of the "), "p_type"))
    )
    return table(spark, d, "part").select(F.col("p_partkey").alias("book_id"), title.alias("title"))


TITLED_SQL = """(SELECT p_partkey AS book_id, CASE p_partkey % 4 WHEN 0 THEN upper(p_name)
    WHEN 1 THEN p_name || ' (Edition ' || p_brand || ')' WHEN 2 THEN p_name || ': ' || p_type
    ELSE p_name || ' of the ' || p_type END AS title FROM part)"""


def _favourites(spark, d):
    """One reader per nation, who names the parts of the sizes dealt to it (every size has a reader)."""
    nations = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("query_id"))
    readers = max(1, nations.count())
    named = table(spark, d, "part").select(
        F.pmod(F.col("p_size") - 1, F.lit(readers)).cast("long").alias("query_id"), "p_name"
    )
    liked = named.distinct().groupBy("query_id").agg(F.sort_array(F.collect_list("p_name")).alias("_names"))
    return nations.join(liked, "query_id").select("query_id", F.array_join("_names", " , ").alias("favorite_books"))


def _already_read(spark, d):
    return already_read(titled_parts(spark, d), _favourites(spark, d))


MATCHES_SQL = """(t = f OR (starts_with(t, f) AND regexp_matches(substr(t, length(f) + 1), '^\\s*[(:,\\-][^\\n]*$')))"""


def _unread(spark, d):
    return exclude_read(titled_parts(spark, d), "Red Widget, blue bolt ,, small ring").select("book_id")


QUERIES = {
    "merge_sources": (merged, f"WITH {MERGED_SQL} SELECT {_MERGED_COLUMNS} FROM merged"),
    "source_counts": (
        _source_counts,
        f"WITH {MERGED_SQL} SELECT source, count(*) AS count FROM merged GROUP BY source",
    ),
    "dedup_merge": (_dedup, f"WITH {MERGED_SQL}, {DEDUP_SQL} SELECT {_MERGED_COLUMNS} FROM deduped"),
    "step_counts": (
        _step_counts,
        f"""WITH {MERGED_SQL}, {DEDUP_SQL},
        n AS (SELECT (SELECT count(*) FROM merged) AS m, (SELECT count(*) FROM deduped) AS d,
          (SELECT count(*) FROM deduped WHERE title IS NOT NULL AND description IS NOT NULL) AS c)
        SELECT 'dedup' AS step, m AS rows_before, d AS rows_after, m - d AS rows_removed FROM n
        UNION ALL SELECT 'drop_incomplete', d, c, d - c FROM n""",
    ),
    "keywords_tfidf": (
        _keywords,
        f"""WITH {q.keywords('documents', 'doc_id', 'text', STOP_WORDS)}
        SELECT doc_id, CAST(rank AS INTEGER) AS rank, term, weight FROM best""",
    ),
    "build_catalog": (_build_catalog, f"WITH {CATALOG_SQL} SELECT {CATALOG_COLUMNS} FROM catalog"),
    "corpus_stats": (_corpus_stats, _CORPUS_SQL),
    "csv_sources": (
        _csv_sources,
        f"""WITH {MERGED_SQL} SELECT
        CASE source WHEN 'book_dataset_1' THEN 0 WHEN 'books_dataset_clean' THEN 1 ELSE 2 END * 576460752303423488
          + row_number() OVER (PARTITION BY source ORDER BY book_id) - 1 AS book_id,
        title, authors, description, year, series, language, pages, rating,
        nullif(genres_raw, '') AS genres_raw, source FROM merged""",
    ),
    "csv_inferred": (
        _csv_inferred,
        """SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS o_totalprice,
        CAST(o_orderdate AS TIMESTAMP) AS o_orderdate, o_orderpriority FROM orders""",
    ),
    "already_read": (
        _already_read,
        f"""WITH b AS (SELECT book_id, lower(title) AS t FROM {TITLED_SQL}),
        f AS (SELECT DISTINCT n_nationkey AS query_id, p_name AS f FROM nation
              JOIN part ON (p_size - 1) % (SELECT count(*) FROM nation) = n_nationkey)
        SELECT DISTINCT CAST(query_id AS BIGINT) AS query_id, book_id FROM b JOIN f ON {MATCHES_SQL}""",
    ),
    "exclude_read": (
        _unread,
        f"""WITH b AS (SELECT book_id, lower(title) AS t FROM {TITLED_SQL}),
        f AS (SELECT unnest(['red widget', 'blue bolt', 'small ring']) AS f)
        SELECT book_id FROM b WHERE NOT EXISTS (SELECT 1 FROM f WHERE {MATCHES_SQL})""",
    ),
}
