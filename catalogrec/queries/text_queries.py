"""Scalar operators over the text and key columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.labels import CATEGORY_GENRES, format_genre, format_number, format_text, period_bucket, with_genre
from ..functions.questionnaire import (
    LIKERT_COLUMNS,
    LIKERT_DESCRIPTORS,
    enrich_short,
    is_usable_summary,
    likert_mean,
    query_text,
    suggested_titles,
    suggestion_text,
    user_profile,
)
from ..functions.text import (
    author_key,
    clean_authors,
    clean_text,
    contains_ci,
    extract_number,
    extract_year,
    first_list_item,
    first_segment,
    is_blank,
    list_text,
    lookup_key,
    repair_text,
    text_prefix,
    title_key,
    to_number,
    truncate_words,
    word_count,
)
from ..plans.benchmark import known_labels
from ..plans.catalog import drop_incomplete
from ..plans.recommend import split_valid
from . import sql as q
from .tables import table, texts

CATEGORIES = [*CATEGORY_GENRES, "", "Zzz", ",Fiction"]
CATEGORY_LIST = q.listed(CATEGORIES)


def category_of(key):
    """A raw category for every row, walking through the dictionary keys."""
    return F.get(F.array(*[F.lit(c) for c in CATEGORIES]), (key % len(CATEGORIES)).cast("int"))


def category_sql(key: str) -> str:
    return f"list_extract({CATEGORY_LIST}, CAST({key} % {len(CATEGORIES)} AS INTEGER) + 1)"


def _clean_text(spark, d):
    return texts(spark, d, "documents", "doc_id", "text").select("doc_id", clean_text("text").alias("desc_clean"))


def _truncate(spark, d):
    return texts(spark, d, "documents", "doc_id", "text").select("doc_id", truncate_words("text", 50).alias("desc_display"))


def _word_count(spark, d):
    return texts(spark, d, "documents", "doc_id", "text").select("doc_id", word_count("text").alias("n_words"))


def _embedding_text(spark, d):
    body = clean_text("text")
    return texts(spark, d, "documents", "doc_id", "text", "source", "lang").select(
        "doc_id",
        F.concat_ws(". ", clean_text("source"), "lang", truncate_words(body, 200)).alias("text_full"),
        F.concat_ws(" ", clean_text("source"), truncate_words(body, 100)).alias("text_leak_free"),
    )


def _mojibake(spark, d):
    once = lambda t: F.decode(F.encode(t, "UTF-8"), "ISO-8859-1")
    coloured = F.concat(F.lit("\x1b[1;31m"), F.col("text"), F.lit("\x1b[0m"))
    return texts(spark, d, "documents", "doc_id", "text").select(
        "doc_id",
        repair_text(once("text")).alias("from_damaged"),
        repair_text("text").alias("from_sound"),
        repair_text(once(once("text"))).alias("from_twice"),
        repair_text(coloured).alias("from_terminal"),
    )


_AUTHOR_SQL = "(' By ' || source || ' (Editor), ' || lang || ' ,')"


def _authors(spark, d):
    raw = F.concat(F.lit(" By "), F.col("source"), F.lit(" (Editor), "), F.col("lang"), F.lit(" ,"))
    return table(spark, d, "documents").select(
        "doc_id", clean_authors(raw).alias("authors_clean"), author_key(raw).alias("author_key")
    )


def _title_keys(spark, d):
    name = F.concat(F.lit(" "), F.upper("p_name"), F.lit(" \t "), F.col("p_brand"), F.lit(" "))
    return table(spark, d, "part").select(
        "p_partkey", title_key(name).alias("title_key"), lookup_key(name).alias("lookup_key")
    )


def _year(spark, d):
    short = F.date_format("o_orderdate", "MM/dd/yy")
    full = F.date_format("o_orderdate", "MMMM d yyyy")
    first = F.when(F.col("o_orderkey") % 2 == 0, full).otherwise(short)
    return table(spark, d, "orders").select(
        "o_orderkey",
        extract_year(first).alias("first_year"),
        F.coalesce(extract_year(first), extract_year(full)).alias("year"),
    )


def _number(spark, d):
    text = F.when(F.col("event_id") % 3 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    return table(spark, d, "events").select(
        "event_id", extract_number("props").alias("first_number"), to_number(text).alias("value_number")
    )


def _list_text(spark, d):
    kind = F.col("p_size") % 10
    raw = (
        F.when(kind == 0, F.lit("[]"))
        .when(kind == 1, F.concat(F.lit("['"), F.col("p_type"), F.lit("'")))
        .when(kind == 2, F.concat(F.lit("  "), F.col("p_type"), F.lit(", X ")))
        .otherwise(F.concat(F.lit("['"), F.col("p_type"), F.lit("', \""), F.col("p_brand"), F.lit("'s\"]")))
    )
    return table(spark, d, "part").select(
        "p_partkey", list_text(raw).alias("genres"), first_list_item(raw).alias("first_genre")
    )


def _genre_map(spark, d):
    raw = F.when(
        F.col("p_partkey") % 17 != 0,
        F.concat(F.lit(" "), F.initcap(category_of(F.col("p_partkey"))), F.lit(" , "), F.col("p_type")),
    )
    return with_genre(table(spark, d, "part").select("p_partkey", raw.alias("genres_raw"))).withColumn(
        "genre_label", format_genre("genre_clean")
    )


_GENRE_RAW_SQL = f"""CASE WHEN p_partkey % 17 <> 0 THEN ' ' || array_to_string(
    [upper(substr(w, 1, 1)) || lower(substr(w, 2)) for w in string_split({category_sql('p_partkey')}, ' ')], ' ')
    || ' , ' || p_type END"""


def _period(spark, d):
    shifted = (F.year("o_orderdate") - F.col("o_orderkey") % 150).cast("double")
    year = F.when(F.col("o_orderkey") % 11 != 0, shifted)
    return table(spark, d, "orders").select("o_orderkey", period_bucket(year).alias("period"))


def _format_value(spark, d):
    price = F.when(F.col("p_size") % 7 != 0, F.col("p_retailprice"))
    text = F.when(F.col("p_size") % 5 == 0, F.lit(" NaN ")).otherwise(F.concat(F.lit(" "), F.col("p_name")))
    return table(spark, d, "part").select(
        "p_partkey",
        format_number(price).alias("price"),
        format_number("p_size", " p.").alias("size"),
        format_text(text).alias("name"),
    )


def _first_segment(spark, d):
    raw = F.concat(F.col("p_type"), F.lit(","), F.col("p_brand"))
    return table(spark, d, "part").select("p_partkey", first_segment(raw).alias("category"))


def _fill_missing(spark, d):
    gaps = F.when(F.col("lang") != "de", F.col("lang"))
    return table(spark, d, "documents").select("doc_id", gaps.alias("lang")).na.fill("Unknown", ["lang"])


def _text_prefix(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", text_prefix("text", 200).alias("shown"))


def _with_gaps(spark, d):
    return table(spark, d, "documents").select(
        "doc_id",
        F.when(F.col("n_chars") % 7 != 0, F.col("source")).alias("title"),
        F.when(F.col("n_chars") % 5 != 0, F.col("text")).alias("description"),
    )


_WITH_GAPS_SQL = """(SELECT doc_id, CASE WHEN n_chars % 7 <> 0 THEN source END AS title,
    CASE WHEN n_chars % 5 <> 0 THEN text END AS description FROM documents)"""


def _drop_nulls(spark, d):
    return drop_incomplete(_with_gaps(spark, d))


def _known_genre(spark, d):
    return known_labels(_genre_map(spark, d)).select("p_partkey", "genre_clean")


def _contains_ci(spark, d):
    return _with_gaps(spark, d).where(contains_ci("description", "The On")).select("doc_id")


def _non_blank(spark, d):
    text = F.when(F.col("n_chars") % 3 == 0, F.lit(" \n ")).otherwise(F.col("text"))
    return table(spark, d, "documents").where(~is_blank(text)).select("doc_id")


def _usable(spark, d):
    text = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("["), F.col("text"))).otherwise(F.col("text"))
    return table(spark, d, "conversations").where(is_usable_summary(text)).select("conv_id", "turn")


def _in_set(spark, d):
    return table(spark, d, "documents").where(F.col("lang").isin("fr", "es")).select("doc_id", "lang")


# --- questionnaires derived from events --------------------------------------------------------


def questionnaires(spark, d):
    """One questionnaire per event; a score of 0 is invalid, a missing one counts as 3."""
    scores = {
        "intensity_action": F.col("user_id") % 6,
        "intensity_romance": F.when(F.col("event_id") % 9 != 0, F.col("event_id") % 5 + 1),
        "intensity_learning": F.col("user_id") % 5 + 1,
        "complexity": F.col("event_id") % 4 + 2,
    }
    return table(spark, d, "events").select(
        F.col("event_id").alias("query_id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("description"),
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("Item "), F.col("user_id").cast("string")))
        .otherwise(F.lit(""))
        .alias("favorite_books"),
        *[v.cast("int").alias(c) for c, v in scores.items()],
    )


QUESTIONNAIRES_SQL = """(SELECT event_id AS query_id,
    CASE WHEN event_type <> 'error' THEN event_type END AS description,
    CASE WHEN event_id % 3 <> 0 THEN 'Item ' || user_id ELSE '' END AS favorite_books,
    CAST(user_id % 6 AS INTEGER) AS intensity_action,
    CAST(CASE WHEN event_id % 9 <> 0 THEN event_id % 5 + 1 END AS INTEGER) AS intensity_romance,
    CAST(user_id % 5 + 1 AS INTEGER) AS intensity_learning,
    CAST(event_id % 4 + 2 AS INTEGER) AS complexity FROM events)"""
VALID_SQL = f"""(SELECT query_id, description, favorite_books, intensity_action,
    coalesce(intensity_romance, 3) AS intensity_romance, intensity_learning, complexity
    FROM {QUESTIONNAIRES_SQL} WHERE intensity_action BETWEEN 1 AND 5)"""


def _descriptor_sql(column: str) -> str:
    return f"list_extract({q.listed(LIKERT_DESCRIPTORS[column])}, {column})"


QUERY_TEXT_SQL = (
    "concat_ws('. ', nullif(description, ''), 'Livres similaires à : ' || nullif(favorite_books, ''), "
    + ", ".join(_descriptor_sql(c) for c in LIKERT_COLUMNS)
    + ")"
)


def _query_text(spark, d):
    valid, _ = split_valid(questionnaires(spark, d))
    return valid.select("query_id", query_text("description", "favorite_books").alias("query_text"))


def _likert_valid(spark, d):
    return split_valid(questionnaires(spark, d))[0].select("query_id", *LIKERT_COLUMNS)


def _likert_rejects(spark, d):
    return split_valid(questionnaires(spark, d))[1].select("query_id", "intensity_action")


def _likert_mean(spark, d):
    return questionnaires(spark, d).select("query_id", F.round(likert_mean(), 6).alias("likert_part"))


def _user_profile(spark, d):
    valid, _ = split_valid(questionnaires(spark, d))
    profile = valid.select("query_id", user_profile().alias("p"))
    return profile.select("query_id", *[F.round(f"p.{a}", 6).alias(a) for a in ("action", "romance", "learning", "complexity")])


def _enrich(spark, d):
    first_words = F.col("p_name")
    longer = F.concat_ws(" ", "p_name", "p_type", "p_brand", F.lit("book"))
    text = F.when(F.col("p_partkey") % 2 == 0, first_words).otherwise(longer)
    return table(spark, d, "part").select("p_partkey", enrich_short(text).alias("query_text"))


def _suggestions(spark, d):
    raw = F.concat(F.col("text"), F.lit("\nlivres_similaires : "), F.col("role"), F.lit(" |  | Book "), F.col("turn").cast("string"), F.lit(" | \nend"))
    raw = F.when(F.col("turn") % 4 == 3, F.col("text")).otherwise(raw)
    return table(spark, d, "conversations").select(
        "conv_id",
        "turn",
        suggestion_text(raw).alias("summary"),
        F.array_join(suggested_titles(raw), "|").alias("titles"),
    )


QUERIES = {
    "clean_text": (_clean_text, f"SELECT doc_id, {q.clean('text')} AS desc_clean FROM documents"),
    "truncate_words": (_truncate, f"SELECT doc_id, {q.truncated('text', 50)} AS desc_display FROM documents"),
    "word_count": (_word_count, f"SELECT doc_id, CAST({q.word_count('text')} AS INTEGER) AS n_words FROM documents"),
    "embedding_text": (
        _embedding_text,
        f"""WITH c AS (SELECT doc_id, lang, {q.clean('source')} AS s, {q.clean('text')} AS t FROM documents)
        SELECT doc_id, s || '. ' || lang || '. ' || {q.truncated('t', 200)} AS text_full,
        s || ' ' || {q.truncated('t', 100)} AS text_leak_free FROM c""",
    ),
    "mojibake_repair": (
        _mojibake,
        f"""SELECT doc_id, {q.repaired('text')} AS from_damaged, {q.repaired('text')} AS from_sound,
        {q.repaired('text')} AS from_twice, {q.repaired('text')} AS from_terminal FROM documents""",
    ),
    "author_clean": (
        _authors,
        f"""SELECT doc_id, {q.clean_authors(_AUTHOR_SQL)} AS authors_clean,
        {q.author_key(_AUTHOR_SQL)} AS author_key FROM documents""",
    ),
    "title_keys": (
        _title_keys,
        f"""WITH t AS (SELECT p_partkey, ' ' || upper(p_name) || ' ' || chr(9) || ' ' || p_brand || chr(160) AS name FROM part)
        SELECT p_partkey, {q.title_key('name')} AS title_key, lower({q.strip('name')}) AS lookup_key FROM t""",
    ),
    "extract_year": (
        _year,
        """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(year(o_orderdate) AS DOUBLE) END AS first_year,
        CAST(year(o_orderdate) AS DOUBLE) AS year FROM orders""",
    ),
    "extract_number": (
        _number,
        """SELECT event_id, TRY_CAST(nullif(regexp_extract(props, '\\d+'), '') AS DOUBLE) AS first_number,
        CASE WHEN event_id % 3 <> 0 THEN value END AS value_number FROM events""",
    ),
    "list_text_parse": (
        _list_text,
        """SELECT p_partkey, CASE p_size % 10 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN p_type || ', X'
          ELSE p_type || ', ' || p_brand || '''s' END AS genres,
        CASE WHEN p_size % 10 > 2 THEN p_type END AS first_genre FROM part""",
    ),
    "genre_map": (
        _genre_map,
        f"""WITH r AS (SELECT p_partkey, {_GENRE_RAW_SQL} AS genres_raw FROM part),
        g AS (SELECT *, {q.genre('genres_raw')} AS genre_clean FROM r)
        SELECT *, {q.format_genre('genre_clean')} AS genre_label FROM g""",
    ),
    "period_bucket": (
        _period,
        f"""WITH y AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0
          THEN CAST(year(o_orderdate) - o_orderkey % 150 AS DOUBLE) END AS y FROM orders)
        SELECT o_orderkey, {q.period('y')} AS period FROM y""",
    ),
    "format_value": (
        _format_value,
        f"""WITH v AS (SELECT p_partkey, p_size, CASE WHEN p_size % 7 <> 0 THEN p_retailprice END AS p,
          CASE WHEN p_size % 5 = 0 THEN ' NaN ' ELSE ' ' || p_name END AS t FROM part)
        SELECT p_partkey, {q.format_number('p')} AS price, {q.format_number('p_size')} || ' p.' AS size,
        {q.format_text('t')} AS name FROM v""",
    ),
    "first_segment": (_first_segment, "SELECT p_partkey, split_part(p_type || ',' || p_brand, ',', 1) AS category FROM part"),
    "fill_missing": (
        _fill_missing,
        "SELECT doc_id, coalesce(CASE WHEN lang <> 'de' THEN lang END, 'Unknown') AS lang FROM documents",
    ),
    "text_prefix": (_text_prefix, "SELECT conv_id, turn, substr(text, 1, 200) AS shown FROM conversations"),
    "drop_nulls": (
        _drop_nulls,
        f"SELECT * FROM {_WITH_GAPS_SQL} WHERE title IS NOT NULL AND description IS NOT NULL",
    ),
    "known_genre": (
        _known_genre,
        f"""WITH r AS (SELECT p_partkey, {_GENRE_RAW_SQL} AS genres_raw FROM part),
        g AS (SELECT p_partkey, {q.genre('genres_raw')} AS genre_clean FROM r)
        SELECT * FROM g WHERE genre_clean <> 'unknown'""",
    ),
    "contains_ci": (
        _contains_ci,
        f"SELECT doc_id FROM {_WITH_GAPS_SQL} WHERE contains(lower(description), 'the on')",
    ),
    "non_blank": (_non_blank, "SELECT doc_id FROM documents WHERE n_chars % 3 <> 0"),
    "usable_summary": (
        _usable,
        "SELECT conv_id, turn FROM conversations WHERE turn % 3 <> 0 AND text <> '' AND NOT starts_with(text, '[')",
    ),
    "in_set": (_in_set, "SELECT doc_id, lang FROM documents WHERE lang IN ('fr', 'es')"),
    "build_query_text": (_query_text, f"SELECT query_id, {QUERY_TEXT_SQL} AS query_text FROM {VALID_SQL}"),
    "likert_valid": (_likert_valid, f"SELECT query_id, {', '.join(LIKERT_COLUMNS)} FROM {VALID_SQL}"),
    "likert_rejects": (
        _likert_rejects,
        f"SELECT query_id, intensity_action FROM {QUESTIONNAIRES_SQL} WHERE intensity_action NOT BETWEEN 1 AND 5",
    ),
    "likert_mean": (
        _likert_mean,
        f"""SELECT query_id, round((intensity_action + coalesce(intensity_romance, 3) + intensity_learning + complexity)
        / 4.0::DOUBLE / 5.0::DOUBLE, 6) AS likert_part FROM {QUESTIONNAIRES_SQL}""",
    ),
    "user_profile": (
        _user_profile,
        f"""SELECT query_id, round(intensity_action / 5.0::DOUBLE * 100, 6) AS action,
        round(intensity_romance / 5.0::DOUBLE * 100, 6) AS romance, round(intensity_learning / 5.0::DOUBLE * 100, 6) AS learning,
        round(complexity / 5.0::DOUBLE * 100, 6) AS complexity FROM {VALID_SQL}""",
    ),
    "enrich_short": (
        _enrich,
        """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0
          THEN p_name || '. Recherche de livre avec ambiance immersive et intrigue captivante.'
          ELSE p_name || ' ' || p_type || ' ' || p_brand || ' book' END AS query_text FROM part""",
    ),
    "suggested_titles": (
        _suggestions,
        f"""SELECT conv_id, turn, {q.strip('text')} AS summary,
        CASE WHEN turn % 4 = 3 THEN '' ELSE role || '|Book ' || turn END AS titles FROM conversations""",
    ),
}
