"""Counts, summaries, distributions and sampling over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import word_count
from ..operators import sampling, statistics
from ..operators.dedup import drop_exact_duplicates, exact_duplicate_count
from ..plans.profile import profile
from . import sql as q
from .tables import table, texts


def _value_counts(spark, d):
    return statistics.value_counts(table(spark, d, "documents"), "source")


def _top_values(spark, d):
    return statistics.value_counts(table(spark, d, "part"), "p_name", n=10)


def _by_key(spark, d):
    return statistics.value_counts(table(spark, d, "lineitem"), "l_quantity", by_key=True)


def _nunique(spark, d):
    part = table(spark, d, "part").withColumn("p_type", F.when(F.col("p_type") != "SMALL", F.col("p_type")))
    return statistics.distinct_counts(part, ["p_name", "p_brand", "p_type", "p_size"])


def _null_counts(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id",
        F.when(F.col("lang") != "de", F.col("lang")).alias("lang"),
        F.when(F.col("n_chars") % 4 == 0, F.lit(" \n")).otherwise(F.col("text")).alias("text"),
    )
    return statistics.null_counts(docs)


_LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]


def _describe(spark, d):
    out = statistics.describe(table(spark, d, "lineitem"), _LINE_COLUMNS)
    return out.withColumn("value", F.round("value", 4))


def _describe_sql() -> str:
    parts = []
    for c in _LINE_COLUMNS:
        measures = {
            "count": f"CAST(count({c}) AS DOUBLE)",
            "mean": f"avg({c})",
            "std": f"stddev_samp({c})",
            "min": f"min({c})",
            "25%": f"quantile_cont({c}, 0.25)",
            "50%": f"quantile_cont({c}, 0.5)",
            "75%": f"quantile_cont({c}, 0.75)",
            "max": f"max({c})",
        }
        parts += [
            f"SELECT '{c}' AS \"column\", '{m}' AS statistic, round(CAST({e} AS DOUBLE), 4) AS value FROM lineitem"
            for m, e in measures.items()
        ]
    return " UNION ALL ".join(parts)


def _median(spark, d):
    return statistics.median(texts(spark, d, "documents", "doc_id", "text"), word_count("text"))


def _histogram(spark, d):
    out = statistics.histogram(texts(spark, d, "documents", "doc_id", "text"), word_count("text"), bins=60)
    return out.select("bin", F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"), "count")


def _row_count(spark, d):
    return statistics.row_count(table(spark, d, "lineitem"))


def _column_profile(spark, d):
    events = table(spark, d, "events")
    out = statistics.column_profile(events.withColumn("value", F.when(F.col("value") > 10, F.col("value"))))
    return out.select("position", "column", "n_present")


def _exact_dups(spark, d):
    return exact_duplicate_count(table(spark, d, "documents"), ["text", "lang"])


def _drop_dups(spark, d):
    return drop_exact_duplicates(table(spark, d, "documents"), ["text", "lang"], "doc_id")


def _profile(spark, d):
    """All scalar measures of the profile of ``orders`` as (table, key, value)."""
    tables = profile(table(spark, d, "orders"), ["o_orderpriority"])
    shaped = [
        tables["row_count"].select(F.lit("row_count").alias("part"), F.lit("").alias("key"), F.col("n_rows").cast("double").alias("value")),
        tables["columns"].select(F.lit("columns").alias("part"), F.col("column").alias("key"), F.col("n_present").cast("double").alias("value")),
        tables["nulls"].select(F.lit("nulls").alias("part"), F.col("column").alias("key"), F.col("n_null").cast("double").alias("value")),
        tables["unique"].select(F.lit("unique").alias("part"), F.col("column").alias("key"), F.col("n_unique").cast("double").alias("value")),
        tables["duplicates"].select(F.lit("duplicates").alias("part"), F.lit("").alias("key"), F.col("duplicated_rows").cast("double").alias("value")),
        tables["summary"].select(F.lit("summary").alias("part"), F.concat_ws(" ", "column", "statistic").alias("key"), F.round("value", 3).alias("value")),
        tables["top_o_orderpriority"].select(F.lit("top").alias("part"), F.col("value").alias("key"), F.col("count").cast("double").alias("value")),
    ]
    return reduce(DataFrame.unionByName, shaped)


def _profile_sql() -> str:
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    numeric = ["o_orderkey", "o_custkey", "o_totalprice"]
    rows = [("row_count", "", "count(*)")]
    rows += [("columns", c, f"count({c})") for c in columns]
    rows += [("nulls", c, f"count(*) - count({c})") for c in columns]
    rows += [("unique", c, f"count(DISTINCT {c})") for c in columns]
    rows += [("duplicates", "", f"count(*) - count(DISTINCT ({', '.join(columns)}))")]
    for c in numeric:
        for m, e in {
            "count": f"count({c})",
            "mean": f"avg({c})",
            "std": f"stddev_samp({c})",
            "min": f"min({c})",
            "max": f"max({c})",
            "25%": f"quantile_cont({c}, 0.25)",
            "50%": f"quantile_cont({c}, 0.5)",
            "75%": f"quantile_cont({c}, 0.75)",
        }.items():
            rows.append(("summary", f"{c} {m}", f"round(CAST({e} AS DOUBLE), 3)"))
    selects = [f"SELECT '{p}' AS part, '{k}' AS key, CAST({e} AS DOUBLE) AS value FROM orders" for p, k, e in rows]
    selects.append("SELECT 'top', o_orderpriority, CAST(count(*) AS DOUBLE) FROM orders GROUP BY o_orderpriority")
    return " UNION ALL ".join(selects)


def _cap(spark, d):
    return sampling.stratified_cap(
        table(spark, d, "events").select("event_id", "event_type"), "event_type", "event_id", cap=400
    )


def _split(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return sampling.stratified_split(orders, "o_orderpriority", "o_orderkey")


def _min_support(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.concat_ws("-", "lang", "source").alias("label"))
    return sampling.min_support(docs, "label", 20)


def _sample(spark, d):
    return sampling.seeded_sample(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 8)


def _first_rows(spark, d):
    return sampling.first_rows(table(spark, d, "customer"), "c_custkey", 10)


QUERIES = {
    "value_counts": (
        _value_counts,
        "SELECT source AS value, count(*) AS count FROM documents WHERE source IS NOT NULL GROUP BY source",
    ),
    "top_values": (
        _top_values,
        "SELECT p_name AS value, count(*) AS count FROM part GROUP BY p_name ORDER BY count DESC, value LIMIT 10",
    ),
    "counts_by_key": (
        _by_key,
        "SELECT l_quantity AS value, count(*) AS count FROM lineitem GROUP BY l_quantity ORDER BY value",
    ),
    "nunique": (
        _nunique,
        """SELECT 'p_name' AS "column", count(DISTINCT p_name) AS n_unique FROM part
        UNION ALL SELECT 'p_brand', count(DISTINCT p_brand) FROM part
        UNION ALL SELECT 'p_type', count(DISTINCT CASE WHEN p_type <> 'SMALL' THEN p_type END) FROM part
        UNION ALL SELECT 'p_size', count(DISTINCT p_size) FROM part""",
    ),
    "null_counts": (
        _null_counts,
        """SELECT 'doc_id' AS "column", count(*) - count(doc_id) AS n_null, CAST(0 AS BIGINT) AS n_blank FROM documents
        UNION ALL SELECT 'lang', count(*) FILTER (WHERE lang = 'de'), CAST(0 AS BIGINT) FROM documents
        UNION ALL SELECT 'text', CAST(0 AS BIGINT), count(*) FILTER (WHERE n_chars % 4 = 0) FROM documents""",
    ),
    "describe": (_describe, _describe_sql()),
    "median": (
        _median,
        f"SELECT CAST(quantile_cont({q.word_count('text')}, 0.5) AS DOUBLE) AS median FROM documents",
    ),
    "histogram": (
        _histogram,
        f"""WITH w AS (SELECT CAST({q.word_count('text')} AS DOUBLE) AS v FROM documents),
        b AS (SELECT min(v) AS lo, (max(v) - min(v)) / 60.0::DOUBLE AS step FROM w),
        c AS (SELECT least(CAST(floor((v - lo) / step) AS INTEGER) + 1, 60) AS bin, count(*) AS n FROM w, b GROUP BY 1)
        SELECT CAST(g.bin AS INTEGER) AS bin, round(lo + (g.bin - 1) * step, 4) AS lower,
        round(lo + g.bin * step, 4) AS upper, coalesce(n, 0) AS count
        FROM (SELECT unnest(range(1, 61)) AS bin) g CROSS JOIN b LEFT JOIN c ON g.bin = c.bin""",
    ),
    "row_count": (_row_count, "SELECT count(*) AS n_rows FROM lineitem"),
    "column_profile": (
        _column_profile,
        " UNION ALL ".join(
            f"SELECT {i} AS position, '{c}' AS \"column\", count({e}) AS n_present FROM events"
            for i, (c, e) in enumerate(
                [
                    ("event_id", "event_id"),
                    ("ts", "ts"),
                    ("user_id", "user_id"),
                    ("event_type", "event_type"),
                    ("value", "CASE WHEN value > 10 THEN value END"),
                    ("props", "props"),
                ]
            )
        ),
    ),
    "exact_dups": (
        _exact_dups,
        "SELECT count(*) - count(DISTINCT (text, lang)) AS duplicated_rows FROM documents",
    ),
    "drop_dups": (_drop_dups, "SELECT text, lang, min(doc_id) AS doc_id FROM documents GROUP BY text, lang"),
    "table_profile": (_profile, _profile_sql()),
    "stratified_cap": (
        _cap,
        """SELECT event_id, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY md5('42:' || event_id), event_id) <= 400""",
    ),
    "stratified_split": (
        _split,
        """SELECT o_orderkey, o_orderpriority,
          row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('42:' || o_orderkey), o_orderkey)
          <= floor(count(*) OVER (PARTITION BY o_orderpriority) * 0.25 + 0.5) AS is_test FROM orders""",
    ),
    "min_support": (
        _min_support,
        """SELECT doc_id, lang || '-' || source AS label FROM documents
        QUALIFY count(*) OVER (PARTITION BY lang, source) >= 20""",
    ),
    "seeded_sample": (
        _sample,
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 8",
    ),
    "first_rows": (_first_rows, "SELECT * FROM customer ORDER BY c_custkey LIMIT 10"),
}
