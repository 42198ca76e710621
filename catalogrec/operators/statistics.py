"""Counts, summaries and exact quantiles that stay distributed on skewed or huge columns."""

from __future__ import annotations

from functools import reduce
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank, word_count
from ..session import scratch_path
from ..sources.storage import materialize

# Buckets a span is counted in, and values listed at once, when an exact quantile is located.
_BUCKETS = 4096
_LISTED_VALUES = 20_000


def value_counts(df: DataFrame, column: str, n: int | None = None, by_key: bool = False) -> DataFrame:
    """(value, count) without nulls: most frequent first, or in key order; optionally the top n."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(*(["value"] if by_key else [F.desc("count"), F.asc("value")]))
    )
    return counts.limit(n) if n is not None else counts


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_unique), nulls not counted.

    One (column, value) pair stream is made distinct, so each column's values are combined
    map-side instead of expanding the whole row once per column.
    """
    def compact(c: str):
        # Long texts cross the shuffle as their SHA-256 digest, short values as they are.
        text = F.col(c).cast("string")
        return F.when(F.length(text) >= 64, F.concat(F.lit("sha256:"), F.sha2(text, 256))).otherwise(text)

    pairs = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), compact(c).alias("value")) for c in columns])).alias("_p")
    ).select("_p.column", "_p.value")
    counted = pairs.distinct().groupBy("column").agg(F.count("value").alias("n_unique"))
    return counted


def _unpivot(row: DataFrame, columns: list[str], *values: tuple[str, str]) -> DataFrame:
    """Turn one row holding ``{prefix}{column}`` cells into a row per column."""
    entries = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{prefix}{c}").alias(name) for prefix, name in values])
        for c in columns
    ]
    return row.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, n_null, n_blank) in one pass; blank is counted for text columns only."""
    columns = columns or df.columns
    types = dict(df.dtypes)
    row = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns],
        *[
            (F.count_if(F.col(c).isNotNull() & is_blank(c)) if types[c] == "string" else F.lit(0).cast("long")).alias(f"b_{c}")
            for c in columns
        ],
    )
    return _unpivot(row, columns, ("n_", "n_null"), ("b_", "n_blank"))


def column_profile(df: DataFrame) -> DataFrame:
    """(position, column, type, n_present) of every column in one pass."""
    row = df.agg(*[F.count(c).alias(f"n_{c}") for c in df.columns])
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column"),
            F.lit(t).alias("type"),
            F.col(f"n_{c}").alias("n_present"),
        )
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return row.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")


def _series(df: DataFrame, columns: list[Column]) -> DataFrame:
    """(series, v): the present values of several numeric columns in one stream."""
    cells = F.array(*[F.struct(F.lit(i).alias("series"), c.cast("double").alias("v")) for i, c in enumerate(columns)])
    return df.select(F.explode(cells).alias("_c")).select("_c.series", "_c.v").where(
        F.col("v").isNotNull() & ~F.isnan("v")
    )


def _stored_series(df: DataFrame, column: str | Column) -> DataFrame:
    """The series of one column; a computed column is computed once and written as numbers.

    Several passes follow, and none of them should go back to the text it came from.
    """
    if isinstance(column, str):
        return _series(df, [F.col(column)])
    spark = df.sparkSession
    return materialize(spark, scratch_path(spark, "series"), lambda: _series(df, [column]))


def _quantiles(values: DataFrame, bounds: dict[int, tuple], probs: list[float]) -> dict[tuple[int, float], float]:
    """{(series, prob): quantile} given {series: (n, min, max)} of a ``_series`` table."""
    positions = {(i, p): (n - 1) * p for i, (n, _, _) in bounds.items() if n for p in probs}
    at_rank: dict[tuple[int, int], float] = {}
    spans: dict[tuple, set[int]] = {}
    for (i, _), x in positions.items():
        n, lo, hi = bounds[i]
        spans.setdefault((i, lo, hi, 0, n), set()).update((floor(x), ceil(x)))
    while spans:
        for span in [s for s in spans if s[1] == s[2]]:
            for rank in spans.pop(span):
                at_rank[span[0], rank] = span[1]
        if spans:
            spans = _narrow(values, spans, listed=sum(s[4] for s in spans) <= _LISTED_VALUES)
    out = {}
    for (i, p), x in positions.items():
        below, above = at_rank[i, floor(x)], at_rank[i, ceil(x)]
        out[i, p] = below + (above - below) * (x - floor(x))
    return out


def _narrow(values: DataFrame, spans: dict, listed: bool) -> dict:
    """Replace each span (series, lo, hi, rows below, rows) by its buckets that hold its ranks."""
    v = F.col("v")
    order = list(spans)
    piece = bucket = F.when(F.lit(False), F.lit(0))
    for i, (series, lo, hi, _, _) in enumerate(order):
        # Halves keep the range finite; the ends are buckets of their own, so every pass shrinks.
        share = F.try_divide(v * 0.5 - lo * 0.5, F.lit(hi * 0.5 - lo * 0.5))
        place = (
            F.when(v == lo, F.lit(-1))
            .when(v == hi, F.lit(_BUCKETS))
            .otherwise(F.coalesce(F.least(F.floor(share * _BUCKETS), F.lit(_BUCKETS - 1)), F.lit(0)))
        )
        inside = (F.col("series") == series) & v.between(lo, hi)
        piece, bucket = piece.when(inside, i), bucket.when(inside, place)
    counted = (
        values.select("v", piece.alias("piece"), (v if listed else bucket).alias("bucket"))
        .where("piece is not null")
        .groupBy("piece", "bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .collect()
    )
    pieces: dict[int, list] = {}
    for row in counted:
        pieces.setdefault(row["piece"], []).append(row)
    narrowed: dict = {}
    for i, span in enumerate(order):
        below = span[3]
        for row in sorted(pieces.get(i, []), key=lambda r: r["bucket"]):
            ranks = {r for r in spans[span] if below <= r < below + row["n"]}
            if ranks:
                narrowed.setdefault((span[0], row["lo"], row["hi"], below, row["n"]), set()).update(ranks)
            below += row["n"]
    return narrowed


def exact_quantiles(df: DataFrame, column: str | Column, probs: list[float]) -> DataFrame:
    """(prob, quantile) with linear interpolation, exact at any size.

    ``percentile`` keeps every distinct value of a column in one task. Here the wanted ranks are
    narrowed down by counting: each pass counts the values of the current spans in equal-width
    buckets and keeps, per rank, only the bucket that holds it. A pass shuffles bucket counts and
    returns at most ``_BUCKETS + 2`` rows per span; a span shrinks about ``_BUCKETS``-fold, so
    even 10^12 distinct values take four passes over the one column. The last values are listed
    once no more than ``_LISTED_VALUES`` are left.
    """
    values = _stored_series(df, column)
    bounds = values.agg(F.count("v"), F.min("v"), F.max("v")).first()
    found = _quantiles(values, {0: tuple(bounds)}, probs)
    rows = [(float(p), found.get((0, p))) for p in probs]
    return df.sparkSession.createDataFrame(rows, "prob double, quantile double")


def median(df: DataFrame, column: str | Column) -> DataFrame:
    return exact_quantiles(df, column, [0.5]).select(F.col("quantile").alias("median"))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, statistic, value): count, mean, sample deviation, min, quartiles, max.

    One pass for the moments; the quartiles of all columns are narrowed down together.
    """
    def number(c: str) -> Column:
        v = F.col(c).cast("double")
        return F.when(~F.isnan(v), v)

    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(*[F.struct(*[f(number(c)).alias(m) for m, f in measures.items()]).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    moments = {i: row[f"m{i}"] for i in range(len(columns)) if row[f"m{i}"]["count"]}
    values = _series(df, [F.col(c) for c in columns])
    probs = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
    found = _quantiles(values, {i: (r["count"], r["min"], r["max"]) for i, r in moments.items()}, list(probs.values()))
    rows = []
    for i, c in enumerate(columns):
        row = moments.get(i)
        rows.append((c, "count", float(row["count"] if row else 0)))
        rows += [(c, m, row[m] if row else None) for m in ("mean", "std", "min", "max")]
        rows += [(c, name, found.get((i, p))) for name, p in probs.items()]
    return df.sparkSession.createDataFrame(rows, "column string, statistic string, value double")


def histogram(df: DataFrame, column: str | Column, bins: int = 60) -> DataFrame:
    """(bin, lower, upper, count) over equal-width bins; the maximum falls in the last bin.

    Empty bins are listed too.
    """
    values = _stored_series(df, column)
    bounds = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("b")).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    width = (hi - lo) / F.lit(float(bins))
    place = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.floor((F.col("v") - lo) / width).cast("int") + 1, F.lit(bins))
    )
    counts = values.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    grid = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (lo + (F.col("bin") - 1) * width).alias("lower"),
        (lo + F.col("bin") * width).alias("upper"),
        F.coalesce("_n", F.lit(0)).alias("count"),
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def corpus_statistics(
    df: DataFrame,
    top_genres: int = 15,
    top_languages: int = 10,
) -> DataFrame:
    """(metric, key, value) for the nine corpus measures.

    One scan and one grouping-sets aggregation yield every distribution and total; the top lists
    and the distinct count are cut from that small result.
    """
    sets = ["source", "genre_clean", "period", "language"]
    base = df.select(
        *sets,
        is_blank("authors_clean").cast("int").alias("_no_author"),
        F.col("year").isNull().cast("int").alias("_no_year"),
        word_count("desc_clean").alias("_words"),
    )
    cube = base.groupingSets([[F.col(c)] for c in sets] + [[]], *[F.col(c) for c in sets]).agg(
        F.grouping_id().alias("_set"),
        F.count(F.lit(1)).alias("_n"),
        F.sum("_no_author").alias("_no_author"),
        F.sum("_no_year").alias("_no_year"),
        F.avg("_words").alias("_mean_words"),
    )
    n = len(sets)
    # grouping_id has a 1 bit for every column that is rolled up.
    set_id = {c: ((1 << n) - 1) ^ (1 << (n - 1 - i)) for i, c in enumerate(sets)}
    metric = reduce(
        lambda acc, c: acc.when(F.col("_set") == set_id[c], F.lit(c)),
        sets[1:],
        F.when(F.col("_set") == set_id[sets[0]], F.lit(sets[0])),
    ).otherwise(F.lit("total"))
    groups = cube.withColumn("_dim", metric).withColumn(
        "_key", F.coalesce(*[F.col(c) for c in sets])
    )
    known = groups.where((F.col("_dim") == "total") | F.col("_key").isNotNull())
    order = Window.partitionBy("_dim").orderBy(F.desc("_n"), "_key")
    limits = {"genre_clean": top_genres, "language": top_languages}
    names = {
        "source": "sources",
        "genre_clean": "top_genres",
        "period": "period_distribution",
        "language": "language_distribution",
    }
    # Only the two limited lists are ranked, each with its limit as a filter right behind the window,
    # so that every task keeps its own top rows before the shuffle (no dimension in one task whole).
    ranked = reduce(
        DataFrame.unionByName,
        [known.where(~F.col("_dim").isin(*limits)).withColumn("_rank", F.lit(1))]
        + [
            known.where(F.col("_dim") == dim).withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= limit)
            for dim, limit in limits.items()
        ],
    )
    cells = F.when(
        F.col("_dim") == "total",
        F.array(
            _cell("total_books", None, F.col("_n")),
            _cell("missing_authors", None, F.col("_no_author")),
            _cell("missing_year", None, F.col("_no_year")),
            _cell("average_description_length_words", None, F.col("_mean_words")),
        ),
    )
    for dim, name in names.items():
        kept = _cell(name, F.col("_key"), F.col("_n"))
        listed = F.array(kept)
        if dim in limits:
            listed = F.when(F.col("_rank") <= limits[dim], listed).otherwise(F.filter(listed, lambda _: F.lit(False)))
        cells = cells.when(F.col("_dim") == dim, listed)
    # Every genre counts, not only the listed ones.
    genres = known.where(F.col("_dim") == "genre_clean").agg(F.count(F.lit(1)).alias("_g"))
    unique = genres.select(F.explode(F.array(_cell("unique_genres", None, F.col("_g")))).alias("_c")).select("_c.*")
    return (
        ranked.select(F.explode(cells).alias("_c"))
        .select("_c.*")
        .unionByName(unique)
        .groupBy("metric", "key")
        .agg(F.sum("value").alias("value"))
    )


def _cell(metric: str, key: Column | None, value: Column) -> Column:
    return F.struct(
        F.lit(metric).alias("metric"),
        (key.cast("string") if key is not None else F.lit(None).cast("string")).alias("key"),
        value.cast("double").alias("value"),
    )
