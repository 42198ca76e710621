"""The three catalogue CSV files, read into one schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import extract_number, extract_year, list_text, to_number

# CSV cells that mean "missing".
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Names the merged table gives to its sources, in merge order.
SOURCE_1 = "book_dataset_1"
SOURCE_2 = "books_dataset_clean"
SOURCE_3 = "best_books_ever"

CATALOG_SCHEMA = {
    "title": "string",
    "authors": "string",
    "description": "string",
    "year": "double",
    "series": "string",
    "language": "string",
    "pages": "double",
    "rating": "double",
    "genres_raw": "string",
    "source": "string",
}

# A book id is the source's rank above this bit and the row's place in the file below it.
_SOURCE_SHIFT = 59


def missing_to_null(df: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """Null for every text cell that spells a missing value."""
    listed = NA_TOKENS if tokens is None else tokens
    return df.select(
        *[
            (F.when(~F.col(f"`{c}`").isin(listed), F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`"))
            for c, t in df.dtypes
        ]
    )


# Types tried for a text column, the first that all its cells fit.
_INFERRED = ("int", "bigint", "double", "boolean", "date", "timestamp")


def infer_types(df: DataFrame) -> DataFrame:
    """Cast every text column to the first of some types that all its present cells fit.

    Missing cells are null by now and fit any type; a column without a present cell stays STRING.
    Dates must be written as such, without a time. One aggregation looks at all columns.
    """
    named = [c for c, t in df.dtypes if t == "string"]
    if not named:
        return df
    fits = []
    for i, c in enumerate(named):
        cell = F.trim(F.col(f"`{c}`"))
        fits.append(F.count(cell).alias(f"n{i}"))
        for t in _INFERRED:
            fit = cell.try_cast(t).isNotNull()
            if t == "double":  # a bare 1f or 1d is no number in a file
                fit = fit & ~cell.rlike("[dDfF]$")
            if t == "boolean":
                fit = F.lower(cell).isin("true", "false")
            if t == "date":
                fit = fit & cell.rlike(r"\A\d{4}-\d{1,2}-\d{1,2}\z")
            if t == "timestamp":
                fit = fit & cell.rlike(r"\A\d{4}-\d{1,2}-\d{1,2}[T ]")
            fits.append(F.count(F.when(fit, 1)).alias(f"{t}{i}"))
    found = df.agg(*fits).first()
    types = {
        c: next((t for t in _INFERRED if found[f"n{i}"] and found[f"{t}{i}"] == found[f"n{i}"]), "string")
        for i, c in enumerate(named)
    }
    return df.select(
        *[
            F.trim(F.col(f"`{c}`")).cast(types[c]).alias(c) if types.get(c, "string") != "string" else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def _csv_reader(spark: SparkSession, encoding: str, multi_line: bool) -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", encoding)
    )


def read_csv(
    spark: SparkSession, path: str, encoding: str = "UTF-8", infer: bool = False, multi_line: bool = True
) -> DataFrame:
    """A CSV file with header and doubled quotes; all columns STRING unless ``infer``.

    With ``infer`` a column's type is decided after missing tokens have become null. Text may hold
    line breaks inside quotes (``multi_line``), which makes a file unsplittable: store large catalogues
    as several files, or as Parquet after the first read.
    """
    df = missing_to_null(_csv_reader(spark, encoding, multi_line).csv(path))
    return infer_types(df) if infer else df


ROW_ID = "_row_id"


def read_numbered_csv(spark: SparkSession, path: str, encoding: str = "UTF-8", multi_line: bool = True) -> DataFrame:
    """``read_csv`` with the place of each row in ``ROW_ID``: files in order of path, rows as in the file.

    Spark deals files over partitions by size, so the number a row has in its partition is only an
    order inside its piece of a file. Pieces are counted in a first pass (one row per piece), and
    what lies before a piece is added to the place in it. The ids do not depend on how files are dealt.
    """
    # Both passes read the same columns, so that both see the same pieces.
    read = _csv_reader(spark, encoding, multi_line).csv(path).withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_at": F.monotonically_increasing_id(),
        }
    )
    pieces = read.groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("_file", "_block", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    placed = read.join(pieces, ["_file", "_block"])
    numbered = placed.withColumn(ROW_ID, F.col("_before") + F.col("_at") - F.col("_first"))
    return missing_to_null(numbered.drop("_file", "_block", "_at", "_first", "_before"))


def _running(column: str, out: str, seed: str | None = None, modulus: int | None = None):
    """A running sum of ``column`` over the lines before each line of its piece of a file.

    Lines of one piece arrive together and in file order (the text reader, a map and a broadcast
    join keep the order of a partition), so a sum per run of equal pieces suffices; the running
    value is carried from batch to batch. ``seed`` names a column added to every line of a piece.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        last, carried = None, 0
        for batch in batches:
            files = batch.column("_file").to_pylist()
            blocks = np.asarray(batch.column("_block"), dtype=np.int64)
            values = np.asarray(batch.column(column), dtype=np.int64)
            keys = list(zip(files, blocks.tolist()))
            fresh = np.array([k != p for k, p in zip(keys, [last, *keys[:-1]])], dtype=bool)
            total = np.cumsum(values)
            starts = np.flatnonzero(fresh)
            run_of = np.cumsum(fresh) - 1
            if len(values) and not fresh[0]:
                starts = np.r_[0, starts]
                run_of = run_of + 1
            lead = np.zeros(len(starts), dtype=np.int64)
            if len(values) and not fresh[0]:
                lead[0] = carried
            before = total - values - (total[starts] - values[starts] - lead)[run_of]
            if len(values):
                last, carried = keys[-1], int(before[-1] + values[-1])
            result = before + (np.asarray(batch.column(seed), dtype=np.int64) if seed else 0)
            if modulus:
                result = result % modulus
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in batch.schema.names] + [pa.array(result, pa.int64())],
                names=[*batch.schema.names, out],
            )

    return run


def _csv_lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """Lines of the files with their piece, place and quote count; split as text files are."""
    raw = spark.read.text(path)
    utf8 = encoding.upper().replace("-", "") == "UTF8"
    line = F.col("value") if utf8 else F.decode(F.col("value").cast("binary"), encoding)
    lines = raw.select(
        line.alias("_line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    lines = lines.withColumn("_q", F.length("_line") - F.length(F.regexp_replace("_line", '"', "")))
    schema = "_line string, _file string, _block long, _at long, _q int, _before long"
    return lines.mapInArrow(_running("_q", "_before", modulus=2), schema)


def read_split_csv(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """``read_numbered_csv`` for files with line breaks inside quotes, read by as many tasks as pieces.

    Text splitting cuts files at line breaks, some of which lie inside quotes. Each line knows the
    parity of quotes before it in its piece; a small table of pieces (one row each) adds up the
    parities of earlier pieces, so each piece knows whether it starts inside quotes, and the
    records begun before it. A record starts on a line with an even count of quotes before it. Lines
    that hold a whole record are parsed in place; only the lines of records over several lines are
    gathered by record number, in order, and joined by a line break. Rows are numbered in file
    order (files by path), the header record of each file left out; empty records are skipped.
    """
    lines = _csv_lines(spark, path, encoding)
    pieces = lines.groupBy("_file", "_block").agg(
        (F.sum("_q") % 2).alias("_odd"),
        F.count(F.lit(1)).alias("_lines"),
        F.count(F.when(F.col("_before") == 0, 1)).alias("_starts0"),
        F.count(F.when(F.col("_before") == 1, 1)).alias("_starts1"),
    )
    in_file = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_inside", F.coalesce(F.sum("_odd").over(in_file), F.lit(0)) % 2)
    pieces = pieces.withColumn("_starts", F.when(F.col("_inside") == 0, F.col("_starts0")).otherwise(F.col("_starts1")))
    # One row per piece of a file: the window over all pieces orders files by path.
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_records_before", F.coalesce(F.sum("_starts").over(earlier), F.lit(0)))
    pieces = pieces.withColumn("_file_rank", F.dense_rank().over(Window.orderBy("_file")) - 1)
    pieces = pieces.withColumn("_header", F.min("_records_before").over(Window.partitionBy("_file")))
    pieces = pieces.select("_file", "_block", "_inside", "_records_before", "_file_rank", "_header")
    placed = lines.join(F.broadcast(pieces), ["_file", "_block"])
    placed = placed.withColumn("_start", ((F.col("_inside") + F.col("_before")) % 2 == 0).cast("long"))
    # The record of a line: records begun before its piece, plus those begun in it up to here.
    placed = placed.mapInArrow(
        _running("_start", "_begun", seed="_records_before"), f"{', '.join(f'{n} {t}' for n, t in placed.dtypes)}, _begun long"
    )
    placed = placed.withColumn("_record", F.col("_begun") + F.col("_start") - 1).withColumn("_start", F.col("_start") == 1)
    ends = (F.col("_inside") + F.col("_before") + F.col("_q")) % 2 == 0
    whole = placed.where(F.col("_start") & ends).select("_record", "_file_rank", "_header", F.col("_line").alias("_text"))
    parts = placed.where(~(F.col("_start") & ends))
    joined = parts.groupBy("_record").agg(
        F.array_sort(F.collect_list(F.struct("_at", "_line"))).alias("_parts"),
        F.first("_file_rank").alias("_file_rank"),
        F.first("_header").alias("_header"),
    )
    joined = joined.select("_record", "_file_rank", "_header", F.concat_ws("\n", F.col("_parts._line")).alias("_text"))
    records = whole.unionByName(joined)
    header = records.where(F.col("_record") == F.col("_header")).orderBy("_file_rank").select("_text").first()
    if header is None:
        return spark.createDataFrame([], f"{ROW_ID} long")
    import csv

    names = next(csv.reader([header["_text"]], quotechar='"', doublequote=True))
    ddl = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    rows = records.where((F.col("_record") != F.col("_header")) & (F.col("_text") != ""))
    parsed = rows.select(
        F.from_csv("_text", ddl, {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}).alias("_r"),
        (F.col("_record") - F.col("_file_rank") - 1).alias(ROW_ID),
    )
    return missing_to_null(parsed.select("_r.*", ROW_ID))


def conform(df: DataFrame, columns: dict[str, Column], source: str, rank: int, row_id: Column | None = None) -> DataFrame:
    """Project to the common schema; columns not given are null. Adds ``book_id``."""
    place = row_id if row_id is not None else F.monotonically_increasing_id()
    book_id = (F.lit(rank).cast("long") * F.lit(1 << _SOURCE_SHIFT) + place.cast("long")).alias("book_id")
    values = {**columns, "source": F.lit(source)}
    return df.select(
        book_id,
        *[values.get(name, F.lit(None)).cast(dtype).alias(name) for name, dtype in CATALOG_SCHEMA.items()],
    )


def from_source_1(df: DataFrame, row_id: Column | None = None) -> DataFrame:
    columns = {
        "title": F.col("Title"),
        "description": F.col("Book_Description"),
        "rating": to_number("Stars"),
        "genres_raw": F.col("Category"),
    }
    return conform(df, columns, SOURCE_1, 0, row_id)


def from_source_2(df: DataFrame, row_id: Column | None = None) -> DataFrame:
    columns = {
        "title": F.col("Title"),
        "authors": F.col("Authors"),
        "description": F.col("Description"),
        "year": to_number("`Publish Date (Year)`"),
        "genres_raw": F.col("Category"),
    }
    return conform(df, columns, SOURCE_2, 1, row_id)


def from_source_3(df: DataFrame, row_id: Column | None = None) -> DataFrame:
    columns = {
        "title": F.col("title"),
        "authors": F.col("author"),
        "description": F.col("description"),
        "year": F.coalesce(extract_year("firstPublishDate"), extract_year("publishDate")),
        "series": F.col("series"),
        "language": F.col("language"),
        "pages": extract_number("pages"),
        "rating": to_number("rating"),
        "genres_raw": list_text("genres"),
    }
    return conform(df, columns, SOURCE_3, 2, row_id)


def load_source_1(spark: SparkSession, path: str) -> DataFrame:
    return from_source_1(read_split_csv(spark, path, "ISO-8859-1"), F.col(ROW_ID))


def load_source_2(spark: SparkSession, path: str) -> DataFrame:
    return from_source_2(read_split_csv(spark, path), F.col(ROW_ID))


def load_source_3(spark: SparkSession, path: str) -> DataFrame:
    return from_source_3(read_split_csv(spark, path), F.col(ROW_ID))


def merge_sources(frames: list[DataFrame]) -> DataFrame:
    """Bag union of conformed sources."""
    return reduce(DataFrame.unionByName, frames)


def source_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy("source").agg(F.count(F.lit(1)).alias("count"))
