"""Parquet materialisation and JSON documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if the path exists on whatever file system it names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


MANIFEST = "_MANIFEST"


def input_manifest(spark: SparkSession, inputs: list[str], params: dict | None = None) -> str:
    """A digest of the input files (path, size, modification time, all files below each input)
    and of the parameters. Only file metadata is listed, as any reader of the files lists it."""
    import hashlib
    import json

    digest = hashlib.sha256(json.dumps(params or {}, sort_keys=True, default=str).encode())
    conf = spark._jsc.hadoopConfiguration()
    for name in inputs:
        root = spark._jvm.org.apache.hadoop.fs.Path(name)
        fs = root.getFileSystem(conf)
        digest.update(f"\0{name}".encode())
        if not fs.exists(root):
            digest.update(b"\0missing")
            continue
        files = fs.listFiles(root, True)
        found = []
        while files.hasNext():
            status = files.next()
            found.append(f"{status.getPath().toString()}|{status.getLen()}|{status.getModificationTime()}")
        for line in sorted(found):
            digest.update(line.encode())
    return digest.hexdigest()


def _read_small(spark: SparkSession, path: str) -> str | None:
    if not path_exists(spark, path):
        return None
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_small(spark: SparkSession, path: str, text: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(jvm_path, True)
    out.write(bytearray(text.encode()))
    out.close()


def materialize(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    force_rebuild: bool = False,
    inputs: list[str] | None = None,
    params: dict | None = None,
) -> DataFrame:
    """The Parquet table at ``path``, built and written first if absent, forced, or built from
    other inputs or parameters than now.

    With ``inputs``, a manifest (``input_manifest``) is written beside the table, and a complete
    table is reused only if its manifest equals the one of the inputs now: another file at the same
    path, a changed file or other parameters rebuild it. The written table also cuts the lineage:
    later jobs restart from files, not from the inputs.
    """
    complete = path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")
    wanted = input_manifest(spark, inputs, params) if inputs is not None else None
    same = wanted is None or (complete and _read_small(spark, f"{path.rstrip('/')}/{MANIFEST}") == wanted)
    if force_rebuild or not complete or not same:
        build().write.mode("overwrite").parquet(path)
        if wanted is not None:
            _write_small(spark, f"{path.rstrip('/')}/{MANIFEST}", wanted)
    return spark.read.parquet(path)


def write_json(df: DataFrame, path: str, append: bool = False, compression: str | None = None) -> None:
    """JSON documents; replaces the target, or adds to a history. ``compression`` as Spark's JSON writer takes it."""
    df.write.mode("append" if append else "overwrite").json(path, compression=compression)


def write_batch(df: DataFrame, path: str, batch_id: int) -> str:
    """Append one batch to a history; writing the same batch again replaces it. Returns its folder."""
    folder = f"{path.rstrip('/')}/batch_id={batch_id}"
    df.write.mode("overwrite").json(folder)
    return folder


# The first non-blank line of a file that holds one document over several lines, or a list.
_OPENING = r"\A\s*(\[|\{\s*\z)"
_WHOLE = "_file string, text string, broken boolean, position long"


def _parse_whole(lines):
    """The documents of one file that holds a list or one document, and what cannot be read.

    The first value of the file is parsed; a list gives one row per element (an element that is no
    object is a broken row), an object one row. Whatever stands behind the first value is one
    broken row, with its place (in signs from the start of the file); so is a first value that
    cannot be read, with place 0.
    """
    import json

    import pandas as pd

    lines = lines.sort_values(["_block", "_at"])
    text = "\n".join(lines["value"].tolist())
    name = lines["_file"].iloc[0]
    rows = []
    start = len(text) - len(text.lstrip())
    try:
        value, end = json.JSONDecoder().raw_decode(text, start)
    except ValueError:
        return pd.DataFrame([(name, text, True, 0)], columns=["_file", "text", "broken", "position"])
    for item in value if isinstance(value, list) else [value]:
        if isinstance(item, dict):
            rows.append((name, json.dumps(item), False, None))
        elif item is not None:
            rows.append((name, json.dumps(item), True, start))
    rest = text[end:]
    if rest.strip():
        rows.append((name, rest, True, end))
    return pd.DataFrame(rows, columns=["_file", "text", "broken", "position"])


def read_json_history(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """(good rows, broken rows) of a JSON history; a missing history has no rows.

    A file holds one document per line, or one list of documents, or one document, either over
    several lines. Its kind is told by its first non-blank line alone: ``[`` or a lone ``{`` opens
    a whole file, anything else makes a line file, whatever its later lines hold. Every non-blank
    line of a line file is a good or a broken row; a whole file is read by one task (it is one
    value) and what does not belong to its first value is broken. Broken rows carry their text
    (``_corrupt_record``), their file and, for whole files, the place of the text in the file. No
    file name passes through the driver.
    """
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    full = StructType([*wanted.fields, StructField(CORRUPT, StringType())])
    if not path_exists(spark, path):
        empty = spark.createDataFrame([], full)
        return empty.drop(CORRUPT), empty.select(CORRUPT, F.lit(None).cast("string").alias("file"), F.lit(None).cast("long").alias("position"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    present = lines.where(F.trim("value") != "")
    first = present.groupBy("_file").agg(F.min_by("value", F.struct("_block", "_at")).alias("_first"))
    kinds = first.select("_file", F.col("_first").rlike(_OPENING).alias("_whole"))
    # One row per file: shipped, so that no line of the history is shuffled.
    marked = present.join(F.broadcast(kinds), "_file")
    by_line = marked.where(~F.col("_whole")).select(
        F.from_json("value", full, options).alias("r"), "_file", F.lit(None).cast("long").alias("position")
    ).select("r.*", "_file", "position")
    whole = marked.where("_whole").select("value", "_file", "_block", "_at").groupBy("_file").applyInPandas(_parse_whole, _WHOLE)
    read = whole.where(~F.col("broken")).select(F.from_json("text", full, options).alias("r"), "_file", "position").select("r.*", "_file", "position")
    broken = whole.where("broken").select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in wanted], F.col("text").alias(CORRUPT), "_file", "position"
    )
    rows = by_line.unionByName(read).unionByName(broken)
    good = rows.where(F.col(CORRUPT).isNull()).select(*wanted.fieldNames())
    bad = rows.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, F.col("_file").alias("file"), "position")
    return good, bad


def read_metrics(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame | None:
    """A metrics document, or None when there is no file."""
    if not path_exists(spark, path):
        return None
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)
