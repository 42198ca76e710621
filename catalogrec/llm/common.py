"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_mod(key: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(modulus))


def held_out(key: str, modulus: int, remainder: int) -> Column:
    """True for the rows no label is learned from; a null id is not held out."""
    return F.coalesce(crc_mod(key, modulus) == remainder, F.lit(False))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared scratch folder and read them back, which cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.scratch = path
    return written


def discard(*tables: DataFrame) -> None:
    """Remove tables written by ``cut`` that nothing reads any more, and shuffle files behind them.

    Spark removes the files of a shuffle when the driver's garbage collector finds it unused.
    """
    gc.collect()
    for df in tables:
        jvm = df.sparkSession._jvm
        jvm.System.gc()
        path = jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


# Bits of a sieve; its rows are 64 of them each, so at most 131,072 rows are broadcast, whatever the keys.
SIEVE_BITS = 1 << 23


def _slot(columns: tuple[str, ...]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SIEVE_BITS))


def sieve(keys: DataFrame, *columns: str) -> DataFrame:
    """Rows (word, bits) of a bit table in which the slots of all keys are set, written. Its size is bounded."""
    slots = keys.select(_slot(columns).alias("slot"))
    bits = F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")
    return cut(slots.groupBy(F.expr("slot div 64").alias("word")).agg(bits), "sieve")


def may_hold(df: DataFrame, words: DataFrame, *columns: str) -> DataFrame:
    """``df`` with ``may_hold``: false for rows that are surely not among the keys of a ``sieve``.

    A key among them is never false; others are true by chance, the more the more keys there are. Rows are not
    shuffled. The columns must have the types of the keys.
    """
    rows = df.withColumn("_slot", _slot(columns)).withColumn("_word", F.expr("_slot div 64"))
    told = rows.join(F.broadcast(words), F.col("_word") == F.col("word"), "left")
    bit = F.expr("shiftleft(1L, cast(_slot % 64 as int)) & bits") != 0
    return told.withColumn("may_hold", F.coalesce(bit, F.lit(False))).drop("_slot", "_word", "word", "bits")


def arrow_rows(
    df: DataFrame, compute: Callable[[pa.RecordBatch], dict], columns: str, keep: list[str]
) -> DataFrame:
    """Add computed columns to every row, one Arrow batch at a time.

    ``compute`` gets a batch and returns the new columns; ``columns`` is their schema and ``keep``
    names the input columns that are passed on. Rows keep their place, so no join is needed.
    """
    kept = df.select(*keep).schema if keep else StructType()
    schema = StructType([*kept.fields, *StructType.fromDDL(columns).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in batches:
            made = compute(batch)
            arrays = []
            for field in target:
                values = made[field.name] if field.name in made else batch.column(field.name)
                if not isinstance(values, (pa.Array, pa.ChunkedArray)):
                    values = pa.array(values, field.type, from_pandas=False)
                arrays.append(values if values.type == field.type else values.cast(field.type))
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, schema)


def texts(column: pa.Array) -> list[str]:
    """The texts of a batch; null becomes the empty text."""
    return [t if t is not None else "" for t in column.to_pylist()]


def vectors(column: pa.Array, width: int) -> np.ndarray:
    """A list column of equal lengths as a matrix of doubles."""
    if not len(column):
        return np.zeros((0, width))
    return np.asarray(column.flatten()).astype(np.float64).reshape(len(column), width)


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (the finaliser of the splitmix generator)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
