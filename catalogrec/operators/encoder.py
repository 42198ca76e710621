"""Text to vector: a fitted lexical encoder, and a slot for any other one."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 384
# Rows whose vectors a task holds at once.
SLICE_ROWS = 1024


TERM = r"[\p{L}\p{N}_]{2,}"


def term_indices(text: Column, width: int = WIDTH) -> Column:
    """The place of every term of a text in a vector of ``width``: the first 32 bits of the md5 of
    the lower-cased term, modulo the width. A stated hash, so SQL computes the same places."""
    terms = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TERM), 0)
    return F.transform(terms, lambda t: F.pmod(F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("long"), F.lit(width)).cast("int"))


class HashedEncoder:
    """Term counts at hashed places, weighted by ln((N+1)/(df+1)) of the corpus, unit length.

    ``df`` counts the corpus documents with a term at each place, so the fitted state is ``width``
    numbers whatever the corpus size.
    """

    def __init__(self, idf: list[float], width: int) -> None:
        self.idf, self.width = idf, width


def fit_encoder(corpus: DataFrame, text_col: str = "text_full", width: int = WIDTH) -> HashedEncoder:
    """Count, over the whole corpus, the documents with a term at each place; one pass."""
    places = corpus.select(F.explode(F.array_distinct(term_indices(F.col(text_col), width))).alias("i"))
    df = {r["i"]: r["n"] for r in places.groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}  # width rows at most
    n = corpus.count()
    return HashedEncoder([log((n + 1.0) / (df.get(i, 0) + 1.0)) for i in range(width)], width)


def _slices(rows):
    """A batch or frame in parts of at most ``SLICE_ROWS`` rows; one part if it is empty."""
    cut = (lambda at: rows.slice(at, SLICE_ROWS)) if hasattr(rows, "slice") else (lambda at: rows.iloc[at : at + SLICE_ROWS])
    return map(cut, range(0, max(1, len(rows)), SLICE_ROWS))


def encode_text(model: HashedEncoder, df: DataFrame, text_col: str) -> DataFrame:
    """Add ``embedding ARRAY<FLOAT>`` using a fitted encoder, for corpus and queries alike.

    Terms are found and hashed in Column expressions; only the places pass to Arrow, where each
    batch is counted with one ``bincount``. A text without terms gives the zero vector.
    """
    import numpy as np
    import pyarrow as pa

    idf, width = np.asarray(model.idf), model.width
    placed = df.withColumn("_places", term_indices(F.col(text_col), width))
    schema = f"{placed.schema.simpleString()[7:-1]},embedding:array<float>"

    def encoded(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column("_places")
        rows = len(column)
        counts = np.zeros((rows, width))
        if rows:
            owners = np.repeat(np.arange(rows), np.diff(np.asarray(column.offsets)))
            flat = np.asarray(column.flatten(), dtype=np.int64)
            np.add.at(counts, (owners, flat), 1.0)
        weights = counts * idf
        size = np.sqrt((weights * weights).sum(axis=1))
        unit = np.divide(weights, size[:, None], out=np.zeros_like(weights), where=size[:, None] > 0).astype(np.float32)
        vectors = pa.FixedSizeListArray.from_arrays(pa.array(unit.ravel(), pa.float32()), width).cast(pa.list_(pa.float32()))
        return pa.RecordBatch.from_arrays([*batch.columns, vectors], names=[*batch.schema.names, "embedding"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from map(encoded, _slices(batch))

    return placed.mapInArrow(run, schema).drop("_places")


def encode_with(
    df: DataFrame, text_col: str, load: Callable[[], Callable[[list[str]], list]], batch_size: int = 32
) -> DataFrame:
    """Add ``embedding`` with a caller-supplied encoder.

    ``load()`` runs once per Python task and returns ``encode(list of texts) -> list of vectors``;
    texts reach it in batches of ``batch_size``.
    """
    schema = f"{df.schema.simpleString()[7:-1]},embedding:array<float>"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load()
        for frame in frames:
            for part in _slices(frame):
                texts = part[text_col].fillna("").tolist()
                vectors = []
                for start in range(0, len(texts), batch_size):
                    vectors.extend(encode(texts[start : start + batch_size]))
                yield part.assign(embedding=[[float(x) for x in v] for v in vectors])

    return df.mapInPandas(run, schema)
