"""Ranked lexical search: integer term impacts in a compressed quadtree of maxima, searched best-first.

Terms are the maximal runs of letters, digits and non-ASCII signs, A-Z lower-cased. Tasks take each
text apart once and pass on its length n and its tf per term asked for; over all documents Spark
counts N (documents with a term), L (their terms) and df per term. A term's weight is
``floor(1000 ln((2N+2)/(2df+1)))`` and its impact in a
document ``w * ((10**9 tf) div (1000 tf + 8 m))`` with ``m = 10 + (90 n N) div L``; a document's
score for an item is the sum of the impacts of the item's distinct terms.

The impacts form a grid: rows are the terms any item asks for, columns the documents of a shard
(documents are dealt to shards by a hash of their row). Each shard holds a quadtree over its grid
(a k^2 tree with k = 2): a cell at level l covers a square block of rows and columns and stores
the largest impact inside it. Only cells with at least two impacts are stored, level by level as
sorted keys; a cell with one impact is that impact, looked up among the points. An item descends
the tree jointly along the row paths of its terms, over column ranges, best-first: a range's bound
is the sum over the item's terms of the maximum of the cell that holds the term's row and the
range. A range of one column is exact. The best ranges leave the queue some at a time, so that
their halves are bounded in one batch; ranges below the k-th best column found so far are dropped,
and the search ends with the queue. It has then met every column of the shard's top k (ties by
document order). The shards' lists are merged by a window per item.

Rows keep their identity: repeated rows are separate documents, ordered among equal scores and
ids by their row number. A null text has no terms; a null doc_id sorts after all ids.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Impacts a shard holds at most, and items searched by one task at most.
SHARD_POSTINGS = 400_000
ITEMS_PER_TASK = 5_000
# Query vocabularies up to this many terms are broadcast to the term occurrences.
BROADCAST_TERMS = 2_000_000
# Up to this many, the tasks that count a text's terms look them up and pass on only those asked for.
LOOKUP_TERMS = 200_000
# Bytes of text whose terms are counted at a time; a longer text is counted alone.
SLICE_BYTES = 8 << 20
# Ranges taken from the queue at a time, and cells looked up at a time.
WAVE, LOOKUPS = 256, 1 << 20
BEYOND = np.iinfo(np.int64).max
# What TERM and the lower-casing do to each byte of UTF-8; 0 ends a term.
FOLDED = np.frombuffer(bytes(b if b > 0x7F or chr(b).isalnum() else 0 for b in range(256)).lower(), dtype=np.uint8)


def terms(text: F.Column) -> F.Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), 0)


def split_terms(data: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The terms of texts that lie one behind the other in UTF-8 (text i from bounds[i] to bounds[i + 1]), and each text's number of terms."""
    folded = FOLDED[data]
    inside = folded != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    begins[edges] = inside[edges]
    starts = np.append(np.flatnonzero(begins[inside]), np.count_nonzero(inside)).astype(np.int32)
    found = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(folded[inside])])
    return found, np.diff(np.searchsorted(np.flatnonzero(begins), bounds))


def _slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of about SLICE_BYTES: the first one's place, their bytes and their bounds within them."""
    _, offsets, data = texts.buffers()
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(offsets, dtype=wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if offsets[-1] > offsets[0] else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1)
        last = min(last, len(texts))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def _count(lookup: Broadcast | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (row_key, doc_id, n, term, tf): one without a term per document, then one per distinct term.

    With a lookup only its terms are passed on, as their ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = lookup.value if lookup is not None else None
        for batch in batches:
            if not batch.num_rows:
                continue
            for first, data, bounds in _slices(batch.column("text")):
                found, n = split_terms(data, bounds)
                found = found.dictionary_encode()
                words = found.dictionary
                code = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                doc = np.repeat(np.arange(len(n)), n)
                if ids is not None:
                    code = np.fromiter((ids.get(w, -1) for w in words.to_pylist()), np.int64, len(words))[code]
                    doc, code = doc[code >= 0], code[code >= 0]
                width = max(len(words) if ids is None else len(ids), 1)
                cell, tf = np.unique(doc * width + code, return_counts=True)
                doc, code = cell // width, cell % width
                term = pa.array(code) if ids is not None else words.take(pa.array(code)).view(pa.string())
                row = pa.array(np.concatenate([np.arange(len(n)), doc]) + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row_key").take(row),
                        batch.column("doc_id").take(row),
                        pa.array(np.concatenate([n, n[doc]]).astype(np.int64)),
                        pa.concat_arrays([pa.nulls(len(n), term.type), term]),
                        pa.array(np.concatenate([np.zeros(len(n), dtype=np.int64), tf])),
                    ],
                    names=["row_key", "doc_id", "n", "term_id" if ids is not None else "term", "tf"],
                )

    return run


def _cells(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, height: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level, the sorted keys of cells holding at least two impacts, and their maxima."""
    levels = []
    for level in range(height + 1):
        shift = height - level
        key = (rows >> shift) << level | (cols >> shift)
        order = np.argsort(key, kind="stable")
        key, vals = key[order], values[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        maxima = np.maximum.reduceat(vals, starts) if len(key) else vals
        many = sizes >= 2
        levels.append((key[starts][many], maxima[many]))
        if not many.any():
            break
    return levels


class ImpactTree:
    """The quadtree of one shard's grid of impacts (rows: term ids, columns: local documents).

    Within the grid rows stand by their largest impact, so a cell's rows are alike and its maximum is near each of theirs.
    """

    def __init__(self, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, width: int) -> None:
        self.terms, at = np.unique(rows, return_inverse=True)
        peak = np.zeros(len(self.terms), dtype=np.int64)
        np.maximum.at(peak, at, values)
        self.place = np.empty(len(self.terms), dtype=np.int64)
        self.place[np.argsort(peak, kind="stable")] = np.arange(len(self.terms))
        rows = self.place[at]
        self.height = max(1, math.ceil(math.log2(max(len(self.terms), width, 2))))
        # A last key beyond all others saves every lookup the question whether it ran off the end.
        levels = _cells(rows, cols, values, self.height)
        self.cells = np.concatenate([keys | 1 << 2 * level for level, (keys, _) in enumerate(levels)] + [[BEYOND]])
        self.maxima = np.concatenate([maxima for _, maxima in levels] + [[0]])
        point = rows << self.height | cols
        order = np.argsort(point)
        self.points, self.values = np.append(point[order], BEYOND), np.append(values[order], 0)

    def bounds(self, levels: np.ndarray, rows: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Per column block (of its level), the sum over the rows of the largest impact in (the row's cell, the block)."""
        step = max(1, LOOKUPS // len(rows))
        return np.concatenate([self._bounds(levels[i : i + step], rows, blocks[i : i + step]) for i in range(0, len(blocks), step)])

    def _bounds(self, levels: np.ndarray, rows: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        shift = self.height - levels
        key = (1 << levels | rows[:, None] >> shift) << levels | blocks
        at = np.searchsorted(self.cells, key)
        stored = self.cells[at] == key
        largest = np.where(stored, self.maxima[at], 0)
        # A cell not stored holds at most one impact: look for it in this row and block.
        row, block = np.nonzero(~stored)
        low = rows[row] << self.height | (blocks << shift)[block]
        at = np.searchsorted(self.points, low)
        hit = self.points[at] < low + (1 << shift)[block]
        largest[row[hit], block[hit]] = self.values[at[hit]]
        return largest.sum(axis=0)

    def top(self, rows: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best columns with a score above 0 as (column, score), best first, ties by column."""
        rows = np.unique(rows)
        at = np.searchsorted(self.terms, rows)
        at = at[np.append(self.terms, BEYOND)[at] == rows]
        if not len(at):
            return []
        rows = np.sort(self.place[at])
        cols = scores = np.zeros(0, dtype=np.int64)
        floor = 1
        levels = blocks = np.zeros(1, dtype=np.int64)
        bound = self.bounds(levels, rows, blocks)
        while len(bound):
            # The best ranges leave the queue and their halves are bounded in one batch.
            order = np.argsort(-bound, kind="stable")
            best, rest = order[:WAVE], order[WAVE:]
            half = (2 * blocks[best][:, None] + np.arange(2)).ravel()
            level = np.repeat(levels[best] + 1, 2)
            halves = self.bounds(level, rows, half)
            single = (level == self.height) & (halves >= floor)
            if single.any():
                cols, scores = np.append(cols, half[single]), np.append(scores, halves[single])
                if len(scores) >= k:
                    # No range below the k-th best column found so far holds a better one.
                    floor = max(floor, int(np.partition(scores, -k)[-k]))
            levels, blocks, bound = (np.append(old[rest], new) for old, new in ((levels, level), (blocks, half), (bound, halves)))
            open_ = (levels < self.height) & (bound >= floor)
            levels, blocks, bound = levels[open_], blocks[open_], bound[open_]
        order = np.lexsort((cols, -scores))[:k]
        return list(zip(cols[order].tolist(), scores[order].tolist()))


def _search(k: int):
    def run(postings: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        columns = ["item_id", "no_item", "row_key", "doc_id", "no_doc", "score"]
        empty = pd.DataFrame({c: pd.Series(dtype="bool" if c.startswith("no_") else "int64") for c in columns})
        if postings.empty or items.empty:
            return empty
        docs = postings[["row_key", "doc_id", "no_doc"]].drop_duplicates("row_key")
        docs = docs.sort_values(["no_doc", "doc_id", "row_key"])
        col = pd.Series(np.arange(len(docs)), index=docs["row_key"].to_numpy())
        cols = col.loc[postings["row_key"].to_numpy()].to_numpy()
        tree = ImpactTree(postings["term_id"].to_numpy(np.int64), cols, postings["impact"].to_numpy(np.int64), len(docs))
        keys, ids, no_doc = (docs[c].to_numpy() for c in ("row_key", "doc_id", "no_doc"))
        found = []
        for item_id, no_item, wanted in zip(items["item_id"], items["no_item"], items["term_ids"]):
            for c, score in tree.top(np.asarray(wanted, dtype=np.int64), k):
                found.append((item_id, no_item, keys[c], ids[c], no_doc[c], score))
        return pd.DataFrame(found, columns=columns) if found else empty

    return run


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text_column: str = "text",
                   item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """Each item's k best documents with a score above 0: item_id, rank, doc_id, score.

    Documents and items are whole tables. Empty tables give no rows; an item without terms, or
    whose terms no document holds, gives none either.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_column).alias("item_id"), F.explode(F.array_distinct(terms(F.col(item_text)))).alias("term"))
    # Dense term ids (rows of the grid), numbered without moving the vocabulary into one task.
    distinct = asked.select("term").distinct()
    # Written once: documents and items read the same numbers, in whatever order a shuffle hands the terms over.
    vocabulary = distinct.rdd.zipWithIndex().map(lambda pair: (pair[0][0], pair[1])).toDF("term string, term_id long")
    vocabulary = cut(vocabulary, "search-terms")
    n_vocabulary = vocabulary.count()
    # The query vocabulary is the items' terms: its size is checked before it is broadcast.
    vocab = F.broadcast(vocabulary) if n_vocabulary <= BROADCAST_TERMS else vocabulary
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("row_key", F.monotonically_increasing_id())
    # Every text is taken apart once: a row without a term has its length, the others its query terms.
    if n_vocabulary <= LOOKUP_TERMS:
        lookup = spark.sparkContext.broadcast({r.term.encode(): r.term_id for r in vocabulary.collect()})
        counted = texts.mapInArrow(_count(lookup), "row_key long, doc_id long, n long, term_id long, tf long")
    else:
        counted = texts.mapInArrow(_count(None), "row_key long, doc_id long, n long, term string, tf long")
        counted = counted.join(vocab, "term", "left").where("term is null or term_id is not null").drop("term")
    # Written once: the counts of documents and terms, df and the impacts read it, and its row count sizes the shards.
    counted = cut(counted, "search-tf")
    lengths, tf = counted.where("term_id is null"), counted.where("term_id is not null")
    stats = lengths.agg(F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    n_docs, n_terms = int(stats["N"]), int(stats["L"])
    if n_docs == 0 or n_vocabulary == 0:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    n_postings = tf.count()
    df = tf.groupBy("term_id").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long")
    m = F.expr(f"10L + (90L * n * {n_docs}L) div {n_terms}L")
    postings = tf.join(F.broadcast(df) if n_vocabulary <= BROADCAST_TERMS else df, "term_id").select(
        "row_key", "doc_id", "term_id", weight.alias("w"), "tf", m.alias("m")
    )
    # A null id goes to pandas as 0 with a mark: one null would turn all ids of a group into floats.
    postings = postings.select(
        "row_key", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.isnull("doc_id").alias("no_doc"), "term_id", (F.col("w") * F.expr("(1000000000L * tf) div (1000L * tf + 8L * m)")).alias("impact")
    )
    shards = max(spark.sparkContext.defaultParallelism, math.ceil(n_postings / SHARD_POSTINGS))
    n_items = items.count()
    blocks = max(1, math.ceil(n_items / ITEMS_PER_TASK))
    # Both sides of the cogroup have keys of one type: an int and a long of equal value hash to different partitions.
    postings = postings.withColumn("shard", F.pmod(F.xxhash64("row_key"), F.lit(shards)).cast("int"))
    postings = postings.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    wanted = asked.join(vocab, "term").groupBy("item_id").agg(F.collect_list("term_id").alias("term_ids"))
    wanted = wanted.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int"))
    wanted = wanted.withColumn("no_item", F.isnull("item_id")).withColumn("item_id", F.coalesce("item_id", F.lit(0)))
    wanted = wanted.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = postings.groupBy("shard", "block").cogroup(wanted.groupBy("shard", "block")).applyInPandas(
        _search(k), "item_id long, no_item boolean, row_key long, doc_id long, no_doc boolean, score long"
    )
    found = found.select(
        F.when(~F.col("no_item"), F.col("item_id")).alias("item_id"), "row_key", F.when(~F.col("no_doc"), F.col("doc_id")).alias("doc_id"), "score"
    )
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row_key")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int"), "doc_id", "score")
