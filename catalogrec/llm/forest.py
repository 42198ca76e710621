"""Nearest neighbours by largest inner product with a hash-prefix forest.

Every vector gets a long hash string per tree: 64 signs of random projections. A tree is the sorted
array of its strings. A query descends in every tree to the longest prefix it shares with a string,
and the trees then ascend together, one level at a time, to shorter prefixes until enough candidates
have been met. Candidates are scored exactly.

The inner product becomes an angle by one more component, sqrt(M^2 - |x|^2) with M the largest
length (0 for queries); where all lengths are equal it is 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .vectors import clean_vectors, widths

TREES = 24
BITS = 64
# Vectors per forest, queries per task and strings met per query and forest, repeats counted.
FOREST_ROWS = 16_384
QUERY_ROWS = 4096
MEETINGS = 24_576
_SEED = 20_240_229


class Forest:
    """Sorted hash strings of a block of vectors."""

    def __init__(self, points: np.ndarray) -> None:
        rng = np.random.default_rng(_SEED)
        self._planes = rng.standard_normal((points.shape[1], TREES * BITS)).astype(np.float32)
        strings = self._hash(points)
        self.order = np.argsort(strings, axis=0, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=0)

    def _hash(self, points: np.ndarray) -> np.ndarray:
        out = np.empty((len(points), TREES), np.uint64)
        for start in range(0, len(points), 2048):
            signs = (points[start : start + 2048].astype(np.float32) @ self._planes) > 0
            packed = np.packbits(signs.reshape(len(signs), TREES, BITS), axis=2)
            out[start : start + 2048] = packed.view(">u8")[..., 0].astype(np.uint64)
        return out

    def ranges(self, queries: np.ndarray, meetings: int) -> tuple[np.ndarray, np.ndarray]:
        """Bounds (query, tree) of the strings met by each query in each sorted array.

        The descent finds the strings that share a prefix of a given length by two binary searches.
        The length is the largest at which all trees together give ``meetings`` strings, found by
        halving because the ranges only grow as prefixes get shorter.
        """
        strings = self._hash(queries)
        short, long = np.zeros(len(strings), np.int64), np.full(len(strings), BITS, np.int64)
        while (short < long).any():
            middle = (short + long + 1) // 2
            low, high = self._at(strings, middle)
            enough = (high - low).sum(1) >= meetings
            short, long = np.where(enough, middle, short), np.where(enough, long, np.minimum(middle - 1, long))
            long = np.maximum(long, short)
        return self._at(strings, short)

    def _at(self, strings: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        tail = np.where(length == 0, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
        some = (length > 0) & (length < BITS)
        tail[some] = (np.uint64(1) << (BITS - length[some]).astype(np.uint64)) - np.uint64(1)
        low, high = np.empty(strings.shape, np.int64), np.empty(strings.shape, np.int64)
        for t in range(TREES):
            low[:, t] = np.searchsorted(self.sorted[:, t], strings[:, t] & ~tail, "left")
            high[:, t] = np.searchsorted(self.sorted[:, t], strings[:, t] | tail, "right")
        return low, high


def _search(k: int, longest: float):
    def search(table: pd.DataFrame) -> pd.DataFrame:
        asked, held = table[table["is_query"]], table[~table["is_query"]]
        found = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []})]
        if not len(asked) or not len(held):
            return found[0]
        x, q = np.stack(held["embedding"]), np.stack(asked["embedding"])
        ids, query_ids = held["vec_id"].to_numpy(), asked["vec_id"].to_numpy()
        lift = np.sqrt(np.maximum(longest**2 - (x * x).sum(1), 0))
        forest = Forest(np.concatenate([x, lift[:, None]], axis=1))
        low, high = forest.ranges(np.concatenate([q, np.zeros((len(q), 1))], axis=1), MEETINGS)
        met = np.zeros(len(x), bool)
        for i, query in enumerate(query_ids):
            met[:] = False
            for t in range(TREES):
                met[forest.order[low[i, t] : high[i, t], t]] = True
            places = np.flatnonzero(met)
            places = places[ids[places] != query]
            scores = np.einsum("ij,j->i", x[places], q[i])
            best = np.lexsort((ids[places], -scores))[:k]
            found.append(pd.DataFrame({"query_id": query, "vec_id": ids[places][best], "score": scores[best]}))
        return pd.concat(found[1:], ignore_index=True)

    return search


def _numbers(count: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))


def nearest_neighbours(
    df: DataFrame, is_query: str = "vec_id % 20 = 0", k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query among all other rows.

    ``is_query`` is a condition on ``vec_id``. The rows are dealt into forests of about
    ``FOREST_ROWS`` by a hash of the id and the queries into blocks of about ``QUERY_ROWS``; every
    block is searched in every forest, and the best of the forests are ranked per query, ties to the
    smaller id. A forest gives up the search when ``MEETINGS`` strings were met, at least all rows of
    a small one; more means better recall. Vectors that are unusable take no part, as query or
    candidate (see ``clean_vectors``, which also settles repeated and null ids); a query without
    candidates gets no row, nor does an empty table. Other columns are not looked at.
    """
    rows = cut(clean_vectors(df, vec_id, embedding).where("usable").drop("usable"), "forest-vectors")
    widths(rows)
    told = rows.agg(
        F.count("*").alias("n"),
        F.sum(F.expr(f"if({is_query}, 1, 0)")).alias("asked"),
        F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)).alias("longest"),
    ).first()
    forests = max(1, -(-told["n"] // FOREST_ROWS))
    blocks = max(1, -(-(told["asked"] or 0) // QUERY_ROWS))
    spot = F.xxhash64("vec_id")
    held = rows.select(
        F.pmod(spot, F.lit(forests)).alias("forest"),
        F.explode(_numbers(blocks)).alias("block"),
        "vec_id", "embedding", F.lit(False).alias("is_query"),
    )
    asked = rows.where(is_query).select(
        F.explode(_numbers(forests)).alias("forest"),
        F.pmod(spot, F.lit(blocks)).alias("block"),
        "vec_id", "embedding", F.lit(True).alias("is_query"),
    )
    found = (
        held.unionByName(asked)
        .groupBy("forest", "block")
        .applyInPandas(_search(k, float(told["longest"] or 0.0) ** 0.5), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
