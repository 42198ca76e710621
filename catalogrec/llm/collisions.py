"""Near-duplicate vectors by collision counting on one-dimensional projections.

All vectors are projected on many random lines. On each line the vectors of a block are sorted, and
the window around a query's projection holds the vectors that collide with it there. A pair whose
collisions reach a count calibrated for recall is verified by its exact cosine.

Two unit vectors of cosine ``c`` differ on a line by a normal number of variance ``2 - 2c``, so a
pair at the threshold falls into a window of half width ``sqrt(2 - 2c)`` with probability 0.683, and
the collisions of such a pair are binomial. The count asked for is the largest one that such a pair
misses with probability at most ``MISSED``; nearer pairs collide more often.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .components import components
from .vectors import clean_vectors, widths

LINES = 64
MISSED = 1e-7
BLOCK_ROWS = 4096
_QUERIES = 128
# Ranks between two marks on a line.
_STRIDE = 16
# Components a collided pair is bounded by before its whole product is taken.
_HEAD = 15
_SEED = 20_231_117


def calibrated_count(lines: int = LINES, inside: float = math.erf(math.sqrt(0.5)), missed: float = MISSED) -> int:
    """The largest count that a binomial number of collisions misses with probability <= ``missed``."""
    below = 0.0
    for count in range(lines + 1):
        below += math.comb(lines, count) * inside**count * (1 - inside) ** (lines - count)
        if below > missed:
            return count
    return lines


def _lines(width: int) -> np.ndarray:
    return np.random.default_rng(_SEED).standard_normal((width, LINES))


def _marks(order: np.ndarray) -> np.ndarray:
    """Bitmaps of the vectors whose rank on a line is below each multiple of ``_STRIDE``, as 64-bit words."""
    lines, n = order.shape
    edges = np.arange(0, n + _STRIDE, _STRIDE, dtype=np.uint16)
    marks = np.zeros((lines, len(edges), -(-n // 64) * 8), np.uint8)
    for line in range(lines):
        bits = np.packbits(order[line][None, :] < edges[:, None], axis=1)
        marks[line, :, : bits.shape[1]] = bits
    return marks.view(np.uint64)


def _collisions(low: np.ndarray, high: np.ndarray, marks: np.ndarray) -> list[np.ndarray]:
    """Collisions of each query with each vector of a block, as bit planes: plane ``k`` holds bit ``k`` of the counts.

    ``low`` and ``high`` number the marks around the window of a query per line; the vectors between
    two marks are the difference of their bitmaps. Three bitmaps of one weight add up to one of that
    weight and one of the next, so 64 counts are added per instruction.
    """
    levels: list[list[np.ndarray]] = [[]]

    def add(bits: np.ndarray, level: int) -> None:
        if level == len(levels):
            levels.append([])
        levels[level].append(bits)
        if len(levels[level]) == 3:
            a, b, c = levels[level]
            differ = a ^ b
            levels[level] = [differ ^ c]
            a &= b
            differ &= c
            a |= differ
            add(a, level + 1)

    for line, marked in enumerate(marks):
        add(marked[high[line]] ^ marked[low[line]], 0)
    for level, same in enumerate(levels):
        if len(same) == 2:
            a, b = same
            levels[level] = [a ^ b]
            add(a & b, level + 1)
    return [same[0] for same in levels]


def _reaching(planes: list[np.ndarray], count: int) -> np.ndarray:
    """Bitmap of the counts that are at least ``count``."""
    out = np.full_like(planes[0], np.iinfo(np.uint64).max)
    for k in range(max(len(planes), count.bit_length())):
        plane = planes[k] if k < len(planes) else np.zeros_like(out)
        out = plane & out if count >> k & 1 else plane | out
    return out


def _set_bits(bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the bits set, as packed by ``np.packbits``; only bytes that are not zero are unpacked."""
    octets = bitmap.view(np.uint8)
    row, at = np.nonzero(octets)
    which, bit = np.nonzero(np.unpackbits(octets[row, at][:, None], axis=1))
    return row[which], at[which] * 8 + bit


def _head(unit: np.ndarray) -> np.ndarray:
    """The first components and the length of the rest: the product of two heads is at least that of the vectors."""
    rest = np.linalg.norm(unit[:, _HEAD:], axis=1)
    return np.ascontiguousarray(np.column_stack([unit[:, :_HEAD], rest]))


class _Forest:
    """Union by smallest id among the rows of a tile."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def link(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.parent[max(i, j)] = min(i, j)
        return True


def _tile(threshold: float, width: int):
    lines, count, half = _lines(width), calibrated_count(), math.sqrt(max(2 - 2 * threshold, 1e-12))

    def tile(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        first, second = key
        frame = frame.sort_values("vec_id", kind="stable")
        left = frame if first == second else frame[frame["block"] == first]
        right = frame if first == second else frame[frame["block"] == second]
        empty = pd.DataFrame({"vec_id": [], "n": [], "other": []})
        if not len(left) or not len(right):
            return empty
        x, y = np.stack(left["embedding"]), np.stack(right["embedding"])
        xs, ys = (v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None] for v in (x, y))
        rough_x, rough_y = xs.astype(np.float32), ys.astype(np.float32)
        head_x, head_y = _head(rough_x), _head(rough_y)
        px, py = xs @ lines, ys @ lines
        places = np.argsort(py, axis=0, kind="stable")
        order = np.empty((LINES, len(y)), np.uint16)
        for line in range(LINES):
            order[line][places[:, line]] = np.arange(len(y))
        # Windows are widened to the next marks, so that none loses a vector.
        low, high = np.empty((LINES, len(x)), np.int64), np.empty((LINES, len(x)), np.int64)
        for line in range(LINES):
            sorted_at = py[places[:, line], line]
            low[line] = np.searchsorted(sorted_at, px[:, line] - half, "left") // _STRIDE
            high[line] = -(-np.searchsorted(sorted_at, px[:, line] + half, "right") // _STRIDE)
        marks = _marks(order)
        xid, yid = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        copies_x, copies_y = left["copies"].to_numpy(), right["copies"].to_numpy()
        links_x, links_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
        forest, edges = _Forest(len(x) + len(y)), []
        for start in range(0, len(x), _QUERIES):
            rows = slice(start, min(start + _QUERIES, len(x)))
            reached = _reaching(_collisions(low[:, rows], high[:, rows], marks), count)
            i, j = _set_bits(reached)
            i += start
            if first == second:
                i, j = i[i < j], j[i < j]
            for part in range(0, len(i), 1 << 16):
                a, b = i[part : part + (1 << 16)], j[part : part + (1 << 16)]
                # Single precision only puts aside what is clearly below; the rest is decided in double.
                near = np.einsum("ij,ij->i", head_x[a], head_y[b]) >= threshold - 1e-4
                a, b = a[near], b[near]
                near = np.einsum("ij,ij->i", rough_x[a], rough_y[b]) >= threshold - 1e-4
                a, b = a[near], b[near]
                near = np.einsum("ij,ij->i", xs[a], ys[b]) >= threshold
                a, b = a[near], b[near]
                np.add.at(links_x, a, copies_y[b])
                np.add.at(links_y, b, copies_x[a])
                offset = 0 if first == second else len(x)
                edges += [(xid[u], yid[v]) for u, v in zip(a.tolist(), b.tolist(), strict=True) if forest.link(u, v + offset)]
        if first == second:
            ids, links = xid, links_x + links_y
        else:
            ids, links = np.concatenate([xid, yid]), np.concatenate([links_x, links_y])
        some = links > 0
        edge = np.array(edges, np.int64).reshape(-1, 2)
        # Rows with other >= 0 are edges of the tile's spanning forest, the others link counts.
        return pd.DataFrame(
            {
                "vec_id": np.concatenate([ids[some], edge[:, 0]]),
                "n": np.concatenate([links[some], np.zeros(len(edge), np.int64)]),
                "other": pd.array([*[None] * int(some.sum()), *edge[:, 1].tolist()], dtype="Int64"),
            }
        )

    return tile


def near_vectors(
    df: DataFrame, threshold: float = 0.9, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every id.

    Two vectors link if their cosine in double precision is at least ``threshold``; a found pair is
    always verified, and a pair above the threshold is missed with probability below ``MISSED``.
    Equal vectors are one until the end: their links to others are counted with multiplicity and
    never spelled out. The distinct vectors are dealt into blocks of about ``BLOCK_ROWS`` by a hash
    of the id; a task takes two blocks, so the work grows with the square of the number of vectors
    but a task does not, and it returns link counts and the edges of a spanning forest, not pairs.
    ``component_id`` is the smallest id reachable by links. Unusable vectors (see ``clean_vectors``)
    link with nothing and stand alone; rows with a null id are left out and a repeated id counts
    once. An empty table gives no rows; other columns are not looked at.
    """
    rows = cut(clean_vectors(df, vec_id, embedding), "collision-vectors")
    usable = rows.where("usable")
    width = widths(usable)
    groups = cut(usable.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies")), "collision-groups")
    blocks = max(1, -(-groups.count() // BLOCK_ROWS))
    own = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    # A block meets itself and every other block once.
    pair = F.transform(
        F.sequence(F.lit(0), F.lit(blocks - 1)),
        lambda o: F.struct(F.least(o, F.col("block")).alias("first"), F.greatest(o, F.col("block")).alias("second")),
    )
    tiles = groups.withColumn("block", own).withColumn("pair", F.explode(pair))
    found = cut(
        tiles.select("vec_id", "embedding", "copies", "block", "pair.first", "pair.second")
        .groupBy("first", "second")
        .applyInPandas(_tile(threshold, width), "vec_id long, n long, other long"),
        "collision-links",
    )
    links = found.where("other is null").groupBy("vec_id").agg(F.sum("n").alias("n"))
    linked = components(found.where("other is not null").select(F.col("vec_id").alias("a"), F.col("other").alias("b")))
    classes = (
        groups.join(links, "vec_id", "left")
        .join(linked.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select(
            "embedding",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
    )
    told = usable.select("vec_id", "embedding").join(classes, "embedding").drop("embedding")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = told.unionByName(alone)
    return out.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
