"""Exact top-k cosine search between two vector tables, without a cross join."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import release, remove, scratch_path

# Bytes of vectors one side may have to be shipped to every executor.
SMALL_SIDE_BYTES = 64 << 20
# Bytes of vectors in a piece of a side where neither side is shipped.
PIECE_BYTES = 32 << 20
# Rows of a left piece whose unit vectors a task holds at once.
_SLICE_ROWS = 1 << 13
# Cells of one similarity block held in a task.
_BLOCK_CELLS = 1 << 20
# Partitions per core into which the larger side is gathered before it is scanned.
_SCANS_PER_CORE = 4
# Scores equal to this many decimals are ties and resolve by id.
SCORE_DECIMALS = 9


class VectorBlock:
    """Ids, unit vectors and exclusion keys of one Arrow batch, as numpy arrays."""

    def __init__(self, table: pa.Table | pa.RecordBatch):
        self.ids = np.asarray(table.column("id"), dtype=np.int64)
        rows = _combined(table.column("vec"))
        flat = np.array(rows.flatten(), dtype=np.float64)
        self.unit = flat.reshape(len(self.ids), -1) if len(self.ids) else flat.reshape(0, 1)
        size = np.sqrt(np.einsum("ij,ij->i", self.unit, self.unit))
        size[size == 0] = 1.0
        self.unit /= size[:, None]
        self.keys = _combined(table.column("keys"))

    def __len__(self) -> int:
        return len(self.ids)

    def coded_keys(self, known: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(row, place in ``known``) of the exclusion keys that are in ``known``, ascending by row."""
        if self.keys.null_count == len(self.keys) or not len(known):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        codes = pc.index_in(self.keys.flatten(), value_set=known)
        hit = np.asarray(codes.is_valid())
        rows = np.asarray(self.keys.value_parent_indices()).astype(np.int64)[hit]
        return rows, np.asarray(codes.filter(codes.is_valid())).astype(np.int64)

    def distinct_keys(self) -> pa.Array:
        return self.keys.flatten().unique().drop_null()


def _combined(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best columns per row; ties go to the lower column."""
    k = min(k, scores.shape[1])
    floor = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k][:, None]
    rows, cols = np.nonzero((scores >= floor) & np.isfinite(scores))
    order = np.lexsort((cols, -scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    starts = np.searchsorted(rows, np.arange(scores.shape[0]))
    keep = np.arange(len(rows)) - starts[rows] < k
    return rows[keep], cols[keep]


class _Excluded:
    """Cells of a similarity block that share a key; the cells asked for are looked up, none is listed."""

    def __init__(self, left: VectorBlock, right: VectorBlock, known: pa.Array):
        self._rows, self._codes = left.coded_keys(known)
        places, codes = right.coded_keys(known)
        self._width = max(1, len(right))
        self._cells = np.unique(codes * self._width + places)
        self._starts = np.searchsorted(codes[np.argsort(codes, kind="stable")], np.arange(len(known) + 1))
        self._of_row = np.searchsorted(self._rows, np.arange(len(left) + 1))

    def among(self, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        """True for the (left row, right place) cells that share a key."""
        out = np.zeros(len(rows), dtype=bool)
        if not len(self._cells):
            return out
        counts = self._of_row[rows + 1] - self._of_row[rows]
        upto = np.concatenate([[0], np.cumsum(counts)])
        begin = 0
        while begin < len(rows):
            fit = int(np.searchsorted(upto, upto[begin] + _BLOCK_CELLS, side="right")) - 1
            end = max(begin + 1, fit)
            n = counts[begin:end]
            at = np.repeat(np.arange(begin, end), n)
            codes = self._codes[np.arange(len(at)) + np.repeat(self._of_row[rows[begin:end]] - (upto[begin:end] - upto[begin]), n)]
            cells = codes * self._width + places[at]
            found = np.minimum(np.searchsorted(self._cells, cells), len(self._cells) - 1)
            out[at[self._cells[found] == cells]] = True
            begin = end
        return out

    def chunks(self, n: int, rows: int, cells: int) -> Iterator[tuple[int, int]]:
        """(begin, count) of consecutive spans of the n left rows, of at most ``rows`` rows and, unless
        it is a single row, at most ``cells`` excluded cells."""
        cell_counts = self._starts[self._codes + 1] - self._starts[self._codes]
        upto = np.concatenate([[0], np.cumsum(np.bincount(self._rows, weights=cell_counts, minlength=n))])
        begin = 0
        while begin < n:
            fit = int(np.searchsorted(upto, upto[begin] + cells, side="right")) - 1
            end = min(n, begin + rows, max(begin + 1, fit))
            yield begin, end - begin
            begin = end


# Rows per ball of the right side's index, and rounds of the clustering that forms the balls.
BALL_ROWS = 128
_BALL_ROUNDS = 3
# Bounds within this of the k-th score are searched: scores are rounded to SCORE_DECIMALS.
_SLACK = 2 * 10.0**-SCORE_DECIMALS
# Past this share of all pairs left to score after each row's first ball, a chunk is scored whole.
_DENSE_SHARE = 0.5


class BallIndex:
    """The right rows of a block grouped into balls, each with its centre and radius.

    For unit vectors q and x in a ball of centre c and radius r (the largest |x - c|),
    q.x = q.c + q.(x - c) <= q.c + r, and as |q - x| >= |q - c| - r, also
    q.x <= 1 - max(0, |q - c| - r)^2 / 2. A ball whose bound is below a query's k-th best score
    holds none of its k best and is skipped. Balls come from a few rounds of spherical k-means
    seeded by evenly spaced rows (no randomness: the same rows give the same balls).
    """

    def __init__(self, right: VectorBlock, ball_rows: int = BALL_ROWS):
        x = right.unit
        n = len(x)
        balls = max(1, ceil(n / ball_rows))
        centres = x[np.linspace(0, n - 1, balls).astype(np.int64)] if n else np.zeros((0, x.shape[1]))
        own = np.zeros(n, dtype=np.int64)
        for _ in range(_BALL_ROUNDS if balls > 1 else 0):
            own = self._assign(x, centres)
            sums = np.zeros_like(centres)
            np.add.at(sums, own, x)
            size = np.linalg.norm(sums, axis=1)
            used = size > 0
            centres[used] = sums[used] / size[used, None]
        present = np.unique(own)
        order = np.argsort(own, kind="stable")
        starts = np.searchsorted(own[order], present)
        self.members = np.split(order, starts[1:])
        self.centres = np.stack([x[m].mean(axis=0) for m in self.members]) if n else np.zeros((0, x.shape[1]))
        self.radii = np.array([np.sqrt(((x[m] - c) ** 2).sum(axis=1)).max() for m, c in zip(self.members, self.centres)])
        self.ball_of = np.empty(n, dtype=np.int64)
        for b, m in enumerate(self.members):
            self.ball_of[m] = b
        self.squares = np.einsum("ij,ij->i", self.centres, self.centres)
        self.narrow = x.astype(np.float32)
        self.scored = 0

    def near(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest ball, bounds of the products with each ball's members) of unit rows."""
        products = q @ self.centres.T
        return np.argmax(products - self.squares / 2, axis=1), _bounds(products, self.squares, self.radii)

    @staticmethod
    def _assign(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
        step = max(1, _BLOCK_CELLS // max(1, len(centres)))
        return np.concatenate([np.argmax(x[i : i + step] @ centres.T, axis=1) for i in range(0, len(x), step)])


def _bounds(products: np.ndarray, squares: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Upper bounds of products with the members of balls, from products with their centres (both of a ball's bounds)."""
    gap = 1 + squares - 2 * products
    np.sqrt(np.maximum(gap, 0, out=gap), out=gap)
    gap -= radii
    np.maximum(gap, 0, out=gap)
    np.square(gap, out=gap)
    gap *= -0.5
    gap += 1
    return np.minimum(products + radii, gap, out=gap)


def _merge(best_s, best_i, rows, scores, ids, k):
    """Fold new (row, score, id) cells into the k best of their rows; ties go to the lower id."""
    own = np.unique(rows)
    r = np.concatenate([np.repeat(own, k), rows])
    s = np.concatenate([best_s[own].ravel(), scores])
    i = np.concatenate([best_i[own].ravel(), ids])
    order = np.lexsort((i, -s, r))
    r = r[order]
    order = order[np.arange(len(r)) - np.searchsorted(r, r) < k]
    best_s[own], best_i[own] = s[order].reshape(-1, k), i[order].reshape(-1, k)


def _exact(q: np.ndarray, x: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Rounded products of single cells of a block, in double precision."""
    if 16 * len(rows) > len(q) * len(x):
        return np.round((q @ x.T)[rows, cols], SCORE_DECIMALS) + 0.0
    part = max(1, _BLOCK_CELLS // q.shape[1])
    spans = [slice(i, i + part) for i in range(0, len(rows), part)]
    found = [np.einsum("ij,ij->i", q[rows[at]], x[cols[at]]) for at in spans]
    return np.round(np.concatenate([np.empty(0), *found]), SCORE_DECIMALS) + 0.0


def _nearest_in_block(
    left: VectorBlock, right: VectorBlock, k: int, known: pa.Array, index: BallIndex | None = None, floor: np.ndarray | None = None
):
    """(left ids, right ids, scores) of the k best right rows of each left row, exactly.

    ``known`` lists the keys of one side: other keys exclude nothing. ``right`` is taken in id
    order (sorted here if it is not), so that equal scores go to the lower id. The right side is searched
    through its ``BallIndex`` (built here unless given): each left row first scores the ball with
    the nearest centre, then every ball whose bound reaches its k-th best score so far. ``floor`` names a
    score per left row below which nothing is wanted (the k-th best of rows met before).
    """
    if not len(left) or not len(right):
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, np.empty(0)
    if np.any(np.diff(right.ids) < 0):
        right, index = _take(right, np.argsort(right.ids, kind="stable")), None
    index = index or BallIndex(right)
    excluded = _Excluded(left, right, known)
    n_balls = len(index.members)
    step = max(1, _BLOCK_CELLS // max(n_balls, k))
    unused = np.iinfo(np.int64).max
    # Products of unit vectors in single precision are off by less than half of this.
    loose = _SLACK + (left.unit.shape[1] + 8) * 2.0**-23
    sizes = np.array([len(b) for b in index.members])
    found = []
    for start, m in excluded.chunks(len(left), step, _BLOCK_CELLS):
        q = left.unit[start : start + m]
        first, bound = index.near(q)
        low = np.full(m, -np.inf) if floor is None else floor[start : start + m]
        best_s, best_i = np.full((m, k), -np.inf), np.full((m, k), unused, dtype=np.int64)
        done = np.zeros((m, n_balls), dtype=bool)

        def better(rows: np.ndarray, places: np.ndarray, scores: np.ndarray) -> np.ndarray:
            """Cells that enter the k best of their rows: a better score, or an equal one with a lower id."""
            last = np.maximum(best_s[rows, -1], low[rows])
            return (scores > last) | ((scores == last) & (right.ids[places] < best_i[rows, -1]))

        def score(ball: int, rows: np.ndarray) -> None:
            part = max(1, _BLOCK_CELLS // (len(index.members[ball]) + k))
            for i in range(0, len(rows), part):
                score_part(ball, rows[i : i + part])

        def score_part(ball: int, rows: np.ndarray) -> None:
            members = index.members[ball]
            scores = np.round(q[rows] @ right.unit[members].T, SCORE_DECIMALS) + 0.0
            index.scored += scores.size
            done[rows, ball] = True
            at, cols = np.nonzero(scores >= np.maximum(best_s[rows, -1], low[rows])[:, None])
            new = better(rows[at], members[cols], scores[at, cols])
            new[new] = ~excluded.among(start + rows[at[new]], members[cols[new]])
            kept = np.full(scores.shape, -np.inf)
            kept[at[new], cols[new]] = scores[at[new], cols[new]]
            at, cols = _best(kept, k)
            _merge(best_s, best_i, rows[at], kept[at, cols], right.ids[members[cols]], k)

        # A bound that is no number (a broken vector in the ball) keeps nothing out.
        wanted = ~(bound[np.arange(m), first] < low - _SLACK)
        for ball in np.unique(first[wanted]):
            score(ball, np.flatnonzero(wanted & (first == ball)))
        left_over = (~done & ~(bound < np.maximum(best_s[:, -1], low)[:, None] - _SLACK)) @ sizes
        if left_over.sum() > _DENSE_SHARE * m * len(right):
            # Little is pruned (vectors without structure): products in single precision tell, with room
            # for their error, the few cells that can enter the k best, and only those are scored exactly.
            narrow = q.astype(np.float32)
            part = max(1, _BLOCK_CELLS // m)
            for i in range(0, len(right), part):
                least = (np.maximum(best_s[:, -1], low)[:, None] - loose).astype(np.float32)
                near = narrow @ index.narrow[i : i + part].T >= least
                index.scored += near.size
                rows, cols = np.divmod(np.flatnonzero(near), near.shape[1])  # one dimension is searched faster than two
                new = ~done[rows, index.ball_of[i + cols]]
                rows, cols = rows[new], cols[new]
                scores = _exact(q, right.unit[i : i + part], rows, cols)
                new = better(rows, i + cols, scores)
                new[new] = ~excluded.among(start + rows[new], i + cols[new])
                if new.any():
                    _merge(best_s, best_i, rows[new], scores[new], right.ids[i + cols[new]], k)
        else:
            for ball in np.argsort(-bound.max(axis=0), kind="stable"):
                rows = np.flatnonzero(~done[:, ball] & ~(bound[:, ball] < np.maximum(best_s[:, -1], low) - _SLACK))
                if len(rows):
                    score(ball, rows)
        rows, cols = np.nonzero(np.isfinite(best_s))
        found.append((left.ids[rows + start], best_i[rows, cols], best_s[rows, cols]))
    return tuple(np.concatenate(part) for part in zip(*found))


def _take(block: VectorBlock, order: np.ndarray) -> VectorBlock:
    taken = object.__new__(VectorBlock)
    taken.ids, taken.unit, taken.keys = block.ids[order], block.unit[order], block.keys.take(pa.array(order))
    return taken


def _batch(parts) -> pa.RecordBatch:
    """Arrow rows of best-first runs, one run per left id."""
    left_ids, right_ids, scores = parts
    fresh = np.ones(len(left_ids), dtype=bool)
    fresh[1:] = left_ids[1:] != left_ids[:-1]
    starts = np.flatnonzero(fresh)
    rank = np.arange(len(left_ids)) - np.repeat(starts, np.diff(np.append(starts, len(left_ids)))) + 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array(left_ids, pa.int64()),
            pa.array(right_ids, pa.int64()),
            pa.array(scores, pa.float64()),
            pa.array(rank, pa.int32()),
        ],
        names=["left_id", "right_id", "similarity", "rank"],
    )


_RESULT = "left_id long, right_id long, similarity double, rank int"


def _side(df: DataFrame, id_col: str, vec_col: str, keys_col: str | None) -> DataFrame:
    keys = F.col(keys_col) if keys_col else F.lit(None)
    return df.where(F.col(vec_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vec_col).alias("vec"),
        keys.cast("array<string>").alias("keys"),
    )


def unique_rows(df: DataFrame, id_col: str) -> DataFrame:
    """One row per id: of several the smallest by its columns in order, nulls first."""
    rest = [c for c in df.columns if c != id_col]
    one = df.groupBy(id_col).agg(F.min(F.struct(*rest)).alias("_one"))
    return one.select(*[F.col(c) if c == id_col else F.col(f"_one.{c}").alias(c) for c in df.columns])


def _measure(side: DataFrame, limit: int) -> int:
    """Bytes of a side: eight per vector cell plus the text of its keys.

    A side whose plan already promises many times the limit is not read to be measured.
    """
    plan = side._jdf.queryExecution().optimizedPlan()
    planned = int(str(plan.stats().sizeInBytes()))
    # Estimates of joins multiply their sides and promise nothing.
    if "Relation" in plan.toString() and "Join" not in plan.toString() and planned > 64 * limit:
        return planned
    key_text = F.aggregate(F.coalesce("keys", F.array().cast("array<string>")), F.lit(0), lambda n, k: n + F.length(k))
    return side.agg(F.sum(F.size("vec").cast("long") * 8 + key_text)).first()[0] or 0


def nearest(
    left: DataFrame,
    right: DataFrame,
    k: int,
    left_id: str,
    right_id: str,
    left_vec: str = "embedding",
    right_vec: str = "embedding",
    left_keys: str | None = None,
    right_keys: str | None = None,
    small_side_bytes: int = SMALL_SIDE_BYTES,
    unique_left: bool = False,
) -> DataFrame:
    """(left_id, right_id, similarity, rank): the k most similar right rows of each left row.

    A left id that occurs on several rows is asked once, with the smallest vector among them (set
    ``unique_left`` where ids are known to be unique, which saves a shuffle). Pairs whose key arrays share a value are skipped (already-read exclusion). All pairs are
    scored as blocked matrix products inside Arrow batches; only top-k rows leave a task. One of
    three exact ways is taken after measuring the sides:

    * right side small: it is broadcast, each left batch is finished in place, no shuffle;
    * left side small: it is broadcast, each right partition emits its own top k per left row,
      and a ranking window merges those;
    * neither small: the right side is cut into cells of near vectors and these into pieces of bounded
      size. Each left row meets its own cell first, then every other piece in which a ball of rows may
      still hold one of its k best (in rounds of bounded shuffle); the same merge follows.
    """
    lhs = _side(left, left_id, left_vec, left_keys)
    if not unique_left:
        lhs = unique_rows(lhs, "id")
    rhs = _side(right, right_id, right_vec, right_keys)
    context = left.sparkSession.sparkContext
    right_bytes = _measure(rhs, small_side_bytes)
    if right_bytes <= small_side_bytes:
        shared = context.broadcast(rhs.toArrow())

        def finish_left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = VectorBlock(shared.value)
            block = _take(block, np.argsort(block.ids, kind="stable"))
            known = block.distinct_keys()
            index = BallIndex(block)
            for batch in batches:
                yield _batch(_nearest_in_block(VectorBlock(batch), block, k, known, index))

        return lhs.mapInArrow(finish_left, _RESULT)

    left_bytes = _measure(lhs, small_side_bytes)
    if left_bytes <= small_side_bytes:
        shared = context.broadcast(lhs.toArrow())

        def scan_right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = VectorBlock(shared.value)
            known = block.distinct_keys()
            best = None
            for batch in batches:
                parts = _nearest_in_block(block, VectorBlock(batch), k, known)
                best = parts if best is None else _keep_best(best, parts, k)
            if best is not None:
                yield _batch(best)

        # A few scans per core, so that few candidates per left row reach the ranking.
        scans = rhs.coalesce(_SCANS_PER_CORE * context.defaultParallelism)
        return _ranked(scans.mapInArrow(scan_right, _RESULT), k)

    return _fragment_and_replicate(lhs, left_bytes, rhs, right_bytes, k)


def _keep_best(a, b, k: int):
    left_ids, right_ids, scores = (np.concatenate(pair) for pair in zip(a, b))
    order = np.lexsort((right_ids, -scores, left_ids))
    left_ids, right_ids, scores = left_ids[order], right_ids[order], scores[order]
    starts = np.searchsorted(left_ids, left_ids)
    keep = np.arange(len(left_ids)) - starts < k
    return left_ids[keep], right_ids[keep], scores[keep]


# Rows that the cells' centres are taken from (the result does not depend on them), and cells at most.
_CENTRE_ROWS = 1 << 13
_MOST_CELLS = 256
_CELL_ROUNDS = 5
# Numbers in the centres of all balls that tell which pieces a row has to meet: they are broadcast.
_ROUTE_NUMBERS = 1 << 20
# Pairs of pieces that meet in a round, per core.
_PAIRS_PER_CORE = 4
_PIECES = "id long, vec array<double>, keys array<string>"


def _unit_rows(column: pa.Array) -> np.ndarray:
    rows = _combined(column)
    unit = np.array(rows.flatten(), dtype=np.float64).reshape(len(rows), -1)
    size = np.sqrt(np.einsum("ij,ij->i", unit, unit))
    size[size == 0] = 1.0
    return unit / size[:, None]


def _centres(side: DataFrame, n: int) -> np.ndarray:
    """Centres of n cells or fewer, from some of the rows."""
    some = side.select("vec").orderBy(F.xxhash64("id"), "id").limit(_CENTRE_ROWS).toArrow()
    x = _unit_rows(some["vec"])
    x = x[np.isfinite(x).all(axis=1)]
    if not len(x):
        return np.zeros((1, x.shape[1]))
    centres = x[np.linspace(0, len(x) - 1, min(n, len(x))).astype(np.int64)]
    for _ in range(_CELL_ROUNDS):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        size = np.linalg.norm(sums, axis=1)
        centres[size > 0] = sums[size > 0] / size[size > 0, None]
    return centres


def _celled(side: DataFrame, centres: np.ndarray, name: str) -> tuple[DataFrame, str, list[int]]:
    """A side written with the cell of each row, its path, and the rows of each cell."""
    spark = side.sparkSession
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.argmax(_unit_rows(batch.column("vec").slice(i, _SLICE_ROWS)) @ shared.value.T, axis=1) for i in range(0, len(batch), _SLICE_ROWS)]
            cell = pa.array(np.concatenate([np.zeros(0, np.int64), *own]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, cell], names=["id", "vec", "keys", "cell"])

    path = scratch_path(spark, name)
    rows = side.withColumn("vec", F.col("vec").cast("array<double>"))
    rows.mapInArrow(assign, f"{_PIECES}, cell int").write.parquet(path)
    written = spark.read.parquet(path)
    counts = dict(written.groupBy("cell").count().collect())
    return written, path, [counts.get(c, 0) for c in range(len(centres))]


def _looked_up(values: list[int], at) -> F.Column:
    return F.get(F.array(*[F.lit(int(v)) for v in values]), at)


def _fragment_and_replicate(lhs: DataFrame, left_bytes: int, rhs: DataFrame, right_bytes: int, k: int) -> DataFrame:
    """Top k of every left row where neither side is small.

    Near vectors lie in the same cell (that of the nearest centre); cells are cut by row id into pieces of
    bounded size. After a left row met the pieces of its own cell, its k-th best score so far tells with
    the bounds of ``BallIndex`` which other pieces it has to meet: none that cannot hold a better row. Where
    vectors are without structure these are all.
    """
    spark = lhs.sparkSession
    centres = _centres(rhs, min(_MOST_CELLS, max(2, ceil(right_bytes / PIECE_BYTES))))
    left, left_path, left_rows = _celled(lhs, centres, "nearest-left")
    right, right_path, right_rows = _celled(rhs, centres, "nearest-right")
    left_bytes, right_bytes = left_bytes / max(1, sum(left_rows)), right_bytes / max(1, sum(right_rows))
    # Pieces are numbered through; those of a cell follow each other.
    parts = [max(1, ceil(n * right_bytes / PIECE_BYTES)) for n in right_rows]
    firsts = [sum(parts[:c]) for c in range(len(parts))]
    piece = _looked_up(firsts, F.col("cell")) + F.pmod(F.xxhash64("id"), _looked_up(parts, F.col("cell"))).cast("int")
    right = right.withColumn("rp", piece)
    first = _looked_up(firsts, F.col("cell"))
    own = F.sequence(first, first + _looked_up(parts, F.col("cell")) - 1)

    out = scratch_path(spark, "nearest-own")
    _meet_pieces(left.select("id", "vec", "keys", F.lit(float("-inf")).alias("floor"), own.alias("rps")), right, left_bytes, k, out)
    met = spark.read.schema(_RESULT).parquet(out)
    best = _materialized(_ranked(met, k), "nearest-best")
    remove(spark, out)

    least = best.where(F.col("rank") == k).select(F.col("left_id").alias("id"), F.col("similarity").alias("floor"))
    known = left.join(least, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    more_path = scratch_path(spark, "nearest-more")
    _routed(known, right, firsts, parts, sum(right_rows)).write.parquet(more_path)
    release(spark)
    more = spark.read.parquet(more_path)
    out = scratch_path(spark, "nearest-other")
    _meet_pieces(more, right, left_bytes, k, out)
    remove(spark, more_path)
    release(spark, left_path, right_path)
    return _ranked(best.unionByName(spark.read.schema(_RESULT).parquet(out)), k)


def _materialized(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(_RESULT).parquet(path)


def _routed(known: DataFrame, right: DataFrame, firsts: list[int], parts: list[int], n_right: int) -> DataFrame:
    """(id, vec, keys, floor, rps): left rows with the pieces outside their cell that may hold a row of score ``floor``."""
    spark = known.sparkSession
    width = (right.select(F.size("vec")).first() or [1])[0]
    ball_rows = max(BALL_ROWS, ceil(n_right * width / _ROUTE_NUMBERS))

    def outline(rows: pa.Table) -> pa.Table:
        """Balls of a piece; its rows are put in order, so that they are the same wherever they are asked for."""
        block = VectorBlock(rows)
        index = BallIndex(block, ball_rows)
        centres = pa.FixedSizeListArray.from_arrays(pa.array(index.centres.ravel()), index.centres.shape[1]).cast(pa.list_(pa.float64()))
        piece = pa.array([rows["rp"][0].as_py()] * len(centres), pa.int32())
        return pa.table({"rp": piece, "centre": centres, "radius": pa.array(index.radii)})

    balls = right.groupBy("rp").applyInArrow(outline, "rp int, centre array<double>, radius double").toArrow().sort_by("rp")
    centres = np.array(_combined(balls["centre"]).flatten(), dtype=np.float64).reshape(balls.num_rows, -1)
    squares = np.einsum("ij,ij->i", centres, centres)
    present, starts = np.unique(np.asarray(balls["rp"]), return_index=True)
    of_cell = np.repeat(np.arange(len(parts)), parts)[present]
    narrow = [a.astype(np.float32) for a in (centres, squares, np.asarray(balls["radius"]))]
    shared = spark.sparkContext.broadcast((narrow, present.astype(np.int32), starts, of_cell))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (centres, squares, radii), present, starts, of_cell = shared.value
        # Bounds in single precision are off by less than this.
        loose = _SLACK + 4 * (centres.shape[1] + 8) * 2.0**-23
        step = max(1, _BLOCK_CELLS // len(centres))
        for batch in (b.slice(i, step) for b in batches for i in range(0, len(b), step)):
            q = _unit_rows(batch.column("vec")).astype(np.float32)
            bound = _bounds(q @ centres.T, squares, radii)
            least = (np.asarray(batch.column("floor")) - loose).astype(np.float32)
            meets = np.logical_or.reduceat(~(bound < least[:, None]), starts, axis=1)
            meets &= np.asarray(batch.column("cell"))[:, None] != of_cell
            counts = meets.sum(axis=1)
            rps = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(present[np.nonzero(meets)[1]]))
            some = pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "vec", "keys", "floor")), rps], names=["id", "vec", "keys", "floor", "rps"])
            yield some.filter(pa.array(counts > 0))

    return known.select("id", "vec", "keys", "floor", "cell").mapInArrow(route, f"{_PIECES}, floor double, rps array<int>")


def _meet_pieces(left: DataFrame, right: DataFrame, left_bytes: float, k: int, out: str) -> None:
    """Write the k best of each left row (id, vec, keys, floor, rps) in each of its right pieces ``rps``.

    The left rows of a piece are cut by row id into parts of bounded size. The pairs of parts and pieces
    are numbered and meet in rounds; a round's shuffle files are released before the next one.
    """
    spark = left.sparkSession
    asked = dict(left.select(F.explode("rps").alias("rp")).groupBy("rp").count().collect())
    n = max(asked, default=0) + 1
    parts = [ceil(asked.get(p, 0) * left_bytes / PIECE_BYTES) for p in range(n)]
    cores = spark.sparkContext.defaultParallelism
    # Parts enough for all cores where few pieces are asked.
    while 0 < sum(parts) < cores and max(asked.values()) > _SLICE_ROWS * max(parts):
        parts = [2 * p for p in parts]
    firsts = [sum(parts[:p]) for p in range(n)]
    number = _looked_up(firsts, F.col("rp"))
    total = _looked_up(parts, F.col("rp"))
    part = F.pmod(F.xxhash64("id", F.lit(1)), total).cast("int")
    pairs_left = left.withColumn("rp", F.explode("rps")).drop("rps").withColumn("pair", number + part)
    pairs_right = right.where(total > 0).withColumn("pair", F.explode(F.sequence(number, number + total - 1)))

    def meet(l: pa.Table, r: pa.Table) -> pa.Table:
        return _meet(l, r, k)

    per_round = max(1, _PAIRS_PER_CORE * cores)
    for at in range(0, sum(parts), per_round):
        now = F.col("pair").between(at, at + per_round - 1)
        grid_left = pairs_left.where(now).select("id", "vec", "keys", "floor", "pair").groupBy("pair")
        grid_right = pairs_right.where(now).select("id", "vec", "keys", "pair").groupBy("pair")
        found = grid_left.cogroup(grid_right).applyInArrow(meet, _RESULT)
        found.write.mode("append").parquet(out)
        del grid_left, grid_right, found
        release(spark)
    if not sum(parts):
        spark.createDataFrame([], _RESULT).write.parquet(out)


def _meet(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The k best right rows of each left row; of the left side one slice at a time becomes unit vectors."""
    block = VectorBlock(right)
    block = _take(block, np.argsort(block.ids, kind="stable"))
    index = BallIndex(block)
    found = []
    for at in range(0, max(1, len(left)), _SLICE_ROWS):
        part = left.slice(at, _SLICE_ROWS)
        asked = VectorBlock(part)
        floor = np.array(_combined(part["floor"]), dtype=np.float64)
        found.append(_batch(_nearest_in_block(asked, block, k, asked.distinct_keys(), index, floor)))
    return pa.Table.from_batches(found)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("left_id").orderBy(F.desc("similarity"), "right_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
