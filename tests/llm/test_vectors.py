"""Near-duplicate and nearest-neighbour search on vectors against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from catalogrec.llm.collisions import calibrated_count, near_vectors
from catalogrec.llm.components import components
from catalogrec.llm.forest import nearest_neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, score string, n_links int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 7) for i, v in rows], SCHEMA)


def planted(seed=0, width=16):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.standard_normal(width).tolist()) for i in range(120)]
    for i in range(40):  # near copies, a chain of them and exact copies
        rows.append((200 + i, (np.array(rows[i % 8][1]) + 0.08 * rng.standard_normal(width)).tolist()))
    rows += [(300 + i, rows[3][1]) for i in range(5)]
    return rows


AWKWARD = [
    (900, None),
    (901, []),
    (902, [0.0] * 16),
    (903, [float("nan")] + [1.0] * 15),
    (904, [float("inf")] + [1.0] * 15),
    (905, [None] + [1.0] * 15),
    (None, [1.0] * 16),
]


def brute_links(rows, threshold=0.9):
    ids = [i for i, _ in rows]
    x = np.array([np.array(v, np.float32) for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    label = dict(zip(ids, ids, strict=True))
    for _ in ids:
        for i, j in zip(*np.nonzero(near), strict=True):
            label[ids[i]] = min(label[ids[i]], label[ids[j]])
    return {i: (int(near[k].sum()), label[i]) for k, i in enumerate(ids)}


def test_near_vectors_matches_brute_force(spark):
    rows = planted()
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(frame(spark, rows + AWKWARD)).collect()}
    want = brute_links(rows)
    assert {i: got[i] for i in want} == want
    assert {i: got[i] for i in range(900, 906)} == {i: (0, i) for i in range(900, 906)}
    assert None not in got and len(got) == len(rows) + 6


def test_near_vectors_over_several_blocks(spark, monkeypatch):
    import catalogrec.llm.collisions as module

    monkeypatch.setattr(module, "BLOCK_ROWS", 40)
    rows = planted(1)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(frame(spark, rows)).collect()}
    assert got == brute_links(rows)


def test_repeated_ids_and_empty_tables(spark):
    v, w = [1.0, 0.0], [0.0, 1.0]
    got = near_vectors(frame(spark, [(1, v), (1, v), (1, w), (2, w)])).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == [(1, 1, 1, True), (2, 1, 1, False)]
    assert near_vectors(frame(spark, [])).count() == 0
    assert nearest_neighbours(frame(spark, [])).count() == 0
    assert nearest_neighbours(frame(spark, AWKWARD)).count() == 0


def test_different_widths_are_an_error(spark):
    with pytest.raises(ValueError, match="components"):
        near_vectors(frame(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


def test_near_vectors_count_misses_less_than_one_in_ten_million():
    p, count = math.erf(math.sqrt(0.5)), calibrated_count()
    assert sum(math.comb(64, k) * p**k * (1 - p) ** (64 - k) for k in range(count)) <= 1e-7


def test_collisions_are_counted_in_bit_planes():
    from catalogrec.llm.collisions import LINES, _STRIDE, _collisions, _head, _marks, _reaching, _set_bits

    rng = np.random.default_rng(3)
    n, asked = 333, 21  # no multiple of a word or of a stride
    order = np.stack([rng.permutation(n) for _ in range(LINES)]).astype(np.uint16)
    low = rng.integers(0, n // _STRIDE, (LINES, asked))
    high = np.minimum(low + rng.integers(0, 15, (LINES, asked)), -(-n // _STRIDE))
    inside = (order[:, None, :] >= low[:, :, None] * _STRIDE) & (order[:, None, :] < high[:, :, None] * _STRIDE)
    marks = _marks(order)
    assert marks.nbytes < order.nbytes * n // 64  # a bit per vector and mark
    planes = _collisions(low, high, marks)
    for count in (0, 1, 16, 23, 40, 64):
        row, place = _set_bits(_reaching(planes, count))
        got = {(i, j) for i, j in zip(row.tolist(), place.tolist(), strict=True) if j < n}
        assert got == set(zip(*(x.tolist() for x in np.nonzero(inside.sum(axis=0) >= count)), strict=True))
        assert count == 0 or (place < n).all()
    x = rng.standard_normal((50, 40))
    assert (_head(x) @ _head(x).T >= x @ x.T - 1e-9).all()


def test_calibrated_count_misses_seldom():
    p = math.erf(math.sqrt(0.5))
    count = calibrated_count(64, p, 1e-6)
    missed = sum(math.comb(64, k) * p**k * (1 - p) ** (64 - k) for k in range(count))
    assert missed <= 1e-6 < missed + math.comb(64, count) * p**count * (1 - p) ** (64 - count)


def test_neighbours_recall_and_order(spark, monkeypatch):
    import catalogrec.llm.forest as module

    monkeypatch.setattr(module, "FOREST_ROWS", 600)
    monkeypatch.setattr(module, "QUERY_ROWS", 30)
    monkeypatch.setattr(module, "MEETINGS", 1200)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((2000, 24)) * rng.uniform(0.5, 2, (2000, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = nearest_neighbours(frame(spark, rows), "vec_id % 50 = 0", 10).collect()
    x = x.astype(np.float32).astype(np.float64)
    hits = 0
    for q in range(0, 2000, 50):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert all(abs(x[m[1]] @ x[q] - m[2]) < 1e-9 for m in mine) and q not in [m[1] for m in mine]
        assert [m[2] for m in mine] == sorted((m[2] for m in mine), reverse=True)
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += len(set(np.argsort(-scores)[:10]) & {m[1] for m in mine})
    assert hits / 400 >= 0.9


def test_ties_go_to_the_smaller_id(spark):
    rows = [(20, [1.0, 0.0])] + [(i, [1.0, 0.0]) for i in (5, 3, 7)] + [(9, [0.0, 1.0])]
    got = nearest_neighbours(frame(spark, rows), "vec_id % 20 = 0", 3).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 3), (2, 5), (3, 7)]


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(40, 41), (41, 40), (50, 50), (60, 40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 40: 40, 41: 40, 60: 40}
