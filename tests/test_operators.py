"""Table operators against brute force, on skewed inputs where it matters."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogrec.operators import classify, metrics, sampling, similarity, statistics
from catalogrec.operators.dedup import FILL_COLUMNS, dedup_merge, drop_exact_duplicates, exact_duplicate_count
from catalogrec.operators.encoder import encode_text, encode_with, fit_encoder
from catalogrec.operators.keywords import default_stop_words, extract_keywords, term_counts
from catalogrec.operators.quality import split_suggestions, verify_titles
from catalogrec.plans.benchmark import benchmark_labels, kpi_tables
from catalogrec.sources.catalog_csv import CATALOG_SCHEMA

SCHEMA = "book_id long, " + ", ".join(f"{c} {t}" for c, t in CATALOG_SCHEMA.items())


def book(i, title=None, authors=None, description=None, **more):
    row = {**dict.fromkeys(CATALOG_SCHEMA), "title": title, "authors": authors, "description": description, **more}
    return (i, *row.values())


def books(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


# --- merge of duplicates -----------------------------------------------------------------------


def test_merge_fills_from_other_rows(spark):
    df = books(spark, [book(1, "T", "A", "short", year=2001.0), book(2, " t ", None, "longer txt")])
    (row,) = dedup_merge(df).collect()
    assert (row.book_id, row.description, row.authors, row.year) == (2, "longer txt", "A", 2001.0)


def test_different_authors_stay(spark):
    df = books(spark, [book(1, "T", "A", "x"), book(2, "T", "B", "x"), book(3, "T", None, "x")])
    assert dedup_merge(df).count() == 3
    prefixed = books(spark, [book(1, "T", "By Austen, Jane", "x"), book(2, "T", "Jane Austen", "x")])
    assert dedup_merge(prefixed).count() == 2


def test_ties_and_null_titles(spark):
    df = books(spark, [book(5, "T", None, "abc"), book(3, "t", None, "xyz"), book(7, None, None, "n"), book(8, " ", None, "nn")])
    assert sorted(r.book_id for r in dedup_merge(df).collect()) == [3, 8]


def brute_merge(rows):
    groups = {}
    for r in sorted(rows):
        groups.setdefault(" ".join((r[1] or "").lower().split()), []).append(r)
    out = []
    names = ["book_id", *CATALOG_SCHEMA]
    for group in groups.values():
        authors = {(r[2] or "").strip().lower().split(",")[0] for r in group} - {""}
        if len(group) == 1 or len(authors) > 1:
            out += group
            continue
        best = list(max(group, key=lambda r: (len(r[3] or ""), -r[0])))
        for c in FILL_COLUMNS:
            i = names.index(c)
            if best[i] in (None, ""):
                best[i] = next((r[i] for r in group if r[i] not in (None, "")), best[i])
        out.append(tuple(best))
    return sorted(out, key=lambda r: r[0])


def test_merge_equals_brute_force_with_a_hot_title(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        title = "Hot" if hot else f"T{rnd.randrange(700)}"
        author = None if hot or rnd.random() < 0.5 else f"A{rnd.randrange(2)}"
        rows.append(
            book(i, title, author, "d" * rnd.randrange(40), year=rnd.choice([None, 1990.0]), series=rnd.choice([None, "", "S"]), genres_raw=rnd.choice([None, "g"]))
        )
    got = sorted(tuple(r) for r in dedup_merge(books(spark, rows)).collect())
    assert got == brute_merge(rows)


def test_merge_is_idempotent_on_merged_groups(spark):
    df = books(spark, [book(i, f"T{i % 5}", None, "d" * i) for i in range(40)])
    once = dedup_merge(df)
    assert sorted(map(tuple, dedup_merge(once).collect())) == sorted(map(tuple, once.collect()))


def test_exact_duplicates(spark):
    rows = [(1, "a" * 70, "x"), (2, "a" * 70, "x"), (3, "a" * 70, None), (4, "a" * 70, None), (5, "b", "x")]
    df = spark.createDataFrame(rows, "id long, t string, l string")
    assert exact_duplicate_count(df, ["t", "l"]).first()[0] == 2
    assert sorted(r.id for r in drop_exact_duplicates(df, ["t", "l"], "id").collect()) == [1, 3, 5]


# --- keywords ----------------------------------------------------------------------------------


def test_term_counts(spark):
    df = spark.createDataFrame([("b a2 A2 b_c zz zz zz x",), ("",), (None,)], "t string")
    got = [r[0] and [tuple(t) for t in r[0]] for r in df.select(term_counts(F.col("t"))).collect()]
    assert got == [[("a2", 2), ("b_c", 1), ("zz", 3)], None, None]


def test_keywords(spark):
    docs = [(1, "the cat sat cat"), (2, "dog dog cat"), (3, " "), (4, "the the")]
    df = spark.createDataFrame(docs, "book_id long, desc_clean string")
    got = {r.book_id: r.keywords for r in extract_keywords(df, stop_words=["the"]).collect()}
    assert got == {1: ["cat", "sat"], 2: ["dog", "cat"]}
    limited = {r.book_id: r.keywords for r in extract_keywords(df, stop_words=["the"], max_terms=1).collect()}
    assert limited == {1: ["cat"], 2: ["cat"]}
    assert "the" in default_stop_words()


# --- similarity --------------------------------------------------------------------------------


def brute_nearest(left, right, k, skip):
    out = {}
    for li, lv in left.items():
        scored = []
        for ri, rv in right.items():
            if skip(li, ri):
                continue
            size = np.linalg.norm(lv) * np.linalg.norm(rv)
            scored.append((-round(float(lv @ rv / size) if size else 0.0, 9), ri))
        out[li] = [ri for _, ri in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("small_bytes", [1 << 26, 3000, 700])
def test_nearest_all_strategies(spark, small_bytes):
    rng = np.random.default_rng(3)
    left = {i: rng.normal(size=6) for i in range(40)}
    right = {i: rng.normal(size=6) for i in range(100, 400)}
    for i in range(150, 250):  # a third of the rows are copies of one vector
        right[i] = right[150]
    right[399] = np.zeros(6)
    hot = {i: ["hot"] if i % 3 == 0 else [f"k{i}"] for i in left}
    carried = {i: ["hot", "z"] if i % 2 else ["other"] for i in right}

    def frame(vectors, keys):
        rows = [(i, [float(x) for x in v], keys[i]) for i, v in vectors.items()]
        return spark.createDataFrame(rows, "id long, embedding array<double>, keys array<string>").repartition(3)

    found = similarity.nearest(
        frame(left, hot), frame(right, carried), 7, "id", "id", left_keys="keys", right_keys="keys", small_side_bytes=small_bytes
    )
    got = {}
    for r in found.orderBy("left_id", "rank").collect():
        got.setdefault(r.left_id, []).append(r.right_id)
    assert got == brute_nearest(left, right, 7, lambda a, b: bool(set(hot[a]) & set(carried[b])))


def _block(vectors, keys=None):
    import pyarrow as pa

    ids = list(vectors)
    table = pa.table({
        "id": pa.array(ids, pa.int64()),
        "vec": pa.array([[float(x) for x in vectors[i]] for i in ids], pa.list_(pa.float64())),
        "keys": pa.array([keys[i] if keys else None for i in ids], pa.list_(pa.string())),
    })
    return similarity.VectorBlock(table)


@pytest.mark.parametrize("clustered", [True, False])
def test_ball_index_is_exact_and_prunes_clustered_vectors(clustered):
    import pyarrow as pa

    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16))
    make = (lambda: centres[rng.integers(0, 40)] + 0.05 * rng.normal(size=16)) if clustered else (lambda: rng.normal(size=16))
    right = {i: make() for i in range(3000)}
    for i in range(100, 400):  # a hot group of copies: ties resolve by id
        right[i] = right[100]
    right[7] = np.zeros(16)
    left = {i: make() for i in range(200)}
    left[0] = right[100]
    hot = {i: ["a"] if i % 4 == 0 else [f"q{i}"] for i in left}
    carried = {i: ["a"] if i % 5 == 0 else None for i in right}
    lhs, rhs = _block(left, hot), _block(right, carried)
    index = similarity.BallIndex(rhs)
    known = pa.array(["a"] + [f"q{i}" for i in left])
    li, ri, _ = similarity._nearest_in_block(lhs, rhs, 6, known, index)
    got = {}
    for a, b in zip(li.tolist(), ri.tolist()):
        got.setdefault(a, []).append(b)
    assert got == brute_nearest(left, right, 6, lambda a, b: bool(set(hot[a]) & set(carried[b] or [])))
    grid = len(left) * len(right)
    assert index.scored < 0.25 * grid if clustered else index.scored <= 1.1 * grid


@pytest.mark.parametrize("clustered", [True, False])
def test_blocks_of_scores_are_bounded(monkeypatch, clustered):
    import pyarrow as pa

    limit = 4000
    monkeypatch.setattr(similarity, "_BLOCK_CELLS", limit)
    seen = []
    for name, place in (("_best", 0), ("_merge", 3)):
        real = getattr(similarity, name)
        monkeypatch.setattr(similarity, name, lambda *a, real=real, place=place: seen.append(a[place].size) or real(*a))
    rng = np.random.default_rng(4)
    centre = rng.normal(size=8)
    right = {i: centre + 1e-3 * rng.normal(size=8) if clustered and i < 900 else rng.normal(size=8) for i in range(1000)}
    left = {i: centre + 1e-3 * rng.normal(size=8) if clustered else rng.normal(size=8) for i in range(300)}
    keys, carried = {i: ["hot"] if i % 2 else [f"q{i}"] for i in left}, {i: ["hot"] if i % 3 == 0 else None for i in right}
    known = pa.array(["hot"])
    spans = list(similarity._Excluded(_block(left, keys), _block(right, carried), known).chunks(len(left), 100, limit))
    assert [b for b, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))] and sum(n for _, n in spans) == len(left)
    assert max(n for _, n in spans) * 334 // 2 <= 2 * limit
    li, ri, _ = similarity._nearest_in_block(_block(left, keys), _block(right, carried), 5, known)
    got = {}
    for a, b in zip(li.tolist(), ri.tolist()):
        got.setdefault(a, []).append(b)
    assert got == brute_nearest(left, right, 5, lambda a, b: a % 2 == 1 and b % 3 == 0)
    assert max(seen) <= limit


def test_block_search_holds_few_cells_of_a_hot_key():
    """Neither the pairs excluded by one shared key nor the scores of a block are listed in whole."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(12)
    right = {i: rng.normal(size=8) for i in range(12_000)}
    left = {i: rng.normal(size=8) for i in range(1_500)}
    left[3] = np.zeros(8)
    hot, carried = {i: ["hot"] if i % 2 else ["cold"] for i in left}, {i: ["hot"] if i % 3 else ["rare"] for i in right}
    lhs, rhs = _block(left, hot), _block(right, carried)
    tracemalloc.start()
    li, ri, _ = similarity._nearest_in_block(lhs, rhs, 5, pa.array(["hot", "cold"]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6
    got = {}
    for a, b in zip(li.tolist(), ri.tolist()):
        got.setdefault(a, []).append(b)
    some = {i: left[i] for i in (0, 1, 2, 3, 777)}
    assert {i: got[i] for i in some} == brute_nearest(some, right, 5, lambda a, b: a % 2 == 1 and b % 3 != 0)


def test_pieces_meet_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(similarity, "PIECE_BYTES", 300)
    rounds = []
    monkeypatch.setattr(similarity, "release", lambda s, *paths: rounds.append(paths))
    rng = np.random.default_rng(6)
    left, right = ({i: rng.normal(size=4) for i in range(a, a + 60)} for a in (0, 100))
    frames = [spark.createDataFrame([(i, [float(x) for x in v]) for i, v in m.items()], "id long, embedding array<double>") for m in (left, right)]
    got = {}
    for r in similarity.nearest(*frames, 4, "id", "id", small_side_bytes=100).orderBy("left_id", "rank").collect():
        got.setdefault(r.left_id, []).append(r.right_id)
    assert got == brute_nearest(left, right, 4, lambda a, b: False)
    assert len(rounds) > 2 and not any(rounds[:-1]) and len(rounds[-1]) == 2


@pytest.mark.parametrize("clustered", [True, False])
def test_rows_meet_only_pieces_that_may_hold_a_better_row(spark, monkeypatch, clustered):
    monkeypatch.setattr(similarity, "PIECE_BYTES", 4000)
    met = []
    meet = similarity._meet_pieces
    monkeypatch.setattr(similarity, "_meet_pieces", lambda left, *a: met.append(sum(len(r.rps) for r in left.select("rps").collect())) or meet(left, *a))
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(12, 8))
    make = lambda i: centres[i % 12] + 0.02 * rng.normal(size=8) if clustered else rng.normal(size=8)
    left, right = {i: make(i) for i in range(120)}, {i: make(i) for i in range(500, 1100)}
    for i in range(700, 760):  # copies: ties go to the lower id, some are excluded
        right[i] = right[700]
    left[3], left[4], right[501] = right[700], np.zeros(8), np.zeros(8)
    hot = {i: ["hot"] if i % 3 == 0 else [f"k{i}"] for i in left}
    carried = {i: ["hot", "z"] if i % 2 else None for i in right}
    hot[5] = ["all"]  # a row whose own cell is excluded must look elsewhere
    for i in right:
        if clustered and i % 12 == 5:
            carried[i] = ["all"]

    def frame(vectors, keys):
        rows = [(i, [float(x) for x in v], keys[i]) for i, v in vectors.items()]
        return spark.createDataFrame(rows, "id long, embedding array<double>, keys array<string>").repartition(3)

    found = similarity.nearest(frame(left, hot), frame(right, carried), 5, "id", "id", left_keys="keys", right_keys="keys", small_side_bytes=100)
    got = {}
    for r in found.orderBy("left_id", "rank").collect():
        got.setdefault(r.left_id, []).append(r.right_id)
    assert got == brute_nearest(left, right, 5, lambda a, b: bool(set(hot[a]) & set(carried[b] or [])))
    pieces = 600 * 64 // 4000
    assert len(met) == 2 and (sum(met) < 0.5 * 120 * pieces if clustered else True)


def test_nearest_with_fewer_rows_than_k(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id long, embedding array<double>")
    found = similarity.nearest(df, df, 5, "id", "id").collect()
    assert sorted((r.left_id, r.rank, r.right_id) for r in found) == [(1, 1, 1), (1, 2, 2), (2, 1, 2), (2, 2, 1)]


# --- statistics --------------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["normal", "hot", "outlier", "constant", "pair", "tiny"])
def test_exact_quantiles(spark, kind, monkeypatch):
    monkeypatch.setattr(statistics, "_LISTED_VALUES", 50)
    monkeypatch.setattr(statistics, "_BUCKETS", 16)
    rng = np.random.default_rng(5)
    values = {
        "normal": rng.normal(size=2000),
        "hot": np.where(rng.random(3000) < 0.34, 7.0, rng.normal(size=3000) * 100),
        "outlier": np.append(rng.random(999), [1e300, -1e300]),
        "constant": np.full(500, 3.5),
        "pair": np.array([1.0, 2.0]),
        "tiny": np.array([5e-324, 0.0, 1e-320]),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double").repartition(4)
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r.prob: r.quantile for r in statistics.exact_quantiles(df, "v", probs).collect()}
    want = np.quantile(values, probs)
    assert [got[p] for p in probs] == pytest.approx(list(want), rel=1e-12, abs=1e-300)


def test_describe_empty_and_histogram(spark):
    empty = spark.createDataFrame([], "v double")
    got = {r.statistic: r.value for r in statistics.describe(empty, ["v"]).collect()}
    assert got["count"] == 0 and got["50%"] is None
    rng = np.random.default_rng(9)
    values = rng.random(500)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    bins = statistics.histogram(df, "v", 10).orderBy("bin").collect()
    assert [r["count"] for r in bins] == list(np.histogram(values, 10)[0])


def test_split_quota_per_label(spark):
    rows = [(i, "hot" if i % 3 else f"l{i % 7}") for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, label string").repartition(4)
    out = sampling.stratified_split(df, "label", "id")
    counts = {r.label: (r.n, r.t) for r in out.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert out.count() == 4000
    assert all(t == int(0.25 * n + 0.5) for n, t in counts.values())


def test_cap_and_support(spark):
    df = spark.createDataFrame([(i, "a" if i < 50 else "b") for i in range(60)], "id long, label string")
    assert sampling.stratified_cap(df, "label", "id", cap=20).groupBy("label").count().collect() != []
    assert {r.label: r["count"] for r in sampling.stratified_cap(df, "label", "id", cap=20).groupBy("label").count().collect()} == {"a": 20, "b": 10}
    assert {r.label for r in sampling.min_support(df, "label", 11).collect()} == {"a"}


# --- metrics -----------------------------------------------------------------------------------

# A published 14 x 14 confusion matrix with its published scores.
GENRES = (
    "arts_poetry fantasy_scifi fiction history_biography horror humor lifestyle mystery_thriller other "
    "romance science_academic sequential_art spirituality_philosophy young_adult"
).split()
MATRIX = [
    [58, 2, 2, 2, 1, 7, 7, 1, 2, 4, 4, 1, 8, 1],
    [3, 51, 2, 1, 16, 0, 0, 5, 3, 7, 0, 8, 2, 2],
    [9, 10, 13, 7, 4, 4, 2, 17, 4, 14, 3, 6, 3, 4],
    [6, 2, 6, 53, 1, 3, 1, 3, 7, 4, 4, 1, 9, 0],
    [3, 11, 0, 0, 60, 2, 1, 12, 0, 5, 0, 3, 1, 2],
    [6, 0, 2, 10, 3, 53, 5, 1, 3, 3, 5, 4, 2, 3],
    [3, 0, 0, 3, 0, 4, 72, 1, 0, 1, 7, 1, 6, 2],
    [3, 3, 6, 5, 9, 1, 0, 57, 1, 8, 0, 3, 1, 3],
    [9, 8, 4, 8, 3, 5, 4, 8, 6, 16, 13, 5, 8, 3],
    [0, 5, 6, 2, 11, 1, 0, 5, 2, 63, 0, 2, 2, 1],
    [2, 4, 2, 11, 0, 3, 5, 1, 2, 0, 58, 0, 7, 5],
    [4, 16, 2, 2, 5, 7, 1, 5, 0, 2, 0, 48, 2, 6],
    [5, 1, 0, 2, 0, 1, 5, 3, 1, 5, 8, 0, 69, 0],
    [3, 10, 4, 1, 3, 2, 5, 2, 1, 18, 2, 4, 5, 40],
]
SCORES = {
    "accuracy": 0.5007142857142857,
    "precision_weighted": 0.48141439991506485,
    "recall_weighted": 0.5007142857142857,
    "f1_weighted": 0.482647675235744,
}


def test_published_matrix(spark):
    rows = [(a, p) for a, line in zip(GENRES, MATRIX) for p, n in zip(GENRES, line) for _ in range(n)]
    tables = kpi_tables(spark.createDataFrame(rows, "actual string, predicted string"))
    rates = {r.label: r for r in tables["one_vs_rest"].collect()}
    first = rates["arts_poetry"]
    assert (first.tp, first.fn, first.fp, first.tn) == (58, 42, 56, 1244)
    assert all(r.tp + r.fp + r.fn + r.tn == 1400 for r in rates.values())
    assert metrics.weighted_scores(tables["one_vs_rest"]).first().asDict() == pytest.approx(SCORES, abs=1e-12)
    report = {r.label: r for r in tables["class_report"].collect()}
    assert report["lifestyle"].f1_score == pytest.approx(0.6923076923076923)
    assert report["other"].f1_score == pytest.approx(0.09090909090909091)
    assert report["macro avg"].precision == pytest.approx(0.48141439991506474)


def test_empty_row_of_percentages(spark):
    df = spark.createDataFrame([("a", "b")], "actual string, predicted string")
    cells = {(r.actual, r.predicted): r.percent for r in kpi_tables(df, labels=["a", "b", "c"])["confusion_percent"].collect()}
    assert cells["a", "b"] == 100.0 and cells["c", "a"] == 0.0 and len(cells) == 9


# --- classifiers and encoder -------------------------------------------------------------------


def test_standardize_and_centroids(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 4)) * [1, 5, 0, 2] + 3
    df = spark.createDataFrame([(i, int(i % 2), [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, label int, embedding array<double>")
    deviation = x.std(axis=0)
    deviation[deviation < 1e-12] = 1
    want = (x - x.mean(axis=0)) / deviation
    got = np.array([r.embedding for r in classify.standardize(df).orderBy("vec_id").collect()])
    assert got == pytest.approx(want, abs=1e-9)
    means = {r.label: r.embedding for r in classify.centroids(df).collect()}
    assert means[1] == pytest.approx(x[1::2].mean(axis=0))
    fitted = classify.standardize(df, fit_on=df.where("label = 0")).orderBy("vec_id").first().embedding
    assert fitted[0] == pytest.approx((x[0, 0] - x[::2, 0].mean()) / x[::2, 0].std())


def test_encoder(spark):
    df = spark.createDataFrame([(1, "dark castle ghost"), (2, "sunny beach holiday"), (3, None)], "book_id long, text_full string")
    model = fit_encoder(df)
    vectors = {r.book_id: np.array(r.embedding) for r in encode_text(model, df, "text_full").collect()}
    assert len(vectors[1]) == 384 and np.linalg.norm(vectors[1]) == pytest.approx(1, abs=1e-6)
    assert not vectors[3].any()
    question = encode_text(model, spark.createDataFrame([("ghost castle",)], "q string"), "q").first().embedding
    assert np.dot(question, vectors[1]) > np.dot(question, vectors[2])
    custom = encode_with(df, "text_full", lambda: (lambda texts: [[float(len(t))] for t in texts])).collect()
    assert {r.book_id: r.embedding for r in custom} == {1: [17.0], 2: [19.0], 3: [0.0]}


def test_benchmark(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 3, [float(v) for v in rng.normal(size=5) + 4 * (i % 3)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    out = benchmark_labels(df, cap=30, support=20, trees=5)
    assert {r.name for r in out["comparison"].collect()} == {"centroid", "knn", "hybrid", "logistic_regression", "random_forest"}
    summary = out["summary"].first()
    assert (summary.n_books_corpus, summary.n_books_sampled, summary.n_test, summary.n_genres) == (120, 90, 24, 3)
    assert summary.accuracy == max(r.accuracy for r in summary.model_comparison)
    assert sum(map(sum, summary.confusion_matrix)) == 24


# --- generated text ----------------------------------------------------------------------------


def test_title_verification(spark):
    rows = [(1, "Text\nLIVRES_SIMILAIRES: A | B | a"), (2, "no titles"), (3, "x LIVRES_SIMILAIRES: Z")]
    df = split_suggestions(spark.createDataFrame(rows, "query_id long, raw_summary string"))
    catalog = spark.createDataFrame([(" a ",), ("A",), (None,)], "title string")
    got = {r.query_id: tuple(r)[1:] for r in verify_titles(df, catalog, "query_id").collect()}
    assert got == {1: (2, 3, 33.3), 2: (0, 0, None), 3: (0, 1, 100.0)}


@pytest.mark.parametrize("small_side_bytes", [1 << 26, 2000, 200])
def test_nearest_asks_a_repeated_id_once(spark, small_side_bytes):
    """All three ways agree, whichever side is small."""
    left = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0])]
    right = [(i, [float(i), 10.0 - i]) for i in range(11)] * 3
    asked = spark.createDataFrame(left, "id long, embedding array<double>")
    offered = spark.createDataFrame([(i + 100 * (j % 3), v) for j, (i, v) in enumerate(right)], "id long, embedding array<double>")
    found = similarity.nearest(asked, offered.dropDuplicates(["id"]), 3, "id", "id", small_side_bytes=small_side_bytes)
    rows = sorted((r["left_id"], r["rank"]) for r in found.collect())
    assert rows == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3)]
    best = {r["left_id"]: r["right_id"] for r in found.where("rank = 1").collect()}
    assert best[1] % 100 == 0


def test_profile_counts_nested_columns_and_decimals(spark):
    from catalogrec.plans.profile import profile

    df = spark.sql("select 1 as a, array(1.0) as b, map('x', 1) as c, cast(1.5 as decimal(9,2)) as d union all select 1, array(2.0), map('x', 1), 1.5")
    tables = profile(df)
    assert tables["duplicates"].first()[0] == 0
    assert "d" in {r["column"] for r in tables["summary"].collect()}
    assert profile(df.union(df))["duplicates"].first()[0] == 2


def test_book_ids_follow_file_order(spark, tmp_path):
    from catalogrec.sources.catalog_csv import load_source_1

    header = "Title,Book_Description,Stars,Category\n"
    for name, rows in (("1", 2), ("2", 40), ("3", 7)):
        text = header + "".join(f"t{name}-{i},d,4.0,c\n" for i in range(rows))
        (tmp_path / f"{name}.csv").write_text(text)
    want = [f"t1-{i}" for i in range(2)] + [f"t2-{i}" for i in range(40)] + [f"t3-{i}" for i in range(7)]
    for cost in ("4194304", "1"):
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        got = load_source_1(spark, str(tmp_path)).orderBy("book_id").collect()
        spark.conf.unset("spark.sql.files.openCostInBytes")
        assert [r["title"] for r in got] == want and [r["book_id"] for r in got] == list(range(49))


def test_types_are_inferred_after_missing_tokens(spark, tmp_path):
    from catalogrec.sources.catalog_csv import read_csv

    (tmp_path / "a.csv").write_text("i,l,d,b,day,t,s,none\n1,1,NA,true,2020-01-02,2020-01-02 03:04:05,x,NA\nNA,9999999999,2.5,NA,NA,NA,1,\n")
    df = read_csv(spark, str(tmp_path), infer=True)
    assert [t for _, t in df.dtypes] == ["int", "bigint", "double", "boolean", "date", "timestamp", "string", "string"]


def test_spread_starts_no_job(spark):
    from catalogrec.session import spread

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("spread", "")
    spread(spark.range(10).groupBy("id").count(), "id")
    spread(spark.range(10).repartition(3), "id")
    assert list(tracker.getJobIdsForGroup("spread")) == []
    spark.sparkContext.setJobGroup("", "")


@pytest.mark.parametrize("encoding", ["UTF-8", "ISO-8859-1"])
def test_split_csv_reads_quoted_line_breaks_in_several_tasks(spark, tmp_path, encoding):
    import csv

    from catalogrec.sources.catalog_csv import ROW_ID, read_split_csv

    rng = random.Random(4)
    texts = ["plain", 'with "quotes"', "line\nbreak", 'two\n\nbreaks, and "q"\n', "", "NA", "café", "x" * 3000 + "\n" + "y" * 3000]
    rows = [[f"b{i}", rng.choice(texts), str(i)] for i in range(6000)]
    for part in range(3):
        with open(tmp_path / f"part-{part}.csv", "w", newline="", encoding=encoding) as f:
            writer = csv.writer(f, lineterminator="\n")
            writer.writerow(["id", "text", "n"])
            writer.writerows(rows[part * 2000 : (part + 1) * 2000])
    spark.conf.set("spark.sql.files.maxPartitionBytes", 32768)
    try:
        read = read_split_csv(spark, str(tmp_path), encoding)
        got = sorted((r[ROW_ID], r["id"], r["text"], r["n"]) for r in read.collect())
        pieces = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert pieces > 3
    missing = {"", "NA"}
    assert got == [(i, r[0], None if r[1] in missing else r[1], r[2]) for i, r in enumerate(rows)]


def test_confusion_counts_rows_with_a_null_label(spark):
    rows = spark.createDataFrame([("a", "a"), (None, "a"), ("a", None), ("b", "a")], "actual string, predicted string")
    matrix = {(r.actual, r.predicted): r["count"] for r in metrics.confusion(rows).collect()}
    assert sum(matrix.values()) == 4 and matrix[None, "a"] == 1 and matrix["a", None] == 1 and len(matrix) == 9
    report = {r.label: (r.tp, r.fp, r.fn) for r in metrics.one_vs_rest(metrics.confusion(rows)).collect()}
    assert report["a"] == (1, 2, 1) and report[None] == (0, 1, 1)


def test_hashed_encoder_equals_a_plain_computation(spark):
    import hashlib
    import math
    import re

    texts = ["Ghost castle ghost", "a b", None, "Été été 12 x_y", "castle of ghosts"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    model = fit_encoder(df, "text", width=16)
    got = {r.id: r.embedding for r in encode_text(model, df, "text").collect()}

    def places(t):
        return [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 16 for w in re.findall(r"[^\W]{2,}", (t or "").lower())]

    df_count = [sum(1 for t in texts if i in places(t)) for i in range(16)]
    for key, t in enumerate(texts):
        w = [places(t).count(i) * math.log(6 / (df_count[i] + 1)) for i in range(16)]
        size = math.sqrt(sum(x * x for x in w))
        want = [x / size if size else 0.0 for x in w]
        assert np.allclose(got[key], want, atol=1e-6), t
    assert got[1] == [0.0] * 16 and got[2] == [0.0] * 16


def test_encoders_hold_the_vectors_of_a_slice(spark):
    import pandas as pd
    import pyarrow as pa

    from catalogrec.operators import encoder

    for rows in (pa.RecordBatch.from_pydict({"a": list(range(2500))}), pd.DataFrame({"a": range(2500)})):
        assert [len(p) for p in encoder._slices(rows)] == [1024, 1024, 452]
        assert [len(p) for p in encoder._slices(rows[:0])] == [0]
    texts = spark.createDataFrame([(i, "a b " * (i % 5) + f"w{i % 3}x") for i in range(2500)], "id int, text string").coalesce(1)
    model = encoder.fit_encoder(texts, "text", 16)
    got = {r.id: r.embedding for r in encoder.encode_text(model, texts, "text").collect()}
    one = {r.id: r.embedding for r in encoder.encode_text(model, texts.where("id >= 2400"), "text").collect()}
    assert len(got) == 2500 and all(got[i] == v for i, v in one.items())
    own = encoder.encode_with(texts, "text", lambda: lambda ts: [[float(len(t))] for t in ts])
    assert all(r.embedding == [float(len(r.text))] for r in own.collect()) and own.count() == 2500


def test_spread_deals_rows_that_lie_in_one_row_group(spark, tmp_path):
    from catalogrec.session import spread

    path = str(tmp_path / "t.parquet")
    spark.range(0, 3_000_000, 1, 1).selectExpr("id", "sha2(cast(id as string), 256) as s").write.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    # Cut by bytes into many partitions, but the rows lie in the few that hold the middle of a row group.
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        df = spark.read.parquet(path)
        assert df.rdd.getNumPartitions() >= cores
        dealt = spread(df, "id")
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 3_000_000 and max(sizes) * cores <= 2 * sum(sizes)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    even = spark.range(0, 100, 1, cores)
    assert spread(even, "id") is even
    assert spread(spark.range(0), "id").count() == 0


def test_keywords_find_the_terms_once(spark):
    from catalogrec.operators.keywords import document_terms, keyword_weights

    rows = [(1, "red red bolt the"), (2, "Red nut_7 \u00e9t\u00e9"), (2, "nut_7 nut_7"), (None, "bolt"), (4, " "), (5, None), (6, "a the")]
    df = spark.createDataFrame(rows, "id long, t string")
    got = sorted((r[0] or 0, r[1], r[2]) for r in document_terms(df, "id", "t", ["the"]).collect())
    assert got == [(0, "bolt", 1), (1, "bolt", 1), (1, "red", 2), (2, "nut_7", 1), (2, "nut_7", 2), (2, "red", 1), (2, "\u00e9t\u00e9", 1)]
    plan = keyword_weights(df, "id", "t", stop_words=["the"])._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan  # counted in neither reader of the terms
