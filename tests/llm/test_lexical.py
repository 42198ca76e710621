"""Ranked lexical search: the quadtree's best-first descent against brute force, rows against SQL."""

from __future__ import annotations

import re
import string

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from catalogrec.llm import lexical
from catalogrec.llm.lexical import ImpactTree, rank_documents
from catalogrec.llm.queries import OP12_SQL


def test_tree_top_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n_rows, width = int(rng.integers(1, 40)), int(rng.integers(1, 300))
        cells = {(int(r), int(c)): int(rng.integers(1, 50)) for r, c in zip(rng.integers(0, n_rows, 400), rng.integers(0, width, 400))}
        rows = np.array([r for r, _ in cells]), np.array([c for _, c in cells]), np.array(list(cells.values()))
        tree = ImpactTree(*rows, width)
        for _ in range(5):
            asked = np.unique(rng.integers(0, n_rows + 3, int(rng.integers(1, 6))))
            scores = {}
            for (r, c), v in cells.items():
                if r in set(asked.tolist()):
                    scores[c] = scores.get(c, 0) + v
            want = sorted(((c, s) for c, s in scores.items() if s > 0), key=lambda x: (-x[1], x[0]))[:7]
            assert tree.top(asked, 7) == want


def test_rows_equal_sql_with_odd_rows(spark, tmp_path):
    docs = [(1, "The cat sat on the mat"), (2, "the CAT"), (2, "the CAT"), (3, None), (4, ""), (None, "cat cat dog"),
            (5, "Ünïcode wörds and 漢字 text 42"), (6, "dog " * 500), (7, "a-b_c d'e"), (8, "mat mat mat the")]
    items = [(10, "cat mat"), (11, "dog"), (12, None), (13, "zzz"), (14, "wörds 42 漢字"), (15, "THE the The")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    b = spark.read.parquet(str(tmp_path / "benchmark.parquet"))
    got = sorted(tuple(r) for r in rank_documents(d, b, k=10).collect())
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{tmp_path / name}.parquet'")
    want = sorted(con.execute(OP12_SQL).fetchall())
    assert got == want and len(got) > 5


def test_empty_tables(spark):
    empty_docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rank_documents(empty_docs, items).count() == 0
    assert rank_documents(spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_null_ids_beside_large_ones(spark, tmp_path):
    big = 1 << 60
    docs = [(big + i, f"cat w{i % 7}") for i in range(60)] + [(None, "cat dog")] * 3
    items = [(big + 1, "cat w1"), (big + 2, "dog"), (None, "w3 w4")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = rank_documents(spark.read.parquet(str(tmp_path / "documents.parquet")), spark.read.parquet(str(tmp_path / "benchmark.parquet")))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{tmp_path / name}.parquet/*.parquet'")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, con.execute(OP12_SQL).fetchall()))


def test_items_that_come_in_another_order_at_each_read(spark):
    def shuffled(batches):
        import random

        for batch in batches:
            yield batch.take(random.SystemRandom().sample(range(len(batch)), len(batch)))

    schema = "item_id long, text string"
    items = spark.createDataFrame([(i, f"w{i}") for i in range(40)], schema).coalesce(1).mapInArrow(shuffled, schema)
    docs = spark.createDataFrame([(i, f"w{i} other") for i in range(40)], "doc_id long, text string")
    got = rank_documents(docs, items).collect()
    assert sorted((r.item_id, r.doc_id) for r in got) == [(i, i) for i in range(40)]


WORDS = ["cat", "Dog", "MAT", "sat", "ÜBER", "über", "漢字", "x1", "42", "e"]


def _tables(spark, folder):
    rng = np.random.default_rng(5)
    docs = [(i // 2, " ".join(rng.choice(WORDS, int(rng.integers(0, 30))))) for i in range(400)] + [(None, "cat x1"), (7, None)]
    items = [(i, "-".join(rng.choice([*WORDS, "unknown"], 3))) for i in range(25)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(5).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{folder / name}.parquet/*.parquet'")
    return *(spark.read.parquet(str(folder / f"{name}.parquet")) for name in ("documents", "benchmark")), sorted(map(str, con.execute(OP12_SQL).fetchall()))


def test_shards_meet_their_items_in_many_partitions(spark, tmp_path):
    # An int and a long hash apart: with partitions that are not merged into one, shards missed their items.
    docs, items, want = _tables(spark, tmp_path)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        got = sorted(map(str, map(tuple, rank_documents(docs, items).collect())))
    finally:
        spark.conf.set(key, "true")
    assert got == want and len(want) > 100


@pytest.mark.parametrize("limits", [{"LOOKUP_TERMS": 0}, {"LOOKUP_TERMS": 0, "BROADCAST_TERMS": 0}, {"SHARD_POSTINGS": 100, "ITEMS_PER_TASK": 7}])
def test_rows_equal_sql_by_every_way(spark, tmp_path, monkeypatch, limits):
    docs, items, want = _tables(spark, tmp_path)
    for name, value in limits.items():
        monkeypatch.setattr(lexical, name, value)
    assert sorted(map(str, map(tuple, rank_documents(docs, items).collect()))) == want


def test_every_text_is_read_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs, items, want = _tables(spark, tmp_path)
    got = rank_documents(docs.mapInArrow(counted, docs.schema), items).collect()
    assert sorted(map(str, map(tuple, got))) == want and read.value == 402


@pytest.mark.parametrize("size", [1, 40, 1 << 20])
def test_terms_and_counts_equal_the_pattern(size, monkeypatch):
    monkeypatch.setattr(lexical, "SLICE_BYTES", size)
    rng = np.random.default_rng(8)
    signs = np.array([*map(chr, range(128)), *"äÄßİ漢🙂\u0085\u00a0\u2028", *string.ascii_letters])
    texts = ["", "", "ab", "cd", " ", "", *("".join(rng.choice(signs, int(rng.integers(0, 60)))) for _ in range(200)), ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([*range(len(texts) - 1), None]), pa.array(texts)], names=["row_key", "doc_id", "text"])
    fold = str.maketrans(lexical.UPPER, lexical.LOWER)
    terms = [re.findall(lexical.TERM, t.translate(fold)) for t in texts]
    want = sorted((i, len(ts), t, ts.count(t)) for i, ts in enumerate(terms) for t in set(ts))
    got = pa.Table.from_batches(lexical._count(None)([batch.slice(0, 3), batch.slice(3)])).to_pylist()
    assert [(r["row_key"], r["n"]) for r in got if r["term"] is None] == [(i, len(ts)) for i, ts in enumerate(terms)]
    assert sorted((r["row_key"], r["n"], r["term"], r["tf"]) for r in got if r["term"] is not None) == want
    assert all(r["doc_id"] == (r["row_key"] if r["row_key"] < len(texts) - 1 else None) for r in got)
