"""Personal data: base spans against SQL, EM against known reliabilities, added spans, odd rows."""

from __future__ import annotations

import hashlib
import random

import duckdb
import numpy as np

from catalogrec.llm.pii import PiiModel, base_spans, expectation_maximisation, find_pii, fit_pii, luhn
from catalogrec.llm.queries import BASE_PII_SQL, op11_pii

SCHEMA = "doc_id long, text string, source string"
ODD = [None, "", " ", "a@b", "x@y.z", "+1 (415) 555-2671", "4111 1111 1111 1111", "4111 1111 1111 1112", "999.1.1.1 1.2.3.4",
       "4111111111111111 4111111111111111", "mail: jane (at) example (dot) org", "é😀 a@b.co 😀 +44 20 7946 0958", "1.2.3.4.5.6.7.8",
       "+12 3", "x" * 20000 + " a@b.cd", "00255.0.0.0 256.1.1.1", "version 1.2.3.4"]


def test_base_columns_equal_sql(spark, tmp_path):
    rows = [(i, t, "s") for i, t in enumerate(ODD)] + [(100, ODD[5], "s"), (100, ODD[5], "s"), (None, ODD[6], None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    path = str(tmp_path / "documents.parquet")
    frame.write.parquet(path)
    got = sorted((r["doc_id"] is None, r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"])
                 for r in op11_pii(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}'")
    want = sorted((d is None, d, *rest) for d, *rest, _ in con.execute(BASE_PII_SQL).fetchall())
    assert got == want


def test_base_spans_by_hand():
    assert base_spans("a@b.co and +1 (415) 555-2671") == [("email", 0, 6), ("phone", 11, 28)]
    assert base_spans("4111111111111111 4111111111111111") == []  # one failing match, not retried
    assert base_spans("999.1.1.1") == [] and base_spans("1.2.3.4") == [("ip", 0, 7)]
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_em_recovers_reliabilities():
    rng = np.random.default_rng(0)
    truth = rng.random(20000) < 0.3
    accuracy = np.array([0.95, 0.85, 0.8, 0.7, 0.65])
    votes = np.where(rng.random((20000, 5)) < accuracy, np.where(truth[:, None], 1, -1), np.where(truth[:, None], -1, 1))
    votes[rng.random((20000, 5)) < 0.2] = 0
    post, reliability = expectation_maximisation(votes, np.ones(20000))
    assert np.abs(reliability - accuracy).max() < 0.04
    # The decision with the true reliabilities is right on about 95 % here; EM's must come close.
    a = np.log(accuracy / (1 - accuracy))
    best = ((votes * a).sum(1) + np.log(0.3 / 0.7) > 0) == truth
    assert ((post > 0.5) == truth).mean() > best.mean() - 0.01


def test_method_adds_spans_and_keeps_base(spark):
    rng = random.Random(1)
    filler = ["the", "report", "was", "filed", "on", "time", "and", "then", "sent", "away"]
    rows = []
    for i in range(400):
        words = [rng.choice(filler) for _ in range(30)]
        if i % 4 == 0:
            words.insert(5, f"write to u{i}@mail.example.com")
        if i % 4 == 1:
            words.insert(5, f"call +1 (415) 555-{1000 + i}")
        if i % 4 == 2:
            words.insert(5, f"ref 9{i:03d}-55-1")
        rows.append((i, " ".join(words), "s"))
    rows += [(1000, "contact: jane (at) example (dot) org please", "s"), (1001, "call (415) 555-2671 now", "s"),
             (1002, "cards 4111111111111111 4111111111111111 here", "s"), (1003, "clean text without any of it", "s")]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = fit_pii(docs)
    out = {r["doc_id"]: r for r in find_pii(docs, model, keep=["doc_id", "source"]).collect()}
    assert out[1000]["spans"] == "email:9:36" and out[1000]["n_email"] == 0
    assert out[1001]["spans"] == "phone:5:19"
    assert out[1002]["spans"] == "card:6:22,card:23:39" and out[1002]["n_card"] == 0
    assert out[1003]["spans"] == "" and out[1003]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    for i in range(400):
        base = base_spans(rows[i][1])
        assert out[i]["spans"].startswith(",".join(f"{k}:{s}:{e}" for k, s, e in base))
        assert out[i]["n_added"] == 0


def test_odd_rows_empty_table_and_clashes(spark):
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(ODD)], SCHEMA)
    model = fit_pii(docs)
    assert find_pii(docs, model).count() == len(ODD)
    empty = spark.createDataFrame([], SCHEMA)
    assert find_pii(empty, fit_pii(empty)).count() == 0
    assert isinstance(fit_pii(empty), PiiModel)
    clashing = spark.createDataFrame([(1, "a@b.co", "x")], "doc_id long, text string, spans string")
    try:
        find_pii(clashing, model)
    except ValueError:
        pass
    else:
        raise AssertionError("a kept column named like an output column must be refused")
    assert find_pii(clashing, model, keep=["doc_id"]).collect()[0]["spans"] == "email:0:6"
