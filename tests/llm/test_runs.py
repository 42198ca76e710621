"""Periodic runs against a brute-force enumeration of every period and stretch."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np

from catalogrec.llm.runs import CoverLCE, describe_runs, detect_runs, difference_cover, find_runs, plant

SCHEMA = "doc_id long, text string, lang string"


def brute_runs(words, min_length=12):
    n, best = len(words), {}
    for p in range(1, n // 2 + 1):
        x = 0
        while x < n - p:
            if words[x] != words[x + p]:
                x += 1
                continue
            y = x
            while y < n - p and words[y] == words[y + p]:
                y += 1
            if y + p - x >= max(min_length, 2 * p) and best.get((x, y + p - x), p + 1) > p:
                best[x, y + p - x] = p
            x = y
    return sorted(((s, ln, q) for (s, ln), q in best.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    spaced = (text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ")
    words = plant(doc_id, [w for w in spaced.split(" ") if w])
    runs = brute_runs(words)
    dropped = {i for s, ln, q in runs for i in range(s + q, s + ln)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    return {
        "n_runs": len(runs),
        "start": best and best[0],
        "length": best and best[1],
        "period": best and best[2],
        "exponent_milli": best and 1000 * best[1] // best[2],
        "runs_sha256": hashlib.sha256("".join(f"{s},{ln},{q}\n" for s, ln, q in runs).encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    }


def test_cover_and_extensions_against_a_plain_loop():
    for v in (3, 7, 13):
        cover = set(difference_cover(v).tolist())
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(2, 90)
        w = [rng.randrange(rng.choice([1, 2, 4])) for _ in range(n)]
        lce = CoverLCE(np.array(w))
        i, j = np.array([rng.randrange(n) for _ in range(40)]), np.array([rng.randrange(n) for _ in range(40)])
        i, j = i[i != j], j[i != j]
        plain = []
        for a, b in zip(i, j):
            t = 0
            while max(a, b) + t < n and w[a + t] == w[b + t]:
                t += 1
            plain.append(t)
        assert lce.extend(i, j).tolist() == plain


def test_runs_equal_brute_force_on_random_and_planted_words():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(0, 150)
        w = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(n)]
        if n > 5 and rng.random() < 0.6:
            a, p = rng.randrange(n), rng.randint(1, 9)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        assert find_runs(np.array(w, dtype=np.int64)) == brute_runs(w)


def test_rows_with_odd_texts_ties_repeats_and_planting(spark):
    planted = [d for d in range(2000) if zlib.crc32(str(d).encode()) % 10 == 0][:3]
    long_text = " ".join(random.Random(2).choice(["a", "b", "the", "x"]) for _ in range(6000))
    texts = [None, "", "  \t\n ", "a", "a " * 30, "x y " * 20 + "z " + "x y " * 20, "w1 w2 w3\x0bw1 w2 w3 " * 8, "é ö 漢 " * 9, long_text,
             " ".join(f"w{i}" for i in range(40)), "a b a b " * 10]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(d, " ".join(f"t{i % 7}" for i in range(60)), "en") for d in planted]
    rows += [(d, " ".join(f"u{i}" for i in range(80)), "en") for d in planted] + [(None, "q " * 20, None), (5, texts[5], None)]
    out = detect_runs(spark.createDataFrame(rows, SCHEMA), keep=["doc_id", "lang"]).collect()
    assert len(out) == len(rows)
    for row, (doc_id, text, _) in zip(sorted(out, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_words"])), sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, len((r[1] or "").split())))):
        want = brute_row(doc_id, text)
        assert {k: row[k] for k in want} == want, (doc_id, text)
    empty = describe_runs(1, None)
    assert empty["n_runs"] == 0 and empty["start"] is None and empty["collapsed_sha256"] == hashlib.sha256(b"").hexdigest()


def test_empty_table_and_clashing_columns(spark):
    assert detect_runs(spark.createDataFrame([], SCHEMA)).count() == 0
    try:
        detect_runs(spark.createDataFrame([(1, "a", "n")], "doc_id long, text string, n_runs string"))
    except ValueError:
        pass
    else:
        raise AssertionError("a kept column named like an output column must be refused")
    renamed = detect_runs(spark.createDataFrame([(1, "a", "n")], "doc_id long, text string, n_runs string"), keep=["doc_id"])
    assert renamed.collect()[0]["n_runs"] == 0
