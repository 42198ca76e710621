"""The stages of the corpus pipeline against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.test_texts import brute_classes

tokenizers = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    syllables = ["ta", "ri", "mo", "ne", "lu", "sa", "ke", "po"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(3))
    rows, labels = [], []
    for i in range(240):
        words = [word() for _ in range(rng.randint(20, 60))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(6):
                words[rng.randrange(len(words))] = rng.choice(["vileone", "vilest", "nasty"])
        rows.append((i, " ".join(words), "xx", rng.choice(["a", "b", None]), 0, "s"))
        labels.append((i, int(toxic)))
    for i in range(240, 300):  # copies and near copies of clean texts
        words = rows[rng.choice([1, 2, 3, 4, 5])][1].split()
        for _ in range(rng.randint(0, 1)):
            words[-1] = word()
        rows.append((i, " ".join(words), "xx", "a", 0, "s"))
    rows += [(300, None, None, None, None, "s"), (301, "", "xx", "a", 0, "s"), (302, "12 34 !!", "xx", "a", 0, "s"), (303, "once", None, None, 4, "s")]
    rows += [(304, rows[1][1], "xx", "b", 1, "s"), (304, "a second text of this id here", "xx", "b", 2, "s"), (304, "a second text of this id here", "xx", "b", 2, "s")]
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows


def stage(spark, name, docs, folder):
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, folder)
    if name != "encoding":
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    return out


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "mixing", "encoding"]


def test_toxic_documents_go(spark, corpus):
    folder, rows = corpus
    kept = stage(spark, "toxicity", spark.read.parquet(f"{folder}/documents.parquet"), folder)
    want = Counter(r[0] for r in rows if not (r[0] < 240 and r[0] % 6 == 0))
    assert Counter(r["doc_id"] for r in kept.collect()) == want


def test_documents_without_language_go(spark, corpus):
    folder, rows = corpus
    kept = stage(spark, "language", spark.read.parquet(f"{folder}/documents.parquet"), folder).collect()
    assert Counter(r["doc_id"] for r in kept) == Counter(r[0] for r in rows if r[1] and any(c.isalpha() for c in r[1]))
    assert all(r["lang"] == "xx" for r in kept)


def test_one_document_of_each_class_stays(spark, corpus):
    folder, rows = corpus
    single = [r for r in rows if r[0] != 304]
    docs = spark.createDataFrame(single, SCHEMA)
    kept = sorted(r["doc_id"] for r in stage(spark, "near_duplicates", docs, folder).collect())
    classes = brute_classes([(r[0], r[1]) for r in single])
    assert kept == sorted(i for i, (n, c) in classes.items() if n == 0 or c == i)
    # Of repeated ids one row per class stays, the copy of a smaller id goes.
    again = stage(spark, "near_duplicates", spark.createDataFrame([r for r in rows if r[0] in (1, 304)], SCHEMA), folder)
    assert sorted((r["doc_id"], r["n_chars"]) for r in again.collect()) == [(1, 0), (304, 2)]


def test_texts_without_links_are_not_shuffled(spark, monkeypatch):
    """Only rows that may be linked reach the exchange of the near-duplicate stage; their class keeps its smallest id."""
    sieved = []
    monkeypatch.setattr(corpus_pipeline, "may_hold", lambda *a, f=corpus_pipeline.may_hold: sieved.append(f(*a)) or sieved[-1])
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(20)), "xx", "a", i, "s") for i in range(300)]
    rows += [(i, rows[0][1], "xx", "b", i, "s") for i in (300, 300, None)]
    rows += [(None, " - ", None, None, None, "s")]
    kept = stage(spark, "near_duplicates", spark.createDataFrame(rows, SCHEMA), "").collect()
    assert Counter((r["doc_id"], r["n_chars"]) for r in kept) == Counter([(r[0], r[4]) for r in rows[:300]] + [(None, None)])
    assert sieved[0].where("may_hold").count() < 10


def test_mixing_repeats_and_drops(spark, corpus):
    folder, rows = corpus
    docs = [r for r in rows if r[0] < 240]
    mixed = Counter(r["doc_id"] for r in stage(spark, "mixing", spark.createDataFrame(docs, SCHEMA), folder).collect())
    size = {r[0]: len((r[1] or "").split()) for r in docs}
    assert max(mixed.values()) <= 2
    taken = Counter()
    for i, n in mixed.items():
        taken[docs[i][3]] += n * size[i]
    total = sum(size.values())
    # a, b and null weigh 3, 1, 2; no source stops at twice its size here unless its share says so.
    own = Counter()
    for r in docs:
        own[r[3]] += size[r[0]]
    limit = {s: 2 * n for s, n in own.items()}
    weight, target, left = {"a": 3, "b": 1, None: 2}, {}, 1.5 * total
    open_sources = set(own)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_sources) for s in open_sources}
        over = {s for s in open_sources if share[s] > limit[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = limit[s]
            left -= limit[s]
        open_sources -= over
    assert all(abs(taken[s] - target[s]) <= 60 * 3 for s in own)


def test_run_encodes_what_is_left(spark, corpus):
    import base64

    import tiktoken

    folder, _ = corpus
    out = corpus_pipeline.run(spark, folder).collect()
    path = tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert out and not any(r["doc_id"] < 240 and r["doc_id"] % 6 == 0 for r in out)
    for r in out[:50]:
        text = library.decode_bytes(r["token_ids"])
        assert library.encode_ordinary(text.decode()) == r["token_ids"]
        assert hashlib.sha256(text).hexdigest() == r["decoded_sha256"] and len(r["token_ids"]) == r["n_tokens"]


def test_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
