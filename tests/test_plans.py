"""Whole jobs: catalogue build from CSV, recommendation, histories, stream."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from catalogrec.functions.questionnaire import LIKERT_COLUMNS
from catalogrec.plans.catalog import build_catalog, leak_free_text
from catalogrec.plans.profile import profile
from catalogrec.plans.recommend import (
    PREFERENCES_SCHEMA,
    axis_anchors,
    build_vectors,
    default_encoder,
    exclude_read,
    recommend,
    session_results,
    split_valid,
)
from catalogrec.operators.statistics import corpus_statistics
from catalogrec.sources.storage import read_json_history, read_metrics, write_json
from catalogrec.streaming.questionnaires import answer_stream, read_questionnaires


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    (folder / "1.csv").write_bytes(
        "Title,Book_Description,Stars,Category\n"
        'Dune,"Sand, worms and ""spice""\non a desert planet",5,Science Fiction\n'
        "Café,Short story of a café,n/a,Fiction\n".encode("latin-1")
    )
    (folder / "2.csv").write_text(
        "Title,Authors,Description,Publish Date (Year),Category\n"
        'DUNE,"By Herbert, Frank",Desert planet,1965,"Fiction , Epic"\n'
        'Twilight,"By Meyer, Stephenie",Vampires and love in a small town,2005,"Young Adult Fiction , Romance"\n'
        "NA,X,A text without title,2000,Fiction\n"
        "Empty,Y,,2000,Fiction\n",
        encoding="utf-8",
    )
    (folder / "3.csv").write_text(
        "title,author,description,series,language,pages,rating,genres,firstPublishDate,publishDate\n"
        "Twilight (Saga #1),Stephenie Meyer (Author),Vampires in love,Saga,English,498 pages,3.6,\"['Young Adult', 'Fantasy']\",,09/14/2005\n"
        "Ghosts,Jo Doe,A haunted castle with ghosts,,French,120 pages,4.0,['Horror'],October 1899,2010\n",
        encoding="utf-8",
    )
    path = str(folder / "catalog")
    build = lambda **o: build_catalog(
        spark, str(folder / "1.csv"), str(folder / "2.csv"), str(folder / "3.csv"), path, stop_words=["and", "in", "of", "the"], **o
    )
    first = build()
    assert build().count() == first.count()  # reused
    return first


def test_materialize_reuses_by_content(spark, tmp_path):
    from catalogrec.sources.storage import materialize

    source = tmp_path / "in.csv"
    source.write_text("a\n1\n")
    built = []

    def build():
        built.append(1)
        return spark.read.option("header", True).csv(str(source))

    table = str(tmp_path / "table")
    assert materialize(spark, table, build, inputs=[str(source)], params={"k": 1}).count() == 1
    assert materialize(spark, table, build, inputs=[str(source)], params={"k": 1}).count() == 1
    assert len(built) == 1  # same files, same parameters: reused
    source.write_text("a\n1\n2\n")  # another content at the same path
    assert materialize(spark, table, build, inputs=[str(source)], params={"k": 1}).count() == 2
    materialize(spark, table, build, inputs=[str(source)], params={"k": 2})
    assert len(built) == 3


def test_catalog(catalog):
    rows = {r.title: r for r in catalog.collect()}
    assert set(rows) == {"Dune", "Café", "Twilight", "Twilight (Saga #1)", "Ghosts"}
    dune = rows["Dune"]
    assert (dune.year, dune.authors_clean, dune.genre_clean, dune.period) == (1965.0, "Herbert, Frank", "fantasy_scifi", "1960s")
    assert dune.desc_clean == 'sand, worms and "spice" on a desert planet'
    assert rows["Café"].rating is None and rows["Ghosts"].period == "Avant 1900"
    assert rows["Twilight (Saga #1)"].year == 2005.0 and rows["Twilight (Saga #1)"].genre_clean == "young_adult"
    assert rows["Ghosts"].text_full == "ghosts. horror. a haunted castle with ghosts"
    assert len(rows["Ghosts"].keywords.split(", ")) == 4
    text = catalog.where("title = 'Ghosts'").select(leak_free_text()).first()[0]
    assert text == "ghosts a haunted castle with ghosts"


def test_statistics_and_profile(catalog):
    stats = {(r.metric, r.key): r.value for r in corpus_statistics(catalog).collect()}
    assert stats["total_books", None] == 5 and stats["unique_genres", None] == 4
    assert stats["missing_authors", None] == 1 and stats["language_distribution", "French"] == 1
    tables = profile(catalog.select("title", "language", "year"), ["language"])
    nulls = {r.column: r.n_null for r in tables["nulls"].collect()}
    assert nulls == {"title": 0, "language": 3, "year": 1}


@pytest.fixture(scope="module")
def engine(spark, catalog, tmp_path_factory):
    encode = default_encoder(catalog)
    vectors = build_vectors(spark, catalog, encode, str(tmp_path_factory.mktemp("vec") / "v"))
    return encode, vectors


def questionnaires(spark, rows):
    return spark.createDataFrame([(*r, None) for r in rows], PREFERENCES_SCHEMA)


ASKED = [
    (1, "haunted castle ghosts", "", "", 1, 1, 1, 1),
    (2, "vampires in love", "twilight", "gore", 2, 5, 2, 3),
    (3, "bad score", "", "", 9, 1, 1, 1),
]


def test_recommend(spark, catalog, engine):
    encode, vectors = engine
    found = recommend(questionnaires(spark, ASKED), catalog, vectors, encode, k=3, anchors=axis_anchors(spark, encode))
    rows = {(r.query_id, r["rank"]): r for r in found.collect()}
    assert set(rows) == {(q, r) for q in (1, 2) for r in (1, 2, 3)}
    assert rows[1, 1].title == "Ghosts" and rows[1, 1].genre == "Horror" and rows[1, 1].pages == "120"
    assert all(not r.title.startswith("Twilight") for (q, _), r in rows.items() if q == 2)
    best = rows[1, 1]
    assert best.score == pytest.approx(0.8 * best.similarity + 0.2 * 0.2) and best.score_pct == pytest.approx(best.score * 100)
    assert set(best.axis_profile.asDict()) == {"action", "romance", "learning", "complexity"}
    assert exclude_read(catalog, "Twilight").count() == 3 and exclude_read(catalog, " ").count() == 5


def test_session_documents(spark, catalog, engine, tmp_path):
    encode, vectors = engine
    asked = questionnaires(spark, ASKED)
    found = recommend(asked, catalog, vectors, encode, k=2)
    quality = spark.createDataFrame([(1, "ok", 80.0)], "query_id long, summary string, coherence_score double")
    write_json(session_results(split_valid(asked)[0], found, quality), str(tmp_path / "s"))
    docs = {r.query_id: r for r in spark.read.json(str(tmp_path / "s")).collect()}
    assert [b["rank"] for b in docs[1].recommendations] == [1, 2]
    assert docs[1].genai_quality.coherence_score == 80.0 and docs[2].summary is None
    assert docs[2].user_profile.romance == 100.0


def test_json_history(spark, tmp_path):
    path = str(tmp_path / "h")
    good, bad = read_json_history(spark, path, "a int")
    assert good.count() == bad.count() == 0
    df = spark.createDataFrame([(1,)], "a int")
    write_json(df, path)
    write_json(df, path, append=True)
    (tmp_path / "h" / "broken.json").write_text("{oops\n")
    good, bad = read_json_history(spark, path, "a int")
    assert good.count() == 2 and bad.count() == 1
    write_json(df, path)
    assert read_json_history(spark, path, "a int")[0].count() == 1
    assert read_metrics(spark, str(tmp_path / "none.json")) is None
    (tmp_path / "m.json").write_text(json.dumps({"accuracy": 0.5}, indent=2))
    assert read_metrics(spark, str(tmp_path / "m.json")).first().accuracy == 0.5


def test_json_history_of_mixed_files_loses_no_row(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.json").write_text('{"a":1}\n[broken\n{"a":2}\n\n')  # a line file stays one
    (folder / "b.json").write_text('[\n {"a":3},\n {"a":4}, 5\n]\ntrailing junk\n')
    (folder / "c.json").write_text('{\n "a": 6\n}\n')
    (folder / "d.json").write_text('{\n "a": 7,\n')
    (folder / "e.json").write_text("\n\n")
    good, bad = read_json_history(spark, str(folder), "a int")
    assert sorted(r.a for r in good.collect()) == [1, 2, 3, 4, 6]
    broken = sorted((r["_corrupt_record"], r.file.rsplit("/", 1)[-1], r.position) for r in bad.collect())
    assert broken == [("\ntrailing junk", "b.json", 25), ("5", "b.json", 0), ("[broken", "a.json", None), ('{\n "a": 7,', "d.json", 0)]


def test_stream_matches_batch_and_survives_replay(spark, catalog, engine, tmp_path):
    encode, vectors = engine
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    questionnaires(spark, ASKED).coalesce(1).write.json(source)
    answer = lambda batch: recommend(batch, catalog, vectors, encode, k=2).select("query_id", "rank", "book_id")

    def run(checkpoint):
        answer_stream(read_questionnaires(spark, source), answer, out, str(tmp_path / checkpoint)).awaitTermination()
        rows = spark.read.json(f"{out}/results").select("query_id", "rank", "book_id")
        return sorted(map(tuple, rows.collect()))

    batch = sorted(map(tuple, answer(questionnaires(spark, ASKED)).collect()))
    assert run("c1") == batch
    # The batch was written but its commit was lost: it is replayed and replaced, not doubled.
    (tmp_path / "c1" / "commits" / "0").unlink()
    (tmp_path / "c1" / "commits" / ".0.crc").unlink()
    assert run("c1") == batch
    rejected = spark.read.json(f"{out}/rejected")
    assert [r.query_id for r in rejected.collect()] == [3]
    assert spark.read.json(f"{out}/preferences").where(F.col(LIKERT_COLUMNS[0]) > 5).count() == 0
    assert run("c2") == sorted(batch * 2)  # another stream adds to the history


def test_history_of_lists_and_indented_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1}\n{"a": 2}\nbroken\n')
    (tmp_path / "b.json").write_text('[\n  {"a": 3},\n  {"a": 4}\n]\n')
    (tmp_path / "c.json").write_text('{\n  "a": 5\n}\n')
    (tmp_path / "d.json").write_text('[{"a": 6}, {"a":')
    (tmp_path / "e.json").write_text('[{"a": 7}]')
    good, corrupt = read_json_history(spark, str(tmp_path), "a long")
    assert sorted(r["a"] for r in good.collect()) == [1, 2, 3, 4, 5, 7]
    assert sorted(r[0] for r in corrupt.collect()) == ['[{"a": 6}, {"a":', "broken"]


def test_already_read_compares_no_pairs_of_single_ids(spark):
    from catalogrec.plans.recommend import already_read

    titles = [(1, "Dune: Part (One)"), (1, "Dune: Part (One)"), (2, "Dune"), (2, "Emma - A Novel"), (None, "Emma"), (None, "Dune, again"), (3, None)]
    books = spark.createDataFrame(titles, "book_id long, title string")
    asked = spark.createDataFrame([(7, "dune, Dune: Part"), (7, "Emma"), (8, "emma"), (None, "DUNE")], "query_id long, favorite_books string")
    got = already_read(books, asked)
    want = {(7, 1), (None, 1), (7, 2), (8, 2), (None, 2), (7, None), (8, None), (None, None)}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert got._jdf.queryExecution().optimizedPlan().toString().lstrip().startswith("Union")


def test_history_lines_are_not_shuffled(spark, tmp_path):
    from catalogrec.sources.storage import read_json_history, write_json

    path = str(tmp_path / "history")
    write_json(spark.range(50).repartition(3), path, compression="gzip")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        good, bad = read_json_history(spark, path, "id long")
        assert "SortMergeJoin" not in good._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.id for r in good.collect()) == list(range(50)) and bad.count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
