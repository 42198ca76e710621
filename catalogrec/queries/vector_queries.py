"""Similarity, ranking and classification over ``embeddings``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.questionnaire import AXIS_LIKERT, LIKERT_COLUMNS, read_keys
from ..functions.vectors import cosine
from ..operators import classify
from ..operators.quality import coherence, title_index
from ..operators.sampling import stratified_split
from ..operators.similarity import nearest
from ..plans.benchmark import benchmark_labels, split_standardized
from ..plans.recommend import axis_profile, build_vectors, rank_books, recommend, session_results, split_valid
from ..session import scratch_path
from ..sources.storage import materialize, read_json_history, read_metrics, write_json
from ..streaming.questionnaires import answer_stream, read_questionnaires
from . import sql as q
from .tables import table

_E = "CAST(embedding AS DOUBLE[])"


def _vectors(spark, d):
    return table(spark, d, "embeddings")


def _centroids(spark, d):
    return classify.centroids(_vectors(spark, d))


# Mean vector per label as CTE ``centroid(label, c)``.
CENTROIDS_SQL = """
    cells AS (
      SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
    centroid AS (
      SELECT label, list(x ORDER BY pos) AS c FROM
        (SELECT label, pos, avg(x) AS x FROM cells GROUP BY label, pos) GROUP BY label)"""


def _cosine(spark, d):
    """Similarity of every vector to the mean vector of its own label."""
    pairs = _vectors(spark, d).join(
        _centroids(spark, d).withColumnRenamed("embedding", "centroid"), "label"
    )
    return pairs.select("vec_id", F.round(cosine("embedding", "centroid"), 6).alias("similarity"))


def _score_order(spark, d):
    """Vectors ordered by similarity to their label's mean, best first."""
    return _cosine(spark, d).orderBy(F.desc("similarity"), "vec_id")


def _topk(spark, d):
    """Five nearest other vectors of every vector."""
    vectors = _vectors(spark, d).withColumn("own", F.array(F.col("vec_id").cast("string")))
    found = nearest(vectors, vectors, 5, "vec_id", "vec_id", left_keys="own", right_keys="own")
    return found.select(
        F.col("left_id").alias("query_id"), F.col("right_id").alias("vec_id"), F.round("similarity", 6).alias("similarity"), "rank"
    )


def _label_questions(spark, d):
    """One question per label: its mean vector, with scores derived from the label."""
    return _centroids(spark, d).select(
        F.col("label").cast("long").alias("query_id"),
        "embedding",
        F.lit("").alias("favorite_books"),
        (F.col("label") % 5 + 1).alias("intensity_action"),
        (F.col("label") % 3 + 1).alias("intensity_romance"),
        (F.col("label") % 4 + 1).alias("intensity_learning"),
        (F.col("label") % 2 + 1).alias("complexity"),
    )


def weighted_topk(spark, d):
    """Flagship: five best vectors for each label's mean vector by weighted score."""
    books = _vectors(spark, d).select(
        F.col("vec_id").alias("book_id"), "embedding", F.array().cast("array<string>").alias("read_keys")
    )
    ranked = rank_books(_label_questions(spark, d), books)
    return ranked.select("query_id", "book_id", "rank", F.round("score", 6).alias("score"), F.round("score_pct", 4).alias("score_pct"))


_WEIGHTED_SQL = f"""WITH {CENTROIDS_SQL},
    scored AS (
      SELECT CAST(k.label AS BIGINT) AS query_id, vec_id AS book_id, round({q.cosine(_E, 'c')}, 9) AS s,
        (k.label % 5 + k.label % 3 + k.label % 4 + k.label % 2 + 4) / 4.0::DOUBLE / 5.0::DOUBLE AS likert
      FROM centroid k CROSS JOIN embeddings e),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, book_id) AS rank FROM scored QUALIFY rank <= 5)
    SELECT query_id, book_id, CAST(rank AS INTEGER) AS rank, round(0.8::DOUBLE * s + 0.2::DOUBLE * likert, 6) AS score,
      round((0.8::DOUBLE * s + 0.2::DOUBLE * likert) * 100, 4) AS score_pct FROM ranked"""


# --- batch recommendation ----------------------------------------------------------------------


def _vector_of(spark, d, key):
    """Vector of a row: the vectors are dealt over all keys in turn."""
    return F.col(key) % _vectors(spark, d).count()


def _catalog(spark, d):
    """A catalogue row per part, labelled by the vector its number falls on."""
    vectors = _vectors(spark, d).select("vec_id", "label")
    part = table(spark, d, "part").withColumn("vec_id", _vector_of(spark, d, "p_partkey")).join(vectors, "vec_id")
    return part.select(
        F.col("p_partkey").alias("book_id"),
        F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")")).alias("title"),
        F.when(F.col("p_size") % 3 != 0, F.concat(F.lit("Author "), F.col("p_size").cast("string"))).otherwise(F.lit("")).alias("authors_clean"),
        F.when(F.col("label") % 4 == 0, F.lit("other")).otherwise(F.lit("fantasy_scifi")).alias("genre_clean"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_size") + F.lit(1900.0)).alias("year"),
        F.lit(None).cast("string").alias("series"),
        F.col("p_type").alias("language"),
        F.col("p_size").cast("double").alias("pages"),
        (F.col("p_size") / 8).alias("rating"),
        F.when(F.col("p_size") % 7 == 0, F.lit("")).otherwise(F.col("p_name")).alias("desc_display"),
    )


def _book_vectors(spark, d):
    titles = _catalog(spark, d).select("book_id", _vector_of(spark, d, "book_id").alias("vec_id"), read_keys("title").alias("read_keys"))
    return titles.join(_vectors(spark, d).select("vec_id", "embedding"), "vec_id").drop("vec_id")


def _preferences(spark, d):
    """One questionnaire per event; its favourite is the part its number falls on."""
    events = table(spark, d, "events").select(F.col("event_id").alias("query_id"), "event_type", "user_id")
    part = table(spark, d, "part")
    events = events.withColumn("p_partkey", F.col("query_id") % part.count())
    return events.join(part.select("p_partkey", "p_name"), "p_partkey").select(
        "query_id",
        F.col("event_type").alias("description"),
        F.col("p_name").alias("favorite_books"),
        F.lit("").alias("avoid"),
        *[(F.col("user_id") % (i + 3)).cast("int").alias(c) for i, c in enumerate(LIKERT_COLUMNS)],
    )


def _lookup_encoder(spark, d):
    """Encoder stand-in: the vector a question's number falls on."""
    vectors = _vectors(spark, d).select("vec_id", "embedding")
    at = _vector_of(spark, d, "query_id")
    return lambda df, _col: df.withColumn("vec_id", at).join(vectors, "vec_id").drop("vec_id")


_SHOWN = ["query_id", "rank", "book_id", "title", "author", "genre", "year", "series", "language", "pages", "rating", "description"]


def _batch_recommend(spark, d):
    found = recommend(_preferences(spark, d), _catalog(spark, d), _book_vectors(spark, d), _lookup_encoder(spark, d))
    return found.select(*_SHOWN, F.round("score", 6).alias("score"))


_LIKERT_SQL = [f"CAST(user_id % {i + 3} AS INTEGER) AS {c}" for i, c in enumerate(LIKERT_COLUMNS)]
RECOMMEND_SQL = f"""
    book AS (
      SELECT p_partkey AS book_id, p_name || ' (' || p_brand || ')' AS title, p_size, p_type, p_name, e.label, vec_id AS v
      FROM part JOIN embeddings e ON p_partkey % (SELECT count(*) FROM embeddings) = vec_id),
    ask AS (
      SELECT event_id AS query_id, p_name AS f, {', '.join(_LIKERT_SQL)}, event_id % (SELECT count(*) FROM embeddings) AS u
      FROM events JOIN part ON event_id % (SELECT count(*) FROM part) = p_partkey),
    alike AS (
      SELECT a.vec_id AS u, b.vec_id AS v, round({q.cosine('CAST(a.embedding AS DOUBLE[])', 'CAST(b.embedding AS DOUBLE[])')}, 9) AS s
      FROM embeddings a CROSS JOIN embeddings b),
    good AS (SELECT * FROM ask WHERE {' AND '.join(f'{c} BETWEEN 1 AND 5' for c in LIKERT_COLUMNS)}),
    pairs AS (
      SELECT query_id, book_id, s,
        ({' + '.join(LIKERT_COLUMNS)}) / 4.0::DOUBLE / 5.0::DOUBLE AS likert
      FROM good CROSS JOIN book JOIN alike USING (u, v)
      WHERE NOT (lower(title) = f OR (starts_with(lower(title), f)
        AND regexp_matches(substr(lower(title), length(f) + 1), '^\\s*[(:,\\-][^\\n]*$')))),
    best AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, book_id) AS rank FROM pairs QUALIFY rank <= 5),
    shown AS (
      SELECT query_id, CAST(rank AS INTEGER) AS rank, b.book_id, title,
        CASE WHEN p_size % 3 <> 0 THEN 'Author ' || p_size ELSE 'N/A' END AS author,
        CASE WHEN label % 4 = 0 THEN 'Genre non classé' ELSE 'Fantasy Scifi' END AS genre,
        CASE WHEN p_size % 2 = 0 THEN CAST(p_size + 1900 AS VARCHAR) ELSE 'N/A' END AS year,
        'N/A' AS series, p_type AS language, CAST(p_size AS VARCHAR) AS pages,
        {q.format_number('(p_size / 8.0::DOUBLE)')} AS rating,
        CASE WHEN p_size % 7 = 0 THEN 'Description non disponible' ELSE p_name END AS description,
        round(0.8::DOUBLE * s + 0.2::DOUBLE * likert, 6) AS score
      FROM best JOIN book b USING (book_id))"""


def _fragmented(spark, d):
    """The same ranking when no side may be broadcast (fragment and replicate)."""
    valid, _ = split_valid(_preferences(spark, d))
    questions = _lookup_encoder(spark, d)(valid, "query_text")
    ranked = rank_books(questions, _book_vectors(spark, d), small_side_bytes=256 * 1024)
    return ranked.select("query_id", "rank", "book_id", F.round("score", 6).alias("score"))


def _session(spark, d):
    valid, _ = split_valid(_preferences(spark, d))
    found = recommend(_preferences(spark, d), _catalog(spark, d), _book_vectors(spark, d), _lookup_encoder(spark, d))
    path = scratch_path(spark, "sessions")
    # A document repeats the display columns of its books: compressed, it costs a fraction of its text.
    write_json(session_results(valid, found.select(*_SHOWN)), path, compression="gzip")
    schema = "query_id long, query_text string, recommendations array<struct<book_id: long>>"
    good, _ = read_json_history(spark, path, schema)
    return good.select(
        "query_id", F.array_join(F.transform("recommendations", lambda r: r["book_id"].cast("string")), ",").alias("books")
    )


def _stream(spark, d):
    """Questionnaires written as JSON files, answered as a stream."""
    folder = scratch_path(spark, "stream")
    write_json(_preferences(spark, d).repartition(4), f"{folder}/in")
    catalog, vectors, encode = _catalog(spark, d), _book_vectors(spark, d), _lookup_encoder(spark, d)
    schema = "query_id long, description string, favorite_books string, avoid string, " + ", ".join(
        f"{c} int" for c in LIKERT_COLUMNS
    )
    query = answer_stream(
        read_questionnaires(spark, f"{folder}/in", schema, max_files_per_trigger=2),
        lambda batch: recommend(batch, catalog, vectors, encode).select("query_id", "rank", "book_id", F.round("score", 6).alias("score")),
        f"{folder}/out",
        f"{folder}/checkpoint",
    )
    query.awaitTermination()
    return read_json_history(spark, f"{folder}/out/results", "query_id long, rank int, book_id long, score double")[0]


def _json_history(spark, d):
    """Questionnaires appended twice to a history, then read back; the copies are counted."""
    path = scratch_path(spark, "history")
    rows = _preferences(spark, d)
    write_json(rows, path)
    write_json(rows, path, append=True)
    # Lines cut short, one per part: each must come back as a broken row, none may vanish.
    cut_short = F.concat(F.lit('{"query_id": '), F.col("p_partkey").cast("string"), F.lit(', "description": "'), F.col("p_name"))
    table(spark, d, "part").select(cut_short.alias("value")).write.mode("append").text(path)
    good, bad = read_json_history(spark, path, "query_id long, description string, favorite_books string")
    counted = good.groupBy("query_id", "description", "favorite_books").agg(F.count(F.lit(1)).alias("n"))
    broken = bad.agg(F.lit(None).cast("long").alias("query_id"), F.lit("broken").alias("description"),
                     F.lit(None).cast("string").alias("favorite_books"), F.count(F.lit(1)).alias("n"))
    return counted.unionByName(broken)


def _stored_vectors(spark, d):
    """Vector table of the catalogue, written once and read again: ids, keys and vector lengths."""
    titles = _catalog(spark, d)
    encode = _lookup_encoder(spark, d)
    path = scratch_path(spark, "book-vectors")

    def encoded(df, column):
        return encode(df.withColumn("query_id", F.col("book_id")), column)

    texts = titles.withColumn("text_full", F.col("title"))
    build_vectors(spark, texts, encoded, path)
    again = build_vectors(spark, texts.limit(0), encoded, path)
    return again.select("book_id", F.size("embedding").cast("long").alias("width"), F.size("read_keys").cast("long").alias("n_keys"))


def _title_index(spark, d):
    """Distinct lookup keys of part names with outer blanks and mixed case."""
    named = table(spark, d, "part").select(F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")).alias("title"))
    return title_index(named)


def _metrics_read(spark, d):
    """A metrics document written as JSON and read back."""
    path = scratch_path(spark, "metrics")
    counts = table(spark, d, "part").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_books"))
    write_json(counts.agg(F.array_sort(F.collect_list(F.struct("p_brand", "n_books"))).alias("brands")), path)
    found = read_metrics(spark, path, "brands array<struct<p_brand: string, n_books: long>>").selectExpr("inline(brands)")
    missing = read_metrics(spark, f"{path}-missing")
    return found.withColumn("other_is_missing", F.lit(missing is None))


# --- axis profile, coherence -------------------------------------------------------------------


def _axis_profile(spark, d):
    """Profile of every vector; the anchors are the mean vectors of four labels."""
    names = F.array(*[F.lit(a) for a in AXIS_LIKERT])
    anchors = _centroids(spark, d).where(F.col("label") < len(AXIS_LIKERT)).select(
        F.get(names, F.col("label")).alias("axis"), "embedding"
    )
    out = _vectors(spark, d).withColumn("p", axis_profile("embedding", anchors))
    return out.select("vec_id", *[F.col(f"p.{a}").alias(a) for a in AXIS_LIKERT])


def _axis_sql() -> str:
    levels = []
    for i, axis in enumerate(AXIS_LIKERT):
        sim = q.cosine(_E, f"(SELECT c FROM centroid WHERE label = {i})")
        levels.append(f"round_even(greatest(0.0::DOUBLE, least(1.0::DOUBLE, ({sim} + 0.1::DOUBLE) / 0.5::DOUBLE)) * 100, 1) AS {axis}")
    return f"WITH {CENTROIDS_SQL} SELECT vec_id, {', '.join(levels)} FROM embeddings"


def _coherence(spark, d):
    pairs = _vectors(spark, d).join(_centroids(spark, d).withColumnRenamed("embedding", "item"), "label")
    return coherence(pairs, "embedding", "item").select("vec_id", "coherence_score")


# --- classification ----------------------------------------------------------------------------


def _standardize(spark, d):
    out = classify.standardize(_vectors(spark, d))
    return out.select("vec_id", F.posexplode("embedding").alias("pos", "x")).select(
        "vec_id", "pos", F.round("x", 4).alias("x")
    )


_SCALED_SQL = """
    raw AS (
      SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
    fit AS (SELECT pos, avg(x) AS m, stddev_pop(x) AS s FROM raw GROUP BY pos),
    z AS (SELECT vec_id, label, pos, (x - m) / CASE WHEN s > 0 THEN s ELSE 1 END AS x FROM raw JOIN fit USING (pos))"""


def _centroid_table(spark, d):
    return _centroids(spark, d).select("label", F.posexplode("embedding").alias("pos", "x")).select(
        "label", "pos", F.round("x", 6).alias("x")
    )


def split_vectors(spark, d):
    """(train, test) of the standardised vectors, written once."""
    data = materialize(
        spark,
        scratch_path(spark, "split-vectors"),
        lambda: split_standardized(_vectors(spark, d), "label", "vec_id"),
    )
    return data.where(~F.col("is_test")), data.where("is_test")


SPLIT_SQL = f"""{_SCALED_SQL},
    part_of AS (
      SELECT vec_id, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id), vec_id)
        <= floor(count(*) OVER (PARTITION BY label) * 0.25 + 0.5) AS is_test FROM embeddings),
    rows AS (
      SELECT vec_id, label, is_test, list(x ORDER BY pos) AS v FROM z JOIN part_of USING (vec_id) GROUP BY ALL),
    profile AS (
      SELECT label, list(x ORDER BY pos) AS c FROM
        (SELECT label, pos, avg(x) AS x FROM z JOIN part_of USING (vec_id) WHERE NOT is_test GROUP BY label, pos)
      GROUP BY label),
    cs AS (
      SELECT r.vec_id, p.label, round({q.cosine('v', 'c')}, 9) AS score FROM rows r CROSS JOIN profile p WHERE r.is_test),
    near AS (
      SELECT t.vec_id, n.label,
        row_number() OVER (PARTITION BY t.vec_id ORDER BY round({q.cosine('t.v', 'n.v')}, 9) DESC, n.vec_id) AS place
      FROM rows t CROSS JOIN rows n WHERE t.is_test AND NOT n.is_test QUALIFY place <= 5),
    votes AS (SELECT vec_id, label, count(*) / 5.0::DOUBLE AS vote FROM near GROUP BY ALL),
    blend AS (
      SELECT vec_id, label, 0.6::DOUBLE * score + 0.4::DOUBLE * coalesce(vote, 0) AS score
      FROM cs LEFT JOIN votes USING (vec_id, label))"""


def _pick_sql(source: str, score: str) -> str:
    return (
        f"SELECT vec_id, label AS predicted FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round({score}, 9) DESC, label) = 1"
    )


def _votes(spark, d):
    train, test = split_vectors(spark, d)
    return classify.knn_votes(test, train, "vec_id")


def _centroid_predict(spark, d):
    train, test = split_vectors(spark, d)
    scores = classify.centroid_scores(test, classify.centroids(train), "vec_id", best=1)
    return classify.centroid_predict(scores, "vec_id")


def _knn_predict(spark, d):
    return classify.knn_predict(_votes(spark, d), "vec_id")


def hybrid(spark, d):
    train, test = split_vectors(spark, d)
    scores = classify.centroid_scores(test, classify.centroids(train), "vec_id")
    return classify.hybrid_predict(scores, classify.knn_votes(test, train, "vec_id"), "vec_id")


def _logreg(spark, d):
    train, test = split_vectors(spark, d)
    names = [r[0] for r in train.select("label").distinct().orderBy("label").collect()]
    model = classify.fit_logistic(train, "label", names)
    return classify.model_predict(model, test, "vec_id", "label", names)


def _forest(spark, d):
    train, test = split_vectors(spark, d)
    names = [r[0] for r in train.select("label").distinct().orderBy("label").collect()]
    model = classify.fit_forest(train, "label", names)
    return classify.model_predict(model, test, "vec_id", "label", names)


def _benchmark(spark, d):
    """Full comparison of the five classifiers over the whole table."""
    tables = benchmark_labels(_vectors(spark, d), support=20)
    return tables["comparison"]


def _benchmark_summary(spark, d):
    """The metrics document written as JSON and read back."""
    path = scratch_path(spark, "kpi")
    summary = benchmark_labels(_vectors(spark, d), support=20, trees=20)["summary"]
    write_json(summary, path)
    return spark.read.schema(summary.schema).json(path).select(
        "n_books_corpus", "n_books_sampled", "n_train", "n_test", "n_genres", F.size("confusion_matrix").alias("n_rows")
    )


_BENCH_SUMMARY_SQL = """
    WITH capped AS (
      SELECT vec_id, label FROM embeddings
      QUALIFY row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id), vec_id) <= 400),
    kept AS (SELECT label, count(*) AS n FROM capped GROUP BY label HAVING count(*) >= 20)
    SELECT (SELECT count(*) FROM embeddings) AS n_books_corpus, CAST(sum(n) AS BIGINT) AS n_books_sampled,
      CAST(sum(n - floor(n * 0.25 + 0.5)) AS BIGINT) AS n_train, CAST(sum(floor(n * 0.25 + 0.5)) AS BIGINT) AS n_test,
      count(*) AS n_genres, CAST(count(*) AS INTEGER) AS n_rows FROM kept"""


QUERIES = {
    "cosine_similarity": (
        _cosine,
        f"WITH {CENTROIDS_SQL} SELECT vec_id, round({q.cosine(_E, 'c')}, 6) AS similarity FROM embeddings JOIN centroid USING (label)",
    ),
    "score_order": (
        _score_order,
        f"""WITH {CENTROIDS_SQL} SELECT vec_id, round({q.cosine(_E, 'c')}, 6) AS similarity
        FROM embeddings JOIN centroid USING (label) ORDER BY similarity DESC, vec_id""",
    ),
    "cosine_topk": (
        _topk,
        f"""WITH v AS (SELECT vec_id, {_E} AS e FROM embeddings),
        s AS (SELECT a.vec_id AS query_id, b.vec_id, round({q.cosine('a.e', 'b.e')}, 9) AS s
          FROM v a JOIN v b ON a.vec_id <> b.vec_id)
        SELECT query_id, vec_id, round(s, 6) AS similarity,
          CAST(row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS INTEGER) AS rank FROM s QUALIFY rank <= 5""",
    ),
    "weighted_topk": (weighted_topk, _WEIGHTED_SQL),
    "batch_recommend": (_batch_recommend, f"WITH {RECOMMEND_SQL} SELECT {', '.join(_SHOWN)}, score FROM shown"),
    "fragmented_recommend": (_fragmented, f"WITH {RECOMMEND_SQL} SELECT query_id, rank, book_id, score FROM shown"),
    "stream_recommend": (_stream, f"WITH {RECOMMEND_SQL} SELECT query_id, rank, book_id, score FROM shown"),
    "session_results": (
        _session,
        f"WITH {RECOMMEND_SQL} SELECT query_id, string_agg(book_id, ',' ORDER BY rank) AS books FROM shown GROUP BY query_id",
    ),
    "json_history": (
        _json_history,
        """SELECT event_id AS query_id, event_type AS description, p_name AS favorite_books, CAST(2 AS BIGINT) AS n
        FROM events JOIN part ON event_id % (SELECT count(*) FROM part) = p_partkey
        UNION ALL SELECT CAST(NULL AS BIGINT), 'broken', CAST(NULL AS VARCHAR), count(*) FROM part""",
    ),
    "stored_vectors": (
        _stored_vectors,
        """SELECT p_partkey AS book_id, len(embedding) AS width, CAST(2 AS BIGINT) AS n_keys
        FROM part JOIN embeddings ON p_partkey % (SELECT count(*) FROM embeddings) = vec_id""",
    ),
    "title_index": (_title_index, "SELECT DISTINCT lower(trim(p_name)) AS title_key FROM part"),
    "metrics_read": (_metrics_read, "SELECT p_brand, count(*) AS n_books, true AS other_is_missing FROM part GROUP BY p_brand"),
    "axis_profile": (_axis_profile, _axis_sql()),
    "coherence": (
        _coherence,
        f"""WITH {CENTROIDS_SQL} SELECT vec_id, round_even({q.cosine(_E, 'c')} * 100, 1) AS coherence_score
        FROM embeddings JOIN centroid USING (label)""",
    ),
    "standardize": (
        _standardize,
        f"WITH {_SCALED_SQL} SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, round(x, 4) + 0.0::DOUBLE AS x FROM z",
    ),
    "centroids": (
        _centroid_table,
        f"""WITH {CENTROIDS_SQL} SELECT label, CAST(pos - 1 AS INTEGER) AS pos, round(avg(x), 6) + 0.0::DOUBLE AS x
        FROM cells GROUP BY label, pos""",
    ),
    "centroid_predict": (_centroid_predict, f"WITH {SPLIT_SQL} {_pick_sql('cs', 'score')}"),
    "knn_predict": (_knn_predict, f"WITH {SPLIT_SQL} {_pick_sql('votes', 'vote')}"),
    "hybrid_predict": (hybrid, f"WITH {SPLIT_SQL} {_pick_sql('blend', 'score')}"),
    "logreg": (_logreg, None),
    "random_forest": (_forest, None),
    "model_comparison": (_benchmark, None),
    "benchmark_summary": (_benchmark_summary, _BENCH_SUMMARY_SQL),
}
