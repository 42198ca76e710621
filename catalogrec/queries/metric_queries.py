"""Evaluation tables and generated-text checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics
from ..operators.classify import retained_model
from ..operators.encoder import encode_text, encode_with, fit_encoder
from ..operators.quality import split_suggestions, summary_quality, verify_titles
from ..plans.benchmark import kpi_tables
from . import sql as q
from .tables import table, texts

# 'refund' never occurs: its row and column of the matrix are zeros.
LABELS = ["click", "error", "purchase", "refund", "signup", "view"]


def predictions(spark, d):
    """Event types as truth; low values are predicted as 'click', some purchases as 'view'."""
    guess = (
        F.when(F.col("value") < 5, F.lit("click"))
        .when((F.col("event_type") == "purchase") & (F.col("user_id") % 2 == 0), F.lit("view"))
        .otherwise(F.col("event_type"))
    )
    return table(spark, d, "events").select(F.col("event_type").alias("actual"), guess.alias("predicted"))


MATRIX_SQL = f"""
    p AS (
      SELECT event_type AS actual, CASE WHEN value < 5 THEN 'click'
        WHEN event_type = 'purchase' AND user_id % 2 = 0 THEN 'view' ELSE event_type END AS predicted FROM events),
    lab AS (SELECT unnest({q.listed(LABELS)}) AS label),
    matrix AS (
      SELECT a.label AS actual, b.label AS predicted,
        (SELECT count(*) FROM p WHERE p.actual = a.label AND p.predicted = b.label) AS count
      FROM lab a CROSS JOIN lab b)"""
RATES_SQL = f"""{MATRIX_SQL},
    rates AS (
      SELECT label, CAST(sum(count) FILTER (WHERE actual = label AND predicted = label) AS BIGINT) AS tp,
        CAST(coalesce(sum(count) FILTER (WHERE actual <> label AND predicted = label), 0) AS BIGINT) AS fp,
        CAST(coalesce(sum(count) FILTER (WHERE actual = label AND predicted <> label), 0) AS BIGINT) AS fn,
        CAST(coalesce(sum(count) FILTER (WHERE actual <> label AND predicted <> label), 0) AS BIGINT) AS tn
      FROM lab CROSS JOIN matrix GROUP BY label),
    scores AS (
      SELECT label, tp, coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS precision,
        coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS recall,
        coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f1_score, tp + fn AS support FROM rates),
    total AS (
      SELECT sum(tp) / sum(support)::DOUBLE AS accuracy, sum(precision * support) / sum(support) AS precision_weighted,
        sum(recall * support) / sum(support) AS recall_weighted, sum(f1_score * support) / sum(support) AS f1_weighted,
        CAST(sum(support) AS BIGINT) AS support FROM scores)"""


def _tables(spark, d):
    return kpi_tables(predictions(spark, d), labels=LABELS)


def _report(spark, d):
    rounded = [F.round(c, 6).alias(c) for c in ("precision", "recall", "f1_score")]
    return _tables(spark, d)["class_report"].select("label", *rounded, "support")


def _weighted(spark, d):
    out = metrics.weighted_scores(_tables(spark, d)["one_vs_rest"])
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


def _label_agreement(spark, d):
    """Confusion of the two document labels, label set taken from the rows."""
    return metrics.confusion(table(spark, d, "labels"), "quality", "toxic")


def _retained(spark, d):
    """Best of three fixed rules that predict the event type, by weighted F1."""
    base = predictions(spark, d)
    rules = {
        "rule_a": F.col("predicted"),
        "rule_b": F.col("actual"),
        "rule_c": F.lit("click"),
    }
    rows = [
        metrics.evaluate(base.select("actual", rule.alias("predicted"))).select(F.lit(name).alias("name"), "f1_weighted")
        for name, rule in rules.items()
    ]
    return retained_model(rows[0].unionByName(rows[1]).unionByName(rows[2]))


# --- generated text ----------------------------------------------------------------------------


def _answers(spark, d):
    """Conversation turns that end with one real title, one invented one and a repeat."""
    part = table(spark, d, "part").select(F.col("p_partkey").alias("conv_id"), "p_name")
    turns = table(spark, d, "conversations").join(part, "conv_id", "left").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), "turn", "text", F.coalesce("p_name", F.lit("none")).alias("p_name")
    )
    line = F.concat(
        F.lit("\nLIVRES_SIMILAIRES: "), F.upper("p_name"), F.lit(" | Invented "), F.col("turn").cast("string"),
        F.when(F.col("turn") % 2 == 0, F.concat(F.lit(" | "), F.col("p_name"))).otherwise(F.lit("")),
    )
    raw = F.concat(F.col("text"), F.when(F.col("turn") % 3 != 2, line).otherwise(F.lit("")))
    return turns.select("query_id", "turn", raw.alias("raw_summary"))


def _titles(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("book_id"), F.col("p_name").alias("title"))


def _verification(spark, d):
    return verify_titles(split_suggestions(_answers(spark, d)), _titles(spark, d), "query_id")


_VERIFY_SQL = """WITH a AS (
      SELECT c.conv_id * 1000 + turn AS query_id, turn, coalesce(p_name, 'none') AS p FROM conversations c
      LEFT JOIN part ON conv_id = p_partkey),
    n AS (
      SELECT query_id, CASE WHEN turn % 3 = 2 THEN 0 WHEN turn % 2 = 0 THEN 3 ELSE 2 END AS total,
        CASE WHEN turn % 3 = 2 OR p NOT IN (SELECT p_name FROM part) THEN 0 WHEN turn % 2 = 0 THEN 2 ELSE 1 END AS known FROM a)
    SELECT query_id, CAST(known AS BIGINT) AS titles_verified_count, CAST(total AS BIGINT) AS titles_total_count,
      round_even((1 - known / nullif(total, 0)::DOUBLE) * 100, 1) AS hallucination_rate FROM n"""


def _summary_quality(spark, d):
    """Whole check: suggestions, coherence with a fitted text encoder, invented titles."""
    catalog = _titles(spark, d)
    corpus = table(spark, d, "documents").select(F.col("doc_id").alias("book_id"), F.col("text").alias("text_full"))
    model = fit_encoder(corpus)
    vectors = encode_text(model, corpus, "text_full").select("book_id", "embedding")
    # Each answer's top book is a document spread over all of them by its query id.
    documents = table(spark, d, "documents").select(F.col("doc_id").alias("top_book_id"))
    n_documents = max(1, documents.count())
    answers = _answers(spark, d).withColumn("top_book_id", F.pmod(F.xxhash64("query_id"), F.lit(n_documents)))
    answers = answers.join(documents, "top_book_id")
    out = summary_quality(answers, catalog, vectors, lambda df, c: encode_text(model, df, c))
    return out.select("query_id", "coherence_score", "titles_verified_count", "titles_total_count", "hallucination_rate")


def _embed_text(spark, d):
    docs = texts(spark, d, "documents", "doc_id", "text")
    model = fit_encoder(docs, "text")
    return encode_text(model, docs, "text").select("doc_id", "embedding")


def _embed_custom(spark, d):
    """The encoder slot with a caller's function: two length features per text."""

    def load():
        return lambda texts: [[float(len(t)), float(t.count(" "))] for t in texts]

    docs = texts(spark, d, "documents", "doc_id", "text")
    out = encode_with(docs, "text", load)
    return out.select("doc_id", F.col("embedding")[0].cast("double").alias("n_chars"), F.col("embedding")[1].cast("double").alias("n_spaces"))


QUERIES = {
    "confusion": (lambda s, d: _tables(s, d)["confusion"], f"WITH {MATRIX_SQL} SELECT * FROM matrix"),
    "confusion_pct": (
        lambda s, d: _tables(s, d)["confusion_percent"],
        f"""WITH {MATRIX_SQL} SELECT actual, predicted,
        coalesce(round_even(count / nullif(sum(count) OVER (PARTITION BY actual), 0)::DOUBLE * 100, 1), 0) AS percent FROM matrix""",
    ),
    "tp_fp_fn_tn": (lambda s, d: _tables(s, d)["one_vs_rest"], f"WITH {RATES_SQL} SELECT * FROM rates"),
    "class_report": (
        _report,
        f"""WITH {RATES_SQL}, report AS (
          SELECT label, precision, recall, f1_score, support FROM scores
          UNION ALL SELECT 'accuracy', accuracy, accuracy, accuracy, support FROM total
          UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM scores
          UNION ALL SELECT 'weighted avg', precision_weighted, recall_weighted, f1_weighted, support FROM total)
        SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, support FROM report""",
    ),
    "weighted_scores": (
        _weighted,
        f"""WITH {RATES_SQL} SELECT round(accuracy, 6) AS accuracy, round(precision_weighted, 6) AS precision_weighted,
        round(recall_weighted, 6) AS recall_weighted, round(f1_weighted, 6) AS f1_weighted FROM total""",
    ),
    "label_agreement": (
        _label_agreement,
        """WITH lab AS (SELECT quality AS label FROM labels UNION SELECT toxic FROM labels)
        SELECT a.label AS actual, b.label AS predicted,
          (SELECT count(*) FROM labels WHERE quality = a.label AND toxic = b.label) AS count FROM lab a CROSS JOIN lab b""",
    ),
    "retained_model": (_retained, "SELECT CASE WHEN count(*) > 0 THEN 'rule_b' END AS retained_model FROM events"),
    "title_verification": (_verification, _VERIFY_SQL),
    "summary_quality": (_summary_quality, None),
    "embed_text": (
        _embed_text,
        r"""WITH terms AS (
          SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]{2,}')) AS term FROM documents
        ), counted AS (
          SELECT doc_id, ('0x' || substr(md5(term), 1, 8))::BIGINT % 384 AS i, count(*)::DOUBLE AS tf FROM terms GROUP BY ALL
        ), df AS (SELECT i, count(*) AS df FROM counted GROUP BY i),
        weighted AS (
          SELECT doc_id, i, tf * ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1.0)) AS w FROM counted JOIN df USING (i)
        ), sized AS (SELECT doc_id, sqrt(sum(w * w)) AS z FROM weighted GROUP BY doc_id),
        cells AS (
          SELECT d.doc_id, r.i, coalesce(w.w / nullif(s.z, 0), 0) AS v
          FROM documents d CROSS JOIN range(384) r(i)
          LEFT JOIN weighted w ON w.doc_id = d.doc_id AND w.i = r.i LEFT JOIN sized s ON s.doc_id = d.doc_id
        )
        SELECT doc_id, list(v::FLOAT ORDER BY i) AS embedding FROM cells GROUP BY doc_id""",
    ),
    "embed_custom": (
        _embed_custom,
        """SELECT doc_id, CAST(CAST(length(text) AS FLOAT) AS DOUBLE) AS n_chars,
        CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS n_spaces FROM documents""",
    ),
}
