"""A training corpus from raw documents: five filtering, mixing and encoding stages.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last
return the columns of ``documents``. Models are fitted on labels and languages of the tables.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogrec.llm.bpe import bpe_encode
from catalogrec.llm.common import cut, held_out, may_hold, sieve, table
from catalogrec.llm.jaccard import jaccard_classes
from catalogrec.llm.langid import UNKNOWN, identify_language, language_profiles
from catalogrec.llm.mixing import WORD, mix
from catalogrec.llm.queries import BPE_VOCABULARY
from catalogrec.llm.toxicity import fit_toxicity, score_toxicity
from catalogrec.session import tune

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Toxic from this probability on.
TOXIC = 0.3


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, whatever else the input has."""
    return docs.select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that score as toxic.

    The model learns from the labels that are not held out, on the documents of this stage. Null and
    empty texts are kept.
    """
    tune(spark)
    docs = _documents(docs)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out("doc_id", 4, 2))
    model = fit_toxicity(docs.select("doc_id", "text"), labels, "toxic")
    return score_toxicity(docs, model, keep=COLUMNS, threshold=TOXIC).where("predicted = 0").select(*COLUMNS)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents without a letter, which have no language (``und``), null texts among them.

    A document with a language is kept whichever it is; a null ``lang`` is filled with the prediction.
    """
    tune(spark)
    docs = _documents(docs)
    profiles = language_profiles(docs.where(~held_out("doc_id", 3, 1)))
    known = identify_language(docs, profiles, keep=COLUMNS).where(F.col("lang_pred") != UNKNOWN)
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class: the row of smallest id, a null id last, then of smallest text hash.

    Rows that agree in id and text are one; the smallest of their other columns stay. Rows without words link with
    nothing and are all kept.
    """
    tune(spark)
    docs = _documents(docs)
    wordless = F.coalesce(~F.col("text").rlike(WORD), F.lit(True))
    told = jaccard_classes(docs.where(~wordless).select("doc_id", "text"))
    told = cut(told.select("doc_id", "text_hash", "class_digest", "n_links"), "near-classes")
    # A row without links is alone in its class: only rows that may have links are shuffled.
    linked = sieve(told.where("n_links > 0"), "doc_id", "text_hash")
    rows = docs.withColumn("_hash", F.xxhash64("text")).withColumn("_key", F.col("doc_id").cast("long"))
    rows = may_hold(rows, linked, "_key", "_hash").withColumn("may_hold", F.col("may_hold") & ~wordless).drop("_key")
    chosen = F.min(F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "text_hash")).alias("s")
    kept = told.groupBy("class_digest").agg(chosen).select("s._none", F.coalesce("s.doc_id", F.lit(0)).alias("_id"), F.col("s.text_hash").alias("_hash"))
    some = rows.where("may_hold").withColumn("_none", F.col("doc_id").isNull()).withColumn("_id", F.coalesce("doc_id", F.lit(0)))
    # Joined and grouped by the same keys, the texts are shuffled once.
    key = ["_none", "_id", "_hash"]
    found = some.join(kept, key)
    rest = F.min(F.struct("lang", "source", "n_chars")).alias("s")
    once = found.groupBy(*key, "doc_id", "text").agg(rest).select("doc_id", "text", "s.lang", "s.source", "s.n_chars")
    return once.unionByName(rows.where("not may_hold").select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the sources' words come near their targets.

    A document stands in the result as often as the mix takes its words, rounded: not at all, once or
    twice. Documents without words are taken by no mix and go.
    """
    tune(spark)
    docs = _documents(docs).withColumn("row_key", F.concat_ws(":", "doc_id", F.xxhash64("text")))
    taken = mix(docs, doc_id="row_key").where("taken > 0")
    # Rows equal in id and text, should there be any, share what they got.
    copies = F.round(F.sum("taken") / F.sum("size")).cast("int").alias("copies")
    copies = taken.groupBy(F.col("doc_id").alias("row_key")).agg(copies).where("copies > 0")
    return docs.join(copies, "row_key").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, token_ids) of every document."""
    tune(spark)
    vocabulary = public_tokenizers.path(BPE_VOCABULARY)
    return bpe_encode(_documents(docs), vocabulary, public_tokenizers.PATTERN, keep=["doc_id"], ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("encoding", encode),
]

# Scores of trained models cannot be stated in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what each keeps is written out and read back."""
    tune(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
