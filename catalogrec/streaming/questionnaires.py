"""Score a stream of questionnaires and keep their history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.similarity import unique_rows
from ..plans.recommend import PREFERENCES_SCHEMA, split_valid
from ..sources.storage import write_batch

Answer = Callable[[DataFrame], DataFrame]


def read_questionnaires(
    spark: SparkSession, path: str, schema: str = PREFERENCES_SCHEMA, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Questionnaires that arrive as JSON files in a folder."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def answer_stream(
    questionnaires: DataFrame,
    answer: Answer,
    output: str,
    checkpoint: str,
    id_col: str = "query_id",
    available_now: bool = True,
) -> StreamingQuery:
    """Answer each micro-batch and append to ``output``.

    Three histories are kept below ``output``: ``preferences``, ``rejected`` and ``results``. A
    batch is written under the stream's id (kept in its checkpoint) and its own number, so a batch
    replayed after a failure replaces its earlier rows, and a new stream adds to the history. Of
    several rows of one batch with the same id the smallest by its columns is answered, so a replay
    answers the same one; an id that comes back in a later batch is a new question.
    """

    def stream_id(spark: SparkSession) -> str:
        return spark.read.json(f"{checkpoint}/metadata").first()["id"]

    def run(batch: DataFrame, batch_id: int) -> None:
        own = f"stream={stream_id(batch.sparkSession)}"
        valid, rejected = split_valid(unique_rows(batch, id_col))
        path = write_batch(valid, f"{output}/preferences/{own}", batch_id)
        write_batch(rejected, f"{output}/rejected/{own}", batch_id)
        # The answers start from the written rows: the batch is not recomputed for them.
        stored = batch.sparkSession.read.schema(valid.schema).json(path)
        write_batch(answer(stored), f"{output}/results/{own}", batch_id)

    writer = questionnaires.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
