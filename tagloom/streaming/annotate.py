"""Annotate an unbounded stream of JSON messages.

A tagger orders tokens by row number, which a streaming plan does not offer, so
each micro-batch runs the batch job inside ``foreachBatch``. Output is written
to a folder named after the batch: a batch that runs again after a failure
overwrites its own folder, so every message is delivered once. Between queues,
:func:`annotate_queue` answers each record once and then deletes it.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from tagloom.constants import CONTENT_COLUMN, POLL_SECONDS
from tagloom.plans.training import Tagger, annotate_records
from tagloom.sources import message_queue as mq
from tagloom.streaming.delivery import DELAY, deliver_once

Sink = Callable[[DataFrame, int], None]


def read_messages(
    spark: SparkSession, schema: T.StructType | str, path: str | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """A stream of JSON files under ``path``, or of Kafka values with ``options`` for that connector."""
    if path is not None:
        return spark.readStream.schema(schema).json(path)
    raw = spark.readStream.format("kafka").options(**(options or {})).load()
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")


def folder_sink(path: str) -> Sink:
    def write(lines: DataFrame, batch_id: int) -> None:
        lines.write.mode("overwrite").text(f"{path}/batch={batch_id}")

    return write


def kafka_sink(options: Mapping[str, str]) -> Sink:
    """Delivery to Kafka is at least once."""

    def write(lines: DataFrame, batch_id: int) -> None:  # noqa: ARG001 - every sink takes the batch number
        lines.write.format("kafka").options(**options).save()

    return write


def annotate_stream(
    messages: DataFrame,
    tagger: Tagger,
    sink: Sink,
    checkpoint: str,
    col: str = CONTENT_COLUMN,
    remap: DataFrame | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Start tagging ``messages``; with several models in ``tagger`` their votes decide.

    ``available_now`` works off what is there and stops.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            sink(annotate_records(batch, tagger, col, remap), batch_id)
        finally:
            batch.unpersist()

    writer = messages.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{POLL_SECONDS} seconds"}
    return writer.trigger(**trigger).start()


def queue_answer(
    tagger: Tagger, schema: T.StructType | str, col: str = CONTENT_COLUMN, remap: DataFrame | None = None
) -> Callable[[DataFrame], DataFrame]:
    """Turn (message_id, body) into (message_id, value), the record of the body with its entities.

    A body that is no JSON record, or has no content, comes back as an empty record, so nothing is lost without a trace.
    """

    def answer(batch: DataFrame) -> DataFrame:
        record = F.from_json("body", schema).alias("r")
        records = batch.select(F.col("message_id").alias("_message_id"), record).select("_message_id", "r.*")
        lines = annotate_records(records, tagger, col, remap, keep=["_message_id"])
        return lines.withColumnRenamed("_message_id", "message_id")

    return answer


def annotate_queue(
    spark: SparkSession,
    in_queue: str,
    out_queue: str,
    tagger: Tagger,
    schema: T.StructType | str,
    checkpoint: str,
    col: str = CONTENT_COLUMN,
    remap: DataFrame | None = None,
    delay: str | None = DELAY,
    available_now: bool = False,
    poll_seconds: float = POLL_SECONDS,
    files_per_batch: int = mq.FILES_PER_BATCH,
) -> StreamingQuery:
    """Receive messages, answer each once, then delete it; with several models in ``tagger`` their votes decide."""
    # with availableNow Spark asks a source once how far to go, so it must take all at once
    messages = mq.receive(spark, in_queue, 0 if available_now else poll_seconds, sys.maxsize if available_now else files_per_batch)
    answer = queue_answer(tagger, schema, col, remap)
    return deliver_once(
        messages, answer, out_queue, checkpoint, delay=delay, available_now=available_now, poll_seconds=poll_seconds
    )


def annotate_file(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    tagger: Tagger,
    col: str = CONTENT_COLUMN,
    remap: DataFrame | None = None,
) -> DataFrame:
    """(value): the same job over files of JSON lines."""
    return annotate_records(spark.read.schema(schema).json(path), tagger, col, remap)
