"""Queries that run a stream to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.plans import inputs as inp
from tagloom.plans.registry import query
from tagloom.session import work_folder
from tagloom.sources import message_queue as mq
from tagloom.streaming.delivery import deliver_once as deliver


@query("deliver_once", """
SELECT conv_id || ':' || turn AS message_id, coalesce(role, '') || ': ' || coalesce(text, '') AS value FROM conversations
""")
def deliver_once(spark, d) -> DataFrame:
    """Every turn comes twice, in another order, and is answered once."""
    folder = work_folder(spark, "queues")
    record = F.to_json(F.struct("role", "text"))
    turns = inp.conversations(spark, d).select(F.concat_ws(":", "conv_id", "turn").alias("id"), record.alias("body"))
    again = turns.repartition(16, F.xxhash64("body")).sortWithinPartitions(F.xxhash64("id"))
    for messages in (turns, again):
        mq.send(messages, f"{folder}/in", "id", "body")

    def answer(batch: DataFrame) -> DataFrame:
        r = F.from_json("body", "role STRING, text STRING")
        value = F.concat(F.coalesce(r["role"], F.lit("")), F.lit(": "), F.coalesce(r["text"], F.lit("")))
        return batch.select("message_id", value.alias("value"))

    stream = mq.receive(spark, f"{folder}/in", wait=0, files_per_batch=8)
    stream = deliver(stream, answer, f"{folder}/out", f"{folder}/state", poll_seconds=0)
    try:
        stream.processAllAvailable()
    finally:
        stream.stop()
    return mq.waiting(spark, f"{folder}/out").withColumnRenamed("body", "value")
