"""Each record of a stream answered once, however often and in whatever order it arrives.

Two things make it so:

* *Keyed state.* The stream drops a record whose id it has seen inside the watermark, before any work is done on it. The
  watermark follows the time of arrival, so a record is never late, whatever time it carries.
* *A ledger.* The output of a batch and the table of ids it answers are committed by one small file in the output queue (see
  :mod:`tagloom.sources.message_queue`). A batch that runs again after a failure finds its entry and sends nothing. A record that
  comes back later than the watermark, or to a query whose state was lost, is found in the tables of ids and left out. Now and
  then the tables become one, without ids older than ``keep`` days, so the ledger stays small.

What fails in between is harmless: ids and segments without an entry are never read, and an entry's segments are moved to where
consumers see them by whoever comes next.

Defined cases: of rows with one id in a batch, any one is taken; rows with a null id are no copies of each other and each
answered; an empty batch commits an empty entry.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tagloom.constants import POLL_SECONDS
from tagloom.sources import message_queue as mq

Answer = Callable[[DataFrame], DataFrame]
DELAY = "1 day"
KEEP_DAYS = 30
COMPACT_ENTRIES = 100
_IDS = "id string, at timestamp"
_STATE_KEY, _ARRIVAL = "_state_key", "_arrival"


def unseen(messages: DataFrame, id_col: str, delay: str = DELAY) -> DataFrame:
    """The stream without records whose id came before, up to ``delay`` behind the time of arrival."""
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("\x00"), F.uuid()))
    marked = messages.withColumns({_ARRIVAL: F.current_timestamp(), _STATE_KEY: key})
    return marked.withWatermark(_ARRIVAL, delay).dropDuplicatesWithinWatermark([_STATE_KEY]).drop(_STATE_KEY, _ARRIVAL)


class Ledger:
    """What a writer, by name, has committed to a queue."""

    def __init__(self, path: str, writer: str) -> None:
        self.path, self.writer, self.folder = path, writer, mq.Folder(path)

    def entry(self, run: str, batch_id: int) -> str:
        """The name of a batch's entry; a query keeps its ``run`` when it starts again from its checkpoint."""
        return f"{self.writer}/{batch_id:020d}-{run}"

    def entries(self) -> list[str]:
        return [f"{self.writer}/{name.removesuffix('.json')}" for name in self.folder.names(f"ledger/{self.writer}")]

    def recover(self) -> None:
        """Finish what a failure left between commit and move."""
        for entry in self.entries():
            mq.publish(self.folder, entry)

    def _read(self) -> dict[str, dict]:
        """Entries that no other one replaces, with their content."""
        found = {e: json.loads(self.folder.read(f"ledger/{e}.json")) for e in self.entries()}
        gone = {r for content in found.values() for r in content.get("replaces", [])}
        return {e: content for e, content in found.items() if e not in gone}

    def _answered(self, spark: SparkSession, entries: dict[str, dict]) -> DataFrame:
        tables = [f"{self.path}/answered/{name}" for content in entries.values() for name in content["ids"]]
        return spark.read.schema(_IDS).parquet(*tables) if tables else spark.createDataFrame([], _IDS)

    def answered(self, spark: SparkSession) -> DataFrame:
        """``id, at`` of all answered records that are remembered."""
        return self._answered(spark, self._read())

    def fresh(self, batch: DataFrame, id_col: str) -> DataFrame:
        """One row of each id that was not answered, and all rows without an id.

        The answered ids grow with the days they are kept; the join has no hint, so Spark broadcasts a side only if it is small.
        """
        named = batch.where(F.col(id_col).isNotNull()).dropDuplicates([id_col])
        seen = self.answered(batch.sparkSession).select("id")
        left = named.join(seen, F.col(id_col).cast("string") == seen["id"], "left_anti")
        return left.unionByName(batch.where(F.col(id_col).isNull()))

    def commit(self, output: DataFrame, ids: DataFrame, entry: str, message_id: str = "message_id", body: str = "value") -> None:
        """Send ``output`` and note ``ids`` (one column) under ``entry``, both or neither."""
        name = entry.replace("/", "-")
        noted = ids.toDF("id").select(F.col("id").cast("string"), F.current_timestamp().alias("at")).where("id IS NOT NULL")
        noted.write.mode("overwrite").parquet(f"{self.path}/answered/{name}")
        mq.send(output, self.path, message_id, body, entry, [name])

    def compact(self, spark: SparkSession, keep_days: float = KEEP_DAYS) -> None:
        """Bring the ids of all entries but the last, which a restart may ask for, into one table, and forget old ids.

        The new entry names those it replaces, so it takes effect at once; that they are deleted afterwards changes nothing.
        """
        self.recover()
        live = self._read()
        for entry in self.entries():  # what an earlier call replaced but did not come to delete
            if entry not in live:
                self.folder.delete(f"ledger/{entry}.json")
        entries = dict(list(live.items())[:-1])
        if len(entries) < 2:
            return
        ids = self._answered(spark, entries).where(F.col("at") > F.current_timestamp() - F.make_dt_interval(days=F.lit(keep_days).cast("int")))
        name = uuid.uuid4().hex
        ids.write.parquet(f"{self.path}/answered/{name}")
        content = {"segments": [], "ids": [name], "replaces": list(entries)}
        self.folder.write(f"ledger/{self.writer}/-{name}.json", json.dumps(content).encode())  # sorts before all batches
        for entry in entries:
            self.folder.delete(f"ledger/{entry}.json")


def run_id(checkpoint: str) -> str:
    """The id that Spark gives a query in its checkpoint, the same after each start."""
    return json.loads(mq.Folder(checkpoint).read("metadata"))["id"]


def deliver_once(
    messages: DataFrame,
    answer: Answer,
    out_queue: str,
    checkpoint: str,
    id_col: str = "message_id",
    delay: str | None = DELAY,
    writer: str = "answers",
    keep_days: float = KEEP_DAYS,
    available_now: bool = False,
    poll_seconds: float = POLL_SECONDS,
) -> StreamingQuery:
    """Answer each record of ``messages`` once into a queue.

    ``answer`` takes a batch of records that were not answered and returns ``message_id, value``, at most one row for each.
    Keyed state drops copies that arrive inside ``delay``; without it, by None, the ledger alone finds them all the same.
    """
    ledger = Ledger(out_queue, writer)
    source = unseen(messages, id_col, delay) if delay else messages
    ledger.recover()

    def run(batch: DataFrame, batch_id: int) -> None:
        entry = ledger.entry(run_id(checkpoint), batch_id)
        if mq.committed(ledger.folder, entry):
            mq.publish(ledger.folder, entry)
            batch.write.format("noop").mode("overwrite").save()  # the state of the stream goes on all the same
            return
        batch.persist(StorageLevel.MEMORY_AND_DISK)  # one pass through the state
        fresh = ledger.fresh(batch, id_col).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ledger.commit(answer(fresh), fresh.select(id_col), entry)
        finally:
            fresh.unpersist()
            batch.unpersist()
        if len(ledger.entries()) > COMPACT_ENTRIES:
            ledger.compact(batch.sparkSession, keep_days)

    stream = source.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{poll_seconds} seconds"}
    return stream.trigger(**trigger).start()
