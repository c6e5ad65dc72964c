"""A queue of messages in a shared folder, as a Spark data source for streams and writes.

``messages/`` holds segments, files of JSON lines ``{"id": …, "body": …}`` under any name, which producers put there whole.

*Receiving.* ``spark.readStream.format("tagloom_queue")`` reserves the segments that are there for its next batch, in a numbered
file under ``reserved/``, and that number is the stream's offset. A query that starts again finds the same segments
under the same number, whatever arrived meanwhile. While there is none, the source waits up to ``wait`` seconds. Segments are
deleted when Spark commits their batch, which is after its output was delivered: a message is deleted after it was answered.
A queue has one consumer.

*Sending.* A write puts segments into ``staging/``, and one small file under ``ledger/`` commits them together with the ids of the
records they answer (see :mod:`tagloom.streaming.delivery`). Committed segments move to ``messages/``; a move that a failure
cut short is finished by the next one who opens the queue. Segments without a ledger entry are never seen.

Tasks and driver reach the folder through Arrow's file systems, so it may be on any store that these open. Defined cases: an id may
be null, a body may be null or empty; an empty write commits no segment; blank lines of a segment are passed over.
"""

from __future__ import annotations

import json
import sys
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import PurePosixPath

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.functions import lit
from pyspark.sql.types import StructType

from tagloom.constants import POLL_SECONDS

# Tasks get the source by value, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "tagloom_queue"
SCHEMA = "message_id string, body string"
ROWS_PER_BATCH = 1000
FILES_PER_BATCH = 1000
LOOK_SECONDS = 0.2


class Folder:
    """The files of a queue, by paths relative to it."""

    def __init__(self, path: str) -> None:
        if path.startswith("file:/") and not path.startswith("file://"):
            path = f"file://{path.removeprefix('file:')}"
        self.store, self.base = fs.FileSystem.from_uri(path if "://" in path else PurePosixPath(path).as_posix())

    def names(self, folder: str) -> list[str]:
        """Names of the files in a folder, sorted; hidden ones are not finished."""
        found = self.store.get_file_info(fs.FileSelector(f"{self.base}/{folder}", allow_not_found=True))
        return sorted(f.base_name for f in found if f.type == fs.FileType.File and not f.base_name.startswith("."))

    def read(self, name: str) -> bytes:
        with self.store.open_input_stream(f"{self.base}/{name}") as file:
            return file.read()

    def write(self, name: str, content: bytes) -> None:
        """The whole file under its name at once, or nothing."""
        place = PurePosixPath(f"{self.base}/{name}")
        self.store.create_dir(place.parent.as_posix(), recursive=True)
        hidden = (place.parent / f".{place.name}.{uuid.uuid4().hex}").as_posix()
        with self.store.open_output_stream(hidden) as file:
            file.write(content)
        self.store.move(hidden, place.as_posix())

    def move(self, name: str, to: str) -> None:
        """Move a file that may have been moved already."""
        place = PurePosixPath(f"{self.base}/{to}")
        self.store.create_dir(place.parent.as_posix(), recursive=True)
        if self.store.get_file_info(f"{self.base}/{name}").type == fs.FileType.File:
            self.store.move(f"{self.base}/{name}", place.as_posix())

    def delete(self, name: str) -> None:
        if self.store.get_file_info(f"{self.base}/{name}").type == fs.FileType.File:
            self.store.delete_file(f"{self.base}/{name}")


def _numbered(number: int) -> str:
    return f"{number:020d}"


@dataclass
class Segment(InputPartition):
    name: str


class QueueReader(DataSourceStreamReader):
    """Offsets are numbers of reservations; see the module's text."""

    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.wait = float(options.get("wait", POLL_SECONDS))
        self.files = int(options.get("filesperbatch", FILES_PER_BATCH))

    def _reserved(self, folder: Folder) -> list[int]:
        return [int(n.split(".")[0]) for n in folder.names("reserved") if n.endswith(".json")]

    def initialOffset(self) -> dict:
        done = [int(n.split(".")[0]) for n in Folder(self.path).names("reserved") if n.endswith(".done")]
        return {"reserved": max(done, default=0)}

    def latestOffset(self) -> dict:
        folder, until = Folder(self.path), time.monotonic() + self.wait
        last = max([*self._reserved(folder), self.initialOffset()["reserved"]])
        while True:
            taken = {name for n in self._reserved(folder) for name in json.loads(folder.read(f"reserved/{_numbered(n)}.json"))}
            new = [name for name in folder.names("messages") if name not in taken][: self.files]
            if new:
                folder.write(f"reserved/{_numbered(last + 1)}.json", json.dumps(new).encode())
                return {"reserved": last + 1}
            if time.monotonic() >= until:
                return {"reserved": last}
            time.sleep(LOOK_SECONDS)

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        folder = Folder(self.path)
        numbers = [n for n in self._reserved(folder) if start["reserved"] < n <= end["reserved"]]
        return [Segment(name) for n in numbers for name in json.loads(folder.read(f"reserved/{_numbered(n)}.json"))]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        lines = Folder(self.path).read(f"messages/{partition.name}").decode().split("\n")
        records = [json.loads(line) for line in lines if line.strip()]
        for k in range(0, len(records), ROWS_PER_BATCH):
            some = records[k : k + ROWS_PER_BATCH]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in some], pa.string()) for c in ("id", "body")], names=["message_id", "body"])

    def commit(self, end: dict) -> None:
        """The batch was delivered: its messages go, and then its reservation. Done again, this changes nothing."""
        folder = Folder(self.path)
        done = [n for n in self._reserved(folder) if n <= end["reserved"]]
        for n in done:
            for name in json.loads(folder.read(f"reserved/{_numbered(n)}.json")):
                folder.delete(f"messages/{name}")
        if done:
            folder.write(f"reserved/{_numbered(max(done))}.done", b"")
        for n in done:
            folder.delete(f"reserved/{_numbered(n)}.json")
        for name in folder.names("reserved"):
            if name.endswith(".done") and int(name.split(".")[0]) < max(done, default=0):
                folder.delete(f"reserved/{name}")


@dataclass
class Staged(WriterCommitMessage):
    names: list


class QueueWriter(DataSourceWriter):
    """Stages segments and commits them by a ledger entry, unless the entry is there already."""

    def __init__(self, options: dict) -> None:
        self.path, self.entry = options["path"], options.get("entry") or uuid.uuid4().hex
        self.ids = json.loads(options.get("ids", "[]"))
        self.rows = int(options.get("rows", 10_000))

    def write(self, iterator: Iterator) -> Staged:
        folder, names, held = Folder(self.path), [], []

        def flush() -> None:
            if held:
                names.append(f"{uuid.uuid4().hex}.jsonl")
                folder.write(f"staging/{names[-1]}", "".join(held).encode())
                held.clear()

        for row in iterator:
            held.append(json.dumps({"id": row[0], "body": row[1]}, ensure_ascii=False) + "\n")
            if len(held) >= self.rows:
                flush()
        flush()
        return Staged(names)

    def commit(self, messages: list) -> None:
        folder, names = Folder(self.path), [name for m in messages if m for name in m.names]
        if committed(folder, self.entry):
            self._drop(folder, names)
        else:
            folder.write(f"ledger/{self.entry}.json", json.dumps({"segments": names, "ids": self.ids}).encode())
        publish(folder, self.entry)

    def abort(self, messages: list) -> None:
        self._drop(Folder(self.path), [name for m in messages if m for name in m.names])

    @staticmethod
    def _drop(folder: Folder, names: list) -> None:
        for name in names:
            folder.delete(f"staging/{name}")


class QueueSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> QueueReader:  # noqa: ARG002 - the schema is fixed
        return QueueReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> QueueWriter:  # noqa: ARG002 - a queue is only added to
        return QueueWriter(self.options)


def committed(folder: Folder, entry: str) -> bool:
    """Whether the ledger has this entry, published or not."""
    parent, _, name = f"ledger/{entry}".rpartition("/")
    there = folder.names(parent)
    return f"{name}.json" in there


def publish(folder: Folder, entry: str) -> None:
    """Let consumers see the segments of a committed entry."""
    for name in json.loads(folder.read(f"ledger/{entry}.json"))["segments"]:
        folder.move(f"staging/{name}", f"messages/{name}")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(QueueSource)


def receive(spark: SparkSession, path: str, wait: float = POLL_SECONDS, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """A stream ``message_id, body`` of the queue's messages; each is deleted once its batch is done."""
    register(spark)
    return spark.readStream.format(FORMAT).option("wait", wait).option("filesPerBatch", files_per_batch).load(path)


def send(messages: DataFrame, path: str, message_id: Column | str, body: Column | str, entry: str | None = None, ids: list | None = None) -> None:
    """Put a message for each row into the queue, all at once; an ``entry`` that the ledger has already sends nothing.

    ``ids`` are paths that the entry names, as :mod:`tagloom.streaming.delivery` does with tables of answered records.
    """
    spark = messages.sparkSession
    register(spark)
    rows = messages.select(F.col(message_id) if isinstance(message_id, str) else message_id, F.col(body) if isinstance(body, str) else body)
    rows = rows.toDF("message_id", "body").select(F.col("message_id").cast("string"), F.col("body").cast("string"))
    writer = rows.write.format(FORMAT).mode("append").option("ids", json.dumps(ids or []))
    if entry is not None:
        writer = writer.option("entry", entry)
    writer.save(path)


def waiting(spark: SparkSession, path: str) -> DataFrame:
    """``message_id, body`` of the messages that are in the queue now, without taking them."""
    names = Folder(path).names("messages")
    if not names:
        return spark.createDataFrame([], SCHEMA)
    lines = spark.read.schema("id string, body string").json([f"{path}/messages/{name}" for name in names])
    return lines.select(F.col("id").alias("message_id"), F.coalesce("body", lit(None)).alias("body"))
