"""Helpers of this subpackage: folders that all executors share, and file access inside tasks."""

from __future__ import annotations

import uuid
from pathlib import PurePosixPath

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.session import ensure_checkpoint_dir

TEXT_ROWS = 1000


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, as a URI or path that Spark opens."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, after setting the rows of an Arrow batch in its session to TEXT_ROWS at most.

    Both ends of the connection to a Python worker hold whole batches, which the default of 10,000 rows makes large for texts.
    """
    conf = df.sparkSession.conf
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= TEXT_ROWS:
        conf.set(name, str(TEXT_ROWS))
    return df


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the lineage ends there."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def open_store(path: str):
    """The Arrow file system and the path inside it, for ``path`` as Hadoop spells it."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = f"file://{path.removeprefix('file:')}"
    return fs.FileSystem.from_uri(path if "://" in path else PurePosixPath(path).as_posix())


def row_slices(batch: pa.RecordBatch, texts: str | pa.Array, limit: int):
    """Cut a batch into runs of rows whose ``texts``, a column or its name, hold about ``limit`` bytes; a longer row stands alone."""
    texts = batch.column(texts) if isinstance(texts, str) else texts
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


#: A group is hot if it holds more than one row in so many; so there are at most as many hot groups.
HOT_SHARE = 1000


def hot_join(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Inner join of ``rows`` with the one row each key has in ``groups``, whose ``size`` counts the rows of the key.

    Hot groups, at most HOT_SHARE of them, go by broadcast and leave the other join without large keys. Both tables are
    read twice, so they should be stored.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) * HOT_SHARE > total
    large = F.broadcast(groups.where(hot))
    return rows.join(large, key).unionByName(rows.join(large.select(key), key, "left_anti").join(groups.where(~hot), key))


def hashed_sample(rows: DataFrame, size: int) -> DataFrame:
    """At most ``size`` rows, those of least hash over all columns: the same ones in any order and partitioning.

    Of a large table only hashes in the share that holds twice as many rows are sorted, so no task gets a share of each
    partition that grows with their number.
    """
    key = F.xxhash64(*rows.columns)
    total = rows.count()
    if total > 4 * size:
        rows = rows.where(key < -(1 << 63) + int(2 * size / total * (1 << 64)))
    return rows.orderBy(key, *rows.columns).limit(size)
