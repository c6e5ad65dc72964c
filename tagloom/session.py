"""Session helpers: where checkpoints go and how narrow scans are spread."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of ``spark.checkpoint.dir``.

    Only a local master without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its executor, so the
    setting is demanded there.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
    elif context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tagloom-checkpoint-"))


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder, not made yet, that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def freeze(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Give an under-split scan one partition per core.

    A table with at least as many splits as cores is returned as it is, so on a
    large input this adds no shuffle. It only helps inputs of a few row groups
    whose text would otherwise be exploded by one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)
