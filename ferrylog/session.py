"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Bytes of a batch of rows on its way to Python.
ARROW_BATCH_BYTES = 8 * 1024 * 1024


def prepare(spark: SparkSession) -> SparkSession:
    """Set the session options that entry parsing and streaming state rely on.

    * Repeated keys inside a nested JSON object keep their last value, as a
      usual JSON reader does; without the option such an object counts as
      faulty.
    * Streaming state lives in RocksDB, so it may outgrow the executor heap.
    * Batches that go to Python hold a bounded number of bytes: a worker keeps a few of
      them, an executor runs many workers, and rows are as long as their texts.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own;
    on a cluster a machine-local folder would be invisible to other executors,
    so a missing setting is an error there.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="ferrylog-")
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Store ``df`` as a table in the scratch folder and read it from there.

    Cuts the lineage with data that outlives executors, keeps later readers
    from computing it again, and lets the planner see the true size.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
