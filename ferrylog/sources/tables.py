"""Entry, envelope and acknowledgement tables on shared storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrylog.operators.envelopes import pack_envelopes
from ferrylog.schema import BATCH_SIZE, ENTRIES, ENVELOPES


def write_entries(entries: DataFrame, path: str, mode: str = "append") -> None:
    """Store entries with one folder per stream, for partition pruning."""
    entries.select("id", "object", "raw", "stream").write.mode(mode).partitionBy(
        "stream"
    ).parquet(path)


def read_entries(spark: SparkSession, path: str, stream: str | None = None) -> DataFrame:
    """Entries of one named stream, or of every stream with its name.

    Absent text is empty text. Naming a stream prunes all other folders.
    """
    stored = spark.read.schema(ENTRIES).parquet(path)
    if stream is not None:
        # Spark stores an empty partition value as its name for null
        stored = stored.filter(F.col("stream") == stream if stream else F.col("stream").isNull())
    return stored.select(
        "id",
        F.coalesce("stream", F.lit("")).alias("stream"),
        F.coalesce("object", F.lit("")).alias("object"),
        F.coalesce("raw", F.lit("")).alias("raw"),
    )


def write_envelopes(
    lines: DataFrame, path: str, batch_size: int = BATCH_SIZE, mode: str = "append"
) -> None:
    """Pack lines into zstd envelopes and store them."""
    pack_envelopes(lines, batch_size).write.mode(mode).parquet(path)


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPES).parquet(path)


def topic_name(base_topic: str | Column, tenant: Column | None = None) -> Column:
    """Destination topic, below the tenant's name when there is one."""
    base = F.lit(base_topic) if isinstance(base_topic, str) else base_topic
    if tenant is None:
        return base
    return F.when(F.coalesce(tenant, F.lit("")) != "", F.concat_ws("/", tenant, base)).otherwise(
        base
    )


def route_topic(df: DataFrame, base_topic: str, tenant_col: str | None = None) -> DataFrame:
    """Add ``topic``; write with ``partitionBy('topic')`` to split by it."""
    tenant = F.col(tenant_col) if tenant_col else None
    return df.withColumn("topic", topic_name(base_topic, tenant))
