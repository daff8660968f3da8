"""Continuous reading and delivery of entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ferrylog.operators.envelopes import pack_envelopes
from ferrylog.operators.shape import build_payload
from ferrylog.schema import BATCH_SIZE, ENTRIES, require_positive


def stream_table(
    spark: SparkSession, path: str, schema: StructType, per_trigger: int = 1000
) -> DataFrame:
    """A folder of parquet files as a stream, ``per_trigger`` files at a time."""
    require_positive(per_trigger=per_trigger)
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)
    )


def stream_entries(spark: SparkSession, path: str, per_trigger: int = 1000) -> DataFrame:
    """Entries from the beginning, each read once per checkpoint.

    The checkpoint of the query that consumes the stream is the group's cursor;
    ``per_trigger`` files bound a poll.
    """
    return stream_table(spark, path, ENTRIES, per_trigger).select(
        "id",
        F.coalesce("stream", F.lit("")).alias("stream"),
        F.coalesce("object", F.lit("")).alias("object"),
        F.coalesce("raw", F.lit("")).alias("raw"),
    )


def deliver_stream(
    entries: DataFrame,
    path: str,
    checkpoint: str,
    batch_size: int = BATCH_SIZE,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Publish a stream of entries as envelopes below ``path``.

    Every micro-batch replaces its own ``epoch`` folder, so a replay after a
    failure writes the same envelopes again and never loses any. Lines are
    built in the stream's own plan and kept while they are counted and packed.
    """
    lines = build_payload(entries, skip_empty=True).select("id", "stream", "line")

    def publish(batch: DataFrame, epoch: int) -> None:
        kept = batch.persist()
        try:
            pack_envelopes(kept, batch_size).write.mode("overwrite").parquet(
                f"{path}/epoch={epoch}"
            )
        finally:
            kept.unpersist()

    return (
        lines.writeStream.foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def append_stream(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append a streaming result to a parquet folder."""
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
