"""Counters, batch statistics, rejects, ack backlog and health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OK = "ok"
DEGRADED = "degraded"
DISCONNECTED = "disconnected"
TOTAL = "total"


def counters(
    fetched: DataFrame | None = None,
    published: DataFrame | None = None,
    acks: DataFrame | None = None,
    claimed: DataFrame | None = None,
    changes: DataFrame | None = None,
    removed: DataFrame | None = None,
) -> DataFrame:
    """Counters per stream and in total: (scope, stream, metric, value).

    ``acks`` is one row per acknowledged id, ``changes`` the result of
    ``refresh_streams`` and ``removed`` the dropped consumers. Each input is
    counted before it leaves its tasks; the rollup works on counts.
    """
    parts: list[DataFrame] = []
    for metric, df in (
        ("messages_fetched", fetched),
        ("messages_published", published),
        ("messages_claimed", claimed),
        ("dead_consumers_removed", removed),
    ):
        if df is not None:
            parts.append(_count(df, F.lit(metric)))
    if acks is not None:
        metric = F.when(F.col("ack"), "messages_acked").otherwise("messages_nacked")
        parts.append(_count(acks, metric))
    if changes is not None:
        active = changes.filter(F.col("change") != "removed")
        parts.append(_count(active, F.lit("streams_active")))
        parts.append(_count(changes.filter(F.col("change") == "new"), F.lit("streams_discovered")))
    if not parts:
        raise ValueError("counters needs at least one input")
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    # rollup over (metric, stream) less its grand total: a total per metric
    return (
        counts.rollup("metric", "stream")
        .agg(F.sum("n").alias("value"), F.grouping("stream").alias("all_streams"))
        .filter(F.col("metric").isNotNull())
        .select(
            F.when(F.col("all_streams") == 1, TOTAL).otherwise("stream").alias("scope"),
            F.coalesce("stream", F.lit("")).alias("stream"),
            "metric",
            "value",
        )
    )


def _count(df: DataFrame, metric: Column) -> DataFrame:
    return df.groupBy("stream", metric.alias("metric")).agg(F.count(F.lit(1)).alias("n"))


def publish_stats(envelopes: DataFrame) -> DataFrame:
    """Per batch: lines, skipped rows, bytes before and after compression."""
    packed = F.octet_length("payload").cast("bigint")
    return envelopes.select(
        "stream",
        "batch",
        F.col("n_lines").alias("published"),
        F.col("n_skipped").alias("skipped"),
        "raw_bytes",
        packed.alias("packed_bytes"),
        (F.col("raw_bytes") / packed).alias("ratio"),
    )


def error_counts(
    bad_objects: DataFrame | None = None,
    rejected_acks: DataFrame | None = None,
    failed_flushes: DataFrame | None = None,
    failed_batches: DataFrame | None = None,
) -> DataFrame:
    """Errors per stage and reason: (stage, reason, value).

    A failed publish counts all lines of its batch (``n_lines``), a failed ack
    flush counts once.
    """
    parts: list[DataFrame] = []

    def add(df: DataFrame | None, stage: str, reason: Column, weight: Column) -> None:
        if df is not None:
            parts.append(
                df.select(
                    F.lit(stage).alias("stage"),
                    reason.alias("reason"),
                    weight.cast("bigint").alias("n"),
                )
            )

    add(bad_objects, "fetch", F.lit("object"), F.lit(1))
    add(rejected_acks, "ack", F.col("reject_reason"), F.lit(1))
    add(failed_flushes, "ack", F.lit("flush"), F.lit(1))
    add(failed_batches, "publish", F.lit("batch"), F.col("n_lines"))
    if not parts:
        raise ValueError("error_counts needs at least one input")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("stage", "reason").agg(F.sum("n").alias("value"))


def ack_backlog(accepted: DataFrame, processed: DataFrame) -> DataFrame:
    """Ack messages accepted and not yet processed, as one row."""
    signed = accepted.select(F.lit(1).alias("n")).unionAll(
        processed.select(F.lit(-1).alias("n"))
    )
    return signed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("ack_queue_depth"))


def health_rollup(components: DataFrame) -> DataFrame:
    """One row: overall status and the state of ``source`` and ``sink``.

    A component that was not checked (``ok`` is null) or is not listed counts
    as ok; a failing one shows its message.
    """
    failed = ~F.coalesce(F.col("ok"), F.lit(True))
    said = F.coalesce(F.nullif(F.col("message"), F.lit("")), F.lit(DISCONNECTED))

    def state(name: str) -> Column:
        return F.coalesce(
            F.max(F.when(failed & (F.col("component") == name), said)), F.lit(OK)
        ).alias(name)

    bad = F.coalesce(F.max(failed), F.lit(False))
    return components.agg(
        F.when(bad, DEGRADED).otherwise(OK).alias("status"), state("source"), state("sink")
    )
