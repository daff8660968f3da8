"""Deliveries that no positive acknowledgement followed in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.schema import CLAIM_IDLE_MS, require_positive


def unacked_after(
    deliveries: DataFrame,
    acks: DataFrame,
    idle_ms: int = CLAIM_IDLE_MS,
    delay: str = "10 minutes",
) -> DataFrame:
    """Deliveries without a positive ack within ``idle_ms``, for redelivery.

    ``deliveries`` carry ``delivered_at`` and ``acks`` (one row per id)
    ``acked_at``, both timestamps. An ack after the idle time does not stop the
    redelivery. On streams a delivery is given out once both watermarks have
    passed its idle time, which also bounds the state.
    """
    require_positive(idle_ms=idle_ms)
    sent, said = deliveries, acks.filter("ack")
    if deliveries.isStreaming:
        sent = sent.withWatermark("delivered_at", delay)
        said = said.withWatermark("acked_at", delay)
    said = said.select(
        F.col("stream").alias("a_stream"), F.col("id").alias("a_id"), "acked_at"
    )
    in_time = (
        (F.col("stream") == F.col("a_stream"))
        & (F.col("id") == F.col("a_id"))
        & (F.col("acked_at") >= F.col("delivered_at"))
        & (
            F.col("acked_at")
            <= F.col("delivered_at") + F.expr(f"interval '{idle_ms / 1000:.3f}' second")
        )
    )
    how = "left_outer" if deliveries.isStreaming else "left_anti"
    joined = sent.join(said, in_time, how)
    if deliveries.isStreaming:
        joined = joined.filter(F.col("a_id").isNull())
    return joined.select(*deliveries.columns)
