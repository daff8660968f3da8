"""Repeated rows of a stream, told by when they were received."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_received(rows: DataFrame, keys: list[str], keep: str = "1 day") -> DataFrame:
    """One row for each value of ``keys``.

    On a stream the keys are remembered for ``keep`` after their receipt. The time of
    receipt is the micro-batch's own, which only grows and is replayed after a
    failure: no row is ever late, however old its id or its sender's time is, and the
    watermark does nothing but expire state. A repeat after ``keep`` comes through
    again. ``rows`` must not carry a watermark of their own.
    """
    if not rows.isStreaming:
        return rows.dropDuplicates(keys)
    timed = rows.withColumn("_received_at", F.current_timestamp())
    seen = timed.withWatermark("_received_at", keep).dropDuplicatesWithinWatermark(keys)
    return seen.drop("_received_at")
