"""Live counters of streaming queries."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ferrylog.operators.shape import has_body

OBSERVED = "delivery"


def observe_entries(entries: DataFrame) -> DataFrame:
    """Count fetched, publishable and skipped entries of every micro-batch."""
    return entries.observe(
        OBSERVED,
        F.count(F.lit(1)).alias("messages_fetched"),
        F.count_if(has_body()).alias("messages_published"),
        F.count_if(~has_body()).alias("messages_skipped"),
    )


def observe_acks(acks: DataFrame) -> DataFrame:
    """Count acked, refused and rejected messages of parsed acks."""
    good = F.col("reject_reason").isNull()
    return acks.observe(
        "settlement",
        F.sum(F.when(good & F.col("ack"), F.size("ids")).otherwise(0)).alias("messages_acked"),
        F.sum(F.when(good & ~F.col("ack"), F.size("ids")).otherwise(0)).alias("messages_nacked"),
        F.count_if(~good).alias("errors_ack"),
    )


class CounterListener(StreamingQueryListener):
    """Running totals of all observed metrics, and of failed queries.

    Register it with ``spark.streams.addListener`` before the query starts; it
    holds one number per counter, however long the query runs.
    """

    def __init__(self) -> None:
        self.totals: Counter[str] = Counter()
        self.ended = Event()

    def onQueryStarted(self, event) -> None:
        self.ended.clear()

    def onQueryProgress(self, event) -> None:
        for row in (event.progress.observedMetrics or {}).values():
            for name, value in row.asDict().items():
                self.totals[name] += int(value or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.totals["errors_query"] += 1
        self.ended.set()

    def table(self, spark: SparkSession) -> DataFrame:
        """The totals as (metric, value)."""
        return spark.createDataFrame(sorted(self.totals.items()), "metric string, value bigint")


def run_observed(
    spark: SparkSession, start: Callable[[], StreamingQuery], patience_s: float = 60.0
) -> CounterListener:
    """Run a query that ends by itself and return its counters.

    Progress events arrive after the fact; the end event is the last of them.
    """
    listener = CounterListener()
    spark.streams.addListener(listener)
    try:
        start().awaitTermination()
        if not listener.ended.wait(patience_s):
            raise TimeoutError("no end event from the streaming query")
    finally:
        spark.streams.removeListener(listener)
    return listener
