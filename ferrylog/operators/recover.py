"""Pending deliveries: idle ones are claimed, dead consumers are dropped."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylog.operators.positions import first_per_stream
from ferrylog.operators.settle import pending_rows, positive_ids
from ferrylog.operators.shape import build_payload, drop_empty_body
from ferrylog.schema import (
    BATCH_SIZE,
    CLAIM_IDLE_MS,
    CONSUMER_IDLE_TIMEOUT_MS,
    RELEASED,
    require_positive,
)
from ferrylog.session import written

_KEY = ["stream", "id"]
_OWNED = ["stream", "consumer"]


class Dropped(NamedTuple):
    """Result of dropping dead consumers."""

    consumers: DataFrame
    released: DataFrame
    deliveries: DataFrame
    report: DataFrame


def idle_ms(now_ms: int | Column, since: str = "delivered_at_ms") -> Column:
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms).cast("bigint")
    return now - F.col(since)


def pending(deliveries: DataFrame, acks: DataFrame, now_ms: int | Column) -> DataFrame:
    """Delivered and not positively acked, with owner and idle time."""
    open_rows = pending_rows(deliveries, positive_ids(acks))
    return open_rows.withColumn("idle_ms", idle_ms(now_ms))


def select_idle(
    pending_set: DataFrame,
    now_ms: int | Column,
    claim_idle_ms: int = CLAIM_IDLE_MS,
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """Lowest ids first, at most ``batch_size`` idle deliveries per stream.

    The owner plays no part; a consumer's own idle deliveries count.
    """
    require_positive(claim_idle_ms=claim_idle_ms, batch_size=batch_size)
    idle = pending_set.filter(idle_ms(now_ms) >= F.lit(claim_idle_ms))
    return first_per_stream(idle, batch_size)


def claim_idle(
    entries: DataFrame,
    pending_set: DataFrame,
    consumer: str,
    now_ms: int,
    claim_idle_ms: int = CLAIM_IDLE_MS,
    batch_size: int = BATCH_SIZE,
) -> tuple[DataFrame, DataFrame]:
    """Take over idle deliveries and fetch their entries again.

    Returns the claimed entries and the pending set afterwards: claimed rows
    belong to ``consumer`` with their idle time back at zero, and idle rows
    whose entry is gone leave the set without yielding anything. The chosen
    keys are written once, so both results and any retry see the same choice.
    """
    chosen = written(
        select_idle(pending_set, now_ms, claim_idle_ms, batch_size).select(*_KEY), "chosen"
    )
    claimed = entries.join(chosen, _KEY, "left_semi")
    taken = claimed.select(
        *_KEY,
        F.lit(consumer).alias("consumer"),
        F.lit(now_ms).cast("bigint").alias("delivered_at_ms"),
    )
    kept = pending_set.join(chosen, _KEY, "left_anti").select(
        *_KEY, "consumer", "delivered_at_ms"
    )
    return claimed, kept.unionByName(taken)


def redelivery_feed(fresh: DataFrame, claimed: DataFrame) -> DataFrame:
    """Fresh and claimed entries on one path to payload lines."""
    columns = ["id", "stream", "object", "raw"]
    feed = fresh.select(*columns).unionByName(claimed.select(*columns))
    return build_payload(drop_empty_body(feed)).select("id", "stream", "line")


def consumers_info(
    pending_set: DataFrame, now_ms: int | Column, consumers: DataFrame | None = None
) -> DataFrame:
    """Per stream and consumer: pending count and time since last activity.

    With ``consumers`` those that hold nothing are listed, too; released deliveries
    belong to nobody. Both sides become one table before the only shuffle.
    """
    owned = pending_set.filter(~F.col("consumer").eqNullSafe(F.lit(RELEASED)))
    seen = owned.select(
        *_OWNED, F.lit(1).alias("held"), F.col("delivered_at_ms").alias("last_seen_ms")
    )
    if consumers is not None:
        seen = seen.unionByName(
            consumers.select(*_OWNED, F.lit(0).alias("held"), "last_seen_ms")
        )
    return (
        seen.groupBy(*_OWNED)
        .agg(F.sum("held").alias("pending"), F.max("last_seen_ms").alias("last_seen_ms"))
        .select(*_OWNED, "pending", idle_ms(now_ms, "last_seen_ms").alias("idle_ms"))
    )


def dead_consumers(
    info: DataFrame, own_name: str, idle_timeout_ms: int = CONSUMER_IDLE_TIMEOUT_MS
) -> DataFrame:
    """Consumers idle for longer than the timeout, never oneself."""
    return info.filter(
        (F.col("consumer") != own_name) & (F.col("idle_ms") > F.lit(idle_timeout_ms))
    )


def release(pending_set: DataFrame, dead: DataFrame) -> DataFrame:
    """The pending set, in which deliveries of dead consumers have no owner.

    They keep their delivery time and so their turn in the claim feed. Their old
    owner, gone from the consumers, is not listed again because of them.
    """
    gone = dead.select(*_OWNED).distinct().withColumn("_gone", F.lit(True))
    owner = F.when(F.col("_gone"), F.lit(RELEASED)).otherwise(F.col("consumer"))
    return (
        pending_set.join(gone, _OWNED, "left")
        .withColumn("consumer", owner)
        .select(*pending_set.columns)
    )


def drop_dead_consumers(
    consumers: DataFrame, pending_set: DataFrame, dead: DataFrame
) -> Dropped:
    """Remove dead consumers and hand their pending deliveries to the claim feed.

    ``released`` are the deliveries they held, ``deliveries`` the rest, and
    ``report`` the number of deliveries that each removed consumer held.
    """
    gone = dead.select(*_OWNED)
    held = pending_set.groupBy(*_OWNED).agg(F.count(F.lit(1)).alias("held"))
    report = (
        gone.join(held, _OWNED, "left")
        .select(*_OWNED, F.coalesce("held", F.lit(0)).alias("released"))
    )
    return Dropped(
        consumers=consumers.join(gone, _OWNED, "left_anti"),
        released=pending_set.join(gone, _OWNED, "left_semi"),
        deliveries=pending_set.join(gone, _OWNED, "left_anti"),
        report=report,
    )
