"""The jobs of log delivery, as compositions of operators.

Tables are not changed in place: a job returns the next state of its tables,
which the caller writes as a new version and reads in the next round. Delivery
is at least once: a delivered entry stays in the store and in the pending set
until a positive ack settles it.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.operators import recover as rec
from ferrylog.operators import settle as st
from ferrylog.operators.envelopes import dedup_received, pack_envelopes, rejected_envelopes, unpack_envelopes
from ferrylog.operators.shape import build_payload
from ferrylog.operators.streams import read_new
from ferrylog.schema import (
    BATCH_SIZE,
    CLAIM_IDLE_MS,
    CONSUMER_IDLE_TIMEOUT_MS,
    DELIVERIES,
    MAX_DECOMPRESS_BYTES,
)
from ferrylog.session import written


class Delivered(NamedTuple):
    envelopes: DataFrame
    deliveries: DataFrame
    cursors: DataFrame


class Received(NamedTuple):
    lines: DataFrame
    rejected: DataFrame


class Settled(NamedTuple):
    entries: DataFrame
    deliveries: DataFrame
    rejected: DataFrame


class Recovered(NamedTuple):
    lines: DataFrame
    deliveries: DataFrame
    consumers: DataFrame
    report: DataFrame


def deliver(
    entries: DataFrame,
    deliveries: DataFrame,
    cursors: DataFrame,
    consumer: str,
    now_ms: int,
    batch_size: int = BATCH_SIZE,
) -> Delivered:
    """Read the next batch of every stream and pack it for publishing.

    The batch becomes pending before anything is known about its publishing; a
    failed publish therefore comes back through ``recover``.
    """
    rows, after = read_new(entries, cursors, batch_size)
    sent = rows.select(
        "stream",
        "id",
        F.lit(consumer).alias("consumer"),
        F.lit(now_ms).cast("bigint").alias("delivered_at_ms"),
    )
    return Delivered(
        envelopes=pack_envelopes(build_payload(rows, skip_empty=True), batch_size),
        deliveries=deliveries.select(*DELIVERIES.names).unionByName(sent),
        cursors=after,
    )


def receive(envelopes: DataFrame, max_bytes: int = MAX_DECOMPRESS_BYTES) -> Received:
    """Unpack what was published, without repeats, and report what can't be unpacked.

    An envelope that is damaged or larger than ``max_bytes`` gives no line but one row in
    ``rejected`` with its number of lines; nobody acknowledges these, so the entries
    stay pending and ``recover`` builds them again.
    """
    return Received(
        lines=dedup_received(unpack_envelopes(envelopes, max_bytes)),
        rejected=rejected_envelopes(envelopes, max_bytes),
    )


def settle(entries: DataFrame, deliveries: DataFrame, payloads: DataFrame) -> Settled:
    """Read ack payloads and settle what they confirm."""
    valid, rejected = st.validate_ack(st.read_acks(payloads))
    left, still_pending = st.apply_acks(entries, deliveries, st.explode_acks(valid))
    return Settled(entries=left, deliveries=still_pending, rejected=rejected)


def recover(
    entries: DataFrame,
    deliveries: DataFrame,
    consumers: DataFrame,
    consumer: str,
    now_ms: int,
    claim_idle_ms: int = CLAIM_IDLE_MS,
    idle_timeout_ms: int = CONSUMER_IDLE_TIMEOUT_MS,
    batch_size: int = BATCH_SIZE,
) -> Recovered:
    """Drop dead consumers, claim idle deliveries and build them again.

    What a dead consumer held goes to the claim feed first: it keeps its place
    in the pending set with its old delivery time but no owner, so it is claimed as
    soon as it is idle long enough, never stranded, and its old owner is reported
    in one round only. The dead and the pending set are written once.
    """
    info = rec.consumers_info(deliveries, now_ms, consumers)
    dead = written(rec.dead_consumers(info, consumer, idle_timeout_ms), "dead")
    dropped = rec.drop_dead_consumers(consumers, deliveries, dead)
    waiting = written(rec.release(deliveries, dead), "waiting")
    claimed, after = rec.claim_idle(
        entries, waiting, consumer, now_ms, claim_idle_ms, batch_size
    )
    return Recovered(
        lines=build_payload(claimed, skip_empty=True)
        .filter(F.col("line").isNotNull())
        .select("id", "stream", "line"),
        deliveries=after,
        consumers=dropped.consumers,
        report=dropped.report,
    )
