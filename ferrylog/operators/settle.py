"""Acknowledgements: read, validate, group and settle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylog.functions import ackjson
from ferrylog.functions.ids import id_pair
from ferrylog.functions.numbers import floor_div
from ferrylog.functions.zstd import is_compressed, zstd_unpack
from ferrylog.schema import MAX_DECOMPRESS_BYTES, require_positive
from ferrylog.session import written
from ferrylog.streaming.receipt import first_received

_KEY = ["stream", "id"]


def read_acks(payloads: DataFrame, max_bytes: int = MAX_DECOMPRESS_BYTES) -> DataFrame:
    """Parse ack payloads, plain JSON or zstd, told apart by magic bytes.

    Replaces ``payload`` by ``ids``, ``stream``, ``ack`` and ``reject_reason``
    (null for a valid ack). Nothing fails: a payload that cannot be read is
    a row with a reason. Only compressed payloads travel to Python.
    """
    packed = is_compressed(F.col("payload"))
    frames = payloads.withColumn("_packed", packed).withColumn(
        "_body", zstd_unpack(F.when(F.col("_packed"), F.col("payload")), max_bytes)
    )
    text = F.when(F.col("_packed"), F.col("_body")).otherwise(F.col("payload"))
    parsed = frames.withColumn("_text", text.cast("string")).drop("payload", "_body", "_packed")
    return parse_acks(parsed, "_text").drop("_text")


def parse_acks(texts: DataFrame, col: str = "payload") -> DataFrame:
    """Add ``ids``, ``stream``, ``ack`` and ``reject_reason`` from JSON text.

    A null text stands for a frame that could not be decoded.
    """
    parsed = texts.withColumn("_object", ackjson.ack_object(F.col(col))).withColumn(
        "_ack", ackjson.parse_ack(F.col("_object"))
    )
    reason = F.when(F.col(col).isNull(), ackjson.REJECT_UNDECODABLE).otherwise(
        ackjson.reject_reason(F.col("_object"), F.col("_ack"))
    )
    return parsed.withColumn("reject_reason", reason).select(
        *[c for c in texts.columns],
        "_ack.ids",
        "_ack.stream",
        "_ack.ack",
        "reject_reason",
    )


def validate_ack(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split parsed acks into valid and rejected ones."""
    valid = parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, parsed.filter(F.col("reject_reason").isNotNull())


def explode_acks(valid: DataFrame) -> DataFrame:
    """One row per acknowledged id."""
    return valid.select("stream", F.explode("ids").alias("id"), "ack")


def ack_dedup(acks: DataFrame, keep: str = "1 day") -> DataFrame:
    """Repeated acks have the effect of one; on a stream, within ``keep`` of receipt."""
    return first_received(acks, [*_KEY, "ack"], keep)


def accumulate_acks(valid: DataFrame, part_messages: int = 1024) -> DataFrame:
    """Per stream: acked ids in arrival order and the count of refused ids.

    A hot stream's ids would not fit one row, so they come in parts: ``part``
    counts runs of ``part_messages`` arrival numbers (unique within a stream).
    """
    require_positive(part_messages=part_messages)
    part = floor_div(F.col("arrival"), part_messages)
    acked = F.sort_array(F.collect_list(F.when(F.col("ack"), F.struct("arrival", "ids"))))
    return (
        valid.groupBy("stream", part.alias("part"))
        .agg(
            F.flatten(F.transform(acked, lambda m: m["ids"])).alias("ack_ids"),
            F.sum(F.when(F.col("ack"), 0).otherwise(F.size("ids"))).alias("nack_count"),
        )
    )


def positive_ids(acks: DataFrame) -> DataFrame:
    """Distinct settled (stream, id) of exploded acks.

    The distinct combines on the map side, so an id acknowledged very often
    reaches the joins once, and its shuffle is the one that the joins need. An
    ack without a stream name is an error.
    """
    stream = F.when(
        F.col("stream") == "", F.raise_error(F.lit("cannot settle: stream name is empty"))
    ).otherwise(F.col("stream"))
    return acks.select(stream.alias("stream"), "id", "ack").filter("ack").select(*_KEY).distinct()


def apply_acks(
    entries: DataFrame, deliveries: DataFrame, acks: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Settle: positively acked entries leave the store and the pending set.

    ``acks`` is one row per id. An id that was never pending is settled, too;
    applying the same acks again changes nothing. The settled ids are written
    once for both joins: acks are not decoded again, and with the size known
    the store is not shuffled when a round's acks are few.
    """
    settled = written(positive_ids(acks), "settled")
    return entries.join(settled, _KEY, "left_anti"), pending_rows(deliveries, settled)


def pending_rows(deliveries: DataFrame, settled: DataFrame) -> DataFrame:
    return deliveries.join(settled, _KEY, "left_anti")


def nacked(deliveries: DataFrame, acks: DataFrame) -> DataFrame:
    """Refused deliveries that stay pending; an ack for the same id wins.

    One aggregation decides each id, so deliveries join once.
    """
    refused = (
        acks.groupBy(*_KEY).agg(F.max("ack").alias("_acked")).filter(~F.col("_acked"))
    )
    return deliveries.join(refused.select(*_KEY), _KEY, "left_semi")


def sorted_ids(ids: Column) -> Column:
    """Ids of an array in stream order."""
    pairs = F.sort_array(F.transform(ids, lambda i: F.struct(id_pair(i).alias("p"), i.alias("i"))))
    return F.transform(pairs, lambda s: s["i"])
