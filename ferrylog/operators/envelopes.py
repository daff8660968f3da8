"""Pack payload lines into compressed envelopes and unpack them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrylog.functions.body import split_line
from ferrylog.functions.numbers import floor_div
from ferrylog.functions.zstd import zstd_pack, zstd_unpack
from ferrylog.operators.positions import with_position
from ferrylog.schema import BATCH_SIZE, MAX_DECOMPRESS_BYTES, MAX_ENVELOPE_BYTES, require_positive
from ferrylog.streaming.receipt import first_received


def number_batches(lines: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Add ``batch``: consecutive runs of ``batch_size`` entries of a stream.

    Rows that already carry their ``position``, as a read batch does, are not
    numbered again.
    """
    require_positive(batch_size=batch_size)
    numbered = lines if "position" in lines.columns else with_position(lines)
    return numbered.withColumn("batch", floor_div(F.col("position") - 1, batch_size))


def batch_texts(
    lines: DataFrame, batch_size: int = BATCH_SIZE, max_bytes: int = MAX_ENVELOPE_BYTES
) -> DataFrame:
    """Envelopes before compression, with ``body`` as newline-joined lines.

    A null line marks an entry without a body: it takes a place in its batch
    and is counted, but not published. A batch without lines gives nothing.
    A batch of more than ``max_bytes`` comes in several envelopes, so that every
    list is bounded in lines and bytes and no reader's cap is met.
    """
    ordered = F.sort_array(
        F.collect_list(F.when(F.col("line").isNotNull(), F.struct("position", "line")))
    )
    joined = F.array_join(F.transform(ordered, lambda r: r["line"]), "\n")
    columns = [c for c in ("id", "stream", "line", "position") if c in lines.columns]
    ahead = Window.partitionBy("stream", "batch").orderBy("position")
    ahead = ahead.rowsBetween(Window.unboundedPreceding, -1)
    size = F.coalesce(F.octet_length("line") + 1, F.lit(0)).cast("bigint")
    part = floor_div(F.coalesce(F.sum(size).over(ahead), F.lit(0)), max_bytes)
    return (
        number_batches(lines.select(*columns), batch_size)
        .withColumn("_part", part)
        .groupBy("stream", "batch", "_part")
        .agg(
            F.count("line").alias("n_lines"),
            (F.count(F.lit(1)) - F.count("line")).alias("n_skipped"),
            joined.alias("body"),
        )
        .filter(F.col("n_lines") > 0)
        .drop("_part")
        .withColumn("raw_bytes", F.octet_length("body").cast("bigint"))
    )


def pack_envelopes(
    lines: DataFrame, batch_size: int = BATCH_SIZE, max_bytes: int = MAX_ENVELOPE_BYTES
) -> DataFrame:
    """One zstd frame per stream and batch, more for a batch of many bytes."""
    return batch_texts(lines, batch_size, max_bytes).select(
        "stream", "batch", "n_lines", "n_skipped", "raw_bytes", zstd_pack(F.col("body")).alias("payload")
    )


def unpack_envelopes(
    envelopes: DataFrame, max_bytes: int = MAX_DECOMPRESS_BYTES
) -> DataFrame:
    """Lines of all envelopes; a frame that cannot be decoded gives none."""
    text = _decoded(max_bytes)
    return (
        envelopes.select(text.alias("body"))
        .filter(F.col("body").isNotNull())
        .select(F.explode(F.split("body", "\n")).alias("line"))
        .select(split_line(F.col("line")).alias("p"), "line")
        .select("p.id", "p.stream", "p.json", "line")
    )


def rejected_envelopes(
    envelopes: DataFrame, max_bytes: int = MAX_DECOMPRESS_BYTES
) -> DataFrame:
    """Envelopes whose frame is damaged or above the cap, without payload."""
    return (
        envelopes.withColumn("_body", _decoded(max_bytes))
        .filter(F.col("_body").isNull())
        .drop("_body", "payload")
    )


def _decoded(max_bytes: int) -> Column:
    return zstd_unpack(F.col("payload"), max_bytes).cast("string")


def dedup_received(lines: DataFrame, keep: str = "1 day") -> DataFrame:
    """One copy per (stream, id); on a stream, of those received within ``keep``."""
    return first_received(lines, ["stream", "id"], keep)
