"""Stream hash used to spread acknowledgements over shards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferrylog.schema import ACK_SHARDS, FNV_OFFSET, FNV_PRIME, require_positive


def fnv1a_32(col: Column) -> Column:
    """32-bit FNV-1a over the UTF-8 bytes of a string, as bigint.

    Reading the bytes as ISO-8859-1 gives one character per byte, so the byte
    values are plain character codes.
    """
    latin = F.decode(F.encode(col, "UTF-8"), "ISO-8859-1")
    codes = F.transform(F.split(latin, ""), F.ascii)
    mixed = F.aggregate(
        codes,
        F.lit(FNV_OFFSET).cast("bigint"),
        lambda h, b: (h.bitwiseXOR(b.cast("bigint")) * F.lit(FNV_PRIME)).bitwiseAND(
            F.lit(0xFFFFFFFF)
        ),
    )
    return F.when(col == "", F.lit(FNV_OFFSET).cast("bigint")).otherwise(mixed)


def ack_shard(col: Column, shards: int = ACK_SHARDS) -> Column:
    """Shard number of a stream; equal streams always share a shard."""
    require_positive(shards=shards)
    return fnv1a_32(col) % F.lit(shards)
