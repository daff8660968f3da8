"""Zstandard frames. Spark has no SQL function for them, hence Arrow UDFs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ferrylog.schema import MAX_DECOMPRESS_BYTES, ZSTD_MAGIC_HEX, require_positive

# Both UDFs count as non-deterministic for the planner: otherwise a filter on
# their result is moved below them and every frame is coded twice.

# Input is fed in small slices so that a frame that expands without bound is
# noticed soon after it passes the cap.
_SLICE = 4096

# A batch that comes in holds as many bytes as the session says (``prepare``); batches
# that go out are cut at this size, since frames may grow many times over. So a worker
# holds a few times this much, or its largest value, however long its partition is.
_BATCH_BYTES = 4 * 1024 * 1024


def is_compressed(col: Column) -> Column:
    """True when the bytes start with the zstd magic number."""
    return F.coalesce(F.hex(F.substring(col, 1, 4)) == ZSTD_MAGIC_HEX, F.lit(False))


def unpack(data: bytes, max_bytes: int) -> bytes | None:
    """Decode whole frames; None when damaged, cut short or above the cap."""
    import zstandard

    out: list[bytes] = []
    total = 0
    rest = data
    try:
        while rest:
            decoder = zstandard.ZstdDecompressor().decompressobj()
            at = 0
            while at < len(rest) and not decoder.eof:
                chunk = decoder.decompress(rest[at : at + _SLICE])
                at += _SLICE
                total += len(chunk)
                if total > max_bytes:
                    return None
                out.append(chunk)
            if not decoder.eof:
                return None
            rest = decoder.unused_data + rest[at:]
    except zstandard.ZstdError:
        return None
    return b"".join(out)


def _cut(values: Iterator[bytes | None]) -> Iterator[pa.Array]:
    """The values in arrays of about ``_BATCH_BYTES``, each made when it is asked for."""
    done: list[bytes | None] = []
    size = 0
    for value in values:
        done.append(value)
        size += len(value or b"")
        if size >= _BATCH_BYTES:
            yield pa.array(done, pa.binary())
            done, size = [], 0
    yield pa.array(done, pa.binary())


def zstd_pack(col: Column) -> Column:
    """One zstd frame per value: fastest level, no checksum."""

    @F.arrow_udf("binary")
    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import zstandard

        encoder = zstandard.ZstdCompressor(level=1, write_checksum=False)
        for values in batches:
            yield from _cut(
                encoder.compress(v.as_buffer()) if v.is_valid else None for v in values
            )

    return pack.asNondeterministic()(col.cast("binary"))


def zstd_unpack(col: Column, max_bytes: int = MAX_DECOMPRESS_BYTES) -> Column:
    """Decoded bytes; null for null, damaged or oversized input."""
    require_positive(max_bytes=max_bytes)

    @F.arrow_udf("binary")
    def unpacked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            yield from _cut(unpack(v.as_py(), max_bytes) if v.is_valid else None for v in values)

    return unpacked.asNondeterministic()(col)
