"""Table schemas, default knobs and fixed values shared by all modules."""

from __future__ import annotations

from pyspark.sql import types as T

WIRE_ENTRIES = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
    ]
)
ENTRIES = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("object", T.StringType()),
        T.StructField("raw", T.StringType()),
        T.StructField("stream", T.StringType()),
    ]
)
LINES = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("stream", T.StringType()),
        T.StructField("line", T.StringType()),
    ]
)
ENVELOPES = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_skipped", T.LongType()),
        T.StructField("raw_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
ACK_PAYLOADS = T.StructType(
    [
        T.StructField("arrival", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
ACKS = T.StructType(
    [
        T.StructField("arrival", T.LongType()),
        T.StructField("stream", T.StringType()),
        T.StructField("ids", T.ArrayType(T.StringType())),
        T.StructField("ack", T.BooleanType()),
    ]
)
DELIVERIES = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("consumer", T.StringType()),
        T.StructField("delivered_at_ms", T.LongType()),
    ]
)
CONSUMERS = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("consumer", T.StringType()),
        T.StructField("last_seen_ms", T.LongType()),
    ]
)
CURSORS = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("id_ms", T.LongType()),
        T.StructField("id_seq", T.LongType()),
    ]
)
STREAMS = T.StructType([T.StructField("stream", T.StringType())])
COMPONENTS = T.StructType(
    [
        T.StructField("component", T.StringType()),
        T.StructField("ok", T.BooleanType()),
        T.StructField("message", T.StringType()),
    ]
)

# Default knobs; every one is an argument of the operator that uses it.
BATCH_SIZE = 20_000
CLAIM_IDLE_MS = 10_000
CONSUMER_IDLE_TIMEOUT_MS = 300_000
ACK_BATCH_SIZE = 256
ACK_FLUSH_MS = 10
ACK_SHARDS = 50
MAX_DECOMPRESS_BYTES = 256 * 1024 * 1024
#: Lines go on in a new envelope from here on; one line may come on top.
MAX_ENVELOPE_BYTES = MAX_DECOMPRESS_BYTES // 4

# Syslog severity names in the order of their codes 0 to 7.
SEVERITY_NAMES = (
    "EMERGENCY",
    "ALERT",
    "CRITICAL",
    "ERROR",
    "WARNING",
    "NOTICE",
    "INFO",
    "DEBUG",
)
SEVERITY_FALLBACK = "INFO"

# First four bytes of a zstd frame (RFC 8878); 32-bit FNV-1a.
ZSTD_MAGIC_HEX = "28B52FFD"
FNV_OFFSET = 2166136261
FNV_PRIME = 16777619

# Owner of a delivery whose consumer was dropped.
RELEASED = ""

# What stands in a payload line for an entry without raw text.
EMPTY_RAW = "-"


def require_positive(**knobs: int) -> None:
    """Reject knobs below one, naming the first offender."""
    for name, value in knobs.items():
        if value < 1:
            raise ValueError(f"{name} must be positive, got {value}")
