"""Stream lists and read cursors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.functions.ids import id_ms, id_pair, id_seq
from ferrylog.operators.positions import first_per_stream
from ferrylog.schema import BATCH_SIZE, require_positive
from ferrylog.session import written


def discover_streams(entries: DataFrame) -> DataFrame:
    """Names of all streams present; none for an empty table."""
    return entries.select("stream").distinct()


def refresh_streams(
    previous: DataFrame, discovered: DataFrame, single_stream: bool = False
) -> DataFrame:
    """Each stream name with ``change``: new, removed or kept.

    Streams that are new or kept form the list from now on. A reader bound to
    one stream never refreshes: all its names are kept.
    """
    if single_stream:
        return previous.select("stream", F.lit("kept").alias("change"))
    before = previous.select("stream", F.lit(True).alias("_was"))
    now = discovered.select("stream", F.lit(True).alias("_is"))
    return before.join(now, "stream", "full_outer").select(
        "stream",
        F.when(F.col("_was").isNull(), "new")
        .when(F.col("_is").isNull(), "removed")
        .otherwise("kept")
        .alias("change"),
    )


def unread(entries: DataFrame, cursors: DataFrame) -> DataFrame:
    """Entries above their stream's cursor; all entries where there is none."""
    at = cursors.select(
        "stream", F.struct("id_ms", "id_seq").alias("_cursor")
    )
    return (
        entries.join(at, "stream", "left")
        .filter(F.col("_cursor").isNull() | (id_pair("id") > F.col("_cursor")))
        .drop("_cursor")
    )


def read_new(
    entries: DataFrame, cursors: DataFrame, batch_size: int = BATCH_SIZE
) -> tuple[DataFrame, DataFrame]:
    """Next batch: at most ``batch_size`` lowest unread entries per stream.

    Returns the rows, with their ``position`` in the batch, and the cursors as
    they stand after them. The batch is written to the scratch folder: it is
    small next to the store, and every later step reads it.
    """
    require_positive(batch_size=batch_size)
    rows = written(first_per_stream(unread(entries, cursors), batch_size), "batch")
    return rows, advance_cursors(cursors, rows)


def advance_cursors(cursors: DataFrame, rows: DataFrame) -> DataFrame:
    """Highest id per stream of the old cursors and the rows read."""
    seen = rows.select("stream", id_ms("id").alias("id_ms"), id_seq("id").alias("id_seq"))
    return (
        cursors.select("stream", "id_ms", "id_seq")
        .unionByName(seen)
        .groupBy("stream")
        .agg(F.max(F.struct("id_ms", "id_seq")).alias("top"))
        .select("stream", "top.id_ms", "top.id_seq")
    )
