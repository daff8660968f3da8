"""Entry ids: ``<epoch ms>-<sequence>``, ordered as a pair of numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_ms(col: Column | str) -> Column:
    """Millisecond part of an id, null when it is not a number."""
    return F.split_part(_c(col), F.lit("-"), F.lit(1)).try_cast("bigint")


def id_seq(col: Column | str) -> Column:
    """Sequence part of an id, null when it is not a number."""
    return F.split_part(_c(col), F.lit("-"), F.lit(2)).try_cast("bigint")


def id_time(col: Column | str) -> Column:
    """Event time carried by an id."""
    return F.timestamp_millis(id_ms(col))


def id_pair(col: Column | str) -> Column:
    """The id as a struct that sorts in stream order."""
    return F.struct(id_ms(col).alias("id_ms"), id_seq(col).alias("id_seq"))


def parse_id(df: DataFrame, col: str = "id") -> DataFrame:
    """Add ``id_ms``, ``id_seq`` and ``event_time``."""
    return df.withColumns(
        {"id_ms": id_ms(col), "id_seq": id_seq(col), "event_time": id_time(col)}
    )


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
