"""Exact positions in stream order without one task per stream.

``row_number`` partitioned by stream would sort a hot stream in a single task.
Here time is cut into spans. A first small job counts the rows of each (stream,
span) and writes, per span, how many rows come before it; the count shrinks to
almost nothing before its shuffle. Rows then meet that table and are numbered
span by span: one shuffle of the rows, on (stream, span). The table's size is
known once it is written, so Spark broadcasts it when it is small and joins by
shuffle, on the same keys as the numbering, when it is not.

Spans are 2^20 ms (17 minutes) wide. Should one hold more than 2^20 rows, the
count is taken again for spans of 2^12 ms (4 seconds), and should one of those
be crowded, too, rows are numbered in cells: one millisecond and 2^16 sequence
numbers. Ids are unique in their stream, so a cell is bounded even when a third
of all rows share one millisecond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrylog.functions.ids import id_ms, id_seq
from ferrylog.schema import require_positive
from ferrylog.session import written

_SPAN_BITS = (20, 12)
_PART_BITS = 16
_SPAN_ROWS = 1 << 20
_SPAN = ["stream", "_span"]
_CELL = ["stream", "_span", "_major", "_part"]


def with_position(
    df: DataFrame,
    major: Column | None = None,
    minor: Column | None = None,
    span_rows: int = _SPAN_ROWS,
) -> DataFrame:
    """Add ``position``, the 1-based place of each row in its stream's order.

    The order is (``major``, ``minor``), by default the id's pair of numbers;
    a key that is not a number sorts first. Runs the counting job at once.
    """
    return _number(_keyed(df, major, minor), span_rows)


def first_per_stream(
    df: DataFrame,
    limit: int,
    major: Column | None = None,
    minor: Column | None = None,
    span_rows: int = _SPAN_ROWS,
) -> DataFrame:
    """The ``limit`` lowest rows of each stream, exactly, with ``position``.

    Only spans that can hold one of them are written, so all other rows are
    dropped where they are read. Runs the counting job at once.
    """
    require_positive(limit=limit)
    numbered = _number(_keyed(df, major, minor), span_rows, limit)
    return numbered.filter(F.col("position") <= limit)


def _keyed(df: DataFrame, major: Column | None, minor: Column | None) -> DataFrame:
    major = id_ms("id") if major is None else major
    minor = id_seq("id") if minor is None else minor
    return df.withColumns(
        {"_major": F.coalesce(major, F.lit(-1)), "_minor": F.coalesce(minor, F.lit(-1))}
    )


def _before(counts: DataFrame, within: list[str], order: list[str]) -> DataFrame:
    """Rows counted ahead of each row of ``counts``."""
    ahead = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))


def _span_table(rows: DataFrame, limit: int | None) -> DataFrame:
    counts = rows.groupBy(*_SPAN).agg(F.count(F.lit(1)).alias("_n"))
    table = _before(counts, ["stream"], ["_span"])
    return table if limit is None else table.filter(F.col("_before") < limit)


def _number(keyed: DataFrame, span_rows: int, limit: int | None = None) -> DataFrame:
    for bits in _SPAN_BITS:
        rows = keyed.withColumn("_span", F.shiftright("_major", bits))
        spans = written(_span_table(rows, limit), "spans")
        crowded = (spans.agg(F.max("_n")).first()[0] or 0) > span_rows
        if not crowded:
            break
    starts = spans.select(*_SPAN, "_before")
    if crowded:
        group, order = _CELL, ["_minor"]
        cut = rows.withColumn("_part", F.shiftright("_minor", _PART_BITS))
        cells = _cell_starts(cut, starts)
        if limit is not None:
            cut = cut.join(starts.select(*_SPAN), _SPAN, "left_semi")
            cells = cells.filter(F.col("_before") < limit)
        joined = cut.join(cells, _CELL)
    else:
        group, order = _SPAN, ["_major", "_minor"]
        joined = rows.join(starts, _SPAN)
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return joined.withColumn("position", F.col("_before") + place).drop(
        "_before", "_span", "_major", "_minor", "_part"
    )


def _cell_starts(cut: DataFrame, span_starts: DataFrame) -> DataFrame:
    """Rows before each cell: within its span, and before the span."""
    cells = (
        cut.select(*_CELL)
        .join(span_starts.withColumnRenamed("_before", "_ahead"), _SPAN)
        .groupBy(*_CELL)
        .agg(F.count(F.lit(1)).alias("_n"), F.first("_ahead").alias("_ahead"))
    )
    return _before(cells, _SPAN, ["_major", "_part"]).select(
        *_CELL, (F.col("_ahead") + F.col("_before")).alias("_before")
    )
