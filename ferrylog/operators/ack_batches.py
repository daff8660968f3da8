"""Exact count-triggered batches of acknowledgements.

A stream's acks accumulate in arrival order and are flushed as soon as the
accumulated ids reach ``max_ids``; the sum then starts again at zero and no
message is split. The sum's reset makes this a walk over the whole stream, yet
the walk has only ``max_ids`` states (ids accumulated so far), so a run of
messages is a map from entry state to exit state and number of flushes, and
such maps compose:

1. each run of messages gives its map (parallel),
2. maps are composed per group of runs, and groups are walked per stream,
3. with its entry state known, each run numbers its batches (parallel).

No task ever sees more than one run, one group of maps, or the group totals of
a stream. Runs are cut by position, not by arrival number, so that they are full
however sparse a stream's arrivals are. Only arrival, position and number of ids
of a message travel to Python. Positions and maps are read twice, so they are
written to the scratch folder; the maps take less than a byte per message.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylog.functions.numbers import floor_div
from ferrylog.operators.positions import with_position
from ferrylog.schema import ACK_BATCH_SIZE, require_positive
from ferrylog.session import written

_RUN_MESSAGES = 4096
_GROUP_RUNS = 1024
_MAP = "ends array<int>, flushes array<bigint>"


def flush_points(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Running sums with a leading zero, and for a flush after message j the
    message (1-based) of the next flush; past the end when there is none."""
    sums = np.concatenate(([0], np.cumsum(sizes)))
    return sums, np.searchsorted(sums, sums + limit, side="left")


def run_map(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Exit state and flush count of a run for every entry state."""
    sums, following = flush_points(sizes, limit)
    states = np.arange(limit)
    at = np.searchsorted(sums, limit - states, side="left")
    flushes = np.zeros(limit, dtype=np.int64)
    ends = states + sums[-1]
    live = at < len(sums)
    while live.any():
        flushes[live] += 1
        ends[live] = sums[-1] - sums[at[live]]
        at[live] = following[at[live]]
        live = at < len(sums)
    return ends.astype(np.int32), flushes


def run_batches(sizes: np.ndarray, limit: int, state: int, first: int) -> np.ndarray:
    """Batch number of every message of a run entered with ``state``."""
    sums, following = flush_points(sizes, limit)
    points = []
    at = int(np.searchsorted(sums, limit - state, side="left"))
    while at < len(sums):
        points.append(at)
        at = int(following[at])
    places = np.arange(1, len(sums))
    return first + np.searchsorted(np.array(points, dtype=np.int64), places, side="left")


def _matrix(table: pa.Table, name: str, limit: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in table.column(name).chunks])
    return flat.to_numpy(zero_copy_only=False).reshape(-1, limit)


def _rows(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array([values.tolist()], pa.list_(kind))


def ack_batches(valid: DataFrame, max_ids: int = ACK_BATCH_SIZE) -> DataFrame:
    """Flushes per stream: batch number, acked ids and count of refused ids.

    ``arrival`` orders the messages and is unique within a stream, like a
    broker offset; what is left at the end of a stream is its last batch.
    """
    return collect_batches(number_ack_batches(valid, max_ids))


def number_ack_batches(valid: DataFrame, max_ids: int = ACK_BATCH_SIZE) -> DataFrame:
    """Add ``batch`` to every ack message."""
    require_positive(max_ids=max_ids)
    run_length = max(_RUN_MESSAGES, 16 * max_ids)
    messages = valid.select("stream", "arrival", "ids", "ack")
    sizes = messages.select(
        "stream", F.col("arrival").cast("bigint").alias("arrival"), F.size("ids").cast("bigint").alias("n")
    )
    placed = with_position(sizes, F.col("arrival"), F.lit(0))
    run = floor_div(F.col("position") - 1, run_length).alias("run")
    placed = written(placed.select("stream", run, "arrival", "n"), "placed")

    def to_map(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ordered = table.sort_by("arrival")
        ends, flushes = run_map(ordered.column("n").to_numpy(), max_ids)
        return pa.table(
            {
                "stream": pa.array([key[0].as_py()], pa.string()),
                "run": pa.array([key[1].as_py()], pa.int64()),
                "ends": _rows(ends, pa.int32()),
                "flushes": _rows(flushes, pa.int64()),
            }
        )

    maps = written(
        placed.groupBy("stream", "run")
        .applyInArrow(to_map, f"stream string, run bigint, {_MAP}")
        .withColumn("grp", floor_div(F.col("run"), _GROUP_RUNS)),
        "maps",
    )

    def compose(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ordered = table.sort_by("run")
        ends, flushes = _matrix(ordered, "ends", max_ids), _matrix(ordered, "flushes", max_ids)
        state = np.arange(max_ids)
        total = np.zeros(max_ids, dtype=np.int64)
        for e, f in zip(ends, flushes):
            total += f[state]
            state = e[state]
        return pa.table(
            {
                "stream": pa.array([key[0].as_py()], pa.string()),
                "grp": pa.array([key[1].as_py()], pa.int64()),
                "ends": _rows(state, pa.int32()),
                "flushes": _rows(total, pa.int64()),
            }
        )

    def walk(table: pa.Table, step: str, state: int, first: int) -> pa.Table:
        ordered = table.sort_by(step)
        ends, flushes = _matrix(ordered, "ends", max_ids), _matrix(ordered, "flushes", max_ids)
        states, firsts = [], []
        for e, f in zip(ends, flushes):
            states.append(state)
            firsts.append(first)
            first += int(f[state])
            state = int(e[state])
        return pa.table(
            {
                "stream": ordered.column("stream"),
                step: ordered.column(step),
                "state": pa.array(states, pa.int32()),
                "first": pa.array(firsts, pa.int64()),
            }
        )

    def walk_groups(table: pa.Table) -> pa.Table:
        return walk(table, "grp", 0, 0)

    def walk_runs(table: pa.Table) -> pa.Table:
        return walk(table, "run", table.column("state")[0].as_py(), table.column("first")[0].as_py())

    groups = (
        maps.groupBy("stream", "grp")
        .applyInArrow(compose, f"stream string, grp bigint, {_MAP}")
        .groupBy("stream")
        .applyInArrow(walk_groups, "stream string, grp bigint, state int, first bigint")
    )
    runs = (
        maps.join(groups, ["stream", "grp"])
        .groupBy("stream", "grp")
        .applyInArrow(walk_runs, "stream string, run bigint, state int, first bigint")
    )

    def number(table: pa.Table) -> pa.Table:
        ordered = table.sort_by("arrival")
        batch = run_batches(
            ordered.column("n").to_numpy(),
            max_ids,
            ordered.column("state")[0].as_py(),
            ordered.column("first")[0].as_py(),
        )
        return ordered.select(["stream", "arrival"]).append_column(
            "batch", pa.array(batch, pa.int64())
        )

    numbers = (
        placed.join(runs, ["stream", "run"])
        .groupBy("stream", "run")
        .applyInArrow(number, "stream string, arrival bigint, batch bigint")
    )
    return messages.join(numbers, ["stream", "arrival"])


def collect_batches(numbered: DataFrame) -> DataFrame:
    """One row per batch; its id list is bounded by the flush limit."""
    acked = F.sort_array(F.collect_list(F.when(F.col("ack"), F.struct("arrival", "ids"))))
    return numbered.groupBy("stream", "batch").agg(
        F.count(F.lit(1)).alias("messages"),
        F.flatten(F.transform(acked, lambda m: m["ids"])).alias("ack_ids"),
        F.sum(F.when(F.col("ack"), 0).otherwise(F.size("ids"))).alias("nack_count"),
    )
