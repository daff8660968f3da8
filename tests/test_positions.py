"""Exact positions against brute force, with hot streams and hot milliseconds."""

import random

import pytest
from pyspark.sql import functions as F

from ferrylog.operators.positions import first_per_stream, with_position


def sample(seed):
    """A third of all rows in one millisecond of one stream; a few odd ids."""
    rng = random.Random(seed)
    rows = {("hot", f"1000000-{i * 70_000 % 900_001}") for i in range(300)}
    while len(rows) < 900:
        stream = rng.choice(["hot", "hot", "a", "b"])
        rows.add((stream, f"{rng.randrange(10**7)}-{rng.randrange(5)}"))
    rows |= {("a", "odd"), ("b", "-"), ("lone", "5-0")}
    return sorted(rows)


def key(id_):
    parts = id_.split("-")

    def number(i):
        return int(parts[i]) if len(parts) > i and parts[i].isdigit() else -1

    return number(0), number(1)


def expected(rows):
    out = {}
    for stream in {s for s, _ in rows}:
        for n, id_ in enumerate(sorted((i for s, i in rows if s == stream), key=key), 1):
            out[stream, id_] = n
    return out


@pytest.mark.parametrize("span_rows", [1 << 20, 10])
def test_positions(spark, span_rows):
    rows = sample(1)
    df = spark.createDataFrame(rows, "stream string, id string").repartition(7)
    got = with_position(df, span_rows=span_rows)
    assert got.columns == ["stream", "id", "position"]
    assert {(r.stream, r.id): r.position for r in got.collect()} == expected(rows)


@pytest.mark.parametrize("span_rows", [1 << 20, 10])
@pytest.mark.parametrize("limit", [1, 150, 5000])
def test_first_per_stream(spark, span_rows, limit):
    rows = sample(2)
    df = spark.createDataFrame(rows, "stream string, id string").repartition(7)
    got = first_per_stream(df, limit, span_rows=span_rows).collect()
    want = {k: n for k, n in expected(rows).items() if n <= limit}
    assert {(r.stream, r.id): r.position for r in got} == want


def test_other_order_and_empty_input(spark):
    df = spark.createDataFrame([("s", 3), ("s", 1), ("s", 2)], "stream string, at bigint")
    got = with_position(df, F.col("at"), F.lit(0)).collect()
    assert {r.at: r.position for r in got} == {1: 1, 2: 2, 3: 3}
    empty = spark.createDataFrame([], "stream string, id string")
    assert with_position(empty).count() == 0 and first_per_stream(empty, 5).count() == 0
    with pytest.raises(ValueError):
        first_per_stream(empty, 0)


def test_no_task_per_stream(spark):
    """Rows are shuffled on (stream, span) or by cell, never on stream alone."""
    df = spark.createDataFrame(sample(3), "stream string, id string")
    for span_rows in (1 << 20, 10):
        plan = with_position(df, span_rows=span_rows)._jdf.queryExecution().executedPlan().toString()
        assert "row_number() windowspecdefinition(stream" in plan
        windows = [x for x in plan.splitlines() if "row_number()" in x and "Window" in x]
        assert windows and all("_span" in x for x in windows)
