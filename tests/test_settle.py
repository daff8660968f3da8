"""Acknowledgements: batching, settling and their invariants."""

import json
import random

import numpy as np
import pytest
import zstandard
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ferrylog.operators import ack_batches as ab
from ferrylog.operators import settle as st

ACK = "arrival bigint, stream string, ids array<string>, ack boolean"
DELIVERY = "stream string, id string, consumer string, delivered_at_ms bigint"
ROW = "stream string, id string, ack boolean"


def walk(messages, limit):
    """Reference walk: (batch, ids, nacks, messages) in arrival order."""
    out, ids, nacks, n = [], [], 0, 0
    for _, got, ack in sorted(messages):
        n += 1
        if ack:
            ids += got
        else:
            nacks += len(got)
        if len(ids) + nacks >= limit:
            out.append((len(out), ids, nacks, n))
            ids, nacks, n = [], 0, 0
    if n:
        out.append((len(out), ids, nacks, n))
    return out


def batches_of(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.stream, []).append((r.batch, r.ack_ids, r.nack_count, r.messages))
    return {s: sorted(b) for s, b in out.items()}


def messages_of(sizes, ack=lambda n: True):
    return [(n, [f"{n}-{i}" for i in range(size)], ack(n)) for n, size in enumerate(sizes)]


def test_golden_batches(spark):
    messages = messages_of([100, 100, 100, 50, 300, 10])
    df = spark.createDataFrame([(a, "s", i, k) for a, i, k in messages], ACK)
    got = batches_of(ab.ack_batches(df))["s"]
    assert [len(ids) for _, ids, _, _ in got] == [300, 350, 10]
    assert got == walk(messages, 256)


@pytest.mark.parametrize("limit", [1, 7, 64])
def test_batches_against_walk(spark, monkeypatch, limit):
    """Runs and groups are made short, so that states cross many borders."""
    monkeypatch.setattr(ab, "_RUN_MESSAGES", 8)
    monkeypatch.setattr(ab, "_GROUP_RUNS", 3)
    rng = random.Random(limit)
    streams = {
        "hot": messages_of([rng.randint(1, 20) for _ in range(1500)], lambda n: n % 3 != 0),
        "ones": messages_of([1] * 200),
        "few": messages_of([500]),
    }
    rows = [(a * 2, s, i, k) for s, ms in streams.items() for a, i, k in ms]
    rng.shuffle(rows)
    got = batches_of(ab.ack_batches(spark.createDataFrame(rows, ACK).repartition(5), limit))
    assert got == {s: walk(ms, limit) for s, ms in streams.items()}


def test_sparse_arrivals_and_required_ids(spark, monkeypatch):
    """Few messages far apart make full runs; ids may be a type without nulls."""
    rows = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("stream"),
        (F.col("id") * 5000).alias("arrival"),
        F.array(F.concat(F.lit("x"), F.col("id"))).alias("ids"),
        F.lit(True).alias("ack"),
    )
    stored = {}
    real = ab.written
    monkeypatch.setattr(ab, "written", lambda df, label: stored.setdefault(label, real(df, label)))
    got = ab.ack_batches(rows, 16).collect()
    assert stored["maps"].count() == 2
    for stream, of_stream in (("a", range(0, 400, 3)), ("b", [n for n in range(400) if n % 3])):
        parts = sorted((r.batch, r.ack_ids) for r in got if r.stream == stream)
        ids = [f"x{n}" for n in of_stream]
        assert [i for _, p in parts for i in p] == ids
        assert [len(p) for _, p in parts[:-1]] == [16] * (len(ids) // 16 - (len(ids) % 16 == 0))


def test_run_maps_compose():
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 40, 200)
    whole, counts = ab.run_map(sizes, 64)
    first, n1 = ab.run_map(sizes[:77], 64)
    second, n2 = ab.run_map(sizes[77:], 64)
    assert (second[first] == whole).all() and (n1 + n2[first] == counts).all()


def test_accumulated_lists_come_in_parts(spark):
    messages = messages_of([2] * 50, lambda n: n % 5 != 0)
    df = spark.createDataFrame([(a, "s", i, k) for a, i, k in messages], ACK)
    parts = {r.part: (r.ack_ids, r.nack_count) for r in st.accumulate_acks(df, 20).collect()}
    for part, low in ((0, 0), (1, 20), (2, 40)):
        mine = messages[low : low + 20]
        assert parts[part] == (
            [x for _, ids, k in mine if k for x in ids],
            sum(len(ids) for _, ids, k in mine if not k),
        )
    assert sorted(parts) == [0, 1, 2]


def test_payloads_plain_and_compressed(spark):
    body = json.dumps({"ids": ["1-0", "2-0"], "stream": "s", "ack": True}).encode()
    cut = zstandard.ZstdCompressor().compress(body)[:-2]
    rows = [(1, body), (2, zstandard.ZstdCompressor().compress(body)), (3, cut), (4, b"{"), (5, None)]
    df = spark.createDataFrame(rows, "arrival bigint, payload binary")
    valid, rejected = st.validate_ack(st.read_acks(df))
    assert sorted((r.arrival, r.ids, r.stream, r.ack) for r in valid.collect()) == [
        (1, ["1-0", "2-0"], "s", True),
        (2, ["1-0", "2-0"], "s", True),
    ]
    assert {r.arrival: r.reject_reason for r in rejected.collect()} == {
        3: "undecodable",
        4: "malformed",
        5: "undecodable",
    }
    assert st.explode_acks(valid).count() == 4


@pytest.fixture
def store(spark, entries_of):
    rng = random.Random(11)
    keys = [(rng.choice("ab"), f"{n}-0") for n in range(400)]
    entries = entries_of([(i, s, "{}", "r") for s, i in keys])
    sent = [k for k in keys if rng.random() < 0.7]
    deliveries = spark.createDataFrame([(s, i, "c", 0) for s, i in sent], DELIVERY)
    acks = [(s, i, rng.random() < 0.6) for s, i in rng.choices(keys, k=500)]
    acks += [("a", "999-0", True)]
    return keys, sent, entries, deliveries, acks


def rows(df):
    return sorted((r.stream, r.id) for r in df.collect())


def test_settling(spark, store):
    keys, sent, entries, deliveries, acks = store
    df = spark.createDataFrame(acks, ROW)
    settled = {(s, i) for s, i, k in acks if k}
    left, pending = st.apply_acks(entries, deliveries, df)
    assert rows(left) == sorted(k for k in keys if k not in settled)
    assert rows(pending) == sorted(k for k in sent if k not in settled)
    again, pending_again = st.apply_acks(left, pending, df.unionByName(df))
    assert rows(again) == rows(left) and rows(pending_again) == rows(pending)
    refused = {(s, i) for s, i, k in acks if not k} - settled
    assert rows(st.nacked(deliveries, df)) == sorted(k for k in sent if k in refused)
    none = df.filter("false")
    assert rows(st.apply_acks(entries, deliveries, none)[0]) == sorted(keys)
    assert st.ack_dedup(df.unionByName(df)).count() == len(set(acks))


def test_one_id_acknowledged_very_often(spark, store):
    keys, _, entries, deliveries, _ = store
    often = spark.range(20_000).selectExpr(f"'{keys[0][0]}' AS stream", f"'{keys[0][1]}' AS id", "true AS ack")
    left, _ = st.apply_acks(entries, deliveries, often)
    assert rows(left) == sorted(keys[1:])


def test_empty_stream_is_an_error(spark, store):
    _, _, entries, deliveries, _ = store
    bad = spark.createDataFrame([("", "1-0", True)], ROW)
    with pytest.raises(PySparkException, match="stream name is empty"):
        st.apply_acks(entries, deliveries, bad)[0].collect()
