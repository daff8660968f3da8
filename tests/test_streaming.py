"""Streaming forms equal their batch twins and survive restarts."""

import random
import time

import pytest
from pyspark.sql import functions as F

from ferrylog.operators import envelopes as en
from ferrylog.operators.shape import build_payload
from ferrylog.operators.settle import ack_dedup, read_acks
from ferrylog.schema import ACK_PAYLOADS, ENTRIES
from ferrylog.session import scratch_path
from ferrylog.sources import tables
from ferrylog.streaming import ack_flush, feeds, observe, waiting

FAR = "2200-01-01 00:00:00"
BASE = 1_700_000_000_000


def drained(spark, rows, schema=None):
    path = scratch_path(spark, "out")
    feeds.append_stream(rows, path, scratch_path(spark, "offsets")).awaitTermination()
    return spark.read.schema(schema or rows.schema).parquet(path)


@pytest.fixture
def source(spark, entries_of):
    path = scratch_path(spark, "source")

    def add(low, high):
        rows = [(f"{n}-0", "ab"[n % 2], "" if n % 10 == 0 else '{"severity":2}', "") for n in range(low, high)]
        tables.write_entries(entries_of(rows).coalesce(1), path)

    add(0, 50)
    return path, add


def test_each_entry_is_read_once(spark, source):
    path, add = source
    out, offsets = scratch_path(spark, "out"), scratch_path(spark, "offsets")
    for low in (50, 100):
        feeds.append_stream(feeds.stream_entries(spark, path, 1), out, offsets).awaitTermination()
        add(low, low + 50)
    feeds.append_stream(feeds.stream_entries(spark, path, 1), out, offsets).awaitTermination()
    got = sorted(int(r.id.split("-")[0]) for r in spark.read.parquet(out).collect())
    assert got == list(range(150))


def test_delivered_envelopes(spark, source):
    path, add = source
    add(50, 90)
    out, offsets = scratch_path(spark, "out"), scratch_path(spark, "offsets")
    entries = feeds.stream_entries(spark, path, 2)
    feeds.deliver_stream(entries, out, offsets, 20).awaitTermination()
    lines = build_payload(tables.read_entries(spark, path), skip_empty=True).filter("line IS NOT NULL")
    want = sorted(r.line for r in lines.collect())
    assert sorted(r.line for r in en.unpack_envelopes(tables.read_envelopes(spark, out)).collect()) == want
    # the same entries again: a new run over the same checkpoint adds nothing
    feeds.deliver_stream(feeds.stream_entries(spark, path, 2), out, offsets, 20).awaitTermination()
    assert en.unpack_envelopes(tables.read_envelopes(spark, out)).count() == len(want)


def test_observed_counters(spark, source):
    path, _ = source
    watched = observe.observe_entries(feeds.stream_entries(spark, path, 1))
    done = observe.run_observed(
        spark,
        lambda: feeds.append_stream(watched, scratch_path(spark, "o"), scratch_path(spark, "c")),
    )
    assert {r.metric: r.value for r in done.table(spark).collect()} == {
        "messages_fetched": 50,
        "messages_published": 45,
        "messages_skipped": 5,
    }


def test_observed_acks(spark):
    path = scratch_path(spark, "payloads")
    bodies = ['{"ids":["1-0","2-0"],"stream":"s","ack":true}', '{"ids":["3-0"],"stream":"s"}', "x"]
    spark.createDataFrame([(n, b.encode()) for n, b in enumerate(bodies)], ACK_PAYLOADS).write.parquet(path)
    acks = observe.observe_acks(read_acks(feeds.stream_table(spark, path, ACK_PAYLOADS)))
    done = observe.run_observed(
        spark, lambda: feeds.append_stream(acks, scratch_path(spark, "o"), scratch_path(spark, "c"))
    )
    assert dict(done.totals) == {"messages_acked": 2, "messages_nacked": 1, "errors_ack": 1}


def test_old_rows_are_not_lost(spark):
    """Rows nine days behind what came before are new all the same."""
    path = scratch_path(spark, "late")
    for days in (9, 0, 9, 4):
        rows = [("s", f"{days}-{n}", days) for n in range(3)]
        df = spark.createDataFrame(rows, "stream string, id string, days int")
        at = F.timestamp_millis(F.lit(BASE) + F.col("days") * 86_400_000)
        df.withColumn("at", at).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    schema = "stream string, id string, days int, at timestamp"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = drained(spark, en.dedup_received(stream)).collect()
    assert sorted(r.id for r in got) == [f"{d}-{n}" for d in (0, 4, 9) for n in range(3)]
    acks = stream.withColumn("ack", F.col("days") == 9)
    assert drained(spark, ack_dedup(acks)).count() == 9


def flushes(messages, limit, wait):
    """Reference walk over (at_ms, ids, ack): (trigger, ids, nacks, messages)."""
    out, since, ids, nacks, n = [], 0, [], 0, 0
    for at, got, ack in messages:
        if n and at >= since + wait:
            out.append(("time", ids, nacks, n))
            ids, nacks, n = [], 0, 0
        if not n:
            since = at
        n += 1
        ids, nacks = (ids + got, nacks) if ack else (ids, nacks + len(got))
        if len(ids) + nacks >= limit:
            out.append(("size", ids, nacks, n))
            ids, nacks, n = [], 0, 0
    if n:
        out.append(("time", ids, nacks, n))
    return out


@pytest.mark.parametrize("lanes", [1, 3])
def test_ack_flushes(spark, lanes):
    rng = random.Random(lanes)
    rows, at = [], BASE
    for n in range(300):
        at += rng.choice([0, 1, 2, 9, 30])
        ids = [f"{n}-{i}" for i in range(rng.randint(1, 9))]
        rows.append((n, rng.choice("ssst"), ids, rng.random() < 0.7, at))
    path = scratch_path(spark, "acks")
    parts = [rows[:120], rows[120:], [(0, "", [], False, None)]]
    for part in parts:
        df = spark.createDataFrame(
            part, "arrival bigint, stream string, ids array<string>, ack boolean, at bigint"
        ).withColumn("arrived_at", F.coalesce(F.timestamp_millis("at"), F.lit(FAR).cast("timestamp")))
        df.drop("at").coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    schema = "arrival bigint, stream string, ids array<string>, ack boolean, arrived_at timestamp"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = {}
    for r in drained(spark, ack_flush.ack_batches_stream(stream, 20, 10, lanes)).collect():
        got.setdefault((r.stream, r.lane), []).append(
            (r.batch, (r.trigger, r.ack_ids, r.nack_count, r.messages))
        )
    groups = {}
    for n, s, ids, ack, at in rows:
        groups.setdefault((s, n % lanes), []).append((at, ids, ack))
    assert {k: [x for _, x in sorted(v)] for k, v in got.items()} == {
        k: flushes(v, 20, 10) for k, v in groups.items()
    }
    assert {x[0] for v in got.values() for _, x in v} == {"size", "time"}


def test_unacked_batch_and_stream(spark):
    ms = F.timestamp_millis
    sent = spark.range(40).select(
        F.lit("s").alias("stream"),
        F.concat("id", F.lit("-0")).alias("id"),
        ms(BASE + F.col("id") * 1000).alias("delivered_at"),
    )
    said = spark.range(40).filter("id % 4 <> 0").select(
        F.lit("s").alias("stream"),
        F.concat("id", F.lit("-0")).alias("id"),
        (F.col("id") % 4 != 2).alias("ack"),
        ms(BASE + F.col("id") * 1000 + F.when(F.col("id") % 3 == 0, 5000).otherwise(5001)).alias("acked_at"),
    )
    want = sorted(f"{n}-0" for n in range(40) if not (n % 2 == 1 and n % 3 == 0))
    assert sorted(r.id for r in waiting.unacked_after(sent, said, 5000).collect()) == want
    far = F.lit(FAR).cast("timestamp")
    end = spark.range(1).select(F.lit("").alias("stream"), F.lit("").alias("id"))
    a, b = scratch_path(spark, "sent"), scratch_path(spark, "said")
    twice = said.unionByName(said)
    sent.unionByName(end.withColumn("delivered_at", far)).write.parquet(a)
    twice.unionByName(end.withColumns({"ack": F.lit(True), "acked_at": far})).write.parquet(b)
    found = waiting.unacked_after(
        feeds.stream_table(spark, a, sent.schema), feeds.stream_table(spark, b, said.schema), 5000
    )
    assert sorted(r.id for r in drained(spark, found).collect()) == want


def test_defaults_are_checked(spark, source):
    with pytest.raises(ValueError):
        feeds.stream_entries(spark, source[0], 0)
    with pytest.raises(ValueError):
        ack_flush.ack_batches_stream(feeds.stream_table(spark, source[0], ENTRIES), flush_ms=0)
