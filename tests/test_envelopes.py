"""Packing and unpacking of envelopes, entry tables, topics, reports."""

import json

import pytest
from pyspark.sql import functions as F

from ferrylog.operators import envelopes as en
from ferrylog.operators import report as rp
from ferrylog.operators.shape import build_payload, extract_fields
from ferrylog.plans import jobs
from ferrylog.schema import WIRE_ENTRIES
from ferrylog.session import scratch_path
from ferrylog.sources import tables


@pytest.fixture
def lines(entries_of):
    rows = [(f"{n}-0", "a", '{"m":"tab\\tnl\\n"}', "x\ty\nz") for n in range(25)]
    rows += [(f"{n}-1", "a", "", "") for n in range(25, 30)]
    rows += [(f"{n}-0", "b", "", "r") for n in range(3)] + [("3-0", "b", "", "")]
    return build_payload(entries_of(rows).repartition(6), skip_empty=True)


def test_batches_keep_order_and_count_skipped(lines):
    texts = {(r.stream, r.batch): r for r in en.batch_texts(lines, 10).collect()}
    assert {k: (r.n_lines, r.n_skipped) for k, r in texts.items()} == {
        ("a", 0): (10, 0),
        ("a", 1): (10, 0),
        ("a", 2): (5, 5),
        ("b", 0): (3, 1),
    }
    ids = [x.split("\t")[0] for x in texts["a", 1].body.split("\n")]
    assert ids == [f"{n}-0" for n in range(10, 20)]
    assert all(r.raw_bytes == len(r.body.encode()) for r in texts.values())


def test_batch_without_lines_writes_nothing(lines):
    assert {(r.stream, r.batch) for r in en.batch_texts(lines, 5).collect()} == {
        ("a", 0), ("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 0),
    }
    with pytest.raises(ValueError):
        en.number_batches(lines, 0)


def test_round_trip_through_storage(spark, lines):
    path = scratch_path(spark, "envelopes")
    tables.write_envelopes(lines, path, 7)
    stored = tables.read_envelopes(spark, path)
    got = {r.line for r in en.unpack_envelopes(stored).collect()}
    assert got == {r.line for r in lines.collect() if r.line}
    row = en.unpack_envelopes(stored).filter("stream = 'a'").first()
    assert json.loads(row.json) == {"m": "tab\tnl\n", "raw": "x\ty\nz"}
    stats = rp.publish_stats(stored).collect()
    assert sum(r.published for r in stats) == 28
    assert all(r.ratio == r.raw_bytes / r.packed_bytes for r in stats)


def test_damaged_frames_are_reported(lines):
    packed = en.pack_envelopes(lines, 10)
    broken = packed.withColumn(
        "payload", F.when(F.col("stream") == "b", F.substring("payload", 1, 9)).otherwise(F.col("payload"))
    )
    assert {r.stream for r in en.unpack_envelopes(broken).collect()} == {"a"}
    assert [(r.stream, r.n_lines) for r in en.rejected_envelopes(broken).collect()] == [("b", 3)]
    assert en.rejected_envelopes(packed, max_bytes=50).count() == 4


def test_receive_reports_what_it_refuses(lines):
    packed = en.pack_envelopes(lines, 10)
    broken = packed.withColumn("payload", F.when(F.col("stream") == "b", F.lit(None)).otherwise(F.col("payload")))
    got = jobs.receive(broken.unionByName(packed.filter("stream = 'a'")))
    assert got.lines.count() == 25 and {r.stream for r in got.lines.collect()} == {"a"}
    assert [(r.stream, r.batch, r.n_lines) for r in got.rejected.collect()] == [("b", 0, 3)]
    assert {(r.stage, r.reason): r.value for r in rp.error_counts(failed_batches=got.rejected).collect()} == {
        ("publish", "batch"): 3
    }
    assert jobs.receive(packed.limit(0)).rejected.count() == 0


def test_received_copies(lines):
    sent = lines.filter("line IS NOT NULL").select("id", "stream", "line")
    assert en.dedup_received(sent.unionByName(sent)).count() == 28


def test_entry_tables_prune_by_stream(spark, entries_of):
    path = scratch_path(spark, "entries")
    tables.write_entries(entries_of([("1-0", "a:b/c", "o", "r"), ("1-0", "z", None, None)]), path)
    assert tables.read_entries(spark, path).count() == 2
    one = tables.read_entries(spark, path, "a:b/c")
    assert [tuple(r) for r in one.collect()] == [("1-0", "a:b/c", "o", "r")]
    assert "PartitionFilters: [isnotnull(stream" in one._jdf.queryExecution().toString()
    assert tuple(tables.read_entries(spark, path, "z").first()) == ("1-0", "z", "", "")


def test_wire_fields(spark):
    rows = [
        ("1-0", "s", {"source": "10.0.0.1", "timestamp": "1", "object": "o", "raw": "raw data"}),
        ("2-0", "s", {"source": "x"}),
        ("3-0", "s", {"raw": None}),
    ]
    got = extract_fields(spark.createDataFrame(rows, WIRE_ENTRIES)).collect()
    assert [tuple(r) for r in got] == [("1-0", "s", "o", "raw data"), ("2-0", "s", "", ""), ("3-0", "s", "", "")]


def test_topics(spark):
    df = spark.createDataFrame([("unit-42",), ("",), (None,)], "tenant string")
    got = [r.topic for r in tables.route_topic(df, "logs/in", "tenant").collect()]
    assert got == ["unit-42/logs/in", "logs/in", "logs/in"]
    assert tables.route_topic(df, "logs/in").first().topic == "logs/in"


@pytest.mark.parametrize(
    "rows, want",
    [
        ([("source", True, ""), ("sink", True, "")], ("ok", "ok", "ok")),
        ([("source", False, "refused"), ("sink", True, "")], ("degraded", "refused", "ok")),
        ([("source", True, ""), ("sink", False, "")], ("degraded", "ok", "disconnected")),
        ([("source", True, "")], ("ok", "ok", "ok")),
        ([("source", True, ""), ("sink", None, "")], ("ok", "ok", "ok")),
        ([], ("ok", "ok", "ok")),
    ],
)
def test_health(spark, rows, want):
    df = spark.createDataFrame(rows, "component string, ok boolean, message string")
    assert tuple(rp.health_rollup(df).first()) == want


def test_counters(spark):
    streams = spark.createDataFrame([("a",), ("a",), ("b",)], "stream string")
    acks = spark.createDataFrame([("a", True), ("a", False), ("a", True)], "stream string, ack boolean")
    got = {
        (r.scope, r.stream, r.metric): r.value
        for r in rp.counters(fetched=streams, acks=acks).collect()
    }
    assert got == {
        ("stream", "a", "messages_fetched"): 2,
        ("stream", "b", "messages_fetched"): 1,
        ("total", "", "messages_fetched"): 3,
        ("stream", "a", "messages_acked"): 2,
        ("total", "", "messages_acked"): 2,
        ("stream", "a", "messages_nacked"): 1,
        ("total", "", "messages_nacked"): 1,
    }
    with pytest.raises(ValueError):
        rp.counters()
    with pytest.raises(ValueError):
        rp.error_counts()


def test_errors_and_backlog(spark, lines):
    failed = en.batch_texts(lines, 10).filter("batch = 0")
    got = {(r.stage, r.reason): r.value for r in rp.error_counts(failed_batches=failed).collect()}
    assert got == {("publish", "batch"): 13}
    assert rp.ack_backlog(lines, lines.filter("stream = 'a'")).first()[0] == 4
    assert rp.ack_backlog(lines.filter("false"), lines.filter("false")).first()[0] == 0


def test_envelopes_are_bounded_in_bytes(spark):
    lines = spark.createDataFrame([(f"{k}-0", "s", f"{k}-0\ts\t{'x' * 500}") for k in range(1, 41)], "id string, stream string, line string")
    packed = en.pack_envelopes(lines, batch_size=30, max_bytes=2_000)
    assert max(r.raw_bytes for r in packed.collect()) < 2_000 + 520
    back = en.unpack_envelopes(packed, 3_000)
    assert {r.line for r in back.collect()} == {r.line for r in lines.collect()}


def test_empty_stream_name_survives_storage(spark, tmp_path):
    rows = [("1-0", "", "{}", "r"), ("2-0", "s", "{}", "r")]
    tables.write_entries(spark.createDataFrame(rows, "id string, stream string, object string, raw string"), str(tmp_path / "e"))
    found = tables.read_entries(spark, str(tmp_path / "e"))
    assert {(r.id, r.stream) for r in found.collect()} == {("1-0", ""), ("2-0", "s")}
    assert [r.id for r in tables.read_entries(spark, str(tmp_path / "e"), "").collect()] == ["1-0"]


def test_batches_of_a_codec_are_bounded_in_bytes(spark):
    from ferrylog.functions import zstd
    from ferrylog.session import ARROW_BATCH_BYTES, prepare

    prepare(spark)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") in (str(ARROW_BATCH_BYTES), f"{ARROW_BATCH_BYTES}b")
    values = [b"x" * 1_000_000, None, b""] * 20
    cut = list(zstd._cut(iter(values)))
    assert [v for part in cut for v in part.to_pylist()] == values
    assert max(part.nbytes for part in cut) < zstd._BATCH_BYTES + 1_100_000
