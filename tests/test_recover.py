"""Reading, claiming, consumers and whole rounds of delivery."""

import json
import random

from pyspark.sql import functions as F

from ferrylog.catalog import queries
from ferrylog.operators import recover as rec
from ferrylog.operators import settle as st
from ferrylog.operators import streams as sm
from ferrylog.operators.envelopes import unpack_envelopes
from ferrylog.plans import jobs
from ferrylog.session import written

DELIVERY = "stream string, id string, consumer string, delivered_at_ms bigint"
CONSUMER = "stream string, consumer string, last_seen_ms bigint"
CURSOR = "stream string, id_ms bigint, id_seq bigint"
ROW = "stream string, id string, ack boolean"


def keys(df):
    return sorted((r.stream, r.id) for r in df.collect())


def test_read_in_batches_until_empty(spark, entries_of):
    rows = [(f"{n // 3}-{n % 3}", s, "", "r") for n in range(25) for s in "ab"]
    entries = entries_of(rows + [("7-0", "c", "", "r")])
    cursors = spark.createDataFrame([], CURSOR)
    seen, sizes = [], []
    while True:
        batch, cursors = sm.read_new(entries, cursors, 10)
        got = keys(batch)
        if not got:
            break
        sizes.append(len(got))
        seen += got
    assert sizes == [21, 20, 10]
    assert sorted(seen) == sorted((s, i) for i, s, _, _ in entries.collect())
    assert {r.stream: (r.id_ms, r.id_seq) for r in cursors.collect()} == {
        "a": (8, 0),
        "b": (8, 0),
        "c": (7, 0),
    }


def test_stream_lists(spark, entries_of):
    entries = entries_of([("1-0", "s1", "", "r"), ("1-0", "s2", "", "r"), ("2-0", "s2", "", "r")])
    found = sm.discover_streams(entries)
    assert sorted(r.stream for r in found.collect()) == ["s1", "s2"]
    assert sm.discover_streams(entries.filter("false")).count() == 0
    known = spark.createDataFrame([("s1",), ("s0",)], "stream string")
    got = {r.stream: r.change for r in sm.refresh_streams(known, found).collect()}
    assert got == {"s0": "removed", "s1": "kept", "s2": "new"}
    single = sm.refresh_streams(known, found, single_stream=True)
    assert {r.change for r in single.collect()} == {"kept"} and single.count() == 2


def test_claim(spark, entries_of):
    rng = random.Random(3)
    ids = [(s, f"{n}-0") for n in range(200) for s in ("hot", "hot2")][:300]
    sent = [(s, i, rng.choice(["me", "other"]), rng.randrange(100)) for s, i in ids]
    entries = entries_of([(i, s, "{}", "r") for s, i in ids if i != "3-0"])
    pending = spark.createDataFrame(sent, DELIVERY)
    claimed, after = rec.claim_idle(entries, pending, "me", 110, 60, 40)
    idle = {}
    for s, i, _, at in sorted(sent, key=lambda r: int(r[1].split("-")[0])):
        if 110 - at >= 60:
            idle.setdefault(s, []).append((s, i))
    chosen = {k for group in idle.values() for k in group[:40]}
    want = sorted(k for k in chosen if k[1] != "3-0")
    assert keys(claimed) == want
    state = {(r.stream, r.id): (r.consumer, r.delivered_at_ms) for r in after.collect()}
    expect = {(s, i): (c, at) for s, i, c, at in sent if (s, i) not in chosen}
    expect.update({k: ("me", 110) for k in want})
    assert state == expect


def test_nothing_pending_yields_nothing(spark, entries_of):
    entries = entries_of([("1-0", "s", "", "r")])
    claimed, after = rec.claim_idle(entries, spark.createDataFrame([], DELIVERY), "me", 10, 5, 5)
    assert claimed.count() == 0 and after.count() == 0


def test_dead_consumers(spark):
    minute = 60_000
    consumers = spark.createDataFrame(
        [
            ("s", "me", 0),
            ("s", "dead", 0),
            ("s", "edge", 9 * minute),
            ("s", "live", 10 * minute),
            ("t", "dead", 10 * minute),
        ],
        CONSUMER,
    )
    pending = spark.createDataFrame(
        [("s", "1-0", "dead", 0), ("s", "2-0", "dead", 0), ("s", "3-0", "me", 0)], DELIVERY
    )
    info = rec.consumers_info(pending, 10 * minute, consumers)
    assert {(r.stream, r.consumer): (r.pending, r.idle_ms) for r in info.collect()} == {
        ("s", "me"): (1, 10 * minute),
        ("s", "dead"): (2, 10 * minute),
        ("s", "edge"): (0, minute),
        ("s", "live"): (0, 0),
        ("t", "dead"): (0, 0),
    }
    dead = rec.dead_consumers(info, "me", minute)
    assert [(r.stream, r.consumer) for r in dead.collect()] == [("s", "dead")]
    out = rec.drop_dead_consumers(consumers, pending, dead)
    assert out.consumers.count() == 4
    assert keys(out.released) == [("s", "1-0"), ("s", "2-0")]
    assert keys(out.deliveries) == [("s", "3-0")]
    assert [(r.consumer, r.released) for r in out.report.collect()] == [("dead", 2)]


def test_dead_consumer_is_reported_once(spark, entries_of):
    """More is pending than one claim takes; what is left has no owner."""
    entries = entries_of([(f"{n}-0", "s", "", "r") for n in range(8)])
    deliveries = spark.createDataFrame([("s", f"{n}-0", "dead", n) for n in range(8)], DELIVERY)
    consumers = spark.createDataFrame([("s", "dead", 0), ("s", "me", 1000)], CONSUMER)
    reports, claimed = [], []
    for now in (1000, 1300, 1600):
        done = jobs.recover(entries, deliveries, consumers, "me", now, 700, 600, batch_size=3)
        claimed += sorted(r.id for r in done.lines.collect())
        reports.append([(r.consumer, r.released) for r in done.report.collect()])
        deliveries, consumers = table_of(done.deliveries), table_of(done.consumers)
        owners = {r.consumer for r in deliveries.collect()}
        assert owners <= {"me", ""} and deliveries.count() == 8
    assert reports == [[("dead", 8)], [], []]
    assert [r.consumer for r in consumers.collect()] == ["me"]
    assert set(claimed) == {f"{n}-0" for n in range(8)}


def table_of(df):
    """The next version of a table, as a job's caller would write it."""
    return written(df, "version")


def test_rounds_deliver_everything_at_least_once(spark, entries_of):
    """Deliver, lose some publishes, settle some, recover until all is settled."""
    rng = random.Random(9)
    rows = [
        (f"{n}-{n % 2}", rng.choice("aab"), "" if n % 10 == 0 else '{"severity":1}', "" if n % 10 == 0 else "r")
        for n in range(120)
    ]
    entries = entries_of(rows)
    deliveries = spark.createDataFrame([], DELIVERY)
    cursors = spark.createDataFrame([], CURSOR)
    consumers = spark.createDataFrame([("a", "me", 0)], CONSUMER)
    published, settled, now = [], set(), 0
    for _ in range(3):
        now += 1000
        done = jobs.deliver(entries, deliveries, cursors, "me", now, 30)
        lines = [(r.stream, r.id) for r in unpack_envelopes(done.envelopes).collect()]
        published += lines
        deliveries, cursors = table_of(done.deliveries), table_of(done.cursors)
        acks = [(s, i, rng.random() < 0.5) for s, i in lines]
        settled |= {(s, i) for s, i, k in acks if k}
        table = spark.createDataFrame(acks, ROW)
        left, pending = st.apply_acks(entries, deliveries, table)
        entries, deliveries = table_of(left), table_of(pending)
    want = sorted((s, i) for i, s, o, r in rows if o or r)
    assert sorted(published) == want
    now += 20_000
    again = jobs.recover(entries, deliveries, consumers, "me", now, batch_size=1000)
    redelivered = [(r.stream, r.id, r.line) for r in again.lines.collect()]
    assert sorted((s, i) for s, i, _ in redelivered) == [k for k in want if k not in settled]
    assert all(json.loads(x.split("\t", 2)[2])["severity"] == "ALERT" for _, _, x in redelivered)
    held = {(r.stream, r.id) for r in again.deliveries.collect()}
    assert held == {(s, i) for i, s, _, _ in rows} - settled


def test_redelivery_feed(entries_of):
    fresh = entries_of([("1-0", "s", "", "r"), ("2-0", "s", "", "")])
    claimed = entries_of([("0-1", "s", '{"a":1}', "")])
    got = {r.id: r.line for r in rec.redelivery_feed(fresh, claimed).collect()}
    assert got == {"1-0": '1-0\ts\t{"raw":"r"}', "0-1": '0-1\ts\t{"a":1,"raw":"-"}'}


def test_now_may_be_a_column(spark):
    pending = spark.createDataFrame([("s", "1-0", "c", 5)], DELIVERY)
    info = rec.consumers_info(pending, F.lit(9).cast("bigint"))
    assert info.first().idle_ms == 4


def test_an_idle_consumer_that_drops_the_others_stays(spark, tmp_path):
    at = "timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id AS int))"
    events = spark.range(1, 30).selectExpr(
        "id AS event_id", f"{at} AS ts", "id AS user_id", "'click' AS event_type", "0D AS value", "'{}' AS props"
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    names = lambda query: {r.consumer for r in queries.QUERIES[query](spark, str(tmp_path)).collect()}
    assert queries.OWN_IDLE in names("dead_consumers")
    assert names("drop_dead_consumers_left") == {queries.OWN_IDLE, "relay-4", "relay-5"}
