"""The store by days, and deliveries and acks as parts: nothing lost, nothing read in vain."""

import pytest
from pyspark.sql import functions as F

from ferrylog.operators import envelopes as en
from ferrylog.operators.streams import read_new
from ferrylog.schema import CURSORS
from ferrylog.session import scratch_path, written
from ferrylog.sources import tables
from ferrylog.sources.folders import complete_parts
from ferrylog.sources.store import DAY_MS, EntryStore
from ferrylog.streaming import feeds
from ferrylog.streaming.ledger import Ledger, flush_acks_stream, read_flushes

DAY = 19_000


def ident(day, n):
    return f"{(DAY + day) * DAY_MS + n * 1000}-{n}"


@pytest.fixture
def filled(spark, entries_of):
    rows = [(ident(d, n), s, "", f"{s}{d}{n}") for s in ("a", "b", "") for d in range(4) for n in range(5)]
    rows += [("odd", "a", "", "no number"), ("odd", "b", "", "no number")]
    store = EntryStore(spark, scratch_path(spark, "store"))
    store.add(entries_of(rows))
    return store


def acks(spark, pairs, ok=True):
    return spark.createDataFrame([(s, i, ok) for s, i in pairs], "stream string, id string, ack boolean")


def plan_of(df):
    return df._jdf.queryExecution().toString()


def keys(df):
    return sorted((r.stream, r.id) for r in df.collect())


def test_settled_entries_are_left_out_and_compacted(spark, filled):
    every = keys(filled.live())
    assert len(every) == 62
    gone = [("a", ident(1, n)) for n in range(5)] + [("b", ident(2, 0)), ("b", ident(9, 9)), ("a", "odd")]
    filled.settle(acks(spark, gone), 0)
    filled.settle(acks(spark, [("b", ident(0, 0))], ok=False), 1)
    want = [k for k in every if k not in gone]
    assert keys(filled.live()) == want
    assert filled.stored().count() == 62
    for _ in range(2):
        filled.compact()
        assert keys(filled.live()) == want
    # the day left empty is not rewritten, its ids stay noted; all other ids are forgotten
    assert filled.stored().count() == 62 - 1
    assert {r.id for r in filled.settled().filter("stream = 'a'").collect()} >= {ident(1, 0)}
    assert filled.settled().filter("stream = 'b'").filter(F.col("id") == ident(2, 0)).count() == 0
    filled.settle(acks(spark, [("b", ident(3, 4))]), 2)
    assert keys(filled.live()) == [k for k in want if k != ("b", ident(3, 4))]


def test_a_repeated_round_changes_nothing(spark, filled):
    for _ in range(2):
        filled.settle(acks(spark, [("a", ident(0, 0))]), 7)
    assert filled.settled().count() == 1


def test_cursor_and_claim_reach_the_scan(spark, filled):
    low = (DAY + 2) * DAY_MS + 1000
    cursors = spark.createDataFrame([("a", low, 1), ("b", low, 1)], CURSORS)
    rows = filled.unread(cursors)
    after = [(s, ident(d, n)) for s in "ab" for d in (2, 3) for n in range(5) if (d, n) > (2, 1)]
    assert keys(rows) == sorted(after + [("", ident(d, n)) for d in range(4) for n in range(5)])
    plan = plan_of(rows)
    assert f"(day#" in plan and f">= {DAY + 2})" in plan and "PartitionFilters: [" in plan
    assert f"GreaterThanOrEqual(id_ms,{low})" in plan
    none = spark.createDataFrame([], CURSORS)
    assert filled.unread(none).count() == 62
    wanted = acks(spark, [("a", ident(1, 1)), ("b", ident(3, 3)), ("b", ident(8, 1))]).drop("ack")
    found = filled.fetch(wanted)
    assert keys(found) == [("a", ident(1, 1)), ("b", ident(3, 3))]
    assert f"day#" in plan_of(found) and f"{DAY + 1}" in plan_of(found)


def test_rounds_are_bounded_in_entries_and_go_on(spark, filled):
    entries = filled.live()
    path = scratch_path(spark, "ledger")
    book = Ledger(spark, path)
    assert book.deliver_rounds(entries, "c", lambda: 1, 3, most=2) == 2
    # a round that was published but not committed is made again as it was
    cursors = spark.read.schema(CURSORS).parquet(f"{path}/cursors/part=1")
    rows, _ = read_new(entries, cursors.select(*CURSORS.names), 3)
    book.publish(rows, 2, "c", 1, 3)
    assert Ledger(spark, path).deliver_rounds(entries, "c", lambda: 2, 3) == 5
    sent = spark.read.parquet(f"{path}/deliveries")
    assert sent.groupBy("part", "stream").count().filter("count > 3").isEmpty()
    assert sent.count() == sent.select("stream", "id").distinct().count() == entries.count()
    at = {(r.stream, r.id): r.part for r in sent.collect()}
    assert [at["b", ident(0, n)] for n in range(5)] == [0, 0, 1, 1, 1] and at["b", "odd"] == 0
    got = en.unpack_envelopes(spark.read.parquet(f"{path}/envelopes"))
    assert got.count() == entries.count()
    assert Ledger(spark, path).deliver_rounds(entries, "c", lambda: 2, 3) == 0


def one_by_one(spark, entries, path, size):
    """Rounds in the plainest way: read, publish, commit, and again."""
    book, n = Ledger(spark, path), 0
    cursors = spark.createDataFrame([], CURSORS)
    while True:
        rows, cursors = read_new(entries, cursors, size)
        if rows.isEmpty():
            return n
        book.publish(rows, n, "c", 2, size)
        cursors, n = written(cursors, "cursors"), n + 1


def stored_rounds(spark, path):
    sent = spark.read.parquet(f"{path}/deliveries").collect()
    envelopes = spark.read.parquet(f"{path}/envelopes").drop("payload").collect()
    return (
        sorted((r.part, r.stream, r.id, r.consumer, r.delivered_at_ms) for r in sent),
        sorted((r.part, r.stream, r.batch, r.n_lines, r.n_skipped, r.raw_bytes) for r in envelopes),
    )


def test_rounds_made_together_are_those_made_one_by_one(spark, entries_of):
    # repeated ids at, before and after a round's end, and ids that are no numbers
    ids = [(s, n, k) for s, top in (("a", 7), ("b", 5)) for n in range(top) for k in range(1 + 3 * (n == 3))]
    rows = [(ident(0, n), s, "", f"{s}{n}") for s, n, _ in ids]
    rows += [("odd", "a", "", "x")] * 4 + [(ident(1, n), "c", "", "") for n in range(4)]
    entries = entries_of(rows)
    plain, path = scratch_path(spark, "plain"), scratch_path(spark, "ledger")
    n = one_by_one(spark, entries, plain, 3)
    made = [Ledger(spark, path).deliver_rounds(entries, "c", lambda: 2, 3, m) for m in (1, None)]
    assert sum(made) == n and made[0] == 1
    assert stored_rounds(spark, path) == stored_rounds(spark, plain)
    sent = [str(k) for k in range(n)]
    assert sorted(complete_parts(spark, f"{path}/deliveries"), key=int) == sent


def test_jobs_do_not_grow_with_the_rounds(spark, entries_of):
    def jobs_for(n):
        entries = entries_of([(ident(0, k), "a", "", "x") for k in range(n)])
        sc = spark.sparkContext
        sc.setJobGroup(f"rounds-{n}", "rounds")
        try:
            assert Ledger(spark, scratch_path(spark, "ledger")).deliver_rounds(entries, "c", lambda: 1, 3) == -(-n // 3)
            return len(sc.statusTracker().getJobIdsForGroup(f"rounds-{n}"))
        finally:
            sc._jsc.clearJobGroup()

    # a few jobs more only list the folders of many parts
    assert jobs_for(60) <= jobs_for(6) + 4


def test_rounds_with_folders_of_their_own_are_read_together(spark, filled):
    for n in range(3):
        filled.settle(acks(spark, [("a", ident(n, 0)), ("b", "odd")]), n)
    gone = sorted({("a", ident(n, 0)) for n in range(3)} | {("b", "odd")})
    assert sorted({(r.stream, r.id) for r in filled.settled().collect()}) == gone
    assert filled.settled().columns == ["stream", "id", "day"]
    assert len(keys(filled.live())) == 62 - 4


def test_streamed_delivery_is_pending_and_replays(spark, filled):
    source = scratch_path(spark, "source")
    tables.write_entries(filled.live(), source)
    book = Ledger(spark, scratch_path(spark, "ledger"))
    offsets = scratch_path(spark, "offsets")
    book.deliver_stream(feeds.stream_entries(spark, source), offsets, "c", lambda: 5).awaitTermination()
    assert book.pending().count() == 62
    # the micro-batch comes again: the same part is replaced
    again = scratch_path(spark, "offsets")
    book.deliver_stream(feeds.stream_entries(spark, source), again, "c", lambda: 6).awaitTermination()
    assert book.pending().count() == 62 and len(complete_parts(spark, f"{book.path}/envelopes")) == 1
    book.record_acks(acks(spark, [("a", ident(0, 0))]).withColumn("acked_at_ms", F.lit(9).cast("bigint")), "x")
    assert book.pending().count() == 61


def test_late_deliveries_are_given_once(spark):
    book = Ledger(spark, scratch_path(spark, "ledger"))
    sent = "stream string, id string, consumer string, delivered_at_ms bigint"
    said = "stream string, id string, ack boolean, acked_at_ms bigint"

    def deliver(part, *rows):
        path = scratch_path(spark, "d")
        spark.createDataFrame([("s", i, "c", at) for i, at in rows], sent).write.parquet(path)
        stream = feeds.stream_table(spark, path, spark.read.parquet(path).schema)
        ledger_part = book.record_stream(stream, "deliveries", scratch_path(spark, "o"))
        ledger_part.awaitTermination()
        (found,) = {"0"} & set(complete_parts(spark, f"{book.path}/deliveries"))
        spark.read.parquet(f"{book.path}/deliveries/part={found}").write.parquet(f"{book.path}/deliveries/part=n{part}")

    deliver(1, ("1-1", 1_000), ("2-1", 50_000))
    assert keys(book.give_overdue(0, 11_000, 10_000)) == [("s", "1-1")]
    deliver(2, ("late-1", 500), ("3-1", 500))
    book.record_acks(spark.createDataFrame([("s", "3-1", True, 600), ("s", "2-1", True, 70_000)], said), 0)
    assert keys(book.give_overdue(1, 20_000, 10_000)) == [("s", "late-1")]
    assert keys(book.give_overdue(1, 20_000, 10_000)) == [("s", "late-1")]
    assert keys(book.give_overdue(2, 90_000, 10_000)) == [("s", "2-1")]
    assert book.give_overdue(3, 99_000, 10_000).count() == 0
    with pytest.raises(ValueError):
        book.give_overdue(4, 1, 0)


def test_acks_of_any_age_flush(spark):
    path, offsets = scratch_path(spark, "flushes"), scratch_path(spark, "offsets")
    source = scratch_path(spark, "acks")
    schema = "arrival bigint, stream string, ids array<string>, ack boolean"
    batches = [[(5, "s", ["e"], True)], [(1, "s", ["a", "b"], True), (2, "s", ["c"], False), (3, "t", ["x"], True)], [(4, "s", ["late"], True)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = feeds.stream_table(spark, source, spark.read.parquet(source).schema)
        flush_acks_stream(stream, path, offsets, 3).awaitTermination()
    rows = read_flushes(spark, path).collect()
    assert sorted(i for r in rows for i in r.ack_ids) == ["a", "b", "e", "late", "x"]
    assert sum(r.nack_count for r in rows) == 1
    assert sorted(r.trigger for r in rows) == ["size", "time", "time", "time"]
