"""Registered queries: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrylog import fixtures as fx
from ferrylog.functions import body, hashing, severity, zstd
from ferrylog.operators import ack_batches as ab
from ferrylog.operators import envelopes as en
from ferrylog.operators import recover as rec
from ferrylog.operators import report as rp
from ferrylog.operators import settle as st
from ferrylog.operators import shape
from ferrylog.operators import streams as sm
from ferrylog.functions.ids import parse_id
from ferrylog.plans import jobs
from ferrylog.session import prepare, scratch_path
from ferrylog.sources import tables
from ferrylog.sources.store import EntryStore
from ferrylog.streaming import ack_flush, feeds, ledger, observe, waiting

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

READ_BATCH = 700
CLAIM_BATCH = 200
PACK_BATCH = 500
FLUSH_IDS = 64
PART_MESSAGES = 16
LANES = 4
STREAM_FLUSH_MS = 600_000
CAP_BYTES = 1000
RECEIVE_BYTES = 20_000
#: A consumer of every stream that has been idle for longer than the timeout.
OWN_IDLE = "relay-2"


class Tables:
    """The derived tables of one scale factor, built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self.events = fx.load_events(spark, sf_dir)

    def __getattr__(self, name: str) -> DataFrame:
        return getattr(fx, name)(self.events)

    def documents(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/documents.parquet")

    def ack_rows(self) -> DataFrame:
        """One row per acknowledged id."""
        return self.outcomes.select("stream", "id", "ack")

    def lines(self) -> DataFrame:
        return shape.build_payload(self.entries, skip_empty=True).select("id", "stream", "line")

    def pending(self) -> DataFrame:
        return rec.pending(self.deliveries, self.ack_rows(), fx.NOW_MS)

    def parsed_acks(self) -> DataFrame:
        return st.read_acks(self.ack_payloads)

    def valid_acks(self) -> DataFrame:
        return st.validate_ack(self.parsed_acks())[0]

    def stored(self, df: DataFrame, label: str) -> str:
        """Write a table for a reader or a stream; returns its folder."""
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        return path

    def drained(self, rows: DataFrame, label: str) -> DataFrame:
        """Run a streaming result to its end and read what it wrote."""
        path = scratch_path(self.spark, label)
        feeds.append_stream(rows, path, scratch_path(self.spark, "offsets")).awaitTermination()
        return self.spark.read.schema(rows.schema).parquet(path)

    def stream_of(self, df: DataFrame, label: str) -> DataFrame:
        return feeds.stream_table(self.spark, self.stored(df, label), df.schema)


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Tables(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return fn


def joined(ids: Column | str) -> Column:
    return F.concat_ws(",", ids)


# --- sources and sinks ---------------------------------------------------


@query
def read_entries(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "entries")
    tables.write_entries(t.entries, path)
    return tables.read_entries(t.spark, path)


@query
def read_entries_one_stream(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "entries")
    tables.write_entries(t.entries, path)
    return tables.read_entries(t.spark, path, "syslog:click")


@query
def stream_entries(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "entries")
    tables.write_entries(t.entries, path)
    return t.drained(feeds.stream_entries(t.spark, path), "read")


@query
def read_new(t: Tables) -> DataFrame:
    return sm.read_new(t.entries, t.cursors, READ_BATCH)[0].select("stream", "id", "raw")


@query
def read_new_cursors(t: Tables) -> DataFrame:
    return sm.read_new(t.entries, t.cursors, READ_BATCH)[1]


@query
def discover_streams(t: Tables) -> DataFrame:
    return sm.discover_streams(t.entries)


def _changes(t: Tables) -> DataFrame:
    known = t.entries.filter(F.col("stream") != "syslog:error").select("stream").distinct()
    gone = t.spark.range(1).select(F.lit("syslog:gone").alias("stream"))
    return sm.refresh_streams(known.unionByName(gone), sm.discover_streams(t.entries))


@query
def refresh_streams(t: Tables) -> DataFrame:
    return _changes(t)


@query
def write_envelopes(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "envelopes")
    tables.write_envelopes(t.lines(), path, PACK_BATCH)
    return tables.read_envelopes(t.spark, path).drop("payload")


@query
def read_envelopes(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "envelopes")
    tables.write_envelopes(t.lines(), path, PACK_BATCH)
    return en.unpack_envelopes(tables.read_envelopes(t.spark, path)).select(
        "id", "stream", "json"
    )


@query
def deliver_stream(t: Tables) -> DataFrame:
    """Entries streamed into envelopes, and the envelopes unpacked again."""
    source, path = scratch_path(t.spark, "entries"), scratch_path(t.spark, "published")
    tables.write_entries(t.entries, source)
    feeds.deliver_stream(
        feeds.stream_entries(t.spark, source), path, scratch_path(t.spark, "offsets"), PACK_BATCH
    ).awaitTermination()
    return en.unpack_envelopes(tables.read_envelopes(t.spark, path)).select("id", "stream", "json")


@query
def read_acks(t: Tables) -> DataFrame:
    return t.parsed_acks().select(
        "arrival",
        F.coalesce("stream", F.lit("")).alias("stream"),
        joined("ids").alias("ids"),
        "ack",
        F.coalesce("reject_reason", F.lit("")).alias("reject_reason"),
    )


@query
def route_topic(t: Tables) -> DataFrame:
    tenant = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("unit-"), "user_id")).otherwise("")
    rows = t.events.select("event_id", tenant.alias("tenant"))
    return tables.route_topic(rows, "logs/in", "tenant").select("event_id", "topic")


# --- projections, filters, scalars ---------------------------------------


@query
def extract_fields(t: Tables) -> DataFrame:
    return shape.extract_fields(t.wire_entries)


@query
def drop_empty_body(t: Tables) -> DataFrame:
    return shape.drop_empty_body(t.entries)


@query
def severity_name(t: Tables) -> DataFrame:
    value = F.try_element_at(body.json_object(F.col("object")), F.lit("severity"))
    return (
        t.entries.select("id", value.alias("v"))
        .filter(F.col("v").isNotNull())
        .select("id", severity.severity_name_json("v").alias("severity"))
    )


@query
def severity_name_text(t: Tables) -> DataFrame:
    code = (F.col("user_id") % 12).cast("string")
    text = (
        F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("0"), code))
        .when(F.col("event_id") % 7 == 1, F.concat(F.lit("-"), code))
        .when(F.col("event_id") % 7 == 2, F.concat(code, F.lit(".5")))
        .when(F.col("event_id") % 7 == 3, F.concat(F.lit(" "), code))
        .when(F.col("event_id") % 7 == 4, "")
        .otherwise(code)
    )
    return t.events.select("event_id", severity.severity_name(text).alias("severity"))


@query
def flatten_structured_data(t: Tables) -> DataFrame:
    return shape.structured_data_fields(t.entries)


@query
def pass_through_fields(t: Tables) -> DataFrame:
    return shape.pass_through_fields(t.entries)


@query
def flatten_deep(t: Tables) -> DataFrame:
    return shape.structured_data_fields(t.odd_entries)


@query
def pass_through_numbers(t: Tables) -> DataFrame:
    return shape.pass_through_fields(t.odd_entries)


@query
def build_payload_odd(t: Tables) -> DataFrame:
    return shape.build_payload(t.odd_entries).select("id", "stream", "line")


@query
def default_raw(t: Tables) -> DataFrame:
    return t.entries.select("id", body.default_raw(F.col("raw")).alias("raw"))


@query
def tolerate_bad_object(t: Tables) -> DataFrame:
    return shape.tolerate_bad_object(t.entries).select(
        "id", "object_ok", F.size("fields").cast("bigint").alias("n_fields")
    )


@query
def build_payload(t: Tables) -> DataFrame:
    return shape.build_payload(shape.drop_empty_body(t.entries)).select("id", "stream", "line")


@query
def json_escape(t: Tables) -> DataFrame:
    return t.documents().select("doc_id", body.json_escape(F.col("text")).alias("escaped"))


@query
def parse_id_query(t: Tables) -> DataFrame:
    return parse_id(t.entries.select("id")).select(
        "id", "id_ms", "id_seq", F.unix_millis("event_time").alias("event_ms")
    )


QUERIES["parse_id"] = QUERIES.pop("parse_id_query")


@query
def is_compressed(t: Tables) -> DataFrame:
    return t.ack_payloads.select("arrival", zstd.is_compressed(F.col("payload")).alias("packed"))


@query
def compress_lines(t: Tables) -> DataFrame:
    """Whole texts through compression and back."""
    packed = t.documents().select("doc_id", zstd.zstd_pack(F.col("text")).alias("frame"))
    back = packed.select("doc_id", zstd.zstd_unpack(F.col("frame")).alias("text"))
    return back.select("doc_id", F.md5("text").alias("digest"))


@query
def decompress_capped(t: Tables) -> DataFrame:
    """Texts above the cap come back as null, shown as an empty digest."""
    packed = t.documents().select("doc_id", zstd.zstd_pack(F.col("text")).alias("frame"))
    back = packed.select("doc_id", zstd.zstd_unpack(F.col("frame"), CAP_BYTES).alias("text"))
    return back.select("doc_id", F.coalesce(F.md5("text"), F.lit("")).alias("digest"))


@query
def parse_payload_line(t: Tables) -> DataFrame:
    return shape.parse_lines(t.lines().filter(F.col("line").isNotNull()))


# --- acknowledgements ----------------------------------------------------


@query
def parse_ack(t: Tables) -> DataFrame:
    """Payloads with an unknown key and, for every third, no ack field."""
    pieces = F.concat(
        F.lit('{"note":{"a":1},"ids":'),
        F.to_json("ids"),
        F.lit(',"stream":"'),
        F.col("stream"),
        F.when(F.pmod(F.col("arrival"), F.lit(3)) == 0, '"}')
        .when(F.col("ack"), '","ack":true}')
        .otherwise('","ack":"true"}'),
    )
    return st.parse_acks(t.acks.select("arrival", pieces.alias("payload"))).select(
        "arrival", "stream", joined("ids").alias("ids"), "ack"
    )


@query
def validate_ack(t: Tables) -> DataFrame:
    valid, rejected = st.validate_ack(t.parsed_acks())
    good = valid.select("arrival", F.size("ids").cast("bigint").alias("n"), F.lit("").alias("reason"))
    bad = rejected.select(
        "arrival", F.lit(0).cast("bigint").alias("n"), F.col("reject_reason").alias("reason")
    )
    return good.unionByName(bad)


@query
def explode_acks(t: Tables) -> DataFrame:
    return st.explode_acks(t.valid_acks())


@query
def accumulate_acks(t: Tables) -> DataFrame:
    return st.accumulate_acks(t.valid_acks(), PART_MESSAGES).select(
        "stream", "part", joined("ack_ids").alias("ack_ids"), "nack_count"
    )


@query
def ack_shard(t: Tables) -> DataFrame:
    return t.entries.select(
        "id",
        hashing.fnv1a_32(F.col("stream")).alias("hash"),
        hashing.ack_shard(F.col("stream")).alias("shard"),
    )


@query
def ack_batches(t: Tables) -> DataFrame:
    return ab.ack_batches(t.acks, FLUSH_IDS).select(
        "stream", "batch", "messages", joined("ack_ids").alias("ack_ids"), "nack_count"
    )


def _timed_acks(t: Tables) -> DataFrame:
    """Acks with an arrival time, closed by a row that only moves the clock."""
    at = F.timestamp_millis(F.lit(fx.START_MS) + F.col("arrival") * 60_000)
    acks = t.acks.select("arrival", "stream", "ids", "ack", at.alias("arrived_at"))
    close = t.spark.range(1).select(
        F.lit(-1).cast("bigint").alias("arrival"),
        F.lit("").alias("stream"),
        F.array().cast("array<string>").alias("ids"),
        F.lit(False).alias("ack"),
        F.lit("2200-01-01 00:00:00").cast("timestamp").alias("arrived_at"),
    )
    return acks.unionByName(close)


@query
def ack_batches_stream(t: Tables) -> DataFrame:
    flushed = ack_flush.ack_batches_stream(
        t.stream_of(_timed_acks(t), "acks"), FLUSH_IDS, STREAM_FLUSH_MS, LANES
    )
    return t.drained(flushed, "flushes").select(
        "stream",
        F.col("lane").cast("bigint").alias("lane"),
        "batch",
        "trigger",
        "messages",
        joined("ack_ids").alias("ack_ids"),
        "nack_count",
    )


@query
def apply_acks(t: Tables) -> DataFrame:
    return st.apply_acks(t.entries, t.deliveries, t.ack_rows())[0].select("stream", "id", "raw")


@query
def apply_acks_pending(t: Tables) -> DataFrame:
    return st.apply_acks(t.entries, t.deliveries, t.ack_rows())[1]


@query
def nacked(t: Tables) -> DataFrame:
    return st.nacked(t.deliveries, t.ack_rows())


@query
def ack_dedup(t: Tables) -> DataFrame:
    rows = st.explode_acks(t.valid_acks())
    return st.ack_dedup(rows.unionByName(rows))


@query
def ack_dedup_stream(t: Tables) -> DataFrame:
    rows = t.outcomes.select("stream", "id", "ack", F.timestamp_millis("acked_at_ms").alias("at"))
    source = t.stream_of(rows.unionByName(rows), "acks")
    return t.drained(st.ack_dedup(source), "distinct").select("stream", "id", "ack")


# --- pending, claim and consumers ----------------------------------------


@query
def pending(t: Tables) -> DataFrame:
    return t.pending().select("stream", "id", "consumer", "idle_ms")


@query
def select_idle(t: Tables) -> DataFrame:
    return rec.select_idle(t.pending(), fx.NOW_MS, fx.CLAIM_IDLE_MS, CLAIM_BATCH).select(
        "stream", "id", "consumer"
    )


def _claim(t: Tables) -> tuple[DataFrame, DataFrame]:
    return rec.claim_idle(
        t.entries,
        t.pending(),
        fx.SELF,
        fx.NOW_MS,
        fx.CLAIM_IDLE_MS,
        CLAIM_BATCH,
    )


@query
def claim_idle(t: Tables) -> DataFrame:
    return _claim(t)[0]


@query
def claim_idle_deliveries(t: Tables) -> DataFrame:
    return _claim(t)[1]


@query
def redelivery_feed(t: Tables) -> DataFrame:
    fresh = sm.read_new(t.entries, t.cursors, READ_BATCH)[0]
    return rec.redelivery_feed(fresh, _claim(t)[0])


def _info(t: Tables) -> DataFrame:
    return rec.consumers_info(t.pending(), fx.NOW_MS, t.consumers)


@query
def consumers_info(t: Tables) -> DataFrame:
    return _info(t)


def _dead(t: Tables) -> DataFrame:
    return rec.dead_consumers(_info(t), fx.SELF, fx.CONSUMER_IDLE_TIMEOUT_MS)


@query
def dead_consumers(t: Tables) -> DataFrame:
    return _dead(t).select("stream", "consumer")


def _dropped(t: Tables) -> rec.Dropped:
    return rec.drop_dead_consumers(t.consumers, t.pending(), _dead(t))


@query
def drop_dead_consumers(t: Tables) -> DataFrame:
    return _dropped(t).report


@query
def drop_dead_consumers_left(t: Tables) -> DataFrame:
    """As one of the idle consumers drops the others: it stays itself."""
    dead = rec.dead_consumers(_info(t), OWN_IDLE, fx.CONSUMER_IDLE_TIMEOUT_MS)
    return rec.drop_dead_consumers(t.consumers, t.pending(), dead).consumers


@query
def drop_dead_consumers_released(t: Tables) -> DataFrame:
    return _dropped(t).released.select("stream", "id", "consumer")


def _timed_deliveries(t: Tables) -> DataFrame:
    return t.deliveries.select(
        "stream", "id", F.timestamp_millis("delivered_at_ms").alias("delivered_at")
    )


def _timed_outcomes(t: Tables) -> DataFrame:
    return t.outcomes.select(
        "stream", "id", "ack", F.timestamp_millis("acked_at_ms").alias("acked_at")
    )


@query
def unacked_after(t: Tables) -> DataFrame:
    return waiting.unacked_after(
        _timed_deliveries(t), _timed_outcomes(t), fx.CLAIM_IDLE_MS
    ).select("stream", "id")


@query
def unacked_after_stream(t: Tables) -> DataFrame:
    """Both streams end with a row far ahead that moves the clock."""
    far = F.lit("2200-01-01 00:00:00").cast("timestamp")
    end = t.spark.range(1).select(F.lit("").alias("stream"), F.lit("").alias("id"))
    sent = _timed_deliveries(t).unionByName(end.withColumn("delivered_at", far))
    said = _timed_outcomes(t).unionByName(
        end.withColumn("ack", F.lit(True)).withColumn("acked_at", far)
    )
    found = waiting.unacked_after(
        t.stream_of(sent, "sent"), t.stream_of(said, "said"), fx.CLAIM_IDLE_MS
    )
    return t.drained(found, "unacked").select("stream", "id")


def _late(t: Tables, rows: DataFrame, at: str, label: str) -> DataFrame:
    """A stream of ``rows``, the newest ones first, one file of six a micro-batch."""
    path = t.stored(rows.repartitionByRange(6, F.col(at).desc()), label)
    return feeds.stream_table(t.spark, path, rows.schema, 1)


@query
def unacked_after_late(t: Tables) -> DataFrame:
    """Deliveries and acks that come in newest first, given out after every third of them."""
    book = ledger.Ledger(t.spark, scratch_path(t.spark, "ledger"))
    said = t.outcomes.select("stream", "id", "ack", "acked_at_ms")
    for rows, at, name in ((said, "acked_at_ms", "acks"), (t.deliveries, "delivered_at_ms", "deliveries")):
        late = _late(t, rows, at, name)
        book.record_stream(late, name, scratch_path(t.spark, "offsets")).awaitTermination()
    far = fx.NOW_MS + 365 * fx.DAY_MS
    for part, now in enumerate((fx.NOW_MS - 10 * fx.DAY_MS, far, far)):
        book.give_overdue(part, now, fx.CLAIM_IDLE_MS)
    return book.given().select("stream", "id")


@query
def flush_acks_stream(t: Tables) -> DataFrame:
    """All acks in one micro-batch: by count as the batch operator, the rest by time."""
    path = scratch_path(t.spark, "flushes")
    acks = t.stream_of(t.acks, "acks")
    ledger.flush_acks_stream(acks, path, scratch_path(t.spark, "offsets"), FLUSH_IDS).awaitTermination()
    return ledger.read_flushes(t.spark, path).select(
        "stream", "batch", "trigger", "messages", joined("ack_ids").alias("ack_ids"), "nack_count"
    )


@query
def flush_acks_late(t: Tables) -> DataFrame:
    """Every positive id of acks that come in newest first."""
    path = scratch_path(t.spark, "flushes")
    late = _late(t, t.acks, "arrival", "acks")
    ledger.flush_acks_stream(late, path, scratch_path(t.spark, "offsets"), FLUSH_IDS).awaitTermination()
    return ledger.read_flushes(t.spark, path).select("stream", F.explode("ack_ids").alias("id"))


@query
def deliver_stream_pending(t: Tables) -> DataFrame:
    """What streamed delivery leaves pending: every entry, empty ones too, until acks come."""
    source = scratch_path(t.spark, "entries")
    tables.write_entries(t.entries, source)
    book = ledger.Ledger(t.spark, scratch_path(t.spark, "ledger"))
    book.deliver_stream(
        feeds.stream_entries(t.spark, source, 16),
        scratch_path(t.spark, "offsets"),
        fx.SELF,
        lambda: fx.NOW_MS,
        PACK_BATCH,
    ).awaitTermination()
    book.record_acks(t.outcomes.select("stream", "id", "ack", "acked_at_ms"), 0)
    return book.pending()


@query
def deliver_rounds(t: Tables) -> DataFrame:
    """Rounds of the lowest unread ids of every stream, gone on with after a stop."""
    path = scratch_path(t.spark, "ledger")
    for most in (1, None):
        book = ledger.Ledger(t.spark, path)
        book.deliver_rounds(t.entries, fx.SELF, lambda: fx.NOW_MS, READ_BATCH, most)
    sent = t.spark.read.parquet(f"{path}/deliveries")
    return (
        parse_id(sent)
        .groupBy(F.col("part").cast("bigint").alias("round"), "stream")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id_ms").alias("first_ms"), F.max("id_ms").alias("last_ms"))
    )


def _store(t: Tables) -> EntryStore:
    store = EntryStore(t.spark, scratch_path(t.spark, "store"))
    store.add(t.entries)
    return store


@query
def settle_store(t: Tables) -> DataFrame:
    """Two rounds of acks, the first one compacted away, the second left out on reading."""
    store = _store(t)
    half = F.pmod(F.xxhash64("id"), F.lit(2))
    for part in (0, 1):
        store.settle(t.ack_rows().filter(half == part), part)
        if not part:
            store.compact()
    return store.live().select("stream", "id", "raw")


@query
def read_new_store(t: Tables) -> DataFrame:
    """The next batch, when only days from the least cursor on are read."""
    rows = sm.read_new(_store(t).unread(t.cursors), t.cursors, READ_BATCH)[0]
    return rows.select("stream", "id", "raw")


@query
def claim_store(t: Tables) -> DataFrame:
    """Claimed entries, when only the days of the chosen ids are read."""
    chosen = rec.select_idle(t.pending(), fx.NOW_MS, fx.CLAIM_IDLE_MS, CLAIM_BATCH)
    return _store(t).fetch(chosen)


@query
def dedup_received(t: Tables) -> DataFrame:
    lines = t.lines().filter(F.col("line").isNotNull())
    return en.dedup_received(lines.unionByName(lines))


@query
def dedup_received_stream(t: Tables) -> DataFrame:
    rows = parse_id(t.entries).select("id", "stream", "raw", "event_time")
    source = t.stream_of(rows.unionByName(rows), "received")
    return t.drained(en.dedup_received(source), "distinct").select("id", "stream", "raw")


@query
def dedup_received_late(t: Tables) -> DataFrame:
    """Newest days first, one file a micro-batch, all of it twice."""
    rows = parse_id(t.entries).select("id", "stream", "raw", "event_time")
    days = rows.repartitionByRange(6, F.col("event_time").desc())
    path = t.stored(days, "received")
    days.write.mode("append").parquet(path)
    source = feeds.stream_table(t.spark, path, rows.schema, 1)
    return t.drained(en.dedup_received(source), "distinct").select("id", "stream", "raw")


# --- accounting ----------------------------------------------------------


@query
def counters(t: Tables) -> DataFrame:
    return rp.counters(
        fetched=t.entries,
        published=shape.drop_empty_body(t.entries),
        acks=t.ack_rows(),
        claimed=_claim(t)[0],
        changes=_changes(t),
        removed=_dead(t),
    )


@query
def publish_stats(t: Tables) -> DataFrame:
    stats = rp.publish_stats(en.pack_envelopes(t.lines(), PACK_BATCH))
    return stats.select(
        "stream", "batch", "published", "skipped", "raw_bytes", (F.col("packed_bytes") > 0).alias("packed")
    )


@query
def error_counts(t: Tables) -> DataFrame:
    bad = shape.tolerate_bad_object(t.entries).filter(~F.col("object_ok"))
    failed = en.batch_texts(t.lines(), PACK_BATCH).filter(F.col("batch") % 2 == 1)
    return rp.error_counts(
        bad_objects=bad,
        rejected_acks=st.validate_ack(t.parsed_acks())[1],
        failed_flushes=ab.ack_batches(t.acks, FLUSH_IDS).filter(F.col("batch") % 3 == 0),
        failed_batches=failed,
    )


def _received(t: Tables) -> jobs.Received:
    sent = t.stored(en.pack_envelopes(t.lines(), PACK_BATCH), "sent")
    return jobs.receive(t.spark.read.parquet(sent), RECEIVE_BYTES)


@query
def receive(t: Tables) -> DataFrame:
    """Lines of the envelopes that the receiver's limit lets through."""
    return _received(t).lines.select("id", "stream", "json")


@query
def receive_rejected(t: Tables) -> DataFrame:
    return _received(t).rejected.select("stream", "batch", "n_lines")


@query
def error_counts_jobs(t: Tables) -> DataFrame:
    """Errors as the jobs report them: faulty bodies, refused acks and envelopes."""
    return rp.error_counts(
        bad_objects=shape.tolerate_bad_object(t.entries).filter(~F.col("object_ok")),
        rejected_acks=jobs.settle(t.entries, t.deliveries, t.ack_payloads).rejected,
        failed_batches=_received(t).rejected,
    )


@query
def ack_backlog(t: Tables) -> DataFrame:
    valid = t.valid_acks()
    return rp.ack_backlog(valid, valid.filter(F.col("arrival") % 5 != 0))


@query
def health_rollup(t: Tables) -> DataFrame:
    """The source is well when it has entries, the sink when nothing was refused."""
    source = t.entries.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("source").alias("component"),
        (F.col("n") > 0).alias("ok"),
        F.lit("no entries").alias("message"),
    )
    sink = t.outcomes.agg(F.count_if(~F.col("ack")).alias("n")).select(
        F.lit("sink").alias("component"),
        (F.col("n") == 0).alias("ok"),
        F.concat(F.col("n").cast("string"), F.lit(" refused")).alias("message"),
    )
    return rp.health_rollup(source.unionByName(sink))


@query
def observe_stream(t: Tables) -> DataFrame:
    """Totals of the live counters after the stream has run dry."""
    source, path = scratch_path(t.spark, "entries"), scratch_path(t.spark, "seen")
    tables.write_entries(t.entries, source)
    watched = observe.observe_entries(feeds.stream_entries(t.spark, source))
    done = observe.run_observed(
        t.spark, lambda: feeds.append_stream(watched, path, scratch_path(t.spark, "offsets"))
    )
    return done.table(t.spark)


# --- whole jobs ----------------------------------------------------------


@query
def deliver(t: Tables) -> DataFrame:
    done = jobs.deliver(t.entries, t.deliveries, t.cursors, fx.SELF, fx.NOW_MS, READ_BATCH)
    return en.unpack_envelopes(done.envelopes).select("id", "stream", "json")


@query
def settle(t: Tables) -> DataFrame:
    return jobs.settle(t.entries, t.deliveries, t.ack_payloads).entries.select("stream", "id")


@query
def recover(t: Tables) -> DataFrame:
    return jobs.recover(
        t.entries,
        t.pending().drop("idle_ms"),
        t.consumers,
        fx.SELF,
        fx.NOW_MS,
        fx.CLAIM_IDLE_MS,
        fx.CONSUMER_IDLE_TIMEOUT_MS,
        CLAIM_BATCH,
    ).lines
