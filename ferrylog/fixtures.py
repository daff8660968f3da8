"""Log-delivery tables derived from an ``events`` table.

``events(event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
value double, props string)``. Every rule is a projection of one event, so the
derived tables need no shuffle except the grouping of acknowledgements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrylog.functions.ids import id_pair
from ferrylog.functions.numbers import floor_div
from ferrylog.functions.zstd import zstd_pack

DAY_MS = 86_400_000
# 2024-01-01 and 2024-01-31, the ends of the events' month
START_MS = 1_704_067_200_000
NOW_MS = START_MS + 30 * DAY_MS
# thresholds on the scale of the month, so that both sides occur
CLAIM_IDLE_MS = 10 * DAY_MS
CONSUMER_IDLE_TIMEOUT_MS = 10 * DAY_MS
SELF = "relay-b"


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # parts of a zone-less timestamp, so that the session zone plays no role
    ms = F.expr(
        "unix_date(cast(ts AS date)) * 86400000L + hour(ts) * 3600000L"
        " + minute(ts) * 60000L + cast(floor(extract(SECOND FROM ts) * 1000) AS bigint)"
    )
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    cores = spark.sparkContext.defaultParallelism
    if events.rdd.getNumPartitions() < cores:
        # a table of few splits would keep all later work in as few tasks
        events = events.repartition(cores, "event_id")
    return events.select("event_id", "user_id", "event_type", "props", ms.alias("ms"))


# the event's own number as sequence part: unique without a window over ms
_ID = "concat(ms, '-', event_id)"
_STREAM = "concat('syslog:', event_type)"
_OBJECT = """
CASE event_id % 25
  WHEN 0 THEN ''
  WHEN 1 THEN concat('{"hostname":"h', user_id, '"}')
  WHEN 2 THEN 'not json'
  WHEN 3 THEN concat('{"severity":"', user_id % 10, '"}')
  WHEN 4 THEN concat('{"hostname":"h', user_id, '","severity":', user_id % 10, ',"raw":"inner"}')
  WHEN 5 THEN concat('{"severity":', user_id % 10,
                     ',"structured_data":{"hall":{"row":{"seat":"', user_id, '"}}}}')
  WHEN 6 THEN concat('{"severity":', user_id % 10, ',"structured_data":"-"}')
  ELSE concat('{"hostname":"h', user_id, '","severity":', user_id % 10,
              ',"facility":', user_id % 24, ',"structured_data":{"site@7":', props, '}}')
END"""
_RAW = """
CASE WHEN event_id % 25 IN (0, 7) THEN ''
  ELSE concat('<', user_id % 24 * 8 + user_id % 10 % 8, '>1 ', event_type, ' ', event_id)
END"""


def entries(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        f"{_ID} AS id", f"{_STREAM} AS stream", f"{_OBJECT} AS object", f"{_RAW} AS raw"
    )


def wire_entries(events: DataFrame) -> DataFrame:
    """Field maps as the store hands them out; empty fields are absent."""
    fields = f"map('object', {_OBJECT}, 'raw', {_RAW}, 'source', '10.0.0.1')"
    return events.selectExpr(
        f"{_ID} AS id", f"{_STREAM} AS stream", f"map_filter({fields}, (k, v) -> v <> '') AS fields"
    )


def deliveries(events: DataFrame) -> DataFrame:
    """Two thirds of the events, to one consumer per five days."""
    return events.filter("event_id % 3 <> 0").selectExpr(
        f"{_STREAM} AS stream",
        f"{_ID} AS id",
        f"concat('relay-', (ms - {START_MS}) div {5 * DAY_MS}) AS consumer",
        "ms + 1000 AS delivered_at_ms",
    )


def outcomes(events: DataFrame) -> DataFrame:
    """One ack outcome per delivered event that got one."""
    return events.filter("event_id % 3 <> 0 AND event_id % 4 <> 0").selectExpr(
        "event_id",
        f"{_STREAM} AS stream",
        f"{_ID} AS id",
        "event_id % 4 <> 3 AS ack",
        "ms + 1000 AS delivered_at_ms",
        f"ms + 1000 + event_id % 7 * {3 * DAY_MS} AS acked_at_ms",
    )


def acks(events: DataFrame) -> DataFrame:
    """Ack messages: up to 100 neighbouring events of one stream and outcome.

    ``arrival`` is unique within a stream, like a broker offset.
    """
    return (
        outcomes(events)
        .withColumn("arrival", F.expr("event_id div 100 * 2 + if(ack, 0, 1)"))
        .groupBy("stream", "arrival", "ack")
        .agg(F.sort_array(F.collect_list(F.struct(id_pair("id"), "id"))).alias("pairs"))
        .select("arrival", "stream", F.col("pairs.id").alias("ids"), "ack")
    )


def bad_payloads(spark: SparkSession) -> DataFrame:
    """Payloads that a reader must refuse, with arrivals below zero."""
    return spark.sql(
        """
        SELECT cast(a AS bigint) AS arrival, p AS payload FROM VALUES
          (-1, cast('invalid json' AS binary)),
          (-2, cast('' AS binary)),
          (-3, cast('{"ack":true}' AS binary)),
          (-4, cast('{}' AS binary)),
          (-5, cast('{"ids":[],"stream":"s","ack":true}' AS binary)),
          (-6, cast('{"ids":["msg-123"],"ack":true}' AS binary)),
          (-7, cast('{"ids":["msg-123"],"stream":"","ack":true}' AS binary)),
          (-8, X'28B52FFDFFFF'),
          (-9, cast('["ids"]' AS binary)),
          (-10, cast('{"ids":["x"],"stream":"s"' AS binary))
        AS t(a, p)
        """
    )


def ack_payloads(events: DataFrame) -> DataFrame:
    """Ack messages on the wire, every other pair of arrivals compressed."""
    text = F.to_json(F.struct("ids", "stream", "ack")).cast("binary")
    packed = floor_div(F.col("arrival"), 2) % 2 == 1
    good = acks(events).select(
        "arrival",
        F.when(packed, zstd_pack(F.when(packed, text))).otherwise(text).alias("payload"),
    )
    return good.unionByName(bad_payloads(events.sparkSession))


def consumers(events: DataFrame) -> DataFrame:
    """Consumers by their last delivery, and one per stream that holds nothing."""
    seen = (
        deliveries(events)
        .groupBy("stream", "consumer")
        .agg(F.max("delivered_at_ms").alias("last_seen_ms"))
    )
    idle = streams(events).select(
        "stream", F.lit("spare").alias("consumer"), F.lit(START_MS).alias("last_seen_ms")
    )
    return seen.unionByName(idle)


def streams(events: DataFrame) -> DataFrame:
    return events.selectExpr(f"{_STREAM} AS stream").distinct()


def cursors(events: DataFrame) -> DataFrame:
    """Half of the month is already delivered, except on two streams."""
    return (
        streams(events)
        .filter("stream NOT IN ('syslog:error', 'syslog:view')")
        .selectExpr("stream", f"{START_MS + 15 * DAY_MS} AS id_ms", "0L AS id_seq")
    )


ODD_DEPTH = 49
ODD_BIG = "9" * 42


def odd_entries(events: DataFrame) -> DataFrame:
    """Bodies that a parser would write in another way, and deep ones, of every event."""
    body = f"""
    CASE event_id % 4
      WHEN 0 THEN concat('{{"structured_data":', repeat('{{"n":', {ODD_DEPTH}),
                         '{{"leaf":', event_id, ',"last":1.10}}', repeat('}}', {ODD_DEPTH}), '}}')
      WHEN 1 THEN concat('{{"price":', user_id, '.50,"big":{ODD_BIG},"far":1e400,"list":[1.0,  ',
                         event_id, '],"obj":{{"z":1,"a":-0.0}}}}')
      WHEN 2 THEN concat('{{ "name" : "caf\\\\u00e9", "severity" : ', user_id % 10, ' }}')
      ELSE concat('{{"hostname":"h', user_id, '","severity":', user_id % 10, '}}')
    END"""
    return events.selectExpr(f"{_ID} AS id", f"{_STREAM} AS stream", f"{body} AS object", "'r' AS raw")
