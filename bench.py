"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8) choose input and
cores. Every query runs once to warm up and then three times; the median
counts. Results go to Spark's no-op sink, so all rows are computed. Tables that
are not the subject of a query (entries, deliveries, acks) are mapped from
``events`` and stored before the clock starts; rows per second refer to the
query's main input.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ferrylog import fixtures as fx  # noqa: E402
from ferrylog.catalog import queries as q  # noqa: E402
from ferrylog.operators import ack_batches as ab  # noqa: E402
from ferrylog.operators import envelopes as en  # noqa: E402
from ferrylog.operators import recover as rec  # noqa: E402
from ferrylog.operators import report as rp  # noqa: E402
from ferrylog.operators import settle as st  # noqa: E402
from ferrylog.operators import shape  # noqa: E402
from ferrylog.operators import streams as sm  # noqa: E402
from ferrylog.session import prepare, written  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    tables = q.Tables(spark, SF_DIR)
    entries = written(tables.entries, "entries")
    deliveries = written(tables.deliveries, "deliveries")
    outcomes = written(tables.ack_rows(), "outcomes")
    acks = written(tables.acks, "acks")
    payloads = written(tables.ack_payloads, "payloads")
    cursors = written(tables.cursors, "cursors")
    lines = written(shape.build_payload(entries, skip_empty=True).select("id", "stream", "line"), "lines")
    envelopes = written(en.pack_envelopes(lines), "envelopes")
    pending = written(rec.pending(deliveries, outcomes, fx.NOW_MS), "pending")

    headline = {
        "build_payload": (
            entries,
            lambda: shape.build_payload(shape.drop_empty_body(entries)).select("id", "stream", "line"),
        ),
        "write_envelopes": (lines, lambda: en.pack_envelopes(lines)),
        "read_envelopes": (lines, lambda: en.unpack_envelopes(envelopes)),
        "read_new": (entries, lambda: sm.read_new(entries, cursors)[0]),
        "read_acks": (payloads, lambda: st.read_acks(payloads)),
        "ack_batches": (acks, lambda: ab.ack_batches(acks)),
        "apply_acks": (entries, lambda: st.apply_acks(entries, deliveries, outcomes)[0]),
        "pending": (deliveries, lambda: rec.pending(deliveries, outcomes, fx.NOW_MS)),
        "claim_idle": (
            pending,
            lambda: rec.claim_idle(entries, pending, fx.SELF, fx.NOW_MS, fx.CLAIM_IDLE_MS)[0],
        ),
        "consumers_info": (pending, lambda: rec.consumers_info(pending, fx.NOW_MS)),
        "dedup_received": (lines, lambda: en.dedup_received(lines)),
        "counters": (
            entries,
            lambda: rp.counters(fetched=entries, published=shape.drop_empty_body(entries), acks=outcomes),
        ),
    }
    seconds, rates = {}, {}
    for name, (source, build) in headline.items():
        consume(build())
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            consume(build())
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 4)
        rates[name] = round(source.count() / seconds[name])
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
