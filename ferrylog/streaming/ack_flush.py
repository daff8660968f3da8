"""Count-or-time triggered batches of a stream of acknowledgements."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ferrylog.schema import ACK_BATCH_SIZE, ACK_FLUSH_MS, require_positive

FLUSHES = (
    "stream string, lane int, batch bigint, trigger string, messages bigint,"
    " ack_ids array<string>, nack_count bigint"
)
DEFAULT_LANES = 16


class _AckFlusher(StatefulProcessor):
    """State of one stream and lane: what has arrived since the last flush."""

    def __init__(self, max_ids: int, flush_ms: int) -> None:
        self.max_ids = max_ids
        self.flush_ms = flush_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ids = handle.getListState("ids", "id string")
        self.open = handle.getValueState(
            "open", "batch bigint, since_ms bigint, messages bigint, acked bigint, nacked bigint"
        )

    def _load(self) -> None:
        batch, since, messages, _, nacked = (
            self.open.get() if self.open.exists() else (0, 0, 0, 0, 0)
        )
        self.batch, self.since, self.messages, self.nacked = batch, since, messages, nacked
        self.acked = [r[0] for r in self.ids.get()] if messages else []

    def _save(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if self.messages:
            self.handle.registerTimer(self.since + self.flush_ms)
        if self.acked:
            self.ids.put([(i,) for i in self.acked])
        else:
            self.ids.clear()
        self.open.update((self.batch, self.since, self.messages, len(self.acked), self.nacked))

    def _flush(self, key, trigger: str) -> dict:
        row = {
            "stream": key[0],
            "lane": key[1],
            "batch": self.batch,
            "trigger": trigger,
            "messages": self.messages,
            "ack_ids": self.acked,
            "nack_count": self.nacked,
        }
        self.batch += 1
        self.messages, self.nacked, self.acked = 0, 0, []
        return row

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self._load()
        arrived = pd.concat(list(rows)).sort_values(["at_ms", "arrival"])
        out = []
        for at_ms, ids, ack in zip(arrived["at_ms"], arrived["ids"], arrived["ack"]):
            if not len(ids):
                continue
            if self.messages and at_ms >= self.since + self.flush_ms:
                out.append(self._flush(key, "time"))
            if not self.messages:
                self.since = int(at_ms)
            self.messages += 1
            if ack:
                self.acked.extend(ids)
            else:
                self.nacked += len(ids)
            if len(self.acked) + self.nacked >= self.max_ids:
                out.append(self._flush(key, "size"))
        self._save()
        if out:
            yield pd.DataFrame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._load()
        due = self.since + self.flush_ms <= expiredTimerInfo.getExpiryTimeInMs()
        if self.messages and due:
            row = self._flush(key, "time")
            self._save()
            yield pd.DataFrame([row])

    def close(self) -> None:
        pass


def ack_batches_stream(
    valid: DataFrame,
    max_ids: int = ACK_BATCH_SIZE,
    flush_ms: int = ACK_FLUSH_MS,
    lanes: int = DEFAULT_LANES,
    delay: str = "10 minutes",
    event_time: str = "arrived_at",
) -> DataFrame:
    """Flush at ``max_ids`` ids or ``flush_ms`` after the first unflushed ack.

    Time is event time: a flush falls due when a later ack of the lane or the
    watermark passes it, so results do not depend on how the input is cut into
    micro-batches. The watermark moves only with later rows; close the input
    with a row without ids when the last acks must flush.

    A stream's acks are spread over ``lanes`` by arrival number, so that a hot
    stream is not one task; with one lane batches are exact per stream. State
    is bounded by ``max_ids`` plus one message per lane.
    """
    require_positive(max_ids=max_ids, flush_ms=flush_ms, lanes=lanes)
    # a filter on ids here would move below the watermark and hide closing rows
    messages = valid.withWatermark(event_time, delay).select(
        "stream",
        F.pmod(F.col("arrival"), F.lit(lanes)).cast("int").alias("lane"),
        event_time,
        F.unix_millis(event_time).alias("at_ms"),
        "arrival",
        "ids",
        "ack",
    )
    return messages.groupBy("stream", "lane").transformWithStateInPandas(
        statefulProcessor=_AckFlusher(max_ids, flush_ms),
        outputStructType=FLUSHES,
        outputMode="append",
        timeMode="EventTime",
    )
