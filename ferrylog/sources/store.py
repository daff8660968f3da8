"""A store of entries by stream and day, with the settled ids beside it.

Entries are kept in ranges of their numeric ids, so that a cursor or a claim reaches the
parquet scan as a partition filter on the day and a pushed filter on ``id_ms``. Settling
writes only the settled ids, by day; readers leave those out as they read (merge on
read). ``compact`` rewrites the stream days that hold settled entries and no others.

Ids that are not numbers, and the unnamed stream, live in the folders for null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrylog.functions.ids import id_ms, id_seq
from ferrylog.functions.numbers import floor_div
from ferrylog.operators.settle import positive_ids
from ferrylog.operators.streams import unread
from ferrylog.session import written
from ferrylog.sources.folders import complete_parts, drop_part, read_parts, write_part

DAY_MS = 86_400_000
STORED = "id string, object string, raw string, id_ms bigint, id_seq bigint, stream string, day int"
SETTLED = "stream string, id string, day int"
#: More cursors, or days, than this become a join instead of a list in the filter.
LISTED = 1000

_KEY = ["stream", "id", "day"]


def day_of(ms: Column) -> Column:
    return floor_div(ms, DAY_MS).cast("int")


def _named() -> Column:
    return F.coalesce("stream", F.lit("")).alias("stream")


class EntryStore:
    """Entries below ``path``; every method returns a DataFrame or writes at once."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.entries_path = f"{path}/entries"
        self.settled_path = f"{path}/settled"

    def add(self, entries: DataFrame) -> None:
        """Append entries, ranged by stream, day and id: a hot stream spreads over tasks."""
        rows = entries.select(
            "id",
            "object",
            "raw",
            id_ms("id").alias("id_ms"),
            id_seq("id").alias("id_seq"),
            "stream",
            day_of(id_ms("id")).alias("day"),
        )
        order = ["stream", "day", "id_ms", "id_seq"]
        ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        ranged.write.mode("append").partitionBy("stream", "day").parquet(self.entries_path)

    def stored(self) -> DataFrame:
        """All entries, settled ones not yet compacted away included."""
        return self.spark.read.schema(STORED).parquet(self.entries_path)

    def settle(self, acks: DataFrame, round_: int | str) -> None:
        """Note the positively acknowledged ids of a round; repeating a round changes nothing."""
        ids = positive_ids(acks).withColumn("day", day_of(id_ms("id")))
        write_part(ids.repartition("day").select(*_KEY), self.settled_path, round_, "day")

    def settled(self) -> DataFrame:
        return read_parts(self.spark, self.settled_path, SETTLED)

    def _live(self, stored: DataFrame, settled: DataFrame) -> DataFrame:
        """Of equal ids on one day, none that is settled; a missing day equals itself."""
        rows = stored.withColumn("stream", _named())
        gone = settled.select("stream", "id", F.col("day").alias("_day"))
        same = [rows["stream"] == gone["stream"], rows["id"] == gone["id"]]
        return rows.join(gone, [*same, F.col("day").eqNullSafe(F.col("_day"))], "left_anti")

    def live(self) -> DataFrame:
        """Entries that are not settled."""
        return self._live(self.stored(), self.settled()).select("id", "stream", "object", "raw")

    def unread(self, cursors: DataFrame) -> DataFrame:
        """Live entries above their stream's cursor, all of streams without one.

        The least cursor bounds the days and files of the streams that have one; other streams
        are found by name, in the list of folders.
        """
        low = cursors.agg(F.min("id_ms").alias("ms"), F.count(F.lit(1)).alias("n")).first()
        stored = self.stored()
        if not low.n:
            return self._live(stored, self.settled()).select("id", "stream", "object", "raw")
        after = stored.filter(
            (F.col("day") >= low.ms // DAY_MS) & (F.col("id_ms") >= low.ms)
        ).withColumn("stream", _named())
        known = after.join(cursors.select("stream"), "stream", "left_semi")
        if low.n <= LISTED:
            names = [r.stream for r in cursors.select("stream").collect()]
            new = stored.filter(
                F.col("stream").isNull() | ~F.col("stream").isin(names)
            ).withColumn("stream", _named())
            new = new.filter(~F.col("stream").isin(names))
        else:
            new = stored.withColumn("stream", _named()).join(
                cursors.select("stream"), "stream", "left_anti"
            )
        settled = self.settled().filter(F.col("day").isNull() | (F.col("day") >= low.ms // DAY_MS))
        rows = self._live(known, settled).unionByName(self._live(new, self.settled()))
        return unread(rows, cursors).select("id", "stream", "object", "raw")

    def fetch(self, keys: DataFrame) -> DataFrame:
        """Live entries of the given (stream, id); days without a key are not read."""
        wanted = written(
            keys.select("stream", "id", day_of(id_ms("id")).alias("day")).distinct(), "wanted"
        )
        days = [r.day for r in wanted.select("day").distinct().limit(LISTED + 1).collect()]
        stored = self.stored()
        if len(days) <= LISTED:
            listed = F.col("day").isin([d for d in days if d is not None])
            stored = stored.filter(listed | F.col("day").isNull() if None in days else listed)
        rows = self._live(stored, self.settled())
        return rows.join(wanted, ["stream", "id"], "left_semi").select("id", "stream", "object", "raw")

    def compact(self) -> None:
        """Rewrite the stream days with settled entries, then forget those ids.

        Ids of a day that is left without entries stay noted: a folder without rows is not
        replaced. A failure in between leaves ids noted that are gone already, which is harmless.
        """
        rounds = complete_parts(self.spark, self.settled_path)
        if not rounds:
            return
        settled = read_parts(self.spark, self.settled_path, SETTLED, rounds)
        days = written(settled.select("stream", "day").distinct(), "days")
        stored = self.stored().withColumn("stream", _named())
        on = [stored["stream"] == days["stream"], stored["day"].eqNullSafe(days["day"])]
        touched = stored.join(days, on, "left_semi")
        left = written(self._live(touched, settled), "left")
        order = ["stream", "day", "id_ms", "id_seq"]
        ranged = left.repartitionByRange(*order).sortWithinPartitions(*order)
        (
            ranged.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("stream", "day")
            .parquet(self.entries_path)
        )
        kept = left.select("stream", F.col("day").alias("_day")).distinct()
        on = [settled["stream"] == kept["stream"], settled["day"].eqNullSafe(kept["_day"])]
        noted = written(settled.join(kept, on, "left_anti").distinct(), "noted")
        write_part(noted.repartition("day"), self.settled_path, f"{rounds[-1]}+", "day")
        for name in rounds:
            drop_part(self.spark, self.settled_path, name)
