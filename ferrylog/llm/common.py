"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrylog.session import written

#: White space as the operators count it: blank and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"

#: Rows per Arrow batch; texts may be long, so batches stay small.
ARROW_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Keep the batches that Python workers receive small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty when it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Maximal runs of characters that are not white space, in order."""
    spaced = F.translate(text, SPACE, " " * len(SPACE))
    return F.array_remove(F.split(spaced, " "), "")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened with underscores until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Number rows from 0 in a total order, without sorting them in one task.

    Rows are range-partitioned and sorted, stored once, and numbered within their
    partition; only one count per partition is added up.
    """
    part, place = fresh(df, "_part", "_place")
    at = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(place, at)
    stored = written(ranged, "numbered")
    bits = F.shiftright(F.col(place), 33)
    counts = stored.groupBy(bits.alias(part)).count()
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(name))
    rows = stored.withColumn(part, bits).withColumn(place, F.col(place).bitwiseAND((1 << 33) - 1))
    return (
        rows.join(bases, part)
        .withColumn(name, F.col(name) + F.col(place))
        .drop(part, place)
    )


def bounded(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Neighbouring items in parts of at most ``limit`` together; a larger item stands alone."""
    begin = total = 0
    for k, size in enumerate(sizes):
        if k > begin and total + size > limit:
            yield begin, k
            begin, total = k, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)
