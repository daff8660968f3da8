"""Numbered parts of a table: one folder per round, replaced when a round is repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _files(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _found(spark: SparkSession, pattern: str) -> list:
    return [s.getPath() for s in _files(spark, pattern).globStatus(_path(spark, pattern)) or []]


def write_part(rows: DataFrame, path: str, part: int | str, *by: str) -> None:
    """Store one part; a second write of the same part replaces it."""
    rows.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/part={part}")


def write_parts(rows: DataFrame, path: str) -> None:
    """Store every part that ``part`` numbers, all in one job; parts that come again are replaced.

    Rows meet by part, so that a part is few files, and large parts are split between tasks.
    Spark swaps the folders when all are written; the mark of a complete part follows.
    """
    (
        rows.hint("rebalance", F.col("part"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("part")
        .parquet(path)
    )
    spark = rows.sparkSession
    done = set(complete_parts(spark, path))
    stored = {p.getName()[5:]: p for p in _found(spark, f"{path}/part=*")}
    files = _files(spark, path)
    for name in [str(r.part) for r in rows.select("part").distinct().collect()]:
        if name in stored and name not in done:
            files.create(_path(spark, f"{path}/part={name}/_SUCCESS")).close()


def complete_parts(spark: SparkSession, path: str) -> list[str]:
    """Names of the parts that were written to their end."""
    return sorted(p.getParent().getName()[5:] for p in _found(spark, f"{path}/part=*/_SUCCESS"))


def read_parts(
    spark: SparkSession, path: str, schema: StructType | str, parts: list[str] | None = None
) -> DataFrame:
    """All complete parts, or the named ones, as one table; empty when there are none."""
    names = complete_parts(spark, path) if parts is None else parts
    if not names:
        return spark.createDataFrame([], schema)
    # with one base, parts may have partitions of their own; the part's name is no column
    files = spark.read.schema(schema).option("basePath", path)
    return files.parquet(*[f"{path}/part={n}" for n in names]).drop("part")


def drop_part(spark: SparkSession, path: str, part: str) -> None:
    for folder in _found(spark, f"{path}/part={part}"):
        files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.delete(folder, True)
