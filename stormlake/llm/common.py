"""Shared helpers: narrow column selection, running totals, files in any store."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from stormlake.session import Stages

__all__ = ["Stages", "table", "pick", "with_running_total", "open_store", "chunks", "partitions", "small_batches", "mix64"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **cols: str | Column) -> DataFrame:
    """Only the named columns, under our own names: whatever else the table
    holds, also under names we use inside, cannot clash."""
    return df.select(*[(df[c] if isinstance(c, str) else c).alias(name) for name, c in cols.items()])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "4m") -> None:
    """Texts go to Python workers and back in batches of at most so many rows and bytes (for the
    rest of the session): a batch lies in the JVM and in the worker at once, several times over."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def with_running_total(stages: Stages, df: DataFrame, order: list[str], value: str, total: str) -> DataFrame:
    """Add ``total``: the sum of ``value`` over all rows before this one in the
    order of ``order`` (nulls first; rows equal in all order columns come in any
    order).  Rows are range-partitioned and written once with their part
    number, so no task sorts more than one part; only one row a part goes
    through the window over parts."""
    n = partitions(df.sparkSession)
    parts = stages.save(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    sums = parts.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = sums.select("_part", F.coalesce(F.sum("_sum").over(
        W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (parts.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(before, "_part").withColumn(total, (F.col("_before") + F.col("_inside")).cast("long"))
            .drop("_part", "_inside", "_before"))


def open_store(path: str):
    """(file system, path in it) for a URI or plain path, on any executor."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(path)


def chunks(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Index ranges [i, j) of consecutive texts with about ``most`` bytes
    together; a longer text is a range of its own."""
    i, size = 0, 0
    for j, t in enumerate(texts):
        if j > i and size + len(t) > most:
            yield i, j
            i, size = j, 0
        size += len(t)
    if i < len(texts):
        yield i, len(texts)


_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective scrambler of 64-bit integers (splitmix64's finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


