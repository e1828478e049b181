"""Set operators (ST2-ST5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormlake import config as C


def vocabulary(spark: SparkSession, values: list[str] | None = None, col: str = "eventType") -> DataFrame:
    """The known event types as a one-column table (49 rows, fixed)."""
    values = C.EVENT_TYPES if values is None else values
    return spark.createDataFrame([(v,) for v in values], f"{col} string")


def expected_not_seen(expected: DataFrame, seen: DataFrame) -> DataFrame:
    """ST2: distinct expected values absent from the data (anti join on a bounded list)."""
    col = expected.columns[0]
    s = seen.select(F.col(seen.columns[0]).alias(col)).where(F.col(col).isNotNull())
    return expected.distinct().join(s.distinct(), on=col, how="left_anti")


def seen_not_expected(seen: DataFrame, expected: DataFrame) -> DataFrame:
    """ST3: distinct values in the data that are not expected."""
    col = seen.columns[0]
    e = expected.select(F.col(expected.columns[0]).alias(col))
    return seen.where(F.col(col).isNotNull()).distinct().join(e, on=col, how="left_anti")


def union_all_by_name(frames: list[DataFrame]) -> DataFrame:
    """ST5: stack frames whose columns differ; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
