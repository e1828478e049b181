"""Aggregations (AG1-AG7, AG11).

All are hash aggregates with a partial (map-side) step, so a hot key is
reduced before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    ex = set(exclude or [])
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, _NUMERIC) and f.name not in ex]


def day_means(df: DataFrame, keys: list[str], cols: list[str] | None = None) -> DataFrame:
    """AG1: mean of every numeric column per key (nulls skipped)."""
    cols = cols or numeric_columns(df, exclude=keys)
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])


def count_by(df: DataFrame, keys: list[str | Column], name: str = "count",
             drop_null_keys: bool = True) -> DataFrame:
    """AG2/AG3/AG4/AG5: rows per key; null keys dropped as pandas groupby does."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    if drop_null_keys:
        cond = None
        for n in g.columns[:len(keys)]:
            c = F.col(n).isNotNull()
            cond = c if cond is None else cond & c
        if cond is not None:
            g = g.where(cond)
    return g


def pivot_counts(df: DataFrame, index: list[str], pivot_col: str,
                 values: list[str] | None = None) -> DataFrame:
    """AG6: index x pivot value counts, missing combinations -> 0.

    Pass ``values`` to skip the extra job that discovers them.
    """
    g = df.where(F.col(pivot_col).isNotNull()).groupBy(*index)
    p = g.pivot(pivot_col, values) if values is not None else g.pivot(pivot_col)
    out = p.agg(F.count(F.lit(1)))
    vals = [c for c in out.columns if c not in index]
    return out.na.fill(0, subset=vals)


def event_counts_per_file(df: DataFrame, file_col: str, type_col: str = "EVENT_TYPE") -> DataFrame:
    """AG7: rows per (file, event type) -- null types dropped as value_counts
    does -- with the file's total row count alongside."""
    counts = df.groupBy(file_col, type_col).agg(F.count(F.lit(1)).alias("count"))
    counts = counts.withColumn("file_rows", F.sum("count").over(Window.partitionBy(file_col)))
    return counts.where(F.col(type_col).isNotNull())


def year_range(df: DataFrame, col: str = "year", keys: list[str] | None = None) -> DataFrame:
    """AG11: min and max of a column, per key."""
    keys = keys or []
    return df.groupBy(*keys).agg(F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"))
