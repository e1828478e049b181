"""Profiles: null percentages (AG8), distinct values (AG9), shape/schema (AG10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormlake.functions.scalars import round_half_even


def null_counts(df: DataFrame, cols: list[str], group_cols: list[str] | None = None) -> DataFrame:
    """One grouped aggregate -> (group..., column, nulls, n); all columns in one pass."""
    group_cols = group_cols or []
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.sum(F.col(c).isNull().cast("long")).alias(f"__z{i}") for i, c in enumerate(cols)]
    wide = df.groupBy(*group_cols).agg(*aggs)
    stack = ", ".join(f"'{c}', __z{i}" for i, c in enumerate(cols))
    return wide.selectExpr(*[f"`{g}`" for g in group_cols], "__n AS n",
                           f"stack({len(cols)}, {stack}) AS (column_name, nulls)")


def null_percentages(df: DataFrame, cols: list[str] | None = None,
                     group_cols: list[str] | None = None, digits: int | None = 2) -> DataFrame:
    """AG8: % null per column (per group), rounded half-even; 0 rows -> null.

    Long format ``(group..., column_name, null_pct)``; sort by ``null_pct`` desc when
    presenting.
    """
    group_cols = group_cols or []
    cols = cols or [c for c in df.columns if c not in group_cols]
    nc = null_counts(df, cols, group_cols)
    pct = F.when(F.col("n") > 0, (F.col("nulls") / F.col("n")) * F.lit(100.0))
    if digits is not None:
        pct = round_half_even(pct, digits)
    return nc.select(*group_cols, "column_name", pct.alias("null_pct"))


def distinct_values(df: DataFrame, col: str, order_col: str | None = None,
                    group_cols: list[str] | None = None) -> DataFrame:
    """AG9/ST4: distinct values; with ``order_col``, ``first_seen`` gives first-seen order."""
    group_cols = group_cols or []
    if order_col is None:
        return df.select(*group_cols, col).distinct()
    return df.groupBy(*group_cols, col).agg(F.min(order_col).alias("first_seen"))


def schema_profile(df: DataFrame) -> DataFrame:
    """AG10: one row per column with type, non-null count and the row count."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count(F.col(c)).alias(f"__c{i}") for i, c in enumerate(cols)]
    wide = df.agg(*aggs)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    stack = ", ".join(f"{i}, '{c}', '{types[c]}', __c{i}" for i, c in enumerate(cols))
    return wide.selectExpr("__rows AS n_rows",
                           f"stack({len(cols)}, {stack}) AS (position, column_name, dtype, non_null)")
