"""Projections, filters and renames (PJ1-PJ9)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormlake import config as C


def select_existing(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """PJ1: keep the wanted columns that exist, in the wanted order."""
    present = set(df.columns)
    return df.select(*[c for c in wanted if c in present])


def select_strict(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """PJ2: select; a missing column is an error."""
    cols = list(cols)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.select(*cols)


def rename_by_map(df: DataFrame, source: str,
                  mapping: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """PJ3: rename raw -> canonical names of one source; unknown source is a no-op."""
    mapping = C.COLUMN_MAP if mapping is None else mapping
    table = mapping.get(source)
    if table is None:
        return df
    present = set(df.columns)
    return df.withColumnsRenamed({k: v for k, v in table.items() if k in present and k != v})


def drop_tolerant(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """PJ4: drop what exists, ignore the rest."""
    return df.drop(*cols)


def drop_strict(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """PJ5: drop; a missing column is an error."""
    cols = list(cols)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """PJ7: drop rows having any null."""
    return df.na.drop(how="any", subset=subset)


def head(df: DataFrame, n: int, order: list[str | Column]) -> DataFrame:
    """PJ9: the first n rows by an explicit order (a top-n, not a sample)."""
    return df.orderBy(*order).limit(n)


def coalesce_nan(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NaN -> null on floating columns, so null is the only missing marker."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    cols = [c for c in (cols or df.columns) if c in floats]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType))
                           for c in cols})
