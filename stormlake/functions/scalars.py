"""Column expressions (FN2, FN3, FN5-FN9, the seeded uniform).

All are built-in Spark expressions: they stay inside whole-stage codegen and
never cross into Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormlake import config as C


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def season(date_col: str | Column) -> Column:
    """FN2: month -> season name; anything else, null included, is autumn."""
    m = F.month(_c(date_col))
    return (F.when(m.isin(C.WINTER_MONTHS), F.lit(C.SEASON_WINTER))
             .when(m.isin(C.SPRING_MONTHS), F.lit(C.SEASON_SPRING))
             .when(m.isin(C.SUMMER_MONTHS), F.lit(C.SEASON_SUMMER))
             .otherwise(F.lit(C.SEASON_AUTUMN)))


def with_date_parts(df: DataFrame, date_col: str = "date") -> DataFrame:
    """FN3: add year, month, day; a missing column is an error."""
    if date_col not in df.columns:
        raise ValueError(f"Column '{date_col}' not found in DataFrame.")
    d = F.col(date_col)
    return df.withColumns({"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)})


def lenient_year(c: str | Column) -> Column:
    """FN4: year of a value that may be text; unparseable -> null."""
    col = _c(c)
    return F.year(F.try_to_timestamp(col.cast("string")))


def occurred(c: str | Column = "eventType") -> Column:
    """FN5: null -> 0, anything else -> 1."""
    return _c(c).isNotNull().cast("int")


def mid_range(avg: str | Column, mx: str | Column, mn: str | Column) -> Column:
    """FN6: the given average, else (max + min) / 2."""
    return F.coalesce(_c(avg), (_c(mx) + _c(mn)) / F.lit(2.0))


def fill_from(c: str | Column, other: str | Column) -> Column:
    """FN7: the value, else the other side's value."""
    return F.coalesce(_c(c), _c(other))


def zero_fill_int(c: str | Column) -> Column:
    """FN8: null -> 0, as int."""
    return F.coalesce(_c(c), F.lit(0)).cast("int")


def round_half_even(c: str | Column, digits: int = 2) -> Column:
    """FN9: two-digit rounding, ties to even (0.125 -> 0.12)."""
    return F.bround(_c(c), digits)


def uniform(*parts: str | Column, seed: int = C.SEED) -> Column:
    """A U[0,1) draw that depends only on the row's key and the seed.

    md5 of ``key|seed``; its first 32 bits over 2^32.  Stable under any
    re-partitioning and task retry, so samplers built on it are deterministic.
    """
    key = F.concat_ws("|", *[_c(p).cast("string") for p in parts], F.lit(str(seed)))
    hi = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double")
    return hi / F.lit(4294967296.0)


def uniform_sql(key_sql: str, seed: int = C.SEED) -> str:
    """The same draw in DuckDB SQL, for oracles."""
    return (f"(('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || '|{seed}'), 1, 8))::UBIGINT"
            f" / 4294967296.0)")
