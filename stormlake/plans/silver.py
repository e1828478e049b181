"""Raw -> silver, one function per source (PL1-PL4).

Inputs carry their identity as columns (``city_id``, and for hourly files
``granularity``), so one job cleans every city of a source at once; the
per-file rules of the source (date format, null gate, first-kept duplicates)
are evaluated per identity key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormlake import config as C
from stormlake.functions.dates import parse_dates_per_file
from stormlake.functions.scalars import mid_range
from stormlake.operators.aggregate import numeric_columns
from stormlake.operators.interpolate import gated_fill, month_block
from stormlake.operators.project import (drop_null_rows, drop_tolerant, rename_by_map,
                                         select_existing, select_strict)
from stormlake.operators.window import first_per_key

# {source: {raw name: canonical name}}; the library's own where none is given
Mapping = dict[str, dict[str, str]]
ID_COLS = ["city_id"]
# columns that tell one input file from another, where the scan gives them
FILE_COLS = ["city", "source", "file", "granularity"]


def _ids(df: DataFrame, extra: list[str] | None = None) -> list[str]:
    return [c for c in ID_COLS + FILE_COLS + (extra or []) if c in df.columns]


def _position(df: DataFrame, order_extra: list[str] | None = None) -> list[str]:
    """What orders the rows of one file: its own row order where the scan gives
    it, else the date and the given columns."""
    return ["row_order"] if "row_order" in df.columns else ["date", "date_raw", *(order_extra or [])]


def _block(df: DataFrame):
    """What cuts a file's rows for the gap fill: its splits where rows come in file
    order, else the month."""
    if "row_order" in df.columns:
        return F.floor(F.col("row_order.split") / (1 << 20))
    return month_block("date")


def _measures(df: DataFrame, exclude: list[str]) -> list[str]:
    return numeric_columns(df, exclude=exclude)


def silver_base1(raw: DataFrame, order_extra: list[str] | None = None, mapping: Mapping | None = None) -> DataFrame:
    """PL1: rename, whole-file date format (no fill).  Duplicate and null
    reports are separate queries over this output."""
    ids = _ids(raw)
    df = rename_by_map(raw, "base_1", mapping)
    return parse_dates_per_file(df, "date", ids)


def silver_base2(raw: DataFrame, limit: float = C.SILVER_FILL_LIMIT, mapping: Mapping | None = None) -> DataFrame:
    """PL2: select known columns, rename, date, mid-range average, drop wind
    columns, gap fill columns with 0 < null % <= limit per city."""
    ids = _ids(raw)
    df = select_existing(raw, ids + C.BASE2_SELECT + ["row_order"])
    df = rename_by_map(df, "base_2", mapping)
    df = parse_dates_per_file(df, "date", ids)
    if "average_temperature" in df.columns:
        df = df.withColumn("average_temperature", mid_range(
            "average_temperature", "maximum_temperature", "minimum_temperature"))
    else:
        df = df.withColumn("average_temperature", mid_range(
            F.lit(None).cast("double"), "maximum_temperature", "minimum_temperature"))
    df = drop_tolerant(df, C.BASE2_DROP)
    cols = _measures(df, exclude=ids + ["date_format"])
    return gated_fill(df, cols, ids, _position(df), limit, block=_block(df))


def silver_base3(raw: DataFrame, limit: float = C.SILVER_FILL_LIMIT,
                 order_extra: list[str] | None = None, mapping: Mapping | None = None) -> DataFrame:
    """PL3: rename, date, gap fill columns with 0 < null % <= limit per file.

    Works for the daily and the hourly file; for hourly rows pass the columns
    that order observations inside a day in ``order_extra``.
    """
    order_extra = order_extra or []
    ids = _ids(raw)
    df = rename_by_map(raw, "base_3", mapping)
    df = parse_dates_per_file(df, "date", ids)
    cols = _measures(df, exclude=ids + order_extra + ["date_format"])
    return gated_fill(df, cols, ids, _position(df, order_extra), limit, block=_block(df))


def first_reports(df: DataFrame, ordinal: str) -> DataFrame:
    """The first report of each (city, or file of no known city, date, event type)."""
    if "file" not in df.columns:
        return first_per_key(df, ["city_id", "date", "eventType"], ordinal)
    d = df.withColumn("__file", F.when(F.col("city_id").isNull(), F.col("file")))
    return first_per_key(d, ["city_id", "__file", "date", "eventType"], ordinal).drop("__file")


def silver_disaster(raw: DataFrame, ordinal: str = "ordinal", mapping: Mapping | None = None) -> DataFrame:
    """PL4: keep 3 columns, drop incomplete rows, rename, date, then keep the
    first report of each (city, date, event type); reports of a file of no known city
    repeat inside that file only."""
    ids = _ids(raw)
    df = select_strict(raw, ids + [ordinal] + C.DISASTER_SELECT)
    df = drop_null_rows(df, subset=C.DISASTER_SELECT)
    df = rename_by_map(df, "base_disaster", mapping)
    df = parse_dates_per_file(df, "date", ids)
    return first_reports(df, ordinal)


def merge_first(parts: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """First report of each (city or file of no known city, date, event type) over
    parts that were each reduced to theirs."""
    return first_reports(parts, ordinal)
