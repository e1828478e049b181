"""Disaster trend and report tables (PL8, PL9 and its parts AG2-AG6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stormlake import config as C
from stormlake.functions.scalars import lenient_year, season, zero_fill_int
from stormlake.operators.aggregate import count_by, pivot_counts
from stormlake.operators.joins import left_on
from stormlake.operators.window import ema, sma, year_spine


def with_year(df: DataFrame, date_col: str = "date") -> DataFrame:
    """FN4 on a date or text column."""
    c = F.col(date_col)
    is_text = dict(df.dtypes)[date_col] == "string"
    return df.withColumn("year", lenient_year(c) if is_text else F.year(c))


def disasters_over_years(disasters: DataFrame, keys: list[str] | None = None,
                         window: int = C.MOVING_AVERAGE_WINDOW) -> DataFrame:
    """PL8: disasters per year on a gap-free year spine, with SMA and EMA.

    ``keys`` (default: city) make it one job for every city.  The spine and
    the counts are one row per (city, year), so the moving-average windows
    sort a few dozen rows per city, however many disasters there are.
    """
    keys = keys if keys is not None else ["city_id"]
    y = with_year(disasters)
    counts = count_by(y, keys + ["year"])
    spine = year_spine(y.where(F.col("year").isNotNull()), keys)
    t = left_on(spine, counts, keys + ["year"]).withColumn("count", zero_fill_int("count"))
    t = sma(t, "count", keys, ["year"], window)
    t = ema(t, "count", keys, ["year"], window)
    return t.select(*keys, F.col("year").cast("int").alias("year"), "count",
                    "count_moving_average_sma", "count_moving_average_ema")


def ranked(report: DataFrame, order: list, keys: list[str] | None = None) -> DataFrame:
    """ST1: a report's presented order as a column (a report is a few rows a key)."""
    w = Window.partitionBy(*(keys or [])).orderBy(*order)
    return report.withColumn("report_rank", F.row_number().over(w))


def disasters_by_year(disasters: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """AG2: rows per year (unparseable dates dropped)."""
    keys = keys if keys is not None else ["city_id"]
    return count_by(with_year(disasters), keys + ["year"])


def disasters_by_type(disasters: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """AG3: rows per event type (nulls dropped); present ascending by count."""
    keys = keys if keys is not None else ["city_id"]
    return count_by(disasters, keys + ["eventType"])


def disasters_by_season(disasters: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """AG4: rows per season of the (lenient) date."""
    keys = keys if keys is not None else ["city_id"]
    d = disasters
    if dict(d.dtypes)["date"] == "string":
        d = d.withColumn("date", F.to_date(F.try_to_timestamp(F.col("date"))))
    return count_by(d.withColumn("season", season("date")), keys + ["season"])


def disasters_by_city(disasters: DataFrame, city_col: str = "city_id") -> DataFrame:
    """AG5: rows per city; present ascending by count."""
    return count_by(disasters, [city_col])


def event_types_over_years(disasters: DataFrame, keys: list[str] | None = None,
                           values: list[str] | None = None) -> DataFrame:
    """AG6: (city, year) x event type counts, missing -> 0."""
    keys = keys if keys is not None else ["city_id"]
    y = with_year(disasters).where(F.col("year").isNotNull())
    return pivot_counts(y, keys + ["year"], "eventType", values)
