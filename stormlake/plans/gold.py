"""Silver -> gold: labelled city-days per source (PL5-PL7).

All cities of a source in one job, keyed by ``city_id``.  The disaster side
keeps only (city, date, eventType); dates match null to null as in the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from stormlake import config as C
from stormlake.functions.scalars import fill_from, occurred, season
from stormlake.operators.aggregate import day_means
from stormlake.operators.interpolate import gated_fill, month_block
from stormlake.operators.joins import full_outer_null_safe, left_on
from stormlake.operators.project import drop_strict
from stormlake.session import materialize

KEYS = ["city_id", "date"]


def _disasters(disaster_silver: DataFrame) -> DataFrame:
    return disaster_silver.select("city_id", "date", "eventType")


def _clean(df: DataFrame) -> DataFrame:
    return df.drop("date_raw", "date_format")


def _label(df: DataFrame) -> DataFrame:
    return df.withColumn("disaster_occurred", occurred("eventType"))


def gold_base1(daily: DataFrame, hourly: DataFrame, disaster_silver: DataFrame,
               hourly_cols: list[str] | None = None) -> DataFrame:
    """PL5: season on the daily rows, hourly day means joined left, then the
    full outer join with disasters and the label."""
    hourly_cols = hourly_cols or ["relative_humidity", "sea_level_air_pressure",
                                  "surface_air_pressure"]
    d = _clean(daily).withColumn("season", season("date"))
    means = day_means(hourly, KEYS, [c for c in hourly_cols if c in hourly.columns])
    base = left_on(d, means, KEYS)
    return _label(full_outer_null_safe(base, _disasters(disaster_silver), KEYS, null_safe=["date"]))


def gold_base2(daily: DataFrame, disaster_silver: DataFrame) -> DataFrame:
    """PL6: season, full outer join with disasters, label."""
    d = _clean(daily).withColumn("season", season("date"))
    return _label(full_outer_null_safe(d, _disasters(disaster_silver), KEYS, null_safe=["date"]))


def gold_base3(daily: DataFrame, hourly: DataFrame, disaster_silver: DataFrame,
               limit: float = C.GOLD_FILL_LIMIT) -> DataFrame:
    """PL7: fill daily precipitation / wind from the same day's hourly means,
    drop sunshine and gust, join dewpoint and humidity means, gap fill columns
    with 0 < null % <= 40 per city, full outer join with disasters, then season
    (after the join, so disaster-only days get one) and the label."""
    fill_cols = ["precipitation", "wind_direction", "wind_speed"]
    mean_cols = ["dewpoint", "relative_humidity"] + fill_cols
    means = day_means(hourly, KEYS, mean_cols)
    m = means.withColumnsRenamed({c: f"__h_{c}" for c in fill_cols})
    d = left_on(_clean(daily), m, KEYS)
    d = d.withColumns({c: fill_from(c, f"__h_{c}") for c in fill_cols})
    d = d.drop(*[f"__h_{c}" for c in fill_cols])
    d = drop_strict(d, ["total_sunshine_duration", "wind_gust"])
    # the gap fill reads this joined daily table three times (gate check,
    # windows, block summary): materialise it once in the shared checkpoint
    # dir, which also cuts the long silver lineage
    d = materialize(d)
    cols = [c for c in d.columns if c not in KEYS]
    d = gated_fill(d, cols, ["city_id"], ["date"], limit, block=month_block("date"))
    g = full_outer_null_safe(d, _disasters(disaster_silver), KEYS, null_safe=["date"])
    return _label(g.withColumn("season", season("date")))
