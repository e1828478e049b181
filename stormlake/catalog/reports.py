"""Report, profile and set queries (AG1-AG11, WN5, ST2-ST4, PJ9, JN3, FN2-FN3)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from stormlake import config as C
from stormlake import oracles as O
from stormlake.catalog import register
from stormlake.catalog.layers import (silver_base1_daily_df, silver_base2_df,
                                      silver_base3_daily_df, silver_base3_hourly_df,
                                      silver_disaster_df)
from stormlake.functions.scalars import season, with_date_parts
from stormlake.operators.aggregate import day_means, event_counts_per_file, year_range
from stormlake.operators.interpolate import month_block
from stormlake.operators.joins import left_null_safe_suffixed
from stormlake.operators.profile import distinct_values, null_percentages, schema_profile
from stormlake.operators.project import head
from stormlake.operators.sets import expected_not_seen, seen_not_expected, union_all_by_name, vocabulary
from stormlake.operators.window import duplicates_report, ema
from stormlake.plans import gold, trends
from stormlake.session import materialize, scratch_path
from stormlake.sources import fixtures as X
from stormlake.sources.files import city_id_of, load_cities, load_stations

SD = O.silver_disaster
YEAR_SQL = "CAST(year(date) AS INTEGER)"


@register("hourly_day_means", lambda: f"""
SELECT city_id, date, {', '.join(f'avg({c}) AS {c}' for c in O.SILVER3H_MEAS)}
FROM ({O.silver_base3_hourly()}) h GROUP BY city_id, date""")
def q_hourly_day_means(spark, sf):
    """AG1: day means of every hourly measure, per city."""
    return day_means(silver_base3_hourly_df(spark, sf), ["city_id", "date"], O.SILVER3H_MEAS)


def _hourly_ema_sql() -> str:
    # weights of values more than 90 rows back are below 2^-90
    order = "PARTITION BY city_id ORDER BY obs_ts, ord_a, ord_b, ord_c ROWS BETWEEN 90 PRECEDING AND CURRENT ROW"
    alpha = 2.0 / (C.MOVING_AVERAGE_WINDOW + 1)
    one = f"""SELECT city_id, ord_a, ord_b, ord_c, obs_ts, sea_level_air_pressure,
  list(sea_level_air_pressure) OVER ({order}) AS l FROM ({X.WEATHER_HOURLY_SQL}) h"""
    return f"""SELECT city_id, ord_a, ord_b, ord_c, CAST(CAST(list_reduce(l,
  lambda y, v: (1.0::DOUBLE - {alpha}::DOUBLE) * y + {alpha}::DOUBLE * v) AS FLOAT) AS DOUBLE) AS ema
FROM ({one}) x"""


@register("hourly_pressure_ema", _hourly_ema_sql)
def q_hourly_pressure_ema(spark, sf):
    """WN2 over the long hourly series, in month blocks: every row's average over its city's whole history
    (given in single precision: decimal rounding has ties here, as the weights are halves)."""
    h = X.weather_hourly(spark, sf)
    e = ema(h, "sea_level_air_pressure", ["city_id"], ["obs_ts", "ord_a", "ord_b", "ord_c"], out="ema", block=month_block("date"))
    return e.select("city_id", "ord_a", "ord_b", "ord_c", F.col("ema").cast("float").cast("double").alias("ema"))


@register("disasters_by_year", lambda: f"""
SELECT city_id, {YEAR_SQL} AS year, count(*) AS count FROM ({SD()}) s
WHERE date IS NOT NULL GROUP BY ALL""")
def q_disasters_by_year(spark, sf):
    """AG2 + FN4."""
    return trends.disasters_by_year(silver_disaster_df(spark, sf))


@register("reports_by_text_year", lambda: f"""
SELECT city_id, CASE WHEN city_id % 3 = 1 AND EVENT_TYPE IS NOT NULL THEN CAST(year(try_strptime(BEGIN_DATE, '%Y-%m-%d')) AS INTEGER) END AS year,
  count(*) AS count FROM ({X.STORM_EVENTS_RAW_SQL}) r
WHERE city_id % 3 = 1 AND EVENT_TYPE IS NOT NULL GROUP BY ALL""")
def q_reports_by_text_year(spark, sf):
    """FN4 on text: raw reports by the year of their date as it is written; texts
    that are no date by themselves have no year and are not counted."""
    raw = X.storm_events_raw(spark, sf).where(F.col("EVENT_TYPE").isNotNull())
    dates = raw.select("city_id", F.col("BEGIN_DATE").alias("date"))
    return trends.disasters_by_year(dates)


@register("disasters_by_type", lambda: f"""
SELECT city_id, eventType, count(*) AS count FROM ({SD()}) s
WHERE eventType IS NOT NULL GROUP BY ALL""")
def q_disasters_by_type(spark, sf):
    """AG3."""
    return trends.disasters_by_type(silver_disaster_df(spark, sf))


@register("disasters_by_season", lambda: f"""
SELECT city_id, {O.season('date')} AS season, count(*) AS count FROM ({SD()}) s GROUP BY ALL""")
def q_disasters_by_season(spark, sf):
    """AG4 + FN2."""
    return trends.disasters_by_season(silver_disaster_df(spark, sf))


_CITY_ROWS = ", ".join(
    f"({i}, '{c}', {C.CITY_COORDINATES[c][0]}::DOUBLE, {C.CITY_COORDINATES[c][1]}::DOUBLE, "
    f"{C.CITY_STATIONS[c]})" for i, c in enumerate(C.CITIES))


@register("disasters_by_city", lambda: f"""
SELECT d.city_id, d.city, d.lat, d.lon, d.station, c.count FROM
  (SELECT city_id, count(*) AS count FROM ({SD()}) s GROUP BY city_id) c
JOIN (VALUES {_CITY_ROWS}) d(city_id, city, lat, lon, station) ON c.city_id = d.city_id""")
def q_disasters_by_city(spark, sf):
    """AG5 with the city and station dimensions loaded from their JSON files (SC8, SC9)."""
    counts = trends.disasters_by_city(silver_disaster_df(spark, sf))
    dim = _city_dim(spark)
    return counts.join(dim, "city_id").select("city_id", "city", "lat", "lon", "station", "count")


def _city_dim(spark):
    """The dimensions as the source keeps them, one JSON array a file."""
    def load(reader, rows):
        path = scratch_path(spark, "dimension")
        spark.createDataFrame([(json.dumps(rows, ensure_ascii=False),)], "value string").coalesce(1).write.text(path)
        return reader(spark, path)
    cities = load(load_cities, [{"city": c, "coordinates": list(C.CITY_COORDINATES[c])} for c in C.CITIES])
    stations = load(load_stations, [{"city": c, "sation": C.CITY_STATIONS[c]} for c in C.CITIES])
    return cities.join(stations, "city").withColumn("city_id", city_id_of(F.col("city")))


_TYPE_COUNTS = ", ".join(f"count(*) FILTER (WHERE eventType = '{v}') AS \"{v}\"" for v in X.EVENT_TYPE_VALUES)


@register("event_types_over_years", lambda: f"""
SELECT city_id, {YEAR_SQL} AS year, {_TYPE_COUNTS}
FROM ({SD()}) s WHERE date IS NOT NULL AND eventType IS NOT NULL GROUP BY city_id, {YEAR_SQL}""")
def q_event_types_over_years(spark, sf):
    """AG6: (city, year) x event type, missing -> 0."""
    return trends.event_types_over_years(silver_disaster_df(spark, sf), values=X.EVENT_TYPE_VALUES)


@register("event_counts_per_file", lambda: f"""
SELECT source_file, EVENT_TYPE, count, file_rows FROM (
  SELECT source_file, EVENT_TYPE, count(*) AS count,
         sum(count(*)) OVER (PARTITION BY source_file) AS file_rows
  FROM (SELECT lower(CZ_NAME_STR) || '_storm_events.csv' AS source_file, EVENT_TYPE
        FROM ({X.STORM_EVENTS_RAW_SQL}) r) f GROUP BY source_file, EVENT_TYPE) x
WHERE EVENT_TYPE IS NOT NULL""")
def q_event_counts_per_file(spark, sf):
    """AG7: event counts per raw file, by the names of the files that are read."""
    from stormlake.catalog.io import storm_files

    raw = storm_files(spark, sf).withColumn("source_file", F.concat("file", F.lit(".csv")))
    return event_counts_per_file(raw, "source_file", "EVENT_TYPE").select(
        "source_file", "EVENT_TYPE", "count", "file_rows")


_PROFILE_COLS = ["date", "maximum_temperature", "minimum_temperature", "average_temperature",
                 "precipitation", "snowfall", "wind_speed", "wind_speed_gust", "wind_direction"]


@register("null_profile", lambda: " UNION ALL ".join(
    f"""SELECT city_id, '{c}' AS column_name,
  round_even((sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) / count(*)) * 100.0::DOUBLE, 2) AS null_pct
FROM ({O.silver_base1()}) s GROUP BY city_id""" for c in _PROFILE_COLS))
def q_null_profile(spark, sf):
    """AG8 + FN9: null % per city and column, two digits half-even."""
    return null_percentages(silver_base1_daily_df(spark, sf), _PROFILE_COLS, ["city_id"])


@register("event_types_first_seen", lambda: f"""
SELECT EVENT_TYPE, min(ordinal) AS first_seen FROM ({X.STORM_EVENTS_RAW_SQL}) r
WHERE EVENT_TYPE IS NOT NULL GROUP BY EVENT_TYPE""")
def q_event_types_first_seen(spark, sf):
    """AG9 / ST4: the distinct event types over all files, with first-seen order."""
    raw = X.storm_events_raw(spark, sf).where(F.col("EVENT_TYPE").isNotNull())
    return distinct_values(raw, "EVENT_TYPE", order_col="ordinal")


_SCHEMA = [("city_id", "int"), ("ordinal", "bigint"), ("location", "string"),
           ("date", "date"), ("eventType", "string")]


@register("silver_disaster_schema", lambda: f"""
SELECT n_rows, position, column_name, dtype, non_null FROM (
  SELECT count(*) AS n_rows, {', '.join(f'count({c}) AS c{i}' for i, (c, _) in enumerate(_SCHEMA))}
  FROM ({SD()}) s) a,
  (VALUES {', '.join(f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(_SCHEMA))}) v(position, column_name, dtype),
  LATERAL (SELECT CASE position {' '.join(f'WHEN {i} THEN c{i}' for i in range(len(_SCHEMA)))} END AS non_null)""")
def q_silver_disaster_schema(spark, sf):
    """AG10: row count, column types and non-null counts."""
    return schema_profile(silver_disaster_df(spark, sf).select(*[c for c, _ in _SCHEMA]))


@register("disaster_year_range", lambda: f"""
SELECT city_id, min({YEAR_SQL}) AS min_year, max({YEAR_SQL}) AS max_year FROM ({SD()}) s
GROUP BY city_id""")
def q_disaster_year_range(spark, sf):
    """AG11."""
    return year_range(trends.with_year(silver_disaster_df(spark, sf)), "year", ["city_id"])


@register("duplicate_disaster_dates", lambda: f"""
SELECT city_id, ordinal, date, eventType, duplicate_count FROM (
  SELECT *, count(*) OVER (PARTITION BY city_id, date) AS duplicate_count FROM ({SD()}) s) x
WHERE duplicate_count > 1""")
def q_duplicate_disaster_dates(spark, sf):
    """WN5: every member of a (city, date) seen more than once, with its group size."""
    d = silver_disaster_df(spark, sf).select("city_id", "ordinal", "date", "eventType")
    return duplicates_report(d, ["city_id", "date"])


_VOCAB = ", ".join("('" + v.replace("'", "''") + "')" for v in C.EVENT_TYPES)


@register("event_types_not_seen", lambda: f"""
SELECT eventType FROM (VALUES {_VOCAB}) v(eventType)
WHERE eventType NOT IN (SELECT eventType FROM ({SD()}) s WHERE eventType IS NOT NULL)""")
def q_event_types_not_seen(spark, sf):
    """ST2: official event types absent from the data."""
    seen = silver_disaster_df(spark, sf).select("eventType")
    return expected_not_seen(vocabulary(spark), seen)


@register("event_types_unexpected", lambda: f"""
SELECT DISTINCT eventType FROM ({SD()}) s
WHERE eventType IS NOT NULL AND eventType NOT IN (SELECT * FROM (VALUES {_VOCAB}) v(e))""")
def q_event_types_unexpected(spark, sf):
    """ST3: event types in the data that are not official."""
    seen = silver_disaster_df(spark, sf).select("eventType")
    return seen_not_expected(seen, vocabulary(spark))


@register("gold_base2_head", lambda: f"""
SELECT * FROM ({O.gold_base2()}) g ORDER BY city_id, date NULLS FIRST, eventType NULLS FIRST LIMIT 10""")
def q_gold_base2_head(spark, sf):
    """PJ9: the first rows of a gold table by key (a top-n report)."""
    g = gold.gold_base2(silver_base2_df(spark, sf), silver_disaster_df(spark, sf))
    return head(g, 10, ["city_id", "date", "eventType"])


@register("season_of_day", lambda: f"""
SELECT city_id, date, {O.season('date')} AS season FROM ({X.WEATHER_DAILY_SQL}) w""")
def q_season_of_day(spark, sf):
    """FN2 on every weather day."""
    return X.weather_daily(spark, sf).select("city_id", "date", season("date").alias("season"))


@register("date_parts", lambda: f"""
SELECT city_id, date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
  CAST(day(date) AS INTEGER) AS day FROM ({X.WEATHER_DAILY_SQL}) w""")
def q_date_parts(spark, sf):
    """FN3."""
    return with_date_parts(X.weather_daily(spark, sf).select("city_id", "date"), "date")


_JN3_KEYS = ["precipitation", "wind_direction", "wind_speed"]


@register("value_key_join", lambda: f"""
SELECT d.city_id, d.precipitation, d.wind_direction, d.wind_speed, d.date AS date_df1,
  h.date AS date_df2, h.dewpoint, h.relative_humidity, d.average_temperature,
  d.maximum_temperature, d.minimum_temperature
FROM ({O.silver_base3_daily()}) d LEFT JOIN (
  SELECT city_id, date, avg(dewpoint) AS dewpoint, avg(relative_humidity) AS relative_humidity,
    avg(precipitation) AS precipitation, avg(wind_direction) AS wind_direction,
    avg(wind_speed) AS wind_speed
  FROM ({O.silver_base3_hourly()}) x GROUP BY city_id, date) h
ON d.city_id = h.city_id AND {' AND '.join(f'd.{k} IS NOT DISTINCT FROM h.{k}' for k in _JN3_KEYS)}""")
def q_value_key_join(spark, sf):
    """JN3: the source's literal join of daily rows to hourly day means on
    three measured values (null matches null), overlapping names suffixed."""
    daily = silver_base3_daily_df(spark, sf).select(
        "city_id", "date", *_JN3_KEYS, "average_temperature", "maximum_temperature",
        "minimum_temperature")
    means = day_means(silver_base3_hourly_df(spark, sf), ["city_id", "date"],
                      ["dewpoint", "relative_humidity", *_JN3_KEYS])
    return left_null_safe_suffixed(daily, means, ["city_id", *_JN3_KEYS])


# --- PL9: the disaster report as one table -----------------------------------
_REPORT_COLS = ["location", "date", "eventType"]
_SILVER_COLS = ["city_id", *_REPORT_COLS]


def _report_sql() -> str:
    counts = [("by_year", f"CAST({YEAR_SQL} AS VARCHAR)", "item", "date IS NOT NULL"),
              ("by_type", "eventType", "n, item", "eventType IS NOT NULL"),
              ("by_season", O.season("date"), "item", "true")]
    parts = [f"""SELECT '{name}' AS report, city_id, item, CAST(n AS DOUBLE) AS value,
  row_number() OVER (PARTITION BY city_id ORDER BY {order}) AS report_rank FROM (
  SELECT city_id, {item} AS item, count(*) AS n FROM s WHERE {keep} GROUP BY 1, 2)""" for name, item, order, keep in counts]
    parts.append("""SELECT 'by_city' AS report, city_id, CAST(city_id AS VARCHAR) AS item, CAST(n AS DOUBLE) AS value,
  row_number() OVER (ORDER BY n, city_id) AS report_rank FROM (SELECT city_id, count(*) AS n FROM s GROUP BY 1)""")
    nulls = " UNION ALL ".join(
        f"SELECT city_id, '{c}' AS item, round_even((count(*) - count({c})) / count(*) * 100.0::DOUBLE, 2) AS value FROM s GROUP BY 1"
        for c in _REPORT_COLS)
    parts.append(f"""SELECT 'null_pct' AS report, city_id, item, value,
  row_number() OVER (PARTITION BY city_id ORDER BY value DESC, item) AS report_rank FROM ({nulls})""")
    parts += [f"SELECT 'profile' AS report, NULL AS city_id, '{c}' AS item, CAST(count({c}) AS DOUBLE) AS value, {i} AS report_rank FROM s"
              for i, c in enumerate(_SILVER_COLS)]
    return f"WITH s AS ({SD()}) " + " UNION ALL ".join(parts)


@register("disaster_report", _report_sql)
def q_disaster_report(spark, sf):
    """PL9 / ST1: profile, null shares and counts per year, type, season and city in
    one table, each with the order in which it is presented."""
    from stormlake.plans.jobs import report_tables

    t = report_tables(materialize(silver_disaster_df(spark, sf).select(*_SILVER_COLS)))
    value = {"by_year": ("year", "count"), "by_type": ("eventType", "count"), "by_season": ("season", "count"),
             "by_city": ("city_id", "count"), "null_pct": ("column_name", "null_pct"), "profile": ("column_name", "non_null")}
    parts = []
    for name, (item, number) in value.items():
        d = t[name]
        if name == "profile":
            d = d.withColumns({"city_id": F.lit(None).cast("int"), "report_rank": F.col("position")})
        parts.append(d.select(F.lit(name).alias("report"), "city_id", F.col(item).cast("string").alias("item"),
                              F.col(number).cast("double").alias("value"), F.col("report_rank").cast("long")))
    return union_all_by_name(parts)


# --- weather silver: duplicates and nulls, before and after the gap fill ------
def _weather_quality_sql() -> str:
    before = O.silver_base3_daily(-1.0)  # a gate that fills nothing
    parts = [f"""SELECT city_id, '{stage}' AS stage, '{c}' AS column_name,
  round_even((count(*) - count({c})) / count(*) * 100.0::DOUBLE, 2) AS null_pct FROM {stage} GROUP BY city_id"""
             for stage in ("before", "after") for c in O.SILVER3_MEAS]
    dup = """SELECT city_id, 'after' AS stage, 'duplicated dates' AS column_name, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS DOUBLE) AS null_pct
  FROM (SELECT city_id, date, count(*) AS n FROM after GROUP BY 1, 2) GROUP BY city_id"""
    return f"WITH before AS ({before}), after AS ({O.silver_base3_daily()}) " + " UNION ALL ".join([*parts, dup])


@register("weather_quality", _weather_quality_sql)
def q_weather_quality(spark, sf):
    """AG8 / WN5 on weather silver: null shares per city and column before and after
    the gap fill, and rows whose date is there more than once."""
    from stormlake.plans.silver import silver_base3

    raw = X.raw_base3_daily(spark, sf)
    tables = {"before": materialize(silver_base3(raw, limit=-1.0)), "after": materialize(silver_base3(raw))}
    parts = [null_percentages(d, O.SILVER3_MEAS, ["city_id"]).withColumn("stage", F.lit(name)) for name, d in tables.items()]
    again = duplicates_report(tables["after"].select("city_id", "date"), ["city_id", "date"]).groupBy("city_id").count()
    cities = tables["after"].select("city_id").distinct().join(again, "city_id", "left")
    parts.append(cities.select("city_id", F.lit("after").alias("stage"), F.lit("duplicated dates").alias("column_name"),
                               F.coalesce("count", F.lit(0)).cast("double").alias("null_pct")))
    return union_all_by_name(parts)
