"""Weather / disaster views derived from the driver's test tables.

The test tables hold no weather, so these views map them onto the shapes the
pipelines expect.  Each view has a Spark builder and the same view in DuckDB
SQL (``*_SQL``), so a query and its oracle start from identical rows.  Every
view reads whole tables; rows are chosen only by value predicates.

``city_id`` 0..7 stands for the cities of ``config.CITIES`` in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormlake import config as C

N_CITIES = len(C.CITIES)
# every order is a storm report; those below this value name no event type, so
# that days with a disaster stay the rarer class
DISASTER_MIN_PRICE = 450000.0
# the types that the reports name
EVENT_TYPE_VALUES = ["HIGH", "LOW", "MEDIUM", "URGENT"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def city_name(city_id) -> F.Column:
    names = F.array(*[F.lit(c) for c in C.CITIES])
    return F.element_at(names, city_id.cast("int") + 1)


CITY_NAME_SQL = "[" + ", ".join(f"'{c}'" for c in C.CITIES) + "]"


def city_dim(spark: SparkSession) -> DataFrame:
    """SC8/SC9 as a table: city_id, city, lat, lon, station (fixed, 8 rows)."""
    rows = [(i, c, C.CITY_COORDINATES[c][0], C.CITY_COORDINATES[c][1], C.CITY_STATIONS[c])
            for i, c in enumerate(C.CITIES)]
    return spark.createDataFrame(rows, "city_id int, city string, lat double, lon double, station int")


# --------------------------------------------------------------------------
# weather_daily: orders grouped by (customer % 8, order day)
# --------------------------------------------------------------------------
def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    g = (o.groupBy((F.col("o_custkey") % N_CITIES).cast("int").alias("city_id"),
                   F.to_date("o_orderdate").alias("date"))
          .agg(F.max("o_totalprice").alias("mx"), F.min("o_totalprice").alias("mn"),
               F.min("o_orderkey").alias("k")))
    k = F.col("k")
    return g.select(
        "city_id", "date",
        (F.col("mx") / F.lit(10000.0)).alias("maximum_temperature"),
        (F.col("mn") / F.lit(20000.0)).alias("minimum_temperature"),
        F.when(k % 9 != 0, F.col("mx") / F.lit(15000.0)).alias("average_temperature"),
        F.when(k % 6 != 0, (k % 100) / F.lit(10.0)).alias("precipitation"),
        F.when(k % 3 != 0, (k % 40).cast("double")).alias("snow_depth"),
        F.when(k % 2 != 0, (k % 30).cast("double")).alias("wind_speed"),
        F.when(k % 4 != 0, (k % 360).cast("double")).alias("wind_direction"),
        (F.col("mx") / F.lit(5000.0)).alias("wind_gust"),
        (k % 600).cast("double").alias("sunshine_duration"),
    )


WEATHER_DAILY_SQL = f"""
SELECT city_id, date,
  mx / 10000.0::DOUBLE AS maximum_temperature,
  mn / 20000.0::DOUBLE AS minimum_temperature,
  CASE WHEN k % 9 <> 0 THEN mx / 15000.0::DOUBLE END AS average_temperature,
  CASE WHEN k % 6 <> 0 THEN (k % 100) / 10.0::DOUBLE END AS precipitation,
  CASE WHEN k % 3 <> 0 THEN CAST(k % 40 AS DOUBLE) END AS snow_depth,
  CASE WHEN k % 2 <> 0 THEN CAST(k % 30 AS DOUBLE) END AS wind_speed,
  CASE WHEN k % 4 <> 0 THEN CAST(k % 360 AS DOUBLE) END AS wind_direction,
  mx / 5000.0::DOUBLE AS wind_gust,
  CAST(k % 600 AS DOUBLE) AS sunshine_duration
FROM (SELECT CAST(o_custkey % {N_CITIES} AS INTEGER) AS city_id, CAST(o_orderdate AS DATE) AS date,
             max(o_totalprice) AS mx, min(o_totalprice) AS mn, min(o_orderkey) AS k
      FROM orders GROUP BY 1, 2) g
"""


# --------------------------------------------------------------------------
# weather_hourly: one observation per lineitem row
# --------------------------------------------------------------------------
HOURLY_ORDER = ["obs_ts", "ord_a", "ord_b", "ord_c"]


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ts = F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_linenumber"))
    return li.select(
        (F.col("l_suppkey") % N_CITIES).cast("int").alias("city_id"),
        ts.alias("obs_ts"),
        F.to_date(ts).alias("date"),
        F.col("l_orderkey").alias("ord_a"), F.col("l_partkey").alias("ord_b"),
        F.col("l_suppkey").alias("ord_c"),
        F.when(F.col("l_linenumber") != 3, F.col("l_quantity")).alias("relative_humidity"),
        F.col("l_extendedprice").alias("sea_level_air_pressure"),
        (F.col("l_discount") * F.lit(100.0)).alias("dewpoint"),
        (F.col("l_tax") * F.lit(100.0)).alias("precipitation"),
        (F.col("l_partkey") % 360).cast("double").alias("wind_direction"),
        (F.col("l_quantity") / F.lit(2.0)).alias("wind_speed"),
    )


WEATHER_HOURLY_SQL = f"""
SELECT CAST(l_suppkey % {N_CITIES} AS INTEGER) AS city_id,
  l_shipdate + to_hours(l_linenumber) AS obs_ts,
  CAST(l_shipdate + to_hours(l_linenumber) AS DATE) AS date,
  l_orderkey AS ord_a, l_partkey AS ord_b, l_suppkey AS ord_c,
  CASE WHEN l_linenumber <> 3 THEN l_quantity END AS relative_humidity,
  l_extendedprice AS sea_level_air_pressure,
  l_discount * 100.0::DOUBLE AS dewpoint,
  l_tax * 100.0::DOUBLE AS precipitation,
  CAST(l_partkey % 360 AS DOUBLE) AS wind_direction,
  l_quantity / 2.0::DOUBLE AS wind_speed
FROM lineitem
"""


# --------------------------------------------------------------------------
# storm_events_raw: every order as a storm report, raw (CSV-like) shape
# --------------------------------------------------------------------------
def storm_events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw disaster rows: text BEGIN_DATE in one format per city file.

    city_id % 3 picks ``MM/dd/yyyy HH:mm:ss``, ``yyyy-M-d`` or ``d/M/yyyy``;
    reported the day after the order; a '4-NOT SPECIFIED' priority and an order
    below DISASTER_MIN_PRICE have no type.
    """
    o = table(spark, sf_dir, "orders")
    cid = (F.col("o_custkey") % N_CITIES).cast("int")
    d = F.date_add(F.to_date("o_orderdate"), 1)
    text = (F.when(cid % 3 == 0, F.concat(F.date_format(d, "MM/dd/yyyy"), F.lit(" 00:00:00")))
             .when(cid % 3 == 1, F.date_format(d, "yyyy-M-d"))
             .otherwise(F.date_format(d, "d/M/yyyy")))
    named = (F.col("o_orderpriority") != "4-NOT SPECIFIED") & (F.col("o_totalprice") >= F.lit(DISASTER_MIN_PRICE))
    etype = F.when(named, F.substring("o_orderpriority", 3, 100))
    return o.select(
        F.col("o_orderkey").alias("ordinal"),
        cid.alias("city_id"),
        F.upper(city_name(cid)).alias("CZ_NAME_STR"),
        text.alias("BEGIN_DATE"),
        etype.alias("EVENT_TYPE"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit("\nstatus "),
                 F.col("o_orderstatus")).alias("EVENT_NARRATIVE"),
    )


def storm_city(cz_name):
    """City number of a raw report's CZ_NAME_STR."""
    return (F.array_position(F.array(*[F.lit(c.upper()) for c in C.CITIES]), cz_name) - 1).cast("int")


STORM_EVENTS_RAW_SQL = f"""
SELECT o_orderkey AS ordinal, city_id,
  upper({CITY_NAME_SQL}[city_id + 1]) AS CZ_NAME_STR,
  CASE WHEN city_id % 3 = 0 THEN strftime(d, '%m/%d/%Y') || ' 00:00:00'
       WHEN city_id % 3 = 1 THEN strftime(d, '%Y-%-m-%-d')
       ELSE strftime(d, '%-d/%-m/%Y') END AS BEGIN_DATE,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' AND o_totalprice >= {DISASTER_MIN_PRICE}::DOUBLE
       THEN substr(o_orderpriority, 3, 100) END AS EVENT_TYPE,
  'Order ' || CAST(o_orderkey AS VARCHAR) || chr(10) || 'status ' || o_orderstatus AS EVENT_NARRATIVE
FROM (SELECT *, CAST(o_custkey % {N_CITIES} AS INTEGER) AS city_id,
             CAST(o_orderdate AS DATE) + 1 AS d
      FROM orders) o
"""


# --------------------------------------------------------------------------
# raw weather files per source, with the source's own column names
# --------------------------------------------------------------------------
def raw_base1_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = weather_daily(spark, sf_dir)
    return w.select(
        "city_id",
        F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit(" 00:00:00+00:00")).alias("date"),
        F.col("maximum_temperature").alias("temperature_2m_max"),
        F.col("minimum_temperature").alias("temperature_2m_min"),
        F.col("average_temperature").alias("temperature_2m_mean"),
        F.col("precipitation").alias("rain_sum"),
        F.col("snow_depth").alias("snowfall_sum"),
        F.col("wind_speed").alias("wind_speed_10m_max"),
        F.col("wind_gust").alias("wind_gusts_10m_max"),
        F.col("wind_direction").alias("wind_direction_10m_dominant"),
    )


RAW_BASE1_DAILY_SQL = f"""
SELECT city_id, strftime(date, '%Y-%m-%d') || ' 00:00:00+00:00' AS date,
  maximum_temperature AS temperature_2m_max, minimum_temperature AS temperature_2m_min,
  average_temperature AS temperature_2m_mean, precipitation AS rain_sum,
  snow_depth AS snowfall_sum, wind_speed AS wind_speed_10m_max,
  wind_gust AS wind_gusts_10m_max, wind_direction AS wind_direction_10m_dominant
FROM ({WEATHER_DAILY_SQL}) w
"""


def raw_base1_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = weather_hourly(spark, sf_dir)
    return h.select(
        "city_id", *HOURLY_ORDER[1:],
        F.concat(F.date_format("obs_ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00")).alias("date"),
        F.col("relative_humidity").alias("relative_humidity_2m"),
        F.col("sea_level_air_pressure").alias("pressure_msl"),
        (F.col("sea_level_air_pressure") / F.lit(2.0)).alias("surface_pressure"),
    )


RAW_BASE1_HOURLY_SQL = f"""
SELECT city_id, ord_a, ord_b, ord_c,
  strftime(obs_ts, '%Y-%m-%d %H:%M:%S') || '+00:00' AS date,
  relative_humidity AS relative_humidity_2m, sea_level_air_pressure AS pressure_msl,
  sea_level_air_pressure / 2.0::DOUBLE AS surface_pressure
FROM ({WEATHER_HOURLY_SQL}) h
"""


def raw_base2_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = weather_daily(spark, sf_dir)
    return w.select(
        "city_id",
        F.date_format("date", "yyyy-MM-dd").alias("DATE"),
        F.col("wind_speed").alias("AWND"),
        F.col("precipitation").alias("PRCP"),
        F.col("snow_depth").alias("SNWD"),
        F.col("average_temperature").alias("TAVG"),
        F.col("maximum_temperature").alias("TMAX"),
        F.col("minimum_temperature").alias("TMIN"),
        F.col("wind_direction").alias("WDFG"),
        F.col("wind_gust").alias("WSFG"),
        F.lit("STATION").alias("NAME"),
    )


RAW_BASE2_DAILY_SQL = f"""
SELECT city_id, strftime(date, '%Y-%m-%d') AS DATE, wind_speed AS AWND, precipitation AS PRCP,
  snow_depth AS SNWD, average_temperature AS TAVG, maximum_temperature AS TMAX,
  minimum_temperature AS TMIN, wind_direction AS WDFG, wind_gust AS WSFG, 'STATION' AS NAME
FROM ({WEATHER_DAILY_SQL}) w
"""


def raw_base3_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = weather_daily(spark, sf_dir)
    return w.select(
        "city_id",
        F.date_format("date", "yyyy-MM-dd").alias("time"),
        F.col("average_temperature").alias("tavg"),
        F.col("minimum_temperature").alias("tmin"),
        F.col("maximum_temperature").alias("tmax"),
        F.col("precipitation").alias("prcp"),
        F.col("snow_depth").alias("snow"),
        F.col("wind_direction").alias("wdir"),
        F.col("wind_speed").alias("wspd"),
        F.col("wind_gust").alias("wpgt"),
        F.col("sunshine_duration").alias("tsun"),
    )


RAW_BASE3_DAILY_SQL = f"""
SELECT city_id, strftime(date, '%Y-%m-%d') AS time, average_temperature AS tavg,
  minimum_temperature AS tmin, maximum_temperature AS tmax, precipitation AS prcp,
  snow_depth AS snow, wind_direction AS wdir, wind_speed AS wspd, wind_gust AS wpgt,
  sunshine_duration AS tsun
FROM ({WEATHER_DAILY_SQL}) w
"""


def raw_base3_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = weather_hourly(spark, sf_dir)
    return h.select(
        "city_id", *HOURLY_ORDER[1:],
        F.date_format("obs_ts", "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.col("dewpoint").alias("dwpt"),
        F.col("relative_humidity").alias("rhum"),
        F.col("precipitation").alias("prcp"),
        F.col("wind_direction").alias("wdir"),
        F.col("wind_speed").alias("wspd"),
    )


RAW_BASE3_HOURLY_SQL = f"""
SELECT city_id, ord_a, ord_b, ord_c, strftime(obs_ts, '%Y-%m-%d %H:%M:%S') AS time,
  dewpoint AS dwpt, relative_humidity AS rhum, precipitation AS prcp,
  wind_direction AS wdir, wind_speed AS wspd
FROM ({WEATHER_HOURLY_SQL}) h
"""


# --------------------------------------------------------------------------
# model-side views
# --------------------------------------------------------------------------
def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels joined to documents: (doc_id, label, prediction, score)."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lab.join(doc, "doc_id").select(
        "doc_id", F.col("quality").alias("label"), F.col("toxic").alias("prediction"),
        F.col("n_chars").cast("double").alias("score"))


SCORED_SQL = """
SELECT l.doc_id, l.quality AS label, l.toxic AS prediction, CAST(d.n_chars AS DOUBLE) AS score
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as feature rows: (id, features array<double>, disaster_occurred)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("features"),
                    (F.col("label") == 0).cast("int").alias("disaster_occurred"))


VECTORS_SQL = """
SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS features,
       CAST(label = 0 AS INTEGER) AS disaster_occurred
FROM embeddings
"""


def api_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series responses (SC12 input): one per embedding row, hourly steps."""
    e = table(spark, sf_dir, "embeddings")
    start = F.lit("1973-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days=F.col("vec_id"))
    vals = F.transform("embedding", lambda x: x.cast("double"))
    return e.select(
        F.col("vec_id").alias("response_id"),
        (F.col("vec_id") % N_CITIES).cast("int").alias("city_id"),
        start.alias("start"),
        (start + F.make_dt_interval(hours=F.size("embedding"))).alias("end"),
        F.lit(3600).alias("interval_seconds"),
        vals.alias("relative_humidity_2m"),
        F.reverse(vals).alias("pressure_msl"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log rows from supplier: params and metrics as maps (RN1 shape)."""
    s = table(spark, sf_dir, "supplier")
    exp = F.concat(F.lit("DataBase_base_"), ((F.col("s_nationkey") % 3) + 1).cast("string"))
    params = F.create_map(
        F.lit("model"), F.concat(F.lit("model_"), (F.col("s_suppkey") % 3).cast("string")),
        F.lit("max_depth"), (F.col("s_nationkey") % 7 + 2).cast("string"))
    metrics = F.when(
        F.col("s_suppkey") % 2 == 0,
        F.create_map(F.lit("recall"), F.col("s_acctbal") / F.lit(10000.0),
                     F.lit("f1_score"), F.col("s_acctbal") / F.lit(20000.0)),
    ).otherwise(F.create_map(F.lit("recall"), F.col("s_acctbal") / F.lit(10000.0),
                             F.lit("auc_roc"), F.col("s_acctbal") / F.lit(30000.0)))
    return s.select(
        F.col("s_suppkey").cast("string").alias("run_id"),
        exp.alias("experiment"),
        F.lit("FINISHED").alias("status"),
        (F.col("s_suppkey") * 1000).alias("start_time"),
        (F.col("s_suppkey") * 1000 + F.col("s_nationkey")).alias("end_time"),
        params.alias("params"), metrics.alias("metrics"))
