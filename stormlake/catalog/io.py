"""Source/sink queries: CSV round trips through the raw layout and the gold
Parquet layout (SC1-SC7, SC11).  Files go to a fresh folder under the shared
checkpoint directory."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from stormlake import config as C
from stormlake import oracles as O
from stormlake.catalog import register
from stormlake.catalog.modeling import gold2
from stormlake.plans import silver
from stormlake.session import scratch_path
from stormlake.sources import fixtures as X
from stormlake.sources.files import (column_map_dict, file_name, load_column_map, read_csv_lenient, read_gold,
                                     scan_raw, with_file_ordinals, write_named_csv, write_parquet)


def _reports(spark, sf):
    return X.storm_events_raw(spark, sf).select(
        F.col("ordinal").cast("string").alias("EVENT_ID"), "CZ_NAME_STR", "BEGIN_DATE",
        "EVENT_TYPE", "EVENT_NARRATIVE",
        F.concat(F.lower(X.city_name(F.col("city_id"))), F.lit("_storm_events")).alias("file"))


def _in_file_order(df, *order):
    """One CSV a file name, its rows in the given order."""
    return df.repartition("file").sortWithinPartitions("file", *order)


def storm_files(spark, sf):
    """Storm reports written as one CSV per city and scanned back."""
    root = scratch_path(spark, "raw")
    write_named_csv(_in_file_order(_reports(spark, sf), F.col("EVENT_ID").cast("long")), f"{root}/base_disaster")
    return scan_raw(spark, root)["base_disaster"]


@register("disaster_csv_silver", O.silver_disaster)
def q_disaster_csv_silver(spark, sf):
    """SC5 -> SC6/SC1 -> SC7 -> PL4: storm reports written as one CSV per city,
    scanned back with the bad-line policy, identity parsed from file names; the
    first report of a day and type is the first of its file."""
    d = storm_files(spark, sf).drop("granularity")
    first = silver.silver_disaster(d.withColumn("ordinal", F.struct("row_order", F.col("EVENT_ID").cast("long").alias("id"))))
    return first.withColumn("ordinal", F.col("ordinal.id")).drop("source", "file", "city")


_B1_DAILY = ["date", "temperature_2m_max", "temperature_2m_min", "temperature_2m_mean", "rain_sum",
             "snowfall_sum", "wind_speed_10m_max", "wind_gusts_10m_max", "wind_direction_10m_dominant"]
_B1_HOURLY = ["date", "relative_humidity_2m", "pressure_msl", "surface_pressure"]


def _base1_files(spark, sf):
    """base_1's daily and hourly files as the source names them, in one folder."""
    root = scratch_path(spark, "raw")
    name = lambda g: file_name(X.city_name(F.col("city_id")), g).alias("file")
    write_named_csv(X.raw_base1_daily(spark, sf).select(*_B1_DAILY, name("daily")), f"{root}/base_1")
    write_named_csv(X.raw_base1_hourly(spark, sf).select(*_B1_HOURLY, name("hourly")), f"{root}/base_1", mode="append")
    return scan_raw(spark, root, numeric={"base_1": [*_B1_DAILY[1:], *_B1_HOURLY[1:]]})["base_1"]


@register("silver_base1_from_csv", O.silver_base1)
def q_silver_base1_from_csv(spark, sf):
    """SC5 named weather files ``{city}_{daily|hourly}_1973_2024`` -> SC6 scan of
    both kinds, each by its own header -> PL1 on the daily files."""
    daily = _base1_files(spark, sf).where("granularity = 'daily'")
    return silver.silver_base1(daily.select("city_id", *_B1_DAILY))


@register("silver_base1_hourly_from_csv", lambda: "SELECT city_id, date, date_raw, date_format, relative_humidity, "
          f"sea_level_air_pressure, surface_air_pressure FROM ({O.silver_base1_hourly()}) s")
def q_silver_base1_hourly_from_csv(spark, sf):
    """The same folder's hourly files: PL1."""
    hourly = _base1_files(spark, sf).where("granularity = 'hourly'")
    return silver.silver_base1(hourly.select("city_id", *_B1_HOURLY))


# two of the eight cities go by names that are not known: their files keep their own reports
_UNKNOWN = {6: "boston", 7: "seattle"}


def _unknown_name(city_id):
    known = F.lower(X.city_name(city_id))
    for i, name in _UNKNOWN.items():
        known = F.when(city_id == i, F.lit(name)).otherwise(known)
    return F.concat(known, F.lit("_storm_events"))


def _unknown_sql() -> str:
    name = " ".join(f"WHEN {i} THEN '{n}'" for i, n in _UNKNOWN.items())
    return f"""SELECT CASE WHEN city_id < {min(_UNKNOWN)} THEN city_id END AS city_id,
  CASE city_id {name} ELSE {X.CITY_NAME_SQL}[city_id + 1] END || '_storm_events' AS file,
  ordinal, location, date, date_raw, date_format, eventType FROM ({O.silver_disaster()}) s"""


_UNKNOWN_COLS = ["city_id", "file", "ordinal", "location", "date", "date_raw", "date_format", "eventType"]


@register("unknown_cities_silver", _unknown_sql)
def q_unknown_cities_silver(spark, sf):
    """PL4/WN6 where files name cities that are not known: reports repeat inside
    their own file, so days and types that such files share are all kept."""
    root = scratch_path(spark, "raw")
    reports = _reports(spark, sf).withColumn("file", _unknown_name(X.storm_city(F.col("CZ_NAME_STR"))))
    write_named_csv(_in_file_order(reports, F.col("EVENT_ID").cast("long")), f"{root}/base_disaster")
    d = scan_raw(spark, root)["base_disaster"].drop("granularity")
    first = silver.silver_disaster(d.withColumn("ordinal", F.struct("row_order", F.col("EVENT_ID").cast("long").alias("id"))))
    return first.withColumn("ordinal", F.col("ordinal.id")).select(*_UNKNOWN_COLS)


@register("unknown_cities_stream", _unknown_sql)
def q_unknown_cities_stream(spark, sf):
    """The same from a file stream, three files a batch, merged on read."""
    from stormlake.streaming.ingest import read_silver_disaster, silver_disaster_stream

    root, out = scratch_path(spark, "stream-raw"), scratch_path(spark, "stream-silver")
    reports = _reports(spark, sf).withColumn("file", _unknown_name(X.storm_city(F.col("CZ_NAME_STR"))))
    write_named_csv(reports.repartition("file"), root)
    _finish(silver_disaster_stream(spark, root, out, scratch_path(spark, "stream-ckpt"), max_files=3))
    return read_silver_disaster(spark, out).select(*_UNKNOWN_COLS)


@register("file_row_numbers", lambda: f"""
SELECT {X.CITY_NAME_SQL}[city_id + 1] || '_storm_events' AS file, CAST(ordinal AS VARCHAR) AS EVENT_ID, EVENT_TYPE,
  row_number() OVER (PARTITION BY city_id ORDER BY ordinal) - 1 AS row_number FROM ({X.STORM_EVENTS_RAW_SQL}) r""")
def q_file_row_numbers(spark, sf):
    """SC1: every row's number in its own file, whatever splits the file was read in."""
    root = scratch_path(spark, "raw")
    reports = _in_file_order(_reports(spark, sf).drop("EVENT_NARRATIVE"), F.col("EVENT_ID").cast("long"))
    write_named_csv(reports, f"{root}/base_disaster")
    d = read_csv_lenient(spark, f"{root}/base_disaster")
    return with_file_ordinals(d, "row_number").select("file", "EVENT_ID", "EVENT_TYPE", "row_number")


@register("silver_base2_mapped_from_file", O.silver_base2)
def q_silver_base2_mapped_from_file(spark, sf):
    """SC10 -> PL2: the column map is read from its JSON file, as the source's job does."""
    path = scratch_path(spark, "column-map")
    spark.createDataFrame([(json.dumps(C.COLUMN_MAP),)], "value string").coalesce(1).write.text(path)
    mapping = column_map_dict(load_column_map(spark, path))
    return silver.silver_base2(X.raw_base2_daily(spark, sf), mapping=mapping)


# files of one folder with three header layouts, one of them of no known city
_LAYOUTS = [["DATE", "PRCP", "TMAX", "TMIN", "SNWD"], ["TMIN", "TMAX", "DATE", "NAME"], ["NAME", "DATE", "PRCP", "AWND", "TMAX", "WSFG", "TMIN"]]


def _layout_sql() -> str:
    cols = ["PRCP", "TMAX", "TMIN", "SNWD", "AWND", "WSFG"]
    has = lambda c: ", ".join(str(i) for i, l in enumerate(_LAYOUTS) if c in l)
    sel = ", ".join(f"CASE WHEN city_id % 3 IN ({has(c)}) THEN {c} END AS {c}" for c in cols)
    name = f"CASE WHEN city_id = 7 THEN 'boston' ELSE {X.CITY_NAME_SQL}[city_id + 1] END || '_station'"
    return f"""SELECT {name} AS file, CASE WHEN city_id <> 7 THEN {X.CITY_NAME_SQL}[city_id + 1] END AS city,
  CASE WHEN city_id <> 7 THEN city_id END AS city_id, DATE, {sel} FROM ({X.RAW_BASE2_DAILY_SQL}) r"""


@register("mixed_header_scan", _layout_sql)
def q_mixed_header_scan(spark, sf):
    """SC1/SC6/SC7/PJ1: a folder whose files have three header layouts, extra
    columns and a city that is not known: columns are found by name, file by file."""
    raw = X.raw_base2_daily(spark, sf)
    name = F.concat(F.when(F.col("city_id") == 7, F.lit("boston")).otherwise(X.city_name(F.col("city_id"))),
                    F.lit("_station")).alias("file")
    root = scratch_path(spark, "raw")
    for i, layout in enumerate(_LAYOUTS):
        part = raw.where(F.col("city_id") % 3 == i)
        write_named_csv(part.select(*layout, name), f"{root}/base_2", mode="append")
    cols = ["PRCP", "TMAX", "TMIN", "SNWD", "AWND", "WSFG"]
    return scan_raw(spark, root, numeric={"base_2": cols})["base_2"].select("file", "city", "city_id", "DATE", *cols)


@register("gold_allow_list_scan", lambda: f"""
SELECT g.*, 'base_2' AS source, {X.CITY_NAME_SQL}[g.city_id + 1] AS city FROM ({O.gold_base2()}) g
WHERE {X.CITY_NAME_SQL}[g.city_id + 1] IN ('albuquerque', 'dallas', 'oklahoma city')""")
def q_gold_allow_list_scan(spark, sf):
    """SC3/SC4 partitioned snappy Parquet sink -> SC2 scan -> SC11 allow-list
    (partition-pruned to the cities chosen for base_2)."""
    g = gold2(spark, sf).withColumns({"source": F.lit("base_2"),
                                      "city": X.city_name(F.col("city_id"))})
    path = scratch_path(spark, "gold")
    write_parquet(g, path, ["source", "city"])
    return read_gold(spark, path)


def _finish(q) -> None:
    """Wait for an available-now stream; it ends once the files are processed."""
    if not q.awaitTermination(1800):
        q.stop()
        raise TimeoutError("the stream did not finish")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


# files of one stream with three header layouts: more columns, filled or empty, and other orders
_STREAM_LAYOUTS = [["EVENT_ID", "CZ_NAME_STR", "BEGIN_DATE", "EVENT_TYPE", "EVENT_NARRATIVE"],
                   ["EVENT_TYPE", "EVENT_ID", "BEGIN_DATE", "CZ_NAME_STR", "EVENT_NARRATIVE", "MAGNITUDE"],
                   ["BEGIN_DATE", "DEATHS", "EVENT_ID", "EVENT_TYPE", "CZ_NAME_STR", "EVENT_NARRATIVE"]]


@register("disaster_stream_silver", O.silver_disaster)
def q_disaster_stream_silver(spark, sf):
    """Structured Streaming: storm-report CSV files of three header layouts picked up by a file stream
    (available-now trigger, three files a batch), PL4 applied per micro-batch in
    ``foreachBatch``, batches merged on read."""
    from stormlake.streaming.ingest import read_silver_disaster, silver_disaster_stream

    root = scratch_path(spark, "stream-raw")
    reports = _reports(spark, sf).withColumns({"MAGNITUDE": F.lit("1.5"), "DEATHS": F.lit(None).cast("string")})
    for i, layout in enumerate(_STREAM_LAYOUTS):
        part = reports.where(F.pmod(F.crc32(F.col("file").cast("binary")), F.lit(3)) == i)
        write_named_csv(part.select(*layout, "file").repartition("file"), root, mode="append")
    out = scratch_path(spark, "stream-silver")
    _finish(silver_disaster_stream(spark, root, out, scratch_path(spark, "stream-ckpt"), max_files=3))
    return read_silver_disaster(spark, out).drop("file", "city")


@register("hourly_day_means_stream", lambda: f"""
SELECT city_id, date, {', '.join(f'avg({c}) AS {c}' for c in O.SILVER3H_MEAS)}
FROM ({O.silver_base3_hourly()}) h GROUP BY city_id, date""")
def q_hourly_day_means_stream(spark, sf):
    """AG1 over a stream: the silver hourly table arrives as a Parquet file stream
    (two files a batch); each batch's sums and counts are added up on read."""
    from stormlake.catalog.layers import silver_base3_hourly_df
    from stormlake.streaming.ingest import day_partials_to_parquet, read_day_means

    cols = O.SILVER3H_MEAS
    src = scratch_path(spark, "hourly-src")
    (silver_base3_hourly_df(spark, sf)
        .select("city_id", F.to_timestamp("date_raw").alias("obs_ts"), *cols)
        .write.parquet(src))
    schema = "city_id int, obs_ts timestamp, " + ", ".join(f"{c} double" for c in cols)
    out = scratch_path(spark, "hourly-means")
    _finish(day_partials_to_parquet(spark, src, schema, cols, out, scratch_path(spark, "hourly-ckpt"), max_files=2))
    return read_day_means(spark, out, cols)
