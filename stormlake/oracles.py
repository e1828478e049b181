"""DuckDB SQL for the same plans, used as correctness oracles.

Each builder takes the SQL of its input and returns the SQL of its output,
mirroring a Spark operator; the SQL runs the plain whole-series windows that
the Spark side replaces with its block decomposition.
"""

from __future__ import annotations

from stormlake import config as C
from stormlake.sources import fixtures as X

_PY_FORMATS = ["%m/%d/%Y", "%Y-%m-%d", "%d/%m/%Y"]  # same order as config.DATE_FORMATS
_NULLS = ", ".join("'" + t + "'" for t in C.NULL_TOKENS)


def parse_dates(src: str, col: str, keys: list[str], cols: list[str]) -> str:
    """FN1 per file; ``cols`` are the input columns (``col`` among them)."""
    k = ", ".join(keys)
    head = f"split_part(CAST({col} AS VARCHAR), ' ', 1)"
    parsed = ", ".join(f"CAST(try_strptime(__txt, '{f}') AS DATE) AS __p{i}"
                       for i, f in enumerate(_PY_FORMATS))
    fails = [f"sum(CASE WHEN __txt IS NOT NULL AND __p{i} IS NULL THEN 1 ELSE 0 END)"
             for i in range(len(_PY_FORMATS))]
    choice = "CASE " + " ".join(f"WHEN {f} = 0 THEN {i}" for i, f in enumerate(fails)) + " END"
    pick = "CASE v.date_format " + " ".join(
        f"WHEN {i} THEN p.__p{i}" for i in range(len(_PY_FORMATS))) + " END"
    others = ", ".join(f"p.{c}" for c in cols if c != col)
    return f"""
SELECT {others}, CAST(p.{col} AS VARCHAR) AS {col}_raw, {pick} AS {col}, v.date_format
FROM (SELECT *, {parsed} FROM (
        SELECT *, CASE WHEN {head} IN ({_NULLS}) THEN NULL ELSE {head} END AS __txt
        FROM ({src}) s0) s1) p
LEFT JOIN (SELECT {k}, {choice} AS date_format FROM (
        SELECT *, {parsed} FROM (
          SELECT *, CASE WHEN {head} IN ({_NULLS}) THEN NULL ELSE {head} END AS __txt
          FROM ({src}) s2) s3) q GROUP BY {k}) v USING ({k})
"""


def interpolate(src: str, cols: list[str], keys: list[str], order: list[str],
                all_cols: list[str], limit: float | None) -> str:
    """WN3 (+ WN4 gate when ``limit``) with whole-series windows."""
    k = ", ".join(keys)
    o = ", ".join(order)
    w = f"PARTITION BY {k} ORDER BY {o}"
    lvl1 = [f"row_number() OVER ({w}) AS __rn"]
    lvl2 = []
    for i, c in enumerate(cols):
        lvl2 += [
            f"last_value(CAST({c} AS DOUBLE) IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS __pv{i}",
            f"last_value(CASE WHEN {c} IS NOT NULL THEN __rn END IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS __pp{i}",
            f"first_value(CAST({c} AS DOUBLE) IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS __nv{i}",
            f"first_value(CASE WHEN {c} IS NOT NULL THEN __rn END IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS __np{i}",
            f"round_even((sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY {k}) / count(*) OVER (PARTITION BY {k})) * 100.0::DOUBLE, 2) AS __pct{i}",
        ]
    outs = []
    for c in all_cols:
        if c in cols:
            i = cols.index(c)
            fill = (f"CASE WHEN {c} IS NOT NULL THEN CAST({c} AS DOUBLE) WHEN __pv{i} IS NULL THEN NULL "
                    f"WHEN __nv{i} IS NULL THEN __pv{i} "
                    f"ELSE ((__nv{i} - __pv{i}) / (__np{i} - __pp{i})) * (__rn - __pp{i}) + __pv{i} END")
            if limit is not None:
                fill = (f"CASE WHEN __pct{i} > 0 AND __pct{i} <= {float(limit)}::DOUBLE THEN {fill} "
                        f"ELSE CAST({c} AS DOUBLE) END")
            outs.append(f"{fill} AS {c}")
        else:
            outs.append(c)
    return f"""
SELECT {', '.join(outs)} FROM (
  SELECT *, {', '.join(lvl2)} FROM (
    SELECT *, {', '.join(lvl1)} FROM ({src}) i0) i1) i2
"""


def rename(src: str, source: str, cols: list[str]) -> str:
    m = C.COLUMN_MAP[source]
    return "SELECT " + ", ".join(f"{c} AS {m[c]}" if c in m and m[c] != c else c for c in cols) + \
        f" FROM ({src}) r"


def season(col: str = "date") -> str:
    m = f"month({col})"
    w = ", ".join(map(str, C.WINTER_MONTHS))
    sp = ", ".join(map(str, C.SPRING_MONTHS))
    su = ", ".join(map(str, C.SUMMER_MONTHS))
    return (f"CASE WHEN {m} IN ({w}) THEN '{C.SEASON_WINTER}' WHEN {m} IN ({sp}) THEN '{C.SEASON_SPRING}' "
            f"WHEN {m} IN ({su}) THEN '{C.SEASON_SUMMER}' ELSE '{C.SEASON_AUTUMN}' END")


# --------------------------------------------------------------------------
# silver
# --------------------------------------------------------------------------
RAW1_COLS = ["city_id", "date", "temperature_2m_max", "temperature_2m_min", "temperature_2m_mean",
             "rain_sum", "snowfall_sum", "wind_speed_10m_max", "wind_gusts_10m_max",
             "wind_direction_10m_dominant"]
SILVER1_COLS = ["city_id", "date", "maximum_temperature", "minimum_temperature",
                "average_temperature", "precipitation", "snowfall", "wind_speed",
                "wind_speed_gust", "wind_direction"]


def silver_base1() -> str:
    r = rename(X.RAW_BASE1_DAILY_SQL, "base_1", RAW1_COLS)
    return parse_dates(r, "date", ["city_id"], SILVER1_COLS)


RAW1H_COLS = ["city_id", "ord_a", "ord_b", "ord_c", "date", "relative_humidity_2m",
              "pressure_msl", "surface_pressure"]
SILVER1H_COLS = ["city_id", "ord_a", "ord_b", "ord_c", "date", "relative_humidity",
                 "sea_level_air_pressure", "surface_air_pressure"]


def silver_base1_hourly() -> str:
    r = rename(X.RAW_BASE1_HOURLY_SQL, "base_1", RAW1H_COLS)
    return parse_dates(r, "date", ["city_id"], SILVER1H_COLS)


def silver_base2() -> str:
    cols = ["city_id", "DATE", "AWND", "PRCP", "SNWD", "TAVG", "TMAX", "TMIN", "WDFG", "WSFG"]
    r = rename(X.RAW_BASE2_DAILY_SQL, "base_2", cols)
    renamed = ["city_id", "date", "wind_speed", "precipitation", "snow_depth", "average_temperature",
               "maximum_temperature", "minimum_temperature", "wind_direction", "wind_gust"]
    p = parse_dates(r, "date", ["city_id"], renamed)
    mr = f"""SELECT city_id, date, date_raw, date_format, precipitation, snow_depth,
  coalesce(average_temperature, (maximum_temperature + minimum_temperature) / 2.0::DOUBLE) AS average_temperature,
  maximum_temperature, minimum_temperature FROM ({p}) m"""
    meas = ["precipitation", "snow_depth", "average_temperature", "maximum_temperature",
            "minimum_temperature"]
    return interpolate(mr, meas, ["city_id"], ["date", "date_raw"],
                       ["city_id", "date", "date_raw", "date_format"] + meas, C.SILVER_FILL_LIMIT)


RAW3_COLS = ["city_id", "time", "tavg", "tmin", "tmax", "prcp", "snow", "wdir", "wspd", "wpgt", "tsun"]
SILVER3_MEAS = ["average_temperature", "minimum_temperature", "maximum_temperature", "precipitation",
                "snow_depth", "wind_direction", "wind_speed", "wind_gust", "total_sunshine_duration"]


def silver_base3_daily(limit: float = C.SILVER_FILL_LIMIT) -> str:
    r = rename(X.RAW_BASE3_DAILY_SQL, "base_3", RAW3_COLS)
    p = parse_dates(r, "date", ["city_id"], ["city_id", "date"] + SILVER3_MEAS)
    return interpolate(p, SILVER3_MEAS, ["city_id"], ["date", "date_raw"],
                       ["city_id", "date", "date_raw", "date_format"] + SILVER3_MEAS, limit)


RAW3H_COLS = ["city_id", "ord_a", "ord_b", "ord_c", "time", "dwpt", "rhum", "prcp", "wdir", "wspd"]
SILVER3H_MEAS = ["dewpoint", "relative_humidity", "precipitation", "wind_direction", "wind_speed"]


def silver_base3_hourly(limit: float = C.SILVER_FILL_LIMIT) -> str:
    r = rename(X.RAW_BASE3_HOURLY_SQL, "base_3", RAW3H_COLS)
    base = ["city_id", "ord_a", "ord_b", "ord_c", "date"]
    p = parse_dates(r, "date", ["city_id"], base + SILVER3H_MEAS)
    return interpolate(p, SILVER3H_MEAS, ["city_id"],
                       ["date", "date_raw", "ord_a", "ord_b", "ord_c"],
                       base + ["date_raw", "date_format"] + SILVER3H_MEAS, limit)


def silver_disaster() -> str:
    sel = f"""SELECT city_id, ordinal, CZ_NAME_STR, BEGIN_DATE, EVENT_TYPE FROM ({X.STORM_EVENTS_RAW_SQL}) e
WHERE CZ_NAME_STR IS NOT NULL AND BEGIN_DATE IS NOT NULL AND EVENT_TYPE IS NOT NULL"""
    r = rename(sel, "base_disaster", ["city_id", "ordinal", "CZ_NAME_STR", "BEGIN_DATE", "EVENT_TYPE"])
    p = parse_dates(r, "date", ["city_id"], ["city_id", "ordinal", "location", "date", "eventType"])
    return f"""SELECT city_id, ordinal, location, date_raw, date, date_format, eventType FROM (
  SELECT *, row_number() OVER (PARTITION BY city_id, date, eventType ORDER BY ordinal) AS __k
  FROM ({p}) d) x WHERE __k = 1"""


# --------------------------------------------------------------------------
# gold
# --------------------------------------------------------------------------
def _label_join(base: str, base_cols: list[str], season_after: bool) -> str:
    cols = [c for c in base_cols if c not in ("city_id", "date")]
    sel = ", ".join(f"b.{c}" for c in cols)
    q = f"""SELECT coalesce(b.city_id, d.city_id) AS city_id, coalesce(b.date, d.date) AS date, {sel},
  d.eventType, CAST(d.eventType IS NOT NULL AS INTEGER) AS disaster_occurred
FROM ({base}) b FULL OUTER JOIN (SELECT city_id, date, eventType FROM ({silver_disaster()}) s) d
  ON b.city_id = d.city_id AND b.date IS NOT DISTINCT FROM d.date"""
    if season_after:
        q = f"SELECT *, {season('date')} AS season FROM ({q}) g"
    return q


def gold_base1() -> str:
    hourly = f"""SELECT city_id, date, avg(relative_humidity) AS relative_humidity,
  avg(sea_level_air_pressure) AS sea_level_air_pressure, avg(surface_air_pressure) AS surface_air_pressure
FROM ({silver_base1_hourly()}) h GROUP BY city_id, date"""
    daily_cols = [c for c in SILVER1_COLS]
    base = f"""SELECT d.*, h.relative_humidity, h.sea_level_air_pressure, h.surface_air_pressure FROM (
  SELECT {', '.join(daily_cols)}, {season('date')} AS season FROM ({silver_base1()}) x) d
LEFT JOIN ({hourly}) h ON d.city_id = h.city_id AND d.date = h.date"""
    cols = daily_cols + ["season", "relative_humidity", "sea_level_air_pressure", "surface_air_pressure"]
    return _label_join(base, cols, season_after=False)


GOLD2_COLS = ["city_id", "date", "precipitation", "snow_depth", "average_temperature",
              "maximum_temperature", "minimum_temperature"]


def gold_base2() -> str:
    base = f"SELECT {', '.join(GOLD2_COLS)}, {season('date')} AS season FROM ({silver_base2()}) x"
    return _label_join(base, GOLD2_COLS + ["season"], season_after=False)


def gold_base3() -> str:
    fills = ["precipitation", "wind_direction", "wind_speed"]
    hourly = f"""SELECT city_id, date, avg(dewpoint) AS dewpoint, avg(relative_humidity) AS relative_humidity,
  avg(precipitation) AS h_precipitation, avg(wind_direction) AS h_wind_direction,
  avg(wind_speed) AS h_wind_speed FROM ({silver_base3_hourly()}) h GROUP BY city_id, date"""
    keep = [c for c in SILVER3_MEAS if c not in ("total_sunshine_duration", "wind_gust")]
    sel = ", ".join(f"coalesce(d.{c}, h.h_{c}) AS {c}" if c in fills else f"d.{c}" for c in keep)
    base = f"""SELECT d.city_id, d.date, {sel}, h.dewpoint, h.relative_humidity
FROM ({silver_base3_daily()}) d LEFT JOIN ({hourly}) h ON d.city_id = h.city_id AND d.date = h.date"""
    meas = keep + ["dewpoint", "relative_humidity"]
    filled = interpolate(base, meas, ["city_id"], ["date"], ["city_id", "date"] + meas, C.GOLD_FILL_LIMIT)
    return _label_join(filled, ["city_id", "date"] + meas, season_after=True)


# --------------------------------------------------------------------------
# trends
# --------------------------------------------------------------------------
def disasters_over_years(span: int = C.MOVING_AVERAGE_WINDOW) -> str:
    a = 2.0 / (span + 1)
    return f"""
WITH RECURSIVE y AS (SELECT city_id, CAST(year(date) AS INTEGER) AS year FROM ({silver_disaster()}) s
                     WHERE date IS NOT NULL),
c AS (SELECT city_id, year, count(*) AS cnt FROM y GROUP BY city_id, year),
sp AS (SELECT city_id, CAST(unnest(range(min(year), max(year) + 1)) AS INTEGER) AS year
       FROM y GROUP BY city_id),
t AS (SELECT sp.city_id, sp.year, CAST(coalesce(c.cnt, 0) AS INTEGER) AS count,
             row_number() OVER (PARTITION BY sp.city_id ORDER BY sp.year) AS rn
      FROM sp LEFT JOIN c ON sp.city_id = c.city_id AND sp.year = c.year),
e AS (SELECT city_id, rn, CAST(count AS DOUBLE) AS ema FROM t WHERE rn = 1
      UNION ALL
      SELECT t.city_id, t.rn, e.ema * {1.0 - a}::DOUBLE + CAST(t.count AS DOUBLE) * {a}::DOUBLE
      FROM e JOIN t ON t.city_id = e.city_id AND t.rn = e.rn + 1)
SELECT t.city_id, t.year, t.count,
  CASE WHEN count(t.count) OVER w = {span}
       THEN avg(CAST(t.count AS DOUBLE)) OVER w END AS count_moving_average_sma,
  e.ema AS count_moving_average_ema
FROM t JOIN e ON t.city_id = e.city_id AND t.rn = e.rn
WINDOW w AS (PARTITION BY t.city_id ORDER BY t.year ROWS BETWEEN {span - 1} PRECEDING AND CURRENT ROW)
"""
