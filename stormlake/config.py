"""Fixed values that must equal the source project's for results to match.

Everything in this module is data, stated plainly and in its natural order.
"""

from __future__ import annotations

# --- fixed values: raw -> canonical column names, per source ---------------
COLUMN_MAP: dict[str, dict[str, str]] = {
    "base_1": {
        "date": "date",
        "temperature_2m_max": "maximum_temperature",
        "temperature_2m_min": "minimum_temperature",
        "temperature_2m_mean": "average_temperature",
        "rain_sum": "precipitation",
        "showers_sum": "precipitation_esparsa",
        "snowfall_sum": "snowfall",
        "snow_depth": "snow_depth",
        "wind_speed_10m_max": "wind_speed",
        "wind_gusts_10m_max": "wind_speed_gust",
        "wind_direction_10m_dominant": "wind_direction",
        "relative_humidity_2m": "relative_humidity",
        "pressure_msl": "sea_level_air_pressure",
        "surface_pressure": "surface_air_pressure",
    },
    "base_2": {
        "DATE": "date",
        "NAME": "name_station",
        "TMAX": "maximum_temperature",
        "TMIN": "minimum_temperature",
        "TAVG": "average_temperature",
        "SNWD": "snow_depth",
        "PRCP": "precipitation",
        "AWND": "wind_speed",
        "WDFG": "wind_direction",
        "WSFG": "wind_gust",
        "PGTM": "peak_gust_time",
        "SNOW": "snow",
    },
    "base_3": {
        "time": "date",
        "tavg": "average_temperature",
        "tmin": "minimum_temperature",
        "tmax": "maximum_temperature",
        "temp": "temperature",
        "dwpt": "dewpoint",
        "rhum": "relative_humidity",
        "prcp": "precipitation",
        "snow": "snow_depth",
        "wdir": "wind_direction",
        "wspd": "wind_speed",
        "wpgt": "wind_gust",
        "pres": "sea_level_air_pressure",
        "tsun": "total_sunshine_duration",
        "coco": "code_weather",
    },
    "base_disaster": {
        "CZ_NAME_STR": "location",
        "BEGIN_DATE": "date",
        "EVENT_TYPE": "eventType",
    },
}

# --- fixed values: the monitored cities, coordinates and stations ----------
CITIES: list[str] = [
    "dallas", "houston", "miami", "nashville",
    "new york", "oklahoma city", "albuquerque", "chicago",
]
CITY_COORDINATES: dict[str, tuple[float, float]] = {
    "dallas": (32.7831, -96.8067),
    "houston": (29.7633, -95.3633),
    "miami": (25.7743, -80.1937),
    "nashville": (36.1659, -86.7844),
    "new york": (40.7143, -74.006),
    "oklahoma city": (35.4676, -97.5164),
    "albuquerque": (35.0844, -106.6511),
    "chicago": (41.85, -87.65),
}
CITY_STATIONS: dict[str, int] = {
    "dallas": 72258,
    "houston": 72244,
    "miami": 72202,
    "nashville": 72327,
    "new york": 74486,
    "oklahoma city": 72353,
    "albuquerque": 72365,
    "chicago": 72534,
}

# --- fixed values: cities used for model training, per source --------------
TRAINING_CITIES: dict[str, list[str]] = {
    "base_1": ["albuquerque", "miami", "chicago"],
    "base_2": ["albuquerque", "dallas", "oklahoma city"],
    "base_3": ["albuquerque", "nashville", "chicago"],
}

# --- fixed values: base_2 raw columns kept at silver -----------------------
BASE2_SELECT: list[str] = [
    "DATE", "AWND", "PRCP", "SNOW", "SNWD", "TAVG", "TMAX", "TMIN", "WDFG", "WSFG",
]
BASE2_DROP: list[str] = ["wind_gust", "wind_direction", "wind_speed"]
DISASTER_SELECT: list[str] = ["CZ_NAME_STR", "BEGIN_DATE", "EVENT_TYPE"]

# --- fixed values: date formats, tried in this order on a whole file -------
# (Python strptime spellings: %m/%d/%Y, %Y-%m-%d, %d/%m/%Y)
DATE_FORMATS: list[str] = ["M/d/yyyy", "yyyy-M-d", "d/M/yyyy"]
NULL_TOKENS: list[str] = ["", "nan", "NaN", "NaT", "None", "NA", "N/A", "null", "NULL"]

# --- fixed values: seasons (northern hemisphere, by month) -----------------
SEASON_WINTER, SEASON_SPRING, SEASON_SUMMER, SEASON_AUTUMN = (
    "Inverno", "Primavera", "Verão", "Outono",
)
WINTER_MONTHS = [12, 1, 2]
SPRING_MONTHS = [3, 4, 5]
SUMMER_MONTHS = [6, 7, 8]

# --- fixed values: interpolation gates (null %, rounded to 2 digits) -------
SILVER_FILL_LIMIT = 20.0
GOLD_FILL_LIMIT = 40.0

# --- fixed values: moving average window, split and model defaults --------
MOVING_AVERAGE_WINDOW = 3
TEST_SIZE = 0.3
SEED = 42
SMOTE_K = 5
ADASYN_K = 5
ENN_K = 3
N_TRIALS = 50
BALANCING_METHODS: list[str | None] = [
    None, "SMOTE", "ADASYN", "RandomUnderSampler", "SMOTEENN",
]

# --- fixed values: the 49 official storm event types -----------------------
EVENT_TYPES: list[str] = [
    "Astronomical Low Tide", "Avalanche", "Blizzard", "Coastal Flood", "Cold/Wind Chill",
    "Debris Flow", "Dense Fog", "Dense Smoke", "Drought", "Dust Devil", "Dust Storm",
    "Excessive Heat", "Extreme Cold/Wind Chill", "Flash Flood", "Flood", "Freezing Fog",
    "Frost/Freeze", "Funnel Cloud", "Hail", "Heat", "Heavy Rain", "Heavy Snow", "High Surf",
    "High Wind", "Hurricane (Typhoon)", "Ice Storm", "Lake-Effect Snow", "Lakeshore Flood",
    "Lightning", "Marine Hail", "Marine High Wind", "Marine Strong Wind", "Marine Thunderstorm Wind",
    "Rip Current", "Seiche", "Sleet", "Sneakerwave", "Storm Surge/Tide", "Strong Wind",
    "Thunderstorm Wind", "Tornado", "Tropical Depression", "Tropical Storm", "Tsunami",
    "Volcanic Ash", "Waterspout", "Wildfire", "Winter Storm", "Winter Weather",
]
