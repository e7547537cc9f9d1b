"""Column names of the raw files."""

# Column names of the on-time performance files.
TRIP_COLUMNS = [
    "FL_DATE",
    "OP_CARRIER_AIRLINE_ID",
    "OP_CARRIER_FL_NUM",
    "ORIGIN_AIRPORT_ID",
    "DEST_AIRPORT_ID",
    "CRS_DEP_TIME",
    "CRS_ELAPSED_TIME",
    "ARR_DELAY_NEW",
    "CANCELLED",
    "DIVERTED",
    "WEATHER_DELAY",
    "NAS_DELAY",
]

# Column names of the hourly station files.
OBSERVATION_TEXTS = ["WBAN", "Date", "Time", "SkyCondition", "WeatherType"]
OBSERVATION_MEASURES = [
    "Visibility",
    "DryBulbFarenheit",
    "DryBulbCelsius",
    "DewPointFarenheit",
    "DewPointCelsius",
    "WetBulbFarenheit",
    "WetBulbCelsius",
    "RelativeHumidity",
    "WindSpeed",
    "WindDirection",
    "Altimeter",
    "SeaLevelPressure",
    "StationPressure",
    "HourlyPrecip",
]
OBSERVATION_COLUMNS = OBSERVATION_TEXTS + OBSERVATION_MEASURES
