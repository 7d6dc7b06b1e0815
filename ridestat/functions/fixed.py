"""Fixed values that must equal the source system's for results to match.

Kept together, in natural order, as plain text.
"""

# ---- fixed values: canonical raw trip columns, in file order -------------------------------
CANONICAL_COLUMNS = [
    "Genero_Usuario",
    "Edad_Usuario",
    "Bici",
    "Ciclo_Estacion_Retiro",
    "Fecha_Retiro",
    "Hora_Retiro",
    "Ciclo_EstacionArribo",
    "Fecha_Arribo",
    "Hora_Arribo",
]

# ---- fixed values: accepted header spellings per canonical column (first present wins) ----
COLUMN_ALIASES = {
    "Genero_Usuario": ["Genero_Usuario", "Genero_usuario"],
    "Edad_Usuario": ["Edad_Usuario", "Edad_usuario"],
    "Bici": ["Bici"],
    "Ciclo_Estacion_Retiro": ["Ciclo_Estacion_Retiro", "CE_retiro"],
    "Fecha_Retiro": ["Fecha_Retiro", "Fecha_retiro"],
    "Hora_Retiro": ["Hora_Retiro", "Hora_retiro"],
    "Ciclo_EstacionArribo": ["Ciclo_EstacionArribo", "Ciclo_Estacion_Arribo", "CE_arribo"],
    "Fecha_Arribo": ["Fecha_Arribo", "Fecha Arribo", "Fecha_arribo"],
    "Hora_Arribo": ["Hora_Arribo", "Hora_arribo"],
}

# ---- fixed values: header normalisation (lower-case, these accents folded, these dropped) ---
HEADER_ACCENTS_FROM = "áéíóú"
HEADER_ACCENTS_TO = "aeiou"
HEADER_DROPPED = "_ "

# ---- fixed values: gender codes kept as they are; anything else becomes "?" ---------------
GENDER_CODES = ["M", "F", "O", "?"]
GENDER_UNKNOWN = "?"

# ---- fixed values: final trips_clean column order -----------------------------------------
TRIPS_CLEAN_COLUMNS = [
    "trip_id",
    "source_file",
    "gender",
    "age",
    "bike_id",
    "start_station_number",
    "end_station_number",
    "start_datetime",
    "end_datetime",
    "duration_minutes",
    "start_date",
    "end_date",
    "year",
    "month",
    "day",
    "hour",
    "weekday",
    "is_weekend",
    "start_station_found",
    "end_station_found",
]

# ---- fixed values: station catalog columns, in table order --------------------------------
STATION_COLUMNS = [
    "station_id",
    "external_id",
    "station_number",
    "station_name",
    "latitude",
    "longitude",
    "capacity",
    "rental_methods",
    "has_kiosk",
]

# ---- fixed values: weekday names, Monday = 0 ----------------------------------------------
WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
WEEKEND_DAYS = [5, 6]

# ---- fixed values: age groups (label, inclusive low, inclusive high) ------------------------
AGE_UNKNOWN = "Unknown"
AGE_UNDER = ("Under 18", 18)  # age < 18
AGE_BANDS = [
    ("18-24", 18, 24),
    ("25-34", 25, 34),
    ("35-44", 35, 44),
    ("45-54", 45, 54),
    ("55-64", 55, 64),
]
AGE_TOP = "65+"

# ---- fixed values: clean-trip filter (minutes) ---------------------------------------------
CLEAN_MIN_EXCLUSIVE = 0
CLEAN_MAX_INCLUSIVE = 180
LONG_TRIP_MINUTES = 180
VERY_LONG_TRIP_MINUTES = 1440

# ---- fixed values: report sizes ------------------------------------------------------------
TOP_ROUTES = 500
TRIAGE_SAMPLE_ROWS = 500
TRIAGE_VALUE_COUNTS = 20
TOP_MISSING_STATIONS = 20
TOP_INVALID_FILES = 10

# ---- fixed values: text that pandas' CSV reader turns into a missing value by default -------
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
# How a missing raw value prints when it is turned into text ("astype(str)").
MISSING_AS_TEXT = "nan"

# ---- fixed values: datetime field patterns (strptime directives %d %m %Y %y %H %M %S) -------
DAY_RE = r"3[01]|[12]\d|0[1-9]|[1-9]| [1-9]"
MONTH_RE = r"1[0-2]|0[1-9]|[1-9]"
YEAR4_RE = r"\d\d\d\d"
YEAR2_RE = r"\d\d"
HOUR_RE = r"2[0-3]|[0-1]\d|\d"
MINUTE_RE = r"[0-5]\d|\d"
SECOND_RE = r"6[0-1]|[0-5]\d|\d"
TWO_DIGIT_YEAR_PIVOT = 69  # 69..99 -> 1900s, 00..68 -> 2000s
# nanosecond timestamps only cover this range; whole-second bounds
TIMESTAMP_MIN = "1677-09-21 00:12:44"
TIMESTAMP_MAX = "2262-04-11 23:47:16"

# ---- fixed values: delimiters tried by the header audit, in preference order ----------------
DELIMITER_CANDIDATES = [",", "\t", ";", "|"]
DEFAULT_DELIMITER = ","
