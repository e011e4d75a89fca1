"""Feature lists, column roles and other values that must stay fixed.

FIXED VALUES — these must equal the behaviour being reproduced (feature
names and order, token lists, thresholds, points scale).  They are listed
plainly and in their natural order.
"""

# --- FIXED VALUES: feature sets (order matters: it is the model contract) ---
MINIMAL_FEATURES = (
    "GridPosition", "AvgQualiTime", "weather_tire_cluster",
    "SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET",
    "races_prior_this_season", "Rain", "PointsProp",
)
MINIMAL10_FEATURES = MINIMAL_FEATURES[:-1]          # same list without PointsProp
WEATHER13_FEATURES = (
    "GridPosition", "AirTemp_C", "TrackTemp_C", "Humidity_%", "Pressure_hPa",
    "WindSpeed_mps", "WindDirection_deg", "SOFT", "MEDIUM", "HARD",
    "INTERMEDIATE", "WET", "races_prior_this_season",
)
APP_RAW_COLUMNS = (
    "GridPosition", "AvgQualiTime", "weather_tire_cluster", "AirTemp_C",
    "TrackTemp_C", "Humidity_%", "Pressure_hPa", "WindSpeed_mps",
    "WindDirection_deg", "races_prior_this_season", "Rain", "Driver", "Team",
    "PointsProp", "SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET",
)
EXPECTED_INPUT_COLUMNS = MINIMAL_FEATURES + ("Status",)

WEATHER_COLUMNS = ("AirTemp_C", "TrackTemp_C", "Humidity_%", "Pressure_hPa",
                   "WindSpeed_mps")
TYRES = ("SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET")
SELECTABLE_TYRES = ("SOFT", "MEDIUM", "HARD")

# Column roles of the wide race-entry table.
NUMERIC_ROLE = (
    "DriverNumber", "Position", "GridPosition", "Q1", "Q2", "Q3", "Points",
    "Laps", "Season", "Round", "AvgQualiTime", "AirTemp_C", "TrackTemp_C",
    "Humidity_%", "Pressure_hPa", "WindSpeed_mps", "WindDirection_deg",
    "ParsedTime_s", "FinishTime_s", "DeltaFromAhead_s", "DeviationFromAvg_s",
    "SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET",
    "DeviationFromAvg_s_last1", "DeviationFromAvg_s_last2",
    "DeviationFromAvg_s_last5", "DeviationFromAvg_s_season_to_date",
    "races_prior_this_season", "Rain", "PointsProp",
)
CATEGORICAL_ROLE = ("TeamName", "TeamId", "ClassifiedPosition", "Time",
                    "Status", "Driver")
DROP_ROLE = ("Unnamed: 0", "FullName", "HeadshotUrl", "CountryCode",
             "TeamColor", "DriverId")
TARGET = "DeviationFromAvg_s"
KEY = ("Season", "Round", "DriverNumber")
RACE = ("Season", "Round")

# --- FIXED VALUES: Rain token normalisation (lower-cased, stripped text) ---
RAIN_TOKENS = {
    "rain": 1, "yes": 1, "raining": 1,
    "norain": 0, "no": 0, "no rain": 0, "no_rain": 0,
    "0": 0, "1": 1, "false": 0, "true": 1,
}
# Variant without true/false and without the substring rule.
RAIN_TOKENS_STRICT = {k: v for k, v in RAIN_TOKENS.items()
                      if k not in ("true", "false")}

# --- FIXED VALUES: leakage mask names ---
LEAKAGE_EXACT = ("ParsedTime_s", "ParsedTime", "Position", "DriverNumber",
                 "num__Position", "Laps", "Unnamed: 0", "Round")
LEAKAGE_TARGET_NAMES = ("num__DeviationFromAvg_s", "DeviationFromAvg_s")
LEAKAGE_IDENTITY_PREFIXES = ("cat__Driver_", "cat__TeamName", "cat__TeamId",
                             "Driver__", "TeamName__", "TeamId__", "Team__")

# --- FIXED VALUES: names left out of summaries ---
SUMMARY_EXACT = ("num__DeviationFromAvg_s", "DeviationFromAvg_s", "ParsedTime_s", "ParsedTime",
                 "Position", "DriverNumber", "Laps", "Unnamed: 0", "Round")
SUMMARY_PREFIXES = ("cat__Driver_", "Driver__", "cat__TeamName", "TeamName__", "cat__TeamId",
                    "TeamId__", "cat__Team", "Team__", "ClassifiedPosition")

# --- FIXED VALUES: race settings defaults of the interactive app ---
DEFAULT_SETTINGS = {
    "AirTemp_C": 28.0, "TrackTemp_C": 33.0, "Humidity_%": 55.0,
    "Pressure_hPa": 1012.0, "WindSpeed_mps": 2.5, "WindDirection_deg": 180.0,
    "races_prior_this_season": 12, "tire": "SOFT", "Rain": False,
}
DEFAULT_POINTS_PROP = 0.5
DEFAULT_AVG_QUALI_TIME = 90.0
MAX_POINTS_PER_RACE = 25.0

# --- FIXED VALUES: weather description thresholds ---
AIR_TEMP_LABELS = ((30, "hot"), (20, "warm"), (10, "mild"))   # else "cool"
HUMIDITY_LABELS = ((80, "very humid"), (60, "humid"),
                   (30, "moderate humidity"))                  # else "dry"

# --- FIXED VALUES: championship points for positions 1..10 (public F1 scale) ---
POINTS_SCALE = (25, 18, 15, 12, 10, 8, 6, 4, 2, 1)

TERTILE_LABELS = ("low", "med", "high")
RESIDUAL_BIN_LABELS = ("overperform", "close", "underperform")
