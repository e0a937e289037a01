"""Results depend on them, so they are stated here and nowhere else."""

# Grid cell ids: "<tag><resolution>_<lon thousandths>_<lat thousandths>", e.g. h3_res8_-73966_40769.
CELL_TAG = "h3_res"
CELL_RESOLUTION = 8
CELL_AREA_KM2 = 0.737

EARTH_RADIUS_MILES = 3959.0
CITY_SPEED_MPH = 10.0

# Inclusive hour bands. The night band starts above its end, so a plain BETWEEN never matches it.
MORNING_RUSH = (7, 9)
EVENING_RUSH = (17, 19)
NIGHT = (22, 4)

FOG_WORDS = ("mist", "smoke", "haze", "dust", "fog", "sand", "ash", "squall", "tornado")
STATION_IDS = ("725030", "744860", "725053")

# Recency tiers: at most N days -> score; anything older scores 1.
RECENCY_TIERS = ((1, 5), (3, 4), (7, 3), (14, 2))
SEGMENTS = ("Gold", "Silver", "Bronze", "Watch", "Dead")

# Share of the maximum, strictly below the bound -> level; anything else is "Very High".
DEMAND_LEVELS = ((0.3, "Low"), (0.5, "Medium"), (0.7, "High"))
MARKER_SIZE = (250.0, 600.0)

# Demand strictly above the bound -> price multiplier; anything else 1.0.
SURGE_TIERS = ((50, 2.5), (30, 1.8), (15, 1.2))

CLUSTER_NAMES = ("High Demand", "Medium Demand", "Low Demand", "Night Shift")
DAY_NAMES = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")
VENDOR_NAMES = {"1": "Vendor 1", "2": "Vendor 2"}

# Stands for NULL inside a surrogate key.
NULL_KEY = "_dbt_utils_surrogate_key_null_"

LIVE_DEFAULTS = {
    "temperature_celsius": 15.0,
    "weather_condition": "Clear",
    "humidity_percent": 65.0,
    "wind_speed_kph": 10.0,
}

# Calendar seed: date, name, type.
CALENDAR_SEED = (
    ("2021-01-01", "New Year's Day", "Holiday"),
    ("2021-01-18", "Martin Luther King Jr. Day", "Holiday"),
    ("2021-02-12", "Lincoln's Birthday", "Holiday"),
    ("2021-02-15", "Washington's Birthday", "Holiday"),
    ("2021-04-04", "Easter Sunday", "Holiday"),
    ("2021-05-31", "Memorial Day", "Holiday"),
    ("2021-07-04", "Independence Day", "Holiday"),
    ("2021-07-05", "Independence Day (Observed)", "Holiday"),
    ("2021-09-06", "Labor Day", "Holiday"),
    ("2021-10-11", "Columbus Day", "Holiday"),
    ("2021-11-02", "Election Day", "Event"),
    ("2021-11-07", "NYC Marathon", "Event"),
    ("2021-11-11", "Veterans Day", "Holiday"),
    ("2021-11-25", "Thanksgiving Day", "Holiday"),
    ("2021-12-25", "Christmas Day", "Holiday"),
)
