"""Trip fact, hourly demand and features, fare training set, zone features."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from zonepulse.functions import fixed
from zonepulse.functions.scalars import (
    band_flag, in_band, jitter, number_text, per_area, rush_ratio, safe_div, stamp_text,
    surrogate_key,
)
from zonepulse.functions.times import days_between, dow, hour_floor, seconds_between
from zonepulse.operators.aggregates import hourly_counts, mean_where
from zonepulse.operators.joins import join_date, join_role
from zonepulse.operators.prep import date_between, in_ranges
from zonepulse.operators.windows import add_change, series_features

# Dimensions reach these functions as stored tables. Spark knows the size of a stored table
# and broadcasts it below its own threshold; a larger one is joined by shuffle, with skewed
# partitions split at run time. So no join here carries a broadcast hint.

LAGS = {"pickups_1h_ago": 1, "pickups_24h_ago": 24, "pickups_1week_ago": 168}
ROLLS = {"avg_pickups_7h": 7, "avg_pickups_24h": 24}

TRAINING_COLUMNS = (
    "fare_amount", "passenger_count", "trip_distance", "trip_duration_seconds",
    "picked_up_at", "pickup_cell", "dropoff_cell", "datetime_id", "weather_date",
)
NOISE_KEYS = (
    "picked_up_at", "trip_duration_seconds", "passenger_count", "trip_distance", "fare_amount",
    "pickup_cell", "dropoff_cell",
)
FARE_RANGES = {
    "fare_amount": (0, None),
    "trip_duration_seconds": (60, 7200),
    "trip_distance": (0, 100),
}


def fct_trips(trips: DataFrame, dates: DataFrame, locations: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips with dimension keys. Weather and both locations are required; the date is not,
    so trips outside the calendar keep a NULL datetime_id."""
    keyed = join_date(trips, dates.select("full_date", F.col("date_id").alias("datetime_id")), "picked_up_at")
    keyed = join_role(keyed, locations, "pickup_location_id", "zone_id", "cell", "pickup_cell")
    keyed = join_role(keyed, locations, "dropoff_location_id", "zone_id", "cell", "dropoff_cell")
    keyed = keyed.join(weather.select("weather_date"), F.to_date("picked_up_at") == F.col("weather_date"))
    return keyed.select(
        surrogate_key(stamp_text("picked_up_at"), "vendor_id", number_text("total_amount")).alias("trip_id"),
        "vendor_id", "payment_type_id", "rate_code_id",
        "datetime_id", "pickup_cell", "dropoff_cell", "weather_date",
        "picked_up_at", "dropped_off_at",
        "passenger_count", "trip_distance",
        seconds_between("picked_up_at", "dropped_off_at").alias("trip_duration_seconds"),
        "fare_amount", "extra_amount", "mta_tax", "tip_amount", "tolls_amount",
        "improvement_surcharge", "airport_fee", "total_amount",
    )


def hourly_demand(facts: DataFrame, dates: DataFrame, weather: DataFrame) -> DataFrame:
    """Pickups per cell and hour with calendar and weather attributes.

    Counts first and joins the dimensions afterwards, on the far fewer (cell, hour) rows; the
    day of the hour is the key of both. Should a dimension list a day more than once, the count
    is multiplied by the number of matches, which is what joining every single trip would give.
    """
    counts = hourly_counts(facts, "pickup_cell", "picked_up_at").withColumn("__day", F.to_date("timestamp_hour"))
    per_date = dates.groupBy(F.col("full_date").alias("__day")).agg(
        F.count(F.lit(1)).alias("__dates"),
        F.min("is_weekend").alias("is_weekend"),
        F.min("is_holiday").alias("is_holiday"),
    )
    per_weather = weather.groupBy(F.col("weather_date").alias("__day")).agg(
        F.count(F.lit(1)).alias("__weathers"),
        *[F.min(c).alias(c) for c in ("avg_temp_celsius", "total_precipitation_mm", "had_rain", "had_snow")],
    )
    times = F.coalesce("__dates", F.lit(1)) * F.coalesce("__weathers", F.lit(1))
    return (
        counts.join(per_date, "__day", "left")
        .join(per_weather, "__day", "left")
        .select(
            "pickup_cell", "timestamp_hour",
            (F.col("total_pickups") * times).alias("total_pickups"),
            "is_weekend", "is_holiday",
            dow("timestamp_hour").alias("day_of_week"),
            F.hour("timestamp_hour").alias("hour_of_day"),
            "avg_temp_celsius", "total_precipitation_mm", "had_rain", "had_snow",
        )
    )


def hourly_features(
    demand: DataFrame, dates: DataFrame, cell: str = "pickup_cell", block_rows: int | None = None
) -> DataFrame:
    """Calendar parts, lags, rolling means, daily change and the rain-in-rush-hour flag.

    A cell has at most one row per hour of the calendar here, so one sorted run per cell
    stays small however many trips it had; `block_rows` splits it nevertheless.
    """
    parts = dates.select("full_date", "month", "quarter", "day_of_year")
    dated = join_date(demand, parts, "timestamp_hour")
    rich = series_features(dated, cell, "timestamp_hour", "total_pickups", LAGS, ROLLS, block_rows)
    rich = add_change(rich, "total_pickups", "pickups_24h_ago", "pickups_change_24h")
    return rich.withColumn("rain_during_rush_hour", band_flag("had_rain", "hour_of_day")).select(
        "total_pickups", cell, "timestamp_hour",
        "hour_of_day", "day_of_week", "month", "quarter", "day_of_year",
        "avg_temp_celsius", "total_precipitation_mm", "had_rain", "had_snow",
        "is_weekend", "is_holiday",
        *LAGS, *ROLLS, "pickups_change_24h", "rain_during_rush_hour",
    )


def join_hourly_demand(trips: DataFrame, demand: DataFrame, out: str = "historical_demand") -> DataFrame:
    """LEFT join of trips to the demand of their cell and hour; none counts as 0."""
    side = demand.select(
        "pickup_cell", F.col("timestamp_hour").alias("__hour"), F.col("total_pickups").alias(out)
    )
    joined = trips.withColumn("__hour", hour_floor("picked_up_at")).join(side, ["pickup_cell", "__hour"], "left")
    return joined.withColumn(out, F.coalesce(out, F.lit(0))).drop("__hour")


def fare_training(
    facts: DataFrame, dates: DataFrame, weather: DataFrame, demand: DataFrame,
    noise: float = 0.1, seed: int | None = None,
) -> DataFrame:
    """Label and features for the fare model. The label carries uniform noise unless it is 0."""
    if noise and seed is None:
        raise ValueError("noise needs a seed")
    # Only fields that survive; the ranges cut rows before any join.
    trips = in_ranges(
        facts.select(*TRAINING_COLUMNS),
        FARE_RANGES,
    )
    days = dates.select(F.col("date_id").alias("datetime_id"), "day_of_week", "is_holiday", "is_weekend")
    sky = weather.select("weather_date", "avg_temp_celsius", "total_precipitation_mm", "had_rain", "had_snow")
    joined = trips.join(days, "datetime_id", "left").join(sky, "weather_date", "left")
    return join_hourly_demand(joined, demand).select(
        jitter(F.col("fare_amount").cast("double"), noise, seed, NOISE_KEYS).alias("fare_amount"),
        "passenger_count",
        F.col("trip_distance").cast("double").alias("trip_distance"),
        "trip_duration_seconds",
        F.hour("picked_up_at").alias("hour_of_day"),
        "day_of_week", "is_holiday", "is_weekend",
        "pickup_cell", "dropoff_cell",
        "avg_temp_celsius", "total_precipitation_mm", "had_rain", "had_snow",
        "historical_demand",
    )


def zone_volume(facts: DataFrame) -> DataFrame:
    day = F.to_date("picked_up_at")
    return facts.groupBy("pickup_cell").agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.min(day).alias("first_trip_date"),
        F.max(day).alias("last_trip_date"),
    )


def zone_patterns(
    features: DataFrame, bands: Mapping[str, tuple[int, int]] | None = None, wrap_night: bool = False
) -> DataFrame:
    """Intensity, weekend behaviour and time bands of every cell, in one grouping.

    The night band 22..4 is empty as a plain BETWEEN; `wrap_night` makes it span midnight.
    """
    bands = bands or {
        "morning_rush_demand": fixed.MORNING_RUSH,
        "evening_rush_demand": fixed.EVENING_RUSH,
        "night_demand": fixed.NIGHT,
    }
    n, weekend = F.col("total_pickups"), F.col("is_weekend")
    day, hour = F.to_date("timestamp_hour"), F.hour("timestamp_hour")
    return (
        features.groupBy("pickup_cell")
        .agg(
            F.avg(n).alias("avg_hourly_demand"),
            F.stddev_samp(n).alias("stddev_hourly_demand"),
            F.max(n).alias("peak_hourly_demand"),
            mean_where(weekend, n).alias("weekend_avg_demand"),
            mean_where(~weekend, n).alias("weekday_avg_demand"),
            F.count_distinct(F.when(weekend, day)).alias("weekend_days_active"),
            F.count_distinct(F.when(~weekend, day)).alias("weekday_days_active"),
            *[mean_where(in_band(hour, b, wrap_night), n).alias(name) for name, b in bands.items()],
        )
        .withColumn("weekend_ratio", safe_div("weekend_avg_demand", "weekday_avg_demand"))
    )


def zone_features(
    facts: DataFrame, features: DataFrame, locations: DataFrame, first: str, as_of: str,
    wrap_night: bool = False,
) -> DataFrame:
    """Per zone: volume, intensity, density, weekend ratio, time bands and activity span.

    Only zones with trips between `first` and `as_of`. Hours come from the demand or the
    feature table; lags are not needed.
    """
    volume = zone_volume(date_between(facts, "picked_up_at", first, as_of))
    patterns = zone_patterns(date_between(features, "timestamp_hour", first, as_of), wrap_night=wrap_night)
    joined = (
        locations.select(F.col("cell").alias("pickup_cell"), "zone_name", "borough", "latitude", "longitude")
        .join(volume, "pickup_cell")
        .join(patterns, "pickup_cell", "left")
    )

    def filled(col: str, default) -> Column:
        return F.coalesce(F.col(col), F.lit(default)).alias(col)

    return joined.select(
        "pickup_cell", "zone_name", "borough", "latitude", "longitude",
        "total_trips",
        filled("avg_hourly_demand", 0.0),
        per_area("total_trips").alias("trips_per_km2"),
        filled("weekend_ratio", 1.0),
        filled("stddev_hourly_demand", 0.0),
        filled("peak_hourly_demand", 0),
        filled("weekend_avg_demand", 0.0),
        filled("weekday_avg_demand", 0.0),
        filled("weekend_days_active", 0),
        filled("weekday_days_active", 0),
        filled("morning_rush_demand", 0.0),
        filled("evening_rush_demand", 0.0),
        filled("night_demand", 0.0),
        rush_ratio("morning_rush_demand", "evening_rush_demand", "avg_hourly_demand").alias("rush_hour_ratio"),
        "first_trip_date", "last_trip_date",
        days_between("first_trip_date", "last_trip_date").alias("days_active"),
        F.lit(as_of).cast("date").alias("created_at"),
    )
