"""Calendar, location and daily weather dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonepulse.functions.geo import cell_id, centre_of, centroid_x, centroid_y
from zonepulse.functions.times import calendar_parts, date_id, is_weekend
from zonepulse.operators.aggregates import WIDE, exact_avg, exact_sum
from zonepulse.operators.prep import where_not
from zonepulse.sources.tables import date_spine

NO_EVENT = "No Event"


def dim_datetime(spark: SparkSession, events: DataFrame, start: str, end: str) -> DataFrame:
    """One row per day and event of that day; days without an event get placeholders.

    Any calendar row makes a day a holiday, whatever its type.
    """
    days = date_spine(spark, start, end, out="full_date")
    marked = days.join(events, days["full_date"] == events["event_date"], "left")
    return marked.select(
        date_id("full_date").alias("date_id"),
        "full_date",
        *[col.alias(name) for name, col in calendar_parts("full_date").items()],
        is_weekend("full_date").alias("is_weekend"),
        F.coalesce("event_name", F.lit(NO_EVENT)).alias("event_name"),
        F.coalesce("event_type", F.lit(NO_EVENT)).alias("event_type"),
        F.col("event_date").isNotNull().alias("is_holiday"),
    )


def dim_location(zones: DataFrame, unknown: str = "Unknown") -> DataFrame:
    """Zones of known boroughs with their centre and grid cell.

    Zones have one closed `ring`, or `rings` with holes as read from a polygon text.
    """
    if "rings" in zones.columns:
        centre = centre_of("rings")
    else:
        centre = F.struct(centroid_x("ring").alias("x"), centroid_y("ring").alias("y"))
    centred = where_not(zones, "borough", unknown).select(
        F.col("zone_id").cast("string").alias("zone_id"), "zone_name", "borough", centre.alias("zone_centroid"),
    )
    placed = centred.withColumns({"longitude": F.col("zone_centroid.x"), "latitude": F.col("zone_centroid.y")})
    return placed.withColumn("cell", cell_id("longitude", "latitude"))


def dim_weather(weather: DataFrame) -> DataFrame:
    """One row per day over all sources."""
    return weather.groupBy(F.col("observation_date").alias("weather_date")).agg(
        exact_avg("avg_temp_celsius", WIDE).alias("avg_temp_celsius"),
        F.max("max_temp_celsius").alias("max_temp_celsius"),
        F.min("min_temp_celsius").alias("min_temp_celsius"),
        exact_sum("precipitation_mm", WIDE).alias("total_precipitation_mm"),
        F.bool_or("is_rainy").alias("had_rain"),
        F.bool_or("is_snowy").alias("had_snow"),
        F.bool_or("is_foggy").alias("had_fog"),
    )
