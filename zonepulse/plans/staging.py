"""Staging: conformed trips, calendar events and weather."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from zonepulse.functions import fixed
from zonepulse.functions.scalars import (
    cast_to, f_to_c, flag, has_word, in_words, inch_to_mm, round_to,
)
from zonepulse.functions.times import day_of, from_epoch, shift_days, shift_years, stamp
from zonepulse.operators.aggregates import WIDE, coverage, exact_avg
from zonepulse.operators.ordering import random_n
from zonepulse.operators.prep import (
    conform, date_between, require_positive, require_present, time_range, where_in,
)
from zonepulse.sources.sinks import append

NUMERIC = "decimal(18,4)"
MEASURES = ("trip_distance", "passenger_count", "total_amount")
LOCATION_IDS = ("pickup_location_id", "dropoff_location_id")

TRIP_SPEC = {
    "vendor_id": ("vendor_id", "string"),
    "picked_up_at": ("pickup_datetime", "timestamp_ntz"),
    "dropped_off_at": ("dropoff_datetime", "timestamp_ntz"),
    "passenger_count": ("passenger_count", "long"),
    "trip_distance": ("trip_distance", NUMERIC),
    "pickup_location_id": ("pickup_location_id", "string"),
    "dropoff_location_id": ("dropoff_location_id", "string"),
    "rate_code_id": ("rate_code", "string"),
    "payment_type_id": ("payment_type", "string"),
    "fare_amount": ("fare_amount", NUMERIC),
    "extra_amount": ("extra", NUMERIC),
    "mta_tax": ("mta_tax", NUMERIC),
    "tip_amount": ("tip_amount", NUMERIC),
    "tolls_amount": ("tolls_amount", NUMERIC),
    "improvement_surcharge": ("imp_surcharge", NUMERIC),
    "airport_fee": ("airport_fee", NUMERIC),
    "total_amount": ("total_amount", NUMERIC),
}

WEATHER_COLUMNS = (
    "observation_date", "avg_temp_celsius", "max_temp_celsius", "min_temp_celsius",
    "precipitation_mm", "is_rainy", "is_snowy", "is_foggy",
)

# Every field as text: numbers and quoted numbers then read alike, and a bad one is just NULL.
WEATHER_DOC = (
    "dt string, main struct<temp:string,temp_max:string,temp_min:string,humidity:string>, "
    "weather array<struct<main:string>>, wind struct<speed:string>, rain struct<`1h`:string>"
)


def batch_trips(raw: DataFrame, shift: int, start=None, end=None) -> DataFrame:
    """History: quality filters and the time range on the source columns, then the shift."""
    good = require_present(require_positive(raw, MEASURES), LOCATION_IDS)
    good = time_range(good, "pickup_datetime", start, end)
    moved = {
        **TRIP_SPEC,
        "picked_up_at": (shift_days("pickup_datetime", shift), "timestamp_ntz"),
        "dropped_off_at": (shift_days("dropoff_datetime", shift), "timestamp_ntz"),
    }
    return conform(good, moved)


def landed_trips(landing: DataFrame, start: str | None = None, day_col: str | None = None) -> DataFrame:
    """Streamed rows from the cutoff on. Empty location ids pass here, NULL ones do not.

    `day_col` names the partition column holding the pickup day, so that older partitions are
    never listed or opened.
    """
    good = require_present(require_positive(landing, MEASURES), LOCATION_IDS, allow_empty=True)
    good = time_range(good, "pickup_datetime", start)
    if day_col and start is not None:
        good = good.where(F.col(day_col) >= F.lit(start[:10]).cast("date"))
    return conform(good, TRIP_SPEC)


def unify_batch_stream(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """UNION ALL; a day covered by both sources counts twice."""
    return batch.unionByName(stream)


def stg_trips(
    batch: DataFrame, landing: DataFrame, shift: int, batch_start: str, batch_end: str,
    stream_start: str, day_col: str | None = None,
) -> DataFrame:
    """Batch rows from [batch_start, batch_end) before the shift, landed rows from stream_start."""
    return unify_batch_stream(
        batch_trips(batch, shift, batch_start, batch_end), landed_trips(landing, stream_start, day_col)
    )


def stg_events(seed: DataFrame, years: int) -> DataFrame:
    return conform(
        seed,
        {
            "event_date": (shift_years(F.col("event_date").cast("date"), years), "date"),
            "event_name": ("event_name", "string"),
            "event_type": ("event_type", "string"),
        },
    )


def stg_weather(readings: DataFrame, years: int, ids: Sequence[str] = fixed.STATION_IDS) -> DataFrame:
    """Station readings in Celsius and millimetres, one row per reading."""
    return where_in(readings, "stn", ids).select(
        F.col("stn").cast("string").alias("station_id"),
        shift_years(F.col("date").cast("date"), years).alias("observation_date"),
        f_to_c("temp").alias("avg_temp_celsius"),
        f_to_c("max").alias("max_temp_celsius"),
        f_to_c("min").alias("min_temp_celsius"),
        inch_to_mm("prcp").alias("precipitation_mm"),
        flag("fog").alias("is_foggy"),
        flag("rain_drizzle").alias("is_rainy"),
        flag("snow_ice_pellets").alias("is_snowy"),
    )


def parse_weather(raw: DataFrame) -> DataFrame:
    """The document parsed once into nested text fields next to the original columns."""
    return raw.withColumn("doc", F.from_json("raw_json", WEATHER_DOC))


def stg_weather_json(raw: DataFrame) -> DataFrame:
    sky = F.get("doc.weather", F.lit(0))["main"]
    return parse_weather(raw).select(
        day_of(from_epoch(F.col("doc.dt").try_cast("long"))).alias("observation_date"),
        cast_to("doc.main.temp", "double", safe=True).alias("avg_temp_celsius"),
        cast_to("doc.main.temp_max", "double", safe=True).alias("max_temp_celsius"),
        cast_to("doc.main.temp_min", "double", safe=True).alias("min_temp_celsius"),
        F.coalesce(cast_to("doc.rain.1h", "double", safe=True), F.lit(0.0)).alias("precipitation_mm"),
        has_word(sky, "rain").alias("is_rainy"),
        has_word(sky, "snow").alias("is_snowy"),
        in_words(sky, fixed.FOG_WORDS).alias("is_foggy"),
        "inserted_at",
    )


def station_rollup(
    readings: DataFrame, years: int, first: str | None = None, last: str | None = None,
    ids: Sequence[str] = fixed.STATION_IDS,
) -> DataFrame:
    """One row per day over all stations; readings without temperature or rain do not count.

    Converts after aggregating: the conversions are linear, so means and extremes carry over.
    """
    good = where_in(readings, "stn", ids).where(F.col("temp").isNotNull() & F.col("prcp").isNotNull())
    if first is not None:
        good = good.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return (
        good.groupBy(shift_years("date", years).alias("observation_date"))
        .agg(
            exact_avg("temp", WIDE).alias("t"), F.max("max").alias("hi"), F.min("min").alias("lo"),
            exact_avg("prcp", WIDE).alias("p"),
            *[
                F.bool_or(F.col(src).try_cast("int") == 1).alias(out)
                for out, src in (
                    ("is_rainy", "rain_drizzle"), ("is_snowy", "snow_ice_pellets"), ("is_foggy", "fog"),
                )
            ],
        )
        .select(
            "observation_date",
            f_to_c("t").alias("avg_temp_celsius"),
            f_to_c("hi").alias("max_temp_celsius"),
            f_to_c("lo").alias("min_temp_celsius"),
            round_to(F.col("p") * 25.4, 2).alias("precipitation_mm"),
            "is_rainy", "is_snowy", "is_foggy",
        )
    )


def weather_unified(*sources: DataFrame) -> DataFrame:
    """UNION ALL of the common weather columns."""
    return reduce(DataFrame.unionByName, [s.select(*WEATHER_COLUMNS) for s in sources])


def backfill_rows(source: DataFrame, day_first: str, day_last: str, shift: int) -> DataFrame:
    """Rows of some source days, cleaned and shifted, ready to append to the landing table."""
    good = date_between(source, "pickup_datetime", day_first, day_last)
    good = require_present(require_positive(good, MEASURES), LOCATION_IDS, allow_empty=True)
    return good.withColumns(
        {c: shift_days(c, shift) for c in ("pickup_datetime", "dropoff_datetime")}
    )


def backfill(
    source: DataFrame, path: str, schema: StructType, day_first: str, day_last: str, shift: int,
    n: int | None = None, seed: int = 0, keys: Sequence[str] = (), as_of=None,
) -> DataFrame:
    """Appends cleaned and shifted rows to a landing table and returns its coverage.

    With `n` a random sample of exactly that many rows, drawn by `keys`; columns the source
    lacks are NULL in the table.
    """
    rows = backfill_rows(source, day_first, day_last, shift)
    if n is not None:
        rows = random_n(rows, n, seed, keys)
    if "processing_timestamp" in schema.names:
        rows = rows.withColumn("processing_timestamp", stamp(as_of).cast("timestamp_ntz"))
    append(rows, path, schema)
    landed = source.sparkSession.read.schema(schema).parquet(path)
    return coverage(landed, "pickup_location_id", "pickup_datetime")
