"""Reports: RFM, vendors, demand map, trip sample, hot cells, live conditions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from zonepulse.functions import fixed
from zonepulse.functions.scalars import (
    demand_level, earnings, lookup, marker_size, pct, recency_score, rfm_segment, round_to,
    safe_div, speed_mph,
)
from zonepulse.functions.times import day_name, days_between, dow_name, hour_floor
from zonepulse.operators.aggregates import MONEY, WIDE, exact_avg, kpis, value_counts, volume_by
from zonepulse.operators.joins import complete_grid, label_locations, without_match
from zonepulse.operators.ordering import order_by_category, random_n, top_k
from zonepulse.operators.prep import date_between, last_interval, same_year, where_in
from zonepulse.operators.windows import quantile_scores, with_max
from zonepulse.plans.staging import parse_weather
from zonepulse.session import stash
from zonepulse.sources.tables import latest


# --- recency, frequency, monetary ---------------------------------------------------------

def rfm_metrics(facts: DataFrame, locations: DataFrame, as_of: str, days: int) -> DataFrame:
    """Per cell and its labels: days since the last pickup, trips, mean earnings, mean tip %.

    Aggregated per cell first; two zones that share a cell each get the cell's trips.
    """
    first = F.date_sub(F.lit(as_of).cast("date"), days)
    window = facts.where(F.col("picked_up_at") >= first.cast("timestamp_ntz"))
    window = window.where(F.col("picked_up_at") < F.date_add(F.lit(as_of).cast("date"), 1).cast("timestamp_ntz"))
    paid = earnings("fare_amount", "tip_amount", "extra_amount", "tolls_amount")
    cells = window.groupBy("pickup_cell").agg(
        days_between(F.max(F.to_date("picked_up_at")), F.lit(as_of).cast("date")).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency_trips"),
        exact_avg(paid, MONEY).alias("monetary_avg_earnings"),
        exact_avg(round_to(pct("tip_amount", "fare_amount"), 6), "decimal(18,6)").alias("avg_tip_percentage"),
    )
    labels = (
        locations.groupBy(F.col("cell").alias("pickup_cell"), "zone_name", "borough")
        .agg(F.count(F.lit(1)).alias("__zones"))
    )
    return cells.join(labels, "pickup_cell", "left").select(
        "pickup_cell", "zone_name", "borough", "recency_days",
        (F.col("frequency_trips") * F.coalesce("__zones", F.lit(1))).alias("frequency_trips"),
        "monetary_avg_earnings", "avg_tip_percentage",
    )


def rfm_scored(metrics: DataFrame, tiebreak: str | Sequence[str], frequency: str, monetary: str, recency: str = "recency_days") -> DataFrame:
    """Scores 1..5 and the segment for every row of the metrics.

    The columns of `tiebreak` tell the rows apart.
    """
    scored = quantile_scores(metrics, {"f_score": frequency, "m_score": monetary}, 5, tiebreak)
    scored = scored.withColumn("r_score", recency_score(recency))
    return scored.withColumn("segment", rfm_segment("r_score", "f_score", "m_score"))


def rfm(facts: DataFrame, locations: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    scored = rfm_scored(
        rfm_metrics(facts, locations, as_of, days), ("pickup_cell", "zone_name", "borough"),
        "frequency_trips", "monetary_avg_earnings",
    )
    return scored.select(
        "pickup_cell", "zone_name", "borough", "recency_days", "frequency_trips",
        round_to("monetary_avg_earnings", 2).alias("avg_earnings"),
        round_to("avg_tip_percentage", 1).alias("avg_tip_pct"),
        "r_score", "f_score", "m_score", "segment",
    )


def rfm_ordered(scored: DataFrame) -> DataFrame:
    return scored.orderBy(F.desc("f_score"), F.desc("m_score"), F.desc("r_score"))


def customer_rfm(orders: DataFrame, key: str, ts: str, amount: str, as_of: str) -> DataFrame:
    """The same scores for any keyed fact, e.g. customers by their orders."""
    metrics = orders.groupBy(key).agg(
        days_between(F.max(F.to_date(ts)), F.lit(as_of).cast("date")).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
        exact_avg(amount, MONEY).alias("monetary"),
    )
    return rfm_scored(metrics, key, "frequency", "monetary")


def segment_revenue(scored: DataFrame) -> DataFrame:
    """Sum over zones of trips times mean earnings, richest segment first."""
    value = F.col("frequency_trips") * F.col("avg_earnings").cast("decimal(18,2)")
    out = scored.groupBy("segment").agg(F.sum(value).cast("double").alias("total_revenue"))
    return out.orderBy(F.desc("total_revenue"))


def top_by_segment(scored: DataFrame, segments: Sequence[str], k: int = 50) -> DataFrame:
    chosen = where_in(scored, "segment", segments)
    return order_by_category(
        chosen, "segment", fixed.SEGMENTS, [F.desc("frequency_trips"), F.asc("pickup_cell")], k
    )


def rfm_summaries(scored: DataFrame, segments: Sequence[str] = fixed.SEGMENTS[:2]) -> dict[str, DataFrame]:
    return {
        "totals": scored.agg(
            F.count(F.lit(1)).alias("zones"),
            F.count(F.when(F.col("segment") == "Gold", 1)).alias("gold_zones"),
            F.count(F.when(F.col("segment") == "Silver", 1)).alias("silver_zones"),
            exact_avg("avg_earnings", WIDE).alias("avg_earnings"),
            exact_avg("avg_tip_pct", WIDE).alias("avg_tip_pct"),
        ),
        "counts": value_counts(scored, "segment"),
        "revenue": segment_revenue(scored),
        "top": top_by_segment(scored, segments),
        "prioritise": top_by_segment(scored, ["Gold"], 5),
        "watch": top_by_segment(scored, ["Watch"], 3),
    }


# --- vendors ------------------------------------------------------------------------------

def vendor_hours(facts: DataFrame) -> DataFrame:
    """Trips and speeds per vendor and full hour: one pass over the facts for all vendor
    reports, with at most one row per vendor and hour of the calendar."""
    moving = (F.col("trip_distance") > 0) & (F.col("trip_duration_seconds") > 0)
    speed = round_to(speed_mph("trip_distance", "trip_duration_seconds"), 6).cast("decimal(18,6)")
    return facts.groupBy("vendor_id", hour_floor("picked_up_at").alias("picked_up_at")).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(F.when(moving, speed)).alias("speed_sum"),
        F.count(F.when(moving, speed)).alias("speed_n"),
    )


def vendor_volume(hours: DataFrame, period: str) -> DataFrame:
    return volume_by(hours, "vendor_id", "picked_up_at", period, weight="trips")


def average_speed(hours: DataFrame, cap: float = 60.0) -> DataFrame:
    """Mean speed by vendor and hour of day over trips with distance and time; groups at or
    above the cap, and groups without such trips, drop."""
    out = hours.groupBy("vendor_id", F.hour("picked_up_at").alias("hour")).agg(
        F.try_divide(F.sum("speed_sum").cast("double"), F.sum("speed_n").cast("double")).alias("avg_speed_mph")
    )
    return out.where(F.col("avg_speed_mph") < cap)


def vendor_kpis(hourly: DataFrame, speed: DataFrame, first: str = "1", second: str = "2") -> DataFrame:
    """Totals of two vendors, the first one's share and its lead in mean speed, as one row."""

    def trips_of(vendor: str):
        return F.coalesce(F.sum(F.when(F.col("vendor_id") == vendor, F.col("trip_count"))), F.lit(0))

    totals = hourly.agg(trips_of(first).alias("trips_1"), trips_of(second).alias("trips_2"))
    means = speed.agg(
        *[
            exact_avg(F.when(F.col("vendor_id") == v, F.col("avg_speed_mph")), WIDE).alias(name)
            for v, name in ((first, "s1"), (second, "s2"))
        ]
    )
    lead = means.select(F.col("s1") - F.col("s2")).scalar()
    share = safe_div(F.col("trips_1") * F.lit(100.0), (F.col("trips_1") + F.col("trips_2")).cast("double"))
    return totals.withColumns({"share_1_pct": share, "speed_lead_mph": lead})


def vendor_report(
    facts: DataFrame, start: str, end: str, fill: str = "mean", seed: int | None = None,
    vendors: Sequence[str] = ("1", "2"),
) -> dict[str, DataFrame]:
    """By hour, weekday, month of the year of `end`, and speed; weekdays and months filled up.

    The facts are read once, into a stored table of vendor hours.
    """
    year = end[:4]
    chosen = where_in(facts, "vendor_id", vendors)
    chosen = date_between(chosen, "picked_up_at", min(start, f"{year}-01-01"), max(end, f"{year}-12-31"))
    hours = stash(vendor_hours(chosen), "vendors")
    span = date_between(hours, "picked_up_at", start, end)
    hourly, weekly = vendor_volume(span, "hour"), vendor_volume(span, "day_of_week")
    monthly = vendor_volume(same_year(hours, "picked_up_at", end), "month")
    speed = average_speed(span)
    months = [f"{year}-{m:02d}" for m in range(1, 13)]
    name = lookup("vendor_id", fixed.VENDOR_NAMES).alias("vendor")
    week_grid = complete_grid(
        weekly, "vendor_id", "day_of_week", list(range(1, 8)), "trip_count", fill,
        (0.8, 1.2), list(vendors), (1000, 5000), seed,
    )
    month_grid = complete_grid(
        monthly, "vendor_id", "month", months, "trip_count", fill,
        (0.7, 1.3), list(vendors), (30000, 100000), seed,
    )
    return {
        "hourly": hourly.select("*", name),
        "weekly": week_grid.withColumn("day_name", dow_name("day_of_week")).select("*", name),
        "monthly": month_grid.select("*", name),
        "speed": speed.select("*", name),
        "kpis": vendor_kpis(hourly, speed),
    }


# --- demand map ---------------------------------------------------------------------------

def demand_at_hour(forecast: DataFrame, hour: int, cell: str = "pickup_cell") -> DataFrame:
    """One row per cell for an hour of the day: mean prediction and latest hour."""
    return (
        forecast.where(F.hour("timestamp_hour") == hour)
        .groupBy(cell)
        .agg(
            exact_avg("predicted_total_pickups", WIDE).alias("predicted_total_pickups"),
            F.max("timestamp_hour").alias("timestamp_hour"),
        )
    )


def demand_levels(demand: DataFrame, col: str = "predicted_total_pickups") -> DataFrame:
    """Level and marker size by share of the largest demand."""
    topped = with_max(demand, col, "__max")
    return topped.withColumns(
        {"demand_level": demand_level(col, "__max"), "marker_size": marker_size(col, "__max")}
    ).drop("__max")


def demand_map(forecast: DataFrame, locations: DataFrame, hour: int, k: int = 10) -> dict[str, DataFrame]:
    # One row per cell, read by each of the four parts.
    demand = stash(demand_at_hour(forecast, hour), "demand_map")
    cells = locations.select(F.col("cell").alias("pickup_cell")).where(F.col("pickup_cell").isNotNull()).distinct()
    best = top_k(demand, [F.desc("predicted_total_pickups"), F.asc("pickup_cell")], k)
    labels = locations.withColumnRenamed("cell", "pickup_cell")
    return {
        "levels": demand_levels(demand),
        "without_forecast": without_match(cells, demand, "pickup_cell"),
        "kpis": kpis(demand, "predicted_total_pickups"),
        "top": label_locations(best, labels, "pickup_cell"),
    }


def recent_forecast(forecast: DataFrame, as_of: str, interval: str = "7 days") -> DataFrame:
    recent = last_interval(forecast, "timestamp_hour", interval, as_of, upper=True)
    return recent.withColumn("hour", F.hour("timestamp_hour"))


# --- smaller reports ----------------------------------------------------------------------

SAMPLE_COLUMNS = (
    "trip_id", "picked_up_at", "dropped_off_at", "passenger_count", "trip_distance",
    "fare_amount", "extra_amount", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "airport_fee", "total_amount",
)


def trip_sample(facts: DataFrame, n: int, start: str, end: str, seed: int) -> DataFrame:
    """n random paid trips of a date range, with the day's name."""
    paid = facts.where((F.col("trip_distance") > 0) & (F.col("fare_amount") > 0))
    span = date_between(paid, "picked_up_at", start, end).select(*SAMPLE_COLUMNS)
    drawn = random_n(span, n, seed, ["trip_id"])
    return drawn.withColumn("day_of_week", day_name("picked_up_at"))


def hot_cells(features: DataFrame, as_of=None, interval: str = "1 hour", k: int = 200, cell: str = "pickup_cell") -> DataFrame:
    """Cells with the most pickups over the last interval."""
    recent = last_interval(features, "timestamp_hour", interval, as_of)
    recent = recent.select(cell, F.col("total_pickups").alias("total_pickups_forecast"))
    return top_k(recent, [F.desc("total_pickups_forecast"), F.asc(cell)], k)


def live_conditions(raw: DataFrame) -> DataFrame:
    """The newest weather document's reading, or defaults when there is none."""
    # The newest document is found on its text; only that one is parsed.
    newest = latest(raw, "inserted_at", ["raw_json"])
    doc = parse_weather(newest)
    read = {
        "temperature_celsius": F.col("doc.main.temp").try_cast("double"),
        "weather_condition": F.get("doc.weather", F.lit(0))["main"],
        "humidity_percent": F.col("doc.main.humidity").try_cast("double"),
        "wind_speed_kph": F.col("doc.wind.speed").try_cast("double"),
    }
    return doc.select(
        *[
            F.when(F.col("raw_json").isNull(), F.lit(fixed.LIVE_DEFAULTS[name])).otherwise(col).alias(name)
            for name, col in read.items()
        ]
    )


