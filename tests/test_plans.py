from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from zonepulse.functions import fixed
from zonepulse.plans import dimensions as D, facts as FA, reports as R, staging as ST
from zonepulse.sources import tables as TB


def pairs(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def trip(pickup, **over):
    row = {
        "vendor_id": "1", "pickup_datetime": datetime.fromisoformat(pickup),
        "dropoff_datetime": datetime.fromisoformat(pickup).replace(minute=59), "passenger_count": 1,
        "trip_distance": 2.0, "pickup_location_id": "1", "dropoff_location_id": "2", "rate_code": "1",
        "payment_type": "1", "fare_amount": 10.0, "extra": 0.5, "mta_tax": 0.5, "tip_amount": 1.0,
        "tolls_amount": 0.0, "imp_surcharge": 0.3, "airport_fee": 0.0, "total_amount": 12.3,
    }
    row.update(over)
    return tuple(row.values())


def trips(frame, *rows):
    return frame(list(rows), TB.TRIP_SCHEMA)


# --- staging ------------------------------------------------------------------------------

def test_cutoffs_are_half_open_and_one_day_overlaps(frame):
    batch = trips(frame, trip("2020-12-31 23:59:59"), trip("2021-01-01 00:00:00"), trip("2021-11-23 23:00:00"), trip("2021-11-24 00:00:00"))
    landing = trips(frame, trip("2025-11-23 23:59:59"), trip("2025-11-24 00:00:00"))
    both = ST.stg_trips(batch, landing, 1462, "2021-01-01", "2021-11-24", "2025-11-24")
    assert pairs(both, "picked_up_at") == [
        (datetime(2025, 1, 2),), (datetime(2025, 11, 24, 0),), (datetime(2025, 11, 24, 23),)]


def test_batch_drops_empty_ids_and_stream_keeps_them(frame):
    rows = [trip("2025-01-01 00:00:00", pickup_location_id=z) for z in ("", None, "5")]
    bad = [trip("2025-01-01 00:00:00", trip_distance=0.0), trip("2025-01-01 00:00:00", passenger_count=None),
           trip("2025-01-01 00:00:00", total_amount=-1.0)]
    df = trips(frame, *rows, *bad)
    assert pairs(ST.batch_trips(df, 0), "pickup_location_id") == [("5",)]
    assert pairs(ST.landed_trips(df), "pickup_location_id") == [("",), ("5",)]
    assert dict(ST.batch_trips(df, 0).dtypes)["fare_amount"] == "decimal(18,4)"


def test_landing_partitions_are_pruned(frame, spark, tmp_path):
    from zonepulse.sources import sinks as K

    path = str(tmp_path / "landing")
    rows = trips(frame, trip("2025-11-23 23:59:59"), trip("2025-11-24 00:00:00"), trip("2025-11-25 00:00:00"))
    K.materialize(K.with_day(rows, "pickup_datetime", "day"), path, ["day"])
    landing = spark.read.parquet(path)
    out = ST.landed_trips(landing, "2025-11-24", day_col="day")
    assert out.count() == ST.landed_trips(landing, "2025-11-24").count() == 2
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2025-11-24" in plan


def test_calendar_shift(frame):
    seed = frame([(date(2021, 2, 28), "a", "Holiday"), (date(2020, 2, 29), "b", "Event")], TB.CALENDAR_SCHEMA)
    assert pairs(ST.stg_events(seed, 4), "event_date") == [(date(2024, 2, 29),), (date(2025, 2, 28),)]


def test_builtin_calendar(spark):
    seed = TB.calendar_seed(spark)
    assert seed.count() == 15 and seed.select("event_date").distinct().count() == 15


STATION = "stn string, date date, temp double, max double, min double, prcp double, fog string, rain_drizzle string, snow_ice_pellets string"


def test_stations(frame):
    rows = [
        ("725030", date(2020, 2, 28), 50.0, 60.0, 40.0, 0.1, "0", "1", "0"),
        ("744860", date(2020, 2, 29), 70.0, 80.0, 50.0, 0.3, None, "0", "0"),
        ("725053", date(2020, 2, 28), None, 99.0, 1.0, 0.3, "1", "0", "0"),
        ("999999", date(2020, 2, 28), 0.0, 0.0, 0.0, 0.0, "1", "1", "1"),
    ]
    df = frame(rows, STATION)
    assert ST.stg_weather(df, 4).count() == 3
    assert pairs(ST.stg_weather(df, 4).where("station_id = '744860'"), "is_foggy", "avg_temp_celsius") == [(False, 21.11)]
    # One year on, both days fall on 28 February and are rolled up together.
    out = ST.station_rollup(df, 1).collect()
    assert len(out) == 1 and out[0]["observation_date"] == date(2021, 2, 28)
    assert (out[0]["avg_temp_celsius"], out[0]["max_temp_celsius"], out[0]["min_temp_celsius"]) == (15.56, 26.67, 4.44)
    assert out[0]["precipitation_mm"] == 5.08 and out[0]["is_rainy"] is True and out[0]["is_foggy"] is False


DOCS = [
    '{"dt":1735732800,"main":{"temp":5.5,"temp_max":"6.5","temp_min":1},"weather":[{"main":"Light Rain"}],"rain":{"1h":2.5}}',
    '{"dt":1735732800,"main":{"temp":"warm"},"weather":[{"main":"HAZE"}]}',
    '{"dt":1735732800,"main":{},"weather":[]}',
    "broken",
    "",
]


def test_weather_documents(frame):
    df = frame([(d, datetime(2025, 1, 1, i)) for i, d in enumerate(DOCS)], TB.RAW_JSON_SCHEMA)
    rows = ST.stg_weather_json(df).orderBy("inserted_at").collect()
    assert rows[0][:8] == (date(2025, 1, 1), 5.5, 6.5, 1.0, 2.5, True, False, False)
    assert rows[1]["avg_temp_celsius"] is None and rows[1]["is_foggy"] is True and rows[1]["precipitation_mm"] == 0.0
    assert rows[2]["is_foggy"] is False and rows[3]["observation_date"] is None and rows[4]["precipitation_mm"] == 0.0
    unified = ST.weather_unified(ST.stg_weather_json(df), ST.stg_weather_json(df))
    assert unified.count() == 10 and unified.columns == list(ST.WEATHER_COLUMNS)
    daily = D.dim_weather(ST.stg_weather_json(df).where("observation_date is not null")).first()
    assert daily["total_precipitation_mm"] == 2.5 and daily["had_rain"] is True and daily["avg_temp_celsius"] == 5.5


def test_live_conditions(frame):
    df = frame([(d, datetime(2025, 1, 1, i)) for i, d in enumerate(DOCS[:2])], TB.RAW_JSON_SCHEMA)
    row = R.live_conditions(df).first()
    assert row["temperature_celsius"] is None and row["weather_condition"] == "HAZE" and row["wind_speed_kph"] is None
    assert R.live_conditions(df.limit(0)).first().asDict() == fixed.LIVE_DEFAULTS


def test_latest_keeps_null_fields_of_a_present_row(frame):
    df = frame([(1, "a"), (2, None)], "t int, x string")
    assert TB.latest(df, "t", ["x"], {"x": "none"}).first()["x"] is None
    assert TB.latest(df.limit(0), "t", ["x"], {"x": "none"}).first()["x"] == "none"


# --- dimensions ---------------------------------------------------------------------------

def events(frame, *rows):
    return frame(list(rows), TB.CALENDAR_SCHEMA)


def test_calendar_dimension(spark, frame):
    marks = events(frame, (date(2025, 1, 1), "NY", "Holiday"), (date(2025, 1, 2), "Run", "Event"), (date(2025, 1, 2), "Fair", "Event"))
    dim = D.dim_datetime(spark, marks, "2025-01-01", "2025-12-31")
    assert dim.count() == 366
    first = dim.where("date_id = '20250101'").first()
    assert first["event_name"] == "NY" and first["is_holiday"] and first["day_of_week"] == 4 and not first["is_weekend"]
    assert dim.where("full_date = '2025-01-02' and is_holiday").count() == 2
    quiet = dim.where("date_id = '20250104'").first()
    assert (quiet["event_name"], quiet["is_holiday"], quiet["is_weekend"]) == ("No Event", False, True)


def square(x, y):
    return [(x - 0.1, y - 0.1), (x + 0.1, y - 0.1), (x + 0.1, y + 0.1), (x - 0.1, y + 0.1), (x - 0.1, y - 0.1)]


def locations(frame):
    rows = [("1", "One", "A", square(-73.9, 40.7)), ("2", "Two", "B", square(-73.8, 40.6)),
            ("3", "Three", "Unknown", square(0.0, 0.0)), ("4", "Four", None, square(0.0, 0.0))]
    return D.dim_location(frame(rows, TB.ZONE_SCHEMA))


def test_location_dimension(frame):
    assert pairs(locations(frame), "zone_id", "cell") == [("1", "h3_res8_-73900_40700"), ("2", "h3_res8_-73800_40600")]


# --- facts --------------------------------------------------------------------------------

WEATHER = ("weather_date date, avg_temp_celsius double, max_temp_celsius double, min_temp_celsius double, "
           "total_precipitation_mm double, had_rain boolean, had_snow boolean, had_fog boolean")


def star(spark, frame, *marks):
    dates = D.dim_datetime(spark, events(frame, *marks), "2025-01-01", "2025-01-31")
    weather = frame([(date(2025, m, d), 1.0, 2.0, 0.0, 0.5, d % 2 == 0, False, False) for m, d in ((1, 1), (1, 2), (2, 1))], WEATHER)
    return dates, locations(frame), weather


def test_trip_fact(spark, frame):
    dates, places, weather = star(spark, frame)
    rows = trips(
        frame, trip("2025-01-01 10:00:00"), trip("2025-01-03 10:00:00"), trip("2025-02-01 10:00:00"),
        trip("2025-01-02 10:00:00", dropoff_location_id="3"), trip("2025-01-02 10:00:00", pickup_location_id="77"),
        trip("2025-01-01 10:00:00", payment_type="2"),
    )
    out = FA.fct_trips(ST.batch_trips(rows, 0), dates, places, weather)
    assert pairs(out.fillna("-"), "datetime_id", "payment_type_id") == [("-", "1"), ("20250101", "1"), ("20250101", "2")]
    assert out.where("datetime_id = '20250101'").select("trip_id").distinct().count() == 1
    assert out.first()["trip_duration_seconds"] == 59 * 60


def naive_demand(facts, dates, weather):
    """Joins every trip to the dimensions by their ids before grouping."""
    days = dates.select(F.col("date_id").alias("datetime_id"), "is_weekend", "is_holiday")
    joined = facts.join(days, "datetime_id", "left").join(weather, "weather_date", "left")
    return joined.groupBy("pickup_cell", F.date_trunc("hour", "picked_up_at").cast("timestamp_ntz").alias("timestamp_hour")).agg(
        F.count(F.lit(1)).alias("total_pickups"), F.min("is_weekend").alias("is_weekend"), F.min("is_holiday").alias("is_holiday"))


@pytest.mark.parametrize("marks", [(), ((date(2025, 1, 1), "a", "x"), (date(2025, 1, 1), "b", "x"))])
def test_counting_first_equals_joining_first(spark, frame, marks):
    dates, places, weather = star(spark, frame, *marks)
    rows = trips(frame, *[trip(f"2025-{m}-0{d} {h:02d}:15:00") for m, d, h in (("01", 1, 3), ("01", 1, 3), ("01", 2, 3), ("02", 1, 9))])
    facts = FA.fct_trips(ST.batch_trips(rows, 0), dates, places, weather)
    cols = ["pickup_cell", "timestamp_hour", "total_pickups", "is_weekend", "is_holiday"]
    mine = FA.hourly_demand(facts, dates, weather)
    want = naive_demand(facts, dates, weather)
    assert sorted(map(str, mine.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))
    assert mine.agg(F.max("total_pickups")).first()[0] == (8 if marks else 2)


DEMAND = ("pickup_cell string, timestamp_hour timestamp_ntz, total_pickups long, is_weekend boolean, is_holiday boolean, "
          "day_of_week int, hour_of_day int, avg_temp_celsius double, total_precipitation_mm double, had_rain boolean, had_snow boolean")


def hours(frame, cell, stamps, rain=None):
    rows = []
    for i, s in enumerate(stamps):
        t = datetime.fromisoformat(s)
        wd = t.isoweekday() % 7 + 1
        rows.append((cell, t, i + 1, wd in (1, 7), False, wd, t.hour, 1.0, 0.0, rain, False))
    return frame(rows, DEMAND)


def test_features_of_a_short_series(spark, frame):
    dates, _, _ = star(spark, frame)
    demand = hours(frame, "c", ["2025-01-01 07:00:00", "2025-01-01 09:00:00", "2025-03-01 10:00:00"], True)
    rows = FA.hourly_features(demand, dates).orderBy("timestamp_hour").collect()
    assert [r["pickups_1h_ago"] for r in rows] == [None, 1, 2]
    assert [r["avg_pickups_7h"] for r in rows] == [1.0, 1.5, 2.0]
    assert [r["rain_during_rush_hour"] for r in rows] == [1, 1, 0]
    assert [r["month"] for r in rows] == [1, 1, None] and rows[2]["pickups_change_24h"] is None


def test_zone_patterns_of_weekdays_only(frame):
    demand = hours(frame, "c", ["2025-01-01 08:00:00", "2025-01-02 23:00:00"])
    row = FA.zone_patterns(demand).first()
    assert row["weekend_ratio"] is None and row["weekend_days_active"] == 0 and row["weekday_days_active"] == 2
    assert row["night_demand"] is None and row["morning_rush_demand"] == 1.0
    assert FA.zone_patterns(demand, wrap_night=True).first()["night_demand"] == 2.0
    one = FA.zone_patterns(demand.limit(1)).first()
    assert one["stddev_hourly_demand"] is None


def test_zone_features_fill_gaps(spark, frame):
    dates, places, weather = star(spark, frame)
    rows = trips(frame, trip("2025-01-01 08:10:00"), trip("2025-01-02 09:10:00"))
    facts = FA.fct_trips(ST.batch_trips(rows, 0), dates, places, weather)
    out = FA.zone_features(facts, FA.hourly_demand(facts, dates, weather), places, "2025-01-01", "2025-01-31").collect()
    assert len(out) == 1
    row = out[0]
    assert (row["total_trips"], row["weekend_ratio"], row["night_demand"], row["days_active"]) == (2, 1.0, 0.0, 1)
    assert row["rush_hour_ratio"] == 1.0 and row["created_at"] == date(2025, 1, 31)
    assert row["trips_per_km2"] == pytest.approx(2 / 0.737) and row["stddev_hourly_demand"] == 0.0


def test_fare_training_ranges(spark, frame):
    dates, places, weather = star(spark, frame)
    rows = trips(
        frame, trip("2025-01-01 08:10:00"), trip("2025-01-01 08:20:00", fare_amount=0.0),
        trip("2025-01-01 08:58:00"), trip("2025-01-01 08:30:00", trip_distance=100.0),
    )
    facts = FA.fct_trips(ST.batch_trips(rows, 0), dates, places, weather)
    demand = FA.hourly_demand(facts, dates, weather)
    out = FA.fare_training(facts, dates, weather, demand, noise=0).collect()
    # 08:58 to 08:59 lasts exactly 60 seconds and is out.
    assert [(r["fare_amount"], r["historical_demand"]) for r in out] == [(10.0, 4)]
    none = FA.fare_training(facts, dates, weather, demand.limit(0), noise=0).first()
    assert none["historical_demand"] == 0
    noisy = FA.fare_training(facts, dates, weather, demand, noise=0.1, seed=1).first()["fare_amount"]
    assert 9.0 <= noisy <= 11.0 and noisy != 10.0
    with pytest.raises(ValueError):
        FA.fare_training(facts, dates, weather, demand)


# --- reports ------------------------------------------------------------------------------

FACT = ("pickup_cell string, vendor_id string, picked_up_at timestamp_ntz, trip_distance double, trip_duration_seconds long, "
        "fare_amount double, tip_amount double, extra_amount double, tolls_amount double")


def fact_rows(frame, *rows):
    return frame([(c, v, datetime.fromisoformat(t), 5.0, sec, fare, 1.0, 0.0, 0.0) for c, v, t, sec, fare in rows], FACT)


def labels(frame, *rows):
    return frame(list(rows), "cell string, zone_name string, borough string")


def test_rfm_shared_cells_and_window(frame):
    facts = fact_rows(
        frame, ("a", "1", "2025-01-31 10:00:00", 60, 10.0), ("a", "1", "2025-01-20 10:00:00", 60, 0.0),
        ("b", "1", "2025-01-01 10:00:00", 60, 10.0), ("b", "1", "2024-12-31 23:59:59", 60, 10.0), ("c", "1", "2025-02-01 00:00:00", 60, 10.0),
    )
    places = labels(frame, ("a", "N1", "B"), ("a", "N2", "B"))
    out = {(r["pickup_cell"], r["zone_name"]): r for r in R.rfm(facts, places, "2025-01-31", 30).collect()}
    assert set(out) == {("a", "N1"), ("a", "N2"), ("b", None)}
    a = out[("a", "N1")]
    assert (a["recency_days"], a["frequency_trips"], a["avg_earnings"], a["avg_tip_pct"], a["r_score"]) == (0, 2, 6.0, 5.0, 5)
    assert out[("b", None)]["recency_days"] == 30


def test_rfm_of_nothing(frame):
    empty = R.rfm(fact_rows(frame).limit(0), labels(frame), "2025-01-31")
    parts = R.rfm_summaries(empty)
    assert empty.count() == 0 and parts["totals"].first()["zones"] == 0 and parts["revenue"].count() == 0


def test_rfm_quintiles_have_ntile_sizes(spark):
    from zonepulse.operators.windows import quantile_scores

    df = spark.range(1003).select(F.col("id").alias("k"), (F.col("id") * 37 % 11).alias("f"))
    a = quantile_scores(df, {"s": "f"}, 5, "k")
    assert [r["count"] for r in a.groupBy("s").count().orderBy("s").collect()] == [201, 201, 201, 200, 200]


def test_vendor_report(frame):
    facts = fact_rows(
        frame, ("a", "1", "2025-01-05 10:00:00", 3600, 1.0), ("a", "1", "2025-01-05 10:30:00", 0, 1.0),
        ("a", "2", "2025-01-06 11:00:00", 1, 1.0), ("a", "3", "2025-01-06 11:00:00", 60, 1.0), ("a", "1", "2025-06-01 00:00:00", 1800, 1.0),
    )
    out = R.vendor_report(facts, "2025-01-01", "2025-01-31", "zero")
    assert pairs(out["hourly"], "vendor_id", "hour", "trip_count", "vendor") == [("1", 10, 2, "Vendor 1"), ("2", 11, 1, "Vendor 2")]
    # 5 miles in a second is no trip speed: the whole group is dropped.
    assert pairs(out["speed"], "vendor_id", "hour", "avg_speed_mph") == [("1", 10, 5.0)]
    assert out["weekly"].count() == 14 and out["weekly"].where("day_name = 'Sun' and vendor_id = '1'").first()["trip_count"] == 2
    assert pairs(out["monthly"].where("trip_count > 0"), "vendor_id", "month", "trip_count") == [("1", "2025-01", 2), ("1", "2025-06", 1), ("2", "2025-01", 1)]
    kpi = out["kpis"].first()
    assert kpi["trips_1"] == 2 and kpi["share_1_pct"] == pytest.approx(200 / 3) and kpi["speed_lead_mph"] is None


def test_vendor_report_of_nothing(frame):
    out = R.vendor_report(fact_rows(frame).limit(0), "2025-01-01", "2025-01-31")
    kpi = out["kpis"].first()
    assert kpi["trips_1"] == 0 and kpi["share_1_pct"] is None
    assert out["hourly"].count() == 0 and out["weekly"].count() == 14


def test_demand_map(frame):
    rows = [("a", datetime(2025, 1, 1, 8), 2.0), ("a", datetime(2025, 1, 2, 8), 4.0), ("b", datetime(2025, 1, 1, 8), 1.0), ("b", datetime(2025, 1, 1, 9), 50.0)]
    forecast = frame(rows, "pickup_cell string, timestamp_hour timestamp_ntz, predicted_total_pickups double")
    places = labels(frame, ("a", "N", "B"), ("c", "M", "B"))
    out = R.demand_map(forecast, places, 8, 1)
    assert pairs(out["levels"], "pickup_cell", "predicted_total_pickups", "demand_level") == [("a", 3.0, "Very High"), ("b", 1.0, "Medium")]
    assert pairs(out["without_forecast"], "pickup_cell") == [("c",)]
    assert pairs(out["top"], "location") == [("N, B",)]
    nothing = R.demand_map(forecast, places, 3)
    assert nothing["levels"].count() == 0 and nothing["without_forecast"].count() == 2 and nothing["kpis"].first()["row_count"] == 0
    assert R.recent_forecast(forecast, "2025-01-02 00:00:00", "1 day").count() == 3


def test_hot_cells(frame):
    demand = hours(frame, "c", ["2025-01-01 07:00:00", "2025-01-01 08:00:00", "2025-01-01 09:00:00"])
    assert pairs(R.hot_cells(demand), "total_pickups_forecast") == [(2,), (3,)]
    assert pairs(R.hot_cells(demand, k=1), "total_pickups_forecast") == [(3,)]
    assert R.hot_cells(demand, as_of="2026-01-01 00:00:00").count() == 0
