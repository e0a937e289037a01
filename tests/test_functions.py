import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from zonepulse.functions import geo, scalars as S, times as T


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_day_and_year_shifts_differ(value):
    assert value(T.shift_days(ts("2021-02-28 10:00:00"), 1462)) == datetime(2025, 3, 1, 10)
    assert value(T.shift_days(ts("2021-02-28 10:00:00"), 1461)) == datetime(2025, 2, 28, 10)
    assert value(T.shift_years(F.lit("2021-02-28").cast("date"), 4)) == date(2025, 2, 28)
    assert value(T.shift_years(F.lit("2020-02-29").cast("date"), 1)) == date(2021, 2, 28)


def test_seconds_truncate(value):
    assert value(T.seconds_between(ts("2025-01-01 00:00:00.9"), ts("2025-01-01 00:00:02.1"))) == 1
    assert value(T.seconds_between(ts("2025-01-01 00:01:00"), ts("2025-01-01 00:00:00"))) == -60


def test_calendar(value):
    assert value(T.dow(ts("2025-01-05 00:00:00"))) == 1
    assert value(T.is_weekend(ts("2025-01-04 00:00:00"))) is True
    assert value(T.date_id(F.lit("2025-01-04").cast("date"))) == "20250104"
    assert value(T.month_key(ts("2025-01-04 00:00:00"))) == "2025-01"
    assert value(T.day_name(ts("2025-01-04 00:00:00"))) == "Saturday"
    assert value(T.dow_name(F.lit(7))) == "Sat"
    assert value(T.hour_floor(ts("2025-12-31 23:59:59.999"))) == datetime(2025, 12, 31, 23)
    assert value(T.from_epoch(F.lit(0))) == datetime(1970, 1, 1)
    assert value(T.ago(ts("2025-03-01 01:00:00"), "24 hours")) == datetime(2025, 2, 28, 1)
    assert value(T.days_between(F.lit("2025-01-01").cast("date"), F.lit("2025-01-31").cast("date"))) == 30


def test_defaults(value):
    assert value(S.falsy_default(F.lit(""), "1")) == "1"
    assert value(S.falsy_default(F.lit(None).cast("string"), "1")) == "1"
    assert value(S.falsy_default(F.lit("2"), "1")) == "2"
    assert value(S.falsy_default(F.lit(0.0), 0.5, "number")) == 0.5
    assert value(S.missing_default(F.lit(""), "1")) == ""
    assert value(S.to_number(F.lit("abc"))) is None
    assert value(S.to_number(F.lit("4.5"))) == 4.5
    assert value(S.cast_to(F.lit("x"), "int", safe=True)) is None
    assert value(S.flag(F.lit(None).cast("string"))) is False
    assert value(S.flag(F.lit("1"))) is True


def test_conversions(value):
    assert value(S.f_to_c(F.lit(50.3))) == 10.17
    assert value(S.inch_to_mm(F.lit(0.1))) == 2.54
    assert value(S.round_to(F.lit(17.365), 2)) == 17.37
    assert value(S.round_to(F.lit(2.3449999), 2)) == 2.34
    assert value(S.round_to(F.lit(0.123456789), 8)) == 0.12345679
    assert value(S.speed_mph(F.lit(10.0), F.lit(1800))) == 20.0
    assert value(S.speed_mph(F.lit(10.0), F.lit(0))) is None
    assert value(S.pct(F.lit(2.0), F.lit(0.0))) == 0.0
    assert value(S.earnings(F.lit(1), F.lit(None).cast("int"))) is None
    assert value(S.safe_div(F.lit(1), F.lit(0))) is None
    assert value(S.rush_ratio(F.lit(None).cast("double"), F.lit(3.0), F.lit(None).cast("double"))) == 3.0
    assert value(S.rush_ratio(F.lit(1.0), F.lit(3.0), F.lit(0.0))) is None
    assert value(S.per_area(F.lit(737))) == pytest.approx(1000.0)


@pytest.mark.parametrize("days,score", [(0, 5), (1, 5), (2, 4), (3, 4), (4, 3), (7, 3), (8, 2), (14, 2), (15, 1)])
def test_recency_tiers(value, days, score):
    assert value(S.recency_score(F.lit(days))) == score


@pytest.mark.parametrize(
    "r,f,m,name",
    [(5, 5, 5, "Gold"), (4, 4, 3, "Silver"), (2, 3, 1, "Bronze"), (1, 3, 1, "Watch"), (2, 2, 3, "Watch"),
     (3, 2, 5, "Dead"), (1, 2, 2, "Dead")],
)
def test_segments(value, r, f, m, name):
    assert value(S.rfm_segment(F.lit(r), F.lit(f), F.lit(m))) == name


@pytest.mark.parametrize(
    "x,top,name", [(29, 100, "Low"), (30, 100, "Medium"), (50, 100, "High"), (70, 100, "Very High"), (0, 0, "No Demand")]
)
def test_demand_levels(value, x, top, name):
    assert value(S.demand_level(F.lit(x), F.lit(top))) == name


def test_marker_size(value):
    assert value(S.marker_size(F.lit(5), F.lit(0))) == 250.0
    assert value(S.marker_size(F.lit(5), F.lit(10))) == 425.0


@pytest.mark.parametrize("demand,factor", [(15, 1.0), (16, 1.2), (30, 1.2), (31, 1.8), (50, 1.8), (51, 2.5)])
def test_surge(value, demand, factor):
    assert value(S.surge(F.lit(demand))) == factor


@pytest.mark.parametrize("hour,flag", [(6, 0), (7, 1), (9, 1), (10, 0), (17, 1), (19, 1), (20, 0)])
def test_rain_in_rush_hour(value, hour, flag):
    assert value(S.band_flag(F.lit(True), F.lit(hour))) == flag
    assert value(S.band_flag(F.lit(None).cast("boolean"), F.lit(hour))) == 0


def test_night_band_is_empty_unless_wrapped(value):
    assert [h for h in range(24) if value(S.in_band(F.lit(h), (22, 4)))] == []
    assert [h for h in range(24) if value(S.in_band(F.lit(h), (22, 4), wrap=True))] == [0, 1, 2, 3, 4, 22, 23]


def test_words(value):
    assert value(S.has_word(F.lit("Light Rain"), "rain")) is True
    assert value(S.has_word(F.lit(None).cast("string"), "rain")) is False
    assert value(S.in_words(F.lit("Haze"), ("mist", "haze"))) is True
    assert value(S.json_field(F.lit('{"rain":{"1h":2.5}}'), "$.rain.1h", "double")) == 2.5


def test_lookup_and_labels(value):
    assert value(S.lookup(F.lit("3"), {"1": "a"})) is None
    assert value(S.place_label(F.lit("SoHo"), F.lit("Manhattan"))) == "SoHo, Manhattan"
    assert value(S.place_label(F.lit(None).cast("string"), F.lit("x"))) == "Unknown Location"


def test_surrogate_key_marks_nulls(value):
    import hashlib

    key = S.surrogate_key(S.stamp_text(ts("2025-01-01 07:30:00")), F.lit(None).cast("string"), S.number_text(F.lit("12.5000").cast("decimal(18,4)")))
    text = "2025-01-01 07:30:00+00-_dbt_utils_surrogate_key_null_-12.5"
    assert value(key) == hashlib.md5(text.encode()).hexdigest()
    assert value(S.number_text(F.lit("100").cast("decimal(18,4)"))) == "100"


def test_messages_roundtrip(frame):
    text = "ä" * 100
    rows = frame([(text, 1), (None, 2)], "t string, n int").select(S.encode_message("t", "n").alias("value"))
    back = [r["x"] for r in rows.select(S.decode_text("value").alias("x")).collect()]
    assert back == ['{"t":"%s","n":1}' % text, '{"n":2}']
    assert "\n" not in rows.first()["value"]
    odd = frame([("%%%",), ("/w==",), (None,), ("",)], "value string")
    assert [r["x"] for r in odd.select(S.decode_text("value").alias("x")).collect()] == [None, None, None, ""]


def test_jitter_stays_in_band(spark):
    df = spark.range(1000).select("id", S.jitter(F.lit(100.0), 0.1, 7, ["id"]).alias("x"))
    low, high, mean = df.agg(F.min("x"), F.max("x"), F.avg("x")).first()
    assert 90 <= low < 92 and 108 < high < 110 and abs(mean - 100) < 1
    other = spark.range(1000).repartition(3).select("id", S.jitter(F.lit(100.0), 0.1, 7, ["id"]).alias("x"))
    assert df.exceptAll(other).count() == 0


# --- places -------------------------------------------------------------------------------

def test_cell_roundtrip(value):
    cell = geo.cell_id(F.lit(-73.9661), F.lit(40.7694))
    assert value(cell) == "h3_res8_-73966_40769"
    assert value(geo.cell_lon(cell)) == -73.966
    assert value(geo.cell_lat(cell)) == 40.769


@pytest.mark.parametrize("bad", ["h3_res9_-73966_40769", "h3_res8_1_2_3", "h3_res8_a_2", "h3_res8_1", "", "8a2a1072b59ffff"])
def test_malformed_cells_are_null(value, bad):
    assert value(geo.cell_lon(F.lit(bad))) is None
    assert value(geo.cell_lat(F.lit(bad))) is None


def test_coarse_cells(value):
    assert value(geo.coarse_cell(F.lit("h3_res8_-73966_40769"), 50)) == "h3_res8x50_-74000_40750"


RINGS = {
    "square": ([(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)], (1, 1)),
    "clockwise": ([(0, 0), (0, 2), (2, 2), (2, 0), (0, 0)], (1, 1)),
    "triangle": ([(0, 0), (3, 0), (0, 3), (0, 0)], (1, 1)),
    "L": ([(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2), (0, 0)], (5 / 6, 5 / 6)),
    "line": ([(0, 0), (2, 0), (0, 0)], (1, 0)),
    "far away": ([(-74.002, 40.598), (-73.998, 40.598), (-73.998, 40.602), (-74.002, 40.602), (-74.002, 40.598)], (-74, 40.6)),
}


@pytest.mark.parametrize("name", RINGS)
def test_centroids(frame, name):
    ring, (x, y) = RINGS[name]
    df = frame([([(float(a), float(b)) for a, b in ring],)], "ring array<struct<x:double,y:double>>")
    got = df.select(geo.centroid_x("ring"), geo.centroid_y("ring")).first()
    assert got[0] == pytest.approx(x, abs=1e-9) and got[1] == pytest.approx(y, abs=1e-9)


def test_distances(value):
    miles = lambda *p: value(geo.haversine_miles(*[F.lit(float(v)) for v in p]))
    assert miles(40.7, -74, 40.7, -74) == 0.0
    assert miles(0, 0, 0, 180) == pytest.approx(math.pi * 3959)
    assert miles(40.0, -74, 40.0 + 1 / 69.1, -74) == pytest.approx(1.0, abs=0.01)
    assert value(geo.est_seconds(F.lit(5.0))) == 1800.0
    assert value(geo.rule_fare(F.lit(0.1))) == 5.0
    assert value(geo.rule_fare(F.lit(4.0))) == 13.0


# --- polygons with holes ------------------------------------------------------------------

def shapes(spark, *texts):
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string").withColumn("r", geo.rings_of("t"))
    return rows.select("n", "r", geo.area_of("r").alias("area"), geo.centre_of("r").alias("c")).orderBy("n").collect()


def test_rings_of_polygon_texts(spark):
    got = shapes(
        spark, "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))", "polygon((0 0,0 4,4 4,4 0,0 0))", " POLYGON Z ((0 0 9, 4 0 9, 4 4 9, 0 4 9, 0 0 9)) ",
        "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (2 1, 2 3, 4 3, 4 1, 2 1))",
        "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)), ((10 0, 10 1, 11 1, 11 0, 10 0), (10.25 0.25, 10.25 0.75, 10.75 0.75, 10.75 0.25, 10.25 0.25)))",
        "POLYGON ((1 1, 1 1, 1 1))", "POINT (1 2)", "", None, "POLYGON EMPTY", "POLYGON ((a b, 4 0, 4 4, 0 0))",
    )
    for r in got[:3]:
        assert [(x["hole"], len(x["points"])) for x in r["r"]] == [(False, 5)]
        assert r["area"] == 16.0 and tuple(r["c"]) == (2.0, 2.0)
    assert [x["hole"] for x in got[3]["r"]] == [False, True]
    assert got[3]["area"] == 12.0 and got[3]["c"]["x"] == pytest.approx((16 * 2 - 4 * 3) / 12) and got[3]["c"]["y"] == pytest.approx(2.0)
    assert [x["hole"] for x in got[4]["r"]] == [False, False, True] and got[4]["area"] == pytest.approx(4.75)
    assert got[4]["c"]["x"] == pytest.approx((4 * 1 + 0.75 * 10.5) / 4.75) and got[4]["c"]["y"] == pytest.approx((4 * 1 + 0.75 * 0.5) / 4.75)
    assert got[5]["area"] == 0.0 and tuple(got[5]["c"]) == (1.0, 1.0)
    assert all(r["r"] is None and r["area"] is None and r["c"] is None for r in got[6:10])
    assert got[10]["r"][0]["points"][0]["x"] is None


def test_draws_are_the_same_in_any_engine(spark):
    import hashlib

    df = spark.range(50).select("id", S.draw(7, "id", F.when(F.col("id") > 3, F.lit("k"))).alias("d"), S.uniform(7, "id").alias("u"))
    for r in df.collect():
        text = f"7|{r['id']}|{'k' if r['id'] > 3 else ''}"
        assert r["d"] == int(hashlib.md5(text.encode()).hexdigest()[:15], 16)
        assert 0 <= r["u"] < 1
