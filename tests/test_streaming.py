import base64
import json
from datetime import datetime

from pyspark.sql import functions as F

from zonepulse import catalog
from zonepulse.plans.warehouse import open_warehouse
from zonepulse.sources import sinks as K, tables as TB
from zonepulse.streaming import ingest as I

GOOD = {
    "vendor_id": "1", "pickup_datetime": "2025-01-01T10:00:00", "dropoff_datetime": "2025-01-01T10:20:00",
    "passenger_count": 2, "trip_distance": 3, "pickup_location_id": "7", "dropoff_location_id": "8",
    "fare_amount": 10.5, "total_amount": 12.0,
}


def encoded(*docs):
    texts = [d if isinstance(d, str) else json.dumps(d) for d in docs]
    return [(base64.b64encode(t.encode()).decode(),) for t in texts]


def messages():
    lacking = {k: v for k, v in GOOD.items() if k != "fare_amount"}
    rows = encoded(
        GOOD, {**GOOD, "rate_code": "", "extra": 0, "tip_amount": 2.5}, {**GOOD, "vendor_id": 2},
        lacking, {**GOOD, "pickup_datetime": "soon"}, {**GOOD, "passenger_count": "many"}, json.dumps(GOOD)[:50], "",
    )
    return rows + [("***",), (None,)]


def test_trip_messages(frame):
    df = frame(messages(), "value string")
    good = I.ingest_trips(df, as_of="2025-02-01 00:00:00").collect()
    assert len(good) == 3
    assert good[0]["pickup_datetime"] == datetime(2025, 1, 1, 10) and good[0]["trip_distance"] == 3.0
    assert (good[0]["rate_code"], good[0]["extra"]) == ("1", 0.0)
    # A present empty text is kept here; only a missing one is filled.
    assert (good[1]["rate_code"], good[1]["tip_amount"]) == ("", 2.5)
    assert good[2]["vendor_id"] == "2" and good[2]["processing_timestamp"] == datetime(2025, 2, 1)
    kept, bad = I.split_bad(I.parse_trips(df))
    assert kept.count() == 3 and bad.count() == 7


def test_raw_documents(frame):
    df = frame(encoded('{"a":1}', "broken{", "") + [("***",)], "value string")
    out = I.ingest_raw_json(df, as_of="2025-02-01 00:00:00").collect()
    assert [(r["raw_json"], r["inserted_at"]) for r in out] == [('{"a":1}', datetime(2025, 2, 1))]


def test_stream_lands_like_the_batch(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(messages(), "value string").write.parquet(source)
    stream = TB.read_stream(spark, source, "value string")
    I.land(I.ingest_trips(stream, as_of="2025-02-01 00:00:00"), table, str(tmp_path / "cp")).awaitTermination()
    # A second batch of files is picked up by a restarted query; the first is not read again.
    spark.createDataFrame(encoded(GOOD), "value string").write.mode("append").parquet(source)
    I.land(I.ingest_trips(stream, as_of="2025-02-01 00:00:00"), table, str(tmp_path / "cp")).awaitTermination()
    landed = spark.read.parquet(table)
    assert landed.count() == 4 and landed.where("event_day = '2025-01-01'").count() == 4


def test_replay(spark, frame):
    rows = []
    for i in range(20):
        rows.append((str(i), datetime(2021, 1, 1, 10, i), datetime(2021, 1, 1, 11), 1, 1.0, "1", "2", "" if i else None, "0", 5.0, None, 0.5, 0.0, 0.0, 0.3, 0.0, 6.0))
    rows.append(("late", datetime(2021, 1, 2), datetime(2021, 1, 2), 1, 1.0, "1", "2", "1", "1", 5.0, 0.0, 0.5, 0.0, 0.0, 0.3, 0.0, 6.0))
    trips = frame(rows, TB.TRIP_SCHEMA)
    batch = I.replay_batch(trips, "2025-01-01", 5, 1461, 1462, 3, ["vendor_id"])
    back = I.ingest_trips(batch).collect()
    assert len(back) == 5 and {r["rate_code"] for r in back} == {"1"} and {r["payment_type"] for r in back} == {"0"}
    assert {r["pickup_datetime"].date().isoformat() for r in back} == {"2025-01-02"}
    assert {r["extra"] for r in back} == {0.0}
    again = I.ingest_trips(I.replay_batch(trips, "2025-01-01", 5, 1461, 1462, 3, ["vendor_id"])).collect()
    assert sorted(r["vendor_id"] for r in again) == sorted(r["vendor_id"] for r in back)
    assert I.replay_batch(trips, "2025-01-01", 500, 1461, 1462, 3, ["vendor_id"]).count() == 20


def test_replay_of_a_whole_day(spark):
    w = open_warehouse(spark, "/root/testdata/sf0.01")
    trips = catalog.raw_event_trips(w)
    of_day = trips.where("to_date(pickup_datetime) = date'2024-01-11' AND trip_distance > 0 AND passenger_count > 0 AND total_amount > 0")
    of_day = of_day.where("pickup_location_id IS NOT NULL AND dropoff_location_id IS NOT NULL")
    assert catalog.replay_rows(w).count() == of_day.count() > 100
    assert I.replay_batch(trips, "2028-01-11", None, 1461, 1462, 3, ["event_id"]).count() == of_day.count()


def test_window_summary_equals_batch(spark):
    folder = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{folder}/events.parquet")
    stream = TB.read_stream(spark, f"{folder}/event[s].parquet", events.schema)
    live = I.drain_updates(I.zone_activity(stream, "ts", "event_type", "value"), "t", ["window_start", "event_type"])
    batch = events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("window_start"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    assert live.select(batch.columns).exceptAll(batch).count() == 0 and live.count() == batch.count()
    slid = I.zone_activity(events, "ts", "event_type", "value", "1 hour", "30 minutes")
    assert slid.agg(F.sum("n")).first()[0] == 2 * events.count()


def test_updates_keep_the_newest_state(spark, tmp_path):
    source, path, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    schema = "zone string, kind string"
    for kinds in (["start", "start"], ["end", "start"]):
        spark.createDataFrame([("a", k) for k in kinds], schema).write.mode("append").parquet(source)
        active = I.active_trips(TB.read_stream(spark, source, schema), "zone", "kind", ["start"], ["end"])
        I.write_updates(active, path, cp).awaitTermination()
    assert [tuple(r) for r in I.latest_updates(spark, path, ["zone"]).collect()] == [("a", 2)]


def test_feed_is_newest_first(frame):
    df = frame([(datetime(2025, 1, 1, 0, m),) for m in (0, 5, 7, 10)], "t timestamp_ntz")
    assert [r["t"].minute for r in I.recent_feed(df, "t").collect()] == [10, 7, 5]


def test_messages_are_single_lines(spark, tmp_path):
    rows = spark.range(3).select(F.repeat(F.lit("x"), 500).alias("t"), "id")
    K.to_messages(rows).write.text(str(tmp_path / "m"))
    assert spark.read.text(str(tmp_path / "m")).count() == 3
