from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from zonepulse.operators.aggregates import net_balance
from zonepulse.sources import tables as TB
from zonepulse.sources.snapshots import SnapshotTable
from zonepulse.streaming import stateful as ST

START = datetime(2024, 1, 1)
EVENTS = "zone string, kind string, at timestamp_ntz, value double"


def arrive(spark, folder, rows, schema=EVENTS):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def at(hours):
    return START + timedelta(hours=hours)


def test_balances_leave_the_state_at_zero(spark, tmp_path):
    source, path, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    batches = [
        [("a", "start"), ("a", "start"), ("b", "start"), (None, "start"), ("e", "other")],
        [("a", "end"), ("c", "start"), ("b", "end")],
        [("a", "end"), ("d", "end")],
        [("b", "start"), ("b", "start"), ("d", "start")],
        [("c", "end"), ("c", "start")],
    ]
    everything = []
    for rows in batches:
        rows = [(z, k, START, 1.0) for z, k in rows]
        everything += rows
        arrive(spark, source, rows)
        stream = TB.read_stream(spark, source, EVENTS)
        balance = ST.running_balance(stream, "zone", "kind", ["start"], ["end"])
        ST.write_latest(balance, path, cp, ["zone"], ended=F.col("active") == 0, compact_every=2).awaitTermination()
        # After every batch: the newest rows are the batch result, the state holds open keys only.
        want = {r["zone"]: r["active"] for r in net_balance(spark.createDataFrame(everything, EVENTS), "zone", "kind", ["start"], ["end"]).collect() if r["active"]}
        assert {r["zone"]: r["active"] for r in ST.latest(spark, path, ["zone"]).collect() if r["active"]} == want
        assert {r["zone"]: r["n"] for r in ST.stored_balances(spark, cp).collect()} == want
    # Batches 0 to 3 were rewritten as one row per open key; one more batch came after.
    assert len(SnapshotTable(spark, path).current()["folders"]) == 2
    assert SnapshotTable(spark, path).read().count() == 4


def test_idle_keys_expire(spark, tmp_path):
    source, path, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for rows in ([("a", "start", at(0), 1.0), ("b", "start", at(1), 1.0)], [("b", "start", at(9), 1.0)], [("c", "start", at(20), 1.0)], [("c", "other", at(20), 1.0)]):
        arrive(spark, source, rows)
        stream = TB.read_stream(spark, source, EVENTS)
        balance = ST.running_balance(stream, "zone", "kind", ["start"], ["end"], ts="at", idle="6 hours", delay="1 hour")
        ST.write_latest(balance, path, cp, ["zone"]).awaitTermination()
    got = {r["zone"]: (r["active"], r["expired"]) for r in ST.latest(spark, path, ["zone"]).collect()}
    assert got == {"a": (0, True), "b": (0, True), "c": (1, False)}
    assert {r["zone"]: r["n"] for r in ST.stored_balances(spark, cp).collect()} == {"c": 1}


def windows_by_hand(batches, delay=2, width=1):
    """Summed and late rows per (hour, zone), from the definition."""
    on_time, late, newest = Counter(), Counter(), None
    for rows in batches:
        edge = newest - timedelta(hours=delay) if newest else None
        for zone, _, t, _ in rows:
            if t is not None:
                hour = t.replace(minute=0, second=0)
                (late if edge and hour + timedelta(hours=width) <= edge else on_time)[hour, zone] += 1
        newest = max([t for *_, t, _ in rows if t is not None] + ([newest] if newest else []), default=None)
    return on_time, late


def test_windows_lose_nothing(spark, tmp_path):
    source, path, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    batches = [
        [("a", "x", at(0.5), 1.0), ("a", "x", at(5.2), 2.0), ("b", "x", at(3), None)],
        [("a", "x", at(0.7), 4.0), ("a", "x", at(5.5), 8.0), ("b", "x", at(2.5), 1.0), ("c", "x", None, 3.0)],
        [("a", "x", at(30), 1.0)],
        [],
        [("a", "x", at(5.1), 5.0), ("b", "x", at(28.5), 1.0), (None, "x", at(29), 1.0)],
    ]
    for rows in batches:
        arrive(spark, source, rows)
        ST.summarize_windows(TB.read_stream(spark, source, EVENTS), path, cp, "at", "zone", "value", compact_every=2).awaitTermination()
    on_time, late = windows_by_hand([b for b in batches if b])
    got = ST.window_summary(spark, path, "zone", "value").collect()
    assert {(r["window_start"], r["zone"]): r["n"] for r in got if r["n"]} == dict(on_time)
    assert {(r["window_start"], r["zone"]): r["n_late"] for r in got if r["n_late"]} == dict(late)
    whole = ST.window_summary(spark, path, "zone", "value", with_late=True)
    rows = [r for b in batches for r in b if r[2]]
    want = spark.createDataFrame(rows, EVENTS).groupBy(F.date_trunc("hour", "at").cast("timestamp_ntz").alias("window_start"), "zone").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("avg_value")
    )
    assert Counter(map(tuple, whole.drop("n_late").collect())) == Counter(map(tuple, want.collect()))
    kept = ST.late_rows(spark, path)
    assert kept.count() == sum(late.values()) + 1 and kept.where("at IS NULL").first()["value"] == 3.0


def test_sliding_windows_lose_nothing(spark, tmp_path):
    source, path, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    batches = [[("a", "x", at(6), 1.0)], [("a", "x", at(3.2), 1.0), ("a", "x", at(3.7), 1.0)]]
    for rows in batches:
        arrive(spark, source, rows)
        stream = TB.read_stream(spark, source, EVENTS)
        ST.summarize_windows(stream, path, cp, "at", "zone", "value", "2 hours", "1 hour", "1 hour").awaitTermination()
    got = {r["window_start"].hour: (r["n"], r["n_late"]) for r in ST.window_summary(spark, path, "zone", "value").collect()}
    # Windows that end by 05:00 are closed: 02:00 to 04:00, and 03:00 to 05:00.
    assert got == {2: (0, 2), 3: (0, 2), 5: (1, 0), 6: (1, 0)}


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    arrive(spark, source, [("a", "x", at(1), 1.0), ("a", "x", at(9), 1.0)])
    for cp in ("cp1", "cp2"):
        # A lost checkpoint starts again with batch 0, which the table already has.
        ST.summarize_windows(TB.read_stream(spark, source, EVENTS), path, str(tmp_path / cp), "at", "zone", "value").awaitTermination()
    assert ST.window_summary(spark, path, "zone", "value").agg(F.sum("n")).first()[0] == 2


def test_landing_keeps_few_files_a_day(spark, tmp_path):
    source, path, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for n in range(6):
        rows = [(f"z{i}", "x", at(24 * (i % 3)), float(n)) for i in range(300)]
        spark.createDataFrame(rows, EVENTS).repartition(8).write.mode("append").parquet(source)
        ST.land_daily(TB.read_stream(spark, source, EVENTS), path, cp, "at", compact_every=3, most=2).awaitTermination()
    table = SnapshotTable(spark, path, ["event_day"])
    assert table.read().count() == 1800 and ST.landed(spark, path).where("event_day = '2024-01-02'").count() == 600
    named = Counter(f.split("/")[0] for f in table.current()["folders"])
    assert set(named.values()) == {1} and len(named) == 3
    table.clean_up()
    assert len(table.folders()) == 3 and table.read().count() == 1800
