from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonepulse.plans import models as M
from zonepulse.plans.store import ModelStore
from zonepulse.session import stash

FEATURES = ("pickup_cell string, timestamp_hour timestamp_ntz, total_pickups long, had_rain boolean, is_weekend boolean, "
            "is_holiday boolean, avg_temp_celsius double, pickups_24h_ago long, hour_of_day int")


def table(spark, n=700):
    rows = []
    for i in range(n):
        t = datetime(2025, 1, 1) + timedelta(hours=i // 2)
        cell = "ab"[i % 2]
        rows.append((cell, t, (t.hour + 1) * (3 if cell == "a" else 1), None, t.isoweekday() > 5, False, 10.0 if i % 5 else None, i if i > 50 else None, t.hour))
    return stash(spark.createDataFrame(rows, FEATURES))


@pytest.fixture(scope="module")
def trained(spark):
    df = table(spark)
    cols = ["pickup_cell", "hour_of_day", "had_rain", "is_weekend", "avg_temp_celsius"]
    return df, M.train_demand(df, 1, ["pickups_24h_ago"], cols, iterations=10)


def test_model_learns_and_survives_unknown_cells(trained, spark, tmp_path):
    df, model = trained
    scored = M.predict(model, df)
    assert scored.columns == df.columns + ["predicted_total_pickups"]
    error = scored.agg(F.avg(F.abs(F.col("predicted_total_pickups") - F.col("total_pickups")))).first()[0]
    assert error < 3
    strange = M.predict(model, df.limit(3).withColumn("pickup_cell", F.lit("zzz")))
    assert strange.where("predicted_total_pickups is not null").count() == 3
    model.write().overwrite().save(str(tmp_path / "m"))
    from pyspark.ml import PipelineModel

    again = M.predict(PipelineModel.load(str(tmp_path / "m")), df)
    assert again.exceptAll(scored).count() == 0


def test_categories_are_encoded_by_target_or_by_name(spark):
    df = spark.range(2000).select("id", (F.col("id") % 40).cast("string").alias("c"), (F.col("id") % 40 * 2.0).alias("y"))
    for named in ((), ("c",)):
        model = M.train_trees(df, "y", ["c"], 1, 20, keys=["id"], categorical=named)
        worst = M.predict(model, df).agg(F.max(F.abs(F.col("y") - F.col("predicted_y")))).first()[0]
        assert worst < 10
        strange = df.limit(2).withColumn("c", F.when(F.col("id") == 0, F.lit("new")))
        assert M.predict(model, strange).where("predicted_y IS NOT NULL").count() == 2


def test_small_sets_train_without_held_out_rows(spark):
    df = spark.range(4).select("id", F.col("id").cast("string").alias("c"), (F.col("id") * 1.0).alias("y"))
    model = M.train_trees(df, "y", ["c"], 1, 3, keys=["id"], share_held_out=0.0)
    assert M.predict(model, df).where("predicted_y IS NOT NULL").count() == 4


def test_fold_means_leave_out_a_rows_own_part(spark):
    df = spark.range(600).select("id", F.when(F.col("id") % 7 > 0, (F.col("id") % 3).cast("string")).alias("c"), (F.col("id") % 10).alias("y"))
    split = M.hold_out(df, 0.2, 4, ["id"])
    rows = M.fold_means(split, "c", "y", "m", 4, ["id"]).collect()
    assert len(rows) == 600 and {r["__fold"] for r in rows} == {-1, 0, 1, 2, 3, 4}
    train = [r for r in rows if not r["is_validation"]]
    for r in rows:
        assert r["is_validation"] == (r["__fold"] == -1)
        others = [x for x in train if x["__fold"] != r["__fold"]]
        mine = [x["y"] for x in others if x["c"] == r["c"] and r["c"] is not None]
        overall = sum(x["y"] for x in others) / len(others)
        assert r["m"] == pytest.approx((sum(mine) + M.SMOOTHING * overall) / (len(mine) + M.SMOOTHING))


def test_held_out_share_is_the_same_at_any_size(spark):
    for n in (300, 5000, 100_000):
        df = M.hold_out(spark.range(n), 0.1, 1, ["id"])
        assert df.where("is_validation").count() == pytest.approx(n * 0.1, abs=4 * (n * 0.09) ** 0.5)
        again = M.hold_out(spark.range(n).repartition(5), 0.1, 1, ["id"])
        assert df.exceptAll(again).count() == 0


def test_model_store_keeps_the_old_model_until_the_new_one_is_whole(spark, tmp_path, monkeypatch):
    df = spark.range(200).select("id", (F.col("id") % 5 * 2.0).alias("x"), (F.col("id") % 5 * 3.0).alias("y"))
    store = ModelStore(spark, str(tmp_path / "models"))
    with pytest.raises(ValueError):
        store.load("m")
    first = M.train_trees(df, "y", ["x"], 1, 2, keys=["id"])
    store.save("m", first, rows=200)
    want = M.predict(first, df).collect()
    assert M.predict(store.load("m"), df).collect() == want and store.facts("m") == {"rows": 200, "version": 0}

    class Broken:
        def write(self):
            raise RuntimeError("stop")

    with pytest.raises(RuntimeError):
        store.save("m", Broken())
    assert M.predict(store.load("m"), df).collect() == want
    store.save("m", M.train_trees(df.withColumn("y", F.col("y") + 1), "y", ["x"], 1, 2, keys=["id"]), rows=1)
    assert store.facts("m") == {"rows": 1, "version": 1} and M.predict(store.load("m", 0), df).collect() == want
    assert store.clean_up("m", keep=1) == 1
    assert M.predict(store.load("m"), df).collect() != want


def test_no_rows_to_train_on(spark):
    with pytest.raises(ValueError):
        M.train_trees(spark.range(0).select("id", F.lit(1).alias("y")), "y", ["id"], 1)


def test_forecast_reaches_all_hours_alike(trained):
    df, model = trained
    out = M.build_forecast(df, model)
    last = df.agg(F.max("timestamp_hour")).first()[0]
    recent = df.where(F.col("timestamp_hour") >= F.lit(last - timedelta(hours=24)))
    want = df.alias("f").join(
        recent.alias("r"),
        (F.col("f.pickup_cell") == F.col("r.pickup_cell"))
        & (F.hour("f.timestamp_hour") == F.hour("r.timestamp_hour"))
        & (F.dayofweek("f.timestamp_hour") == F.dayofweek("r.timestamp_hour")),
    ).count()
    assert out.count() == want > recent.count()
    exact = M.build_forecast(df, model, on=("pickup_cell", "timestamp_hour"))
    assert exact.count() == recent.count()
    assert M.build_forecast(df, model, as_of="2030-01-01 00:00:00").count() == 0


def test_quotes(trained, spark):
    df, model = trained
    requests = spark.createDataFrame(
        [(1, 40.7, -74.0, 40.7, -74.0, datetime(2025, 1, 5, 9)), (2, 40.7, -74.0, 40.8, -73.9, datetime(2025, 1, 6, 9))],
        "request_id int, pickup_lat double, pickup_lon double, dropoff_lat double, dropoff_lon double, requested_at timestamp_ntz",
    )
    conditions = spark.createDataFrame([(12.345,)], "temperature_celsius double")
    forecast = spark.createDataFrame(
        [("h3_res8_-74000_40700", datetime(2025, 1, 6), 20.6), ("h3_res8_-74000_40700", datetime(2024, 1, 6), 99.0)],
        "pickup_cell string, timestamp_hour timestamp_ntz, predicted_total_pickups double",
    )
    rows = M.quote_features(requests, conditions, forecast).orderBy("request_id").collect()
    assert rows[0]["trip_distance"] == 0.0 and rows[0]["historical_demand"] == 21 and rows[0]["day_of_week"] == 1
    assert rows[0]["avg_temp_celsius"] == 12.35 and rows[0]["is_weekend"] is True and rows[1]["is_weekend"] is False
    assert rows[1]["trip_duration_seconds"] == pytest.approx(rows[1]["trip_distance"] * 360, abs=3)
    bare = M.quote_features(requests, conditions.limit(0), forecast.limit(0)).first()
    assert bare["historical_demand"] == 10 and bare["avg_temp_celsius"] == 20.0


def test_horizon(spark):
    demand = table(spark, 400).select("pickup_cell", "timestamp_hour", "total_pickups")
    out = M.forecast_horizon(demand, 24)
    assert out.count() == 48 and out.where("predicted_pickups is null").count() == 0
    assert out.agg(F.min("timestamp_hour")).first()[0] == datetime(2025, 1, 9, 8)
    row = out.where("pickup_cell = 'a' and hour_of_day = 10").first()
    assert row["predicted_pickups"] == 33.0


def zones(spark, n=40):
    rng = np.random.default_rng(5)
    rows = [(f"c{i}", f"z{i}", "b", int(v * 100), float(v), float(v * 2), float(r), 1.0, 2, 1.0, 1.0, 0.0)
            for i, (v, r) in enumerate(zip(rng.uniform(1, 50, n), rng.uniform(0.5, 2, n)))]
    cols = ("pickup_cell string, zone_name string, borough string, total_trips long, avg_hourly_demand double, trips_per_km2 double, "
            "weekend_ratio double, stddev_hourly_demand double, peak_hourly_demand long, morning_rush_demand double, "
            "evening_rush_demand double, night_demand double")
    return spark.createDataFrame(rows, cols)


def test_components_match_numpy(spark):
    df = zones(spark)
    scored, model = M.pca_scores(df)
    x = np.array([[r[c] for c in M.PCA_FEATURES] for r in df.orderBy("pickup_cell").collect()], dtype=float)
    z = (x - x.mean(0)) / x.std(0)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    want = z @ vectors[:, -1]
    if np.corrcoef(want, x[:, 0])[0, 1] < 0:
        want = -want
    got = np.array([r["PC1"] for r in scored.orderBy("pickup_cell").collect()])
    assert np.allclose(got, want, atol=1e-8)
    ratios = [r["explained_ratio"] for r in M.pca_explained(model, df).collect()]
    assert np.allclose(ratios, (values / values.sum())[::-1][:2])


def test_cluster_report(spark):
    out = M.pca_report(zones(spark), restarts=3)
    rows = out["zones"].collect()
    assert min(r["demand_score"] for r in rows) == 0.0 and max(r["demand_score"] for r in rows) == 100.0
    assert {r["cluster_name"] for r in rows} <= set(("High Demand", "Medium Demand", "Low Demand", "Night Shift"))
    by_name = {r["cluster_name"]: r["avg_demand_score"] for r in out["stats"].collect()}
    assert by_name["High Demand"] == max(by_name.values()) and sum(r["zones"] for r in out["stats"].collect()) == 40
    assert out["loadings"].count() == 8 and out["top"].count() <= 20
    assert out["summary"].first()["zones"] == 40
    checks = out["checks"].collect()
    assert len(checks) == 7 and all(r["violations"] == 0 for r in checks)


def test_checks_of_components_and_clusters_find_faults(spark):
    scored, model = M.pca_scores(zones(spark))
    wrong = scored.withColumn("PC2", F.col("PC2") + F.col("PC1"))
    bad = {r["check_name"] for r in M.check_components(wrong, model, M.PCA_FEATURES).collect() if r["violations"]}
    assert bad == {"PC2 is an eigenvector", "components do not correlate"}
    rows, fitted = M.cluster(scored, ["PC1", "PC2"], 4, 3)
    moved = rows.withColumn("cluster", (F.col("cluster") + 1) % 4)
    assert {r["check_name"]: r["violations"] for r in M.check_clusters(moved, fitted, ["PC1", "PC2"]).collect()}["zones nearer to another centre"] == 40
    worse = sorted(fitted, key=lambda m: -m.summary.trainingCost)
    if worse[0].summary.trainingCost > worse[-1].summary.trainingCost * 1.01:
        assert M.check_clusters(rows, worse, ["PC1", "PC2"]).where("check_name = 'starts with less cost'").first()["violations"] > 0


def test_clusters_with_few_zones_and_a_constant(spark):
    df = zones(spark, 3).withColumn("weekend_ratio", F.lit(1.0))
    out = M.pca_report(df, restarts=2)
    assert out["zones"].count() == 3 and out["zones"].where("cluster_name is null").count() == 0
    gaps = zones(spark, 5).withColumn("weekend_ratio", F.when(F.col("zone_name") != "z0", F.col("weekend_ratio")))
    assert M.pca_scores(gaps)[0].count() == 4


