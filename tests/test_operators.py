import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F
from pyspark.sql.types import StructType

from zonepulse.session import stash_observed
from zonepulse.operators import aggregates as A, joins as J, ordering as O, prep as P, quality as Q, windows as W


def pairs(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# --- filters ------------------------------------------------------------------------------

def test_quality_filters(frame):
    rows = [(1, 1.0, 1, 5.0, "1"), (2, 0.0, 1, 5.0, "1"), (3, 1.0, None, 5.0, "1"), (4, 1.0, 1, -1.0, "1"),
            (5, 1.0, 1, 5.0, ""), (6, 1.0, 1, 5.0, None)]
    df = P.require_positive(frame(rows, "id int, d double, p long, t double, z string"), ["d", "p", "t"])
    assert pairs(df, "id") == [(1,), (5,), (6,)]
    assert pairs(P.require_present(df, ["z"]), "id") == [(1,)]
    assert pairs(P.require_present(df, ["z"], allow_empty=True), "id") == [(1,), (5,)]
    assert pairs(P.where_not(df, "z", "1"), "id") == [(5,)]
    assert pairs(P.in_ranges(frame(rows, "id int, d double, p long, t double, z string"), {"t": (0, 5.5)}), "id") == [(1,), (2,), (3,), (5,), (6,)]


def test_presence_of_numbers(frame):
    assert P.require_present(frame([(1,), (None,)], "id long"), ["id"]).count() == 1


def stamps(frame):
    times = ["2024-12-31 23:59:59", "2025-01-01 00:00:00", "2025-01-02 23:59:59.5", "2025-01-03 00:00:00", "2025-12-31 23:00:00"]
    rows = [(i, datetime.fromisoformat(t)) for i, t in enumerate(times)]
    return frame(rows, "id int, t timestamp_ntz")


def test_time_filters(frame):
    df = stamps(frame)
    assert pairs(P.time_range(df, "t", "2025-01-01", "2025-01-03"), "id") == [(1,), (2,)]
    assert pairs(P.date_between(df, "t", "2025-01-01", "2025-01-02"), "id") == [(1,), (2,)]
    assert pairs(P.same_year(df, "t", "2025-06-01"), "id") == [(1,), (2,), (3,), (4,)]
    assert pairs(P.last_interval(df, "t", "24 hours"), "id") == [(4,)]
    assert pairs(P.last_interval(df, "t", "2 days", "2025-01-03 00:00:00"), "id") == [(1,), (2,), (3,), (4,)]
    assert pairs(P.last_interval(df, "t", "2 days", "2025-01-03 00:00:00", upper=True), "id") == [(1,), (2,), (3,)]
    assert P.skip_warmup(df, "t").count() == 5
    assert pairs(P.skip_warmup(df, "t", 24), "id") == [(2,), (3,), (4,)]


def test_date_between_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = P.date_between(df, "o_orderdate", "1996-01-01", "1996-12-31")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_preview_distinct_union(frame):
    df = frame([(1, "b"), (2, "a"), (3, "a")], "id int, k string")
    assert P.preview(df, ["k"], 2).count() == 2
    with pytest.raises(Exception):
        P.preview(df, ["missing"], 2).count()
    assert [r["k"] for r in P.distinct_values(df, ["k"], ordered=True).collect()] == ["a", "b"]
    assert P.union_all(df, df).count() == 6


# --- joins --------------------------------------------------------------------------------

def test_date_join_fans_out_on_repeated_days(frame):
    facts = frame([(1, datetime(2025, 1, 1, 5)), (2, datetime(2025, 1, 2, 0)), (3, datetime(2026, 1, 1))], "id int, t timestamp_ntz")
    dim = frame([(date(2025, 1, 1), "a"), (date(2025, 1, 1), "b"), (date(2025, 1, 2), "c")], "full_date date, e string")
    assert pairs(J.join_date(facts, dim, "t").fillna("-"), "id", "e") == [(1, "a"), (1, "b"), (2, "c"), (3, "-")]


def test_required_roles(frame):
    facts = frame([(1, "a", "b"), (2, "a", "x"), (3, None, "a")], "id int, p string, d string")
    dim = frame([("a", "A"), ("b", "B"), ("c", None)], "z string, cell string")
    out = J.join_role(J.join_role(facts, dim, "p", "z", "cell", "pc"), dim, "d", "z", "cell", "dc")
    assert pairs(out, "id", "pc", "dc") == [(1, "A", "B")]
    left = J.join_role(facts, dim, "p", "z", "cell", "pc", how="left")
    assert left.count() == 3


def test_label_and_match(frame):
    cells = frame([("a",), ("b",)], "cell string")
    dim = frame([("a", "SoHo", "M"), ("a", "SoHo", "M"), ("c", "X", "Q")], "cell string, zone_name string, borough string")
    assert pairs(J.label_locations(cells, dim, "cell"), "cell", "location") == [("a", "SoHo, M"), ("b", "Unknown Location")]
    assert pairs(J.without_match(dim, cells, "cell"), "cell") == [("c",)]
    assert pairs(J.where_exists(dim, cells, "cell"), "cell") == [("a",), ("a",)]


def test_grid_completion(frame):
    df = frame([("1", 1, 10), ("1", 3, 15), ("2", 9, 7)], "v string, d int, n long")
    zero = J.complete_grid(df, "v", "d", [1, 2, 3], "n")
    assert pairs(zero, "v", "d", "n") == [("1", 1, 10), ("1", 2, 0), ("1", 3, 15), ("2", 1, 0), ("2", 2, 0), ("2", 3, 0)]
    mean = J.complete_grid(df, "v", "d", [1, 2], "n", "mean", keys=["1", "3"], fallback=(10, 20))
    assert pairs(mean, "v", "d", "n") == [("1", 1, 10), ("1", 2, 12), ("3", 1, 15), ("3", 2, 15)]
    rand = J.complete_grid(df, "v", "d", list(range(1, 50)), "n", "random", (0.8, 1.2), seed=1)
    values = [r["n"] for r in rand.where("v = '1' and d not in (1, 3)").collect()]
    assert all(10 <= v < 15 for v in values) and len(set(values)) > 1
    assert pairs(rand, "v", "d", "n") == pairs(rand, "v", "d", "n")
    with pytest.raises(ValueError):
        J.complete_grid(df, "v", "d", [1], "n", "random")
    empty = J.complete_grid(df.limit(0), "v", "d", [1], "n", "mean", keys=["1"], fallback=(2, 4))
    assert pairs(empty, "v", "d", "n") == [("1", 1, 3)]


def test_predictions_reach_every_matching_hour(frame):
    facts = frame([("a", 7, 1), ("a", 7, 2), ("a", 8, 3), ("b", 7, 4)], "cell string, h int, n int")
    preds = frame([("a", 7, 0.5), ("a", 7, 0.7)], "cell string, h int, predicted_n double")
    keys = [(c, F.col(c), F.col(c)) for c in ("cell", "h")]
    out = J.join_predictions(facts, preds, keys)
    assert pairs(out, "n", "predicted_n") == [(1, 0.5), (1, 0.7), (2, 0.5), (2, 0.7)]


# --- aggregates ---------------------------------------------------------------------------

def test_exact_average_ignores_order(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,), (None,)], "x double")
    assert df.agg(A.exact_avg("x", A.WIDE).alias("a")).first()["a"] == 0.6 / 3
    small = spark.createDataFrame([(0.00003,), (0.00003,)], "x double")
    assert small.agg(A.exact_avg("x", A.WIDE).alias("a")).first()["a"] == 0.00003


def test_whole_set_aggregates_on_empty_input(frame):
    empty = frame([], "k string, t timestamp_ntz, x double, p double")
    assert A.coverage(empty, "k", "t").first()["row_count"] == 0
    assert A.kpis(empty, "x", "k").first()["mean"] is None
    assert A.avg_or_default(empty, "x", 10.0, "d").first()["d"] == 10.0
    assert A.mape(empty, "x", "p").first()["mape"] is None


def test_mape_skips_zero_actuals(frame):
    df = frame([(10.0, 9.0), (0.0, 5.0), (-10.0, -12.0)], "a double, p double")
    row = A.mape(df, "a", "p").first()
    assert row["mape"] == pytest.approx(15.0) and row["rows_scored"] == 2


def test_balance_and_counts(frame):
    df = frame([("a", "s"), ("a", "s"), ("a", "e"), ("b", "x")], "k string, e string")
    assert pairs(A.net_balance(df, "k", "e", ["s"], ["e"]), "k", "active") == [("a", 1), ("b", 0)]
    assert [tuple(r) for r in A.value_counts(df, "e").collect()] == [("s", 2), ("e", 1), ("x", 1)]
    assert pairs(A.row_counts({"x": df, "y": df.limit(0)}), "model", "row_count") == [("x", 4), ("y", 0)]
    assert A.density(df, "k", 2.0, 1).first()["trips_per_km2"] == 1.5


# --- windows ------------------------------------------------------------------------------

def series(frame, seed=3, hot=600):
    rng, rows = random.Random(seed), []
    for key, n in (("hot", hot), ("small", 30), ("one", 1)):
        t = datetime(2025, 1, 1)
        for _ in range(n):
            t += timedelta(hours=rng.randint(1, 6))
            rows.append((key, t, rng.randint(0, 50)))
    return frame(rows, "k string, t timestamp_ntz, n long")


LAGS, ROLLS = {"l1": 1, "l24": 24}, {"r7": 7, "r24": 24}


def test_lags_count_rows_not_hours(frame):
    out = W.series_features(series(frame), "k", "t", "n", {"l1": 1, "l168": 168}, {"r7": 7})
    rows = [r for r in out.orderBy("t").collect() if r["k"] == "hot"]
    assert rows[0]["l1"] is None and rows[0]["r7"] == rows[0]["n"]
    assert [r["l168"] for r in rows[:168]] == [None] * 168
    assert rows[300]["l168"] == rows[132]["n"]
    assert rows[2]["r7"] == pytest.approx(sum(r["n"] for r in rows[:3]) / 3)
    assert rows[100]["r7"] == pytest.approx(sum(r["n"] for r in rows[94:101]) / 7)


@pytest.mark.parametrize("size", [24, 25, 100, 10_000])
def test_blocks_give_the_same_features(frame, size):
    df = series(frame)
    plain = W.series_features(df, "k", "t", "n", LAGS, ROLLS)
    split = W.series_features(df, "k", "t", "n", LAGS, ROLLS, size)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.select(plain.columns).collect()))


def test_blocks_with_null_keys_and_ties(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 4 > 0, F.col("id") % 2).alias("k"), (F.col("id") % 7).alias("t"), (F.col("id") * 3).alias("n"))
    plain = W.series_features(df, "k", ["t", "id"], "n", LAGS, ROLLS)
    split = W.series_features(df, "k", ["t", "id"], "n", LAGS, ROLLS, 30)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.select(plain.columns).collect()))


def test_block_must_hold_the_longest_lag(frame):
    with pytest.raises(ValueError):
        W.series_features(series(frame), "k", "t", "n", LAGS, ROLLS, 10)


@pytest.mark.parametrize("rows", [0, 3, 5, 7, 1000])
def test_quantiles_equal_ntile(spark, rows):
    df = spark.range(rows).select("id", (F.col("id") * 7919 % 13).alias("x"), F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("y"))
    plain = df.withColumns({out: F.ntile(5).over(Window.orderBy(col, "id")) for out, col in {"a": "x", "b": "y"}.items()})
    assert pairs(W.quantile_scores(df, {"a": "x", "b": "y"}, 5, "id"), "id", "a", "b") == pairs(plain, "id", "a", "b")


def test_quantiles_of_rows_alike_keep_their_sizes(spark):
    df = spark.range(13).select(F.lit(1).alias("x"), F.lit("t").alias("t"), F.lit("u").alias("u"))
    sizes = W.quantile_scores(df, {"a": "x"}, 5, ("t", "u")).groupBy("a").count()
    assert pairs(sizes, "a", "count") == [(1, 3), (2, 3), (3, 3), (4, 2), (5, 2)]


def test_top_n_cuts_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id"))
    out = W.top_n_per_group(df, "g", [F.desc("id")], 2)
    assert pairs(out, "g", "id") == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_names_by_rank_with_few_and_many_groups(frame):
    df = frame([(0, 1.0), (0, 3.0), (1, 9.0), (2, 0.0)], "g int, m double")
    assert pairs(W.name_by_rank(df, "g", "m", ["x", "y", "z", "w"], "n").select("g", "n").distinct(), "g", "n") == [(0, "y"), (1, "x"), (2, "z")]
    assert W.name_by_rank(df, "g", "m", ["x"], "n").where("n is null").count() == 3


def test_scaling(frame):
    df = frame([(1.0,), (3.0,), (5.0,)], "x double")
    assert pairs(W.min_max(df, "x", "s"), "x", "s") == [(1.0, 0.0), (3.0, 50.0), (5.0, 100.0)]
    assert pairs(W.min_max(df.where("x = 3"), "x", "s"), "s") == [(0.0,)]
    assert pairs(W.share_of_max(df, "x", "s"), "s") == [(20.0,), (60.0,), (100.0,)]
    assert W.share_of_max(frame([(0.0,)], "x double"), "x", "s").first()["s"] is None


# --- orders and samples -------------------------------------------------------------------

def test_category_order(frame):
    df = frame([("Dead", 9), ("Gold", 1), ("Gold", 5), ("?", 99)], "s string, n int")
    rows = O.order_by_category(df, "s", ["Gold", "Dead"], [F.desc("n")]).collect()
    assert [(r["s"], r["n"]) for r in rows] == [("Gold", 5), ("Gold", 1), ("Dead", 9), ("?", 99)]


def test_random_sample_has_the_exact_size(spark):
    df = spark.range(20_000)
    for n in (1, 100, 5000):
        first = [r["id"] for r in O.random_n(df, n, 1, ["id"]).collect()]
        assert len(set(first)) == n
        assert first == [r["id"] for r in O.random_n(df.repartition(7), n, 1, ["id"]).collect()]
    assert O.random_n(df.limit(5), 100, 1, ["id"]).count() == 5
    assert O.random_n(df.limit(0), 100, 1, ["id"]).count() == 0
    ids = [r["id"] for r in O.random_n(df, 2000, 9, ["id"]).collect()]
    assert abs(sum(ids) / 2000 - 10_000) < 500


def test_random_sample_of_equal_rows(spark):
    df = spark.range(3000).select(F.lit(1).alias("x"))
    assert O.random_n(df, 70, 1, ["x"]).count() == 70


# --- checks -------------------------------------------------------------------------------

def test_checks(frame):
    df = frame([(1, "a", 1), (1, "b", 0), (2, None, None)], "id int, k string, n int")
    dim = frame([("a",), ("a",)], "k string")
    checks = {
        "unique": Q.check_unique(df, ["id"]), "present": Q.check_not_null(df, ["k", "n"]),
        "known": Q.check_reference(df, dim, "k", "k"), "positive": Q.check_range(df, F.col("n") > 0),
        "fine": Q.check_unique(df, ["id", "k"]),
    }
    assert pairs(Q.report(checks), "check_name", "violations", "passed") == [
        ("fine", 0, True), ("known", 1, False), ("positive", 1, False), ("present", 1, False), ("unique", 1, False)]
    assert pairs(Q.condition_report(df, {"a": F.col("n") > 0, "b": F.col("id") > 0}), "check_name", "violations") == [("a", 1), ("b", 0)]
    tagged, known = Q.known(df, {"k": ("k", dim, "k"), "n": ("n", frame([(1,), (1,)], "v int"), "v")})
    assert tagged.count() == 3
    stored, counts = stash_observed(tagged, Q.violations({**known, "id": F.col("id") > 1}))
    assert counts == {"k": 1, "n": 1, "id": 2} and stored.count() == 3
    assert pairs(Q.counted_report(df.sparkSession, counts), "check_name", "violations", "passed") == [("id", 2, False), ("k", 1, False), ("n", 1, False)]
    want = StructType.fromDDL("id int, n string, x int")
    assert Q.check_schema(df, want) == ["missing column x", "column n is int, not string"]
    assert Q.check_schema(df, df.schema, exact=True) == []
    assert Q.check_schema(df, StructType.fromDDL("id int"), exact=True) == ["unexpected column k", "unexpected column n"]
