import sys

import duckdb
import pytest

sys.path.insert(0, "tools")
import check  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in check.TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_twin(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    result = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(result.columns)
    mine = check.rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert mine == check.rows_of(result.columns, result.fetchall())
    kinds = dict(zip(result.columns, map(str, result.types)))
    assert all(check.compatible(t, kinds[c]) for c, t in df.dtypes)


@pytest.mark.parametrize("name", ["demand_model_forecast", "fare_model_quotes"])
def test_queries_without_twin_run(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


LAZY = (
    "hourly_features", "hourly_demand_trips", "hourly_features_trips", "fct_trips", "conform_trips", "unify_trips",
    "zone_volume", "vendor_hourly", "parent_cells", "density_rank", "station_rollup", "weather_json", "surge_tiers",
    "last_hour_summary", "active_trips", "top_parts_per_brand", "semi_join_active", "distinct_cells",
)


@pytest.mark.parametrize("name", LAZY)
def test_plans_stay_hash_based(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for costly in ("SortAggregate", "CartesianProduct", "NestedLoop", "Python", "Exchange SinglePartition, REPARTITION"):
        assert costly not in plan


def test_scans_read_only_needed_columns(spark):
    plan = entry.queries()["hourly_demand_trips"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "l_returnflag" not in plan and "o_totalprice" not in plan


def test_the_union_prunes_landed_days(spark):
    plan = entry.queries()["unify_trips"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_day" in plan


@pytest.mark.parametrize("name", ["quality_report", "model_row_counts"])
def test_trips_are_read_from_their_source_once(spark, name, monkeypatch):
    """Counts scans of lineitem in every plan that runs, those of stored frames included."""
    from pyspark.sql.readwriter import DataFrameWriter

    entry.catalog.open_warehouse(spark, FOLDER).weather, entry.catalog.open_warehouse(spark, FOLDER).dates
    plans, write = [], DataFrameWriter.parquet

    def noted(self, path, *args, **more):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    plans.append(entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString())
    assert sum(p.count("lineitem.parquet") for p in plans) == 1


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "pickups_24h_ago" in df.columns
