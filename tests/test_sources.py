from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from zonepulse import session
from zonepulse.sources import sinks as K, tables as TB


def test_spine(spark):
    days = TB.date_spine(spark, "2024-02-28", "2024-03-01")
    assert [r[0] for r in days.collect()] == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
    assert TB.date_spine(spark, "2024-01-01", "2024-01-31", "1 week").count() == 5


def test_seed_from_csv(spark, tmp_path):
    (tmp_path / "seed.csv").write_text("event_date,event_name,event_type\n2021-01-01,\"New Year, again\",Holiday\n")
    row = TB.read_seed(spark, str(tmp_path / "seed.csv")).first()
    assert row["event_date"] == date(2021, 1, 1) and row["event_name"] == "New Year, again"


def test_layers_and_views(spark, frame):
    assert K.layer_path("/x/", " facts ", "m") == "/x/facts/m"
    assert K.layer_path("/x", None, "m") == K.layer_path("/x", " ", "m") == "/x/default/m"
    K.as_view(frame([(1,)], "a int"), "facts_m")
    assert TB.list_models(spark).where("name = 'facts_m'").first()["temporary"] is True
    assert TB.read_table(spark, "facts_m").count() == 1


def test_layer_namespaces(spark):
    name = K.ensure_layer(spark, " zp_layer ")
    assert name == "zp_layer" and K.ensure_layer(spark, "zp_layer") == name
    assert spark.catalog.databaseExists(name)
    spark.sql(f"DROP DATABASE {name}")


def test_landing_table(spark, tmp_path):
    path, schema = str(tmp_path / "landing"), StructType.fromDDL("a string, b double, c long")
    assert K.ensure_table(spark, path, schema).count() == 0
    K.append(spark.createDataFrame([("x", 1)], "a string, c int"), path, schema)
    assert K.ensure_table(spark, path, schema).count() == 1
    row = spark.read.schema(schema).parquet(path).first()
    assert (row["a"], row["b"], row["c"]) == ("x", None, 1)


def test_partitioned_landing_table(spark, tmp_path):
    path, schema = str(tmp_path / "landing"), StructType.fromDDL("a string, d date")
    assert K.ensure_table(spark, path, schema, ["d"]).count() == 0
    rows = spark.createDataFrame([("x", date(2025, 1, 1)), ("y", date(2025, 1, 2))], schema)
    K.append(rows, path, schema, ["d"])
    assert K.ensure_table(spark, path, schema, ["d"]).where("d = '2025-01-02'").first()["a"] == "y"


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    K.materialize(spark.range(10).select("id", (F.col("id") % 2).alias("p")), path, ["p"], ["id"])
    K.materialize(spark.range(3).select("id", F.lit(1).cast("long").alias("p")), path, ["p"], files_per_partition=2)
    out = spark.read.parquet(path).groupBy("p").count().orderBy("p").collect()
    assert [(r["p"], r["count"]) for r in out] == [(0, 5), (1, 3)]


def test_plain_table_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    K.materialize(spark.range(10), path)
    assert K.materialize(spark.range(3), path).count() == 3


def test_retention_edge(frame):
    df = frame([(date(2025, 1, 1),), (date(2025, 1, 2),), (date(2025, 4, 1),)], "d date")
    assert [r["d"] for r in K.expire_partitions(df, "d", 90, "2025-04-01").collect()] == [date(2025, 1, 2), date(2025, 4, 1)]


def test_scratch_follows_the_session(spark):
    assert session.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")


class Bare:
    """A session without any checkpoint folder."""

    def __init__(self, master):
        self.master, self.sparkContext, self.conf = master, self, self

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return None


def test_scratch_needs_a_shared_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        session.scratch_root(Bare("yarn"))
    assert session.scratch_root(Bare("local[2]")) == session.scratch_root(Bare("local[2]"))


def test_stash_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, datetime(2025, 1, 1), None)], "a int, t timestamp_ntz, s string")
    kept = session.stash(df)
    assert kept.collect() == df.collect() and kept.schema == df.schema
    assert "parquet" in kept._jdf.queryExecution().executedPlan().toString().lower()


def test_stash_of_nothing(spark):
    assert session.stash(spark.range(0)).count() == 0


def test_raw_documents_and_zones(spark, tmp_path):
    zones = spark.createDataFrame([("1", "n", "b", [(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)])], TB.ZONE_SCHEMA)
    zones.write.parquet(str(tmp_path / "z"))
    assert TB.read_zones(spark, str(tmp_path / "z")).first()["ring"][1]["x"] == 1.0
    spark.createDataFrame([("{}", datetime(2025, 1, 1))], TB.RAW_JSON_SCHEMA).write.parquet(str(tmp_path / "r"))
    assert TB.read_raw_json(spark, str(tmp_path / "r")).first()["raw_json"] == "{}"
