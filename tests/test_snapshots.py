from collections import Counter

import pytest
from pyspark.sql import functions as F

from zonepulse.sources import files
from zonepulse.sources.snapshots import SnapshotTable

DAYS = "day date, id long, name string"


def rows_of(spark, *rows):
    return spark.createDataFrame([(d, n, f"n{n}") for d, n in rows], "d string, id long, name string").select(F.col("d").cast("date").alias("day"), "id", "name")


def seen(df):
    return Counter((str(r["day"]), r["id"]) for r in df.collect())


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "t"), ["day"])


def test_a_failed_write_leaves_the_old_table(spark, table):
    table.replace(rows_of(spark, ("2024-01-01", 1), ("2024-01-02", 2)))
    bad = rows_of(spark, ("2024-01-01", 7), ("2024-01-03", 8)).withColumn("name", F.when(F.col("id") == 8, F.raise_error(F.lit("stop"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="stop"):
        table.replace(bad)
    assert seen(table.read()) == Counter({("2024-01-01", 1): 1, ("2024-01-02", 2): 1})
    assert table.history.numbers() == [0]
    # A write that is killed between its files and its version is not seen either, and is cleaned up.
    table._write(rows_of(spark, ("2024-01-09", 9)), 1, ())
    assert table.read().count() == 2 and table.clean_up() >= 1
    assert [f.split("/")[0] for f in table.folders()] == ["day=2024-01-01", "day=2024-01-02"]


def test_readers_keep_the_version_they_began_with(spark, table):
    table.replace(rows_of(spark, ("2024-01-01", 1)))
    before = table.read()
    after = table.replace(rows_of(spark, ("2024-01-01", 2), ("2024-01-05", 3)))
    assert seen(before) == Counter({("2024-01-01", 1): 1}) and seen(table.read(0)) == seen(before)
    assert seen(after) == Counter({("2024-01-01", 2): 1, ("2024-01-05", 3): 1})
    # A table may be made from itself.
    table.replace(table.read().where("id = 3"))
    assert seen(table.read()) == Counter({("2024-01-05", 3): 1})


def test_partitions_are_replaced_alone(spark, table):
    table.replace_partitions(rows_of(spark, ("2024-01-01", 1), ("2024-01-02", 2)))
    table.replace_partitions(rows_of(spark, ("2024-01-02", 5), ("2024-01-03", 6)))
    assert seen(table.read()) == Counter({("2024-01-01", 1): 1, ("2024-01-02", 5): 1, ("2024-01-03", 6): 1})
    plan = table.read().where("day = DATE'2024-01-03'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_a_batch_is_added_once(spark, table):
    for n, batch in ((1, 0), (2, 1), (2, 1), (1, 0), (3, 2)):
        table.append(rows_of(spark, ("2024-01-01", n)), "query", batch)
    table.append(rows_of(spark, ("2024-01-01", 3)), "another", 0)
    assert seen(table.read()) == Counter({("2024-01-01", n): k for n, k in ((1, 1), (2, 1), (3, 2))})


def test_compaction_keeps_rows_and_joins_files(spark, table):
    for n in range(6):
        table.append(rows_of(spark, ("2024-01-01", n), ("2024-01-02", n)) if n < 4 else rows_of(spark, ("2024-01-02", n)))
    before = seen(table.read())
    assert table.compact(most=4) == 1
    assert Counter(f.split("/")[0] for f in table.current()["folders"]) == Counter({"day=2024-01-01": 4, "day=2024-01-02": 1})
    assert table.compact() == 1 and table.compact() == 0
    assert table.clean_up() > 0 and len(table.folders()) == 2 and seen(table.read()) == before


def test_expiry_removes_folders(spark, table):
    table.replace(rows_of(spark, *[(f"2024-01-{d:02d}", d) for d in range(1, 11)]).unionByName(rows_of(spark, (None, 99))))
    kept = table.expire("day", 3, "2024-01-10")
    assert len(kept) == 4 and len(table.folders()) == 11
    assert table.clean_up() == 7
    assert [f for f in files.names(spark, table.path) if f != "_SUCCESS"] == ["_versions", "day=2024-01-08", "day=2024-01-09", "day=2024-01-10", "day=__HIVE_DEFAULT_PARTITION__"]
    assert {r["id"] for r in table.read().collect()} == {8, 9, 10, 99}
    with pytest.raises(ValueError):
        table.expire("id", 3, "2024-01-10")


def test_tables_without_partitions_and_without_rows(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "p"))
    with pytest.raises(ValueError):
        table.read()
    table.replace(spark.range(0))
    assert table.read().count() == 0 and table.read().columns == ["id"]
    table.append(spark.range(3))
    table.append(spark.range(2))
    assert table.read().count() == 5 and table.compact() == 1 and table.read().count() == 5


def test_the_second_of_two_writers_starts_over(spark, table, monkeypatch):
    table.append(rows_of(spark, ("2024-01-01", 1)))
    publish, other = files.publish_text, SnapshotTable(spark, table.path, ["day"])
    raced = []

    def race(spark, path, text):
        if not raced:
            raced.append(path)
            other.append(rows_of(spark, ("2024-01-01", 2)))
        return publish(spark, path, text)

    monkeypatch.setattr(files, "publish_text", race)
    table.append(rows_of(spark, ("2024-01-01", 3)))
    assert {r["id"] for r in table.read().collect()} == {1, 2, 3} and table.history.numbers() == [0, 1, 2]
