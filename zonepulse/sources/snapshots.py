"""Stored tables whose readers see one version as a whole.

Rows are written aside, into folders of their own inside the table's folder, and a small file
then names the folders that make up the new version. Readers take the newest such file. A write
that fails leaves folders that no version names; a reader that began with an older version keeps
its files until they are cleaned up.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from zonepulse.sources import files
from zonepulse.sources.versions import Versions

#: Partition column that holds one write's files apart; readers do not see it.
WRITE = "__write"


class SnapshotTable:
    """A table at `path`; partition columns are fixed by its first write."""

    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = ()):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), list(partition_by)
        self.history = Versions(spark, self.path)

    def current(self) -> dict | None:
        """Number, schema and folders of the newest version, None before the first."""
        return self.history.current()

    def _publish(self, change: Callable[[dict | None], dict]) -> None:
        def next_(now: dict | None) -> dict:
            kept = {k: now[k] if now else {} for k in ("done", "notes")}
            return {"partition_by": self.partition_by, **kept, **change(now)}

        self.history.publish(next_)

    # rows

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or an older one that has not been cleaned up."""
        content = self.current() if version is None else self.history.content(version)
        if content is None:
            raise ValueError(f"no table at {self.path}")
        return self._rows(content, content["folders"])

    def _rows(self, content: dict, folders: Sequence[str]) -> DataFrame:
        schema = StructType.fromJson(content["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        stored = StructType([*schema.fields, StructField(WRITE, StringType())])
        reader = self.spark.read.schema(stored).option("basePath", self.path)
        return reader.parquet(*[f"{self.path}/{f}" for f in folders]).select(*schema.names)

    def _write(self, df: DataFrame, files_per_partition: int, cluster_by: Sequence[str]) -> list[str]:
        """Writes rows aside and returns their folders."""
        name = uuid.uuid4().hex
        if self.partition_by:
            keys = [F.col(c) for c in self.partition_by]
            if files_per_partition > 1:
                df = df.repartition(*keys, F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition)))
            else:
                df = df.hint("rebalance", *keys)
        if cluster_by:
            df = df.sortWithinPartitions(*self.partition_by, *cluster_by)
        df.withColumn(WRITE, F.lit(name)).write.mode("append").partitionBy(*self.partition_by, WRITE).parquet(self.path)
        return files.matching(self.spark, self.path, "/".join(["*"] * len(self.partition_by) + [f"{WRITE}={name}"]))

    @staticmethod
    def _partition(folder: str) -> str:
        return folder.rpartition("/")[0]

    def replace(self, df: DataFrame, files_per_partition: int = 1, cluster_by: Sequence[str] = ()) -> DataFrame:
        """The whole table becomes `df`, which may read the table itself."""
        folders = self._write(df, files_per_partition, cluster_by)
        self._publish(lambda now: {"schema": _json(df), "folders": folders})
        return self.read()

    def replace_partitions(self, df: DataFrame, files_per_partition: int = 1, cluster_by: Sequence[str] = ()) -> DataFrame:
        """Partitions that `df` has rows of become those rows; the others stay."""
        folders = self._write(df, files_per_partition, cluster_by)
        new = {self._partition(f) for f in folders}

        def change(now: dict | None) -> dict:
            kept = [f for f in now["folders"] if self._partition(f) not in new] if now else []
            return {"schema": _json(df), "folders": kept + folders}

        self._publish(change)
        return self.read()

    def append(
        self, df: DataFrame, writer: str | None = None, batch: int = 0, files_per_partition: int = 1,
        note: object = None,
    ) -> None:
        """Adds rows. A batch that `writer` has already added, by its number, is not added again.

        `note`, a JSON value, is kept with the version as the writer's last one.
        """

        def is_done(now: dict | None) -> bool:
            return writer is not None and now is not None and now["done"].get(writer, -1) >= batch

        if is_done(self.current()):
            return
        folders = self._write(df, files_per_partition, ())

        def change(now: dict | None) -> dict:
            now = now or {"schema": _json(df), "folders": [], "done": {}, "notes": {}}
            if is_done(now):
                return {"schema": now["schema"], "folders": now["folders"]}
            out = {"schema": now["schema"], "folders": now["folders"] + folders}
            if writer is not None:
                out["done"] = {**now["done"], writer: batch}
            if note is not None:
                out["notes"] = {**now["notes"], writer: note}
            return out

        self._publish(change)

    def note(self, writer: str) -> object | None:
        """What the writer's last batch noted."""
        now = self.current()
        return now["notes"].get(writer) if now else None

    def compact(self, most: int = 1, files_per_partition: int = 1) -> int:
        """Rewrites partitions that lie in more than `most` folders; returns how many those were.

        Rows that are added meanwhile stay where they are.
        """
        now = self.current()
        spread = {p for p, n in Counter(map(self._partition, now["folders"] if now else [])).items() if n > most}
        old = [f for f in now["folders"] if self._partition(f) in spread] if now else []
        if not old:
            return 0
        folders = self._write(self._rows(now, old), files_per_partition, ())

        def change(now: dict) -> dict:
            if not set(old) <= set(now["folders"]):
                raise RuntimeError("a partition was replaced while it was rewritten")
            return {"schema": now["schema"], "folders": [f for f in now["folders"] if f not in set(old)] + folders}

        self._publish(change)
        return len(spread)

    # retention

    def expire(self, date_col: str, days: int, as_of: str) -> list[str]:
        """A version without the partitions whose date lies `days` or more before `as_of`.

        Returns the folders left. Rows without a date stay. Nothing is read: the folder's name
        tells the date. `clean_up` then removes the files.
        """
        if date_col not in self.partition_by:
            raise ValueError(f"{date_col} is no partition column")
        at = self.partition_by.index(date_col)
        edge = date.fromisoformat(as_of[:10]) - timedelta(days=days)

        def stays(folder: str) -> bool:
            value = folder.split("/")[at].partition("=")[2]
            return value.startswith("__HIVE") or date.fromisoformat(value) > edge

        self._publish(lambda now: {"schema": now["schema"], "folders": [f for f in now["folders"] if stays(f)]})
        return self.current()["folders"]

    def clean_up(self, keep: int = 1) -> int:
        """Removes all but the newest `keep` versions and every folder none of them names.

        Returns how many folders went. Not for use while another writer is at work: what it has
        written aside is named by no version yet.
        """
        kept = {f for content in self.history.keep(keep) for f in content["folders"]}
        gone = [f for f in self.folders() if f not in kept]
        for folder in gone:
            files.remove(self.spark, f"{self.path}/{folder}")
            upper = self._partition(folder)
            while upper and not files.names(self.spark, f"{self.path}/{upper}"):
                files.remove(self.spark, f"{self.path}/{upper}")
                upper = self._partition(upper)
        return len(gone)

    def folders(self) -> list[str]:
        """All folders with rows that lie in storage, whether a version names them or not."""
        return files.matching(self.spark, self.path, "/".join(["*"] * len(self.partition_by) + [f"{WRITE}=*"]))


def _json(df: DataFrame) -> dict:
    return df.schema.jsonValue()
