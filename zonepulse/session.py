"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, app: str = "zonepulse", **extra: str) -> SparkSession:
    """Session with the settings above; the cluster's own settings decide everything else."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_ROOT: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors can reach: the one the cluster names in spark.checkpoint.dir, or
    the checkpoint folder set on the context.

    Only a local session without either falls back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if not _LOCAL_ROOT:
        _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="zonepulse-"))
    return _LOCAL_ROOT[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path on every call, so that runs never meet; one folder per application, which can
    be removed as a whole once the application has ended."""
    return f"{scratch_root(spark)}/zonepulse/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark removes an execution's shuffle files as soon as it has ended.

    For runs of many stored steps: none reads an earlier one's shuffle again, and left to the
    garbage collection of the driver they would all lie on disk until the last step.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def send_few(spark: SparkSession, rows: int = 1_000) -> None:
    """From now on Python tasks of the session get at most so many rows at once; a lower setting stays.

    For rows that are whole texts: Spark's 10,000 of them are tens of MB, held by the JVM and by
    the Python worker in each task, and executors keep much of that for good. No result depends on it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def stash(df: DataFrame, label: str = "stash") -> DataFrame:
    """Write once to the shared folder and read back.

    Cuts the lineage, survives lost executors and gives the optimizer true sizes. Used where
    several outputs share one expensive frame.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stash_observed(df: DataFrame, metrics: Mapping[str, Column], label: str = "stash") -> tuple[DataFrame, dict[str, object]]:
    """Stores a frame and aggregates over it in the same pass; returns both."""
    seen = Observation()
    stored = stash(df.observe(seen, *[col.alias(name) for name, col in metrics.items()]), label)
    return stored, seen.get
