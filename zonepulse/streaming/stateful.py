"""Streams that carry something from batch to batch: balances, windows and daily landing tables.

Results go to snapshot tables, so a batch that runs again changes nothing, readers see whole
batches only, and what many batches have written is rewritten as one from time to time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from zonepulse.operators.aggregates import WIDE
from zonepulse.session import scratch_path
from zonepulse.sources.sinks import with_day
from zonepulse.sources.snapshots import SnapshotTable

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: Batches after which a result table is rewritten as one.
COMPACT_EVERY = 20


@contextmanager
def on_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, on disk and saved as changes only."""
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- balances ---------------------------------------------------------------------------------


def running_balance(
    stream: DataFrame, key: str, kind: str, start: Sequence, end: Sequence, out: str = "active",
    ts: str | None = None, idle: str | None = None, delay: str = "2 hours",
) -> DataFrame:
    """Starts minus ends per key after every batch that touches it: (key, out, expired).

    A key whose balance is back at 0 leaves the state; so does one without an event for `idle`
    in event time, which is then reported with 0 and `expired`. With `idle` a batch's events of a
    key that all come more than `delay` behind the newest are dropped. Every task sums a batch's rows per key first, so
    a key with very many events sends few rows. Rows with a null key are one group.
    """
    step = F.when(F.col(kind).isin(list(start)), 1).when(F.col(kind).isin(list(end)), -1).otherwise(0)
    at = (F.col(ts) if idle else F.lit(None)).cast("timestamp").alias("at")
    rows = stream.select(F.col(key), step.cast("long").alias("step"), at)
    name, kind_of_key = key, rows.schema[key].dataType.simpleString()
    quiet_ms = int(pd.Timedelta(idle).total_seconds() * 1000) if idle else 0

    def summed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                sums = batch.groupby(key, dropna=False, sort=False).agg(step=("step", "sum"), at=("at", "max"))
                yield sums.reset_index()[[key, "step", "at"]]

    # Defined here, so that it travels with the plan and workers need not have this package.
    class Balance(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.state = handle.getValueState("balance", "n long, until long")

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
            n, until = self.state.get() if self.state.exists() else (0, 0)
            if until:
                self.handle.deleteTimer(until)
            for part in rows:
                n += int(part["step"].sum())
                if quiet_ms and part["at_ms"].notna().any():
                    until = max(until, int(part["at_ms"].max()) + quiet_ms)
            if n:
                if until:
                    self.handle.registerTimer(until)
                self.state.update((n, until))
            else:
                self.state.clear()
            yield pd.DataFrame({name: [key[0]], out: [n], "expired": [False]})

        def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:
            self.state.clear()
            yield pd.DataFrame({name: [key[0]], out: [0], "expired": [True]})

        def close(self) -> None:
            pass

    combined = rows.mapInPandas(summed, f"`{key}` {kind_of_key}, step long, at timestamp").withColumn("at_ms", F.unix_millis("at"))
    if idle:
        combined = combined.withWatermark("at", delay)
    return combined.groupBy(key).transformWithStateInPandas(
        Balance(), f"`{key}` {kind_of_key}, `{out}` long, expired boolean", "Update", "EventTime" if idle else "None"
    )


def write_latest(
    df: DataFrame, path: str, checkpoint: str, keys: Sequence[str], ended: Column | None = None, every: str | None = None,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Keeps the newest row per key of an updating stream in a snapshot table.

    Batches are appended with their number. After `compact_every` of them the table is rewritten
    with one row per key, without those that `ended` holds for.
    """
    table = SnapshotTable(df.sparkSession, path)

    def save(batch: DataFrame, number: int) -> None:
        table.append(batch.withColumn("batch", F.lit(number).cast("long")), "stream", number)
        if (number + 1) % compact_every == 0:
            newest = _newest(table.read(), keys)
            table.replace(newest.where(~ended) if ended is not None else newest)
            table.clean_up(keep=2)

    writer = df.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    with on_rocksdb(df.sparkSession):
        return writer.start()


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*")


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of every key."""
    return _newest(SnapshotTable(spark, path).read(), keys).drop("batch")


def stored_balances(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(key, n) as the stream's state holds them."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "balance").load()
    return state.select(F.col("key.*"), F.col("value.n").alias("n"))


# --- windows ----------------------------------------------------------------------------------


def summarize_windows(
    stream: DataFrame, path: str, checkpoint: str, ts: str, key: str, value: str, window: str = "1 hour",
    slide: str | None = None, delay: str = "2 hours", every: str | None = None, compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Counts and sums per key and time window, with what comes too late kept aside.

    A window is closed once the newest event time of the batches before lies `delay` past its
    end. Rows of open windows are summed into `path`/windows; rows of closed windows, and those
    without event time, go to `path`/late as they are, with the window they belong to. Nothing
    is lost: both together are all rows, and a closed window never changes.
    """
    windows, late = SnapshotTable(stream.sparkSession, f"{path}/windows"), SnapshotTable(stream.sparkSession, f"{path}/late")

    def save(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        newest = windows.note("stream")
        batch = batch.withColumn(ts, F.col(ts).cast("timestamp")).persist()
        # A row without time is in no window; it is kept with the late ones.
        spans = F.window(F.col(ts), window, slide) if slide else F.window(F.col(ts), window)
        timed = batch.where(F.col(ts).isNotNull()).withColumn("__w", spans)
        timeless = batch.where(F.col(ts).isNull()).withColumn("window_start", F.lit(None).cast("timestamp"))
        edge = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        closed = F.coalesce(F.col("__w.end") <= edge, F.lit(False))
        too_late = timed.where(closed).withColumn("window_start", F.col("__w.start")).drop("__w")
        late.append(too_late.unionByName(timeless), "stream", number)
        sums = timed.where(~closed).groupBy(F.col("__w.start").alias("window_start"), F.col(key)).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast(WIDE)).alias("total"), F.count(value).alias("valued")
        )
        here = batch.agg(F.max(ts).cast("string")).first()[0]
        newest = max([t for t in (newest, here) if t], key=datetime.fromisoformat, default=None)
        windows.append(sums, "stream", number, note=newest)
        batch.unpersist()
        if (number + 1) % compact_every == 0:
            windows.replace(_added_up(windows.read(), key))
            for table in (windows, late):
                table.clean_up(keep=2)
            late.compact()

    writer = stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _added_up(parts: DataFrame, key: str) -> DataFrame:
    sums = {c: F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in ("n", "total", "valued")}
    return parts.groupBy("window_start", key).agg(*sums.values())


def window_summary(spark: SparkSession, path: str, key: str, value: str, with_late: bool = False) -> DataFrame:
    """(window_start, key, n, avg_value, n_late): rows, mean value and late rows per window.

    Late rows count only in `n_late`, or with `with_late` in all of them.
    """
    parts = _added_up(SnapshotTable(spark, f"{path}/windows").read(), key).withColumn("n_late", F.lit(0).cast("long"))
    behind = SnapshotTable(spark, f"{path}/late").read().where("window_start IS NOT NULL").groupBy("window_start", key).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast(WIDE)).alias("total"), F.count(value).alias("valued")
    )
    behind = behind.withColumn("n_late", F.col("n"))
    if not with_late:
        behind = behind.withColumns({"n": F.lit(0).cast("long"), "total": F.lit(None).cast("decimal(38,9)"), "valued": F.lit(0).cast("long")})
    both = parts.unionByName(behind).groupBy("window_start", key).agg(
        F.sum("n").alias("n"), F.sum("total").cast("double").alias("total"), F.sum("valued").alias("valued"), F.sum("n_late").alias("n_late")
    )
    return both.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), key, "n", F.try_divide("total", "valued").alias("avg_value"), "n_late"
    )


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows that came after their window was closed, or without a time."""
    return SnapshotTable(spark, f"{path}/late").read()


# --- landing ----------------------------------------------------------------------------------


def land_daily(
    rows: DataFrame, path: str, checkpoint: str, ts: str = "pickup_datetime", every: str | None = None,
    compact_every: int = COMPACT_EVERY, most: int = 4,
) -> StreamingQuery:
    """Appends a stream to a snapshot table partitioned by event day.

    Each batch's rows are brought together by day first, large days in several files, so a batch
    leaves few files a day; days that batches have left in more than `most` folders are rewritten.
    """
    table = SnapshotTable(rows.sparkSession, path, ["event_day"])

    def save(batch: DataFrame, number: int) -> None:
        table.append(with_day(batch, ts), "stream", number)
        if (number + 1) % compact_every == 0:
            table.compact(most)
            table.clean_up(keep=2)

    writer = rows.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def landed(spark: SparkSession, path: str) -> DataFrame:
    return SnapshotTable(spark, path, ["event_day"]).read()


def scratch_landing(rows: DataFrame, label: str, ts: str = "pickup_datetime") -> DataFrame:
    """Lands all rows that are there and returns the table."""
    path = scratch_path(rows.sparkSession, label)
    land_daily(rows, path, f"{path}-checkpoint", ts).awaitTermination()
    return landed(rows.sparkSession, path)
