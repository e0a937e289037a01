"""Tables on disk: layers, replacement, appends, retention, streaming sinks, messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from zonepulse.functions.scalars import encode_message

DEFAULT_LAYER = "default"


def layer_path(root: str, layer: str | None, name: str) -> str:
    """Folder of a model: the trimmed layer name, or the default layer without one."""
    layer = (layer or "").strip() or DEFAULT_LAYER
    return f"{root.rstrip('/')}/{layer}/{name}"


def ensure_layer(spark: SparkSession, layer: str) -> str:
    """Namespace of a layer in the catalog, created if missing."""
    name = layer.strip()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    return name


def materialize(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
    mode: str = "overwrite", files_per_partition: int = 1,
) -> DataFrame:
    """Create or replace a stored table and read it back.

    With partition columns the rows are brought together per partition value before writing,
    spread over `files_per_partition` tasks each, so that a large day neither becomes one task
    nor leaves a file from every task. Only the written partitions are replaced.
    """
    if partition_by:
        keys = [F.col(c) for c in partition_by]
        if files_per_partition > 1:
            keys.append(F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition)))
            df = df.repartition(*keys)
        else:
            # Rebalance splits partitions that grow too large and merges small ones.
            df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if cluster_by:
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def ensure_table(spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str] = ()) -> DataFrame:
    """Empty landing table with a schema, unless something is already there."""
    # An empty partitioned write leaves no files, so its schema goes to a hidden folder inside.
    target = f"{path}/_schema" if partition_by else path
    spark.createDataFrame([], schema).write.mode("ignore").parquet(target)
    return spark.read.schema(schema).parquet(path)


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns in table order and type; columns the rows lack become NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def append(df: DataFrame, path: str, schema: StructType, partition_by: Sequence[str] = ()) -> None:
    """INSERT ... SELECT with a partial column list."""
    out = align(df, schema)
    writer = out.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def expire_partitions(df: DataFrame, date_col: str, days: int, as_of: str) -> DataFrame:
    """Rows whose partition date is still within the retention time; whole partitions go."""
    return df.where(F.col(date_col) > F.date_sub(F.lit(as_of).cast("date"), days))


def to_messages(df: DataFrame, cols: Sequence[str] | None = None, out: str = "value") -> DataFrame:
    """One base64 JSON message per row."""
    return df.select(encode_message(*(cols or df.columns)).alias(out))


def write_stream(
    df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (),
    every: str | None = None,
) -> StreamingQuery:
    """Append-only file sink; drains what is there, or runs on at an interval."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path)


def with_day(df: DataFrame, ts: str, out: str = "event_day") -> DataFrame:
    """Partition column for a timestamp."""
    return df.withColumn(out, F.to_date(F.col(ts)))


