"""Scans: tables, seeds, raw documents, date spines, latest records, streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from zonepulse.functions import fixed
from zonepulse.functions.geo import rings_of

ZONE_SCHEMA = "zone_id string, zone_name string, borough string, ring array<struct<x:double,y:double>>"
ZONE_TEXT_SCHEMA = "zone_id string, zone_name string, borough string, zone_geom string"
RAW_JSON_SCHEMA = "raw_json string, inserted_at timestamp_ntz"
CALENDAR_SCHEMA = "event_date date, event_name string, event_type string"
TRIP_SCHEMA = (
    "vendor_id string, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, "
    "passenger_count long, trip_distance double, pickup_location_id string, "
    "dropoff_location_id string, rate_code string, payment_type string, fare_amount double, "
    "extra double, mta_tax double, tip_amount double, tolls_amount double, "
    "imp_surcharge double, airport_fee double, total_amount double"
)


def read_table(spark: SparkSession, path: str, schema=None, fmt: str = "parquet") -> DataFrame:
    """A file path, or a catalog table when the name holds no slash."""
    if "/" not in path:
        return spark.table(path)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, ZONE_SCHEMA)


def read_zone_texts(spark: SparkSession, path: str) -> DataFrame:
    """Zones of a CSV file with a header line whose `zone_geom` holds polygon texts; adds `rings`."""
    zones = spark.read.csv(path, header=True, schema=ZONE_TEXT_SCHEMA, enforceSchema=False)
    return zones.withColumn("rings", rings_of("zone_geom"))


def read_raw_json(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, RAW_JSON_SCHEMA)


def read_seed(spark: SparkSession, path: str, schema=CALENDAR_SCHEMA) -> DataFrame:
    """CSV with a header line; types come from the schema, never from a guess."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def calendar_seed(spark: SparkSession) -> DataFrame:
    """The built-in event calendar."""
    rows = [(date.fromisoformat(day), name, kind) for day, name, kind in fixed.CALENDAR_SEED]
    return spark.createDataFrame(rows, CALENDAR_SCHEMA)


def date_spine(spark: SparkSession, start: str, end: str, step: str = "1 day", out: str = "date_day") -> DataFrame:
    """Every date from start to end, both included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr(f"interval {step}"))
    return spark.range(1).select(F.explode(days).alias(out))


def hour_spine(start, hours: int, out: str):
    """Column that yields the `hours` full hours after `start`; explode it per key."""
    one = F.expr("interval 1 hour")
    return F.explode(F.sequence(start + one, start + F.make_dt_interval(hours=F.lit(hours)), one)).alias(out)


def latest(df: DataFrame, order: str, cols: Sequence[str], defaults: Mapping[str, object] | None = None) -> DataFrame:
    """The row with the largest `order` as a one-row frame; defaults fill an empty input.

    An aggregate instead of a sort: every task hands over one row.
    """
    newest = df.agg(
        F.max_by(F.struct(*cols), F.col(order)).alias("r"), F.count(F.lit(1)).alias("__n")
    ).select("r.*", "__n")
    for col, value in (defaults or {}).items():
        # Defaults stand in for a missing row, not for a missing field of a present row.
        newest = newest.withColumn(col, F.when(F.col("__n") == 0, F.lit(value)).otherwise(F.col(col)))
    return newest.drop("__n")


def list_models(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Catalog listing: database, table, kind, temporary."""
    found = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    rows = [(".".join(t.namespace or []), t.name, t.tableType, t.isTemporary) for t in found]
    return spark.createDataFrame(rows, "database string, name string, kind string, temporary boolean")


def read_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", **options: str) -> DataFrame:
    """File stream over a folder or a glob (a plain file name is not a stream source)."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)
