"""Messages in, landing tables out. Everything here also runs on batch frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from zonepulse.functions.scalars import decode_text, falsy_default, surge
from zonepulse.functions.times import shift_days, stamp
from zonepulse.operators.aggregates import net_balance
from zonepulse.operators.ordering import random_n
from zonepulse.operators.prep import date_between, last_interval, require_positive, require_present
from zonepulse.plans.models import predict
from zonepulse.plans.staging import LOCATION_IDS, MEASURES
from zonepulse.session import scratch_path
from zonepulse.sources.sinks import to_messages, with_day, write_stream

# Times travel as ISO text and are parsed afterwards, so that a bad one spoils only its row.
MESSAGE_SCHEMA = (
    "vendor_id string, pickup_datetime string, dropoff_datetime string, passenger_count long, "
    "trip_distance double, pickup_location_id string, dropoff_location_id string, "
    "rate_code string, payment_type string, fare_amount double, extra double, mta_tax double, "
    "tip_amount double, tolls_amount double, imp_surcharge double, airport_fee double, "
    "total_amount double"
)
REQUIRED = (
    "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
    "pickup_location_id", "dropoff_location_id", "fare_amount", "total_amount",
)
TEXT_DEFAULTS = {"rate_code": "1", "payment_type": "1"}
AMOUNT_DEFAULTS = {
    "extra": 0.0, "mta_tax": 0.0, "tip_amount": 0.0, "tolls_amount": 0.0,
    "imp_surcharge": 0.0, "airport_fee": 0.0,
}
DEFAULTS = {**TEXT_DEFAULTS, **AMOUNT_DEFAULTS}


def ingest_raw_json(messages: DataFrame, col: str = "value", as_of=None) -> DataFrame:
    """Valid JSON documents as raw text with their arrival time; others are dropped."""
    text = messages.select(decode_text(col).alias("raw_json"))
    valid = text.where(F.try_parse_json("raw_json").isNotNull())
    return valid.withColumn("inserted_at", stamp(as_of).cast("timestamp_ntz"))


def parse_trips(
    messages: DataFrame, col: str = "value", required: Sequence[str] = REQUIRED,
    defaults: Mapping[str, object] = DEFAULTS,
) -> DataFrame:
    """Typed trip fields plus `is_bad` for messages that are broken or lack a required field,
    and the message text for a side table."""
    text = messages.select(decode_text(col).alias("__text"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"}
    doc = F.from_json("__text", f"{MESSAGE_SCHEMA}, __corrupt string", options)
    # Unfolding a one-element array keeps later filters above the parse; pushed below it they
    # would parse the message again for every field they test.
    fields = text.select("__text", F.explode(F.array(doc)).alias("m")).select("__text", "m.*")
    for ts in ("pickup_datetime", "dropoff_datetime"):
        fields = fields.withColumn(ts, F.col(ts).try_cast("timestamp_ntz"))
    bad = F.col("__text").isNull() | F.col("__corrupt").isNotNull()
    for name in required:
        bad = bad | F.col(name).isNull()
    filled = {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    return fields.withColumn("is_bad", bad).drop("__corrupt").withColumns(filled)


def split_bad(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the texts of the bad ones."""
    good = parsed.where(~F.col("is_bad")).drop("is_bad", "__text")
    bad = parsed.where("is_bad").select(F.col("__text").alias("message"))
    return good, bad


def ingest_trips(
    messages: DataFrame, col: str = "value", as_of=None, required: Sequence[str] = REQUIRED,
    defaults: Mapping[str, object] = DEFAULTS,
) -> DataFrame:
    """Landing rows: typed, defaults filled, stamped; bad messages are dropped."""
    good, _ = split_bad(parse_trips(messages, col, required, defaults))
    return good.withColumn("processing_timestamp", stamp(as_of).cast("timestamp_ntz"))


def replay_batch(
    trips: DataFrame, day: str, n: int | None, lookup_shift: int, emit_shift: int, seed: int,
    keys: Sequence[str],
) -> DataFrame:
    """n random trips of the day `lookup_shift` days before `day`, moved by `emit_shift` days,
    as base64 messages. Empty, zero and missing optional fields get their defaults. Without n,
    every trip of the day."""
    moved = replay_rows(trips, day, n, lookup_shift, emit_shift, seed, keys)
    iso = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") for c in ("pickup_datetime", "dropoff_datetime")}
    return to_messages(moved.withColumns(iso))


def replay_rows(
    trips: DataFrame, day: str, n: int | None, lookup_shift: int, emit_shift: int, seed: int,
    keys: Sequence[str],
) -> DataFrame:
    source = date.fromisoformat(day) - timedelta(days=lookup_shift)
    of_day = date_between(trips, "pickup_datetime", source, source)
    clean = require_present(require_positive(of_day, MEASURES), LOCATION_IDS, allow_empty=True)
    drawn = clean if n is None else random_n(clean, n, seed, keys)
    out = {c: shift_days(c, emit_shift) for c in ("pickup_datetime", "dropoff_datetime")}
    out |= {c: falsy_default(c, d) for c, d in TEXT_DEFAULTS.items()}
    out |= {c: falsy_default(c, d, "number") for c, d in AMOUNT_DEFAULTS.items()}
    return drawn.withColumns(out)


def land(rows: DataFrame, path: str, checkpoint: str, ts: str = "pickup_datetime") -> StreamingQuery:
    """Appends a stream to a landing table partitioned by event day."""
    return write_stream(with_day(rows, ts), path, checkpoint, ["event_day"])


def drain(rows: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Runs a stream over all data that is there and returns what it wrote."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    write_stream(rows, path, f"{path}-checkpoint", partition_by).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


def zone_activity(
    stream: DataFrame, ts: str, key: str, value: str, window: str = "1 hour",
    slide: str | None = None, watermark: str = "2 hours",
) -> DataFrame:
    """Rows and mean value per key and time window. The watermark bounds the state; rows later
    than that are dropped."""
    # Event time has to be an instant; the session runs in UTC, so wall time stays the same.
    stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    spans = F.window(F.col(ts), window, slide) if slide else F.window(F.col(ts), window)
    total = F.sum(F.col(value).cast("decimal(18,4)")).cast("double")
    return (
        stream.withWatermark(ts, watermark)
        .groupBy(spans.alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n"), (total / F.count(value)).alias("avg_value"))
        .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), key, "n", "avg_value")
    )


def active_trips(stream: DataFrame, key: str, kind: str, start: Sequence, end: Sequence) -> DataFrame:
    """Started minus ended trips per key, kept up to date as events arrive."""
    return net_balance(stream, key, kind, start, end, "active_trips")


def write_updates(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes the changed groups of an aggregating stream, one folder per batch.

    A batch that runs again replaces its own folder, so a retry leaves no duplicates.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        df.writeStream.outputMode("update").foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def latest_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest state of every group."""
    written = spark.read.parquet(path)
    rest = [c for c in written.columns if c not in (*keys, "batch")]
    newest = F.max_by(F.struct(*rest), F.col("batch")).alias("r")
    return written.groupBy(*keys).agg(newest).select(*keys, "r.*")


def drain_updates(df: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    write_updates(df, path, f"{path}-checkpoint").awaitTermination()
    return latest_updates(spark, path, keys)


def score_stream(stream: DataFrame, model: PipelineModel, prediction: str = "predicted_total_pickups") -> DataFrame:
    """Every event scored by a trained model, with the price multiplier for its demand."""
    return predict(model, stream).withColumn("surge", surge(prediction))


def recent_feed(df: DataFrame, ts: str, interval: str = "5 minutes", as_of=None, then: Sequence[str] = ()) -> DataFrame:
    """The latest rows, newest first; `then` orders rows of the same instant, which also lets
    the sort split them."""
    return last_interval(df, ts, interval, as_of).orderBy(F.desc(ts), *then)
