"""The roles the given tables play. Exact integer arithmetic only, so that any engine agrees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from zonepulse.functions import fixed
from zonepulse.functions.scalars import lookup

HOLIDAYS = {
    "01-01": ("New Year's Day", "Holiday"),
    "07-04": ("Independence Day", "Holiday"),
    "11-02": ("Election Day", "Event"),
    "12-25": ("Christmas Day", "Holiday"),
}
CONDITIONS = {"click": "Clear", "view": "Mist", "purchase": "Light Rain", "signup": "Snow", "error": "Haze"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def plus_seconds(ts: Column, n: Column) -> Column:
    return F.timestamp_add("SECOND", n, ts)


def hundredths(col: str) -> Column:
    """A two-digit amount as whole hundredths (amounts are not negative)."""
    return (F.col(col) * 100.0 + 0.5).cast("long")


TRIP_COLUMNS = (
    "CAST(l_linenumber % 2 + 1 AS string) AS vendor_id",
    "timestampadd(SECOND, start, o_orderdate) AS pickup_datetime",
    "timestampadd(SECOND, start + drive, o_orderdate) AS dropoff_datetime",
    "CAST(l_linenumber - 1 AS bigint) AS passenger_count",
    "l_quantity / 2D - 1D AS trip_distance",
    "CAST(l_suppkey % 25 AS string) AS pickup_location_id",
    "CAST(l_partkey % 25 AS string) AS dropoff_location_id",
    "l_linestatus AS rate_code",
    "l_returnflag AS payment_type",
    "fare / 10000D AS fare_amount",
    "extra / 10000D AS extra",
    "0.5D AS mta_tax",
    "tip / 10000D AS tip_amount",
    "tolls / 10000D AS tolls_amount",
    "0.3D AS imp_surcharge",
    "0D AS airport_fee",
    "(fare + extra + tip + tolls + 8000) / 10000D AS total_amount",
)


def raw_trips(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Trip records: one per line item, its order giving the day. Amounts are whole
    ten-thousandths until the end."""
    cents, discount = hundredths("l_extendedprice"), hundredths("l_discount")
    items = lineitem.withColumns({"cents": cents, "discount": discount}).selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity", "l_suppkey", "l_partkey", "l_linestatus", "l_returnflag",
        "(l_orderkey * 37 + l_linenumber * 911) % 86400 AS start",
        "(l_partkey * 53 + l_linenumber * 7) % 9000 AS drive",
        "cents div 10 AS fare",
        "(cents * discount) div 1000 AS tip",
        "CAST(l_tax * 100D + 0.5D AS bigint) * 2500 AS extra",
        "CASE WHEN l_partkey % 10 = 0 THEN 65500L ELSE 0L END AS tolls",
    )
    # Two tables that grow together: neither is ever broadcast.
    days = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate").hint("merge")
    return items.join(days, "l_orderkey").selectExpr(*TRIP_COLUMNS)


def zones(nation: DataFrame, region: DataFrame) -> DataFrame:
    """One small square per nation; one region plays the unknown borough."""
    lon = (F.col("n_nationkey") * 13 - 74000) / F.lit(1000.0)
    lat = (F.col("n_nationkey") * 7 + 40600) / F.lit(1000.0)
    half = 0.002
    corners = [(-half, -half), (half, -half), (half, half), (-half, half), (-half, -half)]
    ring = F.array(*[F.struct((lon + dx).alias("x"), (lat + dy).alias("y")) for dx, dy in corners])
    borough = F.when(F.col("r_name") == "MIDDLE EAST", "Unknown").otherwise(F.col("r_name"))
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").cast("string").alias("zone_id"),
        F.col("n_name").alias("zone_name"),
        borough.alias("borough"),
        ring.alias("ring"),
    )


def zone_texts(nation: DataFrame, region: DataFrame) -> DataFrame:
    """The zones as polygon texts: a square with a hole off its centre, and a smaller square apart."""
    lon, lat = F.col("n_nationkey") * 13 - 74000, F.col("n_nationkey") * 7 + 40600

    def square(x: float, y: float, half: float) -> Column:
        corners = [(-half, -half), (half, -half), (half, half), (-half, half), (-half, -half)]
        at = [F.concat_ws(" ", ((lon + x + dx) / F.lit(1000.0)).cast("string"), ((lat + y + dy) / F.lit(1000.0)).cast("string")) for dx, dy in corners]
        return F.concat(F.lit("("), F.concat_ws(", ", *at), F.lit(")"))

    text = F.concat(
        F.lit("MULTIPOLYGON (("), square(0, 0, 2), F.lit(", "), square(1, 0, 0.5), F.lit("), ("), square(10, 20, 1), F.lit("))"),
    )
    base = zones(nation, region).join(nation.select(F.col("n_nationkey").cast("string").alias("zone_id"), text.alias("zone_geom")), "zone_id")
    return base.select("zone_id", "zone_name", "borough", "zone_geom")


def stations(orders: DataFrame) -> DataFrame:
    """Station readings in Fahrenheit and inches, one per order; a fourth station is foreign."""
    cust, key = F.col("o_custkey"), F.col("o_orderkey")
    ids = dict(enumerate([*fixed.STATION_IDS, "999999"]))
    temp = (cust % 80 + 20).cast("double")

    def reported(every: int) -> Column:
        return F.when(key % every == 0, "1").otherwise("0")

    return orders.select(
        lookup((cust % 4).cast("int"), ids).alias("stn"),
        F.to_date("o_orderdate").alias("date"),
        temp.alias("temp"),
        (temp + key % 15).alias("max"),
        (temp - key % 15).alias("min"),
        ((key % 50) / F.lit(100.0)).alias("prcp"),
        reported(13).alias("fog"),
        reported(7).alias("rain_drizzle"),
        reported(11).alias("snow_ice_pellets"),
    )


def calendar_events(orders: DataFrame) -> DataFrame:
    """Holidays among the days that have orders."""
    day = F.date_format("event_date", "MM-dd")
    days = orders.select(F.to_date("o_orderdate").alias("event_date")).where(day.isin(*HOLIDAYS)).distinct()
    return days.select(
        "event_date",
        lookup(day, {k: v[0] for k, v in HOLIDAYS.items()}).alias("event_name"),
        lookup(day, {k: v[1] for k, v in HOLIDAYS.items()}).alias("event_type"),
    )


def weather_documents(events: DataFrame) -> DataFrame:
    """One JSON weather document per event; rain amounts only where it rains."""
    eid, uid = F.col("event_id"), F.col("user_id")
    temp = ((uid * 7 + eid) % 400) / F.lit(10.0)
    rainy = F.col("event_type") == "purchase"
    doc = F.struct(
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("dt"),
        F.struct(
            temp.alias("temp"), (temp + uid % 10).alias("temp_max"), (temp - uid % 7).alias("temp_min"),
            (eid % 60 + 30).alias("humidity"),
        ).alias("main"),
        F.array(F.struct(lookup("event_type", CONDITIONS).alias("main"))).alias("weather"),
        F.struct((eid % 200 / F.lit(10.0)).alias("speed")).alias("wind"),
        F.when(rainy, F.struct((eid % 50 / F.lit(10.0)).alias("1h"))).alias("rain"),
    )
    return events.select(F.to_json(doc).alias("raw_json"), F.col("ts").alias("inserted_at"))


def trip_message_fields(events: DataFrame) -> DataFrame:
    """Trip message fields from events. Every 17th lacks a required field, and some leave
    out an optional one."""
    eid, uid = F.col("event_id"), F.col("user_id")
    fare = F.when(eid % 17 != 0, (eid % 5000 + 250) / F.lit(100.0))

    def stamp(extra: Column) -> Column:
        return F.date_format(F.date_trunc("second", plus_seconds(F.col("ts"), extra)), "yyyy-MM-dd'T'HH:mm:ss")

    return events.select(
        "event_id",
        (uid % 2 + 1).cast("string").alias("vendor_id"),
        stamp(F.lit(0)).alias("pickup_datetime"),
        stamp(eid * 53 % 9000).alias("dropoff_datetime"),
        (eid % 6).alias("passenger_count"),
        (eid % 300 / F.lit(10.0)).alias("trip_distance"),
        (uid % 25).cast("string").alias("pickup_location_id"),
        (eid % 25).cast("string").alias("dropoff_location_id"),
        F.when(eid % 3 != 0, (eid % 5 + 1).cast("string")).alias("rate_code"),
        F.when(eid % 4 != 0, (eid % 2 + 1).cast("string")).alias("payment_type"),
        fare.alias("fare_amount"),
        F.when(eid % 5 != 0, (eid % 7) / F.lit(2.0)).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        (uid % 9 / F.lit(2.0)).alias("tip_amount"),
        F.when(eid % 10 == 0, F.lit(6.5)).alias("tolls_amount"),
        F.lit(0.3).alias("imp_surcharge"),
        (fare + uid % 9 / F.lit(2.0) + 0.5).alias("total_amount"),
    )


def message_values(fields: DataFrame, encode) -> DataFrame:
    """Messages as they arrive: base64 JSON, every 23rd broken off in the middle."""
    cols = [c for c in fields.columns if c != "event_id"]
    text = F.to_json(F.struct(*cols), {"ignoreNullFields": "true"})
    broken = F.when(F.col("event_id") % 23 == 0, F.substring(text, 1, 40)).otherwise(text)
    return fields.select(encode(broken).alias("value"))
