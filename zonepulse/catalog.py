"""Every registered query: a name and a function from (session, folder) to a frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DecimalType, ByteType, IntegerType, ShortType, StringType, StructField, StructType,
)

from zonepulse.functions import fixed, geo, scalars as S, times as T
from zonepulse.operators import aggregates as A, joins as J, prep as P, quality as Q, windows as W
from zonepulse.plans import dimensions as DI, facts as FA, models as M, reports as R, staging as ST
from zonepulse.plans.warehouse import (
    CALENDAR, SHIFT_DAYS, SHIFT_YEARS, EVENT_YEARS, Warehouse, build_all, build_report, open_warehouse,
)
from zonepulse.session import scratch_path, stash, stash_observed
from zonepulse.sources import bindings as B, sinks as K, tables as TB
from zonepulse.sources.snapshots import SnapshotTable
from zonepulse.streaming import ingest as I, stateful as SF

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

AS_OF = "2004-11-30"
SPAN = ("2004-01-01", "2004-10-31")
VENDORS = ("1", "2")
SEED = 42


def query(build: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """Registers under the function's name; whole numbers leave as bigint, decimals as double."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(build(open_warehouse(spark, folder)))

    REGISTRY[build.__name__] = run
    return build


def plain(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            col = col.cast("double").alias(f.name)
        elif isinstance(f.dataType, (ByteType, ShortType, IntegerType)):
            col = col.cast("long").alias(f.name)
        cols.append(col)
    return df.select(*cols)


def rounded(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: S.round_to(c, digits) for c in cols})


# --- hourly demand ------------------------------------------------------------------------

@query
def hourly_features(w: Warehouse) -> DataFrame:
    return w.event_features()


@query
def hourly_features_blocked(w: Warehouse) -> DataFrame:
    return w.event_features(block_rows=400)


@query
def hourly_demand_trips(w: Warehouse) -> DataFrame:
    return w.demand()


@query
def hourly_features_trips(w: Warehouse) -> DataFrame:
    return w.features()


@query
def event_value_lags(w: Warehouse) -> DataFrame:
    # A raw series: the rows per event type grow with the table, so blocks are a must.
    rows = w.table("events").select("event_id", "event_type", "ts", F.col("value").cast("decimal(18,4)").alias("value"))
    lags, rolls = {"value_1_ago": 1, "value_100_ago": 100}, {"avg_of_10": 10}
    out = W.series_features(rows, "event_type", ["ts", "event_id"], "value", lags, rolls, block_rows=5000)
    return rounded(out, ["avg_of_10"], 4)


@query
def features_after_warmup(w: Warehouse) -> DataFrame:
    rows = P.skip_warmup(w.event_features(), "timestamp_hour", 168)
    return P.require_not_null(rows, M.LAG_COLUMNS).select("pickup_cell", "timestamp_hour", *M.LAG_COLUMNS)


# --- dimensions and staging ---------------------------------------------------------------

@query
def calendar_dim(w: Warehouse) -> DataFrame:
    return w.dates


@query
def location_dim(w: Warehouse) -> DataFrame:
    return rounded(w.locations.drop("zone_centroid"), ["longitude", "latitude"])


@query
def zone_scan(w: Warehouse) -> DataFrame:
    """Zones from a file of polygon texts with holes and several parts."""
    path = scratch_path(w.spark, "zones")
    B.zone_texts(w.table("nation"), w.table("region")).write.csv(path, header=True)
    zones = TB.read_zone_texts(w.spark, path)
    shapes = zones.select("zone_id", F.size("rings").alias("n_rings"), geo.area_of("rings").alias("area"))
    out = DI.dim_location(zones).drop("zone_centroid").join(shapes, "zone_id")
    return rounded(out, ["longitude", "latitude"]).withColumn("area", S.round_to("area", 9))


@query
def cell_decode(w: Warehouse) -> DataFrame:
    key = F.col("c_custkey")
    good = geo.cell_id((key % 700 - 74300) / F.lit(1000.0), (key % 300 + 40500) / F.lit(1000.0))
    cells = w.table("customer").select("c_custkey", F.when(key % 4 == 0, F.col("c_name")).otherwise(good).alias("cell"))
    return cells.withColumns({"lon": geo.cell_lon("cell"), "lat": geo.cell_lat("cell")})


@query
def events_shifted(w: Warehouse) -> DataFrame:
    return ST.stg_events(w.calendar(), EVENT_YEARS)


@query
def calendar_seed_scan(w: Warehouse) -> DataFrame:
    """Calendar events from a CSV file with a header line."""
    path = scratch_path(w.spark, "seed")
    w.calendar().select("event_date", "event_name", "event_type").write.csv(path, header=True)
    return ST.stg_events(TB.read_seed(w.spark, path), EVENT_YEARS)


@query
def raw_document_scan(w: Warehouse) -> DataFrame:
    """Weather documents from a table of raw texts."""
    path = scratch_path(w.spark, "raw")
    w.weather_documents().select("raw_json", "inserted_at").write.parquet(path)
    return ST.stg_weather_json(TB.read_raw_json(w.spark, path))


@query
def model_listing(w: Warehouse) -> DataFrame:
    """Views of two models as the catalog lists them, with rows of a preview of each."""
    views = {"listed_locations": w.locations, "listed_dates": w.dates}
    for name, df in views.items():
        K.as_view(df, name)
    found = TB.list_models(w.spark).where(F.col("name").isin(list(views)))
    rows = A.row_counts({name: P.preview(df, df.columns[:2], 10) for name, df in views.items()})
    return found.join(rows, F.col("name") == F.col("model")).select("name", "kind", "temporary", "row_count")


@query
def station_weather(w: Warehouse) -> DataFrame:
    return ST.stg_weather(w.stations(), SHIFT_YEARS)


@query
def station_rollup(w: Warehouse) -> DataFrame:
    return ST.station_rollup(w.stations(), SHIFT_YEARS, "1995-01-01", "2000-12-06")


@query
def weather_json(w: Warehouse) -> DataFrame:
    return ST.stg_weather_json(w.weather_documents())


@query
def weather_unified(w: Warehouse) -> DataFrame:
    return w.weather_sources()


@query
def daily_weather(w: Warehouse) -> DataFrame:
    return w.weather


@query
def live_conditions(w: Warehouse) -> DataFrame:
    return R.live_conditions(w.weather_documents())


@query
def conform_trips(w: Warehouse) -> DataFrame:
    return w.trips()


def landing_table(w: Warehouse) -> SnapshotTable:
    """Trips as a stream would have landed them since it began, a month before its rows are used:
    moved to their new days and partitioned by day."""
    moved = w.raw_trips().withColumns({c: T.shift_days(c, SHIFT_DAYS) for c in ("pickup_datetime", "dropoff_datetime")})
    moved = P.time_range(moved, "pickup_datetime", "2004-11-24")
    table = SnapshotTable(w.spark, scratch_path(w.spark, "landing"), ["event_day"])
    table.replace(K.with_day(moved, "pickup_datetime"))
    return table


@query
def unify_trips(w: Warehouse) -> DataFrame:
    landing = landing_table(w).read()
    return ST.stg_trips(w.raw_trips(), landing, SHIFT_DAYS, "1995-02-01", "2000-12-24", "2004-12-24", "event_day")


# --- facts --------------------------------------------------------------------------------

@query
def fct_trips(w: Warehouse) -> DataFrame:
    return w.facts()


def training_set(w: Warehouse, noise: float) -> DataFrame:
    """The facts feed the training rows and the hourly demand, so they are stored in between."""
    trips = stash(w.facts().select(*FA.TRAINING_COLUMNS), "facts")
    return FA.fare_training(trips, w.dates, w.weather, FA.hourly_demand(trips, w.dates, w.weather), noise, SEED)


@query
def fare_training(w: Warehouse) -> DataFrame:
    return training_set(w, 0)


@query
def noisy_label(w: Warehouse) -> DataFrame:
    return training_set(w, 0.1)


@query
def zone_volume(w: Warehouse) -> DataFrame:
    return FA.zone_volume(w.facts())


@query
def zone_patterns(w: Warehouse) -> DataFrame:
    wide = FA.zone_patterns(w.event_demand(), wrap_night=True)
    return rounded(wide, ["stddev_hourly_demand"])


def zone_table(w: Warehouse) -> DataFrame:
    trips = stash(w.facts().select("pickup_cell", "picked_up_at"), "facts")
    return FA.zone_features(trips, FA.hourly_demand(trips, w.dates, w.weather), w.locations, *SPAN)


@query
def zone_features(w: Warehouse) -> DataFrame:
    return rounded(zone_table(w), ["stddev_hourly_demand", "latitude", "longitude"])


# --- recency, frequency, monetary ---------------------------------------------------------

def zone_rfm(w: Warehouse) -> DataFrame:
    return R.rfm(w.facts(), w.locations, AS_OF, 30)


@query
def rfm_zones(w: Warehouse) -> DataFrame:
    return zone_rfm(w)


@query
def rfm_totals(w: Warehouse) -> DataFrame:
    return R.rfm_summaries(zone_rfm(w))["totals"]


@query
def rfm_segment_counts(w: Warehouse) -> DataFrame:
    return R.rfm_summaries(zone_rfm(w))["counts"]


@query
def rfm_segment_revenue(w: Warehouse) -> DataFrame:
    return R.segment_revenue(zone_rfm(w))


@query
def rfm_top_by_segment(w: Warehouse) -> DataFrame:
    return R.top_by_segment(zone_rfm(w), fixed.SEGMENTS, 15)


@query
def rfm_customers(w: Warehouse) -> DataFrame:
    return R.customer_rfm(w.table("orders"), "o_custkey", "o_orderdate", "o_totalprice", "2001-08-01")


# --- vendors ------------------------------------------------------------------------------

def vendor_hours(w: Warehouse) -> DataFrame:
    chosen = P.where_in(w.facts(), "vendor_id", VENDORS)
    return R.vendor_hours(P.date_between(chosen, "picked_up_at", *SPAN))


@query
def vendor_hourly(w: Warehouse) -> DataFrame:
    return R.vendor_volume(vendor_hours(w), "hour")


@query
def vendor_weekday(w: Warehouse) -> DataFrame:
    out = R.vendor_volume(vendor_hours(w), "day_of_week")
    return out.withColumn("day_name", T.dow_name("day_of_week"))


@query
def vendor_monthly(w: Warehouse) -> DataFrame:
    year = P.same_year(P.where_in(w.facts(), "vendor_id", VENDORS), "picked_up_at", AS_OF)
    return A.volume_by(year, "vendor_id", "picked_up_at", "month")


@query
def vendor_speed(w: Warehouse) -> DataFrame:
    return R.average_speed(vendor_hours(w), 24.5)


@query
def vendor_kpis(w: Warehouse) -> DataFrame:
    return rounded(R.vendor_report(w.facts(), *SPAN)["kpis"], ["share_1_pct", "speed_lead_mph"])


@query
def vendor_month_filled(w: Warehouse) -> DataFrame:
    return R.vendor_report(w.facts(), *SPAN)["monthly"]


@query
def event_grid_filled(w: Warehouse) -> DataFrame:
    # Events per user and hour of day leave gaps; the grid fills them with the user's mean.
    hours = A.volume_by(w.table("events"), "user_id", "ts", "hour")
    return J.complete_grid(hours, "user_id", "hour", list(range(24)), "trip_count", "mean")


@query
def vendor_month_random(w: Warehouse) -> DataFrame:
    # Months without trips, and a vendor without any, get random counts near the vendor's mean.
    months = [f"{year}-{month:02d}" for year in (2004, 2005) for month in range(1, 13)]
    volume = R.vendor_volume(R.vendor_hours(w.facts()), "month")
    return J.complete_grid(volume, "vendor_id", "month", months, "trip_count", "random", keys=["1", "2", "9"], seed=SEED)


# --- forecast, demand map -----------------------------------------------------------------

def standin_forecast(w: Warehouse, on=M.FORECAST_KEYS) -> DataFrame:
    """The rolling daily mean plays the model, so that results are exact."""
    features = stash(w.event_features(), "features")
    recent = P.last_interval(features, "timestamp_hour", "24 hours")
    recent = P.require_not_null(recent, ["pickups_24h_ago"])
    scored = recent.withColumn("predicted_total_pickups", F.col("avg_pickups_24h"))
    return M.score_back(features, scored, on)


@query
def forecast_join(w: Warehouse) -> DataFrame:
    return standin_forecast(w)


@query
def forecast_join_two_keys(w: Warehouse) -> DataFrame:
    return standin_forecast(w, ("pickup_cell", "hour")).groupBy("pickup_cell", "timestamp_hour").agg(
        F.count(F.lit(1)).alias("matches"), A.exact_avg("predicted_total_pickups", A.WIDE).alias("mean_prediction")
    )


@query
def mape(w: Warehouse) -> DataFrame:
    return rounded(A.mape(standin_forecast(w), "actual_pickups", "predicted_total_pickups"), ["mape"])


@query
def seasonal_forecast(w: Warehouse) -> DataFrame:
    return M.forecast_horizon(stash(w.event_demand(), "demand"), 24)


def trip_forecast(w: Warehouse) -> DataFrame:
    """Weekday and hour profile of every cell as predictions for the hours that occurred."""
    demand = stash(w.demand(), "demand")
    profile = M.seasonal_profile(demand)
    keyed = demand.select("pickup_cell", "timestamp_hour", "day_of_week", "hour_of_day")
    return keyed.join(profile, ["pickup_cell", "day_of_week", "hour_of_day"]).select(
        "pickup_cell", "timestamp_hour", F.col("expected_pickups").alias("predicted_total_pickups")
    )


@query
def demand_levels(w: Warehouse) -> DataFrame:
    return rounded(R.demand_map(trip_forecast(w), w.locations, 8)["levels"], ["marker_size"])


@query
def demand_kpis(w: Warehouse) -> DataFrame:
    return R.demand_map(trip_forecast(w), w.locations, 8)["kpis"]


@query
def top_cells_labelled(w: Warehouse) -> DataFrame:
    return R.demand_map(trip_forecast(w), w.locations, 8)["top"]


@query
def cells_without_forecast(w: Warehouse) -> DataFrame:
    recent = R.recent_forecast(trip_forecast(w), "2004-11-30 12:00:00")
    return R.demand_map(recent, w.locations, 8)["without_forecast"]


@query
def hot_cells_last_hour(w: Warehouse) -> DataFrame:
    return R.hot_cells(w.event_demand(), k=3)


@query
def haversine_quotes(w: Warehouse) -> DataFrame:
    requests = quote_requests(w)
    quotes = M.quote_features(requests, R.live_conditions(w.weather_documents()), trip_forecast(w), "2004-11-30 12:00:00")
    fare = S.round_to(geo.rule_fare("trip_distance"), 2).alias("rule_fare")
    return quotes.select(
        "request_id", "pickup_cell", "dropoff_cell", "trip_distance", "trip_duration_seconds", "hour_of_day",
        "day_of_week", "is_weekend", "avg_temp_celsius", "historical_demand", fare,
    )


def quote_requests(w: Warehouse) -> DataFrame:
    """One request per order, between two zone centres, at its day and some hour."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")

    def lon(n):
        return (n % 25 * 13 - 74000) / F.lit(1000.0)

    def lat(n):
        return (n % 25 * 7 + 40600) / F.lit(1000.0)

    return w.table("orders").select(
        key.alias("request_id"),
        lat(key).alias("pickup_lat"), lon(key).alias("pickup_lon"),
        lat(cust).alias("dropoff_lat"), lon(cust).alias("dropoff_lon"),
        B.plus_seconds(F.col("o_orderdate"), key * 37 % 86400).alias("requested_at"),
    )


# --- smaller operators --------------------------------------------------------------------

@query
def trip_explorer(w: Warehouse) -> DataFrame:
    paid = w.facts().where((F.col("trip_distance") > 0) & (F.col("fare_amount") > 0))
    span = P.date_between(paid, "picked_up_at", *SPAN)
    return span.select("trip_id", "picked_up_at", "trip_distance", "fare_amount", T.day_name("picked_up_at").alias("day_name"))


@query
def random_sample(w: Warehouse) -> DataFrame:
    # Sampling reads its input several times, so the span is stored first.
    span = stash(P.date_between(w.facts(), "picked_up_at", *SPAN), "span")
    return R.trip_sample(span, 1000, *SPAN, seed=SEED)


@query
def coverage_audit(w: Warehouse) -> DataFrame:
    return A.coverage(w.demand(), "pickup_cell", "timestamp_hour")


@query
def model_row_counts(w: Warehouse) -> DataFrame:
    # Trips are joined from their source once; every count comes with a pass that is needed anyway.
    rows = {"row_count": F.count(F.lit(1))}
    trips, of_trips = stash_observed(w.trips(), rows, "trips")
    facts = FA.fct_trips(trips, w.dates, w.locations, w.weather).select("pickup_cell", "picked_up_at")
    facts, of_facts = stash_observed(facts, rows, "facts")
    known = [("trips", of_trips["row_count"]), ("facts", of_facts["row_count"])]
    counted = w.spark.createDataFrame(known, "model string, row_count long")
    return counted.unionByName(A.row_counts({"demand": FA.hourly_demand(facts, w.dates, w.weather), "events": w.table("events")}))


@query
def quality_report(w: Warehouse) -> DataFrame:
    tagged, references = Q.known(
        w.trips().withColumn("__day", F.to_date("picked_up_at")),
        {"known weather": ("__day", w.weather, "weather_date"), "known pickup zone": ("pickup_location_id", w.locations, "zone_id")},
    )
    trips, of_trips = stash_observed(tagged, Q.violations(references), "trips")
    rows = FA.fct_trips(trips.select(w.trips().columns), w.dates, w.locations, w.weather)
    rows = rows.select("trip_id", "datetime_id", "passenger_count", "trip_duration_seconds")
    conditions = {
        "date present": F.col("datetime_id").isNotNull(),
        "passengers above one": F.col("passenger_count") > 1,
        "short trips": F.col("trip_duration_seconds") < 7200,
    }
    facts, of_facts = stash_observed(rows, Q.violations(conditions), "checked")
    unique = Q.report({"unique trip_id": Q.check_unique(facts, ["trip_id"]), "unique weather_date": Q.check_unique(w.weather, ["weather_date"])})
    return unique.unionByName(Q.counted_report(w.spark, {**of_trips, **of_facts}))


@query
def schema_check(w: Warehouse) -> DataFrame:
    expected = StructType([StructField("vendor_id", StringType()), StructField("trip_distance", StringType()), StructField("surge", StringType())])
    problems = Q.check_schema(w.trips(), expected)
    flagged = F.explode(F.array(*[F.lit(p) for p in problems]))
    # One row per problem next to the size of the checked table.
    return w.trips().agg(F.count(F.lit(1)).alias("row_count")).select("row_count", flagged.alias("problem"))


@query
def distinct_cells(w: Warehouse) -> DataFrame:
    return P.distinct_values(w.facts(), ["pickup_cell"], ordered=True)


@query
def surge_tiers(w: Warehouse) -> DataFrame:
    demand = w.table("orders").groupBy(F.to_date("o_orderdate").alias("day"), "o_orderpriority").agg(F.count(F.lit(1)).alias("demand"))
    return demand.withColumn("surge", S.surge(F.col("demand") * 4))


@query
def density_rank(w: Warehouse) -> DataFrame:
    return A.density(w.facts(), "pickup_cell", fixed.CELL_AREA_KM2, 10)


@query
def parent_cells(w: Warehouse) -> DataFrame:
    return A.rollup_cells(
        w.demand(), geo.coarse_cell("pickup_cell", 50), {"total_pickups": "total_pickups"}, {"avg_pickups": "total_pickups"}
    )


@query
def semi_join_active(w: Warehouse) -> DataFrame:
    active = w.facts().select(F.col("pickup_cell").alias("cell"))
    return J.where_exists(w.locations, active, "cell").select("zone_id", "zone_name", "cell")


@query
def last_hour_summary(w: Warehouse) -> DataFrame:
    scored = w.table("events").withColumn("surge", S.surge("value"))
    return A.realtime_summary(scored, "event_type", "ts", "value", "surge")


@query
def active_trips(w: Warehouse) -> DataFrame:
    return A.net_balance(w.table("events"), "user_id", "event_type", ["click", "view"], ["purchase"])


@query
def recent_feed(w: Warehouse) -> DataFrame:
    return I.recent_feed(w.table("events").select("event_id", "ts", "event_type", "value"), "ts", "5 hours", then=["event_id"])


@query
def trip_score(w: Warehouse) -> DataFrame:
    scored = W.share_of_max(stash(FA.zone_volume(w.facts())), "total_trips", "trip_score")
    return rounded(W.min_max(scored, "total_trips", "volume_score"), ["trip_score", "volume_score"])


@query
def top_parts_per_brand(w: Warehouse) -> DataFrame:
    by = [F.desc("p_retailprice"), F.asc("p_partkey")]
    return W.top_n_per_group(w.table("part"), "p_brand", by, 5).select("p_brand", "p_partkey", "p_retailprice")


@query
def segments_by_balance(w: Warehouse) -> DataFrame:
    named = W.name_by_rank(w.table("customer"), "c_mktsegment", "c_acctbal", fixed.CLUSTER_NAMES, "rank_name")
    return named.groupBy("c_mktsegment", "rank_name").agg(F.count(F.lit(1)).alias("customers"))


@query
def market_kpis(w: Warehouse) -> DataFrame:
    return A.kpis(w.table("orders"), "o_totalprice", "o_custkey")


@query
def tolerant_numbers(w: Warehouse) -> DataFrame:
    raw = F.when(F.col("event_id") % 7 == 0, F.lit("n/a")).otherwise(F.get_json_object("props", "$.k"))
    rows = w.table("events").withColumn("raw", raw)
    return rows.select(
        "event_id", S.to_number("raw").alias("number"),
        S.falsy_default(F.col("event_id") % 5, 9, "number").alias("not_zero"),
        S.falsy_default(F.when(F.col("event_id") % 2 == 0, F.lit("")).otherwise(F.col("event_type")), "none").alias("not_empty"),
    )


# --- models (no exact twin elsewhere) -----------------------------------------------------

@query
def demand_model_forecast(w: Warehouse) -> DataFrame:
    features = stash(w.event_features(), "features")
    return M.build_forecast(features, M.train_demand(features, SEED))


@query
def fare_model_quotes(w: Warehouse) -> DataFrame:
    model = M.train_fare(training_set(w, 0.1), SEED)
    quotes = M.quote_fares(
        quote_requests(w), R.live_conditions(w.weather_documents()), trip_forecast(w), model, "2004-11-30 12:00:00"
    )
    return quotes.select("request_id", "pickup_cell", "dropoff_cell", "trip_distance", "predicted_fare_amount")


@query
def zone_standardized(w: Warehouse) -> DataFrame:
    scaled, names = M.standardize(stash(zone_table(w)), M.PCA_FEATURES)
    return rounded(scaled.select("pickup_cell", *[F.col(z).alias(f"z_{c}") for c, z in names.items()]), [f"z_{c}" for c in names])


def pca_of(w: Warehouse) -> dict[str, DataFrame]:
    """Components and clusters of the zones, computed once for all queries that show them."""
    if "pca" not in w.reports:
        w.reports["pca"] = M.pca_report(zone_table(w))
    return w.reports["pca"]


@query
def pca_zones(w: Warehouse) -> DataFrame:
    return pca_of(w)["zones"]


@query
def pca_loadings(w: Warehouse) -> DataFrame:
    return pca_of(w)["loadings"]


@query
def pca_checks(w: Warehouse) -> DataFrame:
    return pca_of(w)["checks"]


@query
def cluster_stats(w: Warehouse) -> DataFrame:
    return pca_of(w)["stats"]


def split_features(w: Warehouse) -> DataFrame:
    known = P.require_not_null(w.event_features(), M.LAG_COLUMNS)
    return M.hold_out(known, 0.1, SEED, M.DEMAND_KEYS)


@query
def training_matrix(w: Warehouse) -> DataFrame:
    """Training and held-out rows with the mean demand of their cell in other parts of the rows."""
    rows = M.fold_means(split_features(w), "pickup_cell", "total_pickups", "cell_mean", SEED, M.DEMAND_KEYS)
    return rounded(rows.select("pickup_cell", "timestamp_hour", "is_validation", F.col("__fold").alias("fold"), "cell_mean"), ["cell_mean"])


@query
def split_check(w: Warehouse) -> DataFrame:
    return split_features(w).groupBy("pickup_cell", "is_validation").agg(F.count(F.lit(1)).alias("n"))


# --- streams ------------------------------------------------------------------------------

def event_stream(w: Warehouse) -> DataFrame:
    # A file source wants a folder or a glob, hence the bracket.
    return TB.read_stream(w.spark, f"{w.folder.rstrip('/')}/event[s].parquet", w.table("events").schema)


def topic(w: Warehouse, messages: DataFrame) -> DataFrame:
    """Publishes messages to a folder and opens a stream on it."""
    path = scratch_path(w.spark, "topic")
    messages.write.parquet(path)
    return TB.read_stream(w.spark, path, messages.schema)


def trip_messages(w: Warehouse) -> DataFrame:
    return topic(w, B.message_values(B.trip_message_fields(w.table("events")), S.base64_text))


@query
def stream_ingest_trips(w: Warehouse) -> DataFrame:
    rows = I.ingest_trips(trip_messages(w), as_of="2024-02-01 00:00:00")
    return SF.scratch_landing(rows, "trips").drop("processing_timestamp")


@query
def stream_bad_messages(w: Warehouse) -> DataFrame:
    _, bad = I.split_bad(I.parse_trips(trip_messages(w)))
    kind = F.when(F.try_parse_json("message").isNull(), "broken").otherwise("incomplete").alias("kind")
    return I.drain(bad, "bad").groupBy(kind).agg(F.count(F.lit(1)).alias("n"))


@query
def stream_ingest_weather(w: Warehouse) -> DataFrame:
    docs = topic(w, w.weather_documents().select(S.base64_text("raw_json").alias("value")))
    landed = I.drain(I.ingest_raw_json(docs, as_of="2024-02-01 00:00:00"), "weather")
    return ST.stg_weather_json(landed)


PARTS = 5


def in_parts(w: Warehouse, run: Callable[[DataFrame], None]) -> None:
    """Events arrive in five parts of six days each, every seventh event one part late; `run`
    gets a stream over what has arrived so far after each part."""
    events, path = w.table("events"), scratch_path(w.spark, "arrived")
    days = F.datediff(F.to_date("ts"), F.to_date(events.agg(F.min("ts")).scalar()))
    part = F.floor(days / 6) + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)
    events = events.withColumn("part", F.least(part, F.lit(PARTS - 1)))
    for n in range(PARTS):
        events.where(F.col("part") == n).drop("part").write.mode("append").parquet(path)
        run(TB.read_stream(w.spark, path, w.table("events").schema))


@query
def stream_window_summary(w: Warehouse) -> DataFrame:
    path = scratch_path(w.spark, "activity")
    in_parts(w, lambda s: SF.summarize_windows(s, path, f"{path}-checkpoint", "ts", "event_type", "value").awaitTermination())
    return SF.window_summary(w.spark, path, "event_type", "value", with_late=True)


@query
def stream_active_trips(w: Warehouse) -> DataFrame:
    path = scratch_path(w.spark, "active")
    ended = F.col("active_trips") == 0

    def run(stream: DataFrame) -> None:
        balance = SF.running_balance(stream, "user_id", "event_type", ["click", "view"], ["purchase"], "active_trips")
        SF.write_latest(balance, path, f"{path}-checkpoint", ["user_id"], ended, compact_every=2).awaitTermination()

    in_parts(w, run)
    known = SF.latest(w.spark, path, ["user_id"]).where(~ended).select("user_id", "active_trips")
    # What the stream's state holds after the last part, next to what it has reported.
    return known.join(SF.stored_balances(w.spark, f"{path}-checkpoint").withColumnRenamed("n", "in_state"), "user_id", "full")


@query
def stream_scored_events(w: Warehouse) -> DataFrame:
    features = stash(w.event_features(), "features")
    model = M.train_demand(features, SEED)
    live = topic(w, features)
    return I.drain(I.score_stream(live, model), "scored").select(
        "pickup_cell", "timestamp_hour", "predicted_total_pickups", "surge"
    )


@query
def message_roundtrip(w: Warehouse) -> DataFrame:
    fields = B.trip_message_fields(w.table("events")).drop("event_id").where(F.col("fare_amount").isNotNull())
    return I.ingest_trips(stash(K.to_messages(fields)), as_of="2024-02-01 00:00:00").drop("processing_timestamp")


def raw_event_trips(w: Warehouse) -> DataFrame:
    """Trip records from events, as the replay reads them."""
    fields = B.trip_message_fields(w.table("events"))
    return fields.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("pickup_datetime", "dropoff_datetime")}).withColumn("airport_fee", F.lit(0.0))


@query
def replay_rows(w: Warehouse) -> DataFrame:
    """The whole day; `replay_sample` draws from it."""
    rows = I.replay_rows(raw_event_trips(w), "2028-01-11", None, 1461, 1462, SEED, ["event_id"])
    return rows.select("event_id", "pickup_datetime", "rate_code", "payment_type", "extra", "tip_amount", "tolls_amount")


@query
def replay_sample(w: Warehouse) -> DataFrame:
    messages = I.replay_batch(raw_event_trips(w), "2028-01-11", 50, 1461, 1462, SEED, ["event_id"])
    return I.ingest_trips(stash(messages), as_of="2024-02-01 00:00:00")


# --- sinks --------------------------------------------------------------------------------

@query
def sink_roundtrip(w: Warehouse) -> DataFrame:
    daily = K.with_day(w.table("events"), "ts", "day")
    path = scratch_path(w.spark, "sink")
    return K.materialize(daily, path, ["day"], ["event_type"]).groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query
def retention(w: Warehouse) -> DataFrame:
    table = SnapshotTable(w.spark, scratch_path(w.spark, "retention"), ["day"])
    table.replace(K.with_day(w.table("events"), "ts", "day"))
    table.expire("day", 10, "2024-01-30")
    table.clean_up()
    # Everything that lies in storage is read, whether the table's version names it or not.
    stored = w.spark.read.parquet(table.path)
    rows = stored.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("folders_left", F.lit(len({f.split("/")[0] for f in table.folders()})))


@query
def snapshot_replace(w: Warehouse) -> DataFrame:
    """A table, one day of it replaced, rows added twice by one batch, and days in many folders joined."""
    table = SnapshotTable(w.spark, scratch_path(w.spark, "snapshots"), ["day"])
    daily = K.with_day(w.table("events"), "ts", "day")
    table.replace(daily.where(F.col("event_type") != "error"))
    table.replace_partitions(daily.where(F.col("day") == F.lit("2024-01-10").cast("date")))
    for _ in range(2):
        table.append(daily.where((F.col("event_type") == "error") & (F.col("user_id") % 2 == 0)), "errors", 0)
    table.compact()
    out = table.read().groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("folders", F.lit(len(table.current()["folders"])))


@query
def backfill_load(w: Warehouse) -> DataFrame:
    spark, path = w.spark, scratch_path(w.spark, "landing")
    schema = StructType.fromDDL(TB.TRIP_SCHEMA + ", processing_timestamp timestamp_ntz")
    K.ensure_table(spark, path, schema)
    few = w.raw_trips().drop("extra", "mta_tax", "tip_amount", "tolls_amount", "imp_surcharge", "airport_fee")
    audit = ST.backfill(few, path, schema, "2000-01-01", "2000-12-31", SHIFT_DAYS, as_of="2024-02-01 00:00:00")
    paid = S.earnings("fare_amount", "tip_amount", "extra", "tolls_amount")
    known = spark.read.schema(schema).parquet(path).agg(F.count(paid)).scalar()
    return audit.withColumn("with_earnings", known)


@query
def backfill_sample(w: Warehouse) -> DataFrame:
    path = scratch_path(w.spark, "landing")
    schema = StructType.fromDDL(TB.TRIP_SCHEMA + ", processing_timestamp timestamp_ntz")
    K.ensure_table(w.spark, path, schema)
    span = stash(P.date_between(w.raw_trips(), "pickup_datetime", "2000-01-01", "2000-12-31"), "span")
    keys = ["pickup_datetime", "dropoff_datetime", "passenger_count", "pickup_location_id", "dropoff_location_id"]
    ST.backfill(span, path, schema, "2000-01-01", "2000-12-31", SHIFT_DAYS, 400, SEED, keys, as_of="2024-02-01 00:00:00")
    return w.spark.read.schema(schema).parquet(path).select(*keys, "total_amount", "fare_amount", "airport_fee", "processing_timestamp")


@query
def warehouse_build(w: Warehouse) -> DataFrame:
    built, checks = build_all(
        w.spark, w.trips(), w.zones(), w.weather_sources(), ST.stg_events(w.calendar(), SHIFT_YEARS),
        scratch_path(w.spark, "warehouse"), CALENDAR, SPAN, SEED,
    )
    failed = checks.select(F.concat(F.lit("check "), "check_name").alias("model"), F.col("violations").alias("row_count"))
    return build_report(built).unionByName(failed)


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return REGISTRY["hourly_features"](spark, folder)
