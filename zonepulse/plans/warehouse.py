"""All tables that follow from one folder of given tables, and the daily build over them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property, wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonepulse.operators import quality
from zonepulse.operators.aggregates import row_counts
from zonepulse.plans import dimensions, facts, models, staging
from zonepulse.plans.store import ModelStore
from zonepulse.session import stash
from zonepulse.sources import bindings
from zonepulse.sources.sinks import as_view, layer_path
from zonepulse.sources.snapshots import SnapshotTable

SHIFT_DAYS = 1462
SHIFT_YEARS = 4
CALENDAR = ("1999-01-01", "2005-12-31")
EVENT_YEARS = 24
EVENT_CALENDAR = ("2024-01-01", "2024-12-31")


def defined_once(define: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """Keeps the definition of a lazy frame; its data is computed anew by every query."""

    @wraps(define)
    def get(self: Warehouse) -> DataFrame:
        if define.__name__ not in self.defined:
            self.defined[define.__name__] = define(self)
        return self.defined[define.__name__]

    return get


class Warehouse:
    """Staging and facts are lazy frames, dimensions are stored tables.

    Stored dimensions are built once per instance; their true size lets Spark broadcast them
    only while they are small.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.defined: dict[str, DataFrame] = {}
        self.reports: dict[str, dict[str, DataFrame]] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self.defined:
            self.defined[name] = bindings.table(self.spark, self.folder, name)
        return self.defined[name]

    # sources

    @defined_once
    def raw_trips(self) -> DataFrame:
        return bindings.raw_trips(self.table("lineitem"), self.table("orders"))

    @defined_once
    def zones(self) -> DataFrame:
        return bindings.zones(self.table("nation"), self.table("region"))

    @defined_once
    def stations(self) -> DataFrame:
        return bindings.stations(self.table("orders"))

    @defined_once
    def calendar(self) -> DataFrame:
        return bindings.calendar_events(self.table("orders"))

    @defined_once
    def weather_documents(self) -> DataFrame:
        return bindings.weather_documents(self.table("events"))

    # staging

    @defined_once
    def trips(self) -> DataFrame:
        return staging.batch_trips(self.raw_trips(), SHIFT_DAYS)

    @defined_once
    def weather_sources(self) -> DataFrame:
        return staging.weather_unified(
            staging.station_rollup(self.stations(), SHIFT_YEARS),
            staging.stg_weather_json(self.weather_documents()),
        )

    # dimensions of the trips

    @cached_property
    def dates(self) -> DataFrame:
        marked = staging.stg_events(self.calendar(), SHIFT_YEARS)
        return stash(dimensions.dim_datetime(self.spark, marked, *CALENDAR), "dim_datetime")

    @cached_property
    def locations(self) -> DataFrame:
        return stash(dimensions.dim_location(self.zones()), "dim_location")

    @cached_property
    def weather(self) -> DataFrame:
        return stash(dimensions.dim_weather(self.weather_sources()), "dim_weather")

    # facts

    @defined_once
    def facts(self) -> DataFrame:
        return facts.fct_trips(self.trips(), self.dates, self.locations, self.weather)

    @defined_once
    def demand(self) -> DataFrame:
        return facts.hourly_demand(self.facts(), self.dates, self.weather)

    @defined_once
    def features(self) -> DataFrame:
        return facts.hourly_features(self.demand(), self.dates)

    # the dense series: event types as cells

    @cached_property
    def event_dates(self) -> DataFrame:
        marked = staging.stg_events(self.calendar(), EVENT_YEARS)
        return stash(dimensions.dim_datetime(self.spark, marked, *EVENT_CALENDAR), "event_dates")

    @defined_once
    def event_facts(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_type").alias("pickup_cell"), F.col("ts").alias("picked_up_at")
        )

    @defined_once
    def event_demand(self) -> DataFrame:
        return facts.hourly_demand(self.event_facts(), self.event_dates, self.weather)

    def event_features(self, block_rows: int | None = None) -> DataFrame:
        return facts.hourly_features(self.event_demand(), self.event_dates, block_rows=block_rows)


_OPEN: dict[tuple[str, str], Warehouse] = {}


def open_warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse of a folder, one per application so that dimensions are stored once."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _OPEN:
        _OPEN[key] = Warehouse(spark, folder)
    return _OPEN[key]


# Layer and storage of every model: views stay lazy, tables are written.
MODELS = {
    "stg_trips": ("staging", "view"),
    "stg_weather": ("staging", "view"),
    "dim_datetime": ("dimensions", "table"),
    "dim_location": ("dimensions", "table"),
    "dim_weather": ("dimensions", "table"),
    "fct_trips": ("facts", "table"),
    "agg_hourly_demand": ("facts", "table"),
    "fct_hourly_features": ("facts", "table"),
    "fct_fare_training": ("facts", "view"),
    "fct_zone_features": ("facts", "table"),
    "hourly_demand_forecast": ("predictions", "table"),
}


def build_all(
    spark: SparkSession, trips: DataFrame, zones: DataFrame, weather: DataFrame, events: DataFrame,
    out_dir: str, calendar: tuple[str, str], zone_span: tuple[str, str], seed: int = 42,
    iterations: int = 50, fare_iterations: int = 20,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The daily build: layers in order, training, the forecast, then checks.

    Takes staged trips, weather and events. Returns the models by name and the check report.
    Failed checks are reported and do not stop the build. Facts are stored where several
    models read them. Tables are replaced as a whole: until a model's new version is there,
    readers see the old one, also if the build fails. Both models are stored in `out_dir`/models,
    and the forecast comes from the one read back. Without rows to train on, a failed check says
    so and the model of the last build stays in use; without any the forecast is empty.
    """

    def keep(name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        layer, kind = MODELS[name]
        if kind == "view":
            return as_view(df, f"{layer}_{name}")
        table = SnapshotTable(spark, layer_path(out_dir, layer, name), partition_by)
        return table.replace_partitions(df) if partition_by else table.replace(df)

    built = {"stg_trips": keep("stg_trips", trips), "stg_weather": keep("stg_weather", weather)}
    dates = keep("dim_datetime", dimensions.dim_datetime(spark, events, *calendar))
    places = keep("dim_location", dimensions.dim_location(zones))
    sky = keep("dim_weather", dimensions.dim_weather(weather))
    trip_facts = keep("fct_trips", facts.fct_trips(trips, dates, places, sky))
    demand = keep("agg_hourly_demand", facts.hourly_demand(trip_facts, dates, sky))
    features = keep("fct_hourly_features", facts.hourly_features(demand, dates))
    training = keep("fct_fare_training", facts.fare_training(trip_facts, dates, sky, demand, 0.1, seed))
    zone_rows = keep(
        "fct_zone_features", facts.zone_features(trip_facts, features, places, *zone_span),
        partition_by=["created_at"],
    )
    store = ModelStore(spark, f"{out_dir}/models")
    recent, label = models.recent_rows(features), "predicted_total_pickups"
    known = models.require_not_null(features, models.LAG_COLUMNS)
    untrained = {"demand model trained": int(known.isEmpty()), "fare model trained": int(training.isEmpty())}
    if not untrained["demand model trained"]:
        fresh = models.train_demand(features, seed, iterations=iterations)
        store.save("demand", fresh, seed=seed, iterations=iterations)
    if not untrained["fare model trained"]:
        store.save("fare", models.train_fare(training, seed, fare_iterations), seed=seed, iterations=fare_iterations)
    if store.facts("demand"):
        # Without enough history the model of an earlier build still serves.
        stored = store.load("demand")
        forecast = models.build_forecast(features, stored)
        before = fresh if not untrained["demand model trained"] else stored
        both = models.predict(stored, models.predict(before, recent).withColumnRenamed(label, "__before"), keep="__before")
    else:
        both = recent.limit(0).withColumns({label: F.lit(0.0), "__before": F.lit(0.0)})
        forecast = models.score_back(features, both.drop("__before"))
    fares = models.predict(store.load("fare"), training) if store.facts("fare") else training.withColumn("predicted_fare_amount", F.lit(0.0))
    built |= {
        "dim_datetime": dates, "dim_location": places, "dim_weather": sky, "fct_trips": trip_facts,
        "agg_hourly_demand": demand, "fct_hourly_features": features,
        "fct_fare_training": training, "fct_zone_features": zone_rows,
        "hourly_demand_forecast": keep("hourly_demand_forecast", forecast),
    }
    checks = quality.report(
        {
            "dim_datetime unique": quality.check_unique(dates, ["date_id"]),
            "dim_location unique": quality.check_unique(places, ["zone_id"]),
            "dim_location cell unique": quality.check_unique(places, ["cell"]),
            "dim_weather unique": quality.check_unique(sky, ["weather_date"]),
            "fct_trips weather known": quality.check_reference(trip_facts, sky, "weather_date", "weather_date"),
            "stored demand model predicts alike": both.where(~F.col(label).eqNullSafe(F.col("__before"))),
        }
    ).unionByName(
        quality.condition_report(
            trip_facts,
            {
                "fct_trips keys present": F.col("trip_id").isNotNull() & F.col("pickup_cell").isNotNull() & F.col("weather_date").isNotNull(),
                "fct_trips passengers": F.col("passenger_count") > 0,
            },
        )
    ).unionByName(quality.condition_report(fares, {"fares predicted": F.col("predicted_fare_amount").isNotNull()}))
    checks = checks.unionByName(quality.counted_report(spark, untrained))
    return built, checks


def build_report(built: dict[str, DataFrame]) -> DataFrame:
    return row_counts(built)
