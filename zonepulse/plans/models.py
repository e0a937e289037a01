"""Boosted-tree demand and fare models, forecasts, quotes, principal components, clusters."""

from __future__ import annotations

import math
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import (
    PCA, Imputer, PCAModel, SQLTransformer, StringIndexer, StringIndexerModel, TargetEncoder, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, StringType

from zonepulse.functions import fixed
from zonepulse.functions.geo import cell_id, est_seconds, haversine_miles
from zonepulse.functions.scalars import DRAW_BITS, draw, round_to
from zonepulse.functions.times import dow, is_weekend
from zonepulse.operators.aggregates import WIDE, exact_avg
from zonepulse.operators.joins import join_predictions
from zonepulse.operators.prep import last_interval, require_not_null
from zonepulse.operators.windows import correlation_sign, min_max, name_by_rank, share_of_max, top_n_per_group
from zonepulse.session import stash
from zonepulse.sources.tables import hour_spine

DEMAND_FEATURES = (
    "pickup_cell", "hour_of_day", "day_of_week",
    "pickups_1h_ago", "pickups_24h_ago", "pickups_1week_ago",
    "avg_pickups_7h", "avg_pickups_24h",
    "avg_temp_celsius", "total_precipitation_mm", "had_rain", "had_snow",
    "is_weekend", "is_holiday",
    "pickups_change_24h", "rain_during_rush_hour",
    "month", "quarter", "day_of_year",
)
LAG_COLUMNS = ("pickups_1h_ago", "pickups_24h_ago", "pickups_1week_ago")

#: Parts of the training rows between which target means are exchanged, and the weight in rows
#: of the overall mean in a category's mean.
FOLDS, SMOOTHING = 5, 10.0
DEMAND_KEYS = ("pickup_cell", "timestamp_hour")


def hold_out(df: DataFrame, share: float, seed: int, keys: Sequence[str], out: str = "is_validation") -> DataFrame:
    """Marks a share of the rows as held out, by a draw of their keys. The share is the same for
    any number of rows, and a task that runs again decides alike."""
    return df.withColumn(out, draw(seed, *keys) < int(share * (1 << DRAW_BITS)))


def fold_means(
    df: DataFrame, category: str, label: str, out: str, seed: int, keys: Sequence[str],
    held_out: str = "is_validation", folds: int = FOLDS, smoothing: float = SMOOTHING,
) -> DataFrame:
    """Mean label of each row's category, without the row's own part of the rows.

    Rows are dealt to `folds` parts by a draw of their keys; a row's mean comes from the other
    parts, drawn towards their overall mean as if `smoothing` more rows had that. Held-out rows
    are in no part and get the mean of all of them. Adds `__fold` as well. Only sums per category
    and part meet the rows.
    """
    fold = F.when(~F.col(held_out), draw(seed + 1, *keys) % folds).otherwise(F.lit(-1))
    rows = df.withColumn("__fold", fold)
    sums = rows.where("__fold >= 0").groupBy(category, "__fold").agg(F.count(label).alias("__n"), F.sum(F.col(label).cast("double")).alias("__s"))
    total = sums.groupBy(category).agg(F.sum("__n").alias("__n"), F.sum("__s").alias("__s"))
    # Of every category: its rows outside each part, and all of them for the held-out rows.
    parts = total.select(category, "__n", "__s", F.explode(F.array(*[F.lit(f).cast("long") for f in range(-1, folds)])).alias("__fold"))
    own = sums.select(category, "__fold", F.col("__n").alias("__n_own"), F.col("__s").alias("__s_own"))
    of_fold = sums.groupBy("__fold").agg(F.sum("__n").alias("__n_own"), F.sum("__s").alias("__s_own"))
    whole = sums.agg(F.sum("__n").alias("__n"), F.sum("__s").alias("__s"))
    spine = df.sparkSession.range(-1, folds).withColumnRenamed("id", "__fold").join(of_fold, "__fold", "left")
    less = {c: F.col(c) - F.coalesce(f"{c}_own", F.lit(0)) for c in ("__n", "__s")}
    overall = spine.withColumns({c: whole.select(c).scalar() for c in ("__n", "__s")}).withColumns(less)
    overall = overall.select("__fold", F.try_divide("__s", "__n").alias("__all"))
    means = parts.join(own, [category, "__fold"], "left").withColumns(less).select(F.col(category).alias("__c"), "__fold", "__n", "__s")
    found = rows.withColumn("__c", F.col(category)).join(means, ["__c", "__fold"], "left").join(overall, "__fold", "left")
    weight = F.lit(float(smoothing))
    value = (F.coalesce("__s", F.lit(0.0)) + weight * F.col("__all")) / (F.coalesce("__n", F.lit(0)) + weight)
    return found.withColumn(out, value).drop("__c", "__n", "__s", "__all")


def train_trees(
    df: DataFrame, label: str, features: Sequence[str], seed: int, iterations: int = 50,
    depth: int = 6, step: float = 0.3, min_progress: float | None = 0.01,
    share_held_out: float = 0.1, keys: Sequence[str] | None = None, categorical: Sequence[str] = (),
) -> PipelineModel:
    """Boosted regression trees with automatic encoding of the features.

    Flags become numbers (unknown apart), missing numbers their mean. A text becomes the mean
    label of its category, or a category of the trees if it is named in `categorical`. Encoders
    are fitted without the held-out rows, and the rows that train see target means from other
    parts of the rows. With `min_progress` training stops once the held-out error improves by
    less than that share. `keys` tell rows apart in the draws (default: all features).
    """
    keys = list(keys or features)
    columns = list(dict.fromkeys([label, *features, *keys]))
    # Rebalanced, so that small sets are not trained in as many tasks as wrote them.
    data = stash(hold_out(df.select(*columns), share_held_out, seed, keys, "__held_out").hint("rebalance"), "train")
    if data.isEmpty():
        raise ValueError("no rows to train on")
    texts = [f for f in features if isinstance(data.schema[f].dataType, StringType)]
    flags = [f for f in features if isinstance(data.schema[f].dataType, BooleanType)]
    numbers = [f for f in features if f not in texts and f not in flags]
    means = [f for f in texts if f not in categorical]
    exprs = [f"CAST(`{f}` AS double) AS `__n_{f}`" for f in numbers]
    exprs += [f"COALESCE(CAST(CAST(`{f}` AS int) AS double), -1.0D) AS `__b_{f}`" for f in flags]
    stages: list = [SQLTransformer(statement=f"SELECT {', '.join(['*', *exprs])} FROM __THIS__")]
    if numbers:
        stages.append(Imputer(inputCols=[f"__n_{f}" for f in numbers], outputCols=[f"__i_{f}" for f in numbers]))
    stages += [StringIndexer(inputCol=f, outputCol=f"__c_{f}", handleInvalid="keep") for f in texts]
    for f in means:
        stages.append(
            TargetEncoder(
                inputCol=f"__c_{f}", outputCol=f"__m_{f}", labelCol="__label", targetType="continuous",
                handleInvalid="keep", smoothing=SMOOTHING,
            )
        )
        # The sum drops the mark of a category: the mean label is a plain number.
        stages.append(SQLTransformer(statement=f"SELECT *, `__m_{f}` + 0.0D AS `__t_{f}` FROM __THIS__"))
    labelled = data.withColumn("__label", F.col(label).cast("double"))
    train = labelled.where(~F.col("__held_out"))
    if train.isEmpty():
        raise ValueError("no rows to train on")
    encoders = Pipeline(stages=stages).fit(train)
    encoded = encoders.transform(labelled)
    for f in means:
        encoded = fold_means(encoded.drop(f"__t_{f}"), f, "__label", f"__t_{f}", seed, keys, "__held_out").drop("__fold")
    inputs = [f"__i_{f}" for f in numbers] + [f"__b_{f}" for f in flags]
    inputs += [f"__t_{f}" if f in means else f"__c_{f}" for f in texts]
    assembler = VectorAssembler(inputCols=inputs, outputCol="__features", handleInvalid="keep")
    ready = stash(assembler.transform(encoded).select("__features", "__label", "__held_out").hint("rebalance"), "matrix")
    sizes = [len(m.labels) for m in encoders.stages if isinstance(m, StringIndexerModel) and m.getInputCol() in categorical]
    held_out = {}
    if min_progress is not None and not ready.where("__held_out").isEmpty():
        held_out = {"validationIndicatorCol": "__held_out", "validationTol": min_progress}
    trees = GBTRegressor(
        featuresCol="__features", labelCol="__label", predictionCol=f"predicted_{label}",
        maxIter=iterations, maxDepth=depth, stepSize=step, maxBins=max(32, *[n + 1 for n in sizes], 32), seed=seed,
        maxMemoryInMB=512, **held_out,
    )
    return PipelineModel([*encoders.stages, assembler, trees.fit(ready)])


def predict(model: PipelineModel, df: DataFrame, keep: str | None = None) -> DataFrame:
    """Adds predicted_<label>; the model's helper columns are removed again, all but `keep`."""
    out = model.transform(df)
    return out.drop(*[c for c in out.columns if c.startswith("__") and c != keep])


def train_demand(
    features: DataFrame, seed: int, require_lags: Sequence[str] = LAG_COLUMNS,
    columns: Sequence[str] = DEMAND_FEATURES, iterations: int = 50,
) -> PipelineModel:
    """Pickups per cell and hour. Only rows with the required lags take part.

    The default columns include the daily change, which together with the lag gives the label
    away; pass other columns for an honest model.
    """
    return train_trees(require_not_null(features, require_lags), "total_pickups", columns, seed, iterations, keys=DEMAND_KEYS)


def train_fare(training: DataFrame, seed: int, iterations: int = 20) -> PipelineModel:
    """Fare from every other column of the training set."""
    columns = [c for c in training.columns if c != "fare_amount"]
    return train_trees(training, "fare_amount", columns, seed, iterations)


def hour_key(ts: str = "timestamp_hour") -> Column:
    return F.hour(ts)


FORECAST_KEYS = ("pickup_cell", "hour", "day_of_week")
KEY_COLUMNS = {
    "pickup_cell": lambda: F.col("pickup_cell"),
    "hour": hour_key,
    "day_of_week": lambda: dow("timestamp_hour"),
    "timestamp_hour": lambda: F.col("timestamp_hour"),
}


def score_back(features: DataFrame, predictions: DataFrame, on: Sequence[str] = FORECAST_KEYS) -> DataFrame:
    """Predictions next to every hour that shares the keys."""
    keys = [(name, KEY_COLUMNS[name](), KEY_COLUMNS[name]()) for name in on]
    return join_predictions(features, predictions, keys).select(
        "timestamp_hour", "pickup_cell", F.col("total_pickups").alias("actual_pickups"),
        "predicted_total_pickups", "avg_temp_celsius", "had_rain", "is_weekend", "is_holiday",
    )


def recent_rows(features: DataFrame, as_of=None) -> DataFrame:
    """The last 24 hours with a known daily lag."""
    return require_not_null(last_interval(features, "timestamp_hour", "24 hours", as_of), ["pickups_24h_ago"])


def build_forecast(
    features: DataFrame, model: PipelineModel, as_of=None, on: Sequence[str] = FORECAST_KEYS
) -> DataFrame:
    """Scores the last 24 hours with a known daily lag and joins the scores back.

    `as_of` None means the latest hour in the table. Predictions are at most a day's rows per
    cell, so each past hour meets one or two of them.
    """
    return score_back(features, predict(model, recent_rows(features, as_of)), on)


def quote_features(requests: DataFrame, conditions: DataFrame, forecast: DataFrame, as_of=None) -> DataFrame:
    """Model inputs for quote requests (pickup and dropoff coordinates, requested_at)."""
    recent = last_interval(forecast, "timestamp_hour", "24 hours", as_of)
    demand = recent.groupBy("pickup_cell").agg(
        exact_avg("predicted_total_pickups", WIDE).alias("__demand")
    )
    temperature = conditions.select(F.col("temperature_celsius")).scalar()
    miles = haversine_miles("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon")
    known = requests.withColumns(
        {
            "pickup_cell": cell_id("pickup_lon", "pickup_lat"),
            "dropoff_cell": cell_id("dropoff_lon", "dropoff_lat"),
            "__miles": miles,
        }
    )
    return known.join(demand, "pickup_cell", "left").withColumns(
        {
            "passenger_count": F.lit(1).cast("long"),
            "trip_distance": round_to("__miles", 2),
            "trip_duration_seconds": round_to(est_seconds("__miles"), 0).cast("long"),
            "hour_of_day": F.hour("requested_at"),
            "day_of_week": dow("requested_at"),
            "is_holiday": F.lit(False),
            "is_weekend": is_weekend("requested_at"),
            "avg_temp_celsius": round_to(F.coalesce(temperature, F.lit(20.0)), 2),
            "total_precipitation_mm": F.lit(0.0),
            "had_rain": F.lit(False),
            "had_snow": F.lit(False),
            "historical_demand": round_to(F.coalesce("__demand", F.lit(10.0)), 0).cast("long"),
        }
    ).drop("__demand", "__miles")


def quote_fares(
    requests: DataFrame, conditions: DataFrame, forecast: DataFrame, model: PipelineModel, as_of=None
) -> DataFrame:
    return predict(model, quote_features(requests, conditions, forecast, as_of))


def seasonal_profile(demand: DataFrame, cell: str = "pickup_cell") -> DataFrame:
    """Mean pickups of each cell by weekday and hour."""
    return demand.groupBy(
        cell, dow("timestamp_hour").alias("day_of_week"), F.hour("timestamp_hour").alias("hour_of_day")
    ).agg(F.avg("total_pickups").alias("expected_pickups"))


def forecast_horizon(demand: DataFrame, horizon: int = 24, cell: str = "pickup_cell") -> DataFrame:
    """The next `horizon` hours of each cell from its weekday and hour profile; hours without
    a profile take the cell's mean."""
    profile = seasonal_profile(demand, cell)
    last = demand.agg(F.max("timestamp_hour")).scalar()
    means = demand.groupBy(cell).agg(F.avg("total_pickups").alias("__mean"))
    future = means.select(cell, "__mean", hour_spine(last, horizon, "timestamp_hour")).withColumns(
        {"day_of_week": dow("timestamp_hour"), "hour_of_day": F.hour("timestamp_hour")}
    )
    out = future.join(profile, [cell, "day_of_week", "hour_of_day"], "left")
    return out.select(
        cell, "timestamp_hour", "day_of_week", "hour_of_day",
        F.coalesce("expected_pickups", "__mean").alias("predicted_pickups"),
    )


# --- principal components and clusters ----------------------------------------------------

PCA_FEATURES = ("total_trips", "avg_hourly_demand", "trips_per_km2", "weekend_ratio")


def standardize(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """Zero mean and unit population deviation; a constant column becomes all zero."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
    stats = df.agg(*aggs).first()
    names = {c: f"__z_{c}" for c in cols}
    scaled = {
        names[c]: (F.col(c).cast("double") - stats[f"m_{c}"]) / (stats[f"s_{c}"] or 1.0) for c in cols
    }
    return df.withColumns(scaled), names


def pca_scores(df: DataFrame, cols: Sequence[str] = PCA_FEATURES, k: int = 2) -> tuple[DataFrame, PCAModel]:
    """Rows without gaps in the features, with PC1..PCk. PC1 rises with the first feature."""
    clean = stash(df.dropna(subset=list(cols)), "pca")
    scaled, names = standardize(clean, cols)
    vectors = VectorAssembler(inputCols=list(names.values()), outputCol="__x").transform(scaled)
    model = PCA(k=k, inputCol="__x", outputCol="__pc").fit(vectors)
    parts = vector_to_array("__pc")
    out = model.transform(vectors).withColumns({f"PC{i + 1}": parts[i] for i in range(k)})
    out = out.drop("__x", "__pc", *names.values())
    return out.withColumn("PC1", F.col("PC1") * correlation_sign(out, "PC1", cols[0])), model


def pca_explained(model: PCAModel, df: DataFrame) -> DataFrame:
    rows = [(f"PC{i + 1}", float(v)) for i, v in enumerate(model.explainedVariance.toArray())]
    return df.sparkSession.createDataFrame(rows, "component string, explained_ratio double")


def pca_loadings(model: PCAModel, cols: Sequence[str], df: DataFrame) -> DataFrame:
    """Weight of every feature in every component."""
    weights = model.pc.toArray()
    rows = [(c, f"PC{j + 1}", float(weights[i][j])) for i, c in enumerate(cols) for j in range(weights.shape[1])]
    return df.sparkSession.createDataFrame(rows, "feature string, component string, loading double")


def cluster(df: DataFrame, cols: Sequence[str], k: int = 4, restarts: int = 10, seed: int = 42, out: str = "cluster") -> tuple[DataFrame, list[KMeansModel]]:
    """K-means with several starts: rows by the one with the least cost, and all, best first.

    The starts are independent jobs, a few of which run at a time.
    """
    vectors = VectorAssembler(inputCols=list(cols), outputCol="__x").transform(df)
    points = stash(vectors.select("__x").hint("rebalance"), "points")

    def fit(start: int) -> KMeansModel:
        return KMeans(k=k, seed=seed + start, featuresCol="__x", predictionCol=out, maxIter=50).fit(points)

    with ThreadPool(min(4, restarts)) as pool:
        fitted = pool.map(inheritable_thread_target(df.sparkSession)(fit), range(restarts))
    fitted.sort(key=lambda m: m.summary.trainingCost)
    return fitted[0].transform(vectors).drop("__x"), fitted


def cluster_stats(df: DataFrame, key: str = "pickup_cell") -> DataFrame:
    """Zones, trips and rounded means of each named cluster."""
    means = {
        "avg_hourly_demand": "avg_hourly_demand", "avg_demand_score": "demand_score",
        "weekend_ratio": "weekend_ratio", "morning_rush": "morning_rush_demand",
        "evening_rush": "evening_rush_demand", "night_demand": "night_demand",
    }
    return df.groupBy("cluster_name").agg(
        F.count(key).alias("zones"),
        F.sum("total_trips").alias("total_trips"),
        *[round_to(F.avg(src), 2).alias(out) for out, src in means.items()],
    )


def check_components(scored: DataFrame, model: PCAModel, cols: Sequence[str]) -> DataFrame:
    """(check_name, violations) of components against the rows themselves.

    A loading times the correlations must be that loading times the component's variance, the
    loadings have length 1, and components do not correlate.
    """
    pairs = [(i, j) for i in range(len(cols)) for j in range(len(cols))]
    k = model.pc.toArray().shape[1]
    asked = [F.covar_pop(F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double")).alias(f"r{i}_{j}") for i, j in pairs]
    asked += [F.var_pop(f"PC{c + 1}").alias(f"v{c}") for c in range(k)] + [F.covar_pop("PC1", f"PC{c + 1}").alias(f"c{c}") for c in range(1, k)]
    found, weights = scored.agg(*asked).first(), model.pc.toArray()
    spread = [math.sqrt(found[f"r{i}_{i}"] or 0.0) for i in range(len(cols))]
    # A constant column was scaled to zeros and correlates with nothing.
    related = {(i, j): found[f"r{i}_{j}"] / (spread[i] * spread[j]) if spread[i] and spread[j] else 0.0 for i, j in pairs}
    checks = []
    for c in range(k):
        residual = max(
            abs(sum(related[i, j] * weights[j][c] for j in range(len(cols))) - found[f"v{c}"] * weights[i][c]) for i in range(len(cols))
        )
        checks.append((f"PC{c + 1} is an eigenvector", int(residual > 1e-6)))
        checks.append((f"PC{c + 1} has length one", int(abs(sum(w[c] ** 2 for w in weights) - 1) > 1e-9)))
    checks.append(("components do not correlate", sum(abs(found[f"c{c}"]) > 1e-6 for c in range(1, k))))
    return scored.sparkSession.createDataFrame(checks, "check_name string, violations long")


def check_clusters(grouped: DataFrame, fitted: Sequence[KMeansModel], cols: Sequence[str], out: str = "cluster") -> DataFrame:
    """(check_name, violations): rows whose cluster's centre is not the nearest, and starts that
    are better than the one taken, both from distances computed here."""

    def squares(model: KMeansModel) -> list[Column]:
        return [sum(((F.col(c) - F.lit(float(x))) ** 2 for c, x in zip(cols, centre)), F.lit(0.0)) for centre in model.clusterCenters()]

    best = squares(fitted[0])
    own, least = F.get(F.array(*best), F.col(out)), F.array_min(F.array(*best))
    costs = [F.sum(F.array_min(F.array(*squares(m)))).alias(f"s{n}") for n, m in enumerate(fitted)]
    found = grouped.agg(F.count(F.when(own > least + 1e-9, 1)).alias("far"), *costs).first()
    checks = [
        ("zones nearer to another centre", found["far"]),
        ("starts with less cost", sum(found[f"s{n}"] < found["s0"] - 1e-6 * (1 + found["s0"]) for n in range(len(fitted)))),
    ]
    return grouped.sparkSession.createDataFrame(checks, "check_name string, violations long")


def pca_report(
    zones: DataFrame, k: int = 2, clusters: int = 4, seed: int = 42, restarts: int = 10, top: int = 5
) -> dict[str, DataFrame]:
    """Components, demand score, named clusters and their summaries."""
    scored, model = pca_scores(zones, PCA_FEATURES, k)
    scored = min_max(stash(scored, "pc"), "PC1", "demand_score")
    parts = [f"PC{i + 1}" for i in range(k)]
    rows, fitted = cluster(scored, parts, clusters, restarts, seed)
    grouped = stash(rows, "clusters")
    named = name_by_rank(grouped, "cluster", "demand_score", fixed.CLUSTER_NAMES[:clusters], "cluster_name")
    best = top_n_per_group(named, "cluster_name", [F.desc("demand_score"), F.asc("pickup_cell")], top)
    return {
        "zones": share_of_max(named, "total_trips", "trip_score"),
        "checks": check_components(scored, model, PCA_FEATURES).unionByName(check_clusters(grouped, fitted, parts)),
        "explained": pca_explained(model, zones),
        "loadings": pca_loadings(model, PCA_FEATURES, zones),
        "stats": cluster_stats(named),
        "top": best.select("cluster_name", "zone_name", "borough", "demand_score", "total_trips"),
        "summary": named.agg(
            F.count(F.lit(1)).alias("zones"), F.count_distinct("cluster").alias("clusters"),
            F.avg("demand_score").alias("avg_demand_score"), F.max("total_trips").alias("max_trips"),
        ),
    }
