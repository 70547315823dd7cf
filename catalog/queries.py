"""One query per operator, each over whole provided tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segwatch.config import Settings
from segwatch.functions.storage import fresh_path
from segwatch.operators import history
from segwatch.operators.clustering import Clustering, assign, fit_kmeans, lloyd, sorted_centroids
from segwatch.operators.drift import (
    drift_metrics,
    drift_report_by_side,
    drifted_features,
    drop_missing,
    ks_by_side,
    ks_statistic,
    with_p_value,
)
from segwatch.operators.quality import davies_bouldin, inertia, silhouette
from segwatch.operators.rows import before_middle, bounded_sample, head, split_at_rank, split_halves
from segwatch.operators.scaling import apply_scaler, column_moments, fit_scaler, scale_features, with_scale
from segwatch.operators.summary import row_count, value_counts
from segwatch.plans.jobs import CANDIDATE, CHAMPION, evaluate, run_monitoring, run_scoring, train
from segwatch.plans.runlog import RunLog
from segwatch.sources.blobs import blobs_for_keys
from segwatch.sources.tables import read_csv, read_table, write_csv, write_table

FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
SHIP_ORDER = ("l_shipdate", *KEYS)
WIDTH = 64
DIMS = tuple(f"feature_{i + 1}" for i in range(WIDTH))
BLOB_FEATURES = DIMS[:4]
SETTINGS = Settings(features=FEATURES)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(*KEYS, *FEATURES)


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return rows.select("vec_id", "label", *(F.col("embedding")[i].cast("double").alias(d) for i, d in enumerate(DIMS)))


def _rounded(df: DataFrame, columns, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _start(scaled: DataFrame, k: int = 4) -> list[tuple[float, ...]]:
    """The standardised rows with the ``k`` smallest key hashes, in hash order."""
    return [tuple(r[f] for f in FEATURES) for r in bounded_sample(scaled, KEYS, k, seed=0).collect()]


def _labelled(spark: SparkSession, sf_dir: str, distance: str | None = None) -> DataFrame:
    scaled, _ = scale_features(_lineitem(spark, sf_dir), FEATURES)
    return assign(scaled, FEATURES, _start(scaled), distance=distance)


# sources and sinks


def gaussian_blobs(spark, sf_dir):
    return _rounded(blobs_for_keys(_table(spark, sf_dir, "orders"), "o_orderkey"), BLOB_FEATURES)


def _dates_as_text(df: DataFrame) -> DataFrame:
    """Engines name the types of dates and times differently; as text they compare."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType, T.DateType))]
    return df.withColumns({name: F.col(name).cast("string") for name in times})


def _through_csv(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, target = f"{sf_dir}/{name}.parquet", fresh_path(spark, f"{name}-csv")
    table = read_table(spark, source)
    write_csv(table, target, sources=[source])
    return _dates_as_text(read_csv(spark, target, table.schema))


def table_sink(spark, sf_dir):
    source, target = f"{sf_dir}/orders.parquet", fresh_path(spark, "orders")
    write_table(read_table(spark, source), target, sources=[source])
    return _dates_as_text(read_table(spark, target))


def csv_sink_and_scan(spark, sf_dir):
    return _through_csv(spark, sf_dir, "orders")


def csv_of_documents(spark, sf_dir):
    """Whole texts with line breaks, quotes and commas."""
    return _through_csv(spark, sf_dir, "documents")


def table_scan(spark, sf_dir):
    return _dates_as_text(_table(spark, sf_dir, "orders"))


# rows and columns


def project_features(spark, sf_dir):
    return _table(spark, sf_dir, "lineitem").select(*FEATURES)


def _halves_summary(first: DataFrame, second: DataFrame, value: str) -> DataFrame:
    sides = first.select(F.lit("first").alias("side"), value).unionAll(second.select(F.lit("second").alias("side"), value))
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 3).alias("total"))


def split_halves_by_key(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    return _halves_summary(*split_at_rank(events, ["event_id"], events.count() // 2), "value")


def split_halves_by_date(spark, sf_dir):
    lineitem = _table(spark, sf_dir, "lineitem")
    return _halves_summary(*split_halves(lineitem, lineitem, SHIP_ORDER), "l_extendedprice")


def drop_missing_per_feature(spark, sf_dir):
    """Zero tax stands for NULL and zero discount for NaN, so each feature loses other rows."""
    holes = _lineitem(spark, sf_dir).withColumns({
        "l_tax": F.nullif("l_tax", F.lit(0.0)),
        "l_discount": F.when(F.col("l_discount") == 0.0, F.lit(float("nan"))).otherwise(F.col("l_discount")),
    })
    return drop_missing(holes, FEATURES).groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("total")
    )


def first_rows(spark, sf_dir):
    return head(_lineitem(spark, sf_dir), KEYS)


def row_sample(spark, sf_dir):
    return bounded_sample(_lineitem(spark, sf_dir), KEYS, SETTINGS.silhouette_rows).select(*KEYS)


def row_counts(spark, sf_dir):
    return row_count(_lineitem(spark, sf_dir))


def row_counts_if(spark, sf_dir):
    return row_count(_lineitem(spark, sf_dir), F.col("l_discount") > 0.05)


# scaling


def moments(spark, sf_dir):
    stats = with_scale(column_moments(_lineitem(spark, sf_dir), FEATURES))
    return _rounded(stats.select("feature", "n", "mean", "std", "scale"), ["mean", "std", "scale"])


def standardised_rows(spark, sf_dir):
    scaled, _ = scale_features(_lineitem(spark, sf_dir), FEATURES)
    return _rounded(scaled, FEATURES)


def _scaler_per_flag(spark: SparkSession, sf_dir: str) -> RunLog:
    """One stored scaler per return flag, the flag standing for the training run."""
    runs = RunLog(spark, fresh_path(spark, "runs"))
    stats = with_scale(column_moments(_table(spark, sf_dir, "lineitem"), FEATURES, by=["l_returnflag"]))
    runs.append("scalers", stats.withColumnRenamed("l_returnflag", "run_id"))
    return runs


def stored_scalers(spark, sf_dir):
    stored = _scaler_per_flag(spark, sf_dir).table("scalers")
    return _rounded(stored.select("run_id", "feature", "mean", "std", "scale"), ["mean", "std", "scale"])


def apply_stored_scaler(spark, sf_dir):
    scaler = _scaler_per_flag(spark, sf_dir).load_scaler("A")
    return _rounded(apply_scaler(_lineitem(spark, sf_dir), scaler), FEATURES)


# clustering


def cluster_distribution(spark, sf_dir):
    return value_counts(_labelled(spark, sf_dir), "cluster")


def clusters_by_frequency(spark, sf_dir):
    return value_counts(_labelled(spark, sf_dir), "cluster", by_frequency=True)


def nearest_centroid(spark, sf_dir):
    return _rounded(_labelled(spark, sf_dir, "distance").select(*KEYS, "cluster", "distance"), ["distance"])


def nearest_of_many(spark, sf_dir):
    """64 centroids under a limit that they exceed, so that the index finds the nearest."""
    scaled, _ = scale_features(_lineitem(spark, sf_dir), FEATURES)
    found = assign(scaled, FEATURES, _start(scaled, 64), distance="distance", limit=1024)
    return _rounded(found.select(*KEYS, "cluster", "distance"), ["distance"])


def nearest_labelled_vector(spark, sf_dir):
    """Centroids from a table: of all vectors the nearest one whose number is divisible by five."""
    rows = _embeddings(spark, sf_dir)
    centroids = rows.where("vec_id % 5 = 0").select(F.col("vec_id").alias("cluster"), *DIMS)
    return _rounded(assign(rows, DIMS, centroids, distance="distance").select("vec_id", "cluster", "distance"), ["distance"])


def _as_rows(spark: SparkSession, model: Clustering) -> DataFrame:
    rows = model.to_table(spark).withColumn("inertia", F.lit(model.inertia))
    return _rounded(_rounded(rows, model.features), ["inertia"], 3)


def lloyd_steps(spark, sf_dir):
    scaled, _ = scale_features(_lineitem(spark, sf_dir), FEATURES)
    return _as_rows(spark, lloyd(scaled, FEATURES, _start(scaled), max_iter=3))


def training_labels(spark, sf_dir):
    scaled, _ = scale_features(_lineitem(spark, sf_dir), FEATURES)
    model = lloyd(scaled, FEATURES, _start(scaled), max_iter=3)
    return assign(scaled, FEATURES, model.centroids).select(*KEYS, "cluster")


def kmeans_on_blobs(spark, sf_dir):
    """Blobs are far apart, so the best fit is the fixed point next to the label means."""
    blobs = blobs_for_keys(_table(spark, sf_dir, "orders"), "o_orderkey")
    model = fit_kmeans(blobs, BLOB_FEATURES, k=4, keys=["o_orderkey"], tol=0.0)
    return _as_rows(spark, sorted_centroids(model))


def kmeans_on_lineitem(spark, sf_dir):
    scaled, _ = scale_features(_lineitem(spark, sf_dir), FEATURES)
    return _as_rows(spark, sorted_centroids(fit_kmeans(scaled, FEATURES, keys=KEYS)))


# quality


def inertia_on_lineitem(spark, sf_dir):
    scaled, _ = scale_features(_lineitem(spark, sf_dir), FEATURES)
    return _rounded(inertia(scaled, FEATURES, _start(scaled)), ["inertia"], 3)


def silhouette_on_lineitem(spark, sf_dir):
    return _rounded(silhouette(_labelled(spark, sf_dir), FEATURES, "cluster", KEYS), ["silhouette"])


def silhouette_on_embeddings(spark, sf_dir):
    return _rounded(silhouette(_embeddings(spark, sf_dir), DIMS, "label", ["vec_id"]), ["silhouette"])


def silhouette_all_rows_on_embeddings(spark, sf_dir):
    rows = _embeddings(spark, sf_dir)
    return _rounded(silhouette(rows, DIMS, "label", ["vec_id"], sample_size=None), ["silhouette"])


def silhouette_all_rows_on_blobs(spark, sf_dir):
    """Every row of separated clusters: most pairs of blocks never meet."""
    blobs = blobs_for_keys(_table(spark, sf_dir, "orders"), "o_orderkey")
    return _rounded(silhouette(blobs, BLOB_FEATURES, "true_label", ["o_orderkey"], sample_size=None), ["silhouette"])


def davies_bouldin_on_lineitem(spark, sf_dir):
    return _rounded(davies_bouldin(_labelled(spark, sf_dir), FEATURES, "cluster"), ["davies_bouldin"])


def davies_bouldin_on_embeddings(spark, sf_dir):
    return _rounded(davies_bouldin(_embeddings(spark, sf_dir), DIMS, "label"), ["davies_bouldin"])


# drift


def _ship_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem")
    first = before_middle(lineitem, SHIP_ORDER)
    return lineitem.select(*FEATURES, first.alias("early"))


def _event_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = _table(spark, sf_dir, "events")
    return split_at_rank(events, ["event_id"], events.count() // 2)


def ks_on_lineitem(spark, sf_dir):
    return _rounded(ks_by_side(_ship_halves(spark, sf_dir), FEATURES, "early"), ["ks_stat"])


def ks_on_events(spark, sf_dir):
    return _rounded(with_p_value(ks_statistic(*_event_halves(spark, sf_dir), ["value"])), ["ks_stat", "p_value"])


def drift_of_lineitem(spark, sf_dir):
    return _rounded(drift_report_by_side(_ship_halves(spark, sf_dir), FEATURES, "early"), ["ks_stat", "p_value"])


def _price_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dear against cheap line items: the price drifts entirely, quantity with it, the rates hardly."""
    return _table(spark, sf_dir, "lineitem").select(*FEATURES, (F.col("l_extendedprice") < 50000.0).alias("cheap"))


def drifted_by_price(spark, sf_dir):
    found = drifted_features(drift_report_by_side(_price_sides(spark, sf_dir), FEATURES, "cheap"))
    return _rounded(found.select("feature", "ks_stat"), ["ks_stat"])


def monitoring_metrics(spark, sf_dir):
    return _rounded(drift_metrics(drift_report_by_side(_ship_halves(spark, sf_dir), FEATURES, "early")), ["value"])


def monitoring(spark, sf_dir):
    """The whole job: both halves of one table by path, results recorded and read back."""
    path = f"{sf_dir}/lineitem.parquet"
    runs = RunLog(spark, fresh_path(spark, "runs"))
    result = run_monitoring(path, path, SHIP_ORDER, runs, SETTINGS)
    recorded = runs.table("metrics").where(F.col("run_id") == result.run_id)
    return _rounded(recorded.select("key", "value"), ["value"])


# run history, derived from orders: a customer stands for a model and an order for a run


def _model() -> Column:
    return F.concat(F.lit("model-"), F.col("o_custkey").cast("string"))


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    return _table(spark, sf_dir, "orders").select(
        _model().alias("model"), key.alias("version"), F.concat(F.lit("run-"), key).alias("run_id")
    )


def _alias_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    alias = F.when(F.col("o_orderstatus") == "F", CHAMPION).otherwise(CANDIDATE)
    return _table(spark, sf_dir, "orders").select(
        _model().alias("model"), alias.alias("alias"), F.col("o_orderkey").cast("string").alias("version"),
        (1_000_000_000_000 - F.col("o_orderkey")).alias("seq"),
    )


def _metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.metric_rows(
        _table(spark, sf_dir, "orders").select(
            "o_custkey", "o_orderkey", F.col("o_totalprice").alias("inertia"),
            (F.col("o_totalprice") / 1_000_000.0).alias("silhouette_score"),
        ),
        "o_custkey", ["inertia", "silhouette_score"], "o_orderkey",
    )


def run_params(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("random_state"), F.col("o_orderstatus").alias("init")
    )
    runs = RunLog(spark, fresh_path(spark, "runs"))
    runs.append("params", history.param_rows(orders, "o_orderkey", ["random_state", "init"]))
    return runs.table("params")


def run_metrics(spark, sf_dir):
    runs = RunLog(spark, fresh_path(spark, "runs"))
    runs.append("metrics", _metric_history(spark, sf_dir))
    return runs.table("metrics")


def latest_metrics(spark, sf_dir):
    return history.latest_metrics(_metric_history(spark, sf_dir))


def prefixed_metrics(spark, sf_dir):
    return history.prefix_metrics(history.latest_metrics(_metric_history(spark, sf_dir)))


def next_versions(spark, sf_dir):
    models = _table(spark, sf_dir, "customer").select(F.concat(F.lit("model-"), F.col("c_custkey").cast("string")).alias("model"))
    return history.next_versions(models, _versions(spark, sf_dir))


def latest_versions(spark, sf_dir):
    return history.latest_versions(_versions(spark, sf_dir))


def candidate_aliases(spark, sf_dir):
    latest = history.latest_versions(_versions(spark, sf_dir))
    return history.alias_rows(latest, CANDIDATE, F.col("version"))


def current_aliases(spark, sf_dir):
    return history.current_aliases(_alias_events(spark, sf_dir))


def resolved_aliases(spark, sf_dir):
    return history.resolve_aliases(_alias_events(spark, sf_dir), _versions(spark, sf_dir))


def promotions(spark, sf_dir):
    """Scores of urgent orders are undefined and must not pass."""
    score = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(float("nan"))).otherwise(F.col("o_totalprice") / 1_000_000.0)
    candidates = _table(spark, sf_dir, "orders").select(
        _model().alias("model"), F.col("o_orderkey").cast("string").alias("version"), score.alias("silhouette_score")
    )
    return history.promote(candidates, F.col("version"))


# end to end


def _registered(spark: SparkSession, sf_dir: str, alias: str) -> RunLog:
    """A history with one model whose centroids are known: the hash-chosen starting rows."""
    runs = RunLog(spark, fresh_path(spark, "runs"))
    lineitem = _lineitem(spark, sf_dir)
    scaler = fit_scaler(lineitem, FEATURES)
    run_id = runs.start_run()
    runs.log_metrics(run_id, {"inertia": 1.0})
    runs.store_scaler(run_id, scaler)
    centroids = _start(apply_scaler(lineitem, scaler))
    version = runs.register(SETTINGS.model_name, run_id, Clustering(FEATURES, tuple(centroids), 1.0, 0))
    runs.set_alias(SETTINGS.model_name, alias, version)
    return runs


def batch_scoring(spark, sf_dir):
    runs = _registered(spark, sf_dir, CHAMPION)
    written = run_scoring(f"{sf_dir}/lineitem.parquet", fresh_path(spark, "predictions"), runs, SETTINGS)
    return written.select(*KEYS, *FEATURES, "cluster")


def _verdict(runs: RunLog) -> DataFrame:
    """Metrics recorded for the candidate, and whether it became champion."""
    recorded = history.latest_metrics(runs.table("metrics")).select("key", F.round("value", 3).alias("value"))
    promoted = runs.table("aliases").agg(F.count_if(F.col("alias") == CHAMPION).cast("double").alias("value"))
    return recorded.unionAll(promoted.select(F.lit("promoted").alias("key"), "value"))


def evaluation(spark, sf_dir):
    runs = _registered(spark, sf_dir, CANDIDATE)
    evaluate(_lineitem(spark, sf_dir), KEYS, runs, SETTINGS)
    return _verdict(runs)


def evaluation_of_blobs(spark, sf_dir):
    """The label means of well separated blobs pass the gate."""
    blobs = blobs_for_keys(_table(spark, sf_dir, "orders"), "o_orderkey")
    scaled, scaler = scale_features(blobs, BLOB_FEATURES)
    means = scaled.groupBy("true_label").agg(*(F.avg(f).alias(f) for f in BLOB_FEATURES)).orderBy("true_label")
    centroids = tuple(tuple(r[f] for f in BLOB_FEATURES) for r in means.collect())
    runs, settings = RunLog(spark, fresh_path(spark, "runs")), Settings()
    run_id = runs.start_run()
    runs.log_metrics(run_id, {"inertia": 1.0})
    runs.store_scaler(run_id, scaler)
    version = runs.register(settings.model_name, run_id, Clustering(BLOB_FEATURES, centroids, 1.0, 0))
    runs.set_alias(settings.model_name, CANDIDATE, version)
    evaluate(blobs, ["o_orderkey"], runs, settings)
    return _verdict(runs)


def training(spark, sf_dir):
    """Train, evaluate and promote on blobs; the recorded metrics of the run."""
    runs = RunLog(spark, fresh_path(spark, "runs"))
    settings = Settings()
    blobs = blobs_for_keys(_table(spark, sf_dir, "orders"), "o_orderkey")
    train(blobs, ["o_orderkey"], runs, settings)
    evaluate(blobs, ["o_orderkey"], runs, settings)
    return history.latest_metrics(runs.table("metrics")).select("key", F.round("value", 6).alias("value"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        cluster_distribution, gaussian_blobs, table_sink, csv_sink_and_scan, csv_of_documents, table_scan, project_features,
        split_halves_by_key, split_halves_by_date, drop_missing_per_feature, first_rows, row_sample, row_counts,
        row_counts_if, moments, standardised_rows, stored_scalers, apply_stored_scaler, clusters_by_frequency,
        nearest_centroid, nearest_of_many, nearest_labelled_vector, lloyd_steps, training_labels, kmeans_on_blobs, kmeans_on_lineitem, inertia_on_lineitem,
        silhouette_on_lineitem, silhouette_on_embeddings, silhouette_all_rows_on_embeddings, silhouette_all_rows_on_blobs,
        davies_bouldin_on_lineitem, davies_bouldin_on_embeddings,
        ks_on_lineitem, ks_on_events, drift_of_lineitem, drifted_by_price, monitoring_metrics, monitoring, run_params,
        run_metrics, latest_metrics, prefixed_metrics, next_versions, latest_versions, candidate_aliases,
        current_aliases, resolved_aliases, promotions, batch_scoring, evaluation, evaluation_of_blobs, training,
    )
}
