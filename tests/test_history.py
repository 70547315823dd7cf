from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from segwatch.operators import history
from segwatch.operators.clustering import Clustering
from segwatch.operators.scaling import Scaler
from segwatch.plans.runlog import RunLog

MODEL = Clustering(("a", "b"), ((0.0, 1.0), (2.0, 3.0)), 7.5, 3)
SCALER = Scaler(("a", "b"), (1.0, 2.0), (0.5, 0.0), (0.5, 1.0))


@pytest.fixture
def runs(spark, tmp_path):
    return RunLog(spark, str(tmp_path / "runs"))


def test_last_metric_wins(runs):
    run = runs.start_run()
    runs.log_params(run, {"k": 4, "init": "x"})
    runs.log_metrics(run, {"inertia": 1.0, "silhouette_score": 0.5})
    runs.log_metrics(run, {"inertia": 2.0})
    runs.log_metrics(runs.start_run(), {"inertia": 9.0})
    assert runs.metrics(run) == {"inertia": 2.0, "silhouette_score": 0.5}
    assert runs.params(run) == {"k": "4", "init": "x"}


def test_versions_count_numerically(spark, runs):
    for _ in range(10):
        runs.register("m", run := runs.start_run(), MODEL)
    assert runs.latest_version("m") == ("10", run)
    assert runs.register("other", runs.start_run(), MODEL) == "1"
    with pytest.raises(LookupError):
        runs.latest_version("none")
    table = spark.createDataFrame([("m", "9", "r9"), ("m", "10", "r10")], history.VERSIONS)
    assert tuple(history.latest_versions(table).head()) == ("m", "10", "r10")


def test_alias_moves_and_unset_alias_raises(runs):
    first, second = runs.start_run(), runs.start_run()
    runs.register("m", first, MODEL)
    runs.register("m", second, MODEL)
    with pytest.raises(LookupError, match="champion"):
        runs.resolve("m", "champion")
    runs.set_alias("m", "champion", "2")
    runs.set_alias("m", "candidate", "2")
    runs.set_alias("m", "champion", "1")
    assert runs.resolve("m", "champion") == ("1", first)
    assert runs.resolve("m", "candidate") == ("2", second)
    runs.set_alias("m", "champion", "77")
    with pytest.raises(LookupError, match="unregistered"):
        runs.resolve("m", "champion")


def test_scaler_and_centroids_belong_to_their_run(runs):
    run = runs.start_run()
    runs.store_scaler(run, SCALER)
    runs.log_metrics(run, {"inertia": 7.5})
    runs.register("m", run, MODEL)
    assert runs.load_scaler(run) == SCALER
    loaded = runs.load_clustering(run)
    assert (loaded.features, loaded.centroids, loaded.inertia) == (MODEL.features, MODEL.centroids, 7.5)
    with pytest.raises(LookupError):
        runs.load_scaler("unknown")
    with pytest.raises(LookupError):
        runs.load_clustering("unknown")


def test_gate_is_inclusive_and_rejects_nan(spark):
    rows = [("a", "1", 0.35), ("b", "1", float("nan")), ("c", "2", 0.3499), ("d", "1", None), ("e", "3", 0.9)]
    candidates = spark.createDataFrame(rows, "model string, version string, silhouette_score double")
    out = history.promote(candidates, F.lit(5)).orderBy("model").collect()
    assert [tuple(r) for r in out] == [("a", "champion", "1", 5), ("e", "champion", "3", 5)]


def test_many_models_at_once_with_a_hot_one(spark):
    versions = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("m"), F.col("id") % 50)).alias("model"),
        F.col("id").cast("string").alias("version"), F.concat(F.lit("r"), "id").alias("run_id"),
    )
    events = history.alias_rows(versions, "candidate", F.col("version"))
    resolved = {r["model"]: r for r in history.resolve_aliases(events, versions).collect()}
    latest = {r["model"]: r["version"] for r in history.latest_versions(versions).collect()}
    assert {m: r["version"] for m, r in resolved.items()} == latest
    assert resolved["hot"]["version"] == "2997" and resolved["hot"]["run_id"] == "r2997"
    following = {r["model"]: r["version"] for r in history.next_versions(versions, versions).collect()}
    assert following["hot"] == "2998"
    dangling = events.unionAll(spark.createDataFrame([("hot", "candidate", "5000", 9999)], history.ALIASES))
    with pytest.raises(Exception, match="unregistered"):
        history.resolve_aliases(dangling, versions).collect()


def test_rows_from_wide_tables(spark):
    wide = spark.createDataFrame([("r", 4, 0.5, 1)], "run string, k int, score double, seq int")
    assert [tuple(r) for r in history.param_rows(wide, "run", ["k"]).collect()] == [("r", "k", "4")]
    metrics = history.metric_rows(wide, "run", ["score"], "seq")
    assert [tuple(r) for r in history.prefix_metrics(metrics).collect()] == [("r", "eval_score", 0.5, 1)]


def test_several_writers_register_gapless_versions(runs):
    """Eight threads and two logs on one folder: 40 versions, none twice, none left out."""
    other = RunLog(runs.spark, runs.root)
    with ThreadPoolExecutor(8) as pool:
        versions = list(pool.map(lambda i: (runs, other)[i % 2].register("m", f"run-{i}", MODEL), range(40)))
    assert sorted(map(int, versions)) == list(range(1, 41))
    stored = {(r["version"], r["run_id"]) for r in runs.table("versions").collect()}
    assert stored == {(v, f"run-{i}") for i, v in enumerate(versions)}
    assert runs.latest_version("m")[0] == "40"


def test_a_claimed_number_is_not_given_again(runs, tmp_path):
    assert runs.register("odd / name", "a", MODEL) == "1"
    folder = next((tmp_path / "runs" / "claims").iterdir())
    (folder / "2").touch()  # a writer that died after its claim
    assert runs.register("odd / name", "b", MODEL) == "3"


def test_one_read_loads_what_an_alias_points_at(runs):
    with pytest.raises(LookupError, match="no version with alias"):
        runs.load_model("m", "champion")
    for run, shift in (("first", 0.0), ("second", 5.0)):
        runs.log_metrics(run, {"inertia": 1.0 + shift, "other": 2.0})
        runs.log_metrics(run, {"inertia": 7.5 + shift})
        runs.store_scaler(run, Scaler(("a", "b"), (1.0 + shift, 2.0), (0.5, 0.0), (0.5, 1.0)))
        points = tuple((x + shift, y) for x, y in MODEL.centroids)
        runs.set_alias("m", "champion", runs.register("m", run, Clustering(("a", "b"), points, 0.0, 3)))
    runs.register("n", "first", MODEL)  # another model with the same numbers
    version, run_id, fitted, scaler = runs.load_model("m", "champion")
    assert (version, run_id) == ("2", "second") and scaler == runs.load_scaler("second") and fitted == runs.load_clustering("second")
    assert fitted.inertia == 12.5 and fitted.centroids[1] == (7.0, 3.0)
    runs.set_alias("m", "champion", "9")
    with pytest.raises(LookupError, match="unregistered version 9"):
        runs.load_model("m", "champion")
