import logging
import pathlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from reference_math import ks as numpy_ks
from reference_math import silhouette as numpy_silhouette

from segwatch import FEATURE_COLS, RunLog, Settings, evaluate, monitor, run_monitoring, run_scoring, score, train
from segwatch.functions import storage
from segwatch.operators.summary import value_counts
from segwatch.plans.jobs import label_with
from segwatch.sources.blobs import generate_blobs
from segwatch.sources.tables import read_csv, read_table, write_csv, write_table

SETTINGS = Settings(n_init=2)


@pytest.fixture
def runs(spark, tmp_path):
    return RunLog(spark, str(tmp_path / "runs"))


@pytest.fixture
def blobs(spark, tmp_path):
    path = str(tmp_path / "blobs")
    write_table(generate_blobs(spark, 600), path)
    return path


def normal(spark, n, seed):
    values = np.random.default_rng(seed).standard_normal((n, 4))
    pdf = pd.DataFrame(values, columns=FEATURE_COLS)
    pdf.insert(0, "id", range(n))
    return spark.createDataFrame(pdf)


def test_train_returns_the_recorded_run(spark, runs):
    run_id = train(normal(spark, 200, 1), ["id"], runs, Settings(n_clusters=3, n_init=2))
    assert runs.params(run_id) == {"kind": "training", "n_clusters": "3", "random_state": "42", "max_iter": "300", "n_init": "2"}
    assert set(runs.metrics(run_id)) == {"inertia", "silhouette_score", "davies_bouldin_score"}
    assert runs.resolve("segments", "candidate") == ("1", run_id)
    assert len(runs.load_clustering(run_id).centroids) == 3


def test_train_then_evaluate_promotes_and_scores(spark, runs, blobs, tmp_path):
    df = read_table(spark, blobs)
    with pytest.raises(LookupError):
        evaluate(df, ["id"], runs, SETTINGS)
    run_id = train(df, ["id"], runs, SETTINGS)
    with pytest.raises(LookupError):
        score(df, runs, SETTINGS)
    dry = evaluate(df, ["id"], runs, SETTINGS, promote=False)
    with pytest.raises(LookupError):
        runs.resolve("segments", "champion")
    metrics = evaluate(df, ["id"], runs, SETTINGS)
    assert metrics == pytest.approx(dry)
    assert runs.resolve("segments", "champion") == ("1", run_id)
    assert metrics["silhouette_score"] > 0.35
    assert metrics["inertia_on_data"] == pytest.approx(metrics["inertia"])
    recorded = runs.metrics(run_id)
    assert recorded["eval_silhouette_score"] == pytest.approx(recorded["silhouette_score"])

    output = str(tmp_path / "predictions")
    written = run_scoring(blobs, output, runs, SETTINGS)
    assert written.columns == [*df.columns, "cluster"]
    assert written.count() == 600
    assert sum(r["n"] for r in value_counts(written, "cluster").collect()) == 600
    # Original values, not standardised ones, are written.
    assert written.drop("cluster").exceptAll(df).count() == 0
    # Nearly all rows of a blob share one cluster.
    shared = written.groupBy("true_label", "cluster").count().groupBy("true_label").agg(F.max("count").alias("n"))
    assert shared.agg(F.sum("n")).head()[0] > 0.95 * 600

    values = written.select(*FEATURE_COLS, "cluster").toPandas()
    x = values[list(FEATURE_COLS)].to_numpy()
    scaled = (x - x.mean(axis=0)) / x.std(axis=0)
    assert metrics["silhouette_score"] == pytest.approx(numpy_silhouette(scaled, values["cluster"].to_numpy()))


def test_weak_candidate_is_not_promoted(spark, runs, caplog):
    df = normal(spark, 200, 2)
    train(df, ["id"], runs, SETTINGS)
    with caplog.at_level(logging.WARNING):
        metrics = evaluate(df, ["id"], runs, SETTINGS)
    assert {"silhouette_score", "davies_bouldin_score"} <= set(metrics)
    assert 0 < metrics["silhouette_score"] < 0.35
    assert "stays candidate" in caplog.text
    with pytest.raises(LookupError):
        runs.resolve("segments", "champion")
    at_threshold = Settings(n_init=2, silhouette_threshold=metrics["silhouette_score"])
    evaluate(df, ["id"], runs, at_threshold)
    assert runs.resolve("segments", "champion")[0] == "1"


def test_stored_scaler_differs_from_a_refit_on_other_data(spark, runs, blobs):
    df = read_table(spark, blobs)
    train(df, ["id"], runs, SETTINGS)
    moved = df.withColumns({f: F.col(f) * 3.0 + 5.0 for f in FEATURE_COLS})
    refit = evaluate(moved, ["id"], runs, SETTINGS, promote=False, scaler="refit")
    stored = evaluate(moved, ["id"], runs, SETTINGS, promote=False)
    same = evaluate(df, ["id"], runs, SETTINGS, promote=False)
    assert refit["silhouette_score"] == pytest.approx(same["silhouette_score"])
    assert stored["inertia_on_data"] > 2 * same["inertia_on_data"]
    assert stored["inertia"] == same["inertia"]


def test_missing_columns_and_values(spark, runs, blobs):
    df = read_table(spark, blobs)
    with pytest.raises(ValueError, match="are needed"):
        train(df.drop("feature_2"), ["id"], runs, SETTINGS)
    holed = df.withColumn("feature_1", F.when(F.col("id") > 3, F.col("feature_1")))
    with pytest.raises(ValueError, match="'feature_1': 4"):
        train(holed, ["id"], runs, SETTINGS)
    train(df, ["id"], runs, SETTINGS)
    evaluate(df, ["id"], runs, SETTINGS)
    with pytest.raises(ValueError, match="are needed"):
        score(df.drop("feature_2"), runs, SETTINGS)
    assert score(holed, runs, SETTINGS, missing="null").where("cluster is null").count() == 4
    with pytest.raises(Exception, match="missing features"):
        score(holed, runs, SETTINGS).collect()


def test_scoring_runs_on_a_stream_unchanged(spark, runs, blobs):
    df = read_table(spark, blobs)
    run_id = train(df, ["id"], runs, SETTINGS)
    fitted, scaler = runs.load_clustering(run_id), runs.load_scaler(run_id)
    stream = label_with(spark.readStream.schema(df.schema).parquet(blobs), fitted, scaler)
    query = stream.writeStream.format("memory").queryName("labelled_blobs").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.table("labelled_blobs").exceptAll(label_with(df, fitted, scaler)).count() == 0
    assert spark.table("labelled_blobs").count() == 600


def test_monitoring_one_table_in_halves(spark, runs, blobs):
    result = run_monitoring(blobs, blobs, ["id"], runs, SETTINGS)
    values = read_table(spark, blobs).orderBy("id").toPandas()
    for row in result.details.collect():
        v = values[row["feature"]].to_numpy()
        assert row["ks_stat"] == pytest.approx(numpy_ks(v[:300], v[300:]))
        assert row["n_ref"] == row["n_curr"] == 300
        assert row["drifted"] == (row["p_value"] < 0.05) == (row["feature"] in result.drifted_features)
    recorded = runs.metrics(result.run_id)
    assert len(recorded) == 9 and recorded["n_drifted_features"] == len(result.drifted_features)


def test_monitoring_two_tables(spark, runs, blobs, tmp_path):
    df = read_table(spark, blobs)
    other = str(tmp_path / "other")
    write_table(df.withColumn("feature_3", F.col("feature_3") + 40.0), other)
    halves = run_monitoring(blobs, other, ["id"], runs, SETTINGS)
    whole = monitor(df, read_table(spark, other), runs, SETTINGS)
    assert "feature_3" in halves.drifted_features and whole.drifted_features == ["feature_3"]
    short = str(tmp_path / "short")
    write_table(df.where("id < 200"), short)
    with pytest.raises(ValueError, match="no values"):
        run_monitoring(blobs, short, ["id"], runs, SETTINGS)


def test_sinks_round_trip_and_refuse_their_input(spark, blobs, tmp_path):
    df = read_table(spark, blobs)
    for target in (blobs, f"file:{blobs}/", f"{blobs}/sub", str(tmp_path)):
        with pytest.raises(ValueError, match="Refusing"):
            write_table(df, target, sources=[blobs])
    for target in (f"{blobs}/sub", str(tmp_path)):
        with pytest.raises(ValueError, match="Refusing"):
            write_table(df, target)
    assert df.count() == 600
    target = str(tmp_path / "csv")
    write_csv(df, target)
    assert read_csv(spark, target, df.schema).exceptAll(df).count() == 0
    inferred = read_csv(spark, target)
    assert inferred.columns == df.columns and inferred.exceptAll(df).count() == 0
    write_csv(df.where("id < 5"), target)
    assert read_csv(spark, target, df.schema).count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        read_table(spark, str(tmp_path / "absent")).count()


def test_a_failing_overwrite_keeps_the_old_table(spark, blobs, tmp_path):
    target = str(tmp_path / "out")
    write_table(spark.range(7), target)
    bad = spark.range(100).selectExpr("if(id = 99, raise_error('stop'), id) AS id")
    with pytest.raises(Exception, match="stop"):
        write_table(bad, target)
    assert read_table(spark, target).count() == 7
    assert {p.name for p in tmp_path.iterdir()} == {"out", "blobs"}
    write_table(read_table(spark, target).where("id < 3"), target)  # its own input, complete before the exchange
    assert read_table(spark, target).count() == 3


def test_failing_scoring_keeps_the_old_predictions(spark, runs, blobs, tmp_path):
    df = read_table(spark, blobs)
    train(df, ["id"], runs, SETTINGS)
    evaluate(df, ["id"], runs, SETTINGS)
    target = str(tmp_path / "predictions")
    run_scoring(blobs, target, runs, SETTINGS)
    holes = str(tmp_path / "holes")
    write_table(df.withColumn("feature_2", F.when(F.col("id") != 17, F.col("feature_2"))), holes)
    with pytest.raises(Exception, match="missing features"):
        run_scoring(holes, target, runs, SETTINGS)
    assert read_table(spark, target).where("cluster IS NOT NULL").count() == 600


def test_csv_keeps_every_kind_of_text(spark, tmp_path):
    texts = ["two\nlines", 'say "hi", ok', "", None, " pad ", '"', '""', ",", "\\", "\\\"", "a\tb", "NULL", "é🎉", '\n', "'", "#x"]
    df = spark.createDataFrame([(i, t, i / 2) for i, t in enumerate(texts)], "id int, text string, value double")
    target = str(tmp_path / "texts")
    write_csv(df, target)
    assert {r["id"]: r["text"] for r in read_csv(spark, target, df.schema).collect()} == dict(enumerate(texts))
    plain = tmp_path / "plain.csv"
    plain.write_text('id,text\n1,"say ""hi"", ok"\n2,"two\nlines"\n3, pad \n')
    assert [r["text"] for r in read_csv(spark, str(plain), "id int, text string").orderBy("id").collect()] == ['say "hi", ok', "two\nlines", " pad "]


def test_runs_know_their_kind(spark, runs, blobs):
    df = read_table(spark, blobs)
    run_id = train(df, ["id"], runs, SETTINGS)
    assert runs.kind(run_id) == "training"
    assert runs.kind(monitor(df, df, runs, SETTINGS).run_id) == "monitoring"


def test_value_counts_leave_out_every_missing_value(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (float("nan"),), (None,)], "x double")
    assert [tuple(r) for r in value_counts(df, "x").collect()] == [(1.0, 2)]


def test_released_intermediate_tables_are_gone(spark):
    folder = pathlib.Path(storage.shared_folder(spark)) / f"segwatch-{spark.sparkContext.applicationId}"
    kept = storage.cut(spark.range(10))
    assert kept.count() == 10 and folder.exists()
    storage.release(spark)
    assert not folder.exists()
