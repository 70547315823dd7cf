"""The centroid index against plain comparisons, and with the limit set low against the usual way."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_clustering import by_id, frame, numpy_nearest

from segwatch.operators import centroid_index, clustering
from segwatch.operators.clustering import assign, index_centroids
from segwatch.operators.scaling import fit_scaler


def test_a_low_limit_gives_the_same_rows(spark):
    draw = np.random.default_rng(1)
    x, c = draw.standard_normal((900, 4)), draw.standard_normal((120, 4))
    df, names = frame(spark, x)
    df = df.withColumn("cluster", F.lit("old")).withColumn("row", F.col("id"))
    scaler = fit_scaler(df, names)
    usual = assign(df, names, c.tolist(), scaler, distance="d").orderBy("id").collect()
    indexed = assign(df, names, c.tolist(), scaler, distance="d", limit=1024)
    assert indexed.columns == ["id", *names, "row", "cluster", "d"]
    found = indexed.orderBy("id").collect()
    assert [r["cluster"] for r in found] == [r["cluster"] for r in usual]
    assert np.allclose([r["d"] for r in found], [r["d"] for r in usual], atol=1e-12)
    assert [tuple(r)[:6] for r in found] == [tuple(r)[:6] for r in usual]


def test_ties_equal_centroids_hot_balls_and_missing_features(spark, monkeypatch):
    monkeypatch.setattr(centroid_index, "LEAF_ROWS", 8)
    monkeypatch.setattr(centroid_index, "GROUP_ROWS", 16)
    grid = [[float(i), float(j)] for i in range(8) for j in range(8)]
    c = grid[::-1] + grid  # every centroid twice: the smaller number counts
    x = [[0.5, 0.5]] * 200 + [[3.5, 2.0]] * 40 + [[1e6, -1e6], [float("nan"), 0.0]] + grid
    df, names = frame(spark, x)
    with pytest.raises(Exception, match="missing features"):
        assign(df, names, c, limit=1024).collect()
    (found,) = by_id(assign(df, names, c, limit=1024, missing="null"), "cluster")
    good = [i for i, r in enumerate(x) if r[0] == r[0]]
    expected = numpy_nearest(np.array(x)[good], np.array(c))[0].tolist()
    assert [found[i] for i in good] == expected and [found[i] for i in range(len(x)) if i not in good] == [None]


def test_far_clusters_are_compared_with_few_balls(spark):
    draw = np.random.default_rng(3)
    c = np.vstack([draw.normal(m, 0.5, (100, 3)) for m in (-50, 0, 50, 100)])
    x = c + draw.normal(size=c.shape) * 0.01
    df, names = frame(spark, c)
    index = index_centroids(df.withColumnRenamed("id", "cluster"), names, 4096)
    rows, balls = index.candidates(x)
    assert len(rows) < 0.5 * len(x) * len(index.centres)
    table = assign(frame(spark, x)[0], names, df.withColumnRenamed("id", "cluster"), limit=4096)
    assert by_id(table, "cluster")[0] == numpy_nearest(x, c)[0].tolist()


def test_an_index_too_large_is_refused(spark):
    df, names = frame(spark, np.random.default_rng(4).standard_normal((100, 4)))
    with pytest.raises(ValueError, match="index of more than 512 bytes"):
        assign(df, names, np.random.default_rng(5).standard_normal((100, 4)).tolist(), limit=512)
    with pytest.raises(ValueError, match="non-empty"):
        index_centroids(df.limit(0).withColumnRenamed("id", "cluster"), names)
    assert clustering.CENTROID_BYTES == 64 << 20


def test_rows_meet_balls_without_a_shuffled_copy_for_each(spark, monkeypatch):
    """Shuffled are the blocks' results; a row without finite distances has none, ties in several balls go to the smallest."""
    monkeypatch.setattr(centroid_index, "LEAF_ROWS", 4)
    monkeypatch.setattr(centroid_index, "GROUP_ROWS", 16)
    c = [[float(i), float(j)] for i in range(8) for j in range(8)]
    x = [[i + 0.5, j + 0.5] for i in range(7) for j in range(7)] + [[float("inf"), 1.0]]
    df, names = frame(spark, c)
    index = index_centroids(df.withColumnRenamed("id", "cluster"), names, 4096)
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(x)], "row bigint, x array<double>").repartition(3).persist()
    rows.count()
    found = centroid_index.search_index(index, rows)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "CartesianProduct" in plan and "CoGroup" not in plan
    assert {r["row"]: r["cluster"] for r in found.collect()} == dict(enumerate(numpy_nearest(np.array(x[:-1]), np.array(c))[0].tolist()))
