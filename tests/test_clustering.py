import glob
import hashlib
import math
import os

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from reference_math import lloyd as numpy_lloyd
from reference_math import nearest as numpy_nearest

from segwatch.functions import storage
from segwatch.functions.distance import nearest
from segwatch.operators import clustering
from segwatch.operators.clustering import assign, centroid_sums, fit_kmeans, lloyd, sorted_centroids
from segwatch.operators.scaling import apply_scaler, fit_scaler
from segwatch.sources.blobs import blob_centres, generate_blobs


def frame(spark, values, parts=3):
    values = np.asarray(values, dtype=float)
    names = [f"f{i}" for i in range(values.shape[1])]
    pdf = pd.DataFrame(values, columns=names)
    pdf.insert(0, "id", range(len(values)))
    return spark.createDataFrame(pdf).repartition(parts), names


def by_id(df, *columns):
    rows = df.orderBy("id").collect()
    return [[r[c] for r in rows] for c in columns]


@pytest.mark.parametrize("terms", [clustering.UNROLLED_TERMS, 0])
def test_assignment_equals_numpy_on_both_ways(spark, monkeypatch, terms):
    monkeypatch.setattr(clustering, "UNROLLED_TERMS", terms)
    rng = np.random.default_rng(1)
    x, c = rng.standard_normal((300, 5)), rng.standard_normal((7, 5))
    df, names = frame(spark, x)
    labels, squared = numpy_nearest(x, c)
    found, distance = by_id(assign(df, names, c.tolist(), distance="d"), "cluster", "d")
    assert found == labels.tolist()
    assert np.allclose(distance, squared, atol=1e-12)


@pytest.mark.parametrize("terms", [clustering.UNROLLED_TERMS, 0])
def test_equidistant_point_goes_to_the_lower_cluster(spark, monkeypatch, terms):
    monkeypatch.setattr(clustering, "UNROLLED_TERMS", terms)
    df, names = frame(spark, [[0.0], [1.0], [2.0]])
    assert by_id(assign(df, names, [[2.0], [0.0], [0.0]]), "cluster")[0] == [1, 0, 0]


@pytest.mark.parametrize("terms", [clustering.UNROLLED_TERMS, 0])
def test_missing_features_fail_or_give_null(spark, monkeypatch, terms):
    monkeypatch.setattr(clustering, "UNROLLED_TERMS", terms)
    df = spark.createDataFrame([(0, 1.0), (1, None), (2, float("nan"))], "id int, f0 double")
    labels, distance = by_id(assign(df, ["f0"], [[0.0], [1.0]], distance="d", missing="null"), "cluster", "d")
    assert labels == [1, None, None]
    assert distance[0] == 0.0 and distance[1] is None and distance[2] is None
    with pytest.raises(Exception, match="missing features"):
        assign(df, ["f0"], [[0.0], [1.0]]).collect()


def test_assignment_keeps_columns_and_uses_the_scaler_only_inside(spark):
    df, names = frame(spark, [[0.0, 10.0], [4.0, 20.0], [8.0, 90.0]])
    scaler = fit_scaler(df, names)
    inside = assign(df, names, [[-1.0, -1.0], [1.0, 1.0]], scaler)
    outside = assign(apply_scaler(df, scaler), names, [[-1.0, -1.0], [1.0, 1.0]])
    assert inside.columns == ["id", *names, "cluster"]
    assert by_id(inside, "cluster") == by_id(outside, "cluster")
    assert by_id(inside, *names) == by_id(df, *names)


def test_assignment_plan_is_one_narrow_stage(spark):
    df, names = frame(spark, np.ones((4, 3)))
    plain = spark.range(4).select(*(F.col("id").cast("double").alias(n) for n in names))
    plan = assign(plain, names, [[0.0] * 3, [1.0] * 3])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_centroid_checks(spark):
    df, names = frame(spark, np.ones((2, 2)))
    with pytest.raises(ValueError):
        assign(df, names, [])
    with pytest.raises(ValueError):
        assign(df, names, [[1.0]])
    with pytest.raises(ValueError, match="are needed"):
        assign(df, [*names, "g"], [[1.0, 1.0, 1.0]])


@pytest.mark.parametrize("terms", [clustering.UNROLLED_TERMS, 0])
def test_sums_of_several_starts_and_a_hot_cluster(spark, monkeypatch, terms):
    monkeypatch.setattr(clustering, "UNROLLED_TERMS", terms)
    rng = np.random.default_rng(5)
    x = np.vstack([rng.standard_normal((60, 2)), np.zeros((200, 2))])
    df, names = frame(spark, x)
    starts = [[[0.0, 0.0], [2.0, 2.0]], [[1.0, 0.0], [0.0, 1.0], [9.0, 9.0]]]
    for chosen in (starts, starts[:1]):
        rows = {(r["start"], r["cluster"]): r for r in centroid_sums(df, names, chosen).collect()}
        for s, points in enumerate(chosen):
            labels, squared = numpy_nearest(x, points)
            for j in range(len(points)):
                mine = labels == j
                if not mine.any():
                    assert (s, j) not in rows
                    continue
                row = rows[s, j]
                assert row["n"] == mine.sum()
                assert row["cost"] == pytest.approx(squared[mine].sum())
                assert [row["sum_0"], row["sum_1"]] == pytest.approx(x[mine].sum(axis=0).tolist(), abs=1e-9)


def test_lloyd_equals_numpy_and_keeps_an_empty_cluster(spark):
    x = np.random.default_rng(2).standard_normal((200, 3))
    start = [[0.0, 0.0, 0.0], [1.0, 1.0, 1.0], [50.0, 50.0, 50.0]]
    df, names = frame(spark, x)
    model = lloyd(df, names, start, max_iter=4)
    assert np.allclose(model.centroids, numpy_lloyd(x, start, 4))
    assert model.centroids[2] == (50.0, 50.0, 50.0)
    assert model.inertia == pytest.approx(numpy_nearest(x, model.centroids)[1].sum())


def test_lloyd_never_raises_the_inertia_and_stops_when_settled(spark):
    x = np.random.default_rng(3).standard_normal((150, 2))
    df, names = frame(spark, x)
    costs = [lloyd(df, names, x[:4].tolist(), max_iter=t).inertia for t in range(5)]
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))
    settled = lloyd(df, names, x[:4].tolist(), max_iter=300)
    assert settled.iterations < 300
    again = lloyd(df, names, settled.centroids, max_iter=300)
    assert again.iterations == 0 and again.inertia == pytest.approx(settled.inertia)


def plain_seeds(x, names, k, seed, restart):
    """The weighted draw row by row: smallest digest first, then smallest -ln(u) / d."""
    word = lambda name, step: int(hashlib.md5(f"{name}|{seed}|{restart}|{step}".encode()).hexdigest()[:15], 16)
    chosen = [min(range(len(x)), key=lambda i: word(names[i], 0))]
    for step in range(1, k):
        d = ((x[:, None, :] - x[chosen][None]) ** 2).sum(axis=2).min(axis=1)
        draw = lambda i: -math.log((word(names[i], step) + 0.5) / 2.0**60) / d[i]
        chosen.append(min((i for i in range(len(x)) if d[i] > 0), key=draw))
    return x[chosen]


def test_seeds_are_the_weighted_draw_on_any_partitioning(spark):
    x = np.random.default_rng(6).standard_normal((120, 2))
    for parts in (1, 4, 8):
        df = spark.createDataFrame([(i, *map(float, row)) for i, row in enumerate(x)], "id int, f0 double, f1 double").repartition(parts)
        for limit in (1, 10_000):
            clustering.UNROLLED_TERMS, kept = limit, clustering.UNROLLED_TERMS
            try:
                starts = clustering.seed_centroids(df, ["f0", "f1"], ["id"], 5, 7, 3)
            finally:
                clustering.UNROLLED_TERMS = kept
            for r, points in enumerate(starts):
                assert np.allclose(points, plain_seeds(x, range(len(x)), 5, 7, r))


def test_one_model_on_any_partitioning(spark):
    x = np.random.default_rng(7).standard_normal((400, 3))
    rows = [(i, *map(float, row)) for i, row in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, f0 double, f1 double, f2 double")
    names = ["f0", "f1", "f2"]
    models = [fit_kmeans(df.repartition(p), names, k=5, n_init=4, keys=["id"]) for p in (1, 4, 8)]
    for model in models:
        assert np.allclose(model.centroids, models[0].centroids, atol=1e-9) and model.iterations == models[0].iterations
    plain = []
    for r in range(4):
        points = plain_seeds(x, range(len(x)), 5, 42, r)
        for _ in range(300):
            moved = numpy_lloyd(x, points, 1)
            shift = ((moved - points) ** 2).sum()
            points = moved
            if shift <= 1e-4 * x.var(axis=0).mean():
                break
        plain.append((numpy_nearest(x, points)[1].sum(), points))
    cost, points = min(plain, key=lambda p: p[0])
    assert models[0].inertia == pytest.approx(cost) and np.allclose(models[0].centroids, points)


def test_a_task_of_the_fit_holds_a_bounded_group_of_blocks(spark, monkeypatch):
    """A row group is decoded as a whole where it is read, and nothing else of the table is kept in memory meanwhile."""
    monkeypatch.setattr(storage, "GROUP_BYTES", 1 << 20, raising=False)
    df, names = frame(spark, np.random.default_rng(23).standard_normal((60_000, 16)), parts=1)
    folder, cached = storage._session_folder(spark), []
    before, whole = set(glob.glob(f"{folder}/*")), clustering.BoundedLloyd.run
    held = spark.sparkContext._jsc.getPersistentRDDs().size()

    def run(self, starts):
        cached.append(spark.sparkContext._jsc.getPersistentRDDs().size() - held)
        return whole(self, starts)

    monkeypatch.setattr(clustering.BoundedLloyd, "run", run)
    fit_kmeans(df, names, k=2, n_init=1, max_iter=2, keys=["id"])
    blocks = [f for d in set(glob.glob(f"{folder}/*")) - before if "/blocks-" in d for f in glob.glob(os.path.join(d, "*.parquet"))]
    files = [pq.ParquetFile(f).metadata for f in blocks]
    groups = [m.row_group(i).total_byte_size for m in files for i in range(m.num_row_groups)]
    assert sum(groups) > 7 << 20 and max(groups) <= 3 << 20 and cached == [0]


def test_fit_finds_separated_blobs(spark):
    blobs = generate_blobs(spark, 1200)
    names = [f"feature_{i}" for i in range(1, 5)]
    model = sorted_centroids(fit_kmeans(blobs, names, 4, n_init=4, keys=["id"], tol=0.0))
    means = blobs.groupBy("true_label").agg(*(F.avg(n) for n in names)).collect()
    expected = np.array(sorted(tuple(r)[1:] for r in means))
    assert np.abs(np.array(model.centroids) - expected).max() < 0.2
    values = blobs.select(*names).toPandas().to_numpy()
    assert model.inertia == pytest.approx(numpy_nearest(values, model.centroids)[1].sum())
    # A settled fit does not move any more.
    assert np.allclose(numpy_lloyd(values, model.centroids, 1), model.centroids)


def test_many_centroids_travel_in_several_passes(spark, monkeypatch):
    x = np.random.default_rng(8).standard_normal((60, 2))
    df, names = frame(spark, x)
    starts = [x[i:i + 3].tolist() for i in range(5)]
    whole = {(r["start"], r["cluster"]): r["n"] for r in centroid_sums(df, names, starts).collect()}
    monkeypatch.setattr(clustering, "CENTROID_BYTES", 2 * 3 * 2 * 8)
    assert {(r["start"], r["cluster"]): r["n"] for r in centroid_sums(df, names, starts).collect()} == whole


def test_fit_without_a_key_on_mostly_equal_rows(spark):
    df = spark.range(0, 1200, 1, 4).select(
        F.when(F.col("id") < 800, F.lit(0.0)).otherwise(100.0 + (F.col("id") % 2) * 50).alias("f0")
    )
    model = sorted_centroids(fit_kmeans(df, ["f0"], k=3, n_init=3))
    assert model.centroids == ((0.0,), (100.0,), (150.0,)) and model.inertia == 0.0


def test_fit_checks_its_input(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "f0 double")
    with pytest.raises(ValueError, match="'f0': 2"):
        fit_kmeans(df, ["f0"], k=1)
    with pytest.raises(ValueError, match="cannot form"):
        fit_kmeans(spark.createDataFrame([(1.0,)], "f0 double"), ["f0"], k=2)
    with pytest.raises(ValueError, match="f0"):
        fit_kmeans(spark.createDataFrame([(1.0,), (float("inf"),)], "f0 double"), ["f0"], k=1)


def test_fit_on_fewer_distinct_rows_than_clusters(spark):
    df = spark.createDataFrame([(0.0,)] * 30 + [(9.0,)] * 5, "f0 double")
    model = fit_kmeans(df, ["f0"], k=4, n_init=2)
    assert model.inertia == pytest.approx(0.0, abs=1e-12)
    assert {0.0, 9.0} <= {c[0] for c in model.centroids}


def test_blobs_do_not_depend_on_partitioning(spark):
    one = generate_blobs(spark, 500, 6, 3)
    assert one.columns == ["id", *(f"feature_{i}" for i in range(1, 7)), "true_label"]
    assert sorted(one.collect()) == sorted(generate_blobs(spark, 500, 6, 3).repartition(7).collect())
    values = one.toPandas()
    assert values.true_label.value_counts().max() - values.true_label.value_counts().min() <= 1
    for label, centre in enumerate(blob_centres(3, 6)):
        mine = values[values.true_label == label]
        for f, at in enumerate(centre):
            assert abs(mine[f"feature_{f + 1}"].mean() - at) < 0.5
            assert abs(mine[f"feature_{f + 1}"].std() - 1.2) < 0.3
    normals = values[[f"feature_{i}" for i in range(1, 7)]].groupby(values.true_label).transform(lambda c: c - c.mean())
    correlation = np.corrcoef(normals.to_numpy().T) - np.eye(6)
    assert np.abs(correlation).max() < 0.2


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.integers(1, 6), st.integers(1, 5), st.integers(0, 10_000))
def test_nearest_breaks_ties_to_the_lowest_index(k, width, seed):
    rng = np.random.default_rng(seed)
    points = rng.integers(-2, 3, (k, width)).astype(float) + 1e6
    rows = rng.integers(-2, 3, (20, width)).astype(float) + 1e6
    labels, squared = numpy_nearest(rows, points)
    found, distance = nearest(rows, points)
    assert found.tolist() == labels.tolist() and np.allclose(distance, squared)
