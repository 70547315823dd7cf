import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from segwatch import FEATURE_COLS
from segwatch.functions.columns import require_columns
from segwatch.operators.scaling import Scaler, apply_scaler, column_moments, fit_scaler, scale_features, with_scale


def table(spark, n=100, seed=0):
    values = np.random.default_rng(seed).standard_normal((n, len(FEATURE_COLS)))
    return spark.createDataFrame(pd.DataFrame(values, columns=FEATURE_COLS))


def test_shape_is_kept(spark):
    scaled, _ = scale_features(table(spark), FEATURE_COLS)
    assert scaled.columns == list(FEATURE_COLS)
    assert scaled.count() == 100


def test_mean_zero_and_population_deviation_one(spark):
    scaled, _ = scale_features(table(spark, 500), FEATURE_COLS)
    values = scaled.toPandas().to_numpy()
    assert np.abs(values.mean(axis=0)).max() < 1e-12
    assert np.abs(values.std(axis=0) - 1).max() < 1e-12


def test_missing_column_is_named_before_any_job(spark):
    with pytest.raises(ValueError, match=r"Columns \['feature_1'\] are needed"):
        scale_features(table(spark).drop("feature_1"), FEATURE_COLS)
    with pytest.raises(ValueError, match=r"\['a', 'b'\]"):
        require_columns(table(spark), ["a", "feature_1", "b"])


def test_population_not_sample_deviation_and_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    scaler = fit_scaler(df, ["a", "b"])
    assert scaler.stds[0] == pytest.approx(1.247219128924647)
    assert scaler.scales[1] == 1.0
    later = apply_scaler(spark.createDataFrame([(1.0, 7.0)], "a double, b double"), scaler).head()
    assert later["b"] == 2.0


def test_nearly_constant_column_divides_by_one(spark):
    df = spark.createDataFrame([(1e9 + (i % 2) * 1e-7,) for i in range(1000)], "a double")
    assert fit_scaler(df, ["a"]).scales == (1.0,)


def test_null_and_nan_are_ignored_per_feature(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0), (None, 2.0), (float("nan"), 3.0), (3.0, None)], "a double, b double"
    )
    rows = {r["feature"]: r for r in column_moments(df, ["a", "b"]).collect()}
    assert (rows["a"]["n"], rows["b"]["n"], rows["a"]["n_rows"]) == (2, 3, 4)
    assert rows["a"]["mean"] == 2.0 and rows["a"]["std"] == 1.0
    with pytest.raises(ValueError, match="'a': 2"):
        fit_scaler(df, ["a", "b"], allow_missing=False)
    out = apply_scaler(df, fit_scaler(df, ["a", "b"])).collect()
    assert out[1]["a"] is None and math.isnan(out[2]["a"])


def test_empty_and_infinite_input_raise(spark):
    empty = spark.createDataFrame([], "a double")
    with pytest.raises(ValueError, match="empty"):
        fit_scaler(empty, ["a"])
    with pytest.raises(ValueError, match="finite"):
        fit_scaler(spark.createDataFrame([(1.0,), (float("inf"),)], "a double"), ["a"])


def test_table_round_trip(spark):
    scaler = fit_scaler(table(spark), FEATURE_COLS)
    assert Scaler.from_table(scaler.to_table(spark)) == scaler


def test_moments_by_group_equal_moments_of_each_group(spark):
    df = spark.createDataFrame([(g, float(v)) for g in "xy" for v in range(ord(g) % 7 + 2)], "g string, v double")
    for row in column_moments(df, ["v"], by=["g"]).collect():
        alone = column_moments(df.where(df.g == row["g"]), ["v"]).head()
        assert (row["n"], row["mean"], row["std"]) == (alone["n"], alone["mean"], alone["std"])


@settings(max_examples=5, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=2, max_size=40))
def test_scaled_output_is_standard(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "a double")
    scaled, scaler = scale_features(df, ["a"])
    out = np.array([r["a"] for r in scaled.collect()])
    assert abs(out.mean()) < 1e-6
    if scaler.scales[0] == scaler.stds[0]:
        assert out.std() == pytest.approx(1.0, abs=1e-6)


def test_constant_columns_follow_one_rule_at_every_number_of_rows(spark):
    def moments(n, std):
        return spark.createDataFrame([("a", n, 1e6, std)], "feature string, n bigint, mean double, std double")

    for n in (2, 10**4, 10**12):
        assert with_scale(moments(n, 1e-7)).head()["scale"] == 1.0
        assert with_scale(moments(n, 1e-3)).head()["scale"] == 1e-3
