import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segwatch.operators import rows
from segwatch.operators.rows import before_middle, before_rank, bounded_sample, head, split_at_rank, split_halves, value_at_rank
from segwatch.operators.summary import row_count, value_counts


def keyed(spark, n, parts=4):
    return spark.range(0, n, 1, parts).withColumn("v", (F.col("id") * 7) % 11)


def test_sample_does_not_depend_on_partitioning(spark):
    for n in (3, 50):
        first = {r["id"] for r in bounded_sample(keyed(spark, 1000, 1), ["id"], n).collect()}
        again = {r["id"] for r in bounded_sample(keyed(spark, 1000, 7).orderBy(F.desc("id")), ["id"], n).collect()}
        assert first == again and len(first) == n


def test_sample_is_the_smallest_hashes(spark):
    df = keyed(spark, 500)
    digest = F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit("42")))
    expected = {r["id"] for r in df.orderBy(digest).limit(100).collect()}
    assert {r["id"] for r in bounded_sample(df, ["id"], 100).collect()} == expected


def test_sample_of_more_rows_than_there_are_is_the_table(spark):
    assert bounded_sample(keyed(spark, 20), ["id"], 2000).count() == 20


def test_sample_with_one_hot_key_stays_bounded(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1500, F.lit(0)).otherwise(F.col("id")).alias("k"))
    assert bounded_sample(df, ["k"], 100).count() == 100


def test_head(spark):
    assert [r["id"] for r in head(keyed(spark, 30).orderBy(F.desc("id")), ["id"]).collect()] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("small", [10_000, 5])
def test_value_at_rank_with_hot_values(spark, monkeypatch, small):
    monkeypatch.setattr(rows, "SMALL_RANGE", small)
    values = [5] * 400 + [1, 2, 3, 9, 8, 7] * 20 + list(range(100))
    random.Random(3).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(5)
    ordered = sorted(values)
    for rank in (0, 1, 100, 310, len(values) // 2, len(values) - 1):
        expected = ordered[rank]
        below = sum(v < expected for v in values)
        assert value_at_rank(df, "v", rank) == (expected, below, values.count(expected))
    with pytest.raises(IndexError):
        value_at_rank(df, "v", len(values))


@pytest.mark.parametrize("small", [10_000, 5])
def test_value_at_rank_of_text_and_time(spark, monkeypatch, small):
    monkeypatch.setattr(rows, "SMALL_RANGE", small)
    words = [f"w{i * 7919 % 997:04d}" for i in range(300)]
    start = dt.datetime(2024, 3, 31, 0, 30)
    df = spark.createDataFrame(
        [(w, start + dt.timedelta(minutes=i)) for i, w in enumerate(words)], "w string, t timestamp_ntz"
    )
    assert value_at_rank(df, "w", 150)[0] == sorted(words)[150]
    assert value_at_rank(df, "t", 150)[:2] == (start + dt.timedelta(minutes=150), 150)


@pytest.mark.parametrize("small", [10_000, 3])
def test_split_on_compound_key(spark, monkeypatch, small):
    monkeypatch.setattr(rows, "SMALL_RANGE", small)
    keys = [(a, b) for a in ("x", "y", "y2") for b in range(40)]
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame(keys, "a string, b int").repartition(3)
    for rank in (0, 1, 40, 41, 77, 120, 500):
        first, second = split_at_rank(df, ["a", "b"], rank)
        assert sorted((r.a, r.b) for r in first.collect()) == sorted(keys)[:rank]
        assert sorted((r.a, r.b) for r in second.collect()) == sorted(keys)[rank:]


def test_split_needs_an_order_that_tells_rows_apart(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    with pytest.raises(ValueError, match="apart"):
        before_rank(df, ["k"], 2)
    assert split_at_rank(df, ["k"], 1)[0].count() == 1
    with pytest.raises(ValueError, match="missing"):
        before_rank(spark.createDataFrame([(1,), (None,)], "k int"), ["k"], 1)


def test_halves_take_the_position_from_the_reference(spark):
    reference, current = keyed(spark, 10), keyed(spark, 7).withColumn("id", F.col("id") + 100)
    first, second = split_halves(reference, current, ["id"])
    assert sorted(r["id"] for r in first.collect()) == [0, 1, 2, 3, 4]
    assert sorted(r["id"] for r in second.collect()) == [105, 106]
    _, none_left = split_halves(reference, keyed(spark, 4), ["id"])
    assert none_left.count() == 0
    a, b = split_halves(keyed(spark, 9), keyed(spark, 9), ["id"])
    assert (a.count(), b.count()) == (4, 5)


def jobs_of(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_split_takes_at_most_six_jobs(spark, data):
    lineitem = spark.read.parquet(data("0.01", "lineitem"))
    order = ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    assert lineitem.count() > rows.SMALL_RANGE
    found = []
    assert jobs_of(spark, "split", lambda: found.append(before_middle(lineitem, order))) <= 6
    assert lineitem.where(found[0]).count() == lineitem.count() // 2


@pytest.mark.parametrize("kind", ["smallint", "bigint", "float", "double", "decimal(12,3)", "decimal(30,5)", "date", "timestamp", "timestamp_ntz", "string"])
def test_split_by_any_type_of_column(spark, monkeypatch, kind):
    monkeypatch.setattr(rows, "SMALL_RANGE", 4)
    number = F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise(F.col("id") - 90)
    seconds = F.timestamp_seconds(F.lit(1_711_843_200) + number * 1800)
    value = seconds.cast(kind) if kind.startswith(("date", "time")) else number.cast(kind)
    df = spark.range(0, 300, 1, 5).select(value.alias("v"), "id")
    ordered = [r["id"] for r in df.orderBy("v", "id").collect()]
    for rank in (0, 1, 130, 299):
        assert sorted(r["id"] for r in df.where(before_rank(df, ["v", "id"], rank)).collect()) == sorted(ordered[:rank])
    assert sorted(r["id"] for r in df.where(before_middle(df, ["v", "id"])).collect()) == sorted(ordered[:150])


def test_split_is_a_filter_without_shuffle(spark, data):
    lineitem = spark.read.parquet(data("0.001", "lineitem"))
    first, _ = split_at_rank(lineitem, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], 3000)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PushedFilters: [Or(" in plan


@settings(max_examples=5, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=60), st.data())
def test_value_at_rank_property(spark, values, draw):
    rank = draw.draw(st.integers(0, len(values) - 1))
    df = spark.createDataFrame([(v,) for v in values], "v int")
    assert value_at_rank(df, "v", rank)[0] == sorted(values)[rank]


def test_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (0,), (2,), (2,), (None,)], "cluster int")
    assert [(r[0], r[1]) for r in value_counts(df, "cluster").collect()] == [(0, 1), (1, 2), (2, 2)]
    assert [(r[0], r[1]) for r in value_counts(df, "cluster", by_frequency=True).collect()] == [(1, 2), (2, 2), (0, 1)]
    assert row_count(df).head()["n"] == 6
    assert row_count(df, F.col("cluster") > 0).head()["n"] == 4
