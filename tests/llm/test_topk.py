import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from segwatch.llm import topk


def plain(rows, k):
    good = [(n, i, [math.floor(float(x) * 64) for x in v]) for n, (i, v) in enumerate(rows)
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, v in good:
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, j, w in good if m != n and len(w) == len(v))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def result(df, **more):
    return sorted(map(tuple, topk.exact_top_k(df, F.col("vec_id") % 20 == 0, **more).collect()))


@pytest.mark.parametrize("block", [16384, 64, 7])
def test_blocks_of_any_size(spark, block):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(6)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    exact = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert result(df, k=20, candidate_block=block, query_block=block) == plain(exact, 20)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [-1.0, 0.5]), (None, [1.0, 1.0]), (20, [1.0, 2.0]), (7, [1.0]), (40, []), (60, None), (8, [1e30, -3.0][:0] + [5.0, 0.01])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit("x")).withColumn("rank", F.lit(1))
    assert result(df, k=3) == plain(rows, 3)
    assert result(df.limit(0)) == []


def test_large_components_stay_exact(spark):
    rows = [(20, [3e6, -2e6]), (1, [1e6, 5e6]), (2, [1e6 + 1 / 64, 5e6]), (3, [4e6, 1e6])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert result(df, k=2) == plain(rows, 2)


def test_many_equal_vectors(spark):
    df = spark.range(2000).select(F.col("id").alias("vec_id"), F.array(*(F.lit(x) for x in (0.5, 0.25, -0.1))).alias("embedding"))
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert result(df, k=20, candidate_block=300) == plain(rows, 20)


def test_lists_are_not_read_to_their_end_when_bounds_settle():
    rng = np.random.default_rng(1)
    rows = rng.integers(-3, 3, (4000, 4)).astype("float64")
    rows[:30] = 40
    q, r = topk.read_sorted_lists(np.array([[1.0, 2.0, 1.0, 3.0]]), rows, 20)
    assert set(range(20)) <= set(r.tolist()) and len(r) < 200
