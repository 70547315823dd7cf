"""Hard negatives against plain products, and the tables and planes by themselves."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from segwatch.llm.hard_negatives import hard_negatives, lookup_scores, numbers_of, planes_of, subset_sums

SCHEMA = "vec_id bigint, embedding array<double>, label int, score string, n int"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@pytest.mark.parametrize("largest", [0, 1, 255, 2**40, 2**90])
@pytest.mark.parametrize("d", [1, 8, 13, 64])
def test_lookups_are_products(largest, d):
    draw = random.Random(d)
    rows = [[draw.randint(-largest - 1, largest) for _ in range(d)] for _ in range(40)]
    kind = "int64" if largest < 2**62 else object
    x = np.array(rows, dtype=kind)
    width, planes = planes_of(x)
    assert (numbers_of(width, planes, d) == x).all()
    anchor = np.array(rows[3], dtype=object)
    expected = [sum(a * b for a, b in zip(rows[3], row)) for row in rows]
    assert lookup_scores(subset_sums(anchor), width, planes).tolist() == expected


def plain(rows, modulus=10):
    good = [
        (i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = Counter()
    for i, v, label in good:
        if i % modulus:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in good if len(w) == len(v))
        for s, j, other in [t for t in scored if t[2] == label and t[1] != i][:5]:
            near = [t for t in scored if t[2] != label and 80 * -s <= 100 * -t[0] <= 100 * -s][:5]
            out.update((i, j, rank, t[1], -s, -t[0]) for rank, t in enumerate(near, 1))
    return out


def found(spark, rows, modulus=10, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = hard_negatives(df, F.col("vec_id") % modulus == 0, **options)
    return Counter(tuple(r[c] for c in COLUMNS) for r in got.select(*COLUMNS).collect())


def test_random_rows_in_small_blocks(spark):
    draw = np.random.default_rng(4)
    base = draw.normal(size=16)
    rows = [(i, (base + draw.normal(size=16) * 0.4).tolist(), int(draw.integers(0, 4))) for i in range(300)]
    rows += [(500 + i, base.tolist(), i % 3) for i in range(100)]  # ties and one vector with many rows
    expected = plain(rows)
    assert len(expected) > 100
    assert found(spark, rows, candidate_block=64, anchor_block=16) == expected


def test_edges(spark):
    inf, nan = math.inf, math.nan
    v = [0.5, 0.25, -0.1]
    rows = [
        (0, v, 1), (0, v, 1), (1, v, 1), (2, [0.5, 0.24, -0.1], 2), (3, None, 1), (4, [0.1, None, 0.2], 1), (5, [nan, 0.0, 0.0], 1),
        (6, [inf, 0.0, 0.0], 2), (None, v, 1), (7, v, None), (8, [], 1), (9, v[:2], 2), (10, v[:2], 1), (11, v[:2], 1), (12, [], 2), (20, [], 1),
        (30, [0.0] * 3, 2), (31, [-1.0] * 3, 2), (40, [-9.0, 4.0, 1.0], 3), (50, [1e10, -3.0, 1.0], 4), (51, [1e3, 2.0, 1.0], 4), (52, [0.7e3, 2.0, 1.0], 5),
    ]
    assert found(spark, rows) == plain(rows)
    with pytest.raises(Exception, match="does not fit a bigint"):
        found(spark, [(0, [1e30], 1), (1, [1e30], 1)])
    assert found(spark, []) == Counter()
