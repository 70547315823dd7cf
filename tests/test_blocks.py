"""Lloyd iterations with bounds against plain ones, and what they leave unvisited."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from test_clustering import numpy_lloyd, numpy_nearest
from segwatch.operators import blocks
from segwatch.operators.blocks import BoundedLloyd, Centres, pack_rows


def packed(spark, x, parts):
    names = [f"f{i}" for i in range(x.shape[1])]
    rows = [(i, *map(float, row)) for i, row in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{n} double" for n in names)).repartition(parts)
    return pack_rows(df, names, ["id"]).select("n", "body").cache()


def plain(x, points, max_iter, tol):
    for _ in range(max_iter):
        moved = numpy_lloyd(x, points, 1)
        shift = ((moved - points) ** 2).sum()
        points = moved
        if shift <= tol:
            break
    return points


def clusters(seed, n=1200, spread=0.6):
    draw = np.random.default_rng(seed)
    return np.vstack([draw.normal(c, spread, (n // 4, 3)) for c in (-4, 0, 4, 9)])


@pytest.mark.parametrize("one_task", [True, False])
@pytest.mark.parametrize("parts", [1, 8])
def test_restarts_end_where_plain_ones_do(spark, monkeypatch, parts, one_task):
    if not one_task:
        monkeypatch.setattr(blocks, "VISITED_BYTES", 0)
    monkeypatch.setattr(blocks, "BLOCK_ROWS", 64)
    x = np.vstack([clusters(1), np.random.default_rng(2).standard_normal((600, 3)) * 3])
    draw = np.random.default_rng(3)
    starts = [x[draw.choice(len(x), k, replace=False)] for k in (4, 4, 5, 1, 2)]
    tol = 1e-9
    run = BoundedLloyd(packed(spark, x, parts), len(x), 60, tol)
    for start, restart in zip(starts, run.run([s.tolist() for s in starts])):
        expected = plain(x, start, 60, tol)
        assert np.allclose(restart.points, expected, atol=1e-9)
        assert restart.cost == pytest.approx(numpy_nearest(x, expected)[1].sum())
    kinds = {k for k, _ in run.passes}
    assert "part" in kinds and ("one task each" if one_task else "visit") in kinds


def test_settled_rows_cost_nothing(spark):
    """With far clusters a few passes see all rows and the steps after them hardly any."""
    x = clusters(5, 4000)
    start = x[[0, 10, 1000, 3999]]
    run = BoundedLloyd(packed(spark, x, 2), len(x), 100, 0.0)
    restart = run.run([start.tolist()])[0]
    whole = sum(n for k, n in run.passes if k in ("step", "part"))
    visited = sum(n for k, n in run.passes if k not in ("step", "part", "cost"))
    assert restart.settled and np.allclose(restart.points, plain(x, start, 100, 0.0))
    assert whole < 0.5 * restart.tries * len(x) and visited < 0.2 * len(x) * restart.tries


def test_margins_bound_what_can_change():
    """No row with a margin above the two largest moves changes its cluster."""
    draw = np.random.default_rng(7)
    for _ in range(200):
        x, points = draw.normal(size=(300, 2)) * 2, draw.normal(size=(5, 2))
        moved = points + draw.normal(size=(5, 2)) * draw.choice([0.01, 0.1, 0.5])
        best, _, margin = Centres.of([points]).rank(x)
        rests = margin[0] > blocks._two_largest(moved - points)
        assert (numpy_nearest(x[rests], moved)[0] == best[0][rests]).all()


def test_ties_go_to_the_lowest_and_never_rest():
    x, points = np.zeros((3, 2)) + 1e6, np.array([[1e6 + 1, 1e6], [1e6 - 1, 1e6], [1e6, 1e6 + 1]])
    best, squared, margin = Centres.of([points, points[:1]]).rank(x)
    assert best.tolist() == [[0, 0, 0], [0, 0, 0]] and (margin[0] <= 0).all() and np.isinf(margin[1]).all()


def test_digests_of_many_keys_are_those_of_each():
    names = ["", "1|2|3", "é", "x" * 47, "x" * 50, "x" * 51, "x" * 64, "y" * 200, "a\x00b"]
    encoded = [n.encode() for n in names]
    marks = np.concatenate([[0], np.cumsum([len(e) for e in encoded])])
    texts = blocks.Digests(np.frombuffer(b"".join(encoded), dtype="uint8"), marks, b"|42|")
    for end in (b"0|0", b"9|3", b"10|1", b"0|1"):
        expected = [int.from_bytes(hashlib.md5(e + b"|42|" + end).digest()[:8], "big") for e in encoded]
        assert texts.ending(end).tolist() == expected


def test_keys_are_packed_as_bytes(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (22, None, 1.5), (333, "é", 2.5)], "k long, t string, f double").coalesce(1)
    packed = pack_rows(df, ["f"], ["k", "t"]).collect()
    text, ends = b"".join(r["names"] for r in packed), np.cumsum([n for r in packed for n in np.frombuffer(r["lengths"], dtype="int32")])
    found = [text[a:b].decode() for a, b in zip([0, *ends], ends)]
    assert sorted(found) == ["1|a", "22", "333|é"]


def test_restarts_go_on_side_by_side(spark, monkeypatch):
    """Restarts that go on in a task each get a given number of parts, which Spark does not join to one as their rows look few."""
    x = clusters(8, 2000)
    table, parts = packed(spark, x, 2), []
    whole = type(table).repartition
    monkeypatch.setattr(type(table), "repartition", lambda self, n, *by: (parts.append((n, by)), whole(self, n, *by))[1])
    starts = [x[np.random.default_rng(i).choice(len(x), 4, replace=False)].tolist() for i in range(4)]
    run = BoundedLloyd(table, len(x), 100, 0.0)
    for start, restart in zip(starts, run.run(starts)):
        assert np.allclose(restart.points, plain(x, np.array(start), 100, 0.0))
    assert parts and max(n for n, _ in parts) >= len(starts) and {by for _, by in parts} == {("restart",)}
