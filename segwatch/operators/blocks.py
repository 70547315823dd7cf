"""Lloyd iterations over packed blocks of rows, with bounds that let settled rows rest.

The feature columns are turned into matrices once and written as binary blocks; every pass reads these. How far the
second nearest centroid is beyond the nearest, a row's margin, bounds what can happen to it: while the centroids have moved
by less than the margin since (the two largest moves together), the triangle inequality keeps the row where it is. So
when the centroids have slowed down, one pass parts the rows of every restart: those with a large margin become sums
for their cluster and cost nothing from then on; only the others are visited, until the moves have used the margin up
and the rows are parted again. A restart with few rows to visit takes all its steps of that time in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segwatch.functions.columns import as_double
from segwatch.functions.storage import cut

BLOCK_ROWS = 8_192
DIGEST_ROWS = 8_192  # keys digested at once
RANKED_ROWS = 1_024  # rows ranked at once, so that all restarts' distances stay near the processor
VISITED_BYTES = 32 << 20  # rows of a restart that one task steps through; more are visited by a pass for each step
REACH = 16.0  # rows are parted so that they may rest for this many moves of the size of the last one
VISITED_SHARE = 0.4  # a restart's rows are parted when at most this share of them would have to be visited
SLACK = 1e-7  # of a row's and the centroids' size: beyond the rounding error of a margin
TIED_CELLS = 1 << 20  # differences held at once when rows are ranked again
PARTS_EACH = 4  # parts for each restart that goes on in one task, so that few share one
ACTIVE = -1
DRAW_BITS = 60


def pack_rows(df: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``n, body, names, lengths``: the rows as matrices of doubles, row after row, at most ``BLOCK_ROWS`` in one, with the rows' keys
    as text, joined by bars, end to end, and their lengths in bytes. Missing values fail."""
    name = F.concat_ws("|", *(F.col(key).cast("string") for key in keys)).alias("name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:-1]])
            if np.isnan(x).any():
                raise ValueError("cannot assign a row with missing features")
            ends, text = _ends_and_bytes(batch.column(len(features)))
            for at in range(0, len(x), BLOCK_ROWS):
                part, marks = x[at:at + BLOCK_ROWS], ends[at:at + BLOCK_ROWS + 1]
                columns = [part.tobytes(), text[marks[0]:marks[-1]].tobytes(), np.diff(marks).astype("int32").tobytes()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(part)], pa.int32()), *(pa.array([c], pa.binary()) for c in columns)], names=["n", "body", "names", "lengths"]
                )

    rows = df.select(*(as_double(f).alias(f"x{i}") for i, f in enumerate(features)), name)
    return rows.mapInArrow(run, "n int, body binary, names binary, lengths binary")


def _ends_and_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each text ends, after a zero, and the bytes of all."""
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], dtype="int64")[texts.offset:texts.offset + len(texts) + 1]
    whole = texts.buffers()[2]
    return ends, np.frombuffer(whole, dtype="uint8") if whole is not None else np.zeros(0, dtype="uint8")


def draw_seeds(blocks: DataFrame, width: int, k: int, seed: int, n_init: int) -> list[list[list[float]]]:
    """``n_init`` seedings of up to ``k`` rows each, drawn from all rows of ``blocks``.

    The first row of a restart is the one with the smallest digest of key, seed and restart. Each further one
    has the smallest ``-ln(u) / d``: ``u`` comes from the digest of key, seed, restart and step and ``d`` is the squared
    distance to the nearest row chosen so far. The smallest of such numbers belongs to a row with probability
    in proportion to its ``d``, so this is the weighted draw of k-means++, without a random generator: it depends on
    the rows alone, not on their partitions. Every step is one pass for all restarts, with one row a task and restart.
    """
    starts: list[list[list[float]]] = [[] for _ in range(n_init)]
    growing = list(range(n_init))
    fields = ", ".join(f"x{f} double" for f in range(width))
    for step in range(k):
        chosen = {i: np.asarray(starts[i]) for i in growing}

        def run(batches: Iterator[pa.RecordBatch], chosen=chosen, step=step) -> Iterator[pa.RecordBatch]:
            best: dict[int, tuple] = {}
            for batch in batches:
                for body, names, lengths in zip(*batch.columns):
                    whole, ends = _matrix(body, width), np.concatenate([[0], np.cumsum(np.frombuffer(lengths.as_buffer(), dtype="int32"))])
                    text = np.frombuffer(names.as_buffer(), dtype="uint8")
                    for at in range(0, len(whole), DIGEST_ROWS):
                        x, marks = whole[at:at + DIGEST_ROWS], ends[at:at + DIGEST_ROWS + 1]
                        texts = Digests(text, marks, f"|{seed}|".encode())
                        for i, points in chosen.items():
                            rows, score = _scores(x, texts.ending(f"{i}|{step}".encode()), points)
                            if len(rows):
                                least = rows[score == score.min()]
                                found = min((float(score.min()), *x[r].tolist()) for r in least)
                                best[i] = min(best.get(i, found), found)
            columns = list(zip(*((i, *found) for i, found in best.items()))) or [()] * (2 + width)
            kinds = [pa.int32()] + [pa.float64()] * (1 + width)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["restart", "score", *(f"x{f}" for f in range(width))])

        drawn = blocks.select("body", "names", "lengths").mapInArrow(run, f"restart int, score double, {fields}")
        row = F.struct("score", *(f"x{f}" for f in range(width)))
        found = {r["restart"]: list(r["row"])[1:] for r in drawn.groupBy("restart").agg(F.min(row).alias("row")).collect()}
        growing = [i for i in growing if i in found]
        for i in growing:
            starts[i].append(found[i])
        if not growing:
            break
    return starts


class Digests:
    """The first 64 bits of the MD5 of many texts at once: the same arithmetic on a column of each text's words."""

    SHIFTS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
    SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
    START = tuple(map(np.uint32, (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)))

    def __init__(self, text: np.ndarray, marks: np.ndarray, more: bytes):
        """Texts are what lies between the ``marks`` of ``text``, with ``more`` after each of them."""
        self.lengths, self.first, self.text, self.more = np.diff(marks), marks[:-1], text, np.frombuffer(more, dtype="uint8")
        self.padded: dict[int, list] = {}  # by the length of the ending

    def ending(self, end: bytes) -> np.ndarray:
        """Of the texts with ``end`` after them, as numbers with the digest's first byte the highest."""
        if len(end) not in self.padded:
            size = self.lengths + len(self.more) + len(end)
            blocks = (size + 8) // 64 + 1  # of 64 bytes, with the mark and the length at the end
            self.padded[len(end)] = [self._pad(np.flatnonzero(blocks == n), int(n), size) for n in np.unique(blocks)]
        out = np.empty(len(self.lengths), dtype="uint64")
        for which, padded, places in self.padded[len(end)]:
            for i, byte in enumerate(end):
                padded.reshape(-1)[places + i] = byte
            words = np.ascontiguousarray(padded.view("<u4").T)
            state = [np.full(len(which), s) for s in self.START]
            for at in range(0, len(words), 16):
                state = self._block(state, words[at:at + 16])
            out[which] = (state[0].byteswap().astype("uint64") << np.uint64(32)) | state[1].byteswap()
        return out

    def _pad(self, which: np.ndarray, blocks: int, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Some of the texts in so many blocks of bytes, and where their endings begin."""
        lengths, padded = self.lengths[which], np.zeros((len(which), 64 * blocks), dtype="uint8")
        if (longest := int(lengths.max())) > 0:
            at = np.arange(longest)
            source = np.minimum(self.first[which][:, None] + at, len(self.text) - 1)
            np.multiply(self.text[source], at < lengths[:, None], out=padded[:, :longest])
        start = np.arange(len(which)) * padded.shape[1]
        for i, byte in enumerate(self.more):
            padded.reshape(-1)[start + lengths + i] = byte
        padded.reshape(-1)[start + size[which]] = 0x80
        padded[:, -8:] = (8 * size[which]).astype("<u8").view("uint8").reshape(-1, 8)
        return which, padded, start + lengths + len(self.more)

    def _block(self, state: list[np.ndarray], words: np.ndarray) -> list[np.ndarray]:
        a, b, c, d = (s.copy() for s in state)
        mixed, turned = np.empty_like(a), np.empty_like(a)
        filled = [bool(w.any()) for w in words]
        for i in range(64):
            part = i // 16
            if part == 0:  # d ^ (b & (c ^ d))
                np.bitwise_xor(c, d, out=mixed)
                mixed &= b
                mixed ^= d
            elif part == 1:  # c ^ (d & (b ^ c))
                np.bitwise_xor(b, c, out=mixed)
                mixed &= d
                mixed ^= c
            elif part == 2:
                np.bitwise_xor(b, c, out=mixed)
                mixed ^= d
            else:  # c ^ (b | ~d)
                np.invert(d, out=mixed)
                mixed |= b
                mixed ^= c
            word = (i, 5 * i + 1, 3 * i + 5, 7 * i)[part] % 16
            a += mixed
            a += self.SINES[i]
            if filled[word]:
                a += words[word]
            shift = self.SHIFTS[part][i % 4]
            np.right_shift(a, np.uint32(32 - shift), out=turned)
            a <<= np.uint32(shift)
            a |= turned
            a += b
            a, b, c, d = d, a, b, c
        return [s + t for s, t in zip(state, (a, b, c, d))]


def _scores(x: np.ndarray, digests: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that can be drawn and their scores; the digests' first 60 bits are the draw."""
    draw = (digests >> np.uint64(64 - DRAW_BITS)).astype("float64")
    if not len(points):
        return np.arange(len(x)), draw
    near = np.full(len(x), np.inf)
    for p in points:
        away = np.zeros(len(x))
        for f in range(x.shape[1]):
            away += (x[:, f] - p[f]) ** 2
        np.minimum(near, away, out=near)
    rows = np.flatnonzero(near > 0)
    return rows, -np.log((draw[rows] + 0.5) / 2.0**DRAW_BITS) / near[rows]


@dataclass
class Centres:
    """The centroids of several restarts side by side; those with fewer have places that are never nearest."""

    points: np.ndarray  # restarts x clusters x features
    norms: np.ndarray  # squared lengths, infinite at unused places

    @classmethod
    def of(cls, sets: Sequence[np.ndarray]) -> Centres:
        most, width = max(map(len, sets)), sets[0].shape[1]
        points, norms = np.zeros((len(sets), most, width)), np.full((len(sets), most), np.inf)
        for i, s in enumerate(sets):
            points[i, :len(s)], norms[i, :len(s)] = s, (s * s).sum(axis=1)
        return cls(points, norms)

    def only(self, i: int) -> Centres:
        return Centres(self.points[i:i + 1], self.norms[i:i + 1])

    def rank(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest centroid, its squared distance and the margin of each row, restarts x rows; ties to the lowest index.

        A matrix product ranks the centroids. Rows whose two best are closer than its rounding error are ranked again by
        plain differences.
        """
        sets, k, width = self.points.shape
        size = (x * x).sum(axis=1)
        ranking = np.matmul(-2.0 * self.points.reshape(-1, width), x.T).reshape(sets, k, -1)
        ranking += self.norms[:, :, None]
        first, best = ranking[:, 0].copy(), np.zeros((sets, len(x)), dtype="uint8" if k < 256 else "int32")
        second = np.full_like(first, np.inf)
        for j in range(1, k):
            here = ranking[:, j]
            np.copyto(best, j, where=here < first)
            np.minimum(second, np.maximum(first, here), out=second)
            np.minimum(first, here, out=first)
        largest = np.where(np.isfinite(self.norms), self.norms, 0.0).max(axis=1)[:, None]
        gap = second - first
        close = gap <= 1e-12 * width * size + 1e-12 * width * largest
        for i in np.flatnonzero(close.any(axis=1)):
            used = self.points[i, np.isfinite(self.norms[i])]
            rows = np.flatnonzero(close[i])
            for at in range(0, len(rows), step := max(1, TIED_CELLS // used.size)):
                some = rows[at:at + step]
                best[i, some] = ((x[some, None, :] - used[None]) ** 2).sum(axis=2).argmin(axis=1)
        first += size
        second += size
        margin = np.sqrt(np.maximum(second, 0.0, out=second), out=second) - np.sqrt(np.maximum(first, 0.0))
        margin -= SLACK * np.sqrt(size)
        margin -= SLACK * np.sqrt(largest)
        return best, first, margin


class Sums:
    """Rows, visited rows, cost and feature sums by restart and cluster, as one array."""

    def __init__(self, sets: int, k: int, width: int):
        self.total = np.zeros((sets * k, 3 + width))
        self.k = k

    def add(
        self, sets: Sequence[int], best: np.ndarray, x: np.ndarray, near: np.ndarray | None = None, cost: np.ndarray | None = None, only: np.ndarray | None = None
    ) -> None:
        """``near`` marks the rows that would be visited in passes to come, counted under a restart's first cluster; ``only`` those that count."""
        wide, first = np.column_stack([np.ones(len(x)), x]), np.asarray(sets) * self.k
        for j in range(min(self.k, int(best.max(initial=0)) + 1)):
            here = best == j
            if only is not None:
                here &= only
            summed = here.astype("float64") @ wide
            self.total[first + j, 0] += summed[:, 0]
            self.total[first + j, 3:] += summed[:, 1:]
            if cost is not None:
                self.total[first + j, 2] += (cost * here).sum(axis=1)
        if near is not None:
            self.total[first, 1] += np.count_nonzero(near, axis=1)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        used = np.flatnonzero(self.total[:, :2].any(axis=1))
        return used // self.k, used % self.k, self.total[used]


def _matrix(body: pa.BinaryScalar, width: int) -> np.ndarray:
    return np.frombuffer(body.as_buffer(), dtype="float64").reshape(-1, width)


def _schema(width: int) -> str:
    return "restart int, cluster int, n double, near double, cost double, " + ", ".join(f"s{f} double" for f in range(width))


def _sum_batch(sums: Sums, more: dict[str, pa.Array] | None = None) -> pa.RecordBatch:
    restart, cluster, total = sums.rows()
    names = ["restart", "cluster", "n", "near", "cost", *(f"s{f}" for f in range(total.shape[1] - 3))]
    columns = [pa.array(restart.astype("int32")), pa.array(cluster.astype("int32")), *(pa.array(c) for c in total.T.copy())]
    if more is not None:
        names.append("body")
        columns.append(pa.nulls(len(restart), pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=names)


def _pass(df: DataFrame, centres: Centres, reach: np.ndarray, cost: bool, own: bool) -> np.ndarray:
    """Sums of all restarts, restarts x clusters x (n, near, cost, features), from one pass over the blocks.

    With ``own`` a block belongs to one restart (column ``restart``), else all restarts take all rows.
    """
    sets, k, width = centres.points.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(sets, k, width)
        for batch in batches:
            for i, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                whole = _matrix(body, width)
                which = [i] if own else range(sets)
                for at in range(0, len(whole), RANKED_ROWS):
                    x = whole[at:at + RANKED_ROWS]
                    best, squared, margin = (centres.only(i) if own else centres).rank(x)
                    if cost:
                        chosen = np.stack([centres.points[r][b] for r, b in zip(which, best)])
                        squared = ((x[None] - chosen) ** 2).sum(axis=2)
                    sums.add(which, best, x, margin <= reach[list(which), None], squared if cost else None)
        yield _sum_batch(sums)

    first = "restart" if own else "n"
    found = df.select(first, "body").mapInArrow(run, _schema(width)).groupBy("restart", "cluster").agg(
        *(F.sum(c).alias(c) for c in ("n", "near", "cost", *(f"s{f}" for f in range(width))))
    )
    return _collected(found, sets, k, width)


def _collected(found: DataFrame, sets: int, k: int, width: int) -> np.ndarray:
    out = np.zeros((sets, k, 3 + width))
    for r in found.collect():  # at most restarts x clusters rows
        out[r[0], r[1]] = r[2:]
    return out


def _part_rows(df: DataFrame, centres: Centres, reach: np.ndarray) -> tuple[np.ndarray, DataFrame]:
    """Sums of the resting rows, and blocks ``restart, body`` of the rows to be visited, in one pass and one file."""
    sets, k, width = centres.points.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(sets, k, width)
        held: list[list[np.ndarray]] = [[] for _ in range(sets)]

        def block(i: int) -> pa.RecordBatch:
            x = np.concatenate(held[i])
            held[i].clear()
            none = Sums(sets, k, width)
            empty = _sum_batch(none, {})
            columns = [pa.array([int(i)], pa.int32()), pa.array([ACTIVE], pa.int32()), pa.array([float(len(x))])]
            columns += [pa.array([0.0]) for _ in range(2 + width)] + [pa.array([x.tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=empty.schema.names)

        for batch in batches:
            for body in batch.column(0):
                whole = _matrix(body, width)
                for at in range(0, len(whole), RANKED_ROWS):
                    x = whole[at:at + RANKED_ROWS]
                    best, _, margin = centres.rank(x)
                    rests = margin > reach[:, None]
                    sums.add(range(sets), best, x, only=rests)
                    for i in np.flatnonzero(~rests.all(axis=1)):
                        held[i].append(x[~rests[i]])
                        if sum(map(len, held[i])) >= BLOCK_ROWS:
                            yield block(i)
        for i in range(sets):
            if held[i]:
                yield block(i)
        yield _sum_batch(sums, {})

    parted = cut(df.select("body").mapInArrow(run, _schema(width) + ", body binary"), "parted", wide=True)
    sums = parted.where(F.col("cluster") != ACTIVE).groupBy("restart", "cluster").agg(
        *(F.sum(c).alias(c) for c in ("n", "near", "cost", *(f"s{f}" for f in range(width))))
    )
    active = parted.where(F.col("cluster") == ACTIVE).select("restart", "body")
    return _collected(sums, sets, k, width), active


@dataclass
class Restart:
    """One restart on its way: its centroids, their last move, and what they were when its rows were parted."""

    points: np.ndarray
    tries: int = 0
    steps: int = 0
    settled: bool = False
    cost: float = float("nan")
    moved: float = float("inf")  # the two largest moves of the last step together
    since: np.ndarray | None = None
    budget: float = 0.0
    ready: bool = False  # its rows are worth parting

    def rested(self) -> bool:
        """No more steps with this parting: the two largest moves since then have used up the margin."""
        return self.settled or _two_largest(self.points - self.since) > self.budget

    def move(self, sums: np.ndarray, tol: float) -> None:
        """To the means of ``sums`` (clusters x (n, near, cost, features))."""
        k = len(self.points)
        n = sums[:k, 0]
        moved = self.points.copy()
        moved[n > 0] = sums[:k, 3:][n > 0] / n[n > 0, None]  # a cluster without rows keeps its centroid
        step = moved - self.points
        shift = float((step**2).sum())
        self.tries += 1
        self.settled = shift <= tol
        if shift > 0.0:
            self.moved, self.points = _two_largest(step), moved
            self.steps += 1

    def go_on(self, x: Sequence[np.ndarray], resting: np.ndarray, max_iter: int, tol: float) -> None:
        """All steps that the parting allows, over the given blocks of rows."""
        k, width, step = len(self.points), self.points.shape[1], 8 * RANKED_ROWS
        while self.tries < max_iter and not self.rested():
            sums, centres = Sums(1, len(resting), width), Centres.of([self.points])
            for part in x:
                for at in range(0, len(part), step):
                    some = part[at:at + step]
                    sums.add([0], centres.rank(some)[0], some)
            self.move(resting[:k] + sums.total[:k], tol)


def _two_largest(moves: np.ndarray) -> float:
    return float(np.sort(np.sqrt((moves**2).sum(axis=1)))[-2:].sum())


@dataclass
class BoundedLloyd:
    """All restarts over one table of blocks.

    ``passes`` notes what each pass did: its kind and the rows compared in it, those of each restart counted.
    """

    blocks: DataFrame
    rows: int
    max_iter: int
    tol: float
    passes: list[tuple[str, int]] = field(default_factory=list)

    def run(self, starts: Sequence[Sequence[Sequence[float]]]) -> list[Restart]:
        restarts = [Restart(np.asarray(s, dtype="float64")) for s in starts]
        while moving := [r for r in restarts if not r.settled and r.tries < self.max_iter]:
            ready = [r for r in moving if r.ready]
            if 2 * len(ready) >= len(moving):  # a parting is a pass over all rows as a step is
                self._part_and_go_on(ready)
            else:
                self._step(moving)
        sums = _pass(self.blocks, Centres.of([r.points for r in restarts]), np.zeros(len(restarts)), cost=True, own=False)
        self.passes.append(("cost", self.rows * len(restarts)))
        for r, s in zip(restarts, sums):
            r.cost = float(s[:, 2].sum())
        return restarts

    def _reach(self, moving: list[Restart]) -> np.ndarray:
        return np.array([REACH * r.moved for r in moving])

    def _step(self, moving: list[Restart]) -> None:
        """One step of all over all rows, which also tells how many rows would have to be visited after a parting."""
        sums = _pass(self.blocks, Centres.of([r.points for r in moving]), self._reach(moving), cost=False, own=False)
        self.passes.append(("step", self.rows * len(moving)))
        for r, s in zip(moving, sums):
            r.move(s, self.tol)
            r.ready = s[:, 1].sum() <= VISITED_SHARE * self.rows

    def _part_and_go_on(self, moving: list[Restart]) -> None:
        """Part the rows and take all steps this allows."""
        reach = self._reach(moving)
        for r, budget in zip(moving, reach):
            r.since, r.budget = r.points.copy(), float(budget)
        resting, active = _part_rows(self.blocks, Centres.of([r.points for r in moving]), reach)
        self.passes.append(("part", self.rows * len(moving)))
        visited = self.rows - resting[:, :, 0].sum(axis=1)
        for r, n in zip(moving, visited):
            r.ready = n <= VISITED_SHARE * self.rows
        bound = VISITED_BYTES // (8 * (resting.shape[2] - 3))
        small = [i for i, n in enumerate(visited) if n <= bound]
        large = [i for i, n in enumerate(visited) if n > bound]
        self._in_one_task(moving, small, resting, active)
        while left := [i for i in large if moving[i].tries < self.max_iter and not moving[i].rested()]:
            sums = _pass(active.where(F.col("restart").isin(left)), Centres.of([r.points for r in moving]), np.zeros(len(moving)), cost=False, own=True)
            self.passes.append(("visit", int(sums[:, :, 0].sum())))
            for i in left:
                moving[i].move(sums[i] + resting[i], self.tol)

    def _in_one_task(self, moving: list[Restart], which: list[int], resting: np.ndarray, active: DataFrame) -> None:
        """Each of these restarts goes on in one task, which gets its rows to be visited: a bounded number."""
        width, max_iter, tol = resting.shape[2] - 3, self.max_iter, self.tol

        def run(key: tuple, blocks: pa.Table) -> pa.Table:
            i = key[0].as_py()
            restart = moving[i]
            restart.go_on([_matrix(b, width) for c in blocks.column("body").chunks for b in c], resting[i], max_iter, tol)
            columns = {"restart": [i], "points": [restart.points.ravel().tolist()], "tries": [restart.tries], "steps": [restart.steps],
                       "settled": [restart.settled], "moved": [restart.moved]}
            kinds = [pa.int32(), pa.list_(pa.float64()), pa.int32(), pa.int32(), pa.bool_(), pa.float64()]
            return pa.table({c: pa.array(v, kind) for (c, v), kind in zip(columns.items(), kinds)})

        schema = "restart int, points array<double>, tries int, steps int, settled boolean, moved double"
        # The number of parts is given, as parts that look small would be joined and the restarts run one after the other.
        dealt = active.where(F.col("restart").isin(which)).repartition(PARTS_EACH * max(1, len(which)), "restart")
        done = dealt.groupBy("restart").applyInArrow(run, schema).collect() if which else []
        for r in done:
            restart = moving[r["restart"]]
            restart.points = np.array(r["points"]).reshape(restart.points.shape)
            restart.tries, restart.steps, restart.settled, restart.moved = r["tries"], r["steps"], r["settled"], r["moved"]
        for i in set(which) - {r["restart"] for r in done}:  # no row to visit: a few sums say it all
            moving[i].go_on([], resting[i], max_iter, tol)
        self.passes.append(("one task each", int(sum(self.rows - resting[i][:, 0].sum() for i in which))))
