"""Exact top-k by inner product with sorted lists read in order and no random access.

Every component of the vectors is a list sorted by value. A query reads each list from the end
its own sign favours. After a stretch of reading, a row has a lower bound (the components seen, plus the
least the unseen ones can add) and an upper bound (with the most they can add, which is where
the reading stands). Reading stops when no row outside the candidates can reach the k-th lower bound;
then the candidates' scores are resolved.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segwatch.functions.storage import cut

CANDIDATE_BLOCK = 16_384
QUERY_BLOCK = 4_096
QUERIES_AT_ONCE = 128
RESOLVED_AT_ONCE = 65_536
FIRST_UNREAD = 8  # an eighth of each list is unread when the bounds are first looked at; then it is halved
EXACT_SINGLE, EXACT_DOUBLE = 2.0**24, 2.0**53


def quantised(vector: Column) -> Column:
    """Components times 64, rounded down, as doubles; NULL for a vector that cannot take part."""
    good = F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
    # Doubles beyond 2^52 are whole already, and beyond 2^63 `floor` would not hold them.
    def down(x: Column) -> Column:
        scaled = x.cast("double") * 64
        return F.when(F.abs(scaled) < 2.0**52, F.floor(scaled).cast("double")).otherwise(scaled)

    return F.when(good, F.transform(vector, down))


def read_sorted_lists(queries: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates that may be among the ``k`` best of ``rows`` for each query: query and row numbers.

    ``queries`` (q x d) and ``rows`` (n x d) hold whole numbers. Ties at the bounds stay in. All lists
    are read in stretches; what has been read is a mask on the ranks, and the bounds of all rows are
    products with the matrix in which unread components are replaced by their limits.
    """
    n, d = rows.shape
    order = np.argsort(rows, axis=0, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(n)[:, None], (n, d)), axis=0)
    ascending = np.take_along_axis(rows, order, axis=0)
    least, most = ascending[0], ascending[-1]
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    reading = np.arange(len(queries))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    unread = n // FIRST_UNREAD
    while len(reading):
        depth = n - unread
        top, bottom = rank >= unread, rank < depth
        p, m = up[reading], down[reading]
        # An unread component adds at most its value where the reading stands, at least the list's other end.
        upper = p @ np.where(top, rows, ascending[min(unread, n - 1)]).T + m @ np.where(bottom, rows, ascending[depth - 1]).T
        lower = p @ np.where(top, rows, least).T + m @ np.where(bottom, rows, most).T
        q, r = _keep(lower, upper, k)
        settled = np.bincount(q, minlength=len(reading)) <= max(4 * k, n // 32)  # few enough to resolve
        if unread == 0:  # every list is read to its end
            settled[:] = True
        found.append((reading[q[settled[q]]], r[settled[q]]))
        reading, unread = reading[~settled], unread // 2
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _keep(lower: np.ndarray, upper: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the upper bound reaches the k-th largest lower bound of the query."""
    n = lower.shape[1]
    bar = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(lower), -np.inf)
    return np.nonzero(upper >= bar[:, None])


def _best_of_block(k: int):
    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({c: [] for c in ("place", "query_id", "vec_id", "score")}, dtype="int64")
        queries, rows = np.stack(left["v"].to_numpy()), np.stack(right["v"].to_numpy())
        ids, asked = right["id"].to_numpy(), left["id"].to_numpy()
        limit = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, queries.shape[1])
        if limit < EXACT_SINGLE:  # whole numbers of this size are exact in single precision
            queries, rows = queries.astype("float32"), rows.astype("float32")
        out = []
        for at in range(0, len(queries), QUERIES_AT_ONCE):
            part = queries[at:at + QUERIES_AT_ONCE]
            if limit < EXACT_DOUBLE:
                # One more than k, since the query's own row is no candidate.
                q, r = read_sorted_lists(part, rows, k + 1)
                score = np.empty(len(q), dtype="int64")
                for i in range(0, len(q), RESOLVED_AT_ONCE):
                    some = slice(i, i + RESOLVED_AT_ONCE)
                    score[some] = np.einsum("ij,ij->i", part[q[some]], rows[r[some]])
            else:  # too large for exact doubles: whole numbers of any size, checked to fit the result
                q, r = np.nonzero(np.ones((len(part), len(rows)), dtype=bool))
                exact = [sum(int(a) * int(b) for a, b in zip(part[i], rows[j])) for i, j in zip(q, r)]
                score = np.array(exact, dtype="int64")
            frame = pd.DataFrame({"q": q + at, "query_id": asked[q + at], "vec_id": ids[r], "score": score})
            frame = frame[(left["n"].to_numpy()[frame["q"]] != right["n"].to_numpy()[r])]
            frame = frame.sort_values(["q", "score", "vec_id"], ascending=[True, False, True])
            out.append(frame.groupby("q", sort=False).head(k))
        return pd.concat(out)[["query_id", "vec_id", "score", "q"]].assign(
            place=lambda f: left["n"].to_numpy()[f["q"]]
        )[["place", "query_id", "vec_id", "score"]]

    return best


def exact_top_k(
    df: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding",
    candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best other rows of each row for which ``queries`` holds.

    Blocks of queries meet blocks of rows, each pair in one bounded task input that yields at most
    ``k`` rows a query; the best of them are ranked at the end. Ties go to the smaller key.
    Vectors that are NULL or hold NULL, NaN or infinite components take no part, nor do rows
    without key. Repeated rows and keys are candidates of their own, and each repeated query has its own result
    over all rows but itself. Vectors of another length than the query's are no candidates of it.
    Fewer than ``k`` other rows give all of them, an empty table nothing.
    """
    rows = df.select(
        F.col(key).cast("bigint").alias("id"), quantised(F.col(vector)).alias("v"),
        F.coalesce(queries, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("n"),
    ).where(F.col("v").isNotNull() & F.col("id").isNotNull()).withColumn("size", F.size("v"))
    rows = cut(rows, "vectors")  # `n` tells rows apart and must stay
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("asks").alias("asking")).head()
    n_rows, n_queries = max(1, -(-counts["rows"] // candidate_block)), max(1, -(-counts["asking"] // query_block))
    mix = F.xxhash64("n")
    asked = rows.where("asks").select(
        "size", F.pmod(mix, F.lit(n_queries)).cast("int").alias("qb"), "id", "n", "v",
        F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))).alias("cb"),
    )
    given = rows.select(
        F.col("size").alias("size"), F.pmod(mix, F.lit(n_rows)).cast("int").alias("cb"), F.col("id").alias("id"),
        F.col("n").alias("n"), F.col("v").alias("v"), F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("qb"),
    )
    block = ["size", "qb", "cb"]
    best = asked.groupBy(*block).cogroup(given.groupBy(*block)).applyInPandas(
        _best_of_block(k), "place bigint, query_id bigint, vec_id bigint, score bigint"
    )
    by_query = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
