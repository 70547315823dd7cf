"""The SQL each registered query must agree with, written for another engine on the same tables."""

from __future__ import annotations

import hashlib

from catalog.queries import DIMS, FEATURES, KEYS

KEY_LIST = ", ".join(KEYS)
FEATURE_LIST = ", ".join(FEATURES)
K = 4
FLAG_A = "WHERE l_returnflag = 'A'"


def _sums(pattern: str, n: int = 4, sep: str = " + ") -> str:
    return sep.join(pattern.format(i=i, f=FEATURES[i]) for i in range(n))


def _scaled(where: str = "", source: str = "lineitem") -> str:
    """CTEs ``stats`` (one row) and ``scaled`` (keys, x0..x3 and the key hash)."""
    stats = _sums("avg({f}) AS m{i}, CASE WHEN stddev_pop({f}) = 0 THEN 1 ELSE stddev_pop({f}) END AS s{i}", sep=", ")
    xs = _sums("(l.{f} - st.m{i}) / st.s{i} AS x{i}", sep=", ")
    keys = ", ".join(f"l.{k}" for k in KEYS)
    return (
        f"stats AS (SELECT {stats} FROM {source} {where}), "
        f"scaled AS (SELECT {keys}, {_sums('l.{f}', sep=', ')}, {xs}, md5(concat_ws('|', {keys}, '0')) AS digest FROM lineitem l, stats st)"
    )


def _start() -> str:
    """CTE ``c0``: one row of centroid coordinates c{cluster}_{feature}, the K smallest key hashes."""
    cells = ", ".join(
        f"max(CASE WHEN j = {j} THEN x{i} END) AS c{j}_{i}" for j in range(K) for i in range(4)
    )
    return (
        "picked AS (SELECT *, row_number() OVER (ORDER BY digest) - 1 AS j FROM scaled ORDER BY digest LIMIT 4), "
        f"c0 AS (SELECT {cells} FROM picked)"
    )


def _near(step: int) -> str:
    """CTE ``near{step}``: every scaled row with its nearest centroid of ``c{step}``; ties to the lowest."""
    ds = ", ".join(
        "(" + _sums(f"(x{{i}} - c{j}_{{i}}) * (x{{i}} - c{j}_{{i}})") + f") AS d{j}" for j in range(K)
    )
    least = "least(" + ", ".join(f"d{j}" for j in range(K)) + ")"
    cases = " ".join(f"WHEN d{j} = {least} THEN {j}" for j in range(K))
    return (
        f"dist{step} AS (SELECT s.*, {ds} FROM scaled s, c{step}), "
        f"near{step} AS (SELECT *, CAST(CASE {cases} END AS INTEGER) AS cluster, {least} AS distance FROM dist{step})"
    )


def _move(step: int) -> str:
    """CTE ``c{step+1}``: means of the rows of ``near{step}``, the old centroid where a cluster is empty."""
    means = ", ".join(
        f"avg(CASE WHEN cluster = {j} THEN x{i} END) AS n{j}_{i}" for j in range(K) for i in range(4)
    )
    cells = ", ".join(f"coalesce(n{j}_{i}, c{j}_{i}) AS c{j}_{i}" for j in range(K) for i in range(4))
    return f"mean{step} AS (SELECT {means} FROM near{step}), c{step + 1} AS (SELECT {cells} FROM mean{step}, c{step})"


ASSIGNED = f"WITH {_scaled()}, {_start()}, {_near(0)}"
MOVED = ASSIGNED + "".join(f", {_move(t)}, {_near(t + 1)}" for t in range(3))


def _silhouette(rows: str, distance: str) -> str:
    """CTEs down to ``sil`` (one row) from a CTE ``rows`` with ``id``, ``own`` and coordinates."""
    return (
        f"pairs AS (SELECT a.id, a.own, b.own AS other, sum({distance}) AS total, count(*) AS n "
        f"FROM {rows} a, {rows} b GROUP BY a.id, a.own, b.own), "
        "per_row AS (SELECT id, own, max(CASE WHEN own = other THEN n END) AS n_own, "
        "max(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS a, "
        "min(CASE WHEN own <> other THEN total / n END) AS b FROM pairs GROUP BY id, own), "
        "sil AS (SELECT avg(CASE WHEN n_own = 1 OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END) "
        "AS silhouette, count(*) AS n, count(DISTINCT own) AS n_clusters FROM per_row)"
    )


def _davies_bouldin(rows: str, n: int) -> str:
    """CTEs down to ``dbi`` (one row) from ``rows`` with ``own`` and x0..x{n-1}."""
    apart = " + ".join(f"(a.m{i} - b.m{i}) * (a.m{i} - b.m{i})" for i in range(n))
    away = " + ".join(f"(r.x{i} - c.m{i}) * (r.x{i} - c.m{i})" for i in range(n))
    means = ", ".join(f"avg(x{i}) AS m{i}" for i in range(n))
    return (
        f"centre AS (SELECT own, {means} FROM {rows} GROUP BY own), "
        f"spread AS (SELECT r.own, avg(sqrt({away})) AS s FROM {rows} r JOIN centre c ON r.own = c.own GROUP BY r.own), "
        f"apart AS (SELECT a.own AS i, b.own AS j, sqrt({apart}) AS d FROM centre a JOIN centre b ON a.own <> b.own), "
        "worst AS (SELECT apart.i, max(CASE WHEN d > 0 THEN (si.s + sj.s) / d ELSE 0 END) AS ratio FROM apart "
        "JOIN spread si ON si.own = apart.i JOIN spread sj ON sj.own = apart.j GROUP BY apart.i), "
        "dbi AS (SELECT avg(ratio) AS davies_bouldin, count(*) AS n_clusters FROM worst)"
    )


ROW_DISTANCE = "sqrt(" + _sums("(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})") + ")"
SAMPLED = (
    "sampled AS (SELECT row_number() OVER () AS id, cluster AS own, x0, x1, x2, x3 FROM near0 "
    f"ORDER BY md5(concat_ws('|', {KEY_LIST}, '42')) LIMIT 2000)"
)
LABELLED = "labelled AS (SELECT cluster AS own, x0, x1, x2, x3 FROM near0)"
EMBEDDED = "embedded AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


def _ks(long: str) -> str:
    """CTEs down to ``ks`` from a CTE with ``feature, value, is_ref``."""
    return (
        f"per_value AS (SELECT feature, value, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c "
        f"FROM {long} GROUP BY feature, value), "
        "running AS (SELECT feature, sum(r) OVER w AS cr, sum(c) OVER w AS cc, sum(r) OVER (PARTITION BY feature) AS nr, "
        "sum(c) OVER (PARTITION BY feature) AS nc FROM per_value WINDOW w AS (PARTITION BY feature ORDER BY value)), "
        "ks AS (SELECT feature, max(abs(CAST(cr AS DOUBLE) / nr - CAST(cc AS DOUBLE) / nc)) AS ks_stat, "
        "CAST(max(nr) AS BIGINT) AS n_ref, CAST(max(nc) AS BIGINT) AS n_curr FROM running GROUP BY feature)"
    )


def _series(terms: str, weight: str, first: int = 0) -> str:
    return f"(SELECT sum(({weight}) * exp(-q / (2 * z * z))) FROM (SELECT pow(pi() * ({terms}), 2) AS q FROM range({first}, 12) t(i)))"


def _p_value() -> str:
    """CTE ``tested``: ``ks`` with the exact p-value for equal sizes up to 10000, expansions beyond."""
    exact = (
        "(SELECT 2 * sum((CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(2 * lgamma(n_ref + 1) "
        "- lgamma(n_ref - k * h + 1) - lgamma(n_ref + k * h + 1))) FROM range(1, 10001) t(k) WHERE k * h <= n_ref)"
    )
    odd, even = "i + 0.5", "i"
    k0 = f"sqrt(2 * pi()) / z * {_series(odd, '1')}"
    k1 = f"sqrt(pi() / 2) / (3 * pow(z, 4)) * {_series(odd, 'q - z * z')}"
    k2 = (
        f"sqrt(pi() / 2) / (36 * pow(z, 7)) * "
        f"{_series(odd, '6 * pow(z, 6) + 2 * pow(z, 4) + q * (2 * pow(z, 4) - 5 * z * z) + q * q * (1 - 2 * z * z)')}"
        f" - sqrt(pi() / 2) / (18 * pow(z, 3)) * {_series(even, 'q', 1)}"
    )
    k3 = (
        f"sqrt(pi() / 2) / (3240 * pow(z, 10)) * "
        f"{_series(odd, 'q * q * q * (5 - 30 * z * z) + q * q * (212 * pow(z, 4) - 60 * z * z) + q * (135 * pow(z, 4) - 96 * pow(z, 6)) - 30 * pow(z, 6) - 90 * pow(z, 8)')}"
        f" + sqrt(pi() / 2) / (54 * pow(z, 6)) * {_series(even, '3 * q * z * z - q * q', 1)}"
    )
    body = f"1 - ({k0} + ({k1}) / sqrt(size) + ({k2}) / size + ({k3}) / pow(size, 1.5))"
    tail = "2 * exp(-2 * z * z - 2 * z / (3 * sqrt(size)) + 4 * (z * z - pow(z, 4)) / (9 * size))"
    return (
        "sized AS (SELECT *, round(n_ref * ks_stat) AS h, round_even(CAST(n_ref AS DOUBLE) * n_curr / (n_ref + n_curr), 0) AS size "
        "FROM ks), scaled_ks AS (SELECT *, ks_stat * sqrt(size) AS z FROM sized), "
        "tested AS (SELECT feature, ks_stat, n_ref, n_curr, CASE WHEN h = 0 THEN 1.0 "
        f"WHEN n_ref = n_curr AND n_ref <= 10000 THEN {exact} WHEN ks_stat >= 1 THEN 0.0 WHEN z >= 2 THEN {tail} "
        f"WHEN z < 0.2 THEN 1.0 ELSE {body} END AS p_value FROM scaled_ks)"
    )


def _long(source: str, side: str) -> str:
    parts = " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS value, {side} AS is_ref FROM {source}" for f in FEATURES)
    return f"long AS ({parts})"


SHIP = (
    f"numbered AS (SELECT *, row_number() OVER (ORDER BY l_shipdate, {KEY_LIST}) AS position, count(*) OVER () AS total "
    "FROM lineitem), halves AS (SELECT *, position <= total // 2 AS early FROM numbered)"
)
EVENT_HALVES = (
    "numbered AS (SELECT *, row_number() OVER (ORDER BY event_id) AS position, count(*) OVER () AS total FROM events), "
    "halves AS (SELECT *, position <= total // 2 AS early FROM numbered)"
)
SHIP_KS = f"WITH {SHIP}, {_long('halves', 'early')}, {_ks('long')}"
MONITORED = (
    f"{SHIP_KS}, {_p_value()} SELECT 'drift_ks_' || feature AS key, round(ks_stat, 6) AS value FROM tested UNION ALL "
    "SELECT 'drift_pval_' || feature, round(p_value, 6) FROM tested UNION ALL "
    "SELECT 'n_drifted_features', CAST(count(*) FILTER (p_value < 0.05) AS DOUBLE) FROM tested"
)
SCALED_OUT = ", ".join(f"round(x{i}, 6) + 0.0 AS {f}" for i, f in enumerate(FEATURES))
VERSIONS = (
    "versions AS (SELECT 'model-' || o_custkey AS model, CAST(o_orderkey AS VARCHAR) AS version, "
    "'run-' || o_orderkey AS run_id FROM orders)"
)
ALIASES = (
    "events_of AS (SELECT 'model-' || o_custkey AS model, CASE WHEN o_orderstatus = 'F' THEN 'champion' ELSE 'candidate' END "
    "AS alias, CAST(o_orderkey AS VARCHAR) AS version, 1000000000000 - o_orderkey AS seq FROM orders), "
    "pointed AS (SELECT model, alias, version FROM events_of "
    "QUALIFY row_number() OVER (PARTITION BY model, alias ORDER BY seq DESC) = 1)"
)
METRICS = (
    "recorded AS (SELECT CAST(o_custkey AS VARCHAR) AS run_id, 'inertia' AS key, o_totalprice AS value, o_orderkey AS seq "
    "FROM orders UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'silhouette_score', o_totalprice / 1000000.0, o_orderkey "
    "FROM orders)"
)
LATEST = (
    f"WITH {METRICS}, last AS (SELECT run_id, key, value FROM recorded "
    "QUALIFY row_number() OVER (PARTITION BY run_id, key ORDER BY seq DESC) = 1)"
)


def _moments(by: str = "") -> str:
    lead = f"{by} AS run_id, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    count = "" if by else "count({f}) AS n, "
    one = (
        "SELECT " + lead + "'{f}' AS feature, " + count + "round(avg({f}), 6) AS mean, round(stddev_pop({f}), 6) AS std, "
        "round(CASE WHEN stddev_pop({f}) = 0 THEN 1 ELSE stddev_pop({f}) END, 6) AS scale FROM lineitem" + group
    )
    return " UNION ALL ".join(one.format(f=f) for f in FEATURES)


def _centre(c: int, f: int) -> float:
    """Centre coordinates are part of the generator's definition: MD5 of their position and the seed."""
    word = int(hashlib.md5(f"centre|{c}|{f}|42".encode()).hexdigest()[:8], 16)
    return 10.0 * (2.0 * word / 4294967296.0 - 1.0)


def _blobs() -> str:
    """CTE ``blobs``: Box-Muller normals from the four 32-bit words of the key's MD5."""
    word = "(CAST('0x' || substr(digest, {at}, 8) AS BIGINT) + 1) / 4294967296.0::DOUBLE"
    words = ", ".join(f"{word.format(at=1 + 8 * w)} AS u{w}" for w in range(4))
    normals = []
    for pair in range(2):
        a, b = f"u{2 * pair}", f"u{2 * pair + 1}"
        normals += [f"sqrt(-2 * ln({a})) * cos(2 * pi() * {b})", f"sqrt(-2 * ln({a})) * sin(2 * pi() * {b})"]
    centres = [
        "CASE true_label " + " ".join(f"WHEN {c} THEN {_centre(c, f)!r}::DOUBLE" for c in range(4)) + " END" for f in range(4)
    ]
    features = ", ".join(f"{c} + 1.2::DOUBLE * ({n}) AS {d}" for c, n, d in zip(centres, normals, DIMS))
    return (
        "hashed AS (SELECT o_orderkey, CAST(o_orderkey % 4 AS INTEGER) AS true_label, "
        "md5(concat_ws('|', o_orderkey, '42000')) AS digest FROM orders), "
        f"uniform AS (SELECT o_orderkey, true_label, {words} FROM hashed), "
        f"blobs AS (SELECT o_orderkey, {features}, true_label FROM uniform)"
    )


def _blob_fit(steps: int = 12) -> str:
    """Lloyd iterations on ``blobs`` from the label means, with clusters numbered by centroid."""
    dims = DIMS[:4]
    out = [f"cent0 AS (SELECT true_label AS cluster, {', '.join(f'avg({d}) AS {d}' for d in dims)} FROM blobs GROUP BY true_label)"]
    for t in range(steps):
        away = " + ".join(f"(b.{d} - c.{d}) * (b.{d} - c.{d})" for d in dims)
        means = ", ".join(f"avg({d}) AS {d}" for d in dims)
        out.append(
            f"step{t} AS (SELECT b.*, c.cluster, {away} AS distance FROM blobs b, cent{t} c "
            "QUALIFY row_number() OVER (PARTITION BY b.o_orderkey ORDER BY distance, c.cluster) = 1)"
        )
        out.append(f"cent{t + 1} AS (SELECT cluster, {means} FROM step{t} GROUP BY cluster)")
    listed = ", ".join(dims)
    rounded = ", ".join(f"round({d}, 6) AS {d}" for d in dims)
    return ", ".join(out) + (
        f" SELECT CAST(row_number() OVER (ORDER BY {listed}) - 1 AS INTEGER) AS cluster, {rounded}, "
        f"(SELECT round(sum(distance), 3) FROM step{steps - 1}) AS inertia FROM cent{steps}"
    )


def _fit(rows: str, n_init: int = 10, max_iter: int = 300, tol: float = 1e-4, seed: int = 42) -> str:
    """CTEs down to ``best`` (one row p{cluster}_{feature}, cost) from ``rows`` with ``name`` and x0..x3: the whole fit.

    Seeds are the weighted draws from the digests of name, seed, restart and step; then all restarts move until they settle.
    """
    def away(j: int, p: str) -> str:
        return "(" + _sums(f"(x{{i}} - {p}{j}_{{i}}) * (x{{i}} - {p}{j}_{{i}})") + ")"

    def cells(form: str) -> str:
        return ", ".join(form.format(j=j, i=i) for j in range(K) for i in range(4))

    def points(n: int) -> str:
        return ", ".join(f"p{j}_{i}" for j in range(n) for i in range(4))

    out = []
    for step in range(K):
        word = f"CAST(CAST('0x' || substr(md5(concat_ws('|', name, '{seed}', i, '{step}')), 1, 15) AS BIGINT) AS DOUBLE)"
        if step:
            near = "least(" + ", ".join(away(j, "p") for j in range(step)) + ")"
            drawn = f"SELECT *, {near} AS d, {word} AS w FROM seed{step - 1}, {rows}"
            score, source = "-ln((w + 0.5) / 1152921504606846976) / d", f"({drawn}) WHERE d > 0"
        else:
            score, source = "w", f"(SELECT *, {word} AS w FROM range(0, {n_init}) AS r(i), {rows})"
        picked = ", ".join(f"arg_min(x{f}, {score}) AS p{step}_{f}" for f in range(4))
        group = "i" + (", " + points(step) if step else "")
        out.append(f"seed{step} AS (SELECT {group}, {picked} FROM {source} GROUP BY {group})")
    ds = ", ".join(f"{away(j, 'p')} AS d{j}" for j in range(K))
    least = "least(" + ", ".join(f"d{j}" for j in range(K)) + ")"
    cases = " ".join(f"WHEN d{j} = {least} THEN {j}" for j in range(K))
    means = cells("coalesce(avg(x{i}) FILTER (c = {j}), p{j}_{i}) AS n{j}_{i}")
    shift = " + ".join(f"(n{j}_{i} - p{j}_{i}) * (n{j}_{i} - p{j}_{i})" for j in range(K) for i in range(4))
    out.append(f"bar AS (SELECT {tol}::DOUBLE * ({_sums('var_pop(x{i})')}) / 4 AS tol FROM {rows})")
    out.append(
        f"moves AS (SELECT i, 0 AS t, false AS done, {points(K)} FROM seed{K - 1} UNION ALL "
        f"SELECT i, t + 1, ({shift}) <= tol, {cells('n{j}_{i}')} FROM ("
        f"SELECT i, t, {points(K)}, tol, {means} FROM (SELECT *, CASE {cases} END AS c FROM "
        f"(SELECT *, {ds} FROM moves, {rows}, bar WHERE NOT done AND t < {max_iter})) GROUP BY i, t, {points(K)}, tol))"
    )
    out.append("ended AS (SELECT * FROM moves QUALIFY t = max(t) OVER (PARTITION BY i))")
    out.append(f"costs AS (SELECT i, {points(K)}, sum({least}) AS cost FROM (SELECT *, {ds} FROM ended, {rows}) GROUP BY i, {points(K)})")
    out.append("best AS (SELECT * FROM costs ORDER BY cost LIMIT 1)")
    return ", ".join(out)


def _fit_rows(names) -> str:
    """The fitted centroids of ``best`` numbered by their coordinates."""
    listed = ", ".join(names)
    each = " UNION ALL ".join("SELECT " + ", ".join(f"p{j}_{i} AS {n}" for i, n in enumerate(names)) + ", cost FROM best" for j in range(K))
    rounded = ", ".join(f"round({n}, 6) + 0.0 AS {n}" for n in names)
    return f"SELECT CAST(row_number() OVER (ORDER BY {listed}) - 1 AS INTEGER) AS cluster, {rounded}, round(cost, 3) AS inertia FROM ({each})"


def _trained() -> str:
    """The metrics of a training run on the standardised blobs and of its evaluation on the same table."""
    d = DIMS[:4]
    stats = ", ".join(f"avg({f}) AS m{i}, stddev_pop({f}) AS s{i}" for i, f in enumerate(d))
    xs = ", ".join(f"({f} - m{i}) / s{i} AS x{i}" for i, f in enumerate(d))
    ds = ", ".join("(" + _sums(f"(x{{i}} - p{j}_{{i}}) * (x{{i}} - p{j}_{{i}})") + f") AS d{j}" for j in range(K))
    least = "least(" + ", ".join(f"d{j}" for j in range(K)) + ")"
    cases = " ".join(f"WHEN d{j} = {least} THEN {j}" for j in range(K))
    metrics = {
        "inertia": "SELECT cost FROM best", "silhouette_score": "SELECT silhouette FROM sil",
        "davies_bouldin_score": "SELECT davies_bouldin FROM dbi", "inertia_on_data": f"SELECT sum({least}) FROM near",
    }
    rows = [f"SELECT '{p}{key}' AS key, round(({sql}), 6) AS value" for p in ("", "eval_") for key, sql in metrics.items() if p or key != "inertia_on_data"]
    return (
        f"WITH RECURSIVE {_blobs()}, blob_stats AS (SELECT {stats} FROM blobs), "
        f"z AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS name, {xs} FROM blobs, blob_stats), {_fit('z')}, "
        f"near AS (SELECT *, CASE {cases} END AS own FROM (SELECT *, {ds} FROM z, best)), "
        "sampled AS (SELECT o_orderkey AS id, own, x0, x1, x2, x3 FROM near "
        "ORDER BY md5(concat_ws('|', o_orderkey, '42')) LIMIT 2000), "
        f"{_silhouette('sampled', ROW_DISTANCE)}, {_davies_bouldin('near', 4)} " + " UNION ALL ".join(rows)
    )


def _blobs_by_label_means() -> str:
    """CTEs ``near`` (standardised blobs with the nearest label mean) and ``sampled``."""
    d = DIMS[:4]
    stats = ", ".join(f"avg({f}) AS m{i}, stddev_pop({f}) AS s{i}" for i, f in enumerate(d))
    xs = ", ".join(f"({f} - m{i}) / s{i} AS x{i}" for i, f in enumerate(d))
    means = ", ".join(f"avg(x{i}) AS m{i}" for i in range(4))
    away = " + ".join(f"(z.x{i} - c.m{i}) * (z.x{i} - c.m{i})" for i in range(4))
    return (
        f"blob_stats AS (SELECT {stats} FROM blobs), z AS (SELECT o_orderkey, true_label, {xs} FROM blobs, blob_stats), "
        f"label_mean AS (SELECT true_label AS own, {means} FROM z GROUP BY true_label), "
        f"near AS (SELECT o_orderkey, x0, x1, x2, x3, c.own, {away} AS distance FROM z, label_mean c "
        "QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY distance, c.own) = 1), "
        "sampled AS (SELECT o_orderkey AS id, own, x0, x1, x2, x3 FROM near "
        "ORDER BY md5(concat_ws('|', o_orderkey, '42')) LIMIT 2000)"
    )


def _verdict(near: str) -> str:
    """The recorded metrics of a candidate and whether it was promoted, from ``near``, ``sil`` and ``dbi``."""
    return (
        "SELECT 'inertia' AS key, 1.0::DOUBLE AS value UNION ALL SELECT 'eval_inertia', 1.0 UNION ALL "
        f"SELECT 'eval_inertia_on_data', (SELECT round(sum(distance), 3) FROM {near}) UNION ALL "
        "SELECT 'eval_silhouette_score', (SELECT round(silhouette, 3) FROM sil) UNION ALL "
        "SELECT 'eval_davies_bouldin_score', (SELECT round(davies_bouldin, 3) FROM dbi) UNION ALL "
        "SELECT 'promoted', (SELECT CASE WHEN silhouette >= 0.35 THEN 1.0 ELSE 0.0 END FROM sil)"
    )


EVALUATED = f"{ASSIGNED}, {SAMPLED}, {_silhouette('sampled', ROW_DISTANCE)}, {LABELLED}, {_davies_bouldin('labelled', 4)}"
EMBEDDED_WIDE = "wide AS (SELECT label AS own, " + ", ".join(f"v[{i + 1}] AS x{i}" for i in range(64)) + " FROM embedded)"

ORDERS = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate::VARCHAR AS o_orderdate, "
    "o_orderpriority FROM orders"
)

ORACLES: dict[str, str] = {
    "cluster_distribution": f"{ASSIGNED} SELECT cluster, count(*) AS n FROM near0 GROUP BY cluster ORDER BY cluster",
    "gaussian_blobs": f"WITH {_blobs()} SELECT o_orderkey, "
    + ", ".join(f"round({d}, 6) + 0.0 AS {d}" for d in DIMS[:4]) + ", true_label FROM blobs",
    "table_sink": ORDERS,
    "csv_sink_and_scan": ORDERS,
    "csv_of_documents": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "table_scan": ORDERS,
    "project_features": f"SELECT {FEATURE_LIST} FROM lineitem",
    "split_halves_by_key": f"WITH {EVENT_HALVES} SELECT CASE WHEN early THEN 'first' ELSE 'second' END AS side, "
    "count(*) AS n, round(sum(value), 3) AS total FROM halves GROUP BY early",
    "split_halves_by_date": f"WITH {SHIP} SELECT CASE WHEN early THEN 'first' ELSE 'second' END AS side, "
    "count(*) AS n, round(sum(l_extendedprice), 3) AS total FROM halves GROUP BY early",
    "drop_missing_per_feature": " UNION ALL ".join(
        f"SELECT '{f}' AS feature, count(*) AS n, round(sum({f}), 3) AS total FROM lineitem{where}"
        for f, where in zip(FEATURES, ("", "", " WHERE l_discount <> 0", " WHERE l_tax <> 0"))
    ),
    "first_rows": f"SELECT {KEY_LIST}, {FEATURE_LIST} FROM lineitem ORDER BY {KEY_LIST} LIMIT 5",
    "row_sample": f"SELECT {KEY_LIST} FROM lineitem ORDER BY md5(concat_ws('|', {KEY_LIST}, '42')) LIMIT 2000",
    "row_counts": "SELECT count(*) AS n FROM lineitem",
    "row_counts_if": "SELECT count(*) FILTER (l_discount > 0.05) AS n FROM lineitem",
    "moments": _moments(),
    "standardised_rows": f"WITH {_scaled()} SELECT {KEY_LIST}, {SCALED_OUT} FROM scaled",
    "stored_scalers": _moments("l_returnflag"),
    "apply_stored_scaler": f"WITH {_scaled(FLAG_A)} "
    f"SELECT {KEY_LIST}, {SCALED_OUT} FROM scaled",
    "clusters_by_frequency": f"{ASSIGNED} SELECT cluster, count(*) AS n FROM near0 GROUP BY cluster ORDER BY n DESC, cluster",
    "nearest_centroid": f"{ASSIGNED} SELECT {KEY_LIST}, cluster, round(distance, 6) AS distance FROM near0",
    "nearest_of_many": f"WITH {_scaled()}, many AS (SELECT *, row_number() OVER (ORDER BY digest) - 1 AS j FROM scaled ORDER BY digest LIMIT 64), "
    f"rows_of AS (SELECT *, row_number() OVER () AS r FROM scaled), away AS (SELECT r, {', '.join(f'a.{k}' for k in KEYS)}, b.j, "
    f"{_sums('(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})')} AS distance FROM rows_of a, many b), "
    f"one AS (SELECT r, {KEY_LIST}, min((distance, j)) AS best FROM away GROUP BY r, {KEY_LIST}) "
    f"SELECT {KEY_LIST}, CAST(best[2] AS INTEGER) AS cluster, round(best[1], 6) AS distance FROM one",
    "nearest_labelled_vector": f"WITH {EMBEDDED}, away AS (SELECT a.vec_id, b.vec_id AS j, "
    "list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance FROM embedded a, embedded b WHERE b.vec_id % 5 = 0), "
    "one AS (SELECT vec_id, min((distance, j)) AS best FROM away GROUP BY vec_id) "
    "SELECT vec_id, CAST(best[2] AS INTEGER) AS cluster, round(best[1], 6) AS distance FROM one",
    "lloyd_steps": MOVED + " " + " UNION ALL ".join(
        f"SELECT CAST({j} AS INTEGER) AS cluster, " + ", ".join(f"round(c{j}_{i}, 6) AS {f}" for i, f in enumerate(FEATURES))
        + ", (SELECT round(sum(distance), 3) FROM near3) AS inertia FROM c3" for j in range(K)
    ),
    "training_labels": f"{MOVED} SELECT {KEY_LIST}, cluster FROM near3",
    "kmeans_on_blobs": f"WITH {_blobs()}, {_blob_fit()}",
    "kmeans_on_lineitem": f"WITH RECURSIVE {_scaled()}, named AS (SELECT concat_ws('|', {KEY_LIST}) AS name, x0, x1, x2, x3 FROM scaled), "
    f"{_fit('named')} {_fit_rows(FEATURES)}",
    "training": _trained(),
    "inertia_on_lineitem": f"{ASSIGNED} SELECT count(*) AS n, round(sum(distance), 3) AS inertia FROM near0",
    "silhouette_on_lineitem": f"{ASSIGNED}, {SAMPLED}, {_silhouette('sampled', ROW_DISTANCE)} "
    "SELECT round(silhouette, 6) AS silhouette, n, n_clusters FROM sil",
    "silhouette_on_embeddings": f"WITH {EMBEDDED}, sampled AS (SELECT vec_id AS id, label AS own, v FROM embedded "
    "ORDER BY md5(concat_ws('|', vec_id, '42')) LIMIT 2000), "
    f"{_silhouette('sampled', 'list_distance(a.v, b.v)')} SELECT round(silhouette, 6) AS silhouette, n, n_clusters FROM sil",
    "silhouette_all_rows_on_embeddings": f"WITH {EMBEDDED}, whole AS (SELECT vec_id AS id, label AS own, v FROM embedded), "
    f"{_silhouette('whole', 'list_distance(a.v, b.v)')} SELECT round(silhouette, 6) AS silhouette, n, n_clusters FROM sil",
    "silhouette_all_rows_on_blobs": f"WITH {_blobs()}, whole AS (SELECT o_orderkey AS id, true_label AS own, "
    + ", ".join(f"{d} AS x{i}" for i, d in enumerate(DIMS[:4])) + " FROM blobs), "
    f"{_silhouette('whole', ROW_DISTANCE)} SELECT round(silhouette, 6) AS silhouette, n, n_clusters FROM sil",
    "davies_bouldin_on_lineitem": f"{ASSIGNED}, {LABELLED}, {_davies_bouldin('labelled', 4)} "
    "SELECT round(davies_bouldin, 6) AS davies_bouldin, n_clusters FROM dbi",
    "davies_bouldin_on_embeddings": f"WITH {EMBEDDED}, {EMBEDDED_WIDE}, {_davies_bouldin('wide', 64)} "
    "SELECT round(davies_bouldin, 6) AS davies_bouldin, n_clusters FROM dbi",
    "ks_on_lineitem": f"{SHIP_KS} SELECT feature, round(ks_stat, 6) AS ks_stat, n_ref, n_curr FROM ks",
    "ks_on_events": f"WITH {EVENT_HALVES}, long AS (SELECT 'value' AS feature, value, early AS is_ref FROM halves), "
    f"{_ks('long')}, {_p_value()} SELECT feature, round(ks_stat, 6) AS ks_stat, n_ref, n_curr, "
    "round(p_value, 6) AS p_value FROM tested",
    "drift_of_lineitem": f"{SHIP_KS}, {_p_value()} SELECT feature, round(ks_stat, 6) AS ks_stat, n_ref, n_curr, "
    "round(p_value, 6) AS p_value, p_value < 0.05 AS drifted FROM tested",
    "drifted_by_price": f"WITH {_long('lineitem', 'l_extendedprice < 50000')}, {_ks('long')}, {_p_value()} "
    "SELECT feature, round(ks_stat, 6) AS ks_stat FROM tested WHERE p_value < 0.05",
    "monitoring_metrics": MONITORED,
    "monitoring": MONITORED,
    "run_params": "SELECT CAST(o_orderkey AS VARCHAR) AS run_id, 'random_state' AS key, CAST(o_custkey AS VARCHAR) AS value "
    "FROM orders UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'init', o_orderstatus FROM orders",
    "run_metrics": f"WITH {METRICS} SELECT run_id, key, value, seq FROM recorded",
    "latest_metrics": f"{LATEST} SELECT run_id, key, value FROM last",
    "prefixed_metrics": f"{LATEST} SELECT run_id, 'eval_' || key AS key, value FROM last",
    "next_versions": f"WITH {VERSIONS} SELECT 'model-' || c_custkey AS model, CAST(coalesce(max(CAST(version AS BIGINT)), 0) + 1 "
    "AS VARCHAR) AS version FROM customer LEFT JOIN versions ON model = 'model-' || c_custkey GROUP BY c_custkey",
    "latest_versions": f"WITH {VERSIONS} SELECT model, version, run_id FROM versions "
    "QUALIFY row_number() OVER (PARTITION BY model ORDER BY CAST(version AS BIGINT) DESC) = 1",
    "candidate_aliases": f"WITH {VERSIONS} SELECT model, 'candidate' AS alias, version, CAST(version AS BIGINT) AS seq "
    "FROM versions QUALIFY row_number() OVER (PARTITION BY model ORDER BY CAST(version AS BIGINT) DESC) = 1",
    "current_aliases": f"WITH {ALIASES} SELECT model, alias, version FROM pointed",
    "resolved_aliases": f"WITH {ALIASES}, {VERSIONS} SELECT p.model, p.alias, p.version, v.run_id FROM pointed p "
    "LEFT JOIN versions v ON v.model = p.model AND v.version = p.version",
    "promotions": "SELECT 'model-' || o_custkey AS model, 'champion' AS alias, CAST(o_orderkey AS VARCHAR) AS version, "
    "o_orderkey AS seq FROM orders WHERE o_orderpriority <> '1-URGENT' AND o_totalprice / 1000000.0 >= 0.35",
    "batch_scoring": f"{ASSIGNED} SELECT {KEY_LIST}, {FEATURE_LIST}, cluster FROM near0",
    "evaluation": f"{EVALUATED} {_verdict('near0')}",
    "evaluation_of_blobs": f"WITH {_blobs()}, {_blobs_by_label_means()}, {_silhouette('sampled', ROW_DISTANCE)}, "
    f"{_davies_bouldin('near', 4)} {_verdict('near')}",
}
