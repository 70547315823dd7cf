"""Run history kept as append-only file tables below one folder."""

from __future__ import annotations

import hashlib
import threading
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segwatch.functions.storage import claim, local_table
from segwatch.operators.clustering import Clustering
from segwatch.operators.history import (
    ALIASES,
    METRICS,
    PARAMS,
    VERSIONS,
    current_aliases,
    latest_metrics,
    latest_versions,
    next_versions,
)
from segwatch.operators.scaling import SCALER_SCHEMA, Scaler
from segwatch.sources.tables import FILE_FORMATS

SCHEMAS = {
    "params": PARAMS,
    "metrics": METRICS,
    "scalers": f"run_id string, {SCALER_SCHEMA}",
    "centroids": "run_id string, cluster int, feature string, position int, value double",
    "versions": VERSIONS,
    "aliases": ALIASES,
}


class RunLog:
    """Appends to and reads the tables ``params``, ``metrics``, ``scalers``, ``centroids``,
    ``versions`` and ``aliases`` below ``root``, a folder all executors can reach.

    Several writers may register versions of one model: a number is claimed by creating a file of that name
    below ``claims``, which only one of them can. A writer that dies between claim and record leaves a number out.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt
        self._last_seq = 0
        self._lock = threading.Lock()

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, name: str) -> DataFrame:
        """The whole table, lazily; empty before the first append."""
        schema = SCHEMAS[name]
        try:
            reader = self.spark.read.format(self.fmt).schema(schema)
            if self.fmt in FILE_FORMATS:
                reader = reader.option("recursiveFileLookup", True)
            return reader.load(self.path(name))
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows. Each append of a file format has a folder of its own, as writers into one folder remove each
        other's unfinished files."""
        columns = [c.split()[0] for c in SCHEMAS[name].split(", ")]
        own = f"/append-{uuid.uuid4().hex}" if self.fmt in FILE_FORMATS else ""
        rows.select(*columns).write.format(self.fmt).mode("append").save(self.path(name) + own)

    def _append_local(self, name: str, rows: Sequence[tuple]) -> None:
        self.append(name, local_table(self.spark, rows, SCHEMAS[name]).coalesce(1))

    def next_seq(self) -> int:
        """A number larger than all this log handed out before, across processes by the clock."""
        with self._lock:
            return self._next()

    def _next(self) -> int:
        self._last_seq = max(self._last_seq + 1, time.time_ns())
        return self._last_seq

    def start_run(self, kind: str = "") -> str:
        """A new run id; ``kind`` says what the run does and is kept among its parameters."""
        run_id = uuid.uuid4().hex
        if kind:
            self.log_params(run_id, {"kind": kind})
        return run_id

    def kind(self, run_id: str) -> str | None:
        return self.params(run_id).get("kind")

    def log_params(self, run_id: str, params: Mapping[str, object]) -> None:
        self._append_local("params", [(run_id, key, str(value)) for key, value in params.items()])

    def log_metrics(self, run_id: str, metrics: Mapping[str, float]) -> None:
        seq = self.next_seq()
        self._append_local("metrics", [(run_id, key, float(value), seq) for key, value in metrics.items()])

    def metrics(self, run_id: str) -> dict[str, float]:
        """The last value of each metric of a run."""
        rows = latest_metrics(self.table("metrics").where(F.col("run_id") == run_id)).collect()
        return {r["key"]: r["value"] for r in rows}

    def params(self, run_id: str) -> dict[str, str]:
        rows = self.table("params").where(F.col("run_id") == run_id).collect()
        return {r["key"]: r["value"] for r in rows}

    def store_scaler(self, run_id: str, scaler: Scaler) -> None:
        self.append("scalers", scaler.to_table(self.spark).withColumn("run_id", F.lit(run_id)).coalesce(1))

    def load_scaler(self, run_id: str) -> Scaler:
        """The scaler fitted by that very run, never one fitted on other data."""
        return Scaler.from_table(self.table("scalers").where(F.col("run_id") == run_id))

    def register(self, model: str, run_id: str, clustering: Clustering) -> str:
        """Store the centroids of a run as the next version of ``model`` and return the version."""
        rows = [
            (run_id, cluster, feature, position, float(value))
            for cluster, centroid in enumerate(clustering.centroids)
            for position, (feature, value) in enumerate(zip(clustering.features, centroid))
        ]
        self._append_local("centroids", rows)
        wanted = local_table(self.spark, [(model,)], "model string")
        known = self.table("versions").where(F.col("model") == model)
        version = self._claim(model, int(next_versions(wanted, known).head()["version"]))
        self._append_local("versions", [(model, version, run_id)])
        return version

    def _claim(self, model: str, number: int) -> str:
        """The first number from ``number`` on that no other writer has."""
        folder = f"{self.root}/claims/{hashlib.sha256(model.encode()).hexdigest()[:32]}"  # names may hold any sign
        while not claim(self.spark, f"{folder}/{number}"):
            number += 1
        return str(number)

    def latest_version(self, model: str) -> tuple[str, str]:
        row = latest_versions(self.table("versions").where(F.col("model") == model)).head()
        if row is None:
            raise LookupError(f"Model {model} has no versions")
        return row["version"], row["run_id"]

    def set_alias(self, model: str, alias: str, version: str) -> None:
        self._append_local("aliases", [(model, alias, version, self.next_seq())])

    def resolve(self, model: str, alias: str) -> tuple[str, str]:
        """``version, run_id`` an alias points at. Raises ``LookupError`` when it is not set."""
        events = self.table("aliases").where((F.col("model") == model) & (F.col("alias") == alias))
        moved = current_aliases(events).head()
        if moved is None:
            raise LookupError(f"Model {model} has no version with alias '{alias}'")
        version = moved["version"]
        known = self.table("versions").where((F.col("model") == model) & (F.col("version") == version))
        row = known.head()
        if row is None:
            raise LookupError(f"Alias '{alias}' points at the unregistered version {version} of {model}")
        return version, row["run_id"]

    def load_model(self, model: str, alias: str) -> tuple[str, str, Clustering, Scaler]:
        """``version, run_id``, centroids and scaler of the version an alias points at, by one tagged read.

        The alias, the version and what its run stored are joined in one plan. Raises ``LookupError`` as ``resolve``,
        ``load_clustering`` and ``load_scaler`` do.
        """
        events = self.table("aliases").where((F.col("model") == model) & (F.col("alias") == alias))
        last = events.agg(F.max_by("version", "seq").alias("version"))  # one row
        known = self.table("versions").where(F.col("model") == model).select("version", "run_id").distinct()
        run = F.broadcast(last.join(known, "version"))
        nothing = F.lit(None).cast("double")
        stored = self.table("scalers").select(
            "run_id", F.lit("scaler").alias("kind"), F.lit(0).alias("cluster"), "feature", "position", "mean", "std", "scale"
        ).unionAll(self.table("centroids").select(
            "run_id", F.lit("centroid"), "cluster", "feature", "position", "value", nothing, nothing
        )).unionAll(latest_metrics(self.table("metrics").where(F.col("key") == "inertia")).select(
            "run_id", F.lit("inertia"), F.lit(0), "key", F.lit(0), "value", nothing, nothing
        ))
        rows = stored.join(run, "run_id").collect()
        of = {kind: sorted((r for r in rows if r["kind"] == kind), key=lambda r: (r["cluster"], r["position"])) for kind in ("scaler", "centroid", "inertia")}
        if not of["scaler"] or not of["centroid"]:
            version, run_id = self.resolve(model, alias)
            return version, run_id, self.load_clustering(run_id), self.load_scaler(run_id)
        scaler = Scaler(*(tuple(r[c] for r in of["scaler"]) for c in ("feature", "mean", "std", "scale")))
        points: dict[int, list[float]] = {}
        for r in of["centroid"]:
            points.setdefault(r["cluster"], []).append(r["mean"])
        first = of["centroid"][0]
        features = tuple(r["feature"] for r in of["centroid"] if r["cluster"] == first["cluster"])
        inertia = of["inertia"][0]["mean"] if of["inertia"] else float("nan")
        return first["version"], first["run_id"], Clustering(features, tuple(map(tuple, points.values())), inertia, 0), scaler

    def load_clustering(self, run_id: str) -> Clustering:
        """Centroids and stored inertia of a run."""
        mine = self.table("centroids").where(F.col("run_id") == run_id)
        rows = mine.orderBy("cluster", "position").collect()
        if not rows:
            raise LookupError(f"Run {run_id} has no stored centroids")
        points: dict[int, list[float]] = {}
        for r in rows:
            points.setdefault(r["cluster"], []).append(r["value"])
        features = tuple(r["feature"] for r in rows if r["cluster"] == rows[0]["cluster"])
        stored = self.metrics(run_id).get("inertia", float("nan"))
        return Clustering(features, tuple(map(tuple, points.values())), stored, 0)
