"""Run history as append-only tables: parameters, metrics, model versions and aliases.

All operators work on whole histories of many models and runs; each is one combined aggregate or
one join on a unique key, so a model with most of the history is no special case.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARAMS = "run_id string, key string, value string"
METRICS = "run_id string, key string, value double, seq bigint"
VERSIONS = "model string, version string, run_id string"
ALIASES = "model string, alias string, version string, seq bigint"


def _number(version: str = "version") -> Column:
    """Versions are kept as text and compared as numbers."""
    return F.col(version).cast("bigint")


def _melt(df: DataFrame, keep: Sequence[str], columns: Sequence[str], kind: str) -> DataFrame:
    pairs = F.array(*(F.struct(F.lit(c).alias("key"), F.col(c).cast(kind).alias("value")) for c in columns))
    return df.select(*keep, F.inline(pairs))


def param_rows(runs: DataFrame, run_id: str, params: Sequence[str]) -> DataFrame:
    """One row per run and parameter, as text."""
    return _melt(runs, [F.col(run_id).cast("string").alias("run_id")], params, "string")


def metric_rows(runs: DataFrame, run_id: str, metrics: Sequence[str], seq: str) -> DataFrame:
    """One row per run and metric; ``seq`` orders repeated records of one metric."""
    keep = [F.col(run_id).cast("string").alias("run_id"), F.col(seq).cast("bigint").alias("seq")]
    return _melt(runs, keep, metrics, "double").select("run_id", "key", "value", "seq")


def prefix_metrics(metrics: DataFrame, prefix: str = "eval_") -> DataFrame:
    return metrics.withColumn("key", F.concat(F.lit(prefix), "key"))


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """The last recorded value of each metric of each run."""
    return metrics.groupBy("run_id", "key").agg(F.max_by("value", "seq").alias("value"))


def next_versions(models: DataFrame, versions: DataFrame) -> DataFrame:
    """The version a new registration of each of ``models`` gets: the highest plus one, or 1."""
    highest = versions.groupBy("model").agg(F.max(_number()).alias("__highest"))
    return models.select("model").distinct().join(highest, "model", "left").select(
        "model", (F.coalesce("__highest", F.lit(0)) + 1).cast("string").alias("version")
    )


def latest_versions(versions: DataFrame) -> DataFrame:
    """``model, version, run_id`` of the numerically highest version of each model."""
    # The winner is kept as a number, which a hash aggregate holds in place; its text is joined back.
    last = versions.groupBy("model").agg(F.max(_number()).alias("__last"))
    found = versions.withColumn("__last", _number()).join(last, ["model", "__last"])
    return found.select("model", "version", "run_id")


def alias_rows(versions: DataFrame, alias: str, seq: Column) -> DataFrame:
    """Alias events that point ``alias`` of each model at the given version."""
    return versions.select("model", F.lit(alias).alias("alias"), "version", seq.cast("bigint").alias("seq"))


def current_aliases(events: DataFrame) -> DataFrame:
    """Where each alias of each model points after its last move."""
    last = events.groupBy("model", "alias").agg(F.max("seq").alias("seq"))
    return events.join(last, ["model", "alias", "seq"]).select("model", "alias", "version")


def resolve_aliases(events: DataFrame, versions: DataFrame) -> DataFrame:
    """``model, alias, version, run_id``. An alias on an unregistered version fails the query."""
    known = versions.select("model", "version", "run_id")
    found = current_aliases(events).join(known, ["model", "version"], "left")
    failure = F.raise_error(F.concat(F.lit("alias points at an unregistered version of "), "model"))
    return found.select("model", "alias", "version", F.coalesce("run_id", failure.cast("string")).alias("run_id"))


def passes(silhouette: Column, threshold: float = 0.35) -> Column:
    """Good enough for promotion: at the threshold or above. NaN, which sorts above all numbers, is not."""
    return F.coalesce(~F.isnan(silhouette) & (silhouette >= F.lit(threshold)), F.lit(False))


def promote(candidates: DataFrame, seq: Column, threshold: float = 0.35, alias: str = "champion") -> DataFrame:
    """Alias events for every candidate (``model, version, silhouette_score``) that passes."""
    return alias_rows(candidates.where(passes(F.col("silhouette_score"), threshold)), alias, seq)
