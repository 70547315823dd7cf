"""Settings of the end-to-end jobs, passed in explicitly."""

from __future__ import annotations

from dataclasses import dataclass

FEATURE_COLS = ("feature_1", "feature_2", "feature_3", "feature_4")


@dataclass(frozen=True)
class Settings:
    features: tuple[str, ...] = FEATURE_COLS
    model_name: str = "segments"
    n_clusters: int = 4
    random_state: int = 42
    max_iter: int = 300
    n_init: int = 10
    silhouette_rows: int = 2000
    silhouette_threshold: float = 0.35
    drift_threshold: float = 0.05
    fmt: str = "parquet"
