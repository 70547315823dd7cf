"""Segmentation and drift monitoring of large tables with Spark."""

import sys

from pyspark import cloudpickle

from segwatch.config import FEATURE_COLS, Settings
from segwatch.plans.jobs import evaluate, monitor, run_monitoring, run_scoring, score, train
from segwatch.plans.runlog import RunLog

# Functions that run in Python workers travel inside the task, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "FEATURE_COLS",
    "RunLog",
    "Settings",
    "evaluate",
    "monitor",
    "run_monitoring",
    "run_scoring",
    "score",
    "train",
]
