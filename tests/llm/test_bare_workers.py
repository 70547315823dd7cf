"""Every operator's query with Python workers that cannot import this repository."""

from __future__ import annotations

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])  # the driver's path alone: it is no environment variable and the folder is another one
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[3]).getOrCreate())
def bare(_):
    import importlib.util
    return importlib.util.find_spec("segwatch") is None
assert all(spark.sparkContext.parallelize(range(4), 4).map(bare).collect())
import __spark_entry__
for name, query in __spark_entry__.queries().items():
    if name.startswith("op"):
        query(spark, sys.argv[2]).write.format("noop").mode("overwrite").save()
        print("done", name)
"""


def test_queries_run_where_workers_have_no_copy(data, tmp_path):
    sf_dir = os.path.dirname(data("0.001", "documents"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, REPO, sf_dir, str(tmp_path / "shared")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900
    )
    assert run.returncode == 0, run.stderr[-3000:]
    assert run.stdout.count("done op") == 13
