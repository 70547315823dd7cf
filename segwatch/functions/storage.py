"""Small tables made on the driver, and lineage cut through the folder all executors can reach."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from urllib.parse import urlparse

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHECKPOINT_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"
GROUP_BYTES = 8 << 20  # a row group of wide rows: the reader takes up to 4 096 rows of a group at once, whatever their size


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or the checkpoint folder set on the context.

    Where neither is set, intermediate tables go below the session's warehouse. On a cluster that
    has to be storage all executors reach, so a path on the driver's own disk is refused there.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get(WAREHOUSE_SETTING).rstrip("/")
    local = urlparse(warehouse).scheme in ("", "file")
    if local and not context.master.startswith("local"):
        raise ValueError(f"Set {CHECKPOINT_SETTING} to a folder all executors can reach; {warehouse} is local")
    return f"{warehouse}/segwatch-intermediate"


def _session_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/segwatch-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below this application's part of the shared folder that nothing has written to yet."""
    return f"{_session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut", wide: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later uses neither recompute it nor depend on the executor that made it. Unlike a reliable
    checkpoint, which first runs the plan and then runs it again to write, this is one job, and the
    columns later steps do not need are not read. ``wide`` rows, as packed blocks, are written in row groups of
    ``GROUP_BYTES``, as a task holds a whole group, decoded, when it reads one.
    """
    path = fresh_path(df.sparkSession, name)
    bounds = {"parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 1} if wide else {}
    df.write.options(**bounds).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove every intermediate table of this application. Lazy results that read them end with it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_session_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def claim(spark: SparkSession, path: str) -> bool:
    """Create the empty file ``path``, which must not exist. False if it does: then another writer has it.

    Of several writers one succeeds, where the file system creates files exclusively: local folders and HDFS do. Object stores
    need conditional writes for it.
    """
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place.getParent())
    if files.getScheme() == "file":  # Hadoop's own local files are created in two steps
        return jvm.java.io.File(place.toUri().getPath()).createNewFile()
    try:
        files.create(place, False).close()
    except Py4JJavaError as refused:
        if "AlreadyExists" not in refused.java_exception.getClass().getName():
            raise
        return False
    return True


def same_place(path: str) -> str:
    """A path without scheme and trailing slash, for comparing places."""
    parts = urlparse(path)
    return os.path.normpath(parts.netloc + parts.path)


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table of a few rows inside the plan itself; no Python worker is needed to read it."""
    fields = T.StructType.fromDDL(schema)
    if not rows:
        return spark.createDataFrame([], fields)
    columns = {f.name: pa.array(values) for f, values in zip(fields, zip(*rows))}
    return spark.createDataFrame(pa.table(columns), schema=fields)
