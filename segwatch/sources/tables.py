"""Table sources and sinks. Reading is lazy: nothing is collected, and Catalyst prunes the scan."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from py4j.java_gateway import JavaObject
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from segwatch.functions.storage import claim, same_place

SNAPSHOTS = "_snapshots"  # below a table: n/ holds snapshot n, n.claim its writer's claim, n.done says it is complete
KEPT_SNAPSHOTS = 2
FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")
CSV_FILE_ROWS = 1_000_000
NULL_MARK = "\\N"
# Both ways: quotes doubled, spaces kept, NULL apart from the empty text.
DIALECT = {
    "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    "nullValue": NULL_MARK, "emptyValue": "",
}


def _folder(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of ``path`` and its Hadoop path."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, from one listing; nothing if it is absent."""
    files, place = _folder(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(place)] if files.exists(place) else []


def _numbers(names: Sequence[str], ending: str) -> list[int]:
    heads = (name.removesuffix(ending) for name in names if name.endswith(ending))
    return sorted(int(head) for head in heads if head.isdigit())


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """The complete snapshots of the table at ``path``, oldest first; none for a plain folder of files."""
    return _numbers(_names(spark, f"{path.rstrip('/')}/{SNAPSHOTS}"), ".done")


def current_folder(spark: SparkSession, path: str, snapshot: int | None = None) -> str:
    """The folder with the files of a table: of ``snapshot``, or of the last complete one, or ``path`` itself.

    The folder is chosen once, so whoever reads it sees one whole table, whatever is written meanwhile.
    """
    known = snapshots(spark, path)
    if snapshot is not None and snapshot not in known:
        raise LookupError(f"{path} has no snapshot {snapshot}, but {known}")
    if not known:
        return path
    return f"{path.rstrip('/')}/{SNAPSHOTS}/{known[-1] if snapshot is None else snapshot}"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", snapshot: int | None = None) -> DataFrame:
    """Scan a table that carries its own schema (parquet; delta or others where installed).

    File formats give the last complete snapshot, or an older one by its number.
    """
    if fmt in FILE_FORMATS:
        path = current_folder(spark, path, snapshot)
    elif snapshot is not None:
        raise ValueError(f"{fmt} has versions of its own")
    return spark.read.format(fmt).load(path)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Scan CSV with a header row. Without a schema Spark reads the files once more to infer it.

    Quotes are doubled inside quotes, line breaks inside quotes and outer spaces belong to the value, and
    an unquoted ``NULL_MARK`` is NULL while nothing between quotes is the empty text. Line breaks inside
    values make a file unsplittable, so ``write_csv`` writes files of a bounded number of rows.
    """
    path = current_folder(spark, path)
    reader = spark.read.options(header=True, enforceSchema=False, multiLine=True, **DIALECT)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def _refuse_overlap(path: str, sources: Sequence[str]) -> None:
    target = same_place(path)
    for source in map(same_place, sources):
        if source == target or source.startswith(target + "/") or target.startswith(source + "/"):
            raise ValueError(f"Refusing to overwrite {path}: it overlaps the input {source}")


def _refuse_no_table(spark: SparkSession, path: str) -> None:
    """Refuse a target that holds other tables or lies inside one."""
    files, target = _folder(spark, path)
    if files.exists(target):
        for entry in files.listStatus(target):
            name = entry.getPath().getName()
            if entry.isDirectory() and "=" not in name and not name.startswith(("_", ".")):
                raise ValueError(f"Refusing to overwrite {path}: it is no table but holds the folder {name}")
    above = target.getParent()
    if above is not None and any(
        name == SNAPSHOTS or name.startswith("part-") for name in _names(spark, above.toString())
    ):
        raise ValueError(f"Refusing to write {path}: the folder above it is itself a table")


def _claim_number(spark: SparkSession, home: str) -> int:
    """A snapshot number that no other writer has or had."""
    names = _names(spark, home)
    number = max([0, *_numbers(names, ".claim"), *_numbers(names, ".done")]) + 1
    while not claim(spark, f"{home}/{number}.claim"):
        number += 1
    return number


def _forget(spark: SparkSession, path: str, keep: int) -> None:
    """Remove all but the last ``keep`` complete snapshots; the files of a plain folder count as the oldest one.

    A snapshot stops being complete before its files go. Claims stay, so a number is never given twice.
    """
    home = f"{path.rstrip('/')}/{SNAPSHOTS}"
    files, target = _folder(spark, path)
    known = snapshots(spark, path)
    for number in known[:-keep]:
        files.delete(_folder(spark, f"{home}/{number}.done")[1], False)
        files.delete(_folder(spark, f"{home}/{number}")[1], True)
    for entry in files.listStatus(target):
        if len(known) >= keep and entry.getPath().getName() != SNAPSHOTS:
            files.delete(entry.getPath(), True)


def _write_whole(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write a new folder, or none if the job fails. A folder that another writer made meanwhile is left alone."""
    try:
        write(path)
    except BaseException as problem:
        if not isinstance(problem, AnalysisException) or problem.getCondition() != "PATH_ALREADY_EXISTS":
            files, fresh = _folder(spark, path)
            files.delete(fresh, True)
        raise


def _replace(spark: SparkSession, path: str, write: Callable[[str], None], keep: int = KEPT_SNAPSHOTS) -> None:
    """Write a new snapshot below ``path`` and let it count when it is complete; nothing is renamed.

    Where nothing is yet, the table is a plain folder of files, which every reader knows, and Spark commits them.
    To replace it, a writer claims a number, writes the folder of that number and last creates the empty file that makes it
    the table, in one step on every store. Until then readers see what was before. Of several writers that with the
    highest number wins. A job that fails removes its folder; a writer that dies leaves one that nobody reads.
    """
    if keep < 1:
        raise ValueError("keep at least the new snapshot")
    _refuse_no_table(spark, path)
    files, target = _folder(spark, path)
    if not files.exists(target):
        _write_whole(spark, path, write)
        return
    home = f"{path.rstrip('/')}/{SNAPSHOTS}"
    number = _claim_number(spark, home)
    _write_whole(spark, f"{home}/{number}", write)
    claim(spark, f"{home}/{number}.done")
    _forget(spark, path, keep)


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", sources: Sequence[str] = (), keep: int = KEPT_SNAPSHOTS
) -> None:
    """Replace the table at ``path``; the old one stays until the new one is complete.

    ``sources`` are input paths that the target must not overlap. ``keep`` snapshots stay, this one included: with the one
    before it, jobs that have begun to read that one can end. Formats with their own transactions overwrite in place.
    """
    _refuse_overlap(path, sources)
    if fmt in FILE_FORMATS:
        _replace(df.sparkSession, path, lambda to: df.write.format(fmt).save(to), keep)
    else:
        df.write.format(fmt).mode("overwrite").save(path)


def write_csv(df: DataFrame, path: str, sources: Sequence[str] = (), keep: int = KEPT_SNAPSHOTS) -> None:
    """Replace the CSV table at ``path``: a header row in each file, no index column, files of bounded size."""
    _refuse_overlap(path, sources)
    options = {"header": True, "maxRecordsPerFile": CSV_FILE_ROWS, **DIALECT, "emptyValue": '""'}
    _replace(df.sparkSession, path, lambda to: df.write.options(**options).csv(to), keep)
