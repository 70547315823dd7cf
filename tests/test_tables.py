import pytest
from pyspark.sql import functions as F

from segwatch.sources import tables
from segwatch.sources.tables import read_csv, read_table, snapshots, write_csv, write_table


class Stopped(Exception):
    pass


def numbers(spark, path):
    return sorted(r["id"] for r in read_table(spark, path).collect())


STEPS = ["_refuse_no_table", "_claim_number", "write", "claim", "_forget", "end"]


@pytest.mark.parametrize("old", ["snapshot", "plain"])
@pytest.mark.parametrize("step", STEPS)
def test_a_stop_before_any_step_leaves_a_whole_table(spark, tmp_path, monkeypatch, step, old):
    path = str(tmp_path / "t")
    if old == "plain":
        spark.range(7).write.parquet(path)
    else:
        for n in (2, 7):
            write_table(spark.range(n), path)

    def stop(*args):
        raise Stopped

    fresh = spark.range(100, 105)
    if step == "write":  # died half way: files are there, but nothing says that they are all
        def half(to):
            fresh.where("id < 102").write.parquet(to)
            monkeypatch.setattr(tables, "_folder", stop)  # nor does it clean up
            raise Stopped

        with pytest.raises(Stopped):
            tables._replace(spark, path, half)
    elif step == "claim":
        real = tables.claim
        monkeypatch.setattr(tables, "claim", lambda s, p: stop() if p.endswith(".done") else real(s, p))
        with pytest.raises(Stopped):
            write_table(fresh, path)
    elif step != "end":
        monkeypatch.setattr(tables, step, stop)
        with pytest.raises(Stopped):
            write_table(fresh, path)
    else:
        write_table(fresh, path)
    monkeypatch.undo()
    assert numbers(spark, path) == (list(range(100, 105)) if step in ("_forget", "end") else list(range(7)))
    write_table(spark.range(3), path)  # the next writer is not held up by what is left
    assert numbers(spark, path) == [0, 1, 2]


def test_a_reader_that_has_begun_ends_with_the_table_it_chose(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(4), path)
    reader = read_table(spark, path)
    write_table(spark.range(9), path)
    assert reader.count() == 4 and read_table(spark, path).count() == 9
    write_table(read_table(spark, path).where("id < 2"), path)  # its own input
    assert numbers(spark, path) == [0, 1]


def test_old_snapshots_are_read_by_number_and_forgotten(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(99), path)
    assert spark.read.parquet(path).count() == 99 and snapshots(spark, path) == []  # files that any reader knows
    for n in range(1, 5):
        write_table(spark.range(n), path, keep=3)
        assert (tmp_path / "t" / "_SUCCESS").exists() == (n < 3)  # the plain files are the oldest snapshot
    assert snapshots(spark, path) == [2, 3, 4]
    assert read_table(spark, path, snapshot=2).count() == 2
    with pytest.raises(LookupError, match="no snapshot 1"):
        read_table(spark, path, snapshot=1)
    write_table(spark.range(5), path, keep=1)
    assert snapshots(spark, path) == [5]
    assert {p.name for p in (tmp_path / "t" / "_snapshots").iterdir() if p.is_dir()} == {"5"}
    with pytest.raises(ValueError, match="at least"):
        write_table(spark.range(5), path, keep=0)


def test_the_writer_with_the_higher_number_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(2), path)

    def slow(to):
        write_table(spark.range(20), path)  # begins later and ends earlier
        spark.range(10).write.parquet(to)

    tables._replace(spark, path, slow)
    assert numbers(spark, path) == list(range(20)) and snapshots(spark, path) == [1, 2]


def test_csv_snapshots_and_tables_inside_tables(spark, tmp_path):
    path = str(tmp_path / "c")
    for n in (3, 4, 5):
        write_csv(spark.range(n).withColumn("x", F.lit("a,b")), path)
    assert read_csv(spark, path, "id bigint, x string").count() == 5
    with pytest.raises(ValueError, match="itself a table"):
        write_table(spark.range(1), f"{path}/inside")
    assert read_csv(spark, path).columns == ["id", "x"]


def test_a_failing_first_write_leaves_nothing(spark, tmp_path):
    path = tmp_path / "t"
    bad = spark.range(100).selectExpr("if(id = 99, raise_error('stop'), id) AS id")
    with pytest.raises(Exception, match="stop"):
        write_table(bad, str(path))
    assert not path.exists()

    def late(to):
        spark.range(3).write.parquet(to)  # another writer was first
        spark.range(5).write.parquet(to)

    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables._replace(spark, str(path), late)
    assert numbers(spark, str(path)) == [0, 1, 2]
