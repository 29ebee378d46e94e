"""Commits: a whole version at every step, concurrent writers, streams and clean-up."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from crease.sources import expire, read_table, tables, versions, write_table
from crease.sources.files import observed_write


class Killed(Exception):
    pass


def _ids(spark, path, **options):
    return sorted(r.id for r in read_table(spark, path, **options).collect())


def _torn(length):
    """A writer that dies after ``length`` characters of its commit."""
    def put(self, stream, text):
        stream.write(bytearray(text[:length].encode()))
        raise Killed
    return put


def _dies_in_data(spark, path, monkeypatch):
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("no"))
                                          .cast("long")).otherwise(F.col("id")).alias("id"))
    write_table(broken, path)


def _dies_before_commit(spark, path, monkeypatch):
    def gone(*_args, **_options):
        raise Killed
    monkeypatch.setattr(tables.Folder, "create", gone)
    write_table(spark.range(100, 103), path)


def _dies_in_commit(length):
    def run(spark, path, monkeypatch):
        monkeypatch.setattr(tables.Folder, "put", _torn(length))
        write_table(spark.range(100, 103), path)
    return run


def _dies_after_draft(spark, path, monkeypatch):
    def gone(*_args):
        raise Killed
    monkeypatch.setattr(tables, "_one_at_a_time", type("Lock", (), {"__enter__": gone,
                                                                    "__exit__": gone})())
    write_table(spark.range(100, 103), path)


@pytest.mark.parametrize("die", [_dies_in_data, _dies_before_commit, _dies_after_draft, *[
    _dies_in_commit(n) for n in (0, 40)]])
def test_a_writer_killed_at_any_step_leaves_a_whole_version(spark, tmp_path, monkeypatch, die):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    opened = read_table(spark, path)  # a reader from before
    for mode in ("overwrite", "append"):
        with monkeypatch.context() as patched, pytest.raises(Exception):  # noqa: B017
            die(spark, path, patched)
        assert _ids(spark, path) == list(range(5)), mode
    assert write_table(spark.range(7), path) == 7  # the next writer goes on
    assert _ids(spark, path) == list(range(7))
    assert write_table(spark.range(7, 9), path, mode="append") == 2
    assert _ids(spark, path) == list(range(9))
    assert opened.count() == 5


def test_a_torn_commit_is_not_a_version(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    commits = tmp_path / "t" / "_commits"
    whole = next(commits.glob("*1.json")).read_text()
    for number, text in ((2, ""), (3, whole[:30]), (4, "[1]"), (5, "{}")):
        (commits / f"{number:020d}.json").write_text(text)
    assert _ids(spark, path) == list(range(5))
    write_table(spark.range(6), path)
    assert [v.number for v in versions(spark, path)] == [6, 1]


def test_earlier_versions_and_their_removal(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2, 3):
        write_table(spark.range(n), path)
    write_table(spark.range(10, 11), path, mode="append")
    assert [v.number for v in versions(spark, path)] == [4, 3, 2, 1]
    assert _ids(spark, path, version=2) == [0, 1]
    assert _ids(spark, path) == [0, 1, 2, 10]
    spark.range(1).write.parquet(f"{path}/part-unfinished")
    assert [n for n in expire(spark, path, keep=2) if n.startswith("part")] == []  # too young
    assert [v.number for v in versions(spark, path)] == [4, 3]
    assert len(expire(spark, path, keep=1, older_than=0)) == 1 + 3  # a commit, three parts
    assert _ids(spark, path) == [0, 1, 2, 10]
    assert expire(spark, path, older_than=0) == []
    with pytest.raises(ValueError):
        expire(spark, path, keep=0)


def test_writers_at_the_same_time_lose_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: write_table(spark.range(i, i + 1), path, mode="append"),
                      range(12)))
    assert _ids(spark, path) == list(range(12))
    assert [v.number for v in versions(spark, path)] == list(range(12, 0, -1))


def test_a_batch_is_added_once(spark, tmp_path):
    path = str(tmp_path / "t")
    for stream, batch, rows in (("a", 0, 2), ("a", 0, 0), ("a", 1, 2), ("a", 0, 0), ("b", 0, 2),
                                ("b", 0, 0)):
        assert observed_write(spark.range(2), path, mode="append",
                              batch=(stream, batch)) == {"rows": rows}
    write_table(spark.range(1), path)  # an overwrite does not forget them
    assert observed_write(spark.range(2), path, mode="append", batch=("a", 1)) == {"rows": 0}


def test_partitioned_parts_and_tables_written_in_place(spark, tmp_path):
    path, plain = str(tmp_path / "t"), str(tmp_path / "plain")
    rows = spark.range(6).withColumn("season", F.col("id") % 2)
    write_table(rows, path, partition_by=["season"])
    write_table(rows.where("season = 1"), path, mode="append", partition_by=["season"])
    assert read_table(spark, path).where("season = 1").count() == 6
    rows.write.parquet(plain)
    assert _ids(spark, plain) == list(range(6))
    with pytest.raises(ValueError, match="mode"):
        write_table(rows, path, mode="ignore")
