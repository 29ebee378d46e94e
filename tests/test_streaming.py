"""Incremental ingest appends each landed file once."""

import pytest
from pyspark.sql import functions as F

from crease.plans import catalog
from crease.schemas import MATCHES_SCHEMA
from crease.sources import read_table, tables
from crease.streaming import ingest_new_files
from tests.conftest import SF


def test_incremental_ingest(spark, tmp_path):
    raw = catalog.bronze_matches(spark, SF["0.001"])
    cols = [(F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType)
            .alias(f.name) for f in MATCHES_SCHEMA.fields]
    full = raw.select(*cols)
    first, second = full.filter(F.col("id") % 2 == 0), full.filter(F.col("id") % 2 == 1)
    landing, target = str(tmp_path / "landing"), str(tmp_path / "bronze")
    ckpt = str(tmp_path / "ckpt")

    first.write.option("header", "true").csv(landing + "/batch1")
    n1 = ingest_new_files(spark, landing + "/*", MATCHES_SCHEMA, target, "m", checkpoint=ckpt)
    assert n1 == first.count()
    # nothing new: a rerun appends nothing
    assert ingest_new_files(spark, landing + "/*", MATCHES_SCHEMA, target, "m",
                            checkpoint=ckpt) == 0
    second.write.option("header", "true").csv(landing + "/batch2")
    n2 = ingest_new_files(spark, landing + "/*", MATCHES_SCHEMA, target, "m", checkpoint=ckpt)
    assert n2 == second.count()
    bronze = read_table(spark, target)
    assert bronze.count() == full.count()
    assert {"ingested_at", "pipeline_date"} <= set(bronze.columns)


def test_default_progress_location_is_stable(spark, tmp_path):
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        import pytest

        pytest.skip("session has no spark.checkpoint.dir")
    raw = catalog.bronze_matches(spark, SF["0.001"])
    cols = [(F.col(f.name) if f.name in raw.columns else F.lit(None)).cast(f.dataType)
            .alias(f.name) for f in MATCHES_SCHEMA.fields]
    raw.select(*cols).write.option("header", "true").csv(str(tmp_path / "landing"))
    name, target = f"m_{uuid.uuid4().hex}", str(tmp_path / "bronze")
    first = ingest_new_files(spark, str(tmp_path / "landing"), MATCHES_SCHEMA, target, name)
    assert first == raw.count()
    assert ingest_new_files(spark, str(tmp_path / "landing"), MATCHES_SCHEMA, target, name) == 0


def test_files_of_one_run_may_have_different_headers(spark, tmp_path):
    landing, target = tmp_path / "landing", str(tmp_path / "bronze")
    landing.mkdir()
    options = {"checkpoint": str(tmp_path / "ckpt"), "required": ["id", "winner"]}
    (landing / "a.csv").write_text("id,winner,venue\n1,W,V\n2,W,V\n")
    (landing / "b.csv").write_text("venue,id,winner\nV,3,W\n")
    assert ingest_new_files(spark, str(landing), MATCHES_SCHEMA, target, "h", **options) == 3
    (landing / "c.csv").write_text("winner,id\nW,4\n")
    assert ingest_new_files(spark, str(landing), MATCHES_SCHEMA, target, "h", **options) == 1
    assert sorted((r.id, r.winner, r.venue) for r in read_table(spark, target).collect()) == [
        (1, "W", "V"), (2, "W", "V"), (3, "W", "V"), (4, "W", None)]


def test_a_batch_that_is_run_again_is_not_added_twice(spark, tmp_path, monkeypatch):
    landing, target = tmp_path / "landing", str(tmp_path / "bronze")
    landing.mkdir()
    (landing / "a.csv").write_text("id,winner\n1,W\n")
    run = {"checkpoint": str(tmp_path / "ckpt")}
    commit = tables.commit_part

    def commit_and_die(*args, **options):
        commit(*args, **options)
        raise RuntimeError("killed after the commit")

    monkeypatch.setattr("crease.sources.files.commit_part", commit_and_die)
    with pytest.raises(Exception, match="killed"):
        ingest_new_files(spark, str(landing), MATCHES_SCHEMA, target, "r", **run)
    monkeypatch.undo()
    assert ingest_new_files(spark, str(landing), MATCHES_SCHEMA, target, "r", **run) == 0
    assert read_table(spark, target).count() == 1
