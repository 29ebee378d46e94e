"""CSV -> bronze -> silver -> gold -> reports on storage, restartable per stage."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from crease.operators import gold
from crease.plans import catalog
from crease.plans.stages import Layout, run_pipeline, run_stage
from crease.schemas import (
    DELIVERIES_REQUIRED,
    DELIVERIES_SCHEMA,
    MATCHES_REQUIRED,
    MATCHES_SCHEMA,
)
from crease.sources.files import csv_groups, ingest, read_table
from tests.conftest import SF


def _as_raw_csv(df, schema, path):
    cols = [(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    df.select(*cols).write.option("header", "true").csv(path)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_round_trip(spark, tmp_path):
    sf = SF["0.01"]  # the smallest scale where every report has rows
    _as_raw_csv(catalog.bronze_matches(spark, sf), MATCHES_SCHEMA, str(tmp_path / "raw_m"))
    _as_raw_csv(catalog.bronze_deliveries(spark, sf), DELIVERIES_SCHEMA, str(tmp_path / "raw_d"))
    layout = Layout(str(tmp_path / "lake"), str(tmp_path / "raw_m"), str(tmp_path / "raw_d"))

    counts = run_pipeline(spark, layout)
    assert counts["bronze"] == {"matches": 15750, "deliveries": 66058, "matches_malformed": 0,
                                "deliveries_malformed": 0}
    assert counts["silver"] == {"matches": 12004, "deliveries": 58165}
    assert counts["gold"]["batsman_stats"] == 80
    assert counts["gold"]["match_summary"] == 12004
    assert counts["reports"]["q6_all_rounders"] > 0

    def stored(layer, table):
        return read_table(spark, layout.path(layer, table))

    assert {"ingested_at", "pipeline_date"} <= set(stored("bronze", "matches").columns)
    assert "processed_at" in stored("silver", "matches").columns
    assert "gold_created_at" in stored("gold", "batsman_stats").columns
    season = stored("silver", "matches").select("season").first().season
    plan = stored("silver", "matches").where(F.col("season") == season)._jdf.queryExecution()
    assert "PartitionFilters: [isnotnull(season" in plan.toString()

    for name in ("q1_top_scorers", "q2_best_economy", "q3_team_form", "q4_toss_rate",
                 "q5_top_venues", "q6_all_rounders", "top_wicket_takers", "team_total_wins"):
        written = stored("reports", name)
        expected = catalog.QUERIES[name](spark, sf)
        assert _rows(written) == _rows(expected), name

    # a single stage reruns from the layer below it
    assert run_stage(spark, layout, "gold")["bowler_stats"] == counts["gold"]["bowler_stats"]


def test_bucketed_layers_need_no_shuffle_per_match(spark, tmp_path):
    sf = SF["0.001"]
    _as_raw_csv(catalog.bronze_matches(spark, sf), MATCHES_SCHEMA, str(tmp_path / "m"))
    _as_raw_csv(catalog.bronze_deliveries(spark, sf), DELIVERIES_SCHEMA, str(tmp_path / "d"))
    plain = Layout(str(tmp_path / "plain"), str(tmp_path / "m"), str(tmp_path / "d"))
    dealt = replace(plain, root=str(tmp_path / "dealt"), match_buckets=6)
    stages = ["bronze", "silver", "gold"]
    assert run_pipeline(spark, plain, stages) == run_pipeline(spark, dealt, stages)

    def stored(layout, layer, table):
        df = read_table(spark, layout.path(layer, table))
        return df.drop("ingested_at", "pipeline_date", "processed_at", "gold_created_at")

    for layer, table in (("silver", "matches"), ("silver", "deliveries"),
                         ("gold", "match_summary"), ("gold", "bowler_stats")):
        one, two = (stored(x, layer, table) for x in (plain, dealt))
        assert sorted(map(repr, one.select(*two.columns).collect())) \
            == sorted(map(repr, two.collect()))
    files = [f for f in (tmp_path / "dealt/silver/deliveries").glob("part-*/*.parquet")]
    assert 1 < len(files) <= 6
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        m, d = stored(dealt, "silver", "matches"), stored(dealt, "silver", "deliveries")

        def plan(df):
            return df._jdf.queryExecution().executedPlan().toString()

        summary = plan(gold.match_summary(m, d))
        assert "SortMergeJoin" in summary and "Exchange" not in summary
        assert "Exchange" not in plan(gold.innings_runs(d))
        assert plan(gold.batting_board(d)).count("Exchange") == 1  # per player
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # a table is read by another session from its commits alone
    assert read_table(spark.newSession(), dealt.path("silver", "deliveries")).count() == d.count()


def test_ingest_infers_schema_when_none_given(spark, tmp_path):
    raw = catalog.bronze_matches(spark, SF["0.001"])
    _as_raw_csv(raw, MATCHES_SCHEMA, str(tmp_path / "m"))
    inferred = ingest(spark, str(tmp_path / "m"))
    types = dict(inferred.dtypes)
    assert types["id"] == "int" and types["season"] == "int" and types["date"] == "date"
    assert MATCHES_REQUIRED[0] in types
    assert inferred.count() == raw.count()


def test_command_line_runs_one_stage(spark, tmp_path, capsys):
    import json

    from crease.__main__ import main

    sf = SF["0.001"]
    _as_raw_csv(catalog.bronze_matches(spark, sf), MATCHES_SCHEMA, str(tmp_path / "m"))
    _as_raw_csv(catalog.bronze_deliveries(spark, sf), DELIVERIES_SCHEMA, str(tmp_path / "d"))
    main(["--root", str(tmp_path / "lake"), "--matches", str(tmp_path / "m"),
          "--deliveries", str(tmp_path / "d"), "--only", "bronze"])
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counts == {"bronze": {"matches": 1575, "deliveries": 6610, "matches_malformed": 0,
                                 "deliveries_malformed": 0}}


def _csv(folder, header, *lines):
    folder.mkdir()
    (folder / "part.csv").write_text("\n".join([header, *lines]) + "\n")
    return str(folder)


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    names = [f.name for f in DELIVERIES_SCHEMA.fields]
    row = {n: "" for n in names} | {
        "match_id": "1", "inning": "1", "over": "2", "ball": "3", "batsman": "A", "bowler": "B",
        "batsman_runs": "4", "extra_runs": "0", "total_runs": "4", "penalty_runs": "0"}
    shorter = [n for n in names if n != "penalty_runs"]
    for i, order in enumerate((names, shorter, names[::-1])):
        path = _csv(tmp_path / f"d{i}", ",".join(order), ",".join(row[n] for n in order))
        got = ingest(spark, path, DELIVERIES_SCHEMA, required=DELIVERIES_REQUIRED).first()
        assert (got.batsman, got.bowler) == ("A", "B")
        assert (got.batsman_runs, got.extra_runs, got.total_runs) == (4, 0, 4)
        assert got.penalty_runs == (None if order is shorter else 0)
    path = _csv(tmp_path / "missing", "match_id,inning", "1,1")
    with pytest.raises(ValueError, match="batsman"):
        ingest(spark, path, DELIVERIES_SCHEMA, required=DELIVERIES_REQUIRED)


def test_raw_text_stays_in_bronze_and_bad_records_are_counted(spark, tmp_path):
    matches = _csv(tmp_path / "m", "season,id,result,date,toss_decision,toss_winner,winner",
                   "2007/08,1,normal,2008-04-18,bat,A,A", "2009,x,normal,18/04/2009,bat,A,B")
    deliveries = _csv(tmp_path / "d", ",".join(DELIVERIES_REQUIRED), "1,1,1,1,A,B,4,4")
    layout = Layout(str(tmp_path / "lake"), matches, deliveries)
    counts = run_pipeline(spark, layout, ["bronze", "silver"])
    assert counts["bronze"] == {"matches": 2, "matches_malformed": 1, "deliveries": 1,
                                "deliveries_malformed": 0}
    bronze = {r.season: r.date
              for r in read_table(spark, layout.path("bronze", "matches")).collect()}
    assert bronze == {"2007/08": "2008-04-18", "2009": "18/04/2009"}
    silver = read_table(spark, layout.path("silver", "matches"))
    assert {r.id: (r.season, r.match_date is None) for r in silver.collect()} == {
        1: (None, False), None: (2009, True)}


def test_files_of_one_folder_may_have_different_headers(spark, tmp_path):
    row = {"match_id": 1, "inning": 1, "over": 1, "ball": 1, "batsman": "BAT", "bowler": "BOWL",
           "batsman_runs": 4, "total_runs": 5, "fielder": "F", "new column": "?"}
    swapped = ["bowler", "batsman", *[c for c in DELIVERIES_REQUIRED if c[:3] not in ("bow",)
                                      and c != "batsman"]]
    headers = [DELIVERIES_REQUIRED, swapped, DELIVERIES_REQUIRED, [*swapped, "fielder"],
               ["new column", *DELIVERIES_REQUIRED]]
    folder = tmp_path / "d"
    folder.mkdir()
    for i, header in enumerate(headers):
        name = "odd [1]{a}*.csv" if i == 1 else f"f{i}.csv"
        (folder / name).write_text(",".join(header) + "\n" + ",".join(
            str(row[c] + 10 * i if c == "match_id" else row[c]) for c in header) + "\n")
    (folder / "empty.csv").write_text("")
    assert len(csv_groups(spark, str(folder))) == 4
    got = ingest(spark, str(folder), DELIVERIES_SCHEMA, required=DELIVERIES_REQUIRED)
    assert got.columns == [*[f.name for f in DELIVERIES_SCHEMA.fields], "_corrupt_record"]
    found = {r.match_id: r for r in got.collect()}
    assert sorted(found) == [1, 11, 21, 31, 41]
    for r in found.values():
        assert (r.batsman, r.bowler, r.batsman_runs, r.total_runs) == ("BAT", "BOWL", 4, 5)
        assert r._corrupt_record is None
    assert [found[i].fielder for i in (1, 31)] == [None, "F"]
    (folder / "short.csv").write_text("match_id,inning\n1,1\n")
    with pytest.raises(ValueError, match="missing columns.*short.csv"):
        ingest(spark, str(folder), DELIVERIES_SCHEMA, required=DELIVERIES_REQUIRED)
    (tmp_path / "none").mkdir()
    assert ingest(spark, str(tmp_path / "none"), DELIVERIES_SCHEMA).count() == 0
