"""An update from new files gives what a full run over all files gives."""

import pytest

from crease.config import Thresholds
from crease.plans import incremental
from crease.plans.stages import Layout, run_pipeline
from crease.schemas import DELIVERIES_REQUIRED
from crease.sources import read_table, versions

MATCH = ["id", "season", "date", "venue", "winner", "toss_winner", "toss_decision", "result"]
AUDIT = {"ingested_at", "pipeline_date", "processed_at", "gold_created_at"}
LOW = Thresholds(min_matches_batsman=1, min_matches_bowler=1, min_wickets_bowler=0,
                 min_venue_matches=1, all_rounder_runs=1, all_rounder_wickets=0)


def _matches(*rows):
    return "\n".join([",".join(MATCH), *(
        f"{i},{season},2020-01-0{1 + i % 9},V{i % 3},T{i % 4},T{i % 2},bat,{result}"
        for i, season, result in rows)]) + "\n"


def _balls(*ids, runs=1, first=1):
    return "\n".join([",".join(DELIVERIES_REQUIRED), *(
        f"{i},{inning},1,{b},B{(i + b) % 5},W{(i * b) % 4},{(i + b + runs) % 7},{(i + b + runs) % 7}"
        for i in ids for inning in (1, 2) for b in range(first, first + 5))]) + "\n"


STEPS = [
    (_matches(*((i, 2015 + i % 4, "normal") for i in range(1, 13)), (13, "", "tie"),
              (14, 2016, "no result")), _balls(*range(1, 14))),
    # a late match of a known season, one of a new season, one without a season
    (_matches((20, 2016, "normal"), (21, 2030, "normal"), (22, "20x", "tie")), _balls(20, 21)),
    # a copy that moves a match to another season, and one that changes nothing
    (_matches((3, 2001, "normal"), (4, 2015, "normal")), None),
    # balls of a match that is there: copies that win and new ones
    (None, _balls(5, runs=0, first=3)),
    # balls alone, of a match that came before them
    (None, _balls(22)),
]
TABLES = [("silver", "matches"), ("silver", "deliveries"), ("gold", "batsman_stats"),
          ("gold", "bowler_stats"), ("gold", "team_season_wins"), ("gold", "match_summary"),
          ("reports", "q1_top_scorers"), ("reports", "q5_top_venues")]


def _content(spark, layout, layer, table):
    df = read_table(spark, layout.path(layer, table))
    columns = sorted(set(df.columns) - AUDIT)
    return sorted(map(repr, df.select(*columns).collect()))


def _new(folder, step, matches, balls):
    paths = []
    for kind, text in (("m", matches), ("d", balls)):
        (folder / f"{kind}{step}").mkdir()
        if text is not None:
            (folder / f"{kind}{step}" / "f.csv").write_text(text)
            (folder / f"{kind}all").mkdir(exist_ok=True)
            (folder / f"{kind}all" / f"{step}.csv").write_text(text)
        paths.append(str(folder / f"{kind}{step}") if text is not None else None)
    return paths


def _files(tmp_path, season):
    return {str(f) for f in (tmp_path / "lake/silver/matches").glob(f"part-*/season={season}/*")
            if f.suffix == ".parquet"}


def test_updates_equal_full_runs(spark, tmp_path, monkeypatch):
    lake = str(tmp_path / "lake")
    written = []
    for step, texts in enumerate(STEPS):
        layout = Layout(lake, *_new(tmp_path, step, *texts), thresholds=LOW)
        before = _files(tmp_path, 2017)
        if step == 0:
            run_pipeline(spark, layout)
        else:
            written.append(incremental.update(spark, layout))
        if step == 1:
            assert _files(tmp_path, 2017) == before  # a season that nothing new touches
        if step in (1, 2, 4):
            full = Layout(str(tmp_path / f"full{step}"), str(tmp_path / "mall"),
                          str(tmp_path / "dall"), thresholds=LOW)
            run_pipeline(spark, full)
            for layer, table in TABLES:
                assert _content(spark, layout, layer, table) \
                    == _content(spark, full, layer, table), (step, table)
    late, moved, corrected, balls = written
    assert late["silver"]["deliveries"] == 20  # the new matches' balls alone
    assert moved["silver"]["deliveries"] == 0 and "batsman_stats" not in moved["gold"]
    assert moved["silver"]["matches"] < 14
    assert corrected["silver"] == {"matches": 0, "deliveries": 13 * 10 + 20 + 2 * 2}
    assert balls["gold"]["match_summary"] == 2  # the matches without a season
    # nothing new: nothing is written
    assert incremental.update(spark, Layout(lake, thresholds=LOW)) == {
        "silver": {"matches": 0, "deliveries": 0}, "gold": {}}
    counts = {t: len(versions(spark, layout.path(*t))) for t in TABLES}
    assert counts["silver", "matches"] == 3 and counts["silver", "deliveries"] == 4

    # an update that dies between silver and gold is taken up by the next one
    layout = Layout(lake, *_new(tmp_path, 9, _matches((30, 2017, "normal")), _balls(30)),
                    thresholds=LOW)
    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        def dies(*_args):
            raise RuntimeError
        patched.setattr(incremental, "update_gold", dies)
        incremental.update(spark, layout)
    incremental.update(spark, Layout(lake, thresholds=LOW))
    full = Layout(str(tmp_path / "full9"), str(tmp_path / "mall"), str(tmp_path / "dall"),
                  thresholds=LOW)
    run_pipeline(spark, full)
    for layer, table in TABLES:
        assert _content(spark, layout, layer, table) == _content(spark, full, layer, table), table
