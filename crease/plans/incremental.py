"""Rebuild what changed: new bronze parts up to the reports.

Every table's commit says which versions it was made from.  Bronze grows by
parts, so the parts since that version are what is new:

* silver matches are partitioned by season.  The seasons of new rows, and of the
  rows they meet by id, are built anew from what silver holds of them and the new
  rows; the other seasons' files stay.  The survivor of copies is a minimum, so
  combining the last survivor with new copies gives what all copies would.
* silver deliveries of matches that silver does not have are added as a part.  If
  new balls belong to matches it has (a correction), the table is built anew from
  it and the new rows.
* the match summary is replaced for the seasons whose matches or balls changed;
  season wins and the leaderboards run over all seasons and are written anew.

A table that was not made this way (another history, buckets, no commit) is built
in full.  An update that dies is taken up where it stopped: versions, not
memory, say what is still to do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.operators import gold, silver
from crease.operators.dedup import dedup_keep_first
from crease.plans import stages
from crease.plans.stages import Layout
from crease.schemas import DELIVERY_KEY, MATCH_KEY
from crease.sources import tables
from crease.sources.files import MALFORMED, observed_write, with_audit

SEASON = "season"


def _latest(spark: SparkSession, layout: Layout, layer: str, table: str):
    return tables.latest(tables.Folder(spark, layout.path(layer, table)))


def _parts(spark: SparkSession, layout: Layout, layer: str, table: str, parts) -> DataFrame:
    return tables.load_parts(spark, layout.path(layer, table), layout.table_format,
                             _latest(spark, layout, layer, table), parts)


def _since(spark: SparkSession, layout: Layout, layer: str, table: str, number: int | None):
    """Parts of a table that are new since version ``number``; None if it has lost others."""
    now = _latest(spark, layout, layer, table)
    if number == now.number:
        return ()
    path = layout.path(layer, table)
    then = next((v for v in tables.versions(spark, path) if v.number == number), None)
    if then is None or now.parts[:len(then.parts)] != then.parts or now.hidden != then.hidden:
        return None
    return now.parts[len(then.parts):]


def _in_full(spark: SparkSession, layout: Layout, table: str, made_from: dict[str, int]) -> int:
    raw = stages.read(spark, layout, "bronze", table).drop(MALFORMED)
    return stages.write(stages.SILVER[table](raw), layout, "silver", table, "silver",
                        made_from=made_from)


def _seasons(*frames: DataFrame) -> list:
    """The seasons in the frames: as many as there are, NULL among them."""
    found: set = set()
    for df in frames:
        found |= {r[0] for r in df.select(SEASON).distinct().collect()}
    return sorted(found, key=lambda s: (s is not None, s))


def in_seasons(seasons: list):
    return tables.one_of(SEASON, seasons)


def update_matches(spark: SparkSession, layout: Layout) -> int:
    """Bring silver matches up to bronze; rows written."""
    bronze, now = (_latest(spark, layout, layer, "matches") for layer in ("bronze", "silver"))
    made_from = {"bronze": bronze.number}
    new = None if now is None or layout.match_buckets else _since(
        spark, layout, "bronze", "matches", now.made_from.get("bronze"))
    if new is None:
        return _in_full(spark, layout, "matches", made_from)
    if not new:
        return 0
    raw = _parts(spark, layout, "bronze", "matches", new).drop(MALFORMED)
    fresh = silver.valid_matches(raw)
    held = stages.read(spark, layout, "silver", "matches").select(*fresh.columns)
    met = held.join(fresh.select("id").distinct(), "id", "left_semi")
    touched = _seasons(fresh, met)
    rows = held.where(in_seasons(touched)).unionByName(fresh)
    merged = silver.flag_matches(dedup_keep_first(rows, MATCH_KEY), raw.schema["date"].dataType)
    return observed_write(
        with_audit(merged, "silver"), layout.path("silver", "matches"), layout.table_format,
        "replace", [SEASON], values=touched, made_from=made_from)["rows"]


def update_deliveries(spark: SparkSession, layout: Layout) -> int:
    """Bring silver deliveries up to bronze; rows written."""
    bronze, now = (_latest(spark, layout, layer, "deliveries") for layer in ("bronze", "silver"))
    made_from = {"bronze": bronze.number}
    new = None if now is None or layout.match_buckets else _since(
        spark, layout, "bronze", "deliveries", now.made_from.get("bronze"))
    if new is None:
        return _in_full(spark, layout, "deliveries", made_from)
    if not new:
        return 0
    raw = _parts(spark, layout, "bronze", "deliveries", new).drop(MALFORMED)
    held = stages.read(spark, layout, "silver", "deliveries").select(*raw.columns)
    mode = "append"
    if not held.join(raw.select("match_id").distinct(), "match_id", "left_semi").isEmpty():
        raw, mode = held.unionByName(raw), "overwrite"
    return observed_write(
        with_audit(silver.enrich_deliveries(raw), "silver"), layout.path("silver", "deliveries"),
        layout.table_format, mode, made_from=made_from)["rows"]


def _summary(spark: SparkSession, layout: Layout, made_from: dict[str, int]) -> int:
    matches = stages.read(spark, layout, "silver", "matches")
    deliveries = stages.read(spark, layout, "silver", "deliveries")
    now = _latest(spark, layout, "gold", "match_summary")
    touched = None
    if now is not None and set(now.made_from) == set(made_from):
        seasons = tables.touched_since(spark, layout.path("silver", "matches"),
                                       now.made_from["matches"])
        balls = _since(spark, layout, "silver", "deliveries", now.made_from["deliveries"])
        if seasons is not None and balls is not None:
            touched = set(seasons)
            if balls:
                played = _parts(spark, layout, "silver", "deliveries", balls) \
                    .select(F.col("match_id").alias("id")).distinct()
                touched |= set(_seasons(matches.join(played, "id", "left_semi")))
    if touched is None:
        return stages.write(gold.match_summary(matches, deliveries), layout, "gold",
                            "match_summary", "gold", made_from=made_from)
    touched = sorted(touched, key=lambda s: (s is not None, s))
    changed = matches.where(in_seasons(touched))
    # only the balls of these matches are added up
    balls = deliveries.join(changed.select(F.col("id").alias("match_id")), "match_id", "left_semi")
    return observed_write(
        with_audit(gold.match_summary(changed, balls), "gold"),
        layout.path("gold", "match_summary"), layout.table_format, "replace", [SEASON],
        values=touched, made_from=made_from)["rows"]


def update_gold(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Bring the gold tables up to silver; rows written, per table that had to change."""
    made_from = {t: _latest(spark, layout, "silver", t).number for t in ("matches", "deliveries")}
    needs = {"batsman_stats": ["deliveries"], "bowler_stats": ["deliveries"],
             "team_season_wins": ["matches"], "match_summary": ["matches", "deliveries"]}

    def stale(table: str) -> bool:
        now = _latest(spark, layout, "gold", table)
        return now is None or now.made_from != {t: made_from[t] for t in needs[table]}

    jobs: dict[str, Callable] = {}
    if stale("match_summary"):
        jobs["match_summary"] = lambda: _summary(spark, layout, made_from)
    rest = [t for t in ("batsman_stats", "bowler_stats", "team_season_wins") if stale(t)]
    builders = stages.gold_builders(spark, layout, made_from)
    if {"batsman_stats", "bowler_stats"} & set(rest):
        jobs["leaderboards"] = builders["leaderboards"]
    if "team_season_wins" in rest:
        jobs["team_season_wins"] = builders["team_season_wins"]
    done = stages.write_all(layout, jobs)
    return done.pop("leaderboards", {}) | done


def update(spark: SparkSession, layout: Layout) -> dict[str, dict[str, int]]:
    """Append what ``layout`` names as sources to bronze, then bring silver, gold and the
    reports up to it; rows written per stage and table (0: nothing new)."""
    counts: dict[str, dict[str, int]] = {}
    if layout.matches_source or layout.deliveries_source:
        counts["bronze"] = stages.run_bronze(spark, layout, "append")
    counts["silver"] = stages.write_all(layout, {
        "matches": lambda: update_matches(spark, layout),
        "deliveries": lambda: update_deliveries(spark, layout)})
    counts["gold"] = update_gold(spark, layout)
    if counts["gold"]:
        counts["reports"] = stages.run_reports(spark, layout)
    return counts
