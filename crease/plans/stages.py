"""Stage runner: raw files -> bronze -> silver -> gold -> reports.

Each stage reads the previous layer from storage and overwrites its own
tables, so any stage can be rerun alone and a failed run restarts from the
last written layer.  Written layers also cut the lineage: a lost executor
only recomputes work inside the current stage.  Audit columns are added
here, at the sink, never inside the transforms.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from crease.config import Thresholds
from crease.operators import gold, reports, silver
from crease.plans.jobs import run_together
from crease.schemas import (
    DELIVERIES_REQUIRED,
    DELIVERIES_SCHEMA,
    MATCHES_REQUIRED,
    MATCHES_SCHEMA,
)
from crease.sources.files import (
    MALFORMED,
    ingest,
    observed_write,
    read_table,
    with_audit,
    write_table,
)
from crease.sources.tables import Folder, latest

STAGES = ("bronze", "silver", "gold", "reports")


@dataclass(frozen=True)
class Layout:
    """Where each layer lives.  ``root`` must be storage every executor sees."""

    root: str
    matches_source: str | None = None
    deliveries_source: str | None = None
    source_format: str = "csv"
    table_format: str = "parquet"
    thresholds: Thresholds = field(default_factory=Thresholds)
    # independent tables of one stage written concurrently (separate Spark jobs)
    concurrency: int = 4
    # silver tables in so many buckets by match: gold's joins and totals per match then
    # need no shuffle.  None: silver matches are partitioned by season instead
    match_buckets: int | None = None

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"


def read(spark: SparkSession, layout: Layout, layer: str, table: str,
         number: int | None = None) -> DataFrame:
    return read_table(spark, layout.path(layer, table), layout.table_format, number)


# season-bounded reads of these tables open their seasons' folders only
PARTITIONS = {("silver", "matches"): ["season"], ("gold", "match_summary"): ["season"]}
# the match of a row, by which these are bucketed on demand
MATCH = {("silver", "matches"): "id", ("silver", "deliveries"): "match_id"}


def write(df: DataFrame, layout: Layout, layer: str, table: str, audit: str,
          made_from: dict[str, int] | None = None) -> int:
    key = MATCH.get((layer, table)) if layout.match_buckets else None
    return write_table(with_audit(df, audit), layout.path(layer, table), layout.table_format,
                       partition_by=PARTITIONS.get((layer, table)),
                       buckets=[layout.match_buckets, key] if key else (), made_from=made_from)


def write_all(layout: Layout, jobs: dict[str, Callable]) -> dict:
    """Run a stage's independent table writes as concurrent Spark jobs."""
    return run_together(jobs, layout.concurrency)


def run_bronze(spark: SparkSession, layout: Layout, mode: str = "overwrite") -> dict[str, int]:
    """Raw files to bronze; ``append`` takes the sources that are named, as new parts."""
    if mode == "overwrite" and not (layout.matches_source and layout.deliveries_source):
        raise ValueError("bronze needs matches_source and deliveries_source")
    schemas = {"matches": (MATCHES_SCHEMA, MATCHES_REQUIRED),
               "deliveries": (DELIVERIES_SCHEMA, DELIVERIES_REQUIRED)}
    sources = {t: s for t, s in (("matches", layout.matches_source),
                                 ("deliveries", layout.deliveries_source)) if s}

    def load(table: str) -> dict[str, int]:
        schema, required = schemas[table] if layout.source_format == "csv" else (None, None)
        raw = ingest(spark, sources[table], schema, layout.source_format, required)
        return observed_write(with_audit(raw, "bronze"), layout.path("bronze", table),
                              layout.table_format, mode)

    done = write_all(layout, {table: (lambda table=table: load(table)) for table in sources})
    counts = {table: found["rows"] for table, found in done.items()}
    return counts | {f"{table}_malformed": found["malformed"] for table, found in done.items()
                     if "malformed" in found}


SILVER = {"matches": silver.clean_matches, "deliveries": silver.enrich_deliveries}


def version(spark: SparkSession, layout: Layout, layer: str, table: str) -> int | None:
    """The number of a table's latest version; None for a table without commits."""
    found = latest(Folder(spark, layout.path(layer, table)))
    return found.number if found else None


def _made_from(**numbers: int | None) -> dict[str, int]:
    return {name: n for name, n in numbers.items() if n is not None}


def run_silver(spark: SparkSession, layout: Layout) -> dict[str, int]:
    def build(table: str) -> int:
        number = version(spark, layout, "bronze", table)
        raw = read(spark, layout, "bronze", table, number).drop(MALFORMED)
        if layout.match_buckets:
            # the one shuffle: by match, which is enough for the dedup and is what
            # the buckets ask for
            raw = raw.repartition(layout.match_buckets, MATCH["silver", table])
        return write(SILVER[table](raw), layout, "silver", table, "silver",
                     _made_from(bronze=number))

    return write_all(layout, {table: (lambda table=table: build(table)) for table in SILVER})


def gold_builders(spark: SparkSession, layout: Layout, numbers: dict[str, int | None]
                  ) -> dict[str, Callable]:
    """Jobs that write the gold tables from the silver versions in ``numbers``."""
    matches = read(spark, layout, "silver", "matches", numbers["matches"])
    deliveries = read(spark, layout, "silver", "deliveries", numbers["deliveries"])
    t = layout.thresholds

    def save(name: str, df: DataFrame, *made_from: str) -> int:
        return write(df, layout, "gold", name, "gold",
                     _made_from(**{n: numbers[n] for n in made_from}))

    def leaderboards() -> dict[str, int]:
        # one pass over the balls for both; each ranks and writes on its own
        bat, bowl = gold.boards(deliveries, t.min_matches_batsman, t.min_matches_bowler,
                                t.min_wickets_bowler)
        return write_all(layout, {
            "batsman_stats": lambda: save("batsman_stats", gold.rank_batting(bat), "deliveries"),
            "bowler_stats": lambda: save("bowler_stats", gold.rank_bowling(bowl), "deliveries")})

    return {
        "leaderboards": leaderboards,
        "team_season_wins": lambda: save("team_season_wins",
                                         gold.team_season_wins(matches, t.rolling_seasons),
                                         "matches"),
        "match_summary": lambda: save("match_summary", gold.match_summary(matches, deliveries),
                                      "matches", "deliveries")}


def run_gold(spark: SparkSession, layout: Layout) -> dict[str, int]:
    numbers = {t: version(spark, layout, "silver", t) for t in SILVER}
    done = write_all(layout, gold_builders(spark, layout, numbers))
    return done.pop("leaderboards") | done


def report_tables(batsman: DataFrame, bowler: DataFrame, team: DataFrame, summary: DataFrame,
                  t: Thresholds) -> dict[str, DataFrame]:
    return {
        "q1_top_scorers": reports.top_scorers(batsman, t.top_n),
        "q2_best_economy": reports.best_economy(bowler, t.top_n),
        "q3_team_form": reports.recent_team_form(team, t.recent_seasons),
        "q4_toss_rate": reports.toss_decision_rate(summary),
        "q5_top_venues": reports.top_venues(summary, t.top_venues, t.min_venue_matches),
        "q6_all_rounders": reports.all_rounders(batsman, bowler, t.all_rounder_runs,
                                                t.all_rounder_wickets),
        "top_wicket_takers": reports.top_wicket_takers(bowler, t.top_n),
        "team_total_wins": reports.team_total_wins(team),
    }


def run_reports(spark: SparkSession, layout: Layout) -> dict[str, int]:
    tables = {name: read(spark, layout, "gold", name)
              for name in ("batsman_stats", "bowler_stats", "team_season_wins", "match_summary")}
    out = report_tables(tables["batsman_stats"], tables["bowler_stats"],
                        tables["team_season_wins"], tables["match_summary"], layout.thresholds)
    return write_all(layout, {
        name: (lambda name=name, df=df: write_table(df, layout.path("reports", name),
                                                    layout.table_format))
        for name, df in out.items()})


_RUNNERS = {"bronze": run_bronze, "silver": run_silver, "gold": run_gold,
            "reports": run_reports}


def run_stage(spark: SparkSession, layout: Layout, stage: str) -> dict[str, int]:
    """Run one stage; returns rows written per table."""
    if stage not in _RUNNERS:
        raise ValueError(f"unknown stage {stage!r}; choose from {STAGES}")
    return _RUNNERS[stage](spark, layout)


def run_pipeline(spark: SparkSession, layout: Layout,
                 stages: Iterable[str] = STAGES) -> dict[str, dict[str, int]]:
    """Run ``stages`` in order; returns rows written per stage and table."""
    return {stage: run_stage(spark, layout, stage) for stage in stages}
