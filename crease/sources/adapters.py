"""Shape the benchmark's TPC-H-like tables into raw matches and deliveries.

The projection rules are the fixture definitions the oracle SQL also uses
(see ``crease.plans.oracle``).  They only carry the columns Silver, Gold and
the reports read.  Each adapter scans its table once: the duplicated rows the
fixture adds (a UNION ALL of a filtered second scan) are produced by
exploding a copy index instead, which reads the table a single time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _label(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def _copies(duplicate: Column) -> Column:
    """0 for the original row, plus 1 for the extra copy where ``duplicate``."""
    return F.explode(F.when(duplicate, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))


def matches_from_orders(orders: DataFrame) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    o = orders.select(key, cust, "o_orderstatus", "o_orderdate", "o_orderpriority",
                      _copies(key % 20 == 5).alias("copy"))
    status = F.when(F.col("copy") == 1, F.lit("F")).otherwise(F.col("o_orderstatus"))
    priority = F.col("o_orderpriority")
    home = cust % 8
    away = (cust + 1 + key % 7) % 8
    team1, team2 = _label("TEAM_", home), _label("TEAM_", away)
    return o.select(
        key.cast("bigint").alias("id"),
        F.year("o_orderdate").cast("int").alias("season"),
        _label("CITY_", cust % 25).alias("city"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.when(key % 30 == 29, "Final").when(key % 30 == 28, "Qualifier")
         .when(key % 30 == 27, "Eliminator").otherwise("League").alias("match_type"),
        _label("VENUE_", cust % 25).alias("venue"),
        team1.alias("team1"),
        team2.alias("team2"),
        F.when(key % 2 == 0, team1).otherwise(team2).alias("toss_winner"),
        F.when(key % 5 < 2, "bat").otherwise("field").alias("toss_decision"),
        F.when((priority == "5-LOW") | (key % 9 == 0), F.lit(None).cast("string"))
         .when(key % 9 == 1, "")
         .when(status == "F", team1)
         .otherwise(team2).alias("winner"),
        F.when(priority == "5-LOW", "no result")
         .when(priority == "4-NOT SPECIFIED", "tie").otherwise("normal").alias("result"),
        _label("PLAYER_", cust % 48).alias("player_of_match"),
    )


def deliveries_from_lineitem(lineitem: DataFrame) -> DataFrame:
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    l = lineitem.select("l_orderkey", part, supp, "l_linenumber", "l_quantity", "l_discount",
                        "l_tax", _copies(part % 10 == 3).alias("copy"))
    quantity = F.col("l_quantity") + F.col("copy")
    tax = F.round(F.col("l_tax") * 100).cast("int")
    q = quantity.cast("int") % 10
    runs = (F.when(tax == 0, 0)
             .when(q < 4, 0).when(q < 6, 1).when(q == 6, 2).when(q == 7, 3).when(q == 8, 4)
             .otherwise(6))
    striker = _label("PLAYER_", part % 80)
    d = l.select(
        F.col("l_orderkey").cast("bigint").alias("match_id"),
        (1 + supp % 2).cast("int").alias("inning"),
        (1 + F.col("l_linenumber")).cast("int").alias("over"),
        (1 + part % 6).cast("int").alias("ball"),
        F.when(part % 97 != 0, striker).alias("batsman"),
        F.when(supp % 50 != 49, _label("PLAYER_", 60 + supp % 32)).alias("bowler"),
        (tax == 0).cast("int").alias("wide_runs"),
        (tax == 1).cast("int").alias("noball_runs"),
        runs.cast("int").alias("batsman_runs"),
        tax.isin(0, 1).cast("int").alias("extra_runs"),
        F.when(F.round(F.col("l_discount") * 100).cast("int") == 7, striker)
         .alias("player_dismissed"),
    )
    return d.withColumn("total_runs", F.col("batsman_runs") + F.col("extra_runs"))
