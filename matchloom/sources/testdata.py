"""Match telemetry derived from the test tables.

``events`` gives nested match tables: twelve users form a match, days are the samples, money is whole
cents. ``orders`` and ``lineitem`` give a large flat set of end-of-match values. The rules are fixed, so
the same tables can be written in SQL for comparison.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchloom.functions.columns import whole_div
from matchloom.schemas import OBJECTIVES


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _team(account: str) -> Column:
    return F.when(F.col(account) % 12 < 6, F.lit("Team0")).otherwise(F.lit("Team1"))


class EventMatches:
    """Raw match tables from ``events`` and ``part``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def events(self) -> DataFrame:
        return read_table(self.spark, self.sf_dir, "events").select(
            whole_div(F.col("user_id"), 12).alias("match_id"),
            F.col("user_id").alias("account_id"),
            ((F.dayofmonth("ts").cast("bigint") - 1) * 86400).alias("t"),
            "ts",
            "event_type",
            F.round(F.col("value") * 100).cast("bigint").alias("cents"),
            F.get_json_object("props", "$.k").cast("int").alias("k"),
        )

    @cached_property
    def player(self) -> DataFrame:
        """One row per account; lists have one entry per active day, so at most 31."""
        daily = self.events.groupBy("match_id", "account_id", "t").agg(
            F.sum("cents").alias("c"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("event_type") == "purchase").alias("ap"),
        )
        upto = (
            Window.partitionBy("account_id").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        running = daily.select(
            "match_id",
            "account_id",
            "t",
            *[F.sum(c).over(upto).alias(name) for c, name in (("c", "nw"), ("ap", "ap"), ("n", "lvl"))],
        )
        series = running.groupBy("account_id").agg(
            F.first("match_id").alias("match_id"), F.sort_array(F.collect_list(F.struct("t", "nw", "ap", "lvl"))).alias("s")
        )
        last = F.element_at("s", -1)
        return series.where(F.col("match_id") % 43 != 20).select(  # matches without players
            "match_id",
            "account_id",
            _team("account_id").alias("team"),
            F.when(F.col("account_id") % 150 == 96, F.lit(99))
            .otherwise((F.col("account_id") % 6).cast("int"))
            .alias("hero_id"),
            last["nw"].alias("net_worth"),
            last["ap"].alias("ability_points"),
            last["lvl"].alias("player_level"),
            F.when(F.col("account_id") % 37 == 36, F.lit(86400)).otherwise(F.lit(0)).cast("bigint").alias("abandon_match_time_s"),
            F.col("s.t").alias("stats.time_stamp_s"),
            F.col("s.nw").alias("stats.net_worth"),
            F.col("s.ap").alias("stats.ability_points"),
            F.col("s.lvl").alias("stats.level"),
        )

    @cached_property
    def info(self) -> DataFrame:
        """One row per match; at most 26 objectives each."""
        slot = F.col("k") % 13
        fallen = self.events.groupBy("match_id", _team("account_id").alias("team"), slot.alias("o")).agg(
            F.min(F.when(slot == 0, F.lit(0).cast("bigint")).otherwise(F.col("t"))).alias("d")
        )
        names = F.array(*[F.lit(o) for o in OBJECTIVES])
        lists = fallen.groupBy("match_id").agg(F.sort_array(F.collect_list(F.struct("team", "o", "d"))).alias("s"))
        spans = self.events.groupBy("match_id").agg(
            F.min("ts").alias("start_time"), (F.max("t") + 3600).alias("_span")
        )
        m = F.col("match_id")
        return spans.join(lists, "match_id", "left").select(
            "match_id",
            "start_time",
            F.when(m % 25 == 3, F.lit(400)).otherwise(F.col("_span")).cast("bigint").alias("duration_s"),
            F.when(m * 7 % 3 == 0, F.lit("Team0")).otherwise(F.lit("Team1")).alias("winning_team"),
            F.when(m % 31 == 9, F.lit(None)).when(m % 27 == 10, F.lit(95)).otherwise(101 + m % 6).cast("int").alias("average_badge_team0"),
            F.when(m % 29 == 7, F.lit(None)).otherwise(101 + F.least(F.lit(5), m % 6 + m % 4)).cast("int").alias("average_badge_team1"),
            (m % 17 == 11).alias("low_pri_pool"),
            F.when(m % 13 == 4, F.lit(None).cast("boolean")).otherwise(F.lit(False)).alias("new_player_pool"),
            (m % 23 == 5).alias("is_high_skill_range_parties"),
            F.when(m % 21 == 11, F.lit(None).cast("boolean")).otherwise(m % 22 != 13).alias("rewards_eligible"),
            (m % 19 == 12).alias("not_scored"),
            F.col("s.d").alias("objectives.destroyed_time_s"),
            F.transform("s", lambda x: names[x["o"]]).alias("objectives.team_objective"),
            F.col("s.team").alias("objectives.team"),
        )

    @cached_property
    def heroes(self) -> DataFrame:
        """The distinct part types as hero names, numbered by name (a handful of rows)."""
        types = read_table(self.spark, self.sf_dir, "part").select(F.col("p_type").alias("name")).distinct()
        number = F.row_number().over(Window.orderBy("name")) - 1
        return types.select(number.cast("int").alias("id"), "name")


class OrderMatches:
    """Final values only: an order is a match, a line is a player."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def lines(self) -> DataFrame:
        return read_table(self.spark, self.sf_dir, "lineitem")

    @cached_property
    def info(self) -> DataFrame:
        shipped = self.lines.groupBy(F.col("l_orderkey").alias("match_id")).agg(
            F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last")
        )
        orders = read_table(self.spark, self.sf_dir, "orders").select(
            F.col("o_orderkey").alias("match_id"), "o_orderdate", "o_orderstatus"
        )
        status = F.col("o_orderstatus")
        days = F.greatest(
            F.abs(F.datediff("first", "o_orderdate")), F.abs(F.datediff("last", "o_orderdate"))
        )
        return orders.join(shipped, "match_id").select(
            "match_id",
            F.when(status == "F", F.lit("Team0")).when(status == "O", F.lit("Team1")).alias("winning_team"),
            days.cast("bigint").alias("duration_s"),
        )

    @cached_property
    def player(self) -> DataFrame:
        parts = read_table(self.spark, self.sf_dir, "part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("hero_name")
        )
        return self.lines.join(parts, "l_partkey").select(
            F.col("l_orderkey").alias("match_id"),
            F.when(F.col("l_linestatus") == "F", F.lit("Team0")).otherwise(F.lit("Team1")).alias("team"),
            "hero_name",
            F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("net_worth"),
        )
