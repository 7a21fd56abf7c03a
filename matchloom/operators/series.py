"""From list columns to rows: player series, objectives, and the four stage tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.arrays import name_sql, quoted, text_sql, without_last, zip_rows
from matchloom.functions.columns import team_number
from matchloom.schemas import FLAGS, OBJECTIVE_LISTS, OBJECTIVES, PLAYER_SERIES, flag_name


class StageTables(NamedTuple):
    info_general: DataFrame
    info_timestamp: DataFrame
    player_general: DataFrame
    player_timestamp: DataFrame


def explode_series(
    player: DataFrame,
    keys: list[str] | None = None,
    series: dict[str, str] | None = None,
    drop_last: bool = True,
) -> DataFrame:
    """One row per player and sample; the final sample of each list is cut off."""
    return zip_rows(player, keys or ["match_id", "account_id"], series or PLAYER_SERIES, drop_last)


def last_samples(player: DataFrame, keys: list[str] | None = None, series: dict[str, str] | None = None) -> DataFrame:
    """The last sample that ``explode_series`` keeps, per player row that has one: read from the lists in place."""
    lists = series or PLAYER_SERIES
    at = F.greatest(*[F.coalesce(F.size(quoted(c)), F.lit(0)) for c in lists.values()]) - 1
    kept = [F.get(without_last(quoted(c)), F.col("_at") - 1).alias(name) for name, c in lists.items()]
    return player.withColumn("_at", at).where(F.col("_at") > 0).select(*(keys or ["match_id", "account_id"]), *kept)


def explode_objectives(info: DataFrame) -> DataFrame:
    """One row per objective of a match, with the team as a number."""
    rows = zip_rows(info, ["match_id"], OBJECTIVE_LISTS)
    return rows.select("match_id", "destroyed_time", "obj_name", team_number(F.col("team")).alias("obj_team"))


def distinct_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()


def total_gold(player_ts: DataFrame) -> DataFrame:
    """Worth of all players per match and time."""
    return player_ts.groupBy("match_id", F.col("timestamp_s").alias("timestamp")).agg(
        F.sum("net_worth").cast("bigint").alias("total_gold")
    )


def conditional_max(df: DataFrame, keys: list[str], conditions: dict[str, Column]) -> DataFrame:
    """Per group, 1 where a condition holds for any row, else 0."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(c, F.lit(1)).otherwise(F.lit(0))).alias(name) for name, c in conditions.items()]
    )


def lost_at(objectives_long: DataFrame) -> DataFrame:
    """One row per match: when each objective of each team fell (NULL = it stood)."""
    falls = objectives_long.where(F.col("destroyed_time") != 0)
    return falls.groupBy("match_id").agg(
        *[
            F.expr(f"min(CASE WHEN obj_team = {team} AND obj_name = {text_sql(name)} THEN destroyed_time END)").alias(
                flag_name(team, name)
            )
            for team in (0, 1)
            for name in OBJECTIVES
        ]
    )


def lost_at_in_row(info: DataFrame) -> DataFrame:
    """``lost_at`` worked out inside each info row from its list columns, without a shuffle.

    Keeps the other columns of ``info``; every match is one info row.
    """
    times, names, teams = (quoted(c) for c in OBJECTIVE_LISTS.values())
    zipped = F.arrays_zip(times.alias("t"), names.alias("n"), teams.alias("s"))
    falls = info.withColumn("_falls", F.filter(zipped, lambda o: o["t"] != 0))
    first_falls = [
        f"array_min(transform(filter(_falls, o -> o.n = {text_sql(name)} AND o.s = 'Team{team}'), o -> o.t))"
        f" AS {name_sql(flag_name(team, name))}"
        for team in (0, 1)
        for name in OBJECTIVES
    ]
    rest = [name_sql(c) for c in info.columns if c not in OBJECTIVE_LISTS.values()]
    return falls.selectExpr(*rest, *first_falls)


def fallen_flags(clock: str) -> list[str]:
    """SQL of the 26 flags at time ``clock`` over the columns of ``lost_at``."""
    return [f"CASE WHEN {clock} >= {name_sql(f)} THEN 1 ELSE 0 END AS {name_sql(f)}" for f in FLAGS]


def objective_flags(times: DataFrame, objectives_long: DataFrame) -> DataFrame:
    """Flags per (match, timestamp): 1 once the objective has fallen; 0 where a match has none.

    A flag never goes back to 0, so the earliest fall per match decides and the rows meet 1:1
    instead of times x objectives.
    """
    rest = [c for c in times.columns if c not in FLAGS]
    falls = lost_at(objectives_long)
    return times.join(falls, "match_id", "left").selectExpr(*map(name_sql, rest), *fallen_flags("timestamp"))


def general_columns(info: DataFrame) -> DataFrame:
    return info.select("match_id", "winning_team", "duration_s")


def split_general_timestamp(info: DataFrame, player: DataFrame) -> StageTables:
    """The four stage tables of filtered matches with hero names."""
    player_timestamp = explode_series(player)
    return StageTables(
        info_general=general_columns(info),
        info_timestamp=objective_flags(total_gold(player_timestamp), explode_objectives(info)),
        player_general=player.select(
            "match_id", "account_id", "team", "hero_name", "net_worth", "ability_points", "player_level"
        ),
        player_timestamp=player_timestamp,
    )
