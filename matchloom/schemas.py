"""Fixed names and schemas of the match telemetry tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TEAMS = ("Team0", "Team1")
TEAM_SIZE = 6

# The objective names and their order.
OBJECTIVES = (
    "Core",
    "Tier1Lane1",
    "Tier1Lane3",
    "Tier1Lane4",
    "Tier2Lane1",
    "Tier2Lane3",
    "Tier2Lane4",
    "BarrackBossLane1",
    "BarrackBossLane3",
    "BarrackBossLane4",
    "Titan",
    "TitanShieldGenerator1",
    "TitanShieldGenerator2",
)

# The hero names a game state may use.
HEROES = (
    "Infernus", "Seven", "Vindicta", "Lady Geist", "Abrams", "Wraith", "McGinnis", "Paradox",
    "Dynamo", "Kelvin", "Haze", "Holliday", "Bebop", "Calico", "Grey Talon", "Mo & Krill",
    "Shiv", "Ivy", "Warden", "Yamato", "Lash", "Viscous", "Pocket", "Mirage",
    "Vyper", "Sinclair", "Mina", "Drifter", "Victor", "Paige", "The Doorman", "Billy",
)

_longs = T.ArrayType(T.LongType())
_strings = T.ArrayType(T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name.replace("__", "."), kind) for name, kind in fields.items()])


MATCH_INFO = _struct(
    match_id=T.LongType(),
    start_time=T.TimestampType(),
    duration_s=T.LongType(),
    winning_team=T.StringType(),
    is_high_skill_range_parties=T.BooleanType(),
    low_pri_pool=T.BooleanType(),
    new_player_pool=T.BooleanType(),
    rewards_eligible=T.BooleanType(),
    not_scored=T.BooleanType(),
    average_badge_team0=T.IntegerType(),
    average_badge_team1=T.IntegerType(),
    objectives__destroyed_time_s=_longs,
    objectives__team_objective=_strings,
    objectives__team=_strings,
)

MATCH_PLAYER = _struct(
    match_id=T.LongType(),
    account_id=T.LongType(),
    team=T.StringType(),
    hero_id=T.IntegerType(),
    net_worth=T.LongType(),
    ability_points=T.LongType(),
    player_level=T.LongType(),
    abandon_match_time_s=T.LongType(),
    stats__time_stamp_s=_longs,
    stats__net_worth=_longs,
    stats__ability_points=_longs,
    stats__level=_longs,
)

# Columns of the info rows that only the filter reads.
FILTER_ONLY = (
    "start_time",
    "is_high_skill_range_parties",
    "low_pri_pool",
    "new_player_pool",
    "rewards_eligible",
    "not_scored",
    "average_badge_team0",
    "average_badge_team1",
)

# Output name of each series column and the list column it comes from.
PLAYER_SERIES = {
    "timestamp_s": "stats.time_stamp_s",
    "net_worth": "stats.net_worth",
    "ability_points": "stats.ability_points",
    "level": "stats.level",
}
OBJECTIVE_LISTS = {
    "destroyed_time": "objectives.destroyed_time_s",
    "obj_name": "objectives.team_objective",
    "team": "objectives.team",
}

MATCH_JSON = _struct(
    match_info=_struct(
        players=T.ArrayType(
            _struct(
                team=T.IntegerType(),
                stats=T.ArrayType(_struct(time_stamp_s=T.StringType(), net_worth=T.LongType())),
            )
        )
    )
)

_side = _struct(
    players=T.ArrayType(
        _struct(
            hero=T.StringType(),
            net_worth=T.LongType(),
            ability_points=T.LongType(),
            level=T.LongType(),
        )
    ),
    lost_objectives=T.MapType(T.StringType(), T.BooleanType()),
)
GAME_STATE = _struct(timestamp=T.LongType(), team0=_side, team1=_side)

TRAIN_LOG = _struct(
    epoch=T.IntegerType(),
    train_loss=T.DoubleType(),
    train_acc=T.DoubleType(),
    val_loss=T.DoubleType(),
    val_acc=T.DoubleType(),
)


def flag_name(team: int, objective: str) -> str:
    """Name of the 0/1 column that says team ``team`` has lost ``objective``."""
    return f"team{team}_{objective}"


FLAGS = tuple(flag_name(t, o) for t in (0, 1) for o in OBJECTIVES)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
