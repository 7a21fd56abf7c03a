"""Lookups and attachments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIM_ROWS = 10_000


def small_dim(dim: DataFrame, max_rows: int = DIM_ROWS) -> DataFrame:
    """Mark a dimension for broadcast after checking its size; a larger one stays as it is."""
    return F.broadcast(dim) if dim.limit(max_rows + 1).count() <= max_rows else dim


def lookup_inner(
    df: DataFrame, dim: DataFrame, key: str, id_column: str, name_column: str, as_: str
) -> DataFrame:
    """Replace the id in ``key`` by its name; rows with an id the dimension lacks are dropped."""
    names = small_dim(dim.select(F.col(id_column).alias(key), F.col(name_column).alias(as_)))
    rest = [c for c in df.columns if c != key]
    return df.join(names, key).select(*[F.col(f"`{c}`") for c in rest], as_)


def replace_hero_ids_with_names(player: DataFrame, heroes: DataFrame) -> DataFrame:
    return lookup_inner(player, heroes, "hero_id", "id", "name", "hero_name")


def join_inner(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right, on)


def join_left(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right, on, "left")


def attach_winner(df: DataFrame, info: DataFrame, how: str = "inner") -> DataFrame:
    """Add ``winning_team`` by match."""
    return df.join(info.select("match_id", "winning_team"), "match_id", how)


def attach_team(player_ts: DataFrame, general: DataFrame, how: str = "left") -> DataFrame:
    """Add ``team`` by match and account, unless the rows already carry it."""
    if "team" in player_ts.columns:
        return player_ts
    teams = general.select("match_id", "account_id", "team").distinct()
    return player_ts.join(teams, ["match_id", "account_id"], how)
