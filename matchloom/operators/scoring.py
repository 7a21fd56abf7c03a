"""Game states: flattening, checking, editing and scoring.

A state row has ``match_id`` and the fields of ``schemas.GAME_STATE``. Everything here is a projection
of one row, so it runs on streams as well.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.operators.features import feature_vector
from matchloom.operators.models import with_probability
from matchloom.operators.normalize import Params
from matchloom.schemas import HEROES, OBJECTIVES, TEAM_SIZE, flag_name

SIDES = ("team0", "team1")
PLAYER_FIELDS = ("hero", "net_worth", "ability_points", "level")


class StateTables(NamedTuple):
    info_timestamp: DataFrame
    player_general: DataFrame
    player_timestamp: DataFrame


def _lost(side: str, objective: str) -> Column:
    return F.coalesce(F.try_element_at(F.col(f"{side}.lost_objectives"), F.lit(objective)), F.lit(False))


def _all_players() -> Column:
    return F.concat(*[F.col(f"{s}.players") for s in SIDES])


def _total_gold() -> Column:
    worth = F.transform(_all_players(), lambda p: p["net_worth"].cast("bigint"))
    return F.aggregate(worth, F.lit(0).cast("bigint"), lambda total, one: total + one)


def _flags() -> list[Column]:
    return [
        _lost(side, o).cast("int").alias(flag_name(t, o)) for t, side in enumerate(SIDES) for o in OBJECTIVES
    ]


def flatten_game_state(states: DataFrame, keys: list[str] | None = None) -> StateTables:
    """The stage tables of game states; accounts are the list positions, 1-6 and 7-12.

    ``keys`` name the columns that identify a state besides its time.
    """
    keys = keys or ["match_id"]

    def numbered(side: str, first: int, team: str) -> Column:
        return F.transform(
            F.col(f"{side}.players"),
            lambda p, i: F.struct((i + first).cast("bigint").alias("account_id"), F.lit(team).alias("team"), *[
                p[f].alias(f) for f in PLAYER_FIELDS
            ]),
        )

    players = states.select(
        *keys,
        F.col("timestamp").alias("timestamp_s"),
        F.inline(F.concat(numbered("team0", 1, "Team0"), numbered("team1", 1 + TEAM_SIZE, "Team1"))),
    )
    return StateTables(
        info_timestamp=states.select(*keys, "timestamp", _total_gold().alias("total_gold"), *_flags()),
        player_general=players.select(*keys, "account_id", "team", F.col("hero").alias("hero_name")),
        player_timestamp=players.select(
            *keys, "account_id", "timestamp_s", "net_worth", "ability_points", "level"
        ),
    )


def default_objectives(states: DataFrame) -> DataFrame:
    """Give every side all objectives in fixed order, missing ones as not lost."""
    names = F.array(*[F.lit(o) for o in OBJECTIVES])

    def whole(side: str) -> Column:
        values = F.array(*[_lost(side, o) for o in OBJECTIVES])
        return F.col(side).withField("lost_objectives", F.map_from_arrays(names, values))

    return states.withColumns({s: whole(s) for s in SIDES})


def validate(states: DataFrame, heroes: list[str] | tuple[str, ...] = HEROES) -> DataFrame:
    """Add ``reasons``, the sorted list of broken rules; an accepted state has none."""

    def broken(rule: Column, reason: str) -> Column:
        return F.when(F.coalesce(rule, F.lit(True)), F.lit(reason))

    def below_zero(field: str):
        return lambda p: F.coalesce(p[field] < 0, F.lit(True))

    checks = [broken(F.col("timestamp") < 0, "timestamp")]
    for side in SIDES:
        players = F.col(f"{side}.players")
        checks.append(broken(F.size(players) != TEAM_SIZE, f"{side}: player count"))
        checks.append(
            broken(F.exists(players, lambda p: ~F.coalesce(p["hero"].isin(list(heroes)), F.lit(False))), f"{side}: hero")
        )
        checks += [broken(F.exists(players, below_zero(f)), f"{side}: {f}") for f in PLAYER_FIELDS[1:]]
        named = F.coalesce(F.map_keys(f"{side}.lost_objectives"), F.array().cast("array<string>"))
        checks.append(broken(F.exists(named, lambda n: ~n.isin(list(OBJECTIVES))), f"{side}: objective"))
    return states.withColumn("reasons", F.array_sort(F.array_compact(F.array(*checks))))


def accepted(checked: DataFrame) -> DataFrame:
    """The valid states, with all objectives filled in."""
    return default_objectives(checked.where(F.size("reasons") == 0).drop("reasons"))


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") > 0)


def _changed_player(position: int, changes: dict):
    def change(p: Column, i: Column) -> Column:
        new = F.struct(*[(F.lit(changes[f]) if f in changes else p[f]).alias(f) for f in PLAYER_FIELDS])
        return F.when(i == position, new).otherwise(p)

    return change


def _changed_objective(objective: str, destroyed: bool):
    return lambda name, was: F.when(name == objective, F.lit(destroyed)).otherwise(was)


def _edited_side(side: str, edits: list[tuple[Column, dict]]) -> Column:
    """The side after the edits whose condition holds."""
    players, lost = F.col(f"{side}.players"), F.col(f"{side}.lost_objectives")
    for applies, edit in edits:
        if "objective" in edit:
            new = F.transform_values(lost, _changed_objective(edit["objective"], bool(edit["destroyed"])))
            lost = F.when(applies, new).otherwise(lost)
        else:
            new = F.transform(players, _changed_player(edit["player"], edit["changes"]))
            players = F.when(applies, new).otherwise(players)
    return F.col(side).withField("players", players).withField("lost_objectives", lost)


def _check_edit(edit: dict) -> None:
    if edit.get("side") not in SIDES:
        raise ValueError(f"an edit names one of {SIDES}")
    if "objective" in edit:
        if edit["objective"] not in OBJECTIVES:
            raise ValueError(f"unknown objective {edit['objective']}")
    elif not 0 <= edit["player"] < TEAM_SIZE or not set(edit["changes"]) <= set(PLAYER_FIELDS):
        raise ValueError("a player edit names a list position and known fields")


def update_player(states: DataFrame, side: str, player: int, **changes) -> DataFrame:
    edit = {"side": side, "player": player, "changes": changes}
    _check_edit(edit)
    return states.withColumn(side, _edited_side(side, [(F.lit(True), edit)]))


def update_objective(states: DataFrame, side: str, objective: str, destroyed: bool) -> DataFrame:
    edit = {"side": side, "objective": objective, "destroyed": destroyed}
    _check_edit(edit)
    return default_objectives(states).withColumn(side, _edited_side(side, [(F.lit(True), edit)]))


def what_if(states: DataFrame, edits: dict[str, dict]) -> DataFrame:
    """Each state once per named edit, with that edit applied (column ``edit``).

    An edit is ``{"side", "player", "changes"}`` or ``{"side", "objective", "destroyed"}``. The edits are
    written by hand, so the copies are made inside the row.
    """
    for edit in edits.values():
        _check_edit(edit)
    copies = default_objectives(states).withColumn("edit", F.explode(F.array(*[F.lit(n) for n in edits])))
    chosen = [(F.col("edit") == name, edit) for name, edit in edits.items()]
    return copies.withColumns({s: _edited_side(s, [(a, e) for a, e in chosen if e["side"] == s]) for s in SIDES})


def state_vectors(states: DataFrame, params: Params, heroes: list[str]) -> DataFrame:
    """Add ``features``: the same values in the same order as a training row, built without a join."""
    wrong_size = F.lit(False)
    for side in SIDES:
        wrong_size = wrong_size | F.coalesce(F.size(f"{side}.players") != TEAM_SIZE, F.lit(True))

    def slot(p: Column) -> Column:
        ratio = F.try_divide(p["net_worth"].cast("double"), F.col("_gold").cast("double"))
        return F.struct(p["hero"].alias("hero"), p["ability_points"].alias("ability_points"),
                        p["level"].alias("level"), ratio.alias("net_worth_ratio"))

    players = F.when(wrong_size, F.raise_error(F.lit("a team has six players"))).otherwise(_all_players())
    vector = feature_vector(
        F.col("timestamp"), F.col("_gold"), _flags(), F.col("_slots"), heroes, params, "hero"
    )
    return (
        states.withColumn("_gold", _total_gold())
        .withColumn("_slots", F.transform(players, slot))
        .withColumn("features", vector)
        .drop("_gold", "_slots")
    )


def score(model: Model, states: DataFrame, params: Params, heroes: list[str]) -> DataFrame:
    """Add ``score``, the probability that Team1 wins."""
    return with_probability(model.transform(state_vectors(states, params, heroes)))
