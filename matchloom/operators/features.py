"""Slot numbering and the wide feature row per (match, time stamp)."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.functions.arrays import name_sql, quoted
from matchloom.operators.encode import known_category, one_hot_sql
from matchloom.operators.normalize import PLAYER_FEATURES, Params, collect_params, zscore, zscore_sql
from matchloom.operators.ordered import bucket_spans, stored_ranges
from matchloom.operators.series import explode_series, fallen_flags, lost_at_in_row
from matchloom.schemas import FLAGS, OBJECTIVE_LISTS, TEAM_SIZE

SLOT_KEYS = ["match_id", "timestamp_s", "team"]
ROW_KEYS = ["match_id", "timestamp"]
PLACES = 2 * TEAM_SIZE


def slot_numbers(df: DataFrame, slots: int | None = None) -> DataFrame:
    """Number the players of a team at one match and time by account id.

    With ``slots`` only the first numbers are kept, and Spark drops the rest before the shuffle.
    Without it every row is numbered: the rows are written by ranges of group and account, numbered within a range, and
    shifted by what the same group has in the ranges before, so a very large group is not one task.
    """
    if slots is not None:
        one_team = Window.partitionBy(*SLOT_KEYS).orderBy("account_id")
        return df.withColumn("player_num", F.row_number().over(one_team)).where(F.col("player_num") <= slots)
    bucketed = stored_ranges(df, *SLOT_KEYS, "account_id")
    keys = [*SLOT_KEYS, "_bucket"]
    spans = bucket_spans(bucketed, SLOT_KEYS, F.lit(1)).select(*keys, "_start")
    same = [bucketed[k].eqNullSafe(spans[k]) for k in keys]
    in_bucket = Window.partitionBy(*[bucketed[k] for k in keys]).orderBy(bucketed["account_id"])
    return bucketed.join(spans, same).select(
        *[bucketed[c] for c in df.columns],
        (F.col("_start") + F.row_number().over(in_bucket)).cast("int").alias("player_num"),
    )


def _in_slot(slots: int, teams: tuple) -> Column:
    return F.coalesce((F.col("player_num") <= slots) & F.col("team").isin(list(teams)), F.lit(False))


def slot_rows(
    numbered: DataFrame,
    value_columns: list[str],
    slots: int = TEAM_SIZE,
    teams: tuple = (0, 1),
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per match and time with a struct ``p{n}`` of the value columns for all slots of all teams.

    A (match, time) that lacks a slot gives no row. One aggregation does the work of a join per slot;
    ``carry`` adds further aggregates over all rows of the group, those beyond the slots included.
    """
    places = [(team, num) for team in teams for num in range(1, slots + 1)]
    cells = []
    for n, (team, num) in enumerate(places, start=1):
        here = (F.col("team") == team) & (F.col("player_num") == num)
        cells.append(F.max(F.when(here, F.col("_slot"))).alias(f"p{n}"))
    rows = numbered if carry else numbered.where(_in_slot(slots, teams))
    return (
        rows.withColumn("_slot", F.struct(*value_columns))
        .groupBy("match_id", F.col("timestamp_s").alias("timestamp"))
        .agg(
            F.count_if(_in_slot(slots, teams)).alias("_filled"),
            *[c.alias(n) for n, c in (carry or {}).items()],
            *cells,
        )
        .where(F.col("_filled") == len(places))
        .drop("_filled")
    )


def slot_wide(numbered: DataFrame, value_columns: list[str], slots: int = TEAM_SIZE, teams: tuple = (0, 1)) -> DataFrame:
    """``slot_rows`` with the structs spread to columns ``p{n}_{column}``."""
    spread = [
        f"p{n}.{name_sql(c)} AS {name_sql(f'p{n}_{c}')}"
        for n in range(1, slots * len(teams) + 1)
        for c in value_columns
    ]
    return slot_rows(numbered, value_columns, slots, teams).selectExpr(*ROW_KEYS, *spread)


def feature_columns(heroes: list[str]) -> list[str]:
    """Names of the features in order: clock, gold, flags, then the slots."""
    names = ["timestamp", "total_gold", *FLAGS]
    for n in range(1, PLACES + 1):
        names += [f"p{n}_hero_name_{h}" for h in heroes]
        names += [f"p{n}_{c}" for c in PLAYER_FEATURES]
    return names


def slot_columns(heroes: list[str], params: Params | None = None) -> list[str]:
    """SQL of all slot features over the columns ``p{n}_{column}``, scaled where ``params`` are given."""
    columns = []
    for n in range(1, PLACES + 1):
        columns += one_hot_sql(f"p{n}_hero_name", heroes)
        columns += [
            f"{zscore_sql(f'p{n}_{f}', f, params) if params else f'p{n}_{f}'} AS p{n}_{f}" for f in PLAYER_FEATURES
        ]
    return columns


def known_heroes(wide: DataFrame, heroes: list[str]) -> DataFrame:
    """Stop the job at a hero the list lacks."""
    names = [f"p{n}_hero_name" for n in range(1, PLACES + 1)]
    return wide.withColumns({name: known_category(name, heroes) for name in names})


def assemble_features(
    info_ts: DataFrame,
    player_general: DataFrame,
    player_ts: DataFrame,
    heroes: list[str],
    info_general: DataFrame | None = None,
) -> DataFrame:
    """Wide rows from encoded, normalised stage tables (teams 0/1), label last when it is given.

    ``match_id`` stays in front of the features.
    """
    placed = player_ts.join(
        player_general.select("match_id", "account_id", "team", "hero_name"), ["match_id", "account_id"]
    )
    wide = slot_wide(slot_numbers(placed, TEAM_SIZE), ["hero_name", *PLAYER_FEATURES])
    rows = known_heroes(info_ts.join(wide, ROW_KEYS), heroes)
    label = []
    if info_general is not None:
        rows = rows.join(info_general.select("match_id", "winning_team"), "match_id")
        label = ["winning_team"]
    return rows.selectExpr("match_id", "timestamp", "total_gold", *FLAGS, *slot_columns(heroes), *label)


def co_locate(player: DataFrame) -> DataFrame:
    """Bring the player rows of a match together once, before their lists are unnested.

    Filtered matches have twelve players, so no match is large; every later step by (match, time) then
    runs where the rows are.
    """
    return player.repartition("match_id")


def sample_rows(player: DataFrame) -> DataFrame:
    """Samples of filtered players with team and slot number.

    ``player`` comes from ``co_locate`` or a bucketed table; numbering adds a sort but no shuffle.
    """
    rows = explode_series(player, ["match_id", "account_id", "team", "hero_name"])
    in_team = Window.partitionBy("match_id", "timestamp_s", "team").orderBy("account_id")
    return rows.withColumn("team", (F.col("team") == "Team1").cast("int")).withColumn(
        "player_num", F.row_number().over(in_team)
    )


def match_rows(player: DataFrame, info: DataFrame) -> DataFrame:
    """Unscaled rows per (match, time) of filtered, co-located players: gold, flags, slots and label.

    The info table joins by match alone: its objectives are reduced within the row, and the gold of a
    time stamp comes out of the slot aggregate.
    """
    slots = slot_rows(
        sample_rows(player),
        ["hero_name", "ability_points", "level", "net_worth"],
        carry={"total_gold": F.sum("net_worth").cast("bigint")},
    )
    listed = [quoted(c) for c in OBJECTIVE_LISTS.values()]
    falls = lost_at_in_row(info.select("match_id", "winning_team", *listed))
    return slots.join(falls, "match_id").selectExpr(
        *ROW_KEYS,
        "total_gold",
        *fallen_flags("timestamp"),
        *[
            f"struct(p{n}.hero_name, p{n}.ability_points, p{n}.level, "
            f"try_divide(CAST(p{n}.net_worth AS DOUBLE), CAST(total_gold AS DOUBLE)) AS net_worth_ratio) AS p{n}"
            for n in range(1, PLACES + 1)
        ],
        "CAST(winning_team = 'Team1' AS INT) AS winning_team",
    )


def fit_wide(player: DataFrame, info: DataFrame) -> Params:
    """All five standardisation parameters in one pass over the co-located players.

    Total gold counts each (match, time) once, the player features count each sample, and the clock
    counts the (match, time) pairs that fill all twelve slots and have an info row. The samples of a
    (match, time) are reduced to counts, sums and sums of squares first, so numbering is the only sort.
    """

    def moments(name: str, value: Column) -> list[Column]:
        value = value.cast("double")
        return [
            F.count(value).alias(f"{name}_n"), F.sum(value).alias(f"{name}_s"), F.sum(value * value).alias(f"{name}_q"),
        ]

    worth = F.col("net_worth")
    at_time = (
        sample_rows(player)
        .groupBy("match_id", "timestamp_s")
        .agg(
            F.sum(worth).alias("total_gold"),
            F.count_if(_in_slot(TEAM_SIZE, (0, 1))).alias("_filled"),
            *[m for f in ("ability_points", "level", "net_worth") for m in moments(f, F.col(f))],
        )
        .join(info.select("match_id", F.lit(True).alias("_known")), "match_id", "left")
    )
    # a ratio is worth / total_gold, so its sums follow from those of the worth
    gold = F.nullif(F.col("total_gold").cast("double"), F.lit(0.0))
    at_time = at_time.withColumns(
        {
            "net_worth_ratio_n": F.when(gold.isNotNull(), F.col("net_worth_n")).otherwise(F.lit(0)),
            "net_worth_ratio_s": F.col("net_worth_s") / gold,
            "net_worth_ratio_q": F.col("net_worth_q") / (gold * gold),
        }
    )

    def pooled(name: str) -> tuple[Column, Column]:
        n = F.sum(f"{name}_n").cast("double")
        mean = F.try_divide(F.sum(f"{name}_s"), n)
        spread = F.try_divide(F.sum(f"{name}_q"), n) - mean * mean
        return mean, F.sqrt(F.greatest(spread, F.lit(0.0)))

    full = (F.col("_filled") == PLACES) & F.col("_known")
    clock = F.when(full, F.col("timestamp_s"))
    fitted = {
        "total_gold": (F.avg("total_gold").cast("double"), F.stddev_pop("total_gold")),
        **{f: pooled(f) for f in PLAYER_FEATURES},
        "timestamp": (F.avg(clock).cast("double"), F.stddev_pop(clock)),
    }
    wide = at_time.agg(
        *[
            F.struct(F.lit(f).alias("feature"), mean.alias("mean"), std.alias("std")).alias(f)
            for f, (mean, std) in fitted.items()
        ]
    )
    return collect_params(wide.select(F.inline(F.array(*[F.col(f) for f in fitted]))))


def feature_matrix(
    player: DataFrame, info: DataFrame, heroes: list[str], params: Params | None = None, placed: bool = False
) -> DataFrame:
    """The training table: scaled features of filtered players (with hero names), label last.

    ``match_id`` and the raw time stamp (``time_s``) stay in front so that splits by match remain possible. With ``placed``
    the players come from a table in buckets of match ids and stay where they are.
    """
    player = player if placed else co_locate(player)
    params = params or fit_wide(player, info)
    spread = [f"p{n}.{c} AS p{n}_{c}" for n in range(1, PLACES + 1) for c in ("hero_name", *PLAYER_FEATURES)]
    wide = match_rows(player, info).selectExpr(*ROW_KEYS, "total_gold", *FLAGS, *spread, "winning_team")
    return known_heroes(wide, heroes).selectExpr(
        "match_id",
        "timestamp AS time_s",
        f"{zscore_sql('timestamp', 'timestamp', params)} AS timestamp",
        f"{zscore_sql('total_gold', 'total_gold', params)} AS total_gold",
        *FLAGS,
        *slot_columns(heroes, params),
        "winning_team",
    )


def feature_vectors(player: DataFrame, info: DataFrame, heroes: list[str], params: Params, placed: bool = False) -> DataFrame:
    """The training table as key, dense vector and label, without spelling out the single columns.

    The vectors equal ``to_vector`` of ``feature_matrix``; ``placed`` as there.
    """
    rows = match_rows(player if placed else co_locate(player), info)
    slots = F.array(*[F.col(f"p{n}") for n in range(1, PLACES + 1)])
    vector = feature_vector(
        F.col("timestamp"), F.col("total_gold"), [F.col(f) for f in FLAGS], slots, heroes, params, "hero_name"
    )
    return rows.select("match_id", F.col("timestamp").alias("time_s"), vector.alias("features"), "winning_team")


def feature_vector(
    clock: Column, gold: Column, flags: list[Column], slots: Column, heroes: list[str], params: Params, hero: str
) -> Column:
    """The feature values in order as a vector; ``slots`` is an array of structs with the hero in ``hero``.

    An unknown hero, or a missing value, stops the job.
    """
    names = F.array(*[F.lit(h) for h in heroes])
    zero, one = F.lit(0.0), F.array(F.lit(1.0))

    def slot(p: Column) -> Column:
        place = F.array_position(names, p[hero]).cast("int")
        return F.concat(
            F.array_repeat(zero, place - 1),
            one,
            F.array_repeat(zero, F.lit(len(heroes)) - place),
            F.array(*[zscore(p[f], *params[f]) for f in PLAYER_FEATURES]),
        )

    head = F.array(zscore(clock, *params["timestamp"]), zscore(gold, *params["total_gold"]))
    values = F.concat(head, F.array(*[f.cast("double") for f in flags]), F.flatten(F.transform(slots, slot)))
    strange = F.exists(slots, lambda p: F.coalesce(F.array_position(names, p[hero]), F.lit(0)) == 0)

    def gap(p: Column) -> Column:
        lacks = F.lit(False)
        for f in PLAYER_FEATURES:
            lacks = lacks | zscore(p[f], *params[f]).isNull()
        return lacks

    missing = head[0].isNull() | head[1].isNull() | F.exists(slots, gap)
    return array_to_vector(
        F.when(strange, F.raise_error(F.lit("unknown hero")))
        .when(missing, F.raise_error(F.lit("a feature is missing")))
        .otherwise(values)
    )


def to_vector(df: DataFrame, features: list[str], label: str = "winning_team", keep: list[str] | None = None) -> DataFrame:
    """Dense vector column ``features`` in the order given, label last; a missing value is an error."""
    plain = {f: f"f{i}" for i, f in enumerate(features)}
    ends = [label] if label in df.columns else []
    kept = [*(keep or []), *ends]
    flat = df.selectExpr(*map(name_sql, kept), *[f"CAST({name_sql(f)} AS DOUBLE) AS {a}" for f, a in plain.items()])
    assembler = VectorAssembler(inputCols=list(plain.values()), outputCol="features", handleInvalid="error")
    return assembler.transform(flat).select(*[quoted(c) for c in keep or []], "features", *ends)
