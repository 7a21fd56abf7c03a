"""Queries over slots, standardisation, the training table and game states."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.operators import encode, features, normalize, scoring, series
from matchloom.operators.joins import small_dim
from matchloom.operators.normalize import PLAYER_FEATURES
from matchloom.plans import views
from matchloom.plans.prepare import store_matches
from matchloom.plans.queries_tables import CHOSEN, samples, stage_tables
from matchloom.plans.registry import query, rounded
from matchloom.schemas import FLAGS, OBJECTIVES, TEAM_SIZE
from matchloom.session import scratch_path
from matchloom.sources import tables
from matchloom.sources.testdata import EventMatches, read_table

SLOTS = [(team, num) for team in (0, 1) for num in range(1, TEAM_SIZE + 1)]


def hero_list(spark: SparkSession, sf_dir: str) -> list[str]:
    return tables.load_dim_list(EventMatches(spark, sf_dir).heroes)


# slots

_NUMBERED = """numbered AS (
  SELECT match_id, account_id, team, timestamp_s, net_worth, ability_points, level,
         CAST(row_number() OVER (PARTITION BY match_id, timestamp_s, team ORDER BY account_id) AS INT) AS player_num
  FROM {0})"""


@query("slot_numbers", views.EVENTS + ", " + _NUMBERED.format("all_ts") + " SELECT * FROM numbered")
def slot_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.slot_numbers(samples(EventMatches(spark, sf_dir)))


def _twelve_joins() -> str:
    """One join per slot, the form the single aggregation replaces."""
    cells, sources = ["t.match_id", "t.timestamp_s AS timestamp"], "(SELECT DISTINCT match_id, timestamp_s FROM all_ts) t"
    for n, (team, num) in enumerate(SLOTS, start=1):
        slot = f"s{n}"
        cells += [f"{slot}.{c} AS p{n}_{c}" for c in ("account_id", "net_worth", "ability_points", "level")]
        sources += (
            f" JOIN numbered {slot} ON {slot}.match_id = t.match_id AND {slot}.timestamp_s = t.timestamp_s"
            f" AND {slot}.team = 'Team{team}' AND {slot}.player_num = {num}"
        )
    return f"SELECT {', '.join(cells)} FROM {sources}"


@query("slot_wide", views.EVENTS + ", " + _NUMBERED.format("all_ts") + _twelve_joins())
def slot_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = encode.encode_team(samples(EventMatches(spark, sf_dir)), "team")
    return features.slot_wide(
        features.slot_numbers(placed, TEAM_SIZE), ["account_id", "net_worth", "ability_points", "level"]
    )


# standardisation

_RATIO = """SELECT match_id, account_id, timestamp_s, ability_points, level,
  net_worth / nullif(CAST(sum(net_worth) OVER (PARTITION BY match_id, timestamp_s) AS DOUBLE), 0) AS net_worth_ratio,
  net_worth FROM {0}"""


@query(
    "net_worth_ratio",
    f"""{views.EVENTS} SELECT match_id, account_id, timestamp_s, ability_points, level,
       round(net_worth_ratio, 6) AS net_worth_ratio, net_worth FROM ({_RATIO.format('all_ts')})""",
)
def net_worth_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(normalize.net_worth_ratio(series.explode_series(EventMatches(spark, sf_dir).player)))


def _mean_std(pairs: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, avg({f}) AS mean, stddev_pop({f}) AS std FROM {table}" for f, table in pairs.items()
    )


def _scaled(column: str, feature: str) -> str:
    part = "(SELECT {} FROM params WHERE feature = '{}')"
    return f"(({column}) - {part.format('mean', feature)}) / nullif({part.format('std', feature)}, 0)"


@query(
    "fit_params",
    "SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std FROM ("
    + _mean_std({f: "lineitem" for f in ("l_quantity", "l_discount", "l_tax")})
    + ")",
)
def fit_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(normalize.mean_std(read_table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount", "l_tax"]))


@query(
    "zscore",
    """WITH p AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders)
       SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS o_totalprice, round((o_custkey - 100) / CAST(50 AS DOUBLE), 6) AS o_custkey
       FROM orders, p""",
)
def zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    both = ["o_totalprice", "o_custkey"]
    params = normalize.fit_normalizer(orders, both, {"o_custkey": (100.0, 50.0)})
    return rounded(normalize.transform(orders, both, params))


@query(
    "params_merge",
    """WITH old AS (SELECT p_type AS feature, avg(p_size) AS mean, stddev_pop(p_size) AS std FROM part GROUP BY p_type
         UNION ALL SELECT p_brand, avg(p_size), stddev_pop(p_size) FROM part GROUP BY p_brand),
       new AS (SELECT p_type AS feature, avg(p_retailprice) AS mean, stddev_pop(p_retailprice) AS std FROM part GROUP BY p_type)
       SELECT feature, round(coalesce(n.mean, o.mean), 6) AS mean, round(coalesce(n.std, o.std), 6) AS std
       FROM old o FULL JOIN new n USING (feature)""",
)
def params_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")

    def fitted(key: str, value: str) -> DataFrame:
        return part.groupBy(F.col(key).alias("feature")).agg(
            F.avg(value).alias("mean"), F.stddev_pop(value).alias("std")
        )

    old = fitted("p_type", "p_size").unionByName(fitted("p_brand", "p_size"))
    return rounded(normalize.merge_params(old, fitted("p_type", "p_retailprice")))


_KEPT_RATIO = f"kept_ratio AS ({_RATIO.format('kept_ts')})"
_PARAMS = (
    "params AS ("
    + _mean_std({"total_gold": "kept_gold", **{f: "kept_ratio" for f in PLAYER_FEATURES}})
    + ")"
)


@query(
    "normalized_players",
    f"{views.FILTERED}, {views.INFO_TS}, {_KEPT_RATIO}, {_PARAMS} "
    + "SELECT match_id, account_id, timestamp_s, "
    + ", ".join(f"round({_scaled(f, f)}, 6) AS {f}" for f in PLAYER_FEATURES)
    + f", round({_scaled('total_gold', 'total_gold')}, 6) AS total_gold FROM kept_ratio "
    + "JOIN kept_gold g USING (match_id) WHERE g.timestamp = timestamp_s",
)
def normalized_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = stage_tables(spark, sf_dir)
    info, players, _ = normalize.normalize_features(
        series.total_gold(stages.player_timestamp), stages.player_timestamp
    )
    info = info.withColumnRenamed("timestamp", "timestamp_s")
    return rounded(players.join(info, ["match_id", "timestamp_s"]))


@query(
    "one_hot_hero",
    """SELECT p_partkey, p_size, """
    + ", ".join(
        f"CASE WHEN p_type = '{h}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS hero_name_{h}"
        for h in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
    )
    + " FROM part",
)
def one_hot_hero(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read_table(spark, sf_dir, "part").select("p_partkey", "p_size", F.col("p_type").alias("hero_name"))
    return encode.one_hot(parts, "hero_name", hero_list(spark, sf_dir))


# the training table

HEROES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def feature_sql() -> str:
    """The wide row by conditional aggregates over numbered, scaled player rows."""
    cells = []
    for n, (team, num) in enumerate(SLOTS, start=1):
        here = f"FILTER (WHERE team = 'Team{team}' AND player_num = {num})"
        cells += [
            f"max(CASE WHEN hero_name = '{h}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) {here} AS p{n}_hero_name_{h}"
            for h in HEROES
        ]
        cells += [f"round(max({_scaled(f, f)}) {here}, 6) AS p{n}_{f}" for f in PLAYER_FEATURES]
    flags = ", ".join(FLAGS)
    return f"""{views.FILTERED}, {views.INFO_TS}, {_KEPT_RATIO},
fitted AS ({_mean_std({"total_gold": "kept_gold", **{f: "kept_ratio" for f in PLAYER_FEATURES}})}),
placed AS (
  SELECT r.*, p.team, p.hero_name,
         row_number() OVER (PARTITION BY r.match_id, r.timestamp_s, p.team ORDER BY r.account_id) AS player_num
  FROM kept_ratio r JOIN named_player p USING (match_id, account_id)),
full_rows AS (
  SELECT match_id, timestamp_s FROM placed WHERE player_num <= 6 GROUP BY match_id, timestamp_s HAVING count(*) = 12),
clock AS (SELECT i.* FROM info_ts i JOIN full_rows f ON f.match_id = i.match_id AND f.timestamp_s = i.timestamp),
params AS (SELECT * FROM fitted UNION ALL SELECT 'timestamp', avg(timestamp), stddev_pop(timestamp) FROM clock),
slots AS (
  SELECT match_id, timestamp_s, {', '.join(cells)}
  FROM placed SEMI JOIN full_rows USING (match_id, timestamp_s) GROUP BY match_id, timestamp_s)
SELECT c.match_id, c.timestamp AS time_s, round({_scaled('c.timestamp', 'timestamp')}, 6) AS timestamp,
  round({_scaled('c.total_gold', 'total_gold')}, 6) AS total_gold, {flags},
  s.* EXCLUDE (match_id, timestamp_s), CAST(winning_team = 'Team1' AS INT) AS winning_team
FROM clock c JOIN slots s ON s.match_id = c.match_id AND s.timestamp_s = c.timestamp
JOIN kept_info i ON i.match_id = c.match_id"""


def kept_and_params(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, list[str], normalize.Params]:
    """Kept info, kept players, hero list and the fitted parameters.

    The kept rows are written once, as in ``plans.prepare``: the fit and the training table both read them.
    """
    raw = EventMatches(spark, sf_dir)
    info, player = store_matches(raw.info, raw.player, raw.heroes, CHOSEN, scratch_path(spark, "kept"))
    return info, player, hero_list(spark, sf_dir), features.fit_wide(player, info)


@query("feature_matrix", feature_sql())
def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    info, player, heroes, params = kept_and_params(spark, sf_dir)
    return rounded(features.feature_matrix(player, info, heroes, params, placed=True))


@query("assemble_features", feature_sql())
def assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table step by step from the four stage tables."""
    stages = stage_tables(spark, sf_dir)
    info_general = encode.encode_team(stages.info_general.drop("duration_s"), "winning_team")
    player_general = encode.encode_team(stages.player_general, "team")
    info_ts, player_ts, params = normalize.normalize_features(stages.info_timestamp, stages.player_timestamp)
    wide = features.assemble_features(info_ts, player_general, player_ts, hero_list(spark, sf_dir), info_general)
    params = normalize.fit_normalizer(wide, ["timestamp"], params)
    timed = wide.withColumn("time_s", F.col("timestamp"))
    return rounded(normalize.transform(timed, ["timestamp"], params))


def _vector_sql() -> str:
    """The features of each row in their order, one row per feature."""
    names = features.feature_columns(list(HEROES))
    cells = ", ".join(f"CAST({n} AS DOUBLE)" for n in names)
    return f"""SELECT match_id, time_s, winning_team, CAST(unnest(range({len(names)})) AS INT) AS place, unnest([{cells}]) AS value
FROM ({feature_sql()})"""


def _unrolled(vectors: DataFrame) -> DataFrame:
    rows = vectors.select("match_id", "time_s", "winning_team", F.posexplode(vector_to_array("features")).alias("place", "value"))
    return rounded(rows)


@query("vectors", _vector_sql())
def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    info, player, heroes, params = kept_and_params(spark, sf_dir)
    matrix = features.feature_matrix(player, info, heroes, params, placed=True)
    return _unrolled(features.to_vector(matrix, features.feature_columns(heroes), keep=["match_id", "time_s"]))


@query("feature_vectors", _vector_sql())
def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    info, player, heroes, params = kept_and_params(spark, sf_dir)
    return _unrolled(features.feature_vectors(player, info, heroes, params, placed=True))


# game states


def game_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of every match at every sample time; some are spoiled on purpose.

    Teams can be short of players, heroes unknown; match_id % 7 = 3 turns worth negative and
    match_id % 7 = 5 adds an objective that does not exist.
    """
    raw = EventMatches(spark, sf_dir)
    rows = series.explode_series(raw.player, ["match_id", "account_id", "team", "hero_id"])
    names = raw.heroes.select(F.col("id").alias("hero_id"), F.col("name").alias("hero"))
    rows = rows.join(small_dim(names), "hero_id", "left")
    worth = F.when(F.col("match_id") % 7 == 3, -F.col("net_worth")).otherwise(F.col("net_worth"))
    player = F.struct("account_id", "hero", worth.alias("net_worth"), "ability_points", "level")

    def side(team: str):
        mine = F.sort_array(F.collect_list(F.when(F.col("team") == team, player)))  # at most twelve per state
        return F.transform(
            mine,
            lambda p: F.struct(p["hero"].alias("hero"), p["net_worth"].alias("net_worth"),
                               p["ability_points"].alias("ability_points"), p["level"].alias("level")),
        )

    states = rows.groupBy("match_id", F.col("timestamp_s").alias("timestamp")).agg(
        side("Team0").alias("players0"), side("Team1").alias("players1")
    )
    flagged = series.objective_flags(states, series.explode_objectives(raw.info))

    def lost(team: int):
        pairs = [F.struct(F.lit(o).alias("key"), (F.col(f"team{team}_{o}") == 1).alias("value")) for o in OBJECTIVES]
        known = F.filter(F.array(*pairs), lambda p: p["value"])
        extra = F.array(F.struct(F.lit("Tier1Lane2").alias("key"), F.lit(True).alias("value")))
        return F.map_from_entries(F.when(F.col("match_id") % 7 == 5, F.concat(known, extra)).otherwise(known))

    return flagged.select(
        "match_id",
        "timestamp",
        *[
            F.struct(F.col(f"players{t}").alias("players"), lost(t).alias("lost_objectives")).alias(f"team{t}")
            for t in (0, 1)
        ],
    )


_STATES = """, state_player AS (
  SELECT match_id, timestamp_s, account_id, team, name AS hero_name,
         CASE WHEN match_id % 7 = 3 THEN -net_worth ELSE net_worth END AS net_worth, ability_points, level,
         row_number() OVER (PARTITION BY match_id, timestamp_s, team ORDER BY account_id) AS place
  FROM all_ts LEFT JOIN heroes ON hero_id = id),
state_gold AS (
  SELECT match_id, timestamp_s AS timestamp, CAST(sum(net_worth) AS BIGINT) AS total_gold
  FROM state_player GROUP BY match_id, timestamp_s)
"""


@query(
    "game_state_flat",
    views.EVENTS + _STATES + views.flags_over("state_gold", ", x.total_gold"),
)
def game_state_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.flatten_game_state(game_states(spark, sf_dir)).info_timestamp


@query(
    "game_state_players",
    views.EVENTS
    + _STATES
    + """SELECT match_id, timestamp_s, place + CASE team WHEN 'Team0' THEN 0 ELSE 6 END AS account_id, team, hero_name,
       net_worth, ability_points, level FROM state_player""",
)
def game_state_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    # account numbers are unique within a state, so the time joins as well
    flat = scoring.flatten_game_state(
        game_states(spark, sf_dir).withColumn("at", F.col("timestamp")), ["match_id", "at"]
    )
    keys = ["match_id", "at", "account_id"]
    return flat.player_general.join(flat.player_timestamp, keys).drop("at")


_REASONS = ", ".join(
    f"CASE WHEN {rule.format(t=t)} THEN 'team{t}: {reason}' END"
    for t in (0, 1)
    for rule, reason in (
        ("count(*) FILTER (WHERE team = 'Team{t}') <> 6", "player count"),
        ("count(*) FILTER (WHERE team = 'Team{t}' AND hero_name IS NULL) > 0", "hero"),
        ("count(*) FILTER (WHERE team = 'Team{t}' AND net_worth < 0) > 0", "net_worth"),
        ("match_id % 7 = 5", "objective"),
    )
)


def accepted_states_sql(select: str) -> str:
    """``select`` over ``checked``, the states with the list of rules they break."""
    return f"""{views.EVENTS}{_STATES}, checked AS (
         SELECT match_id, timestamp_s AS timestamp, list_sort(list_filter([{_REASONS}], lambda x: x IS NOT NULL)) AS r
         FROM state_player GROUP BY match_id, timestamp_s)
       {select}"""


@query(
    "validate_states",
    accepted_states_sql("SELECT match_id, timestamp, array_to_string(r, '; ') AS reasons, len(r) = 0 AS accepted FROM checked"),
)
def validate_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = scoring.validate(game_states(spark, sf_dir), hero_list(spark, sf_dir))
    return checked.select(
        "match_id",
        "timestamp",
        F.array_join("reasons", "; ").alias("reasons"),
        (F.size("reasons") == 0).alias("accepted"),
    )


EDITS = {
    "richer": {"side": "team0", "player": 0, "changes": {"net_worth": 9_000_000, "level": 30}},
    "titan": {"side": "team1", "objective": "Titan", "destroyed": True},
    "core": {"side": "team0", "objective": "Core", "destroyed": False},
}


@query(
    "what_if",
    views.EVENTS
    + _STATES
    + ", flags AS ("
    + views.flags_over("state_gold", ", x.total_gold")
    + """), first_player AS (
         SELECT match_id, timestamp_s AS timestamp, net_worth AS first_worth FROM state_player WHERE team = 'Team0' AND place = 1)
       SELECT edit, match_id, timestamp,
         CASE WHEN edit = 'richer' AND first_worth IS NOT NULL THEN total_gold - first_worth + 9000000 ELSE total_gold END AS total_gold,
         CASE WHEN edit = 'titan' THEN 1 ELSE team1_Titan END AS team1_Titan,
         CASE WHEN edit = 'core' THEN 0 ELSE team0_Core END AS team0_Core, team0_Titan, team1_Core
       FROM flags LEFT JOIN first_player USING (match_id, timestamp)
       CROSS JOIN (SELECT unnest(['richer', 'titan', 'core']) AS edit)""",
)
def what_if(spark: SparkSession, sf_dir: str) -> DataFrame:
    edited = scoring.what_if(game_states(spark, sf_dir), EDITS)
    flat = scoring.flatten_game_state(edited, ["edit", "match_id"]).info_timestamp
    return flat.select(
        "edit", "match_id", "timestamp", "total_gold", "team1_Titan", "team0_Core", "team0_Titan", "team1_Core"
    )
