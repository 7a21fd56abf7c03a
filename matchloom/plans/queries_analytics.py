"""Queries over aggregates, win rates, leads and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.functions.columns import interval_label, minutes, sigmoid, team_number, time_bin, whole_div
from matchloom.operators import aggregates, analytics, profile, series
from matchloom.operators.joins import lookup_inner
from matchloom.plans import views
from matchloom.plans.queries_tables import match_documents, samples
from matchloom.plans.registry import query, rounded
from matchloom.sources import tables
from matchloom.sources.testdata import EventMatches, OrderMatches, read_table

# sums and means per team


@query(
    "team_gold",
    views.ORDERS + "SELECT match_id, team, CAST(sum(net_worth) AS BIGINT) AS net_worth FROM om_player GROUP BY match_id, team",
)
def team_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.team_sum(OrderMatches(spark, sf_dir).player, ["match_id", "team"], "net_worth")


@query("team_gold_wide", views.ORDERS + "SELECT * FROM om_gold")
def team_gold_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.team_wide(team_gold(spark, sf_dir), ["match_id"], "net_worth")


@query(
    "team_level_by_time",
    views.EVENTS
    + """SELECT match_id, timestamp_s, team, round(avg(level), 6) AS level FROM all_ts GROUP BY match_id, timestamp_s, team""",
)
def team_level_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        aggregates.team_mean(samples(EventMatches(spark, sf_dir)), ["match_id", "timestamp_s", "team"], "level")
    )


@query(
    "last_sample",
    views.EVENTS
    + """SELECT match_id, account_id, team, max(timestamp_s) AS timestamp_s, arg_max(net_worth, timestamp_s) AS net_worth,
       arg_max(ability_points, timestamp_s) AS ability_points, arg_max(level, timestamp_s) AS level
       FROM all_ts GROUP BY match_id, account_id, team""",
)
def last_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.last_per_group(
        samples(EventMatches(spark, sf_dir)), ["match_id", "account_id", "team"], "timestamp_s"
    )


@query(
    "net_income",
    views.EVENTS
    + """SELECT match_id, CAST(CASE WHEN team = 'Team1' THEN 1 ELSE 2 END AS INT) AS team, t AS timestamp_s,
       CAST(sum(nw) AS BIGINT) AS net_worth FROM cum GROUP BY ALL""",
)
def net_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.net_income(tables.parse_match_json(match_documents(spark, sf_dir), "doc"))


# gold differences

_PCT = "(Team0 - Team1) / nullif(CAST(greatest(Team0, Team1) AS DOUBLE), 0) * 100"


@query(
    "gold_diff_end",
    views.ORDERS
    + f"""SELECT match_id, winning_team, Team0, Team1, round({_PCT}, 6) AS gold_diff_pct,
       CASE WHEN winning_team = 'Team0' THEN 'won' ELSE 'lost' END AS result_team0,
       CASE WHEN winning_team = 'Team1' THEN 'won' ELSE 'lost' END AS result_team1
       FROM om_gold JOIN om_info USING (match_id) WHERE winning_team IS NOT NULL""",
)
def gold_diff_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = OrderMatches(spark, sf_dir)
    return rounded(analytics.gold_diff_end(orders.info, orders.player))


_TEAM_TIMES = """, gold AS (
  SELECT match_id, timestamp_s, CAST(sum(net_worth) FILTER (WHERE team = 'Team0') AS BIGINT) AS Team0,
         CAST(sum(net_worth) FILTER (WHERE team = 'Team1') AS BIGINT) AS Team1
  FROM all_ts GROUP BY match_id, timestamp_s)
"""


@query(
    "gold_diff_ts",
    views.EVENTS
    + _TEAM_TIMES
    + f"""SELECT match_id, timestamp_s, winning_team, Team0, Team1, round({_PCT}, 6) AS gold_diff_pct
       FROM gold JOIN raw_info USING (match_id)""",
)
def gold_diff_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = EventMatches(spark, sf_dir)
    return rounded(analytics.gold_diff_ts(raw.info, raw.player, samples(raw)))


@query(
    "gold_diff_range",
    views.EVENTS
    + _TEAM_TIMES
    + f"SELECT round(min({_PCT}), 6) AS min_pct, round(max({_PCT}), 6) AS max_pct FROM gold JOIN raw_info USING (match_id)",
)
def gold_diff_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = EventMatches(spark, sf_dir)
    stats = analytics.gold_diff_ts(raw.info, raw.player, samples(raw))
    return rounded(analytics.gold_diff_range(stats))


@query(
    "gold_diff_box",
    views.ORDERS
    + f""", d AS (
         SELECT CASE WHEN winning_team = 'Team0' THEN 'won' ELSE 'lost' END AS result, {_PCT} AS v
         FROM om_gold JOIN om_info USING (match_id) WHERE winning_team IS NOT NULL),
       q AS (
         SELECT result, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
         FROM d GROUP BY result)
       SELECT result, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, count(v) AS n,
         round(min(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
         round(max(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
         count(v) FILTER (WHERE v NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
       FROM d JOIN q USING (result) GROUP BY result, q1, median, q3""",
)
def gold_diff_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = OrderMatches(spark, sf_dir)
    return rounded(analytics.gold_diff_box(analytics.gold_diff_end(orders.info, orders.player)))


@query(
    "lead_summary",
    views.ORDERS
    + """SELECT count(*) AS matches, count(*) FILTER (WHERE leader_won) AS lead_wins,
       count(*) FILTER (WHERE NOT leader_won) AS comebacks, round(avg(CAST(leader_won AS DOUBLE)), 6) AS accuracy
       FROM om_lead""",
)
def lead_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = OrderMatches(spark, sf_dir)
    return rounded(analytics.leader_accuracy(orders.player, orders.info))


@query(
    "comebacks",
    views.ORDERS
    + "SELECT match_id, Team0, Team1, gold_diff, lead_team, winning_team FROM om_lead WHERE NOT leader_won",
)
def comebacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = OrderMatches(spark, sf_dir)
    return analytics.comebacks(orders.player, orders.info)


@query(
    "winner_margin",
    views.ORDERS
    + """SELECT round(avg(winner_gold_diff), 6) AS mean_margin, max(winner_gold_diff) AS max_margin,
       count(*) FILTER (WHERE winner_gold_diff < 0) AS comebacks,
       min(winner_gold_diff) FILTER (WHERE winner_gold_diff < 0) AS worst_comeback,
       round(avg(winner_gold_diff) FILTER (WHERE winner_gold_diff < 0), 6) AS mean_comeback
       FROM om_lead""",
)
def winner_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = OrderMatches(spark, sf_dir)
    return rounded(analytics.winner_margin(orders.player, orders.info))


def _hist_sql(side: str, rows: str, bins: int) -> str:
    return f"""
SELECT '{side}' AS side, bin, round(lo + bin * width, 6) AS low, round(lo + (bin + 1) * width, 6) AS high,
       count(v) AS count
FROM (SELECT CAST(min(winner_gold_diff) AS DOUBLE) AS lo, (max(winner_gold_diff) - min(winner_gold_diff)) / {bins} AS width
      FROM om_lead WHERE {rows}) b
CROSS JOIN range({bins}) r(bin)
LEFT JOIN (SELECT winner_gold_diff AS v FROM om_lead WHERE {rows}) x
  ON least(CAST(floor((v - lo) / width) AS BIGINT), {bins - 1}) = bin
GROUP BY bin, lo, width"""


@query(
    "winner_gold_hist",
    views.ORDERS + _hist_sql("ahead", "winner_gold_diff >= 0", 50) + " UNION ALL " + _hist_sql("behind", "winner_gold_diff < 0", 30),
)
def winner_gold_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = OrderMatches(spark, sf_dir)
    return rounded(analytics.winner_gold_hist(orders.player, orders.info))


@query(
    "gold_scatter",
    views.ORDERS
    + """SELECT match_id, Team0 + Team1 AS total_gold, gold_diff,
       CAST(CASE winning_team WHEN 'Team0' THEN 0 WHEN 'Team1' THEN 1 END AS INT) AS winner FROM om_lead""",
)
def gold_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = OrderMatches(spark, sf_dir)
    return analytics.gold_scatter(orders.player, orders.info)


@query(
    "duration_hist",
    views.ORDERS
    + """, top AS (SELECT (max(duration_s) + 179) // 180 AS n FROM om_info)
       SELECT (bin * 180) // 60 || '–' || ((bin + 1) * 180) // 60 || ' min' AS label, bin * 180 AS low,
         (bin + 1) * 180 AS high, count(duration_s) AS count
       FROM (SELECT unnest(range(n)) AS bin FROM top) LEFT JOIN om_info ON duration_s // 180 = bin
       GROUP BY bin""",
)
def duration_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.fixed_histogram(OrderMatches(spark, sf_dir).info, "duration_s", 180)


# leads over time


def _lead_time_sql(metric: str, truncate: bool, out: str, having: str = "") -> str:
    mean = f"avg({metric}) FILTER (WHERE team = '{{}}')"
    if truncate:
        mean = f"CAST(trunc({mean}) AS BIGINT)"
    return f"""
, means AS (
  SELECT match_id, timestamp_s, {mean.format('Team0')} - {mean.format('Team1')} AS diff
  FROM all_ts GROUP BY match_id, timestamp_s),
led AS (
  SELECT m.*, CASE WHEN CASE WHEN diff > 0 THEN 'Team0' ELSE 'Team1' END = winning_team
              THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS correct
  FROM means m LEFT JOIN raw_info USING (match_id))
SELECT timestamp_s, {out}, count(DISTINCT match_id) AS matchcount, timestamp_s / 60 AS timestamp_min
FROM led GROUP BY timestamp_s {having}"""


_SHARE = "count(DISTINCT match_id) / (SELECT count(DISTINCT match_id) FROM led) * 100"
_BY_TIME = f"""round(avg(diff), 6) AS avg_diff, round(avg(abs(diff)), 6) AS avg_abs_diff,
  round(avg(correct), 6) AS lead_accuracy, round({_SHARE}, 6) AS match_pct"""


@query(
    "gold_lead_by_time",
    views.EVENTS
    + _lead_time_sql(
        "net_worth", True, f"round_even(avg(correct), 4) AS lead_accuracy, round_even({_SHARE}, 2) AS match_pct"
    ),
)
def gold_lead_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = EventMatches(spark, sf_dir)
    return analytics.gold_lead_by_time(samples(raw), raw.player, raw.info)


def _lead(spark: SparkSession, sf_dir: str, metric: str, how: str, min_matches: int | None = None) -> DataFrame:
    raw = EventMatches(spark, sf_dir)
    stats = analytics.lead_by_time(samples(raw), raw.player, raw.info, metric, how=how, min_matches=min_matches)
    return stats.select(
        "timestamp_s",
        *[F.round(c, 6).alias(c) for c in ("avg_diff", "avg_abs_diff", "lead_accuracy", "match_pct")],
        "matchcount",
        "timestamp_min",
    )


@query("level_lead_by_time", views.EVENTS + _lead_time_sql("level", False, _BY_TIME))
def level_lead_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lead(spark, sf_dir, "level", "inner")


@query("ap_lead_by_time", views.EVENTS + _lead_time_sql("ability_points", False, _BY_TIME))
def ap_lead_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lead(spark, sf_dir, "ability_points", "left")


@query(
    "lead_by_time_min_matches",
    views.EVENTS + _lead_time_sql("level", False, _BY_TIME, "HAVING count(DISTINCT match_id) >= 3"),
)
def lead_by_time_min_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lead(spark, sf_dir, "level", "inner", 3)


def _lead_end_sql(metric: str) -> str:
    return f"""
, last AS (SELECT match_id, account_id, team, arg_max({metric}, timestamp_s) AS v FROM all_ts GROUP BY ALL),
means AS (
  SELECT match_id, avg(v) FILTER (WHERE team = 'Team0') AS Team0, avg(v) FILTER (WHERE team = 'Team1') AS Team1
  FROM last GROUP BY match_id)
SELECT match_id, round(Team0, 6) AS Team0, round(Team1, 6) AS Team1, round(Team0 - Team1, 6) AS diff, winning_team,
       coalesce(CASE WHEN Team0 - Team1 > 0 THEN 'Team0' ELSE 'Team1' END = winning_team, FALSE) AS advantage_won
FROM means JOIN raw_info USING (match_id)"""


def _lead_end(spark: SparkSession, sf_dir: str, metric: str) -> DataFrame:
    raw = EventMatches(spark, sf_dir)
    return analytics.lead_end(series.last_samples(raw.player, ["match_id", "account_id", "team"]), raw.player, raw.info, metric)


@query("level_lead_end", views.EVENTS + _lead_end_sql("level"))
def level_lead_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_lead_end(spark, sf_dir, "level"))


@query("ap_lead_end", views.EVENTS + _lead_end_sql("ability_points"))
def ap_lead_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_lead_end(spark, sf_dir, "ability_points"))


@query(
    "level_lead_accuracy",
    "SELECT count(*) AS matches, count(*) FILTER (WHERE advantage_won) AS advantage_wins, "
    "count(*) FILTER (WHERE NOT advantage_won) AS comeback_wins, "
    "round(avg(CAST(advantage_won AS DOUBLE)), 6) AS accuracy FROM ("
    + views.EVENTS
    + _lead_end_sql("level")
    + ")",
)
def level_lead_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analytics.lead_end_accuracy(_lead_end(spark, sf_dir, "level")))


# heroes


@query("hero_picks", views.ORDERS + "SELECT hero_name, count(*) AS pick_count FROM om_player GROUP BY hero_name ORDER BY pick_count DESC, hero_name")
def hero_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.hero_picks(OrderMatches(spark, sf_dir).player)


@query(
    "top_heroes",
    views.ORDERS
    + """SELECT hero_name, count(*) AS pick_count, round(avg(won), 6) AS winrate
       FROM om_played GROUP BY hero_name ORDER BY pick_count DESC, hero_name LIMIT 4""",
)
def top_heroes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = OrderMatches(spark, sf_dir)
    return rounded(analytics.popularity_vs_winrate(orders.player, orders.info, 4))


@query(
    "hero_match_share",
    views.ORDERS
    + """SELECT hero_name, count(DISTINCT match_id) AS matches, round(avg(won) * 100, 6) AS winrate_pct,
       round(count(DISTINCT match_id) / (SELECT count(DISTINCT match_id) FROM om_player) * 100, 6) AS match_pct
       FROM om_played GROUP BY hero_name""",
)
def hero_match_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = OrderMatches(spark, sf_dir)
    return rounded(analytics.hero_share_and_winrate(orders.player, orders.info))


@query(
    "hero_matches",
    views.ORDERS + "SELECT hero_name, count(DISTINCT match_id) AS matches FROM om_player GROUP BY hero_name",
)
def hero_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.hero_match_share(OrderMatches(spark, sf_dir).player)


_DURATION = """, per_bin AS (
  SELECT hero_name, duration_s // 180 * 3 AS duration_bin, avg(won) AS winrate, count(DISTINCT match_id) AS matches
  FROM om_played GROUP BY ALL),
per_hero AS (
  SELECT hero_name, avg(won) AS overall, count(DISTINCT match_id) AS hero_matches_overall
  FROM om_played GROUP BY hero_name)
"""
_DURATION_OUT = """SELECT hero_name, duration_bin, round(winrate, 6) AS winrate, matches,
  round(overall, 6) AS hero_winrate_overall, hero_matches_overall, round(winrate - overall, 6) AS delta_to_baseline
  FROM per_bin JOIN per_hero USING (hero_name) WHERE duration_bin IS NOT NULL"""


@query("winrate_by_duration", views.ORDERS + _DURATION + _DURATION_OUT)
def winrate_by_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = OrderMatches(spark, sf_dir)
    stats = rounded(analytics.winrate_by_duration(orders.player, orders.info))
    return stats.withColumn("hero_matches_overall", F.col("hero_matches_overall").cast("bigint"))


_CHOSEN = ["ECONOMY", "PROMO", "STANDARD"]


@query(
    "winrate_by_duration_subset",
    views.ORDERS
    + _DURATION
    + "SELECT duration_bin, "
    + ", ".join(f"round(max(winrate - overall) FILTER (WHERE hero_name = '{h}'), 6) AS {h}" for h in _CHOSEN)
    + """ FROM per_bin JOIN per_hero USING (hero_name)
       WHERE duration_bin BETWEEN 15 AND 43 AND hero_name IN ('ECONOMY', 'PROMO', 'STANDARD') GROUP BY duration_bin""",
)
def winrate_by_duration_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = OrderMatches(spark, sf_dir)
    return rounded(analytics.winrate_deviation_wide(orders.player, orders.info, _CHOSEN))


@query(
    "hero_duration_matches",
    views.ORDERS
    + _DURATION
    + """SELECT hero_name, duration_bin, round(winrate, 6) AS winrate, matches FROM per_bin
       WHERE hero_name = 'PROMO' AND duration_bin IS NOT NULL""",
)
def hero_duration_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = OrderMatches(spark, sf_dir)
    return rounded(analytics.winrate_by_duration(orders.player, orders.info, hero="PROMO"))


@query(
    "hero_time_samples",
    views.EVENTS
    + """SELECT name AS hero_name,
         CASE WHEN timestamp_s < 900 THEN timestamp_s // 180 * 3 ELSE 15 + (timestamp_s - 900) // 300 * 5 END AS time_bin_min,
         round(avg(CASE WHEN team = winning_team THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6) AS winrate,
         count(*) AS samples
       FROM all_ts JOIN heroes ON hero_id = id LEFT JOIN raw_info USING (match_id)
       WHERE name IN ('ECONOMY', 'PROMO', 'STANDARD') GROUP BY 1, 2""",
)
def hero_time_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = EventMatches(spark, sf_dir)
    player = lookup_inner(raw.player, raw.heroes, "hero_id", "id", "name", "hero_name")
    carried = series.explode_series(player, ["match_id", "account_id", "team", "hero_name"])
    return rounded(analytics.hero_time_samples(player, carried, raw.info, _CHOSEN))


@query(
    "hero_wr_gold_cases",
    views.ORDERS
    + """, m AS (SELECT avg(net_worth) AS mean FROM om_player)
       SELECT hero_name, round(avg(won) * 100, 6) AS winrate_all,
         round(avg(won) FILTER (WHERE net_worth >= mean + 1500000) * 100, 6) AS winrate_plus,
         round(avg(won) FILTER (WHERE net_worth <= mean - 1500000) * 100, 6) AS winrate_minus,
         count(*) AS samples_all, count(*) FILTER (WHERE net_worth >= mean + 1500000) AS samples_plus,
         count(*) FILTER (WHERE net_worth <= mean - 1500000) AS samples_minus
       FROM om_played, m GROUP BY hero_name""",
)
def hero_wr_gold_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = OrderMatches(spark, sf_dir)
    return rounded(analytics.winrate_by_gold_case(orders.player, orders.info, 1500000))


# profiles


def _profile_text(column: str) -> str:
    return f"""SELECT '{column}' AS column, count({column}) AS count, count(DISTINCT {column}) AS unique,
  (SELECT {column} FROM t WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1) AS top,
  (SELECT count(*) FROM t WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY count(*) DESC LIMIT 1) AS freq,
  CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS q25,
  CAST(NULL AS DOUBLE) AS q50, CAST(NULL AS DOUBLE) AS q75, CAST(NULL AS DOUBLE) AS max FROM t"""


def _profile_number(column: str) -> str:
    return f"""SELECT '{column}', count({column}), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT),
  round(avg({column}), 4), round(stddev_samp({column}), 4), CAST(min({column}) AS DOUBLE),
  quantile_cont(CAST({column} AS DOUBLE), 0.25), quantile_cont(CAST({column} AS DOUBLE), 0.5),
  quantile_cont(CAST({column} AS DOUBLE), 0.75), CAST(max({column}) AS DOUBLE) FROM t"""


@query(
    "profile_table",
    views.ORDERS
    + ", t AS (SELECT match_id, team, hero_name, net_worth, winning_team, duration_s FROM om_played) "
    + " UNION ALL ".join(
        [_profile_text(c) for c in ("team", "hero_name", "winning_team")]
        + [_profile_number(c) for c in ("match_id", "net_worth", "duration_s")]
    ),
)
def profile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = OrderMatches(spark, sf_dir)
    stats = profile.describe_all(orders.player.join(orders.info, "match_id", "left"))
    return stats.withColumns({c: F.round(c, 4) for c in ("mean", "std")})


@query(
    "profile_nonnull",
    views.ORDERS
    + """SELECT 'match_id' AS column, 'bigint' AS type, count(match_id) AS non_null FROM om_info
       UNION ALL SELECT 'winning_team', 'string', count(winning_team) FROM om_info
       UNION ALL SELECT 'duration_s', 'bigint', count(duration_s) FROM om_info""",
)
def profile_nonnull(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.info(OrderMatches(spark, sf_dir).info)


# scalar functions


@query(
    "scalar_mix",
    """SELECT l_orderkey, l_linenumber, greatest(l_partkey, l_suppkey) AS larger, round_even(l_extendedprice / 7, 2) AS rounded,
         CAST(CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS INT) AS side,
         (l_partkey * 60) // 60 || '–' || (l_partkey * 60 + 180) // 60 || ' min' AS label,
         l_suppkey / 60 AS minutes,
         CASE WHEN l_partkey < 900 THEN l_partkey // 180 * 3 ELSE 15 + (l_partkey - 900) // 300 * 5 END AS bin,
         CAST(epoch(l_shipdate) AS BIGINT) // 60 AS shipped_min
       FROM lineitem""",
)
def scalar_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("l_partkey")
    side = F.when(F.col("l_linestatus") == "F", F.lit("Team0")).otherwise(F.lit("Team1"))
    return read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.greatest("l_partkey", "l_suppkey").alias("larger"),
        F.bround(F.col("l_extendedprice") / 7, 2).alias("rounded"),
        team_number(side).alias("side"),
        interval_label(part * 60, part * 60 + 180).alias("label"),
        minutes(F.col("l_suppkey")).alias("minutes"),
        time_bin(part).alias("bin"),
        whole_div(F.unix_seconds(F.col("l_shipdate").cast("timestamp")), 60).alias("shipped_min"),
    )


@query(
    "sigmoid",
    """SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-(l_quantity - 25) / 10)), 6) AS score,
       CAST(1 / (1 + exp(-(l_quantity - 25) / 10)) >= 0.5 AS INT) AS predicted FROM lineitem""",
)
def sigmoids(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = sigmoid((F.col("l_quantity") - 25) / 10)
    return rounded(
        read_table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", score.alias("score"), (score >= 0.5).cast("int").alias("predicted")
        )
    )
