"""The match tables of ``sources.testdata`` and the stages after them, as SQL for the comparison."""

from __future__ import annotations

from matchloom.schemas import OBJECTIVES

_names = ", ".join(f"'{o}'" for o in OBJECTIVES)

EVENTS = f"""
WITH ev AS (
  SELECT user_id // 12 AS match_id, user_id AS account_id,
         CASE WHEN user_id % 12 < 6 THEN 'Team0' ELSE 'Team1' END AS team,
         CAST((day(ts) - 1) * 86400 AS BIGINT) AS t, ts, event_type,
         CAST(round(value * 100) AS BIGINT) AS cents,
         CAST(props->>'$.k' AS INT) AS k
  FROM events),
daily AS (
  SELECT match_id, account_id, team, t, CAST(sum(cents) AS BIGINT) AS c, count(*) AS n,
         count(*) FILTER (WHERE event_type = 'purchase') AS ap
  FROM ev GROUP BY ALL),
cum AS (
  SELECT match_id, account_id, team, t, CAST(sum(c) OVER w AS BIGINT) AS nw,
         CAST(sum(ap) OVER w AS BIGINT) AS ap, CAST(sum(n) OVER w AS BIGINT) AS lvl
  FROM daily WINDOW w AS (PARTITION BY account_id ORDER BY t)),
raw_player AS (
  SELECT match_id, account_id, any_value(team) AS team,
         CAST(CASE WHEN account_id % 150 = 96 THEN 99 ELSE account_id % 6 END AS INT) AS hero_id,
         max(nw) AS net_worth, max(ap) AS ability_points, max(lvl) AS player_level,
         CAST(CASE WHEN account_id % 37 = 36 THEN 86400 ELSE 0 END AS BIGINT) AS abandon_match_time_s,
         list(t ORDER BY t) AS "stats.time_stamp_s", list(nw ORDER BY t) AS "stats.net_worth",
         list(ap ORDER BY t) AS "stats.ability_points", list(lvl ORDER BY t) AS "stats.level"
  FROM cum WHERE match_id % 43 <> 20 GROUP BY match_id, account_id),
obj AS (
  SELECT match_id, team, k % 13 AS o, min(CASE WHEN k % 13 = 0 THEN 0 ELSE t END) AS d
  FROM ev GROUP BY match_id, team, k % 13),
obj_lists AS (
  SELECT match_id, list(d ORDER BY team, o) AS ds, list(([{_names}])[o + 1] ORDER BY team, o) AS os,
         list(team ORDER BY team, o) AS teams
  FROM obj GROUP BY match_id),
raw_info AS (
  SELECT e.match_id, min(ts) AS start_time,
         CAST(CASE WHEN e.match_id % 25 = 3 THEN 400 ELSE max(t) + 3600 END AS BIGINT) AS duration_s,
         CASE WHEN (e.match_id * 7) % 3 = 0 THEN 'Team0' ELSE 'Team1' END AS winning_team,
         CAST(CASE WHEN e.match_id % 31 = 9 THEN NULL WHEN e.match_id % 27 = 10 THEN 95 ELSE 101 + e.match_id % 6 END AS INT)
           AS average_badge_team0,
         CAST(CASE WHEN e.match_id % 29 = 7 THEN NULL ELSE 101 + least(5, e.match_id % 6 + e.match_id % 4) END AS INT)
           AS average_badge_team1,
         e.match_id % 17 = 11 AS low_pri_pool,
         CASE WHEN e.match_id % 13 = 4 THEN NULL ELSE FALSE END AS new_player_pool,
         e.match_id % 23 = 5 AS is_high_skill_range_parties,
         CASE WHEN e.match_id % 21 = 11 THEN NULL ELSE e.match_id % 22 <> 13 END AS rewards_eligible,
         e.match_id % 19 = 12 AS not_scored,
         any_value(ds) AS "objectives.destroyed_time_s", any_value(os) AS "objectives.team_objective",
         any_value(teams) AS "objectives.team"
  FROM ev e JOIN obj_lists l ON l.match_id = e.match_id GROUP BY e.match_id),
heroes AS (
  SELECT CAST(row_number() OVER (ORDER BY p_type) - 1 AS INT) AS id, p_type AS name
  FROM (SELECT DISTINCT p_type FROM part)),
all_ts AS (
  SELECT match_id, account_id, team, hero_id,
         unnest("stats.time_stamp_s"[1:len("stats.time_stamp_s") - 1]) AS timestamp_s,
         unnest("stats.net_worth"[1:len("stats.net_worth") - 1]) AS net_worth,
         unnest("stats.ability_points"[1:len("stats.ability_points") - 1]) AS ability_points,
         unnest("stats.level"[1:len("stats.level") - 1]) AS level
  FROM raw_player),
all_objectives AS (
  SELECT match_id, unnest("objectives.destroyed_time_s") AS destroyed_time,
         unnest("objectives.team_objective") AS obj_name, unnest("objectives.team") AS obj_side
  FROM raw_info)
"""

BADGE = "({0} // 10 * 6 + {0} % 10)"

FILTERED = (
    EVENTS
    + f""",
eligible AS (
  SELECT * FROM raw_info
  WHERE start_time >= TIMESTAMP '2024-01-01 00:00:00' AND start_time <= TIMESTAMP '2024-01-31 23:59:59'
    AND duration_s >= 480 AND rewards_eligible IS TRUE
    AND not_scored IS FALSE AND is_high_skill_range_parties IS FALSE
    AND low_pri_pool IS FALSE AND new_player_pool IS FALSE
    AND average_badge_team0 >= 101 AND average_badge_team1 >= 101
    AND abs({BADGE.format('average_badge_team0')} - {BADGE.format('average_badge_team1')}) <= 2),
eligible_player AS (SELECT p.* FROM raw_player p SEMI JOIN eligible USING (match_id)),
full_matches AS (SELECT match_id FROM eligible_player GROUP BY match_id HAVING count(*) = 12),
left_matches AS (
  SELECT DISTINCT p.match_id FROM eligible_player p JOIN eligible i USING (match_id)
  WHERE p.abandon_match_time_s > 0 AND i.duration_s - p.abandon_match_time_s > 70),
kept AS (SELECT match_id FROM full_matches EXCEPT SELECT match_id FROM left_matches),
kept_info AS (SELECT i.* FROM eligible i SEMI JOIN kept USING (match_id)),
kept_player AS (SELECT p.* FROM raw_player p SEMI JOIN kept USING (match_id)),
named_player AS (
  SELECT k.match_id, k.account_id, k.team, h.name AS hero_name, k.net_worth, k.ability_points, k.player_level
  FROM kept_player k JOIN heroes h ON k.hero_id = h.id),
kept_ts AS (
  SELECT match_id, account_id, p.team, p.hero_name, t.timestamp_s, t.net_worth, t.ability_points, t.level
  FROM all_ts t JOIN named_player p USING (match_id, account_id))
"""
)


def flag_columns(team: str, side: str, clock: str) -> str:
    """One 0/1 column per team and objective over rows of a match with its objectives."""
    return ",\n  ".join(
        f"max(CASE WHEN {side} = 'Team{t}' AND obj_name = '{o}' AND destroyed_time <> 0 "
        f"AND {clock} >= destroyed_time THEN 1 ELSE 0 END) AS {team}{t}_{o}"
        for t in (0, 1)
        for o in OBJECTIVES
    )


def flags_over(times: str, keep: str) -> str:
    """Objective flags of a (match_id, timestamp, ...) relation."""
    return f"""
SELECT x.match_id, x.timestamp{keep},
  {flag_columns('team', 'obj_side', 'x.timestamp')}
FROM {times} x LEFT JOIN all_objectives o ON o.match_id = x.match_id
GROUP BY x.match_id, x.timestamp{keep}"""


INFO_TS = f"""kept_gold AS (
  SELECT match_id, timestamp_s AS timestamp, CAST(sum(net_worth) AS BIGINT) AS total_gold
  FROM kept_ts GROUP BY match_id, timestamp_s),
info_ts AS ({flags_over('kept_gold', ', x.total_gold')})"""

ORDERS = """
WITH om_info AS (
  SELECT o_orderkey AS match_id,
         CASE o_orderstatus WHEN 'F' THEN 'Team0' WHEN 'O' THEN 'Team1' END AS winning_team,
         CAST(max(abs(date_diff('day', o_orderdate, l_shipdate))) AS BIGINT) AS duration_s
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderstatus),
om_player AS (
  SELECT l_orderkey AS match_id, CASE l_linestatus WHEN 'F' THEN 'Team0' ELSE 'Team1' END AS team,
         p_type AS hero_name, CAST(round(l_extendedprice * 100) AS BIGINT) AS net_worth
  FROM lineitem JOIN part ON p_partkey = l_partkey),
om_gold AS (
  SELECT match_id, CAST(sum(net_worth) FILTER (WHERE team = 'Team0') AS BIGINT) AS Team0,
         CAST(sum(net_worth) FILTER (WHERE team = 'Team1') AS BIGINT) AS Team1
  FROM om_player GROUP BY match_id),
om_lead AS (
  SELECT g.match_id, Team0, Team1, Team0 - Team1 AS gold_diff,
         CASE WHEN Team0 - Team1 > 0 THEN 'Team0' ELSE 'Team1' END AS lead_team, winning_team,
         coalesce(winning_team = CASE WHEN Team0 - Team1 > 0 THEN 'Team0' ELSE 'Team1' END, FALSE) AS leader_won,
         CASE WHEN winning_team = 'Team0' THEN Team0 - Team1 ELSE Team1 - Team0 END AS winner_gold_diff
  FROM om_gold g LEFT JOIN om_info i USING (match_id)),
om_played AS (
  SELECT p.*, winning_team, duration_s,
         CASE WHEN team = winning_team THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS won
  FROM om_player p LEFT JOIN om_info USING (match_id))
"""
