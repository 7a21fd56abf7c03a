"""Leads, win rates and gold analyses over the stage tables.

``info`` has one row per match, ``player`` one row per player and match (final values), ``player_ts``
one row per player and sample. Sums and means are taken per match before results are attached, so the
joins by match meet one row per match on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.functions.columns import (
    duration_bin,
    lead_team,
    minutes,
    pct_of_larger,
    rate,
    same_team,
    team_number,
    time_bin,
)
from matchloom.operators.aggregates import (
    box_stats,
    distinct_count,
    group_stats,
    histograms,
    masked_stats,
    sort,
    summary,
    team_mean,
    team_sum,
    team_wide,
    top_n,
    value_counts,
)
from matchloom.operators.filters import filter_in, filter_not, filter_range
from matchloom.operators.joins import attach_team, attach_winner
from matchloom.schemas import TEAMS
from matchloom.session import held

def _diff() -> Column:
    return F.col("Team0") - F.col("Team1")


def _won() -> Column:
    return same_team(F.col("team"), F.col("winning_team"))


# gold differences


def _known_result(info: DataFrame) -> DataFrame:
    """A match without result forms no group."""
    return info.where(F.col("winning_team").isNotNull())


def gold_diff_end(info: DataFrame, player: DataFrame) -> DataFrame:
    """Final gold per team and the difference in percent of the richer team, with both team results."""
    gold = team_wide(team_sum(player, ["match_id", "team"], "net_worth"), ["match_id"], "net_worth")

    def result(team: str) -> Column:
        return F.when(F.col("winning_team") == team, F.lit("won")).otherwise(F.lit("lost"))

    return attach_winner(gold, _known_result(info)).select(
        "match_id",
        "winning_team",
        *TEAMS,
        pct_of_larger(F.col("Team0"), F.col("Team1")).alias("gold_diff_pct"),
        result("Team0").alias("result_team0"),
        result("Team1").alias("result_team1"),
    )


def gold_diff_box(gold_diff: DataFrame, team: int = 0) -> DataFrame:
    """Box-plot figures of the final gold difference by the result of one team."""
    return box_stats(gold_diff.withColumnRenamed(f"result_team{team}", "result"), "gold_diff_pct", "result")


def gold_diff_ts(info: DataFrame, player: DataFrame, player_ts: DataFrame) -> DataFrame:
    """Gold per team and time, and the difference in percent of the richer team."""
    teams = attach_team(player_ts, player, "inner")
    keys = ["match_id", "timestamp_s"]
    gold = team_wide(team_sum(teams, [*keys, "team"], "net_worth"), keys, "net_worth")
    return attach_winner(gold, _known_result(info)).select(
        *keys, "winning_team", *TEAMS, pct_of_larger(F.col("Team0"), F.col("Team1")).alias("gold_diff_pct")
    )


def gold_diff_range(gold_diff: DataFrame) -> DataFrame:
    return gold_diff.agg(F.min("gold_diff_pct").alias("min_pct"), F.max("gold_diff_pct").alias("max_pct"))


def leader_results(player: DataFrame, info: DataFrame) -> DataFrame:
    """Per match: final gold per team, who led, who won, and whether the leader won."""
    gold = team_wide(team_sum(player, ["match_id", "team"], "net_worth"), ["match_id"], "net_worth")
    led = attach_winner(gold.withColumn("gold_diff", _diff()), info, "left")
    leader = lead_team(F.col("gold_diff"))
    return led.select(
        "match_id",
        *TEAMS,
        "gold_diff",
        leader.alias("lead_team"),
        "winning_team",
        same_team(leader, F.col("winning_team")).alias("leader_won"),
    )


def leader_accuracy(player: DataFrame, info: DataFrame) -> DataFrame:
    """How often the gold leader won: matches, wins, comebacks and the share."""
    return summary(
        leader_results(player, info),
        matches=F.count(F.lit(1)),
        lead_wins=F.count_if("leader_won"),
        comebacks=F.count_if(~F.col("leader_won")),
        accuracy=rate(F.col("leader_won")),
    )


def comebacks(player: DataFrame, info: DataFrame) -> DataFrame:
    """Matches the gold leader did not win."""
    return filter_not(leader_results(player, info), F.col("leader_won")).drop("leader_won")


def winner_gold(player: DataFrame, info: DataFrame) -> DataFrame:
    """Per match: the winner's gold lead (negative in a comeback)."""
    diff = F.col("gold_diff")
    margin = F.when(F.col("winning_team") == "Team0", diff).otherwise(-diff)
    return leader_results(player, info).withColumn("winner_gold_diff", margin)


def winner_margin(player: DataFrame, info: DataFrame) -> DataFrame:
    margin = F.col("winner_gold_diff")
    behind = F.when(margin < 0, margin)
    return winner_gold(player, info).agg(
        F.avg(margin).alias("mean_margin"),
        F.max(margin).alias("max_margin"),
        F.count(behind).alias("comebacks"),
        F.min(behind).alias("worst_comeback"),
        F.avg(behind).alias("mean_comeback"),
    )


def winner_gold_hist(player: DataFrame, info: DataFrame, bins_ahead: int = 50, bins_behind: int = 30) -> DataFrame:
    """Histograms of the winner's margin, apart for winners ahead and winners behind."""
    side = F.when(F.col("winner_gold_diff") >= 0, "ahead").when(F.col("winner_gold_diff") < 0, "behind")
    margins = held(winner_gold(player, info).select(side.alias("side"), "winner_gold_diff"), "margins")
    return histograms(margins, "side", "winner_gold_diff", {"ahead": bins_ahead, "behind": bins_behind})


def gold_scatter(player: DataFrame, info: DataFrame) -> DataFrame:
    """Total gold against gold difference per match, with the winner as a number."""
    return leader_results(player, info).select(
        "match_id",
        (F.col("Team0") + F.col("Team1")).alias("total_gold"),
        "gold_diff",
        team_number(F.col("winning_team")).alias("winner"),
    )


# leads over time and at the end


def lead_rows(player_ts: DataFrame, player: DataFrame, info: DataFrame, metric: str, truncate: bool, how: str) -> DataFrame:
    """Per match and time: team means of the metric, their difference, and whether the leader won."""
    keys = ["match_id", "timestamp_s"]
    rows = attach_team(player_ts, player).dropna(subset=[*keys, "team"])

    def mean(team: str) -> Column:
        value = F.avg(F.when(F.col("team") == team, F.col(metric)))
        return (value.cast("bigint") if truncate else value).alias(team)

    wide = rows.groupBy(*keys).agg(*[mean(t) for t in TEAMS])
    led = attach_winner(wide.withColumn("diff", _diff()), info, how)
    return led.withColumn("lead_correct", same_team(lead_team(F.col("diff")), F.col("winning_team")))


def lead_by_time(
    player_ts: DataFrame,
    player: DataFrame,
    info: DataFrame,
    metric: str = "net_worth",
    truncate: bool = False,
    how: str = "left",
    min_matches: int | None = None,
) -> DataFrame:
    """How often the leader at a time went on to win, with the number and share of matches.

    Each (match, time) is one row by then, so matches are counted without a distinct.
    """
    rows = lead_rows(player_ts, player, info, metric, truncate, how)
    present = player_ts.dropna(subset=["match_id", "timestamp_s"])
    if "team" in player_ts.columns:
        present = present.dropna(subset=["team"])
    else:
        present = present.join(player.dropna(subset=["team"]), ["match_id", "account_id"], "left_semi")
    if how == "inner":
        present = present.join(info, "match_id", "left_semi")
    total = distinct_count(present, [], "match_id").scalar()
    stats = group_stats(
        rows,
        ["timestamp_s"],
        avg_diff=F.avg("diff"),
        avg_abs_diff=F.avg(F.abs("diff")),
        lead_accuracy=rate(F.col("lead_correct")),
        matchcount=F.count("match_id"),
    ).withColumn("match_pct", F.col("matchcount") / total * 100)
    stats = filter_range(stats, "matchcount", low=min_matches)
    return stats.withColumn("timestamp_min", minutes(F.col("timestamp_s")))


def gold_lead_by_time(player_ts: DataFrame, player: DataFrame, info: DataFrame) -> DataFrame:
    """``lead_by_time`` for gold: truncated means, rounded half to even, without the mean differences."""
    return lead_by_time(player_ts, player, info, "net_worth", truncate=True).select(
        "timestamp_s",
        F.bround("lead_accuracy", 4).alias("lead_accuracy"),
        "matchcount",
        F.bround("match_pct", 2).alias("match_pct"),
        "timestamp_min",
    )


def lead_end(last: DataFrame, player: DataFrame, info: DataFrame, metric: str) -> DataFrame:
    """Per match: team means of the last samples, the difference, and whether the leader won.

    ``last`` has one row per player, as ``series.last_samples`` or ``last_per_group`` give it.
    """
    means = team_mean(attach_team(last, player), ["match_id", "team"], metric)
    wide = team_wide(means, ["match_id"], metric).withColumn("diff", _diff())
    led = attach_winner(wide, info)
    return led.withColumn("advantage_won", same_team(lead_team(F.col("diff")), F.col("winning_team")))


def lead_end_accuracy(lead: DataFrame) -> DataFrame:
    return lead.agg(
        F.count(F.lit(1)).alias("matches"),
        F.count_if("advantage_won").alias("advantage_wins"),
        F.count_if(~F.col("advantage_won")).alias("comeback_wins"),
        rate(F.col("advantage_won")).alias("accuracy"),
    )


# heroes


def hero_picks(player: DataFrame, n: int | None = None) -> DataFrame:
    """Heroes by number of picks, most picked first."""
    picks = value_counts(player, "hero_name", "pick_count")
    return sort(picks, ["pick_count", "hero_name"], [False, True]) if n is None else top_n(picks, ["pick_count", "hero_name"], n)


def popularity_vs_winrate(player: DataFrame, info: DataFrame, n: int = 20) -> DataFrame:
    """The most picked heroes with their win rate."""
    played = attach_winner(player.select("match_id", "team", "hero_name"), info, "left")
    stats = group_stats(played, ["hero_name"], pick_count=F.count(F.lit(1)), winrate=rate(_won()))
    return top_n(stats, ["pick_count", "hero_name"], n)


def hero_share_and_winrate(player: DataFrame, info: DataFrame) -> DataFrame:
    """Per hero: number and percent of matches played in, and win rate in percent."""
    total = distinct_count(player, [], "match_id").scalar()
    played = attach_winner(player.select("match_id", "team", "hero_name"), info, "left")
    stats = group_stats(
        played, ["hero_name"], matches=F.count_distinct("match_id"), winrate_pct=rate(_won()) * 100
    )
    return stats.withColumn("match_pct", F.col("matches") / total * 100)


def hero_match_share(player: DataFrame) -> DataFrame:
    return distinct_count(player, ["hero_name"], "match_id", "matches")


def winrate_by_duration(
    player: DataFrame, info: DataFrame, heroes: list[str] | None = None, hero: str | None = None
) -> DataFrame:
    """Win rate and matches per hero and three-minute duration bin, against the hero's overall rate.

    A match has one duration, so a hero's matches and wins add up over the bins: the baseline is a sum
    over the small per-bin table, not a second pass. Matches without a duration count in the baseline.
    """
    played = player.select("match_id", "team", "hero_name").join(
        info.select("match_id", "winning_team", "duration_s"), "match_id", "left"
    )
    bins = group_stats(
        played.withColumn("_bin", F.struct(duration_bin(F.col("duration_s")).alias("duration_bin"))),
        ["hero_name", "_bin"],
        _wins=F.count_if(_won()),
        _rows=F.count(F.lit(1)),
        matches=F.count_distinct("match_id"),
    )
    of_hero = Window.partitionBy("hero_name")
    stats = bins.select(
        "hero_name",
        F.col("_bin.duration_bin").alias("duration_bin"),
        (F.col("_wins") / F.col("_rows")).alias("winrate"),
        "matches",
        (F.sum("_wins").over(of_hero) / F.sum("_rows").over(of_hero)).alias("hero_winrate_overall"),
        F.sum("matches").over(of_hero).alias("hero_matches_overall"),
    ).where(F.col("duration_bin").isNotNull())
    stats = stats.withColumn("delta_to_baseline", F.col("winrate") - F.col("hero_winrate_overall"))
    if heroes is not None:
        stats = filter_in(stats, "hero_name", heroes)
    if hero is not None:
        stats = stats.where(F.col("hero_name") == hero).select("hero_name", "duration_bin", "winrate", "matches")
    return stats


def winrate_deviation_wide(
    player: DataFrame, info: DataFrame, heroes: list[str], low: int = 15, high: int = 43
) -> DataFrame:
    """Deviation from the hero's overall win rate per duration bin, one column per chosen hero."""
    stats = filter_range(winrate_by_duration(player, info, heroes), "duration_bin", low, high)
    return team_wide(stats, ["duration_bin"], "delta_to_baseline", tuple(heroes), by="hero_name")


def hero_time_samples(
    player: DataFrame, player_ts: DataFrame, info: DataFrame, heroes: list[str] | None = None
) -> DataFrame:
    """Win rate and number of samples per hero and time bin."""
    if not {"team", "hero_name"} <= set(player_ts.columns):
        sides = player.select("match_id", "account_id", "team", "hero_name")
        player_ts = player_ts.join(sides, ["match_id", "account_id"], "left")
    if heroes is not None:
        player_ts = filter_in(player_ts, "hero_name", heroes)
    # samples of a player in one bin share their result: count them before the result is attached
    binned = player_ts.withColumn("time_bin_min", time_bin(F.col("timestamp_s")))
    per_match = (
        binned.dropna(subset=["hero_name", "time_bin_min"])
        .groupBy("match_id", "hero_name", "team", "time_bin_min")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    played = attach_winner(per_match, info, "left")
    wins = F.sum(F.when(_won(), F.col("_rows")).otherwise(F.lit(0)))
    return group_stats(
        played,
        ["hero_name", "time_bin_min"],
        winrate=wins / F.sum("_rows"),
        samples=F.sum("_rows").cast("bigint"),
    )


def winrate_by_gold_case(player: DataFrame, info: DataFrame, delta: float = 15000) -> DataFrame:
    """Hero win rates in percent: all matches, and with worth ``delta`` above or below the global mean."""
    mean_worth = player.agg(F.avg("net_worth")).scalar()
    played = attach_winner(player.select("match_id", "team", "hero_name", "net_worth"), info, "left")
    worth, mean = F.col("net_worth"), F.col("_mean")
    stats = masked_stats(
        played.withColumn("_mean", mean_worth),
        ["hero_name"],
        {
            "all": F.lit(True),
            "plus": F.coalesce(worth >= mean + delta, F.lit(False)),
            "minus": F.coalesce(worth <= mean - delta, F.lit(False)),
        },
        _won(),
    )
    cases = ("all", "plus", "minus")
    return stats.select(
        "hero_name",
        *[(F.col(f"mean_{c}") * 100).alias(f"winrate_{c}") for c in cases],
        *[F.col(f"samples_{c}") for c in cases],
    )


def net_income(samples: DataFrame) -> DataFrame:
    """Worth per team and time of match samples (team, time_stamp_s, net_worth); any team but 1 is team 2."""
    side = F.when(F.col("team") == 1, F.lit(1)).otherwise(F.lit(2))
    keys = [c for c in ("match_id",) if c in samples.columns]
    return samples.groupBy(*keys, side.alias("team"), F.col("time_stamp_s").cast("bigint").alias("timestamp_s")).agg(
        F.sum("net_worth").cast("bigint").alias("net_worth")
    )
