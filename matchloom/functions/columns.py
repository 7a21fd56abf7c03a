"""Scalar column functions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_div(value: Column, by: int) -> Column:
    """Integer division that truncates, as bigint."""
    return F.call_function("div", value.cast("bigint"), F.lit(by))


def badge_linear(badge: Column) -> Column:
    """Tier and subtier (tier * 10 + subtier) on one linear scale with six steps per tier."""
    return whole_div(badge, 10) * 6 + (badge % 10)


def badge_distance(left: Column, right: Column) -> Column:
    return F.abs(badge_linear(left) - badge_linear(right))


def duration_bin(seconds: Column) -> Column:
    """Three-minute bin of a match duration, named by its first minute."""
    return whole_div(seconds, 180) * 3


def time_bin(seconds: Column) -> Column:
    """Three-minute bins before 900 s, five-minute bins from there on."""
    return F.when(seconds < 900, whole_div(seconds, 180) * 3).otherwise(15 + whole_div(seconds - 900, 300) * 5)


def lead_team(diff: Column) -> Column:
    """Team0 when the difference is positive, Team1 otherwise (ties and missing values too)."""
    return F.when(diff > 0, F.lit("Team0")).otherwise(F.lit("Team1"))


def same_team(team: Column, winner: Column) -> Column:
    """True where the team won; a missing result counts as lost."""
    return F.coalesce(team == winner, F.lit(False))


def rate(flag: Column) -> Column:
    """Share of rows where the flag is set."""
    return F.avg(flag.cast("double"))


def pct_of_larger(left: Column, right: Column) -> Column:
    """Difference in percent of the larger side; NULL where that side is zero or one is missing."""
    return F.try_divide((left - right).cast("double"), F.greatest(left, right).cast("double")) * 100


def team_number(team: Column) -> Column:
    """0 or 1 for the two team names, NULL for anything else."""
    return F.when(team == "Team0", F.lit(0)).when(team == "Team1", F.lit(1))


def interval_label(low_s: Column, high_s: Column) -> Column:
    """Label of a duration interval in whole minutes."""
    return F.format_string("%d–%d min", whole_div(low_s, 60), whole_div(high_s, 60))


def minutes(seconds: Column) -> Column:
    return seconds.cast("double") / 60


def sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def file_number(name: Column) -> Column:
    """Number between the last underscore and the first dot of a file name; NULL if it is none."""
    stem = F.split_part(name, F.lit("."), F.lit(1))
    return F.element_at(F.split(stem, "_"), -1).try_cast("bigint")


def utc_instant(text: Column) -> Column:
    """Parse ``2025-01-31 12:00:00.5 +0100 UTC``; the trailing zone name is ignored."""
    stamp = F.regexp_replace(F.trim(text), " UTC$", "")
    return F.coalesce(
        F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HH:mm:ss.[SSSSSSSSS][SSSSSS][SSS][SS][S] Z")),
        F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HH:mm:ss Z")),
    )
