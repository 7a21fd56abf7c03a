"""Eligibility of matches and the pruning that follows from player rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions.columns import badge_distance

MATCH_PLAYERS = 12


def _bound(kind: T.DataType, moment: datetime, naive_zone: str) -> Column:
    if moment.tzinfo is None:
        raise ValueError("time bounds must carry a zone")
    if isinstance(kind, T.TimestampNTZType):
        wall = moment.astimezone(ZoneInfo(naive_zone)).replace(tzinfo=None)
        return F.lit(wall.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(moment.astimezone(timezone.utc).isoformat()).cast("timestamp")


def filter_matches_eligible(
    info: DataFrame,
    start: datetime,
    end: datetime,
    min_badge: int,
    max_disparity: int,
    min_duration: int = 480,
    naive_zone: str = "UTC",
) -> DataFrame:
    """Scored, rewarded matches of regular players in the time window (both ends included).

    A NULL flag fails its test. ``naive_zone`` tells how to read start times stored without a zone.
    """
    kind = info.schema["start_time"].dataType
    return info.where(
        F.col("start_time").between(_bound(kind, start, naive_zone), _bound(kind, end, naive_zone))
        & (F.col("duration_s") >= min_duration)
        & F.col("rewards_eligible")
        & ~F.col("not_scored")
        & ~F.col("is_high_skill_range_parties")
        & ~F.col("low_pri_pool")
        & ~F.col("new_player_pool")
        & (F.col("average_badge_team0") >= min_badge)
        & (F.col("average_badge_team1") >= min_badge)
        & (badge_distance(F.col("average_badge_team0"), F.col("average_badge_team1")) <= max_disparity)
    )


def filter_in(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def filter_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Rows with ``low <= column <= high``; an end left out is open."""
    if low is not None:
        df = df.where(F.col(column) >= F.lit(low))
    if high is not None:
        df = df.where(F.col(column) <= F.lit(high))
    return df


def filter_not(df: DataFrame, mask: Column) -> DataFrame:
    """Rows where the mask is not true; an unknown mask counts as false."""
    return df.where(~F.coalesce(mask, F.lit(False)))


def empty_guard(df: DataFrame, message: str = "nothing found") -> DataFrame:
    """Tell the caller when there is no row; the (empty) table keeps its schema."""
    if df.isEmpty():
        print(message)
    return df


def null_audit(df: DataFrame) -> DataFrame:
    """Number of missing values in all columns together."""
    per_column = [F.count(F.lit(1)) - F.count(F.col(f"`{name}`")) for name in df.columns]
    total = per_column[0]
    for count in per_column[1:]:
        total = total + count
    return df.agg(total.cast("bigint").alias("missing_values"))


def keep_matching(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``."""
    return left.join(right, on, "left_semi")


BITS_PER_KEY, HASHES, MOST_BITS = 12, 4, 1 << 25


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(bits)) for k in range(HASHES)]


def key_filter(ids: DataFrame, key: str, expected: int) -> Callable[[Column], Column] | None:
    """A test that every key of ``ids`` passes and hardly any other, or None for too many keys to tell apart.

    A Bloom filter of ``BITS_PER_KEY`` bits a key, at most ``MOST_BITS`` (4 MB), worked out by Spark once per query as a scalar
    subquery. It stands in a filter of the scan, so other rows never reach a shuffle.
    """
    bits = 1 << 10
    while bits < expected * BITS_PER_KEY and bits < MOST_BITS:
        bits *= 2
    if expected * 4 > bits:
        return None
    spots = ids.where(F.col(key).isNotNull()).select(F.explode(F.array(*_places(F.col(key), bits))).alias("_spot"))
    mine = spots.groupBy(F.expr("_spot div 64").alias("_word")).agg(F.expr("bit_or(shiftleft(1L, cast(_spot % 64 as int)))").alias("_bits"))
    every = ids.sparkSession.range(bits // 64).join(mine, F.col("id") == F.col("_word"), "left")
    cells = F.sort_array(F.collect_list(F.struct("id", F.coalesce("_bits", F.lit(0)).alias("bits"))))
    words = every.agg(F.transform(cells, lambda c: c["bits"]).alias("words")).scalar()

    def test(column: Column) -> Column:
        held = F.lit(True)
        for spot in _places(column, bits):
            held &= F.bit_get(F.get(words, F.floor(spot / 64).cast("int")), (spot % 64).cast("int")) == 1
        return held

    return test


def drop_matching(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``; rows without a key go too."""
    keys = [on] if isinstance(on, str) else list(on)
    return left.dropna(subset=keys).join(right, keys, "left_anti")


def complete_matches(player: DataFrame, n: int = MATCH_PLAYERS) -> DataFrame:
    """Ids of the matches with exactly ``n`` player rows."""
    counted = player.where(F.col("match_id").isNotNull()).groupBy("match_id").agg(F.count(F.lit(1)).alias("_n"))
    return counted.where(F.col("_n") == n).select("match_id")


def _first_leave() -> Column:
    return F.min(F.when(F.col("abandon_match_time_s") > 0, F.col("abandon_match_time_s")))


def early_leavers(player: DataFrame, info: DataFrame, leniency_s: int = 70) -> DataFrame:
    """Ids of the matches someone left more than ``leniency_s`` before the end.

    The earliest leaver and the longest duration decide, so both sides are reduced to one row per
    match before they meet.
    """
    left_at = (
        player.where(F.col("abandon_match_time_s") > 0).groupBy("match_id").agg(_first_leave().alias("_left_at"))
    )
    ended = info.groupBy("match_id").agg(F.max("duration_s").alias("_end"))
    return left_at.join(ended, "match_id").where(F.col("_end") - F.col("_left_at") > leniency_s).select("match_id")


def match_verdicts(
    eligible: DataFrame, player: DataFrame, leniency_s: int = 70, n: int = MATCH_PLAYERS
) -> DataFrame:
    """One row per eligible match: info rows, player rows, complete?, left early?

    Reads only the id and the leaving time of the player table, and reduces both before the join.
    """
    per_match = player.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("n_players"), _first_leave().alias("_left_at")
    )
    ended = eligible.groupBy("match_id").agg(F.count(F.lit(1)).alias("n_info"), F.max("duration_s").alias("_end"))
    return ended.join(per_match, "match_id", "left").select(
        "match_id",
        "n_info",
        F.coalesce("n_players", F.lit(0)).cast("bigint").alias("n_players"),
        F.coalesce(F.col("n_players") == n, F.lit(False)).alias("complete"),
        F.coalesce(F.col("_end") - F.col("_left_at") > leniency_s, F.lit(False)).alias("left_early"),
    )


def filter_funnel(verdicts: DataFrame) -> DataFrame:
    """Match and player rows after each step of ``filter_matches``, counted in one pass."""
    complete = F.col("complete") & F.col("match_id").isNotNull()
    steps = {
        "prefiltered": F.lit(True),
        "complete": complete,
        "without_leavers": complete & ~F.col("left_early"),
    }

    def total(column: str, keep: Column) -> Column:
        return F.coalesce(F.sum(F.when(keep, F.col(column))), F.lit(0)).cast("bigint")

    counted = verdicts.agg(
        *[
            F.struct(
                F.lit(step).alias("stage"),
                total("n_info", keep).alias("matches"),
                total("n_players", keep).alias("player_rows"),
            ).alias(step)
            for step, keep in steps.items()
        ]
    )
    return counted.select(F.inline(F.array(*steps)))


def observed_funnel(verdicts: DataFrame, seen: Observation) -> DataFrame:
    """``verdicts``, counted for ``funnel_rows`` while another job reads them to the end."""
    complete = F.col("complete") & F.col("match_id").isNotNull()
    steps = {"prefiltered": F.lit(True), "complete": complete, "without_leavers": complete & ~F.col("left_early")}
    counts = [
        F.coalesce(F.sum(F.when(keep, F.col(column))), F.lit(0)).cast("bigint").alias(f"{step}|{name}")
        for step, keep in steps.items()
        for column, name in (("n_info", "matches"), ("n_players", "player_rows"))
    ]
    return verdicts.observe(seen, *counts)


def funnel_rows(spark: SparkSession, seen: Observation) -> DataFrame:
    """The rows of ``filter_funnel`` from what was counted on the way."""
    counts: dict[str, dict[str, int]] = {}
    for name, value in seen.get.items():
        step, _, column = name.partition("|")
        counts.setdefault(step, {})[column] = value
    rows = [(step, c["matches"], c["player_rows"]) for step, c in counts.items()]
    return spark.createDataFrame(rows, "stage string, matches bigint, player_rows bigint")


def kept_ids(eligible: DataFrame, player: DataFrame, leniency_s: int = 70, seen: Observation | None = None) -> DataFrame:
    """Ids of the eligible matches that are complete and that nobody left early; ``seen`` counts the steps on the way."""
    verdicts = match_verdicts(eligible, player, leniency_s)
    verdicts = verdicts if seen is None else observed_funnel(verdicts, seen)
    return verdicts.where(F.col("complete") & ~F.col("left_early")).select("match_id")


FILTER_FROM = 1_000_000  # ids; about what Spark broadcasts by itself


def players_of(player: DataFrame, kept: DataFrame, expected: int | None = None, filter_from: int = FILTER_FROM) -> DataFrame:
    """Player rows of the kept matches, without the leaving time.

    The player side of the join is a scan, so adaptive execution may split a match id with many rows. Where
    ``expected``, the number of kept matches, is beyond a broadcast, a filter of their ids keeps other rows from the shuffle.
    """
    if expected is not None and expected > filter_from:
        held = key_filter(kept, "match_id", expected)
        player = player.where(held(F.col("match_id"))) if held else player
    return keep_matching(player, kept.select("match_id"), "match_id").drop("abandon_match_time_s")


def filter_matches(
    info: DataFrame,
    player: DataFrame,
    start: datetime,
    end: datetime,
    min_badge: int,
    max_disparity: int,
    leniency_s: int = 70,
    min_duration: int = 480,
    hold: Callable[[DataFrame], DataFrame] = lambda ids: ids,
) -> tuple[DataFrame, DataFrame]:
    """Info and player rows of eligible, complete matches that nobody left early.

    Both results need the kept ids. ``hold`` may write them and give them back as a scan, so that the
    verdicts are worked out once.
    """
    eligible = filter_matches_eligible(info, start, end, min_badge, max_disparity, min_duration)
    kept = hold(kept_ids(eligible, player, leniency_s))
    return keep_matching(eligible, kept, "match_id"), players_of(player, kept)
