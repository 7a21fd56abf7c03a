"""From raw match files to the training table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession

from matchloom.functions.arrays import quoted
from matchloom.operators.features import feature_matrix, fit_wide
from matchloom.operators.filters import (
    filter_matches_eligible,
    funnel_rows,
    keep_matching,
    kept_ids,
    players_of,
)
from matchloom.operators.joins import replace_hero_ids_with_names
from matchloom.operators.normalize import Params
from matchloom.operators.series import split_general_timestamp
from matchloom.schemas import FILTER_ONLY, MATCH_INFO, MATCH_PLAYER
from matchloom.sources.tables import load_dim_list, save_params, scan_numbered, scan_parquet, write_bucketed, write_stage


@dataclass(frozen=True)
class Selection:
    """Which matches to keep. The defaults are the fixed values of the standard run."""

    start: datetime = datetime(2025, 10, 25, 0, 54, 51, tzinfo=timezone.utc)
    end: datetime = datetime(2025, 11, 21, 21, 53, 12, tzinfo=timezone.utc)
    min_badge: int = 101
    max_disparity: int = 2
    leniency_s: int = 70


def store_matches(
    info: DataFrame, player: DataFrame, heroes: DataFrame, chosen: Selection, out: str, seen: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """Filtered info rows and filtered player rows with hero names, written below ``out`` and read back.

    Both are written in the same buckets of match ids: what joins or groups them by match later on needs no shuffle.
    The stored info rows carry the kept ids, so the wide player table is scanned once for its rows and
    once, two columns only, for the verdicts. ``seen`` counts the steps of the filter while the info rows are written.
    """
    eligible = filter_matches_eligible(info, chosen.start, chosen.end, chosen.min_badge, chosen.max_disparity)
    kept = keep_matching(eligible, kept_ids(eligible, player, chosen.leniency_s, seen), "match_id").drop(*FILTER_ONLY)
    stored_info = write_bucketed(kept, f"{out}/kept_info", "match_id")
    own = players_of(player, stored_info, stored_info.count())  # counted from the files' footers
    named = replace_hero_ids_with_names(own, heroes)
    return stored_info, write_bucketed(named, f"{out}/kept_player", "match_id")


def prepare(
    spark: SparkSession,
    folder: str,
    heroes_path: str,
    out: str,
    id_range: range = range(45, 48),
    chosen: Selection = Selection(),
) -> tuple[DataFrame, Params]:
    """Write the stage tables, the parameters and the training table below ``out``.

    The filtered matches are written once and read back, so the stage tables, the fit and the training
    table start from them and not from the raw files.
    """
    heroes, seen = scan_parquet(spark, heroes_path), Observation()
    info, player = store_matches(
        scan_numbered(spark, folder, "match_info", id_range).select(*[quoted(n) for n in MATCH_INFO.names]),
        scan_numbered(spark, folder, "match_player", id_range).select(*[quoted(n) for n in MATCH_PLAYER.names]),
        heroes,
        chosen,
        out,
        seen,
    )
    write_stage(funnel_rows(spark, seen), f"{out}/filter_funnel")
    for name, table in split_general_timestamp(info, player)._asdict().items():
        write_stage(table, f"{out}/match_{name}")
    params = fit_wide(player, info)
    save_params(player, params, f"{out}/normalization_params")
    matrix = feature_matrix(player, info, load_dim_list(heroes), params, placed=True)
    return write_stage(matrix, f"{out}/training_dataframe"), params
