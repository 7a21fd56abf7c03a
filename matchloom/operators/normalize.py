"""Standardisation: fit once, apply anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.arrays import name_sql
from matchloom.operators.aggregates import mean_std
from matchloom.operators.skew import spread_join

Params = dict[str, tuple[float | None, float | None]]

INFO_FEATURES = ("total_gold",)
PLAYER_FEATURES = ("ability_points", "level", "net_worth_ratio")


def collect_params(tall: DataFrame) -> Params:
    """The (feature, mean, std) table, one row per feature, as a dict."""
    return {r["feature"]: (r["mean"], r["std"]) for r in tall.collect()}


def params_table(df: DataFrame, params: Params) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(f, m, s) for f, (m, s) in params.items()], "feature string, mean double, std double"
    )


def fit_normalizer(df: DataFrame, features: list[str], params: Params | None = None) -> Params:
    """Mean and population deviation of the features ``params`` does not name yet."""
    given = dict(params or {})
    missing = [f for f in features if f not in given]
    return given | collect_params(mean_std(df, missing)) if missing else given


def zscore(value: Column, mean: float | None, std: float | None) -> Column:
    """Standard score; NULL for a constant feature."""
    return F.try_divide(value.cast("double") - F.lit(mean).cast("double"), F.lit(std).cast("double"))


def zscore_sql(column: str, feature: str, params: Params) -> str:
    """``zscore`` of a column with a feature's parameters as SQL text."""
    mean, std = ("CAST(NULL AS DOUBLE)" if v is None else f"{v!r}D" for v in params[feature])
    return f"try_divide(CAST({name_sql(column)} AS DOUBLE) - {mean}, {std})"


def transform(df: DataFrame, features: list[str], params: Params) -> DataFrame:
    return df.withColumns({f: zscore(F.col(f), *params[f]) for f in features})


def merge_params(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union of two parameter tables; the new row wins where both name a feature."""
    return old.join(new, "feature", "left_anti").unionByName(new)


def group_total(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over the group to each of its rows.

    Sums are combined before the shuffle and joined back, and rows of a heavy group are spread, so a
    group of any size passes.
    """
    totals = df.dropna(subset=keys).groupBy(*keys).agg(F.sum(value).alias(name))
    return spread_join(df, totals, keys, "left")


def net_worth_ratio(player_ts: DataFrame) -> DataFrame:
    """Add each player's share of all worth at the same match and time."""
    totals = group_total(player_ts, ["match_id", "timestamp_s"], "net_worth", "_all")
    share = F.try_divide(F.col("net_worth").cast("double"), F.col("_all").cast("double"))
    return totals.withColumn("net_worth_ratio", share).drop("_all")


def normalize_features(
    info_ts: DataFrame, player_ts: DataFrame, params: Params | None = None
) -> tuple[DataFrame, DataFrame, Params]:
    """Standardise total gold and the player features; worth itself is replaced by its ratio."""
    params = fit_normalizer(info_ts, list(INFO_FEATURES), params)
    with_ratio = net_worth_ratio(player_ts)
    params = fit_normalizer(with_ratio, list(PLAYER_FEATURES), params)
    return (
        transform(info_ts, list(INFO_FEATURES), params),
        transform(with_ratio, list(PLAYER_FEATURES), params).drop("net_worth"),
        params,
    )
