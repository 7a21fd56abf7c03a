"""Grouped and global aggregates. All of them combine on the map side before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.columns import interval_label, whole_div
from matchloom.operators.joins import small_dim
from matchloom.operators.ordered import range_quantiles, stored_ranges, value_weights
from matchloom.schemas import TEAMS
from matchloom.session import held


def _known(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose group keys are all present; a missing key forms no group."""
    return df.dropna(subset=keys)


def team_sum(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return _known(df, keys).groupBy(*keys).agg(F.sum(value).cast("bigint").alias(value))


def team_mean(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return _known(df, keys).groupBy(*keys).agg(F.avg(value).alias(value))


def team_wide(
    df: DataFrame, index: list[str], value: str, teams: tuple[str, ...] = TEAMS, by: str = "team"
) -> DataFrame:
    """One column per team. Two rows for one cell are an error."""
    cells = _known(df, [*index, by]).groupBy(*index)

    def cell(team: str) -> Column:
        here = F.col(by) == team
        return F.when(
            F.count_if(here) > 1, F.raise_error(F.lit(f"more than one row for {team} in one cell"))
        ).otherwise(F.max(F.when(here, F.col(value))))

    return cells.agg(*[cell(t).cast(df.schema[value].dataType).alias(t) for t in teams])


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Rows per value, most frequent first."""
    counted = _known(df, [column]).groupBy(column).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.desc(name), column)


def top_n(df: DataFrame, by: list[str], n: int, descending: bool = True) -> DataFrame:
    """First ``n`` rows; the first column of ``by`` sorts by ``descending``, the rest break ties."""
    first = F.desc(by[0]) if descending else F.asc(by[0])
    return df.orderBy(first, *by[1:]).limit(n)


def sort(df: DataFrame, columns: list[str], ascending: bool | list[bool] = True) -> DataFrame:
    return df.orderBy(*columns, ascending=ascending)


def head(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def distinct_count(df: DataFrame, keys: list[str], column: str, name: str = "n") -> DataFrame:
    """Different values per group, or of the whole table when there are no keys."""
    rows = _known(df, keys) if keys else df
    return rows.groupBy(*keys).agg(F.count_distinct(column).alias(name))


def group_stats(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    return _known(df, keys).groupBy(*keys).agg(*[c.alias(n) for n, c in aggregates.items()])


def summary(df: DataFrame, **aggregates: Column) -> DataFrame:
    """One row of global aggregates."""
    return df.agg(*[c.alias(n) for n, c in aggregates.items()])


def masked_stats(df: DataFrame, keys: list[str], masks: dict[str, Column], value: Column) -> DataFrame:
    """Mean of ``value`` and number of rows under each mask; no rows give NULL and 0."""
    return _known(df, keys).groupBy(*keys).agg(
        *[F.avg(F.when(m, value.cast("double"))).alias(f"mean_{n}") for n, m in masks.items()],
        *[F.count_if(m).alias(f"samples_{n}") for n, m in masks.items()],
    )


def mean_std(df: DataFrame, features: list[str]) -> DataFrame:
    """Tall table (feature, mean, std) with the population deviation."""
    wide = df.agg(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                F.avg(f).cast("double").alias("mean"),
                F.stddev_pop(f).alias("std"),
            ).alias(f)
            for f in features
        ]
    )
    return wide.select(F.inline(F.array(*[F.col(f) for f in features])))


def average_metrics(runs: DataFrame, with_values: bool = False) -> DataFrame:
    """Mean and population deviation per model and metric over the runs (run, model, metric, value).

    ``with_values`` adds the list of single values, for tables with a handful of runs.
    """
    grouped = [F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("runs")]
    if with_values:
        ordered = F.sort_array(F.collect_list(F.struct("run", "value")))
        grouped.append(F.transform(ordered, lambda r: r["value"]).alias("values"))
    return runs.groupBy("model", "metric").agg(*grouped)


def last_per_group(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Last row per group by ``order``; the other columns break ties, largest first."""
    rest = [c for c in df.columns if c not in (*keys, order)]
    packed = df.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("_last"))
    return packed.select(*keys, "_last.*").select(*df.columns)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed; empty bins are kept."""
    bounds = df.agg(F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high"))
    # equal bounds get one unit around the value
    flat = F.col("high") == F.col("low")
    frame = bounds.where(F.col("low").isNotNull()).select(
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        (F.when(flat, F.lit(1.0)).otherwise(F.col("high") - F.col("low")) / bins).alias("width"),
    )
    edge = frame.select(F.struct("low", "width")).scalar()
    counted = (
        df.where(F.col(column).isNotNull())
        .withColumn("_edge", edge)
        .select(
            F.least(
                F.floor((F.col(column) - F.col("_edge.low")) / F.col("_edge.width")), F.lit(bins - 1)
            ).alias("bin")
        )
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    edges = frame.select("low", "width", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return edges.withColumn("bin", F.col("bin").cast("bigint")).join(counted, "bin", "left").select(
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("low"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("high"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
    )


def histograms(df: DataFrame, by: str, column: str, bins: dict[str, int]) -> DataFrame:
    """``histogram`` for each group that ``bins`` names with its number of bins, as (by, bin, low, high, count).

    ``df`` is a stored table: one pass finds all bounds, which are written (a row a group), one more counts.
    """
    number = F.element_at(F.create_map(*[F.lit(x) for pair in bins.items() for x in pair]), F.col(by))
    known = df.where(F.col(column).isNotNull() & F.col(by).isin(list(bins))).select(by, F.col(column).alias("_v"))
    low, high = F.min("_v").cast("double"), F.max("_v").cast("double")
    bounds = known.groupBy(by).agg(low.alias("_low"), high.alias("_high"), number.alias("_bins"))
    flat = F.col("_low") == F.col("_high")  # equal bounds get one unit around the value
    width = F.when(flat, F.lit(1.0)).otherwise(F.col("_high") - F.col("_low")) / F.col("_bins")
    frame = bounds.select(by, F.when(flat, F.col("_low") - 0.5).otherwise(F.col("_low")).alias("_low"), width.alias("_width"), "_bins")
    frame = small_dim(held(frame, "bounds"))
    place = F.least(F.floor((F.col("_v") - F.col("_low")) / F.col("_width")), F.col("_bins") - 1)
    counted = known.join(frame, by).groupBy(by, place.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edges = frame.select(by, "_low", "_width", F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col("_bins") - 1).cast("bigint"))).alias("bin"))
    return edges.join(counted, [by, "bin"], "left").select(
        by,
        "bin",
        (F.col("_low") + F.col("bin") * F.col("_width")).alias("low"),
        (F.col("_low") + (F.col("bin") + 1) * F.col("_width")).alias("high"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
    )


def fixed_histogram(df: DataFrame, column: str, width: int, drop_top_edge: bool = True) -> DataFrame:
    """Half-open bins of fixed width from 0 up to the maximum, empty bins kept.

    With ``drop_top_edge`` a maximum on a bin edge falls out of the last bin; without it one more
    bin takes it.
    """
    counted = (
        df.where(F.col(column) >= 0)
        .groupBy(whole_div(F.col(column), width).alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    # the first bin edge at or above the maximum ends the bins
    top = whole_div(F.max(column) + (width - 1), width)
    if not drop_top_edge:
        top = whole_div(F.max(column), width) + 1
    ends = df.agg(top.alias("top")).where(F.col("top") > 0)
    bins = ends.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("top") - 1)).alias("bin"))
    low, high = F.col("bin") * width, (F.col("bin") + 1) * width
    return bins.join(counted, "bin", "left").select(
        interval_label(low, high).alias("label"),
        low.alias("low"),
        high.alias("high"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
    )


def box_stats(df: DataFrame, column: str, by: str) -> DataFrame:
    """Quartiles and whiskers (outermost values within 1.5 interquartile ranges) per group."""
    counts = stored_ranges(value_weights(df, [by], column), by, "_value")
    quartiles = held(range_quantiles(counts, [by], {"q1": 0.25, "median": 0.5, "q3": 0.75}), "quartiles")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    near = F.col("_value").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        counts.join(small_dim(quartiles), by)
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.sum("_count").alias("n"),
            F.min(F.when(near, F.col("_value"))).cast("double").alias("whisker_low"),
            F.max(F.when(near, F.col("_value"))).cast("double").alias("whisker_high"),
            F.sum(F.when(near, F.lit(0)).otherwise(F.col("_count"))).alias("outliers"),
        )
    )
