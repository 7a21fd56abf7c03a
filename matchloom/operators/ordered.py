"""Ranks, running sums and exact quantiles over whole tables without a single-task window.

Rows are first reduced to distinct values, then dealt out by range, numbered by range and written once. The totals
of the ranges give the offsets (a row a range and group), and only rows within one range are ordered against each
other. Ranges follow the size of the data: Spark samples their bounds and merges small ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.session import held

DIGEST_DIGITS = 4


def digest(seed: int, keys: list[str]) -> Column:
    """A fixed pseudo-random text per key: hex md5 of the seed and the key columns."""
    return F.md5(F.concat_ws("|", F.lit(seed).cast("string"), *[F.col(k).cast("string") for k in keys]))


def stored_ranges(df: DataFrame, *order: str) -> DataFrame:
    """``df`` dealt out by ranges of ``order``, written, with ``_bucket``, the number of a row's range.

    Equal rows are in one range, and a lower range holds lower rows.
    """
    return held(df.repartitionByRange(*order).withColumn("_bucket", F.spark_partition_id()), "ranges")


def bucket_spans(bucketed: DataFrame, by: list[str], weight: Column) -> DataFrame:
    """Per group and bucket: weight before the bucket (``_start``), its end and the group total."""
    totals = bucketed.groupBy(*by, "_bucket").agg(F.sum(weight).alias("_weight"))
    group = Window.partitionBy(*by)
    ordered = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return totals.select(
        *by,
        "_bucket",
        F.sum("_weight").over(ordered).alias("_end"),
        (F.sum("_weight").over(ordered) - F.col("_weight")).alias("_start"),
        F.sum("_weight").over(group).alias("_total"),
    )


def value_weights(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """Rows per group and value as (by, _value, _count), NULL values and NULL groups left out."""
    present = df.dropna(subset=[*by, column])
    return present.groupBy(*by, F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_count"))


def exact_quantiles(df: DataFrame, by: list[str], column: str, probs: dict[str, float]) -> DataFrame:
    """Interpolated quantiles per group (name -> probability), one row per group.

    Equal to sorting each group whole and interpolating linearly between the two neighbours.
    """
    return weighted_quantiles(value_weights(df, by, column), by, probs)


def weighted_quantiles(counts: DataFrame, by: list[str], probs: dict[str, float]) -> DataFrame:
    """``exact_quantiles`` of a table from ``value_weights``."""
    return range_quantiles(stored_ranges(counts, *by, "_value"), by, probs)


def range_quantiles(bucketed: DataFrame, by: list[str], probs: dict[str, float]) -> DataFrame:
    """``weighted_quantiles`` of counts that ``stored_ranges`` has written."""
    wanted = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("p")) for n, p in probs.items()])
    position = F.col("_want.p") * (F.col("_total") - 1)
    targets = (
        bucket_spans(bucketed, by, F.col("_count"))
        .withColumn("_want", F.explode(wanted))
        .select(
            *by,
            "_bucket",
            "_start",
            F.col("_want.name").alias("_name"),
            position.alias("_pos"),
            F.floor(position).alias("_low"),
            F.ceil(position).alias("_high"),
            "_end",
        )
        .where(
            ((F.col("_low") >= F.col("_start")) & (F.col("_low") < F.col("_end")))
            | ((F.col("_high") >= F.col("_start")) & (F.col("_high") < F.col("_end")))
        )
    )
    spans = targets.groupBy(*by, "_bucket").agg(
        F.first("_start").alias("_start"),
        F.collect_list(F.struct("_name", "_pos", "_low", "_high")).alias("_targets"),
    )
    within = (
        Window.partitionBy(*by, "_bucket")
        .orderBy("_value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = (
        bucketed.join(spans, [*by, "_bucket"])
        .withColumn("_upto", F.col("_start") + F.sum("_count").over(within))
        .withColumn("_from", F.col("_upto") - F.col("_count"))
    )

    def covers(rank: Column) -> Column:
        return (rank >= F.col("_from")) & (rank < F.col("_upto"))

    hits = (
        ranked.select(*by, "_value", "_from", "_upto", F.explode("_targets").alias("_t"))
        .where(covers(F.col("_t._low")) | covers(F.col("_t._high")))
        .groupBy(*by, F.col("_t._name").alias("_name"))
        .agg(
            F.max("_t._pos").alias("_pos"),
            F.max("_t._low").alias("_low"),
            F.max(F.when(covers(F.col("_t._low")), F.col("_value"))).cast("double").alias("_below"),
            F.max(F.when(covers(F.col("_t._high")), F.col("_value"))).cast("double").alias("_above"),
        )
        .withColumn("_q", F.col("_below") + (F.col("_pos") - F.col("_low")) * (F.col("_above") - F.col("_below")))
    )
    return hits.groupBy(*by).agg(
        *[F.max(F.when(F.col("_name") == name, F.col("_q"))).alias(name) for name in probs]
    )


def rank_cuts(units: DataFrame, by: list[str], ranks: dict[str, Column], per_group: DataFrame | None = None) -> DataFrame:
    """The digest at given ranks of each group: one row per group and name, column ``bound``.

    ``units`` holds ``_digest`` and the group columns (a few class labels, or none); ``ranks`` are
    1-based and may use ``_total``, the size of the group, and the columns of ``per_group`` (one row per
    group). A rank of 0 gives no row. Only the digest prefix is counted over the whole table; rows are ordered inside the one bucket a rank falls into.
    """
    bucketed = units.select(*by, "_digest", F.substring("_digest", 1, DIGEST_DIGITS).alias("_bucket"))
    wanted = F.array(*[F.struct(F.lit(n).alias("name"), r.cast("bigint").alias("rank")) for n, r in ranks.items()])
    rank = F.col("_want.rank")
    spans = bucket_spans(bucketed, by, F.lit(1))
    spotted = (
        (spans if per_group is None else spans.join(per_group, by))
        .withColumn("_want", F.explode(wanted))
        .where((rank > F.col("_start")) & (rank <= F.col("_end")))
        .select(*by, "_bucket", F.col("_want.name").alias("name"), (rank - F.col("_start")).alias("_nth"))
    )
    keys = [*by, "_bucket"]
    in_bucket = Window.partitionBy(*keys).orderBy("_digest")
    found = spotted.select(*keys).distinct()
    if not by:  # one row per name
        spotted, found = F.broadcast(spotted), F.broadcast(found)
    near = bucketed.join(found, keys, "left_semi")
    return (
        near.withColumn("_row", F.row_number().over(in_bucket))
        .join(spotted, keys)
        .where(F.col("_row") == F.col("_nth"))
        .select(*by, "name", F.col("_digest").alias("bound"))
    )
