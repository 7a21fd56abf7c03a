"""Joins and totals that stay balanced when one key holds a large share of the rows.

A join of two scanned tables is left to adaptive execution, which splits skewed partitions at run time.
Adaptive execution cannot split a side that comes straight out of an aggregation, so joins of raw rows
with per-key aggregates go through ``spread_join``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_ROWS = 5_000_000
SALTS = 64


def heavy_keys(df: DataFrame, keys: list[str], limit: int = HEAVY_ROWS) -> DataFrame:
    """Keys with more than ``limit`` rows: at most row count / ``limit`` of them, so safe to broadcast."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).select(*keys)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    limit: int = HEAVY_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join on ``keys``; rows of heavy left keys are spread over ``salts`` partitions.

    The right side holds few rows per key (an aggregate by the keys) and is repeated only for heavy keys.
    """
    heavy = F.broadcast(heavy_keys(left, keys, limit).withColumn("_heavy", F.lit(True)))
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns], F.spark_partition_id()), F.lit(salts))
    salted = (
        left.join(heavy, keys, "left")
        .withColumn("_salt", F.when(F.col("_heavy"), spread).otherwise(F.lit(0).cast("bigint")))
        .drop("_heavy")
    )
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    copies = (
        right.join(heavy, keys, "left")
        .withColumn("_salt", F.explode(F.when(F.col("_heavy"), every).otherwise(F.array(F.lit(0).cast("bigint")))))
        .drop("_heavy")
    )
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
