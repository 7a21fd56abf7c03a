"""Table profiles: non-null counts and a describe over all columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions.arrays import quoted
from matchloom.operators.ordered import range_quantiles, stored_ranges
from matchloom.session import held

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def info(df: DataFrame) -> DataFrame:
    """One row per column: name, type and number of present values."""
    counted = df.agg(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.count(quoted(f.name)).alias("non_null"),
            ).alias(f"c{i}")
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return counted.select(F.inline(F.array(*counted.columns)))


TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _as_number(field: T.StructField) -> Column:
    """A number as double, a time as seconds since 1970."""
    value = quoted(field.name)
    return value.cast("timestamp").cast("double") if isinstance(field.dataType, TIMES) else value.cast("double")


def _as_text(field: T.StructField) -> Column:
    """Text and booleans as they read, lists, maps and structures as JSON, bytes in hex."""
    value = quoted(field.name)
    if isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
        return F.when(value.isNotNull(), F.to_json(F.struct(value.alias("v"))))
    return F.hex(value) if isinstance(field.dataType, T.BinaryType) else value.cast("string")


def describe_all(df: DataFrame) -> DataFrame:
    """One row per column: count; for numbers and times mean, std and quartiles (times in seconds since
    1970, without std); for all other types unique, top and freq.

    The table is read once for the moments and once for the values of all columns with their counts, which are
    written by ranges of column and value; quartiles and most frequent values come from these.
    """
    numeric = [f for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, *TIMES))]
    others = [f for f in df.schema.fields if f not in numeric]
    if not df.schema.fields:
        raise ValueError("the table has no columns")
    cells = [F.struct(F.lit(f.name).alias("column"), _as_number(f).alias("_value"), F.lit(None).cast("string").alias("_text")) for f in numeric]
    cells += [F.struct(F.lit(f.name).alias("column"), F.lit(None).cast("double").alias("_value"), _as_text(f).alias("_text")) for f in others]
    counts = df.select(F.inline(F.array(*cells))).groupBy("column", "_value", "_text").agg(F.count(F.lit(1)).alias("_count"))
    counts = stored_ranges(counts, "column", "_value", "_text")
    parts = []
    if numeric:
        rows = [
            F.struct(
                F.lit(f.name).alias("column"),
                F.count(_as_number(f)).alias("count"),
                F.avg(_as_number(f)).alias("mean"),
                (F.lit(None).cast("double") if isinstance(f.dataType, TIMES) else F.stddev_samp(_as_number(f))).alias("std"),
                F.min(_as_number(f)).alias("min"),
                F.max(_as_number(f)).alias("max"),
            ).alias(f"c{i}")
            for i, f in enumerate(numeric)
        ]
        wide = df.agg(*rows)
        moments = wide.select(F.inline(F.array(*[F.col(c) for c in wide.columns])))
        quartiles = held(range_quantiles(counts.where(F.col("_value").isNotNull()).drop("_text"), ["column"], QUARTILES), "quartiles")
        parts.append(moments.join(quartiles, "column", "left"))
    if others:
        known = F.col("_text").isNotNull()
        parts.append(
            counts.where(F.col("column").isin([f.name for f in others])).groupBy("column").agg(
                F.coalesce(F.sum(F.when(known, F.col("_count"))), F.lit(0)).cast("bigint").alias("count"),
                F.count("_text").alias("unique"),
                F.min_by("_text", F.when(known, F.struct(-F.col("_count"), "_text"))).alias("top"),
                F.max(F.when(known, F.col("_count"))).alias("freq"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    shape = {
        "column": "string", "count": "bigint", "unique": "bigint", "top": "string", "freq": "bigint",
        "mean": "double", "std": "double", "min": "double",
        "q25": "double", "q50": "double", "q75": "double", "max": "double",
    }
    return out.select(
        *[
            (F.col(f"`{c}`") if c in out.columns else F.lit(None)).cast(kind).alias(c)
            for c, kind in shape.items()
        ]
    )
