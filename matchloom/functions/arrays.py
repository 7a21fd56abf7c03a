"""Helpers for parallel list columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col(name_sql(name))


def name_sql(name: str) -> str:
    """A column name as SQL text. Long generated projections are written as text: one parse each
    instead of many column calls."""
    return "`" + name.replace("`", "``") + "`"


def text_sql(value: str) -> str:
    """A string literal as SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def without_last(values: Column) -> Column:
    """The list without its last element; lists of length 0 and 1 become empty."""
    return F.slice(values, F.lit(1), F.greatest(F.size(values) - 1, F.lit(0)))


def zip_rows(df: DataFrame, keep: list[str], lists: dict[str, str], drop_last: bool = False) -> DataFrame:
    """One row per position of the parallel ``lists`` (output name -> list column).

    Shorter lists are padded with NULL and a NULL list counts as empty, so the longest list decides.
    Each list is cut by its own length before zipping.
    """
    zipped = []
    for name, source in lists.items():
        element = df.schema[source].dataType
        values = F.coalesce(quoted(source), F.array().cast(element))
        zipped.append((without_last(values) if drop_last else values).alias(name))
    packed = df.select(*[quoted(k) for k in keep], F.struct(*zipped).alias("_lists"))
    rows = F.arrays_zip(*[F.col(f"_lists.{name}") for name in lists])
    return packed.select(*[quoted(k) for k in keep], F.inline(rows).alias(*lists))
