"""Team and hero encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions.arrays import name_sql, text_sql


def replace_column(df: DataFrame, column: str, value: Column) -> DataFrame:
    """The same columns in the same order, one of them recomputed."""
    return df.select(*[value.alias(c) if c == column else F.col(f"`{c}`") for c in df.columns])


def encode_team(df: DataFrame, column: str) -> DataFrame:
    """Team name as 0/1 (1 = Team1); NULL stays NULL and numbers pass through."""
    if isinstance(df.schema[column].dataType, (T.StringType, T.VarcharType, T.CharType)):
        return replace_column(df, column, (F.col(column) == "Team1").cast("int"))
    return replace_column(df, column, F.col(column).cast("int"))


def known_category(column: str, categories: list[str]) -> Column:
    """The column itself; a value outside ``categories`` (NULL too) stops the job."""
    known = F.coalesce(F.col(column).isin(list(categories)), F.lit(False))
    problem = F.concat(F.lit(f"unknown category in {column}: "), F.coalesce(F.col(column), F.lit("NULL")))
    return F.when(known, F.col(column)).otherwise(F.raise_error(problem))


def one_hot_sql(column: str, categories: list[str]) -> list[str]:
    """SQL of one 0.0/1.0 column per category."""
    return [
        f"CASE WHEN {name_sql(column)} = {text_sql(c)} THEN 1D ELSE 0D END AS {name_sql(f'{column}_{c}')}"
        for c in categories
    ]


def one_hot(df: DataFrame, column: str, categories: list[str], on_unknown: str = "error") -> DataFrame:
    """Replace ``column`` by one 0.0/1.0 column per category, in the order given.

    ``on_unknown`` is ``error``, or ``ignore`` for a row of zeros.
    """
    if on_unknown not in ("error", "ignore"):
        raise ValueError(f"on_unknown must be error or ignore, not {on_unknown}")
    rest = [name_sql(c) for c in df.columns if c != column]
    checked = df.withColumn(column, known_category(column, categories)) if on_unknown == "error" else df
    return checked.selectExpr(*rest, *one_hot_sql(column, categories))
