"""Parquet and JSON sources and sinks."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions.arrays import name_sql
from matchloom.operators.joins import DIM_ROWS
from matchloom.operators.normalize import Params, collect_params, params_table
from matchloom.schemas import MATCH_JSON, require_columns


def scan_numbered(
    spark: SparkSession, folder: str, prefix: str, id_range: range, schema: T.StructType | None = None
) -> DataFrame:
    """The files ``prefix_{i}.parquet`` that exist for the given numbers; none at all is an error.

    The numbers are alternatives of one path pattern, so the folder is listed once and other files stay unopened.
    """
    if not len(id_range):
        raise FileNotFoundError(f"no {prefix} file asked for in {folder}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(f"{folder}/{prefix}_{{{','.join(map(str, id_range))}}}.parquet")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no {prefix} file for {id_range} in {folder}") from missing


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def point_lookup(spark: SparkSession, path: str, value: int, column: str = "match_id") -> DataFrame:
    """All columns of one match; the predicate reaches the Parquet row groups.

    In a table from ``write_sorted`` all groups but those of the value are skipped by their bounds or their filters.
    """
    return spark.read.parquet(path).where(F.col(column) == value)


def write_sorted(df: DataFrame, path: str, column: str, group_bytes: int = 8 << 20, different: int = 100_000) -> DataFrame:
    """Write for look-ups by ``column``: files hold ranges of it, rows are in its order, and each row group of about
    ``group_bytes`` has its bounds and a Bloom filter for up to ``different`` values."""
    writer = df.repartitionByRange(column).sortWithinPartitions(column).write.mode("overwrite")
    options = {
        f"parquet.bloom.filter.enabled#{column}": "true",
        f"parquet.bloom.filter.expected.ndv#{column}": str(different),
        "parquet.block.size": str(group_bytes),
    }
    writer.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_dim_list(dim: DataFrame, column: str = "name", order: str = "id", max_rows: int = DIM_ROWS) -> list:
    """One column of a small dimension as a list, ordered by ``order``."""
    rows = require_columns(dim, column, order).orderBy(order).select(column).limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"the dimension has more than {max_rows} rows")
    return [r[0] for r in rows]


class CheckedDocuments(NamedTuple):
    """Samples of the sound documents, and the others as they came with the reasons against them."""

    samples: DataFrame
    rejected: DataFrame


def scan_match_json(spark: SparkSession, path: str) -> DataFrame:
    """Match documents, one a line, to samples (team, time_stamp_s, net_worth); a broken line is an error.

    ``check_match_json`` of the same lines parts the broken ones off instead.
    """
    return parse_match_json(spark.read.text(path), "value")


def parse_match_json(df: DataFrame, column: str) -> DataFrame:
    """The samples of documents held as text in ``column``, the other columns beside them; a broken document is an error."""
    rest = [c for c in df.columns if c != column]
    judged = _with_reasons(df, column)
    broken = F.concat(F.lit("a broken document: "), F.array_join("_reasons", ", "))
    sound = F.when(F.size("_reasons") == 0, F.col("_doc")).otherwise(F.raise_error(broken))
    return match_samples(judged.select(*rest, sound.alias("_doc")).select(*rest, "_doc.match_info"))


def check_match_json(df: DataFrame, column: str) -> CheckedDocuments:
    """The same without stopping: broken documents come out whole, with all that is wrong with them."""
    rest = [c for c in df.columns if c != column]
    judged = _with_reasons(df, column)
    samples = match_samples(judged.where(F.size("_reasons") == 0).select(*rest, "_doc.match_info"))
    return CheckedDocuments(samples, judged.where(F.size("_reasons") > 0).select(*df.columns, F.col("_reasons").alias("reasons")))


def _with_reasons(df: DataFrame, column: str) -> DataFrame:
    """``df`` with the parsed document and what is wrong with it. Missing text, text that is no document of the known types,
    missing parts, and time stamps that are no whole numbers count."""
    kind = T.StructType([*MATCH_JSON.fields, T.StructField("_broken", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    document = F.when(F.trim(column) != "", F.from_json(column, kind, options))
    players = F.col("_doc.match_info.players")
    every = F.flatten(F.transform(players, lambda p: F.coalesce(p["stats"], F.array())))
    whole = lambda s: s["time_stamp_s"].try_cast("bigint")
    parsed = F.col("_doc").isNotNull() & F.col("_doc._broken").isNull()
    reasons = {
        "no document": F.col("_doc").isNull(),
        "not of the known form": F.col("_doc._broken").isNotNull(),
        "no match_info": parsed & F.col("_doc.match_info").isNull(),
        "no players": parsed & F.col("_doc.match_info").isNotNull() & players.isNull(),
        "a player without team": parsed & F.exists(players, lambda p: p["team"].isNull()),
        "a player without stats": parsed & F.exists(players, lambda p: p["stats"].isNull()),
        "a time stamp that is no whole number": parsed & F.exists(every, lambda s: whole(s).isNull()),
        "a sample without net worth": parsed & F.exists(every, lambda s: s["net_worth"].isNull()),
    }
    found = F.array_compact(F.array(*[F.when(wrong, F.lit(name)) for name, wrong in reasons.items()]))
    return df.withColumn("_doc", document).withColumn("_reasons", found)


def match_samples(documents: DataFrame) -> DataFrame:
    rest = [c for c in documents.columns if c != "match_info"]
    players = documents.select(*rest, F.inline("match_info.players"))
    samples = players.select(*rest, "team", F.inline("stats"))
    return samples.select(*rest, "team", F.col("time_stamp_s").cast("bigint").alias("time_stamp_s"), "net_worth")


def write_stage(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write a stage table and give it back as a scan, which also cuts the lineage."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int | None = None) -> DataFrame:
    """Write a stage table in buckets of ``key``, each in its order, and give it back as a table scan.

    Tables with the same number of buckets (by default the session's shuffle partitions) are joined and grouped by the key
    without a shuffle. The table is external: its files lie at ``path`` and can be read as plain Parquet too.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = _table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.repartition(buckets, key).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """A table of ``write_bucketed`` in a session that did not write it."""
    name = _table_name(path)
    columns = ", ".join(f"{name_sql(f.name)} {f.dataType.simpleString()}" for f in schema)
    layout = f"CLUSTERED BY ({name_sql(key)}) SORTED BY ({name_sql(key)}) INTO {buckets} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {layout} LOCATION '{path}'")
    return spark.table(name)


def _table_name(path: str) -> str:
    return f"stage_{hashlib.md5(path.encode()).hexdigest()}"


def save_params(df: DataFrame, params: Params, path: str) -> None:
    """Standardisation parameters as JSON lines, one per feature."""
    params_table(df, params).coalesce(1).write.mode("overwrite").json(path)


def load_params(spark: SparkSession, path: str) -> Params:
    return collect_params(spark.read.schema("feature string, mean double, std double").json(path))
