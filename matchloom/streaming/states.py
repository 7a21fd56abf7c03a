"""Score game states as they arrive: scoring is a projection, so it needs no state."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from matchloom.operators.normalize import Params
from matchloom.operators.scoring import score
from matchloom.schemas import GAME_STATE

STATE_ROW = T.StructType([T.StructField("match_id", T.LongType()), *GAME_STATE.fields])


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """A stream of game states from a folder of JSON files."""
    return spark.readStream.schema(STATE_ROW).json(path)


def score_stream(
    states: DataFrame, model: Model, params: Params, heroes: list[str], path: str, checkpoint: str
) -> StreamingQuery:
    """Write (match_id, timestamp, score) for all states that have arrived."""
    scored = score(model, states, params, heroes).select("match_id", "timestamp", "score")
    return (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
