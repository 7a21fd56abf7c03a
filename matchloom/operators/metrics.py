"""Classifier metrics over a scored table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.operators.ordered import bucket_spans, stored_ranges

CLIP = 1e-15


def predicted(score: Column, threshold: float = 0.5, strict: bool = False) -> Column:
    """1 at or above the threshold (training), or only above it (``strict``, evaluation)."""
    return (score > threshold if strict else score >= threshold).cast("int")


def hit(prediction: Column, label: Column) -> Column:
    return (prediction.cast("double") == label.cast("double")).cast("double")


def bce(score: Column, label: Column) -> Column:
    """Log loss of one row, with the probability kept away from 0 and 1."""
    p = F.greatest(F.least(score, F.lit(1 - CLIP)), F.lit(CLIP))
    y = label.cast("double")
    return -(y * F.log(p) + (1 - y) * F.log(1 - p))


def squared_error(score: Column, label: Column) -> Column:
    return F.pow(score - label.cast("double"), 2)


def accuracy(df: DataFrame, score: str, label: str, threshold: float = 0.5, strict: bool = False) -> DataFrame:
    return df.agg(F.avg(hit(predicted(F.col(score), threshold, strict), F.col(label))).alias("accuracy"))


def log_loss(df: DataFrame, score: str, label: str) -> DataFrame:
    return df.agg(F.avg(bce(F.col(score), F.col(label))).alias("bce"))


def mse(df: DataFrame, score: str, label: str) -> DataFrame:
    return df.agg(F.avg(squared_error(F.col(score), F.col(label))).alias("mse"))


def batch_mean_loss(df: DataFrame, score: str, label: str, batch_id: str) -> DataFrame:
    """Mean of the batch means, so a short batch weighs as much as a full one."""
    batches = df.groupBy(batch_id).agg(F.avg(bce(F.col(score), F.col(label))).alias("_loss"))
    return batches.agg(F.avg("_loss").alias("batch_mean_loss"))


def roc_auc(df: DataFrame, score: str, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Area under the ROC curve, exact, tied scores counted half, of the table or of each group; NULL with a single class.

    Rows are reduced to one per distinct score and written by range; the negatives below a score come from the totals of
    the ranges plus a running sum inside its range.
    """
    positive = F.col(label).cast("double") == 1.0
    per_score = (
        df.where(F.col(score).isNotNull())
        .groupBy(*by, F.col(score).alias("_score"))
        .agg(F.count_if(positive).alias("_pos"), F.count_if(~positive).alias("_neg"))
    )
    bucketed = stored_ranges(per_score, *by, "_score")
    spans = bucket_spans(bucketed, list(by), F.col("_neg")).select(*by, "_bucket", "_start")
    upto = Window.partitionBy(*by, "_bucket").orderBy("_score").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = F.col("_start") + F.sum("_neg").over(upto) - F.col("_neg")
    spans = spans if by else F.broadcast(spans)  # without groups a row a range
    ranked = bucketed.join(spans, [*by, "_bucket"]).withColumn("_below", below.cast("double"))
    return ranked.groupBy(*by).agg(
        F.try_divide(
            F.sum(F.col("_pos") * (F.col("_below") + F.col("_neg") / 2)),
            F.sum("_pos").cast("double") * F.sum("_neg").cast("double"),
        ).alias("roc_auc")
    )


def evaluate_groups(df: DataFrame, by: list[str], label: str, prediction: str, score: str) -> DataFrame:
    """All metrics of each group as rows (by, metric, value), in one pass and one for the areas; ``df`` is a stored table."""
    single = {
        "accuracy": F.avg(hit(F.col(prediction), F.col(label))),
        "bce": F.avg(bce(F.col(score), F.col(label))),
        "mse": F.avg(squared_error(F.col(score), F.col(label))),
    }
    wide = df.groupBy(*by).agg(*[v.alias(m) for m, v in single.items()])
    tall = wide.unpivot(by, list(single), "metric", "value")
    areas = roc_auc(df, score, label, tuple(by))
    return tall.unionByName(areas.select(*by, F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value")))


def evaluate(df: DataFrame, name: str, label: str, prediction: str, score: str | None = None) -> DataFrame:
    """Rows (model, metric, value); the probability metrics only where a probability exists."""
    single = {"accuracy": F.avg(hit(F.col(prediction), F.col(label)))}
    if score is not None:
        single["bce"] = F.avg(bce(F.col(score), F.col(label)))
        single["mse"] = F.avg(squared_error(F.col(score), F.col(label)))
    wide = df.agg(
        *[F.struct(F.lit(m).alias("metric"), value.alias("value")).alias(m) for m, value in single.items()]
    )
    tall = wide.select(F.inline(F.array(*single)))
    if score is not None:
        auc = roc_auc(df, score, label)
        tall = tall.unionByName(auc.select(F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value")))
    return tall.select(F.lit(name).alias("model"), "metric", "value")
