"""Queries over splits, metrics and trained models.

Metric queries score ``labels`` with a fixed formula, so SQL can follow. Model queries train on the
training table; SQL names the rows, and what must hold for each comes as columns.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchloom.functions.columns import sigmoid
from matchloom.operators import aggregates, metrics, models, nets, scoring, splits
from matchloom.operators.features import feature_columns, feature_vectors
from matchloom.plans.queries_features import accepted_states_sql, feature_sql, game_states, kept_and_params
from matchloom.plans.registry import query, rounded
from matchloom.schemas import TRAIN_LOG
from matchloom.session import result_path, scratch_path
from matchloom.sources.tables import write_stage
from matchloom.sources.testdata import read_table

SEED = 42

# splits and baselines


def _split_sql(table: str, key: str) -> str:
    return f"""
ranked AS (SELECT {key}, row_number() OVER (ORDER BY md5('{SEED}|' || {key})) AS r, count(*) OVER () AS n FROM {table}),
sized AS (SELECT *, CAST(floor(CAST(0.15 AS DOUBLE) * n) AS BIGINT) AS v FROM ranked)
SELECT {key}, CASE WHEN r <= n - 2 * v THEN 'train' WHEN r <= n - v THEN 'val' ELSE 'test' END AS part FROM sized"""


@query("split_exact", "WITH" + _split_sql("documents", "doc_id"))
def split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id")
    return splits.split_exact(documents, 0.15, 0.15, SEED, ["doc_id"])


@query(
    "split_by_match",
    "SELECT event_id, part FROM events JOIN (WITH users AS (SELECT DISTINCT user_id FROM events),"
    + _split_sql("users", "user_id")
    + ") USING (user_id)",
)
def split_by_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events").select("event_id", "user_id")
    return splits.split_exact(events, 0.15, 0.15, SEED, ["user_id"], unit="match").drop("user_id")


_SIZES = """classes AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality),
shares AS (
  SELECT quality, n, sum(n) OVER () - ceil(CAST(0.15 AS DOUBLE) * sum(n) OVER ()) AS train,
         n * (sum(n) OVER () - ceil(CAST(0.15 AS DOUBLE) * sum(n) OVER ())) / sum(n) OVER () AS share
  FROM classes),
sizes AS (
  SELECT quality, n, floor(share) + CAST(row_number() OVER (ORDER BY share - floor(share) DESC, quality)
         <= train - sum(floor(share)) OVER () AS INT) AS train_n
  FROM shares)"""


@query(
    "split_stratified",
    f"""WITH {_SIZES},
       ranked AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('{SEED}|' || doc_id)) AS r FROM labels)
       SELECT doc_id, quality, CASE WHEN r <= train_n THEN 'train' ELSE 'test' END AS part
       FROM ranked JOIN sizes USING (quality)""",
)
def split_stratified(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return splits.split_stratified(labels, "quality", 0.15, SEED, ["doc_id"])


@query(
    "class_weights",
    """SELECT quality, count(*) AS n, round((SELECT count(*) FROM labels) / (2 * count(*)), 6) AS weight
       FROM labels GROUP BY quality""",
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(splits.class_weights(read_table(spark, sf_dir, "labels"), "quality"))


@query(
    "dummy_majority",
    """SELECT doc_id, toxic, (SELECT quality FROM labels GROUP BY quality ORDER BY count(*) DESC, quality LIMIT 1) AS prediction
       FROM labels""",
)
def dummy_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    return splits.majority_dummy(labels, labels, "quality").drop("quality")


@query(
    "dummy_uniform",
    f"SELECT doc_id, CAST(right(md5('{SEED}|' || doc_id), 1) IN ('8','9','a','b','c','d','e','f') AS INT) AS prediction FROM documents",
)
def dummy_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.uniform_dummy(read_table(spark, sf_dir, "documents").select("doc_id"), SEED, ["doc_id"])


# metrics

_SCORED = """WITH scored AS (
  SELECT doc_id, quality, (doc_id * 37 % 101) / CAST(101 AS DOUBLE) AS score FROM labels),
rows AS (
  SELECT *, CASE WHEN quality = 1 THEN -ln(greatest(least(score, 1 - 1e-15), 1e-15))
            ELSE -ln(1 - greatest(least(score, 1 - 1e-15), 1e-15)) END AS loss FROM scored)
"""
_AUC = """(SELECT sum(p * (below + n / CAST(2 AS DOUBLE))) / (sum(p) * sum(n)) FROM (
  SELECT p, n, sum(n) OVER (ORDER BY score) - n AS below FROM (
    SELECT score, count(*) FILTER (WHERE quality = 1) AS p, count(*) FILTER (WHERE quality <> 1) AS n
    FROM rows GROUP BY score)))"""


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels")
    return labels.select("doc_id", "quality", ((F.col("doc_id") * 37 % 101) / F.lit(101.0)).alias("score"))


@query(
    "eval_accuracy",
    _SCORED
    + "SELECT round(avg(CASE WHEN CAST(score >= 0.5 AS INT) = quality THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6) AS accuracy FROM rows",
)
def eval_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.accuracy(scored_labels(spark, sf_dir), "score", "quality"))


@query("eval_auc", _SCORED + f"SELECT round({_AUC}, 6) AS roc_auc")
def eval_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.roc_auc(scored_labels(spark, sf_dir), "score", "quality"))


@query("eval_logloss", _SCORED + "SELECT round(avg(loss), 6) AS bce FROM rows")
def eval_logloss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.log_loss(scored_labels(spark, sf_dir), "score", "quality"))


@query("eval_mse", _SCORED + "SELECT round(avg((score - quality) * (score - quality)), 6) AS mse FROM rows")
def eval_mse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(metrics.mse(scored_labels(spark, sf_dir), "score", "quality"))


@query(
    "eval_batch_mean",
    _SCORED
    + "SELECT round(avg(m), 6) AS batch_mean_loss FROM (SELECT avg(loss) AS m FROM rows GROUP BY doc_id // 32)",
)
def eval_batch_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched = scored_labels(spark, sf_dir).withColumn("batch", F.expr("doc_id div 32"))
    return rounded(metrics.batch_mean_loss(batched, "score", "quality", "batch"))


@query(
    "eval_report",
    _SCORED
    + f"""SELECT 'formula' AS model, 'accuracy' AS metric,
         round(avg(CASE WHEN CAST(score > 0.5 AS INT) = quality THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6) AS value FROM rows
       UNION ALL SELECT 'formula', 'bce', round(avg(loss), 6) FROM rows
       UNION ALL SELECT 'formula', 'mse', round(avg((score - quality) * (score - quality)), 6) FROM rows
       UNION ALL SELECT 'formula', 'roc_auc', round({_AUC}, 6)""",
)
def eval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scored_labels(spark, sf_dir)
    table = table.withColumn("prediction", metrics.predicted(F.col("score"), strict=True))
    return rounded(metrics.evaluate(table, "formula", "quality", "prediction", "score"))


@query(
    "metric_average",
    _SCORED
    + """, runs AS (
         SELECT doc_id % 25 AS run, 'formula' AS model, avg(loss) AS bce, avg((score - quality) * (score - quality)) AS mse
         FROM rows GROUP BY 1),
       tall AS (SELECT run, model, 'bce' AS metric, bce AS value FROM runs UNION ALL SELECT run, model, 'mse', mse FROM runs)
       SELECT model, metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, count(value) AS runs
       FROM tall GROUP BY model, metric""",
)
def metric_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    label, score = F.col("quality"), F.col("score")
    runs = (
        scored_labels(spark, sf_dir)
        .groupBy((F.col("doc_id") % 25).alias("run"))
        .agg(F.avg(metrics.bce(score, label)).alias("bce"), F.avg(metrics.squared_error(score, label)).alias("mse"))
    )
    tall = runs.select("run", F.lit("formula").alias("model"), F.expr("stack(2, 'bce', bce, 'mse', mse) AS (metric, value)"))
    return rounded(aggregates.average_metrics(tall))


@query(
    "early_stop",
    """WITH RECURSIVE losses AS (
         SELECT user_id AS run, CAST(row_number() OVER (PARTITION BY user_id ORDER BY d) AS INT) AS epoch, loss
         FROM (SELECT user_id, day(ts) AS d, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) AS loss
               FROM events GROUP BY 1, 2)),
       fold AS (
         SELECT run, epoch, loss AS best, 0 AS missed, CAST(NULL AS BIGINT) AS stop FROM losses WHERE epoch = 1
         UNION ALL
         SELECT f.run, l.epoch, CASE WHEN l.loss <= f.best * (1 - CAST(0.01 AS DOUBLE)) THEN l.loss ELSE f.best END,
                CASE WHEN l.loss <= f.best * (1 - CAST(0.01 AS DOUBLE)) THEN 0 ELSE f.missed + 1 END,
                CASE WHEN l.loss > f.best * (1 - CAST(0.01 AS DOUBLE)) AND f.missed + 1 >= 5 THEN CAST(l.epoch AS BIGINT) END
         FROM fold f JOIN losses l ON l.run = f.run AND l.epoch = f.epoch + 1 WHERE f.stop IS NULL)
       SELECT run, max(stop) AS stop_epoch, coalesce(max(stop) - 5, CAST(max(epoch) AS BIGINT)) AS best_epoch,
              min(best) AS best_loss
       FROM fold GROUP BY run""",
)
def early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run per user, an epoch per active day (at most 31), the day's value as the loss."""
    events = read_table(spark, sf_dir, "events")
    daily = events.groupBy(F.col("user_id").alias("run"), F.dayofmonth("ts").alias("day")).agg(
        F.sum(F.round(F.col("value") * 100).cast("bigint")).cast("double").alias("loss")
    )
    epoch = F.row_number().over(Window.partitionBy("run").orderBy("day"))
    return models.early_stop(daily.withColumn("epoch", epoch), ["run"], "epoch", "loss")


# trained models


def _vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str], dict]:
    """The vector table, written once: training passes over it many times."""
    info, player, heroes, params = kept_and_params(spark, sf_dir)
    table = feature_vectors(player, info, heroes, params, placed=True)
    return write_stage(table, scratch_path(spark, "vectors")), heroes, params


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return models.stratified_parts(_vectors(spark, sf_dir)[0], 0.25, SEED)


_TRAINING = f"t AS (SELECT match_id, time_s, winning_team FROM ({feature_sql()}))"
_TEST_ROWS = f"""WITH {_TRAINING},
classes AS (SELECT winning_team, count(*) AS n FROM t GROUP BY winning_team),
shares AS (
  SELECT winning_team, sum(n) OVER () - ceil(CAST(0.25 AS DOUBLE) * sum(n) OVER ()) AS train,
         n * (sum(n) OVER () - ceil(CAST(0.25 AS DOUBLE) * sum(n) OVER ())) / sum(n) OVER () AS share FROM classes),
sizes AS (
  SELECT winning_team, floor(share) + CAST(row_number() OVER (ORDER BY share - floor(share) DESC, winning_team)
         <= train - sum(floor(share)) OVER () AS INT) AS train_n FROM shares),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY winning_team ORDER BY md5('{SEED}|' || match_id || '|' || time_s)) AS r FROM t),
test AS (SELECT match_id, time_s, winning_team FROM ranked JOIN sizes USING (winning_team) WHERE r > train_n)
"""
_JUDGED = _TEST_ROWS + "SELECT *, TRUE AS score_in_range, TRUE AS prediction_fits FROM test"


def _judged(model, test: DataFrame) -> DataFrame:
    """The scored rows with what must hold for each: a probability, and the class it stands for."""
    out = models.with_probability(model.transform(test))
    fits = F.when(F.col("score") == 0.5, F.lit(True)).otherwise(F.col("prediction") == (F.col("score") > 0.5).cast("double"))
    return out.select(*models.KEY, models.LABEL, F.col("score").between(0, 1).alias("score_in_range"), fits.alias("prediction_fits"))


@query("logreg", _TEST_ROWS + "SELECT *, TRUE AS score_in_range, TRUE AS prediction_fits, TRUE AS at_the_minimum FROM test")
def logreg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the test rows; the gradient of the weighted, penalised loss must vanish on the training rows."""
    train, test = _parts(spark, sf_dir)
    model = models.fit_logreg(train)
    return _judged(model, test).withColumn("at_the_minimum", F.lit(models.logreg_gradient(model, train) < 1e-3))


@query("random_forest", _JUDGED)
def random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _parts(spark, sf_dir)
    return _judged(models.fit_forest(train, SEED), test)


@query("mlp", _JUDGED)
def mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = _parts(spark, sf_dir)
    return _judged(models.fit_mlp(train, seed=SEED), test)


_LOG_SQL = """SELECT TRUE AS epochs_without_gap, TRUE AS losses_finite, TRUE AS accuracies_in_range, TRUE AS within_limit"""


def _log_facts(log: DataFrame) -> DataFrame:
    """What must hold for the log of any run, in one row."""
    losses, accuracies = ("train_loss", "val_loss"), ("train_acc", "val_acc")
    return log.agg(
        ((F.min("epoch") == 1) & (F.max("epoch") == F.count_distinct("epoch")) & (F.count("*") == F.max("epoch"))).alias("epochs_without_gap"),
        F.every(F.forall(F.array(*losses), lambda x: (x >= 0) & ~F.isnan(x) & (x < float("inf")))).alias("losses_finite"),
        F.every(F.forall(F.array(*accuracies), lambda x: x.between(0, 1))).alias("accuracies_in_range"),
        (F.max("epoch") <= 200).alias("within_limit"),
    )


@query("mlp_rounds", _LOG_SQL)
def mlp_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default network over the test part as validation rows, in mini-batches."""
    return _log_facts(spark.createDataFrame(_default_log(spark, sf_dir), TRAIN_LOG))


def _default_log(spark: SparkSession, sf_dir: str) -> list[tuple]:
    train, val = _parts(spark, sf_dir)
    table = nets.new_shards(spark, {"train": train, "val": val}, models.KEY, models.LABEL, SEED)
    return nets.fit(table, hidden=6, width=400, rate=0.0001, seed=SEED)[1]


@query("train_log", _LOG_SQL)
def train_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored log of a run of the default network."""
    path = scratch_path(spark, "train-log")
    models.write_train_log(spark, [dict(zip(TRAIN_LOG.names, r)) for r in _default_log(spark, sf_dir)], path)
    return _log_facts(spark.read.schema(TRAIN_LOG).parquet(path))


def _grid_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking of all points of ``FULL_GRID`` at the search's own defaults; the second call finds it done."""
    train, val = _parts(spark, sf_dir)
    path = result_path(spark, "grid", sf_dir)
    return models.grid_search(models.parameter_grid(**models.FULL_GRID), train, val, models.KEY, path, seed=SEED)


@query(
    "grid_search",
    """SELECT CAST(width AS INT) AS width, CAST(hidden AS INT) AS hidden, step, TRUE AS within_epochs, TRUE AS loss_finite,
              TRUE AS in_order, TRUE AS beats_no_model
       FROM (SELECT unnest([100, 200, 400, 600, 800]) AS width), (SELECT unnest([2, 3, 4, 6, 8, 10]) AS hidden),
            (SELECT CAST(unnest([0.0001, 0.0005, 0.001, 0.005, 0.01, 0.05]) AS DOUBLE) AS step)""",
)
def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each of the 180 points with what must hold of it: its epochs, its loss, its place, and that the best point's loss
    is below that of an even chance."""
    ranking = _grid_ranking(spark, sf_dir)
    order, whole = Window.orderBy("place"), Window.partitionBy()  # 180 rows
    loss = F.col("validation_loss")
    return ranking.select(
        "width", "hidden", "step",
        F.col("best_epoch").between(1, 200).alias("within_epochs"),
        ((loss >= 0) & (loss < float("inf"))).alias("loss_finite"),
        F.coalesce(F.lead(loss).over(order) >= loss, F.lit(True)).alias("in_order"),
        (F.min(loss).over(whole) < F.log(F.lit(2.0))).alias("beats_no_model"),
    )


@query("grid_search_full")
def grid_search_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best points with their losses and best epochs."""
    return aggregates.top_n(_grid_ranking(spark, sf_dir), ["place"], 10, descending=False).drop("seconds")


def _comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five models at their full size over the 25 repeated splits; the second call finds them done."""
    table, _, _ = _vectors(spark, sf_dir)
    return models.compare(table, models.default_models(), result_path(spark, "comparison", sf_dir), runs=25, seed=SEED)


_DUMMY_MEANS = f"""WITH {_TRAINING},
classes AS (SELECT winning_team, count(*) AS n FROM t GROUP BY winning_team),
shares AS (
  SELECT winning_team, n, sum(n) OVER () - ceil(CAST(0.15 AS DOUBLE) * sum(n) OVER ()) AS train,
         n * (sum(n) OVER () - ceil(CAST(0.15 AS DOUBLE) * sum(n) OVER ())) / sum(n) OVER () AS share FROM classes),
sizes AS (
  SELECT winning_team, floor(share) + CAST(row_number() OVER (ORDER BY share - floor(share) DESC, winning_team)
         <= train - sum(floor(share)) OVER () AS INT) AS train_n FROM shares),
ranked AS (
  SELECT run, winning_team, md5(({SEED} + run) || '|' || match_id || '|' || time_s) AS d,
         row_number() OVER (PARTITION BY run, winning_team ORDER BY md5(({SEED} + run) || '|' || match_id || '|' || time_s)) AS r
  FROM t, range(25) runs(run)),
test AS (SELECT run, winning_team AS y, right(d, 1) IN ('8', '9', 'a', 'b', 'c', 'd', 'e', 'f') AS up FROM ranked JOIN sizes USING (winning_team) WHERE r > train_n),
majority AS (SELECT arg_min(winning_team, (-train_n, winning_team)) AS m FROM sizes),
scored AS (
  SELECT 'Dummy (Most Frequent)' AS model, run, y, m AS p, CAST(m AS DOUBLE) AS score FROM test, majority
  UNION ALL SELECT 'Dummy (Random)', run, y, CAST(up AS INT), CAST(0.5 AS DOUBLE) FROM test),
clipped AS (SELECT *, greatest(least(score, 1 - 1e-15), 1e-15) AS q FROM scored),
per_run AS (
  SELECT model, run, avg(CAST(p = y AS INT)) AS accuracy, avg(-(y * ln(q) + (1 - y) * ln(1 - q))) AS bce,
         avg((score - y) * (score - y)) AS mse, CASE WHEN min(y) < max(y) THEN CAST(0.5 AS DOUBLE) END AS roc_auc FROM clipped GROUP BY model, run),
tall AS (UNPIVOT per_run ON accuracy, bce, mse, roc_auc INTO NAME metric VALUE value),
known AS (SELECT model, metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM tall GROUP BY model, metric)
SELECT model, metric, CAST(25 AS BIGINT) AS finished, TRUE AS mean_in_range, known.mean AS dummy_mean, known.std AS dummy_std
FROM (SELECT * FROM (SELECT unnest(['Dummy (Most Frequent)', 'Dummy (Random)', 'Logistic Regression', 'Random Forest', 'Neural Network']) AS model),
                    (SELECT unnest(['accuracy', 'roc_auc', 'bce', 'mse']) AS metric)) every LEFT JOIN known USING (model, metric)"""


@query("model_comparison", _DUMMY_MEANS)
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per model and metric: finished runs, whether the mean can be one, and the values of the dummies, which need no training."""
    rows = _comparison(spark, sf_dir)
    means = rounded(aggregates.average_metrics(rows))
    finished = rows.groupBy(F.col("model").alias("_model"), F.col("metric").alias("_metric")).agg(F.count_distinct("run").alias("finished"))
    bounded = F.col("metric") != "bce"
    fine = (F.col("mean") >= 0) & F.when(bounded, F.col("mean") <= 1).otherwise(True)
    dummy = F.col("model").isin(*models.DUMMIES)
    return means.join(finished, (F.col("model") == F.col("_model")) & (F.col("metric") == F.col("_metric"))).select(
        "model", "metric", "finished", F.coalesce(fine, F.lit(True)).alias("mean_in_range"),
        F.when(dummy, F.col("mean")).alias("dummy_mean"), F.when(dummy, F.col("std")).alias("dummy_std"),
    )


@query("model_comparison_full")
def model_comparison_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means and deviations of all five models over the 25 repeated splits."""
    return aggregates.average_metrics(_comparison(spark, sf_dir))


@query("model_roundtrip", _TEST_ROWS + "SELECT match_id, time_s, CAST(0 AS DOUBLE) AS difference FROM test")
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the scores of a stored and loaded model lie from those of the model itself."""
    table, heroes, _ = _vectors(spark, sf_dir)
    train, test = models.stratified_parts(table, 0.25, SEED)
    names = feature_columns(heroes)
    path = scratch_path(spark, "model")
    fitted = models.fit_logreg(train)
    models.save_model(fitted, path, {"features": names})
    loaded, _ = models.load_model(spark, path, names)
    both = loaded.transform(fitted.transform(test).withColumnsRenamed({"probability": "first", "rawPrediction": "r", "prediction": "p"}))
    score = [F.get(vector_to_array(c), F.lit(1)) for c in ("first", "probability")]
    return both.select(*models.KEY, F.abs(score[0] - score[1]).alias("difference"))


@query(
    "score_states",
    accepted_states_sql("SELECT match_id, timestamp, TRUE AS score_in_range, TRUE AS is_sigmoid_of_sum FROM checked WHERE len(r) = 0"),
)
def score_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all valid states of all matches, by a model trained on the kept matches, against the sigmoid of the
    weighted sum of the state's features."""
    table, heroes, params = _vectors(spark, sf_dir)
    model = models.fit_logreg(table)
    states = scoring.accepted(scoring.validate(game_states(spark, sf_dir), heroes))
    weights = F.array(*[F.lit(float(w)) for w in model.coefficients])
    parts = F.zip_with(vector_to_array("features"), weights, lambda x, w: x * w)
    total = F.aggregate(parts, F.lit(float(model.intercept)), lambda a, x: a + x)
    vectors = scoring.state_vectors(states, params, heroes).select("match_id", "timestamp", total.alias("total"))
    scores = scoring.score(model, states, params, heroes).select("match_id", "timestamp", "score")
    agrees = F.abs(F.col("score") - sigmoid(F.col("total"))) < 1e-9
    return scores.join(vectors, ["match_id", "timestamp"]).select(
        "match_id", "timestamp", F.col("score").between(0, 1).alias("score_in_range"), agrees.alias("is_sigmoid_of_sum")
    )
