"""Quality rules with robust multivariate outliers.

``text_counts`` takes plain counts of every whole text. ``outliers`` turns them into a vector per document,
estimates location and scatter of each (language, source) by minimum covariance determinant, and measures
every document by its Mahalanobis distance from its own group.

The estimate is the deterministic form of the fast algorithm for large tables: from two starts (coordinate
medians and spreads; classical moments) concentration steps keep the ``SHARE`` of documents nearest to the
last estimate, and the start with the smaller determinant wins. A step is one aggregate: documents fall into
narrow logarithmic classes of their distance, each class sums its moments, and the classes up to the share
give the next estimate. So a group is never gathered in one task, however large, and nothing is sampled.

A group's estimate is drawn towards that over all documents, which weighs as much as ``PRIOR`` documents of the group:
mean and scatter are weighted means of the own and the common ones. So small groups rest mostly on the common estimate,
large ones on their own, and no size switches from one to the other.

Cases: a null or empty text has no words and fails the base rule; null languages or sources form groups of
their own; ties fall into one class; repeated rows count as often as they occur; an empty table gives an
empty result; other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.llm.common import GRAM, U64, Hasher, flat, grams, mix, slices, spaced_words, store, word_spans

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20

SHARE = 0.75
STEPS = 6
TAIL = 1e-5  # share of clean documents that may lie beyond the cut if the vectors were normal
CLASSES = 32  # distance classes for each factor e

# The vector: expression over the counts, smallest standard deviation taken for it. The floors keep a group
# in which nearly all documents agree (no symbols, no repeated lines) from rejecting small differences.
FEATURES = {
    "log_words": ("ln(1 + n_words)", 1.0),
    "log_word_length": ("ln(word_chars / n_words)", 0.15),
    "root_symbols": ("sqrt(n_symbols / word_chars)", 0.04),
    "log_dup_lines": ("ln(1 + n_dup_lines)", 0.5),
    "root_repeats": ("sqrt(n_repeat_words / n_words)", 0.15),
}
P = len(FEATURES)
LEAST = 0.01  # least variance in any direction, with the smallest deviations above as units
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
POOLED = "*"
PRIOR = P * (P + 3) // 2  # as many documents as an estimate has numbers (location and scatter)


def text_counts(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """The columns of ``keep`` and the counts of each text."""
    schema = T.StructType([*docs.select(*keep).schema.fields, *(T.StructField(c, T.LongType()) for c in COUNTS)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, is_word = Hasher(), spaced_words()
        symbol = np.isin(np.arange(256), np.frombuffer(SYMBOLS, np.uint8))
        for batch in batches:
            out = np.zeros((len(COUNTS), batch.num_rows), dtype=np.int64)
            for first, last, data, at in slices(*flat(batch.column("_text"))):
                out[:, first:last] = _counts(data, at, hasher, is_word, symbol)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *map(pa.array, out)], schema=None, names=[*keep, *COUNTS])

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(count, schema)


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[at[1:]] - total[at[:-1]]


def _counts(data: np.ndarray, at: np.ndarray, hasher: Hasher, is_word: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    n = len(at) - 1
    starts, ends, text = word_spans(data, at, is_word)
    prefix = hasher.prefix(data)
    words = np.bincount(text, minlength=n)
    chars = _per_text(is_word[data] & ((data & 0xC0) != 0x80), at)

    breaks = np.flatnonzero(data == 10)
    line_starts, line_ends = np.sort(np.concatenate((at[:-1], breaks + 1))), np.sort(np.concatenate((breaks, at[1:])))
    line_text = np.repeat(np.arange(n), _per_text(data == 10, at) + 1)
    full = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_text = line_text[full]
    key = mix(hasher.ranges(prefix, line_starts[full], line_ends[full]) + line_text.astype(U64) * U64(GRAM))
    _, first = np.unique(key, return_index=True)
    dup_lines = np.bincount(line_text, minlength=n) - np.bincount(line_text[first], minlength=n)

    windows = grams(hasher.ranges(prefix, starts, ends), WINDOW)
    at_word = np.flatnonzero(text[: len(windows)] == text[WINDOW - 1 :]) if len(windows) else np.zeros(0, np.int64)
    key = mix(windows[at_word] + text[at_word].astype(U64) * U64(GRAM))
    _, same, times = np.unique(key, return_inverse=True, return_counts=True)
    again = at_word[times[same] > 1]
    cover = np.bincount(again, minlength=len(starts) + WINDOW) - np.bincount(again + WINDOW, minlength=len(starts) + WINDOW)
    repeated = np.cumsum(cover)[: len(starts)] > 0
    return np.stack((words, chars, _per_text(symbol[data], at), dup_lines, np.bincount(text[repeated], minlength=n)))


def base_failed() -> F.Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def chi2_cdf(x: float, k: int) -> float:
    term = total = 1.0
    a = k / 2
    for n in range(1, 10_000):
        term *= x / 2 / (a + n)
        total += term
        if term < total * 1e-17:
            break
    return min(1.0, math.exp(a * math.log(x / 2) - x / 2 - math.lgamma(a + 1)) * total) if x > 0 else 0.0


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, k) < p else (low, middle)
    return (low + high) / 2


ESTIMATE = "_key string, _start int, _n long, _mean array<double>, _inverse array<double>, _logdet double"


def _estimate(key: str, start: int, n: int, mean: np.ndarray, scatter: np.ndarray) -> tuple:
    floors = np.array([floor for _, floor in FEATURES.values()])
    scatter = scatter + np.diag(np.maximum(floors**2 - np.diag(scatter), 0))
    values, axes = np.linalg.eigh(scatter / np.outer(floors, floors))  # few documents span too few directions
    scatter = (axes * np.maximum(values, LEAST)) @ axes.T * np.outer(floors, floors)
    return key, start, int(n), mean.tolist(), np.linalg.inv(scatter).ravel().tolist(), float(np.linalg.slogdet(scatter)[1])


def _moments(rows: pd.DataFrame) -> tuple[float, np.ndarray, np.ndarray]:
    n = rows["_c"].sum()
    mean = np.array([rows[f"_s{i}"].sum() for i in range(P)]) / n
    scatter = np.zeros((P, P))
    for i, j in PAIRS:
        scatter[i, j] = scatter[j, i] = rows[f"_s{i}_{j}"].sum() / n - mean[i] * mean[j]
    return n, mean, scatter


def _sums() -> list[F.Column]:
    x = [F.col(name) for name in FEATURES]
    return [
        F.count("*").alias("_c"),
        *(F.sum(x[i]).alias(f"_s{i}") for i in range(P)),
        *(F.sum(x[i] * x[j]).alias(f"_s{i}_{j}") for i, j in PAIRS),
    ]


def _distance() -> F.Column:
    d = [F.col(name) - F.col("_mean")[i] for i, name in enumerate(FEATURES)]
    parts = [d[i] * d[j] * F.col("_inverse")[i * P + j] * (1 if i == j else 2) for i, j in PAIRS]
    return sum(parts[1:], parts[0])


def _starts(vectors: DataFrame) -> DataFrame:
    """Both first estimates of each key; those over all documents come from the sums of the groups."""
    names = list(FEATURES)
    cell = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.floor(F.col(c) * 64).alias("v")) for i, c in enumerate(names))))
    counts = vectors.select("_key", cell.alias("_cell")).groupBy("_key", "_cell.i", "_cell.v").agg(F.count("*").alias("_c"))
    counts = counts.unionByName(counts.groupBy(F.lit(POOLED).alias("_key"), "i", "v").agg(F.sum("_c").alias("_c")))
    sums = vectors.groupBy("_key").agg(*_sums())
    totals = [F.sum(c).alias(c) for c in sums.columns if c != "_key"]
    sums = sums.unionByName(sums.groupBy(F.lit(POOLED).alias("_key")).agg(*totals))

    def weighted_median(values: np.ndarray, counts: np.ndarray) -> float:
        order = np.argsort(values)
        return float(values[order][np.searchsorted(np.cumsum(counts[order]), counts.sum() / 2)])

    def robust(rows: pd.DataFrame) -> pd.DataFrame:
        mean, spread = np.zeros(P), np.zeros(P)
        for i, own in rows.groupby("i"):
            value, count = own["v"].to_numpy() / 64 + 1 / 128, own["_c"].to_numpy()
            mean[i] = weighted_median(value, count)
            spread[i] = 1.4826 * weighted_median(np.abs(value - mean[i]), count)
        row = _estimate(rows["_key"].iloc[0], 0, rows.loc[rows["i"] == 0, "_c"].sum(), mean, np.diag(spread**2))
        return pd.DataFrame([row], columns=[f.split()[0] for f in ESTIMATE.split(", ")])

    def classical(rows: pd.DataFrame) -> pd.DataFrame:
        row = _estimate(rows["_key"].iloc[0], 1, *_moments(rows))
        return pd.DataFrame([row], columns=[f.split()[0] for f in ESTIMATE.split(", ")])

    return (
        counts.groupBy("_key").applyInPandas(robust, ESTIMATE)
        .unionByName(sums.groupBy("_key").applyInPandas(classical, ESTIMATE))
    )


def _concentrated(vectors: DataFrame, estimates: DataFrame, share: float) -> DataFrame:
    """The next estimates: moments of the ``share`` of documents nearest to the last ones, by distance class."""

    def step(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_class")
        counts = rows["_c"].to_numpy()
        near = rows.iloc[: int(np.searchsorted(np.cumsum(counts), share * counts.sum())) + 1]
        _, mean, scatter = _moments(near)
        row = _estimate(rows["_key"].iloc[0], rows["_start"].iloc[0], counts.sum(), mean, scatter)
        return pd.DataFrame([row], columns=[f.split()[0] for f in ESTIMATE.split(", ")])

    def classes(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_class", F.floor(F.log(_distance() + 1e-6) * CLASSES)).groupBy("_key", "_start", "_class").agg(*_sums())

    own = vectors.join(estimates.where(F.col("_key") != POOLED), "_key")
    pooled = vectors.drop("_key").join(F.broadcast(estimates.where(F.col("_key") == POOLED)), F.lit(True))  # two rows
    return classes(own).unionByName(classes(pooled)).groupBy("_key", "_start").applyInPandas(step, ESTIMATE)


def _drawn(own: DataFrame, pooled: DataFrame, prior: float) -> DataFrame:
    """_key, _mean, _inverse: each group's estimate drawn towards the common one, a row with both."""

    def blend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            means, inverses = [], []
            for row in rows.itertuples(index=False):
                weight = row.n / (row.n + prior)
                means.append(weight * np.asarray(row.mean) + (1 - weight) * np.asarray(row.all_mean))
                a, b = (np.linalg.inv(np.reshape(m, (P, P))) for m in (row.inverse, row.all_inverse))
                inverses.append(np.linalg.inv(weight * a + (1 - weight) * b).ravel())
            yield pd.DataFrame({"_key": rows["_key"], "_mean": means, "_inverse": inverses})

    both = own.select("_key", "e.*").join(F.broadcast(pooled), F.lit(True)).select(  # one row
        "_key", F.col("_n").alias("n"), F.col("_mean").alias("mean"), F.col("_inverse").alias("inverse"),
        F.col("_all_mean").alias("all_mean"), F.col("_all_inverse").alias("all_inverse"),
    )
    return both.mapInPandas(blend, "_key string, _mean array<double>, _inverse array<double>")


def outliers(
    counts: DataFrame,
    group: tuple[str, ...] = ("lang", "source"),
    share: float = SHARE,
    steps: int = STEPS,
    prior: float = PRIOR,
    tail: float = TAIL,
) -> DataFrame:
    """``counts`` with base_failed, distance (squared, scaled for the share; null without words) and kept.

    Estimates are taken from the documents that pass the base rule.
    """
    key = F.to_json(F.struct(*group))
    counts = store(counts, "counts")  # texts are read once
    vectors = store(
        counts.where(~base_failed()).select(key.alias("_key"), *(F.expr(e).alias(name) for name, (e, _) in FEATURES.items())),
        "vectors",
    )
    estimates = store(_starts(vectors), "estimates")
    for _ in range(steps):
        estimates = store(_concentrated(vectors, estimates, share), "estimates")
    best = estimates.groupBy("_key").agg(F.min(F.struct("_logdet", "_start", "_n", "_mean", "_inverse")).alias("e"))
    best = store(best, "estimates")
    pooled = best.where(F.col("_key") == POOLED).select(F.col("e._mean").alias("_all_mean"), F.col("e._inverse").alias("_all_inverse"))
    own = _drawn(best.where(F.col("_key") != POOLED), pooled, prior)
    scale = chi2_cdf(chi2_quantile(share, P), P + 2) / share
    rows = (
        counts.withColumn("_key", key)
        .withColumns({name: F.expr(f"if(n_words = 0, null, {e})") for name, (e, _) in FEATURES.items()})
        .join(own, "_key", "left")
        .join(F.broadcast(pooled), F.lit(True), "left")  # one row
        .withColumns({"_mean": F.coalesce("_mean", "_all_mean"), "_inverse": F.coalesce("_inverse", "_all_inverse")})
        .withColumn("base_failed", base_failed())
        .withColumn("distance", _distance() * scale)
    )
    verdict = ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= chi2_quantile(1 - tail, P))
    return rows.select(*counts.columns, "base_failed", "distance", verdict.alias("kept"))
