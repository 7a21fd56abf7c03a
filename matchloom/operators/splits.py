"""Reproducible splits, baselines and class weights.

Splits order rows by the md5 of seed and key. Only digests are ranked; each row is then placed by
comparing its digest with one or two bounds, so the wide feature rows are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.operators.joins import small_dim
from matchloom.operators.ordered import digest, rank_cuts
from matchloom.session import held


FEW_CLASSES = 100


def split_exact(df: DataFrame, val: float, test: float, seed: int, key: list[str], unit: str = "row") -> DataFrame:
    """Add ``part`` (train, val, test) with exact sizes int(val * n) and int(test * n).

    ``key`` identifies a row. With ``unit="match"`` it names the match instead, the sizes count matches,
    and all rows of a match go to one part.
    """
    if not (0 <= val <= 1 and 0 <= test <= 1 and val + test < 1):
        raise ValueError("val and test must lie in 0..1 and sum to less than 1")
    if unit not in ("row", "match"):
        raise ValueError(f"unit must be row or match, not {unit}")
    units = df.select(*key) if unit == "row" else df.select(*key).distinct()
    n = F.col("_total")
    val_size = F.floor(F.lit(float(val)) * n)
    test_size = F.floor(F.lit(float(test)) * n)
    checked = F.when(val_size >= 1, val_size).otherwise(
        F.raise_error(F.lit("the validation share rounds down to no row"))
    )
    train_size = n - test_size - checked
    cuts = rank_cuts(
        units.select(digest(seed, key).alias("_digest")), [], {"train": train_size, "val": train_size + checked}
    )
    bounds = cuts.agg(
        F.struct(*[F.max(F.when(F.col("name") == p, F.col("bound"))).alias(p) for p in ("train", "val")])
    ).scalar()
    mine = digest(seed, key)
    placed = df.withColumn("_bounds", bounds)
    return placed.withColumn(
        "part",
        F.when(mine <= F.col("_bounds.train"), F.lit("train"))
        .when(mine <= F.col("_bounds.val"), F.lit("val"))
        .otherwise(F.lit("test")),
    ).drop("_bounds")


def _attach(df: DataFrame, per_class: DataFrame, label: str) -> DataFrame:
    """``df`` with the columns of a table of one row per class; broadcast after a check of its size."""
    return df.join(small_dim(per_class), label, "left")


def train_sizes(df: DataFrame, label: str, test_size: float) -> DataFrame:
    """Training rows per class: proportional shares, the largest remainders rounded up. The counts of the classes are
    worked out at once and written; what follows reads a row a class."""
    classes = held(df.dropna(subset=[label]).groupBy(label).agg(F.count(F.lit(1)).alias("n")), "classes")
    total = classes.agg(F.sum("n")).scalar()
    sized = classes.withColumn("_all", total).withColumn(
        "_train", F.col("_all") - F.ceil(F.lit(float(test_size)) * F.col("_all"))
    )
    share = F.col("n") * F.col("_train") / F.col("_all")
    floored = sized.withColumn("_base", F.floor(share)).withColumn("_rest", share - F.floor(share))
    missing = floored.agg(F.max("_train") - F.sum("_base")).first()[0] or 0  # fewer than there are classes
    extra = floored.orderBy(F.desc("_rest"), label).limit(int(missing)).select(label, F.lit(1).alias("_extra"))
    joined = floored.join(extra, label, "left")
    return joined.select(label, "n", (F.col("_base") + F.coalesce("_extra", F.lit(0))).cast("bigint").alias("train_n"))


def split_stratified(df: DataFrame, label: str, test_size: float, seed: int, key: list[str]) -> DataFrame:
    """Add ``part`` (train, test) with the class shares kept; the test part has ceil(test_size * n) rows."""
    units = df.dropna(subset=[label]).select(label, digest(seed, key).alias("_digest"))
    sizes = held(train_sizes(df, label, test_size).select(label, "train_n"), "sizes")
    cuts = held(rank_cuts(units, [label], {"train": F.col("train_n")}, sizes), "cuts")  # a row a class
    placed = _attach(df, cuts.select(label, F.col("bound").alias("_bound")), label)
    in_train = digest(seed, key) <= F.col("_bound")
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], F.when(in_train, F.lit("train")).otherwise(F.lit("test")).alias("part"))


def repeated_stratified(df: DataFrame, label: str, test_size: float, seeds: list[int], key: list[str]) -> DataFrame:
    """The bounds of many stratified splits in one pass: rows (seed, label, bound), one per seed and class.

    Rows of a class are in the training part of a seed up to the bound, as ``split_stratified`` places them.
    """
    units = df.dropna(subset=[label]).select(label, *key, F.explode(F.array(*map(F.lit, seeds))).alias("seed"))
    place = F.md5(F.concat_ws("|", F.col("seed").cast("string"), *[F.col(k).cast("string") for k in key]))
    sizes = train_sizes(df, label, test_size).select(label, "train_n", F.explode(F.array(*map(F.lit, seeds))).alias("seed"))
    cuts = rank_cuts(units.select("seed", label, place.alias("_digest")), ["seed", label], {"train": F.col("train_n")}, sizes)
    return cuts.select("seed", label, "bound")


def parts_of(df: DataFrame, bounds: DataFrame, label: str, seed: int, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of one seed, from the stored bounds of ``repeated_stratified`` (a row a class and seed)."""
    own = bounds.where(F.col("seed") == seed).select(label, F.col("bound").alias("_bound"))
    few = own.limit(FEW_CLASSES + 1).collect()
    if len(few) <= FEW_CLASSES:  # no join needed
        bound = F.lit(None).cast("string")
        for row in few:
            bound = F.when(F.col(label) == row[label], F.lit(row["_bound"])).otherwise(bound)
        placed = df.dropna(subset=[label]).withColumn("_bound", bound)
    else:
        placed = _attach(df.dropna(subset=[label]), own, label)
    in_train = F.coalesce(digest(seed, key) <= F.col("_bound"), F.lit(False))
    names = [F.col(f"`{c}`") for c in df.columns]
    return placed.where(in_train).select(*names), placed.where(~in_train).select(*names)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class: n / (classes * rows of the class)."""
    counts = df.dropna(subset=[label]).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    both = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))).scalar()
    weight = F.col("_all.rows") / (F.col("_all.classes") * F.col("n"))
    return counts.withColumn("_all", both).select(label, "n", weight.alias("weight"))


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(label, F.col("weight").alias(name))
    return _attach(df.drop(name), weights, label).select(*[F.col(f"`{c}`") for c in df.columns if c != name], name)


def majority_dummy(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Predict the most frequent training label (the smallest of equals) for every test row."""
    counts = train.dropna(subset=[label]).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    majority = counts.agg(F.min_by(label, F.struct(-F.col("n"), label))).scalar()
    return test.withColumn("prediction", majority)


def uniform_dummy(test: DataFrame, seed: int, key: list[str]) -> DataFrame:
    """Predict 0 or 1 with equal chance, fixed by seed and key."""
    last = F.substring(digest(seed, key), -1, 1)
    return test.withColumn("prediction", last.isin(*"89abcdef").cast("int"))
