"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Each source has a share of all words; no source gives more than ``most_copies`` times its words, and what it
cannot give is shared out again by weight (water-filling, solved in one pass over the sources in the order in
which they fill up). A document of a source with target t and size s is wanted t / s times: the whole part is
certain, the rest is its inclusion probability p, which differs from source to source. Pareto sampling ranks
documents by q = (u / (1 - u)) / (p / (1 - p)) with a uniform number u and takes the first ones until the
source's remaining words are reached, so its words are fixed to within half a document.

The cut is found without sorting a source in one task: two histograms of 4096 ranges each narrow it down (sums per
source and range), and only documents in the last range are ordered. u comes from a digest of id and size, so
reruns agree.

Cases: a null text has size 0 and is taken 0 times; null sources are one source, last in order; rows that agree in
id and size are interchangeable; an empty table gives an empty result. The sources themselves (one row each)
are ordered in one task; they are a dimension of the corpus. Other columns are not read by ``plan_mix`` and pass
unchanged through ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import store

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = "mix-1"
RANGES = 4096
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: str = "text") -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: str = SEED) -> F.Column:
    """A number in (0, 1) from the document's id and size: 52 bits of a digest."""
    name = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("_size").cast("string"))
    return (F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """Rows (_source, _total, _target, _whole, _p, _rest): of each source its words, target, certain copies of each
    document, inclusion probability of one more, and the words those must bring."""
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    by_fill = Window.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    sources = (
        sizes.groupBy("_source")
        .agg(F.sum("_size").alias("_total"))
        .withColumn("_rank", F.row_number().over(by_name))
        .withColumns({"_weight": weight.cast("double"), "_cap": (F.col("_total") * most_copies).cast("double"), "_all": F.sum("_total").over(everything).cast("double")})
        .withColumns(
            {
                "_open": F.sum("_weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)),
                "_filled": F.coalesce(F.sum("_cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
            }
        )
        .withColumn("_full", F.col("_cap") * F.col("_open") < F.col("_weight") * (F.col("_all") - F.col("_filled")))
        .withColumns(
            {
                "_left": F.col("_all") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(everything), F.lit(0.0)),
                "_among": F.sum(F.when(~F.col("_full"), F.col("_weight"))).over(everything),
            }
        )
        .withColumn("_target", F.when(F.col("_full"), F.col("_cap")).otherwise(F.col("_weight") * F.col("_left") / F.col("_among")))
    )
    copies = F.when(F.col("_total") > 0, F.col("_target") / F.col("_total")).otherwise(0.0)
    return sources.withColumn("_whole", F.floor(copies)).select(
        "_source",
        "_total",
        "_target",
        "_whole",
        (copies - F.col("_whole")).alias("_p"),
        (F.col("_target") - F.col("_whole") * F.col("_total")).alias("_rest"),
    )


def _place() -> F.Column:
    """The Pareto rank q as q / (1 + q), which keeps its order and lies in (0, 1)."""
    q = (F.col("_u") / (1 - F.col("_u"))) / (F.col("_p") / (1 - F.col("_p")))
    return F.when(F.col("_p") > 0, q / (1 + q)).otherwise(1.0)


def _cut(rows: DataFrame, part: str, cut: str, before: str, start: F.Column) -> DataFrame:
    """Per source the first range whose words go beyond the rest, and the words that lie before it."""
    running = Window.partitionBy("_source").orderBy(part)
    total = F.sum("_words").over(running.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_start")
    return (
        rows.groupBy("_source", part)
        .agg(F.sum("_size").alias("_words"), F.max("_rest").alias("_rest"), F.max(start).alias("_start"))
        .withColumn("_upto", total)
        .where(F.col("_upto") > F.col("_rest"))
        .groupBy("_source")
        .agg(F.min(F.struct(F.col(part), (F.col("_upto") - F.col("_words")).alias("w"))).alias("_first"))
        .select("_source", F.col(f"_first.{part}").alias(cut), F.col("_first.w").alias(before))
    )


def _with(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    right = per_source.withColumnRenamed("_source", "_of")
    return rows.join(right, F.col("_source").eqNullSafe(F.col("_of")), "left").drop("_of")


def _placed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    return (
        _with(rows, plan)
        .withColumn("_q", _place())
        .withColumn("_part", F.floor(F.col("_q") * RANGES))
        .withColumn("_fine", F.floor((F.col("_q") * RANGES - F.col("_part")) * RANGES))
    )


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """doc_id, _source, _size, _u of each document."""
    rows = docs.select("doc_id", F.col("source").alias("_source"), size_of().alias("_size"))
    return rows.withColumn("_u", uniform(seed))


def plan_mix(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """Per source what ``source_targets`` gives and the two ranges in which its cut lies (a written table)."""
    plan = store(source_targets(sizes, weights, most_copies), "mix-targets")
    rows = _placed(sizes, plan)
    first = store(_cut(rows, "_part", "_cut", "_before", F.lit(0)), "mix-cut")
    open_rows = _with(rows, first).where(F.col("_part") == F.col("_cut"))
    second = _cut(open_rows, "_fine", "_fine_cut", "_fine_before", F.col("_before"))
    return store(_with(_with(plan, first), second), "mix-plan")


def taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (with _source, _size, _u) and how many copies of each the mix takes, as ``_copies``."""
    placed = _placed(rows, plan)
    last = F.coalesce((F.col("_part") == F.col("_cut")) & (F.col("_fine") == F.col("_fine_cut")), F.lit(False))
    sure = F.col("_cut").isNull() | (F.col("_part") < F.col("_cut"))
    sure |= (F.col("_part") == F.col("_cut")) & (F.col("_fine_cut").isNull() | (F.col("_fine") < F.col("_fine_cut")))
    in_order = Window.partitionBy("_source").orderBy("_q", "doc_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_fine_before") + F.coalesce(F.sum("_size").over(in_order), F.lit(0))
    near = placed.where(last).withColumn("_more", before + F.col("_size") / 2 <= F.col("_rest"))
    far = placed.where(~last).withColumn("_more", sure)
    return far.unionByName(near).withColumn("_copies", F.col("_whole") + ((F.col("_p") > 0) & F.col("_more")).cast("long"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken), one per document; texts are read once."""
    sizes = store(sized(docs, seed), "mix-sizes")
    return taken(sizes, plan_mix(sizes, weights, most_copies)).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_total").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """The documents of the mix with their columns, ``size`` (words) and ``copies`` (how often to read each); columns of
    these two names are replaced."""
    plan = plan_mix(store(sized(docs, seed), "mix-sizes"), weights, most_copies)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("size", "copies")]).alias("_row")
    rows = docs.select("doc_id", F.col("source").alias("_source"), size_of().alias("_size"), row).withColumn("_u", uniform(seed))
    copies = taken(rows, plan).where("_copies > 0")
    return copies.select("_row.*", F.col("_size").alias("size"), F.col("_copies").alias("copies"))
