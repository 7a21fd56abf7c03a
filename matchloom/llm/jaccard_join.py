"""Similarity join of documents by the Jaccard similarity of their word shingles.

Documents with equal shingle sets are one node (a 64-bit digest of the set). The rest goes in three steps:

1. Candidates. Shingles are ordered from rare to frequent by a count sketch of fixed size over all documents; two
   sets that link share one of their first shingles in any such order. Nodes that share one meet in a tile of that
   shingle. Sizes within a tile are sorted, so each node meets only the band of sizes that could link; hashed bitmaps
   (one bit flipped per shingle) bound the overlap from above: bits that differ are shingles that differ.
2. Nodes connected by passing pairs form clusters. Texts of cluster members are fetched once.
3. In the tiles of each cluster sorted arrays of shingles are intersected exactly.

A pair inside one component already found is not tested again, so large groups of near copies cost about one
test per document. Both kinds of tile emit a spanning forest, never all pairs; a tile list beyond ``TILE_ROWS`` is
dealt in blocks and every pair of blocks is a tile, so no list is gathered whole and none is cut. Components of the
forests come from contraction in chunks of bounded size and, between chunks, alternating stars on written tables.

Cases: a null or empty text has an empty set and links with nothing; fewer words than a shingle count as one shingle;
ties and repeated rows are nodes of equal sets; a null id takes part and gets the smallest id of its component (null if
it has none); an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.llm.common import U64, WORK_BYTES, Hasher, block_count, flat, grams, lower_table, mix, slices, spaced_words, store, word_spans

WORDS = 3
PERCENT = 90
SKETCH_BITS = 21
SKETCH_CHUNK = 1 << 16  # counters in a row
SIGNATURE_BITS = 1024  # carried with every posting
EXACT_BITS = 8192  # where the sets themselves are at hand
TILE_ROWS = 4096
TASK_ROWS = 512  # texts of clusters in a task
NEAR = 64  # neighbours tested first
CHUNK_ROWS = 1 << 20  # edges that a task contracts
MERGE_ROWS = 1 << 17  # edges read between two contractions


class Shingler:
    def __init__(self, words: int) -> None:
        self.words, self.hasher, self.lower, self.is_word = words, Hasher(), lower_table(), spaced_words()

    def shingles(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and hash of every shingle, repeats included."""
        data = self.lower[data]
        starts, ends, text = word_spans(data, at, self.is_word)
        hashes = self.hasher.ranges(self.hasher.prefix(data), starts, ends)
        full = grams(hashes, self.words)
        same = np.flatnonzero(text[: len(full)] == text[self.words - 1 :]) if len(full) else np.zeros(0, np.int64)
        of, found = [text[same]], [full[same]]
        count = np.bincount(text, minlength=len(at) - 1)
        first = np.cumsum(count) - count
        for n in range(1, self.words):
            short = np.flatnonzero(count == n)
            if len(short):
                whole = grams(hashes, n) ^ U64(n)
                of.append(short)
                found.append(whole[first[short]])
        return np.concatenate(of), np.concatenate(found)

    def sets(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all sets, sorted within each text, and the offsets of the texts."""
        text, found = self.shingles(data, at)
        order = np.argsort(found)
        text, found = text[order], found[order]
        kind = np.uint16 if len(at) <= 1 << 16 else np.int64
        order = np.argsort(text.astype(kind), kind="stable")
        text, found = text[order], found[order]
        new = np.ones(len(text), dtype=bool)
        new[1:] = (text[1:] != text[:-1]) | (found[1:] != found[:-1])
        text, found = text[new], found[new]
        return found, np.concatenate(([0], np.cumsum(np.bincount(text, minlength=len(at) - 1))))


def signature(shingles: np.ndarray, bits: int = SIGNATURE_BITS) -> np.ndarray:
    """The parity of the shingles in each of ``bits`` classes."""
    flips = np.bincount((mix(shingles) % U64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).view(U64)


def sketch(docs: DataFrame, text: str = "text", words: int = WORDS) -> np.ndarray:
    """Counts of all shingles in ``2 ** SKETCH_BITS`` classes; its size does not depend on the documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts, any_row = Shingler(words), np.zeros(1 << SKETCH_BITS, dtype=np.int64), False
        for batch in batches:
            for _, _, data, at in slices(*flat(batch.column("text")), limit=WORK_BYTES):
                _, found = shingler.shingles(data, at)
                np.add.at(counts, (found >> U64(64 - SKETCH_BITS)).astype(np.int64), 1)
                any_row = True
        for k in range(0, len(counts), SKETCH_CHUNK) if any_row else ():
            part = counts[k : k + SKETCH_CHUNK].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([part], pa.binary())], names=["chunk", "counts"])

    def add(chunks: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.int64) for x in chunks.column("counts"))
        return pa.table({"chunk": chunks.column("chunk")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "chunk long, counts binary")
    rows = rows.groupBy("chunk").applyInArrow(add, "chunk long, counts binary").collect()
    out = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    for r in rows:
        out[r["chunk"] : r["chunk"] + SKETCH_CHUNK] = np.frombuffer(r["counts"], np.int64)
    return out


def nodes(docs: DataFrame, text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, _text (its digest), n_shingles, node (digest of the set), signature, firsts (rarest shingles)."""
    ranks = sketch(docs, text, words)
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(ranks, (1 << 31) - 1).astype(np.int32))
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("_text", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("node", T.LongType()),
            T.StructField("signature", T.BinaryType()),
            T.StructField("firsts", T.ArrayType(T.LongType())),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts = Shingler(words), shared.value
        for batch in batches:
            sizes, digests, signatures, firsts, offsets = [], [], [], [], [0]
            for _, _, data, at in slices(*flat(batch.column("text")), limit=WORK_BYTES):
                found, edge = shingler.sets(data, at)
                size = np.diff(edge)
                sizes.append(size)
                total = np.zeros(len(found) + 1, dtype=U64)
                np.cumsum(mix(found), out=total[1:])
                digests.append(mix((total[edge[1:]] - total[edge[:-1]]) ^ size.astype(U64)))
                take = size - -(-percent * size // 100) + (size > 0)
                rank = counts[(found >> U64(64 - SKETCH_BITS)).astype(np.int64)]
                for k in range(len(size)):
                    own = found[edge[k] : edge[k + 1]]
                    order = np.lexsort((own, rank[edge[k] : edge[k + 1]]))
                    firsts.append(own[order[: take[k]]])
                    signatures.append(signature(own).tobytes())
                offsets += (offsets[-1] + np.cumsum(take)).tolist()
            tokens = np.concatenate(firsts).view(np.int64) if firsts else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(tokens))
            join = lambda parts: np.concatenate(parts).astype(U64).view(np.int64) if parts else np.zeros(0, np.int64)
            columns = [batch.column("doc_id"), batch.column("_text"), pa.array(join(sizes)), pa.array(join(digests)), pa.array(signatures, pa.binary()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    rows = docs.select("doc_id", F.xxhash64(F.col(text)).alias("_text"), F.col(text).alias("text"))
    return rows.mapInArrow(read, schema)


def forest(sizes: np.ndarray, signatures: np.ndarray, percent: int, linked: Callable[[int, int], bool] | None = None) -> np.ndarray:
    """Pairs (first, other) that span the components of the pairs whose sizes and bitmaps allow a link (and that
    ``linked`` confirms). ``sizes`` rise."""
    n, label = len(sizes), np.arange(len(sizes))
    low = np.searchsorted(100 * sizes, percent * sizes)
    for k in range(1, n):
        first = max(int(low[k]), k - NEAR)
        for window in (np.arange(k - 1, first - 1, -1), np.arange(int(low[k]), first)):
            window = window[label[window] != label[k]]
            for start in range(0, len(window), 2048):
                test = window[start : start + 2048]
                test = test[label[test] != label[k]]
                differ = np.bitwise_count(signatures[test] ^ signatures[k]).sum(axis=1, dtype=np.int64)
                for j in test[(100 + percent) * differ <= (100 - percent) * (sizes[test] + sizes[k])]:
                    if label[j] != label[k] and (linked is None or linked(int(j), k)):
                        label[label == label[j]] = label[k]
    _, first, group = np.unique(label, return_index=True, return_inverse=True)
    other = np.flatnonzero(first[group] != np.arange(n))
    return np.stack((first[group[other]], other), axis=1)


def tiles(rows: DataFrame, key: str, tile_rows: int, task_rows: int) -> DataFrame:
    """``rows`` (a written table) with the task group (_group, _i, _j) each of its tiles falls to.

    Lists of up to ``tile_rows`` are one tile, and those of about ``task_rows`` rows share a group; a longer list is dealt in blocks, and
    every pair of blocks is a tile and a group of its own.
    """
    groups = max(1, -(-rows.count() // task_rows))
    sizes = rows.groupBy(key).agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("_n")).where("_n > 1")
    group = F.when(F.col("_n").isNull(), F.pmod(F.xxhash64(key), F.lit(groups))).otherwise(F.xxhash64(key))
    block = F.pmod(F.xxhash64("node"), F.coalesce(F.col("_n"), F.lit(1))).cast("int")
    others = F.expr("transform(sequence(0, coalesce(_n, 1) - 1), x -> struct(least(x, _block) AS i, greatest(x, _block) AS j))")
    return (
        rows.join(sizes, key, "left")
        .withColumns({"_block": block, "_group": group})
        .withColumn("_tile", F.explode(others))
        .select(*rows.columns, "_group", F.col("_tile.i").alias("_i"), F.col("_tile.j").alias("_j"))
    )


def per_tile(rows: DataFrame, key: str, tile_rows: int, task_rows: int, spans: Callable) -> DataFrame:
    """Edges (a, b) from ``spans``, which gets the rows of one task group and the row numbers of each of its tiles."""

    def run(group: pa.Table) -> pa.Table:
        keys = group.column(key).to_numpy()
        order = np.argsort(keys, kind="stable")
        edge = np.flatnonzero(np.diff(keys[order], prepend=keys[order][:1] - 1))
        lists = [order[a:b] for a, b in zip(edge, np.append(edge[1:], len(order)))]
        node = group.column("node").to_numpy()
        pairs = [node[np.array(x, dtype=np.int64).reshape(-1, 2)] for x in spans(group, lists)]
        pairs = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return tiles(rows, key, tile_rows, task_rows).groupBy("_group", "_i", "_j").applyInArrow(run, "a long, b long")


def candidates(found: DataFrame, percent: int = PERCENT, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges (a, b) whose components hold every pair of linked nodes."""
    per_node = found.where("n_shingles > 0").dropDuplicates(["node"])
    postings = per_node.select("node", F.explode("firsts").alias("token"))
    lists = postings.groupBy("token").agg(
        F.min("node").alias("low"),
        F.max("node").alias("high"),
        F.count("*").alias("n"),
        F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("sum"),
    )
    # Shingles with the same list of nodes are told by what sums up the list; one of them stands for all.
    shared = lists.where("low <> high").groupBy("low", "high", "n", "sum").agg(F.min("token").alias("token")).select("token")
    few = postings.join(shared, "token")
    rows = store(few.join(per_node.select("node", "n_shingles", "signature"), "node"), "postings")

    def spans(group: pa.Table, lists: list[np.ndarray]) -> Iterator[list]:
        size = group.column("n_shingles").to_numpy()
        node = group.column("node").to_numpy()
        bits = np.frombuffer(b"".join(group.column("signature").to_pylist()), U64).reshape(len(size), -1)
        two = np.array([x for x in lists if len(x) == 2], dtype=np.int64).reshape(-1, 2)
        differ = np.bitwise_count(bits[two[:, 0]] ^ bits[two[:, 1]]).sum(axis=1, dtype=np.int64)
        small, large = np.minimum(size[two[:, 0]], size[two[:, 1]]), np.maximum(size[two[:, 0]], size[two[:, 1]])
        yield two[(100 * small >= percent * large) & ((100 + percent) * differ <= (100 - percent) * (small + large))]
        for own in lists:
            if len(own) > 2:
                own = own[np.lexsort((node[own], size[own]))]
                yield own[forest(size[own], bits[own], percent)]

    return per_tile(rows, "token", tile_rows, tile_rows, spans)


def contract(edges: DataFrame, tasks: int, chunk_rows: int) -> DataFrame:
    """Edges (a, b) with the same components: in each of ``tasks`` those read so far are replaced by one from each of
    their nodes to the least of its component there. Beyond ``chunk_rows`` such edges a task hands them on and starts anew.
    """

    def least(pairs: np.ndarray) -> np.ndarray:
        nodes, at = np.unique(pairs, return_inverse=True)
        a, b = at.reshape(2, -1)
        root = np.arange(len(nodes))
        while True:
            low, new = np.minimum(root[a], root[b]), root.copy()
            np.minimum.at(new, root[a], low)
            np.minimum.at(new, root[b], low)
            while (new[new] != new).any():
                new = new[new]
            if (new == root).all():
                break
            root = new
        own = np.flatnonzero(root != np.arange(len(nodes)))
        return np.stack((nodes[own], nodes[root[own]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = lambda pairs: pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])
        held, waiting, n = np.zeros((2, 0), np.int64), [], 0
        for batch in batches:
            waiting.append(np.stack((batch.column("a").to_numpy(), batch.column("b").to_numpy())))
            n += batch.num_rows
            if n >= min(MERGE_ROWS, chunk_rows):
                held, waiting, n = least(np.concatenate((held, *waiting), axis=1)), [], 0
                if held.shape[1] >= chunk_rows:
                    yield out(held)
                    held = held[:, :0]
        yield out(least(np.concatenate((held, *waiting), axis=1)))

    return edges.coalesce(tasks).mapInArrow(run, "a long, b long")


def components(edges: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Rows (node, component): the smallest node each node of an edge is connected with. Edges are contracted in
    chunks; what the chunks leave open goes through alternating stars, each step two joins on written tables, and is
    contracted again. The number of steps grows with the logarithm of the longest path between chunks."""

    def star(pairs: DataFrame, small: bool) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if small:
            both = both.where("b < a")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = both.join(least, "a")
        out = joined.where("b <> m" if small else "b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        if small:
            out = out.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        return out.where("a <> b")

    def state(pairs: DataFrame) -> tuple[int, int]:
        """Edges, and nodes that are not yet either a component or in one edge to it."""
        ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up"))))
        per_node = pairs.select(ends.alias("end")).select("end.*").groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("low"))
        return tuple(per_node.agg(F.coalesce(F.sum("ups"), F.lit(0)), F.expr("count_if(ups > 1 or ups = 1 and low = 0)")).first())

    now = store(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    n, left = now.count(), 1
    while left:
        now = store(contract(now, block_count(n, chunk_rows), chunk_rows), "stars")
        n, left = state(now)
        if left:
            now = store(star(star(now, False), True), "stars")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.withColumn("component", F.col("node")))


def links(docs: DataFrame, found: DataFrame, text: str, words: int, percent: int, tile_rows: int) -> DataFrame:
    """Exact edges (a, b) that span the components of linked nodes."""
    clusters = components(candidates(found, percent, tile_rows))
    reps = found.groupBy("node").agg(F.min(F.struct("doc_id", "_text")).alias("rep"))
    wanted = store(
        clusters.withColumnRenamed("component", "cluster").join(reps, "node").select("node", "cluster", F.col("rep.doc_id").alias("_id"), F.col("rep._text").alias("_digest")),
        "clusters",
    )
    texts = docs.select("doc_id", F.xxhash64(F.col(text)).alias("_text"), F.col(text).alias("text"))
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_digest"))
    # The same plan at every size: both sides by id.
    rows = store(texts.join(wanted.hint("merge"), on).select("node", "cluster", "text"), "cluster-texts")

    def spans(group: pa.Table, lists: list[np.ndarray]) -> Iterator[list]:
        data, at = flat(group.column("text"))
        node = group.column("node").to_numpy()
        shingler, sets = Shingler(words), [None] * len(node)
        for first, _, part, offsets in slices(data, at, WORK_BYTES):
            hashes, edge = shingler.sets(part, offsets)
            for k in range(len(offsets) - 1):
                sets[first + k] = hashes[edge[k] : edge[k + 1]]
        for own in lists:
            _, once = np.unique(node[own], return_index=True)
            own = np.array(sorted(own[once], key=lambda k: (len(sets[k]), node[k])), dtype=np.int64)
            sizes = np.array([len(sets[k]) for k in own], dtype=np.int64)
            bits = np.stack([signature(sets[k], EXACT_BITS) for k in own])

            def linked(i: int, j: int) -> bool:
                a, b = sets[own[i]], sets[own[j]]
                both = len(np.intersect1d(a, b, assume_unique=True))
                return 100 * both >= percent * (len(a) + len(b) - both)

            yield own[forest(sizes, bits, percent, linked)]

    return per_tile(rows, "cluster", tile_rows, TASK_ROWS, spans)


def grouped(
    docs: DataFrame, text: str = "text", words: int = WORDS, percent: int = PERCENT, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """Rows (doc_id, _text, n_shingles, component_id, first), one per document: the smallest id reachable by links,
    and whether this is the document with it."""
    found = store(nodes(docs, text, words, percent), "shingle-sets")
    joined = store(components(links(docs, found, text, words, percent, tile_rows)), "components")
    rows = found.select("doc_id", "_text", "n_shingles", "node").join(joined, "node", "left").withColumn("_class", F.coalesce("component", "node"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_text")).alias("_first")
    rows = rows.join(rows.where("n_shingles > 0").groupBy("_class").agg(first), "_class", "left")
    linked = F.col("n_shingles") > 0
    same = F.col("doc_id").eqNullSafe(F.col("_first.doc_id")) & (F.col("_text") == F.col("_first._text"))
    return rows.select(
        "doc_id",
        "_text",
        "n_shingles",
        F.when(linked, F.col("_first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(linked, same).otherwise(True).alias("first"),
    )


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id (of equal rows, one). Empty texts
    link with nothing and all stay."""
    keep = (
        grouped(docs, "text", words, percent, tile_rows)
        .where("first")
        .groupBy(F.col("doc_id").alias("_id"), F.col("_text").alias("_digest"))
        .agg(F.max("n_shingles").alias("_size"), F.count("*").alias("_times"))
    )
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_of"), F.xxhash64("text").alias("_t"))
    kept = row.join(keep, F.col("_of").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_digest")))
    alone = kept.where("_size = 0 or _times = 1").select("_row")
    repeated = kept.where("_size > 0 and _times > 1").groupBy("_id", "_digest").agg(F.first("_row").alias("_row")).select("_row")
    return alone.unionByName(repeated).select("_row.*")
