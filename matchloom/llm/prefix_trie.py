"""Tries of conversations: shared beginnings, counted node by node, over z-fast tries of sorted ranges.

A conversation is a sequence of turns; each turn is told by a 128-bit digest of role and text and its length in code points,
so texts are read once and never shuffled. Equal sequences are counted first. Their paths (the digests one after another)
are dealt out by range, so each task holds neighbours in the order of paths, however many share a first turn. A
task builds a compacted trie of its range: nodes with more than one way on, or an end, are kept in a table by the digest
of their prefix at the two-fattest depth of their edge, and each sequence finds the node where it leaves the trie by fat
binary search over depths, a look-up each. A batch of sequences is located first, against the trie as it
stands, and then inserted from there down. At the end edges are expanded into a row for each depth.

Ranges share nodes only on the paths of their first and last sequence. Those rows (at most two paths a range) are
summed by prefix; sums over their subtrees come from running sums in the order (first path through the node, depth), in which
a subtree is one interval. All other rows are final where they were made. The smallest conversation of a parent in
two ranges is joined by range and prefix, so no parent gathers its children in one task.

Hashes of the conversations that end in a node are taken over their numbers in order as a stream, from packed pieces.

Cases: null role or text counts as empty; turns with equal numbers are in the order of their digests (null numbers
first), repeated rows are turns of their own; rows without conversation id belong to no conversation and are passed over; a
conversation without turns ends in the root; no conversations give no rows; other columns are not read.
One conversation's digests (20 bytes a turn) are one row, as its texts' record is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import store

WIDTH = 16  # bytes of a digest
ROOT = bytes(WIDTH)
RANGE_TURNS = 200_000  # turns of distinct sequences a task
FAMILY, KINDS = 100, 6

NODES = (
    "part int, prefix binary, parent binary, depth long, size long, n_convs long, first_conv long, parent_first long, "
    "n_children long, n_leaves long, saved long, shared boolean, from_path long, to_path long"
)


# Sequences


def turns(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, _turns): each conversation's turns in order, as (digest in hex, code points)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct(F.col("turn").alias("turn"), digest.alias("digest"), F.length(text).alias("size"))
    rows = conversations.where("conv_id is not null").select("conv_id", turn.alias("_turn"))
    in_order = F.transform(F.sort_array(F.collect_list("_turn")), lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size")))
    return rows.groupBy("conv_id").agg(in_order.alias("_turns"))


def with_borrowed_heads(convs: DataFrame) -> DataFrame:
    """Each conversation with its first few turns replaced by those of the first one of its hundred, by a rule from its id."""
    n = F.crc32(F.col("conv_id").cast("string")) % KINDS
    heads = convs.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("_of"), F.slice("_turns", 1, KINDS - 1).alias("_head"))
    rows = convs.withColumns({"_n": n.cast("int"), "_base": F.col("conv_id") - F.col("conv_id") % FAMILY}).join(heads, F.col("_base") == F.col("_of"), "left")
    none = F.array().cast("array<struct<digest:string,size:int>>")
    head = F.when(F.col("_n") > 0, F.coalesce(F.slice("_head", 1, F.greatest("_n", F.lit(1))), none)).otherwise(none)
    rest = F.slice("_turns", F.col("_n") + 1, F.greatest(F.size("_turns"), F.lit(1)))
    return rows.select("conv_id", F.concat(head, rest).alias("_turns"))


def paths(convs: DataFrame) -> DataFrame:
    """Rows (conv_id, path, sizes): the digests one after another, and the code points of the turns, four bytes each."""
    joined = F.unhex(F.array_join(F.transform("_turns", lambda t: t["digest"]), ""))
    sizes = F.unhex(F.array_join(F.transform("_turns", lambda t: F.lpad(F.hex(t["size"].cast("long")), 8, "0")), ""))
    return convs.select("conv_id", joined.alias("path"), sizes.alias("sizes"))


def prefixes(path: bytes) -> bytes:
    """The digest of each prefix, that of no turns first; each from the one before and the next turn."""
    out = [ROOT]
    for k in range(0, len(path), WIDTH):
        out.append(hashlib.md5(out[-1] + path[k : k + WIDTH]).digest())
    return b"".join(out)


# The trie of one range


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that the highest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class Sequence:
    """A distinct sequence: digests of its turns and of its prefixes, code points, its conversations and the least of them."""

    __slots__ = ("path", "ids", "sizes", "n", "first", "length")

    def __init__(self, path: bytes, sizes: bytes, n: int, first: int) -> None:
        self.path, self.ids, self.sizes, self.n, self.first = path, prefixes(path), sizes, n, first
        self.length = len(path) // WIDTH

    def turn(self, depth: int) -> bytes:
        """The turn that follows the prefix of this depth."""
        return self.path[depth * WIDTH : (depth + 1) * WIDTH]

    def prefix(self, depth: int) -> bytes:
        return self.ids[depth * WIDTH : (depth + 1) * WIDTH]

    def size(self, depth: int) -> int:
        """Code points of the last turn of the prefix of this depth."""
        return int.from_bytes(self.sizes[depth * 4 - 4 : depth * 4], "big") if depth else 0


class Node:
    """The end of a compacted edge: depths (low, high] of the sequence that labels it."""

    __slots__ = ("low", "high", "label", "parent", "ways", "n", "first", "leaves", "saved", "shared")

    def __init__(self, low: int, high: int, label: Sequence, parent: Node | None) -> None:
        self.low, self.high, self.label, self.parent = low, high, label, parent
        self.ways: dict[bytes, Node] = {}
        self.n, self.first, self.leaves, self.saved, self.shared = 0, None, 0, 0, False


class ZFastTrie:
    """Compacted trie whose nodes are found by the digest of their prefix at the two-fattest depth of their edge."""

    def __init__(self) -> None:
        self.root: Node | None = None
        self.handles: dict[bytes, Node] = {}

    def locate(self, x: Sequence, start: Node | None = None) -> tuple[Node, int]:
        """The exit node of ``x`` and the depth at which it leaves the trie: the node whose edge (or end) holds the last
        prefix that ``x`` shares. Look-ups start below ``start``, a node that ``x`` passes."""
        node = start or self.root
        low, high = node.high, x.length
        while low < high:
            depth = two_fattest(low, high)
            found = self.handles.get(x.prefix(depth))
            if found is None:
                high = depth - 1
            elif found.high <= x.length and found.label.prefix(found.high) == x.prefix(found.high):
                node, low = found, found.high
            else:
                return found, self.common(found, x, depth)
        way = node.ways.get(x.turn(node.high)) if node.high < x.length else None
        return (way, self.common(way, x, node.high + 1)) if way is not None else (node, node.high)

    @staticmethod
    def common(node: Node, x: Sequence, known: int) -> int:
        """The greatest depth on the node's edge at which ``x`` still agrees, from one where it does."""
        low, high = known, min(node.high, x.length)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if node.label.prefix(middle) == x.prefix(middle) else (low, middle - 1)
        return low

    def _named(self, node: Node) -> None:
        self.handles[node.label.prefix(two_fattest(node.low, node.high))] = node

    def _split(self, node: Node, depth: int) -> Node:
        """A new node within the edge of ``node``."""
        parent = node.parent
        upper = Node(node.low, depth, node.label, parent)
        del self.handles[node.label.prefix(two_fattest(node.low, node.high))]
        parent.ways[node.label.turn(node.low)] = upper
        upper.ways[node.label.turn(depth)] = node
        node.low, node.parent = depth, upper
        self._named(upper)
        self._named(node)
        return upper

    def insert(self, x: Sequence, start: Node | None = None) -> None:
        node, depth = self.locate(x, start)
        if depth < node.high:
            node = self._split(node, depth)
        if depth < x.length:
            leaf = Node(depth, x.length, x, node)
            node.ways[x.turn(depth)] = leaf
            self._named(leaf)
            node = leaf
        node.n += x.n  # for now those that end here
        node.first = x.first if node.first is None else min(node.first, x.first)

    def insert_batch(self, batch: Iterable[Sequence]) -> None:
        """Find every exit in the trie as it stands, then insert from the exit node's parent down."""
        batch = list(batch)
        if self.root is None and batch:
            self.root = Node(0, 0, batch[0], None)
        exits = [self.locate(x)[0] for x in batch]
        for x, node in zip(batch, exits):
            start = node.parent or node
            # A node that was split since then still has its parent above it on the same path.
            self.insert(x, start if start.high <= x.length and start.label.prefix(start.high) == x.prefix(start.high) else None)

    def total(self, shared: set[bytes]) -> list[Node]:
        """All nodes, parents first, with sums over their subtrees; those on a path in ``shared`` get only what hangs on
        them beside such paths."""
        order = [self.root] if self.root else []
        for node in order:
            order.extend(node.ways.values())
        for node in reversed(order):
            node.shared = node.label.prefix(node.high) in shared
            for way in node.ways.values():
                node.n += way.n
                node.first = way.first if node.first is None else min(node.first, way.first)
                if not way.shared:
                    node.leaves += way.leaves
                    node.saved += way.saved + (way.n - 1) * sum(way.label.size(d) for d in range(way.low + 1, way.high + 1))
            if not node.ways and not node.shared:
                node.leaves = 1
        return order

    def rows(self, shared: set[bytes]) -> Iterator[tuple]:
        """A row for each depth of each edge: (prefix, parent, depth, size, n_convs, first_conv, parent_first, n_children,
        n_leaves, saved, shared); of shared nodes the sums without their shared children, and saved without their own."""
        for node in self.total(shared):
            above, saved = node.parent, node.saved
            for depth in range(node.high, node.low - (above is None), -1):
                size = node.label.size(depth)
                last = depth == node.high
                if node.shared:
                    children = sum(not w.shared for w in node.ways.values()) if last else 0
                    leaves, own = (node.leaves, node.saved) if last else (0, 0)
                else:
                    children = len(node.ways) if last else 1
                    saved += (node.n - 1) * size
                    leaves, own = node.leaves, saved
                first_above = node.first if depth - 1 > node.low else above.first if above else None
                yield (
                    node.label.prefix(depth), node.label.prefix(depth - 1) if depth else None, depth, size, node.n, node.first,
                    None if node.shared or (depth - 1 == node.low and above is not None and above.shared) else first_above,
                    children, leaves, own, node.shared,
                )


def range_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The expanded trie of one range."""
    part, trie = TaskContext.get().partitionId(), ZFastTrie()
    least: Sequence | None = None
    most: Sequence | None = None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("path", "sizes", "n", "first"))
        sequences = [Sequence(*r) for r in zip(*columns)]
        trie.insert_batch(sequences)
        ends = [x for x in (least, most) if x is not None] + sequences
        least, most = min(ends, key=lambda x: x.path, default=None), max(ends, key=lambda x: x.path, default=None)
    if least is None:
        return
    edges = [{x.prefix(d) for d in range(x.length + 1)} for x in (least, most)]
    kinds = [pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 8, pa.bool_(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in NODES.split(", ")]
    block = []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*block), kinds)], names=names)

    for row in trie.rows(edges[0] | edges[1]):
        between = (2 * part + (row[0] not in edges[0]), 2 * part + (row[0] in edges[1])) if row[-1] else (None, None)
        block.append((part, *row, *between))
        if len(block) == 10_000:
            yield made()
            block.clear()
    if block:
        yield made()


# All ranges


def _spine(nodes: DataFrame) -> DataFrame:
    """The nodes that ranges share, whole: summed by prefix, with sums over their subtrees."""
    parts = nodes.where("shared")
    merged = parts.groupBy("prefix").agg(
        *[F.first(c).alias(c) for c in ("parent", "depth", "size")],
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        F.min("first_conv").alias("first_conv"), F.min("from_path").alias("from_path"), F.max("to_path").alias("to_path"),
    )
    merged = store(merged, "trie-shared")
    below = merged.where("parent is not null").groupBy(F.col("parent").alias("_of")).agg(F.count("*").alias("_below"))
    whole = merged.join(below, F.col("prefix") == F.col("_of"), "left").drop("_of").withColumn("n_children", F.col("n_children") + F.coalesce("_below", F.lit(0)))
    leaf, own = (F.col("n_children") == 0).cast("long"), (F.col("n_convs") - 1) * F.col("size")
    whole = store(whole.drop("_below").withColumns({"n_leaves": F.col("n_leaves") + leaf, "saved": F.col("saved") + own}), "trie-spine")
    # Two paths a range: the order of all paths is a small table.
    known = whole.select(F.explode(F.array("from_path", "to_path")).alias("_path")).distinct()
    owned = whole.groupBy(F.col("from_path").alias("_own")).agg(F.sum("n_leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
    by_path = known.join(owned, F.col("_path") == F.col("_own"), "left").fillna(0, ["_leaves", "_saved"])
    so_far = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, 0)
    ends = store(by_path.select("_path", "_leaves", "_saved", F.sum("_leaves").over(so_far).alias("_l"), F.sum("_saved").over(so_far).alias("_s")), "trie-path-sums")
    upto = ends.select(F.col("_path").alias("_b"), "_l", "_s")
    before = ends.select(F.col("_path").alias("_a"), (F.col("_l") - F.col("_leaves")).alias("_l0"), (F.col("_s") - F.col("_saved")).alias("_s0"))
    above = Window.partitionBy("from_path").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    rows = whole.withColumns({f"_{c}_above": F.coalesce(F.sum(c).over(above), F.lit(0)) for c in ("n_leaves", "saved")})
    rows = rows.join(before, F.col("from_path") == F.col("_a")).join(upto, F.col("to_path") == F.col("_b"))
    sums = {"n_leaves": F.col("_l") - F.col("_l0") - F.col("_n_leaves_above"), "saved": F.col("_s") - F.col("_s0") - F.col("_saved_above")}
    parents = whole.select(F.col("prefix").alias("_of"), F.col("first_conv").alias("parent_first"))
    names = ("prefix", "depth", "n_convs", "first_conv", "parent_first", "n_children", "n_leaves", "saved")
    return rows.withColumns(sums).join(parents, F.col("parent") == F.col("_of"), "left").select(*names)


def trie(sequences: DataFrame, range_turns: int = RANGE_TURNS) -> DataFrame:
    """Rows (prefix, depth, n_convs, first_conv, parent_first, n_children, n_leaves, saved), one per node, of sequences
    (path, sizes, n, first): distinct paths with the number of their conversations and the least of them."""
    sequences = store(sequences, "trie-sequences")
    turns_of_all = sequences.agg(F.sum(F.length("path"))).first()[0] or 0
    ranges = max(1, -(-turns_of_all // (WIDTH * range_turns)), sequences.sparkSession.sparkContext.defaultParallelism)
    nodes = store(sequences.repartitionByRange(ranges, "path").mapInArrow(range_rows, NODES), "trie-nodes")
    spine = store(_spine(nodes), "trie-totals")
    # Within a range, each shared node's least conversation over all ranges.
    in_part = nodes.where("shared").select(F.col("part").alias("_part"), F.col("prefix").alias("_of")).join(spine.select("prefix", F.col("first_conv").alias("_above")), F.col("_of") == F.col("prefix")).drop("prefix")
    own = nodes.where("not shared")
    hung = own.where("parent_first is null").drop("parent_first").join(in_part, (F.col("part") == F.col("_part")) & (F.col("parent") == F.col("_of")))
    names = spine.columns
    return spine.unionByName(hung.withColumn("parent_first", F.col("_above")).select(*names)).unionByName(own.where("parent_first is not null").select(*names))


# Ends


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known: dict[bytes, bytes] = {}
        ends = []
        for path in batch.column("path").to_pylist():
            if path not in known:
                known[path] = prefixes(path)[-WIDTH:]
            ends.append(known[path])
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(ends, pa.binary())], names=["conv_id", "prefix"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv_id, prefix) as a row for each prefix of a batch: its numbers, joined by commas."""
    for batch in batches:
        pieces: dict[bytes, list[int]] = {}
        for conv, prefix in zip(batch.column("conv_id").to_pylist(), batch.column("prefix").to_pylist()):
            pieces.setdefault(prefix, []).append(conv)
        joined = [",".join(map(str, ids)).encode() for ids in pieces.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(pieces), pa.binary()), pa.array([ids[0] for ids in pieces.values()], pa.int64()), pa.array(joined, pa.binary())], names=["prefix", "start", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each prefix's numbers, of rows sorted by prefix and start: one running hash, whatever the group's size."""
    now, running = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for prefix, ids in zip(batch.column("prefix").to_pylist(), batch.column("ids").to_pylist()):
            if prefix == now:
                running.update(b"," + ids)
                continue
            if running is not None:
                done.append((now, running.hexdigest()))
            now, running = prefix, hashlib.sha256(ids)
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())], names=["prefix", "sha256"])
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([running.hexdigest()])], names=["prefix", "sha256"])


def end_hashes(convs: DataFrame, range_rows: int = RANGE_TURNS) -> DataFrame:
    """Rows (_end, ends_sha256): for each prefix that conversations end in, the hash of their ids in order."""
    ends = store(convs.select("conv_id", "path").mapInArrow(_with_end, "conv_id long, prefix binary"), "trie-ends")
    ranges = max(ends.sparkSession.sparkContext.defaultParallelism, -(-ends.count() // range_rows))
    pieces = ends.repartitionByRange(ranges, "conv_id").sortWithinPartitions("conv_id").mapInArrow(_packed, "prefix binary, start long, ids binary")
    hashed = pieces.repartition("prefix").sortWithinPartitions("prefix", "start").mapInArrow(_hashed, "prefix binary, sha256 string")
    return hashed.select(F.col("prefix").alias("_end"), F.col("sha256").alias("ends_sha256"))


def nodes_of(convs: DataFrame, range_turns: int = RANGE_TURNS) -> DataFrame:
    """Rows (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one per node of the
    trie of ``convs`` (conv_id, _turns)."""
    convs = store(paths(convs), "trie-paths")
    found = trie(convs.groupBy("path").agg(F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv_id").alias("first")), range_turns)
    joined = found.join(end_hashes(convs), F.col("prefix") == F.col("_end"), "left")
    none: Column = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select(
        F.col("first_conv").alias("conv_id"), "depth", F.col("parent_first").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )


def conversation_nodes(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of all conversations with borrowed heads."""
    return nodes_of(with_borrowed_heads(turns(conversations)))
