"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are all windows of ``window`` consecutive words of an item (a shorter item is one window). For
each pattern length a shift table over blocks of two words tells how far a search position may jump; only
where the shift is zero do suffix-hash buckets name the patterns to test, a prefix hash thins them out, and
a direct comparison of the words' bytes confirms the occurrence. The search runs over many texts at once:
each lane is a stretch of end positions of one text.

Cases: a null or empty text or item has no words; items with a null id mark words as hit but are not
listed; equal ids count once; repeated documents give repeated rows; empty tables give empty results or no
hits; other columns are never read by ``scan`` and pass unchanged through ``clean_documents``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.llm.common import U64, Hasher, flat, grams, lower_table, plain_words, slices, store, text_bytes, word_spans

WINDOW = 10
BLOCK = 2  # words of a block; shorter patterns use one word
LANE = 256  # end positions of a lane
PASS_BYTES = 2 << 20  # benchmark text searched for in one pass; its tables take some 62 times that, 170 times while built
TABLE_BITS = 18


class Patterns:
    """Search tables for one block of benchmark items."""

    def __init__(self, items: list[tuple[object, str | None]], window: int) -> None:
        lower, is_word, hasher = lower_table(), plain_words(), Hasher()
        names = sorted({str(i) for i, _ in items if i is not None})
        rank = {name: k for k, name in enumerate(names)}
        self.names = names
        found: dict[int, dict[bytes, tuple[np.ndarray, set[int]]]] = {}
        for item, text in items:
            data = lower[np.frombuffer((text or "").encode(), dtype=np.uint8)]
            starts, ends, _ = word_spans(data, np.array([0, len(data)]), is_word)
            if len(starts) == 0:
                continue
            words = [data[a:b].tobytes() for a, b in zip(starts, ends)]
            hashes = hasher.ranges(hasher.prefix(data), starts, ends)
            n = min(window, len(words))
            for k in range(len(words) - n + 1):
                _, ids = found.setdefault(n, {}).setdefault(b" ".join(words[k : k + n]), (hashes[k : k + n], set()))
                if item is not None:
                    ids.add(rank[str(item)])
        self.groups = [Group(n, got) for n, got in sorted(found.items())]

    def search(self, data: np.ndarray, at: np.ndarray, hasher: Hasher, lower: np.ndarray, is_word: np.ndarray):
        """Words of each text, the text of each word, whether a word is hit, (text, item rank) pairs found."""
        data = lower[data]
        starts, ends, text = word_spans(data, at, is_word)
        words = np.bincount(text, minlength=len(at) - 1)
        edge = np.concatenate(([0], np.cumsum(words)))
        cover = np.zeros(len(starts) + 1, dtype=np.int64)
        pairs: set[tuple[int, int]] = set()
        hashes = hasher.ranges(hasher.prefix(data), starts, ends)
        for group in self.groups:
            for end, ids in group.occurrences(hashes, edge, data, starts, ends):
                cover[end - group.length + 1] += 1
                cover[end + 1] -= 1
                pairs.update((int(text[end]), i) for i in ids)
        return words, text, np.cumsum(cover[:-1]) > 0, pairs


class Group:
    """All patterns of one length."""

    def __init__(self, length: int, patterns: dict[bytes, tuple[np.ndarray, set[int]]]) -> None:
        self.length, self.block = length, min(BLOCK, length)
        keys = list(patterns)
        words = np.array([patterns[k][0] for k in keys], dtype=U64).reshape(len(keys), length)
        self.mask = U64((1 << max(TABLE_BITS, int(len(keys) * length).bit_length() + 2)) - 1)
        self.shift = np.full(int(self.mask) + 1, length - self.block + 1, dtype=np.int32)
        for j in range(self.block - 1, length):
            slot = (self._block(words, j) & self.mask).astype(np.int64)
            np.minimum.at(self.shift, slot, length - 1 - j)
        suffix = self._block(words, length - 1)
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.first = suffix[order], words[order, 0]
        self.bytes = [keys[k] for k in order]
        self.ids = [sorted(patterns[keys[k]][1]) for k in order]

    def _block(self, words: np.ndarray, j: int) -> np.ndarray:
        if self.block == 1:
            return words[:, j].copy()
        return grams(np.ascontiguousarray(words[:, j - 1 : j + 1]).reshape(-1), 2)[::2]

    def _blocks_at(self, hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if self.block == 1:
            return hashes[ends]
        return grams(np.stack((hashes[ends - 1], hashes[ends]), axis=1).reshape(-1), 2)[::2]

    def occurrences(self, hashes, edge, data, starts, ends) -> Iterator[tuple[int, list[int]]]:
        """End word and items of each occurrence; ``edge`` holds the first word of every text."""
        first, last = edge[:-1] + self.length - 1, edge[1:] - 1
        long_enough = first <= last
        first, last = first[long_enough], last[long_enough]
        lanes = (last - first) // LANE + 1
        nth = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        place = np.repeat(first, lanes) + nth * LANE
        stop = np.minimum(place + LANE - 1, np.repeat(last, lanes))
        while len(place):
            block = self._blocks_at(hashes, place)
            shift = self.shift[(block & self.mask).astype(np.int64)]
            zero = shift == 0
            if zero.any():
                yield from self._confirmed(place[zero], block[zero], hashes, data, starts, ends)
            place = place + np.maximum(shift, 1)
            keep = place <= stop
            place, stop = place[keep], stop[keep]

    def _confirmed(self, place, block, hashes, data, starts, ends) -> Iterator[tuple[int, list[int]]]:
        low = np.searchsorted(self.suffix, block, side="left")
        many = np.searchsorted(self.suffix, block, side="right") - low
        head = hashes[place - self.length + 1]
        for nth in range(int(many.max(initial=0))):
            live = many > nth
            place, low, many, head = place[live], low[live], many[live], head[live]
            test = low + nth
            for k in np.flatnonzero(self.first[test] == head):
                end, pattern = int(place[k]), int(test[k])
                span = range(end - self.length + 1, end + 1)
                if b" ".join(data[starts[w] : ends[w]].tobytes() for w in span) == self.bytes[pattern]:
                    yield end, self.ids[pattern]


def _passes(benchmark: DataFrame, item_id: str, text: str, pass_bytes: int) -> Iterator[list[tuple[object, str | None]]]:
    """Blocks of items of about ``pass_bytes``; the driver holds one block at a time."""
    total = text_bytes(benchmark, text)
    n = -(-total // pass_bytes) or 1
    part = F.pmod(F.xxhash64(F.col(item_id), F.col(text)), F.lit(n))
    for k in range(n):
        rows = benchmark if n == 1 else benchmark.where(part == k)
        yield [(r[0], r[1]) for r in rows.select(item_id, text).collect()]


STATE = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("_hits", T.BinaryType()),
    ]
)


def _search_pass(docs: DataFrame, text: str, patterns: Patterns) -> DataFrame:
    """``docs`` with the columns of STATE: the finds of this pass added to those of earlier ones."""
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(patterns))  # with its class, for tasks without this package
    kept = [f for f in docs.schema.fields if f.name not in STATE.names]
    again = len(kept) < len(docs.columns)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, hasher, lower, is_word = pickle.loads(shared.value), Hasher(), lower_table(), plain_words()
        for batch in batches:
            n = batch.num_rows
            words, hits = np.zeros(n, np.int64), np.zeros(n, np.int64)
            items = [set(x) for x in batch.column("items").to_pylist()] if again else [set() for _ in range(n)]
            bits = batch.column("_hits").to_pylist() if again else [None] * n
            for first, last, data, at in slices(*flat(batch.column(text))):
                count, of, hit, pairs = tables.search(data, at, hasher, lower, is_word)
                edge = np.concatenate(([0], np.cumsum(count)))
                for row in range(first, last) if again else {first + int(k) for k in of[hit]}:
                    own = hit[edge[row - first] : edge[row - first + 1]]
                    if bits[row] is not None:
                        own = own | np.unpackbits(np.frombuffer(bits[row], np.uint8), count=len(own)).astype(bool)
                    if own.any():
                        hits[row], bits[row] = own.sum(), np.packbits(own).tobytes()
                words[first:last] = count
                for row, item in pairs:
                    items[first + row].add(tables.names[item])
            columns = [batch.column(f.name) for f in kept]
            found = [pa.array(words), pa.array(hits), pa.array([sorted(x) for x in items], pa.list_(pa.string())), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *found], names=[*(f.name for f in kept), *STATE.names])

    return docs.mapInArrow(search, T.StructType([*kept, *STATE.fields]))


def _marked(docs: DataFrame, benchmark: DataFrame, text: str, item_id: str, item_text: str, window: int, pass_bytes: int) -> DataFrame:
    """``docs`` with n_words, n_hit and items. Beyond one pass, the marks so far are written between passes."""
    now = None
    for items in _passes(benchmark, item_id, item_text, pass_bytes):
        now = _search_pass(docs if now is None else store(now, "decontaminate"), text, Patterns(items, window))
    return now.drop("_hits")


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """Rows (doc_id, n_words, n_hit, items: array of item ids as sorted strings), one per document.

    The driver and each task hold the tables of ``pass_bytes`` of benchmark text; a larger benchmark takes
    several passes over the documents, with the same result.
    """
    marked = _marked(docs.select(doc_id, text), benchmark, text, item_id, item_text, window, pass_bytes)
    return marked.select(doc_id, "n_words", "n_hit", "items")


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``docs`` without the documents that hold an occurrence of any benchmark window; all columns are kept."""
    inner = docs.select(F.col("text").alias("_text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    marked = _marked(inner, benchmark, "_text", "item_id", "text", window, pass_bytes)
    return marked.where("n_hit = 0").select("_row.*")


def digest(marked: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The query's columns."""
    return marked.select(
        doc_id,
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
