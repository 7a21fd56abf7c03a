"""Removal of repeated byte strings over the whole corpus, by sorted sample suffixes and induction.

A byte goes if some string of ``length`` bytes over it also starts earlier (smaller id, or same document and earlier
place). Strings are judged on the input and never cross documents.

Sorting every suffix would need a tuple per byte on disk, several times the input. So only sample suffixes are sorted,
and the order of all others is induced from them:

- Every string of ``length`` bytes is led by its smallest gram of ``LEADER`` bytes (by hash, leftmost on ties). Equal
  strings have equal leaders at equal offsets, and one leader serves a run of neighbouring strings: about one sample
  for 25 bytes.
- Round 1: blocks of documents send the hashes of their leaders to shards, which answer what occurs again.
- Round 2: for leaders that do, blocks send suffix tuples (leader, bytes to the right, bytes to the left, start). A shard
  sorts them by the bytes on either side and takes the common prefix lengths of neighbours. A string at offset o
  before a leader equals another exactly if the common lengths reach o to the left and the rest to the right, so classes
  of equal strings are read off the two sorted lists, and the earliest start of each class is kept. What a block can
  settle by itself it does not send.
- Round 3: blocks cut the covered bytes.

Blocks and shards have bounded size and their number grows with the corpus. Equal tuples leave a block once, whatever
the number of copies. A leader beyond ``HOT`` occurrences is dealt to shards by the string instead of by the leader.
All three rounds are one plan; the shuffle of the documents into blocks is computed once and reused.

Cases: a null or empty text has no bytes; rows of equal id count as one document (identical rows do not remove each
other); null ids count as one document after all others; ties cannot differ; an empty table gives an empty result; other
columns pass unchanged through ``without_repeats``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.llm.common import MESSAGE, U64, WORK_BYTES, Hasher, as_table, block_count, by_shard, flat, message, pack, slices, text_bytes, unpack

LENGTH = 100
LEADER = 50
BLOCK_BYTES = 8 << 20
HOT = 50_000
CONTEXT_ROWS = 4096  # leaders whose places are worked out at once
PAD = 0xFF  # occurs in no UTF-8 text
NO_ID = np.iinfo(np.int64).max

class Block:
    """The documents of a block in the order of their ids, and the leaders of their strings."""

    def __init__(self, rows: pa.Table, length: int, leader: int) -> None:
        ids = rows.column("_id").fill_null(NO_ID).to_numpy()
        self.order = np.lexsort((rows.column("_digest").to_numpy(), ids))
        self.rows = rows.take(pa.array(self.order))
        self.ids = ids[self.order]
        self.data, self.at = flat(self.rows.column("text"))
        self.length, self.leader = length, leader
        self._find()

    def _find(self) -> None:
        place, gram, before, after = [], [], [], []
        hasher, base, many = Hasher(), 0, self.length - self.leader + 1
        for _, _, data, at in slices(self.data, self.at, WORK_BYTES):
            if len(data) >= self.length:
                got = self._leaders(data, at, hasher, many)
                for to, part in zip((place, gram, before, after), got):
                    to.append(part)
                place[-1] = place[-1] + base
            base += len(data)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.place, self.gram = join(place, np.int64), join(gram, U64)
        self.least, self.most = join(before, np.int64), join(after, np.int64)  # offsets of the leader in its strings
        self.doc = np.searchsorted(self.at, self.place, side="right") - 1

    def _leaders(self, data: np.ndarray, at: np.ndarray, hasher: Hasher, many: int):
        prefix = hasher.prefix(data)
        starts = np.arange(len(data) - self.leader + 1)
        gram = hasher.ranges(prefix, starts, starts + self.leader)
        bits = U64(32)  # the same for all blocks, or ties would fall differently
        keys = (gram >> bits << bits) | starts.astype(U64)
        low, width = keys, 1
        while width * 2 <= many:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[: len(keys) - many + 1], low[many - width :][: len(keys) - many + 1])
        leader = (low & ((U64(1) << bits) - U64(1))).astype(np.int64)
        size = np.diff(at)
        valid = np.zeros(len(data) + 1, dtype=np.int32)
        long_enough = size >= self.length
        np.add.at(valid, at[:-1][long_enough], 1)
        np.add.at(valid, at[1:][long_enough] - self.length + 1, -1)
        string = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
        leader = leader[string]
        new = np.ones(len(string), dtype=bool)
        new[1:] = (leader[1:] != leader[:-1]) | (string[1:] != string[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(string)) - 1
        own = leader[first]
        return own, gram[own], own - string[last[: len(first)]], own - string[first]

    def starts(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        doc = self.doc[which]
        return self.ids[doc], self.place[which] - self.at[doc]

    def context(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes to the left (backwards) and to the right of the leaders, padded where the document ends."""
        span = self.length - self.leader
        step = np.arange(span)
        out = np.empty((2, len(which), span), dtype=np.uint8)
        for k in range(0, len(which), CONTEXT_ROWS):
            some = which[k : k + CONTEXT_ROWS]
            place, doc = self.place[some], self.doc[some]
            left, right = place[:, None] - 1 - step, place[:, None] + self.leader + step
            for to, at, inside in zip(out, (left, right), (left >= self.at[doc][:, None], right < self.at[doc + 1][:, None])):
                got = self.data[np.clip(at, 0, len(self.data) - 1)]
                got[~inside] = PAD
                to[k : k + CONTEXT_ROWS] = got
        return out[0], out[1]

    def open(self, which: np.ndarray) -> np.ndarray:
        """Bits of the offsets at which the leader leads a string."""
        bit = lambda n: (U64(1) << n.astype(U64))
        return (bit(self.most[which]) - U64(1) | bit(self.most[which])) & ~(bit(self.least[which]) - U64(1))


def common_lengths(sorted_bytes: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Common prefix length of each row with the one before; -1 where ``same`` is false."""
    out = np.full(len(sorted_bytes), -1, dtype=np.int64)
    if len(sorted_bytes) > 1:
        differ = sorted_bytes[1:] != sorted_bytes[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), sorted_bytes.shape[1])
        out[1:][~same[1:]] = -1
    return out


def side(gram: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the tuples by leader and bytes of one side, and their common lengths in that order."""
    width = context.shape[1] + 8
    key = np.empty((len(gram), width), dtype=np.uint8)
    key[:, :8] = gram.astype(">u8").view(np.uint8).reshape(-1, 8)
    key[:, 8:] = context
    order = np.argsort(key.view(f"S{width}").ravel(), kind="stable")
    same = np.ones(len(gram), dtype=bool)
    same[1:] = gram[order][1:] == gram[order][:-1]
    return order, common_lengths(context[order], same)


def settle(gram: np.ndarray, left: np.ndarray, right: np.ndarray, ids: np.ndarray, places: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """Per tuple the bits of the offsets whose string has an earlier equal one among the tuples."""
    out = np.zeros(len(gram), dtype=U64)
    _, group, times = np.unique(gram, return_inverse=True, return_counts=True)
    use = np.flatnonzero(times[group] > 1)
    if not len(use):
        return out
    by_start = use[np.lexsort((places[use], ids[use]))]
    gram, left, right, open_ = gram[by_start], left[by_start], right[by_start], open_[by_start]
    later = (ids[by_start][1:] != ids[by_start][:-1]) | (places[by_start][1:] != places[by_start][:-1])
    rank = np.concatenate(([0], np.cumsum(later)))
    span = left.shape[1]
    by_left, low = side(gram, left)
    by_right, high = side(gram, right)

    def classes(order: np.ndarray, lengths: np.ndarray, depth: int) -> np.ndarray:
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.cumsum(lengths < depth)
        return number

    # Tuples equal on both sides: the first stands for all of them.
    pair = classes(by_left, low, span) * (len(gram) + 1) + classes(by_right, high, span)
    _, first, where = np.unique(pair, return_index=True, return_inverse=True)
    copy_of = first[where]
    found = np.zeros(len(gram), dtype=U64)
    every = np.bitwise_or.reduce(open_) if len(open_) else U64(0)
    # A tuple may be open where the one that stands for it is not; then the whole class is asked.
    asked = np.zeros(len(gram), dtype=U64)
    np.bitwise_or.at(asked, copy_of, open_)
    heads = np.flatnonzero(copy_of == np.arange(len(gram)))
    for o in range(span + 1):
        if not every >> U64(o) & U64(1):
            continue
        ask = heads[(asked[heads] >> U64(o) & U64(1)) == 1]
        pair = classes(by_left, low, o)[ask] * (len(gram) + 1) + classes(by_right, high, span - o)[ask]
        _, first, where = np.unique(pair, return_index=True, return_inverse=True)
        found[ask[rank[ask[first[where]]] < rank[ask]]] |= U64(1) << U64(o)
    result = np.where(rank > rank[copy_of], open_, found[copy_of] & open_)
    out[by_start] = result
    return out


def _plan(docs: DataFrame, length: int, leader: int, block_bytes: int, hot: int, emit: Callable, schema: T.StructType | str) -> DataFrame:
    """``docs`` has _id, text, _digest and what ``emit`` needs besides."""
    n = block_count(text_bytes(docs), block_bytes)
    blocks = docs.withColumn("block", F.pmod(F.xxhash64("_id", "_digest"), F.lit(n)))

    def ask(rows: pa.Table) -> pa.Table:
        block = Block(rows, length, leader)
        grams, times = np.unique(block.gram, return_counts=True)
        number = rows.column("block")[0].as_py()
        many = np.minimum(times, 1 << 30).astype(np.int32)
        out = [message(number, shard, 1, pack(np.diff(grams[own], prepend=U64(0))), pack(many[own])) for shard, own in by_shard((grams % U64(n)).astype(np.int64))]
        return as_table(out)

    def count(group: pa.Table) -> pa.Table:
        parts = [np.cumsum(unpack(x.as_py(), U64), dtype=U64) for x in group.column("a")]
        grams, where = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(where, weights=np.concatenate([unpack(x.as_py(), np.int32) for x in group.column("b")]), minlength=len(grams))
        answer = (total > 1).astype(np.uint8) + (total > hot)
        edge = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        blocks_, shards = group.column("block").to_pylist(), group.column("shard").to_pylist()
        return as_table([message(blocks_[k], shards[k], 1, answer[where[edge[k] : edge[k + 1]]].tobytes()) for k in range(len(parts))])

    def suspects(block: Block, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Leaders that occur again, and whether they are hot."""
        grams = np.unique(block.gram)
        said = np.zeros(len(grams), dtype=np.uint8)
        replies = {s.as_py(): a.as_py() for s, a, r in zip(answers.column("shard"), answers.column("a"), answers.column("round")) if r.as_py() == 1}
        for shard, own in by_shard((grams % U64(n)).astype(np.int64)):
            said[own] = np.frombuffer(replies[shard], np.uint8)
        own = said[np.searchsorted(grams, block.gram)]
        which = np.flatnonzero(own > 0)
        return which, own[which] == 2

    def dealt(block: Block, which: np.ndarray, is_hot: np.ndarray):
        """Own finds, and the tuples to send: index into ``which``, bits asked, shard."""
        left, right = block.context(which)
        ids, places = block.starts(which)
        open_ = block.open(which)
        own = settle(block.gram[which], left, right, ids, places, open_)
        rest = open_ & ~own
        plain = np.flatnonzero((rest != 0) & ~is_hot)
        index, bits, shard = [plain], [rest[plain]], [(block.gram[which[plain]] % U64(n)).astype(np.int64)]
        heavy = np.flatnonzero((rest != 0) & is_hot)
        if len(heavy):
            hasher = Hasher()
            prefix = hasher.prefix(block.data)
            for o in range(length - leader + 1):
                some = heavy[(rest[heavy] >> U64(o) & U64(1)) == 1]
                start = block.place[which[some]] - o
                index.append(some)
                bits.append(np.full(len(some), U64(1) << U64(o), dtype=U64))
                shard.append((hasher.ranges(prefix, start, start + length) % U64(n)).astype(np.int64))
        return own, np.concatenate(index), np.concatenate(bits), np.concatenate(shard), left, right, ids, places

    def tell(rows: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(rows, length, leader)
        which, is_hot = suspects(block, answers)
        number, out = rows.column("block")[0].as_py(), []
        if len(which):
            _, index, bits, shard, left, right, ids, places = dealt(block, which, is_hot)
            for to, own in by_shard(shard):
                at = index[own]
                context = np.concatenate((left[at], right[at]), axis=1).tobytes()
                out.append(message(number, to, 2, pack(block.gram[which[at]]), context, pack(ids[at]), pack(places[at].astype(np.int64)), pack(bits[own])))
        return as_table(out)

    def match(group: pa.Table) -> pa.Table:
        take = lambda c, kind: np.concatenate([unpack(x.as_py(), kind) for x in group.column(c)])
        grams = [unpack(x.as_py(), U64) for x in group.column("a")]
        sizes = [len(x) for x in grams]
        context = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in group.column("b")]).reshape(sum(sizes), -1)
        span = context.shape[1] // 2
        found = settle(np.concatenate(grams), context[:, :span], context[:, span:], take("c", np.int64), take("d", np.int64), take("e", U64))
        edge = np.concatenate(([0], np.cumsum(sizes)))
        blocks_, shards = group.column("block").to_pylist(), group.column("shard").to_pylist()
        return as_table([message(blocks_[k], shards[k], 2, pack(found[edge[k] : edge[k + 1]])) for k in range(len(sizes))])

    def cut(rows: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(rows, length, leader)
        which, is_hot = suspects(block, answers)
        gone = np.zeros(len(block.data) + 1, dtype=np.int32)
        if len(which):
            found, index, bits, shard, *_ = dealt(block, which, is_hot)
            replies = {s.as_py(): a.as_py() for s, a, r in zip(answers.column("shard"), answers.column("a"), answers.column("round")) if r.as_py() == 2}
            for of, own in by_shard(shard):
                np.bitwise_or.at(found, index[own], unpack(replies[of], U64))
            for o in range(length - leader + 1):
                start = block.place[which[(found >> U64(o) & U64(1)) == 1]] - o
                gone[start] += 1
                gone[start + length] -= 1
        np.cumsum(gone, out=gone)
        return emit(block, gone[:-1] > 0)

    first = blocks.select("block", "_id", "_digest", "text")
    counted = first.groupBy("block").applyInArrow(ask, MESSAGE).groupBy("shard").applyInArrow(count, MESSAGE)
    matched = (
        first.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(tell, MESSAGE).groupBy("shard").applyInArrow(match, MESSAGE)
    )
    answers = counted.unionByName(matched)
    last = first if "_row" not in docs.columns else blocks
    return last.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(cut, schema)


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(whole).alias("_digest"), whole.alias("text"))


def _kept(block: Block, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The remaining bytes and their offsets per document."""
    left = np.concatenate(([0], np.cumsum(~gone)))[block.at]
    return block.data[~gone], left


def removed(
    docs: DataFrame, text: str = "text", length: int = LENGTH, leader: int = LEADER, block_bytes: int = BLOCK_BYTES, hot: int = HOT
) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256), one per document."""

    def emit(block: Block, gone: np.ndarray) -> pa.Table:
        data, edge = _kept(block, gone)
        size = np.diff(block.at)
        before = np.zeros_like(gone)
        before[1:] = gone[:-1]
        before[block.at[:-1][size > 0]] = False
        spans = np.concatenate(([0], np.cumsum(gone & ~before)))[block.at]
        ids = block.rows.column("_id").combine_chunks()
        shas = [hashlib.sha256(data[a:b].tobytes()).hexdigest() for a, b in zip(edge[:-1], edge[1:])]
        return pa.table({"doc_id": ids, "n_bytes": size, "n_removed": size - np.diff(edge), "n_spans": np.diff(spans), "kept_sha256": shas})

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return _plan(_keyed(docs, text), length, leader, block_bytes, hot, emit, schema)


def without_repeats(docs: DataFrame, length: int = LENGTH, leader: int = LEADER, block_bytes: int = BLOCK_BYTES, hot: int = HOT) -> DataFrame:
    """``docs`` with the covered bytes cut from ``text`` (a character of which only a part remains goes as well) and
    ``n_chars``, if there, counted anew. Documents of which nothing remains are left out; those that were empty stay."""
    rest = [c for c in docs.columns if c not in ("text", "n_chars")]
    whole = F.coalesce(F.col("text"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in rest], F.col("text").isNull().alias("_no_text"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(whole).alias("_digest"), whole.alias("text"), row.alias("_row"))

    def emit(block: Block, gone: np.ndarray) -> pa.Table:
        data, edge = _kept(block, gone)
        texts = [data[a:b].tobytes().decode(errors="ignore") for a, b in zip(edge[:-1], edge[1:])]
        cut = np.diff(block.at) > np.diff(edge)
        return pa.table({"_row": block.rows.column("_row").combine_chunks(), "_text": texts, "_cut": cut})

    schema = T.StructType([keyed.schema["_row"], T.StructField("_text", T.StringType()), T.StructField("_cut", T.BooleanType())])
    out = _plan(keyed, length, leader, block_bytes, hot, emit, schema).where("not (_cut and _text = '')")
    text = F.when(~F.col("_row._no_text"), F.col("_text"))
    new = {"text": text.alias("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(~F.col("_row._no_text"), F.length("_text")).cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*[new.get(c, F.col("_row").getField(c).alias(c)) for c in docs.columns])
