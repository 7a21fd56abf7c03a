"""Language-model scores of documents by stupid backoff.

Documents fall into two folds by their id; each is scored with the n-gram counts of the other fold, so that no document
vouches for itself. The score of a word is c(context + word) / c(context) for the longest context of up to
``order - 1`` words with which the other fold has it, times ``BACKOFF`` for each word of context given up; a word that the
other fold lacks counts as one more step down from 1 in N + 1. A document's score is the sum of logarithms.

The count tables are partitioned by n-gram hash into shards. Blocks of documents explode their n-grams, reduce them to
the different ones with their counts per fold, and send them to the shards of their hashes; a shard adds up and answers
each block in the order of its questions; the block joins the answers to its n-grams and sums per document. A block
names an n-gram once however often it occurs, so no n-gram, however frequent, gathers more rows than there are blocks. Words and pairs go first; a longer n-gram is only
sent where the other fold has its parts. The documents' shuffle into blocks is computed once and reused.

With ``leave_one_out`` there are no folds: a document is scored with the counts of all other rows, that is those of the
whole table less its own.

Words are runs of digits, letters a-z and anything beyond ASCII, A-Z lower-cased.

Cases: a null or empty text has no words, score 0 and a null mean; a null id is in fold 0; repeated rows count as often
as they occur; an empty fold leaves only the last step; an empty table gives an empty result; other columns are never
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import MESSAGE, U64, Hasher, as_table, block_count, by_shard, flat, grams, lower_table, message, pack, plain_words, slices, text_bytes, unpack, word_spans

ORDER = 3
BACKOFF = 0.4
BLOCK_BYTES = 8 << 20
FOLDS = 2


class Reader:
    def __init__(self) -> None:
        self.hasher, self.lower, self.is_word = Hasher(), lower_table(), plain_words()

    def words(self, column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and text of every word."""
        hashes, texts = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        for first, _, data, at in slices(*flat(column)):
            data = self.lower[data]
            starts, ends, text = word_spans(data, at, self.is_word)
            hashes.append(self.hasher.ranges(self.hasher.prefix(data), starts, ends))
            texts.append(text + first)
        return np.concatenate(hashes), np.concatenate(texts)


def fold_sizes(docs: DataFrame) -> list[int]:
    """Words of each fold."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            _, text = reader.words(batch.column("text"))
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            n = np.bincount(fold[text], minlength=FOLDS)
            yield pa.RecordBatch.from_arrays([pa.array(range(FOLDS), pa.int32()), pa.array(n)], names=["fold", "n"])

    sums = docs.select("fold", "text").mapInArrow(count, "fold int, n long").groupBy("fold").agg(F.sum("n").alias("n")).collect()
    found = {r["fold"]: r["n"] for r in sums}
    return [found.get(k, 0) for k in range(FOLDS)]


def score(docs: DataFrame, text: str = "text", order: int = ORDER, backoff: float = BACKOFF, block_bytes: int = BLOCK_BYTES, leave_one_out: bool = False) -> DataFrame:
    """Rows (doc_id, n_words, n_full, log_score, mean_log): words, those scored with the longest context there is in the
    document, sum of logarithms, and the mean per word."""
    whole = F.coalesce(F.col(text), F.lit(""))
    fold = F.coalesce(F.pmod(F.col("doc_id").cast("long"), F.lit(FOLDS)), F.lit(0)).cast("int")
    fold = F.lit(0) if leave_one_out else fold
    folds = 1 if leave_one_out else FOLDS
    rows = docs.select("doc_id", fold.alias("fold"), whole.alias("text"))
    n = block_count(text_bytes(rows), block_bytes)
    sizes = fold_sizes(rows)
    blocks = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)))

    def shard_of(names: np.ndarray) -> np.ndarray:
        return ((names >> U64(32)) * U64(n) >> U64(32)).astype(np.int64)  # ranges of the hash, so that differences are small

    class Exploded:
        """The words of a block with the different n-grams of each size; ``seen`` gets the other fold's (or all other
        documents') counts of the n-grams that start at each word."""

        def __init__(self, group: pa.Table) -> None:
            self.hashes, self.of = Reader().words(group.column("text"))
            self.fold = group.column("fold").to_numpy()[self.of]
            self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            self.own: dict[int, np.ndarray] = {}
            self.seen: dict[int, np.ndarray] = {}

        def explode(self, size: int) -> None:
            """An n-gram of more than two words is only of use if the other fold (or another document) has both its shorter
            parts: if not, no document there has it, so none will ask for it."""
            if size == 1:
                here, found = np.arange(len(self.hashes)), self.hashes
            else:
                found = grams(self.hashes, size)
                use = self.of[: len(found)] == self.of[size - 1 :] if len(found) else np.zeros(0, bool)
                if size > 2 and len(found):
                    part = self.seen[size - 1]
                    use &= (part[: len(found)] > 0) & (part[1 : len(found) + 1] > 0)
                here = np.flatnonzero(use)
                found = found[here]
            names, where = np.unique(found, return_inverse=True)
            at = np.full(len(self.hashes), -1, dtype=np.int64)
            at[here] = where
            self.tables[size] = (names, at)
            if leave_one_out:
                _, which, times = np.unique(self.of[here] * len(names) + where, return_inverse=True, return_counts=True)
                self.own[size] = np.zeros(len(self.hashes), dtype=np.int64)
                self.own[size][here] = times[which]

        def messages(self, block: int, size: int) -> Iterator[dict]:
            names, at = self.tables[size]
            counts = [np.bincount(at[(self.fold == k) & (at >= 0)], minlength=len(names)).astype(np.int64) for k in range(folds)]
            for shard, own in by_shard(shard_of(names)):
                yield message(block, shard, size, pack(np.diff(names[own], prepend=U64(0))), *(pack(c[own]) for c in counts))

        def read(self, size: int, answers: dict) -> None:
            names, at = self.tables[size]
            total = np.zeros((folds, len(names) + 1), dtype=np.int64)  # the last one stands for no n-gram
            for shard, own in by_shard(shard_of(names)):
                for k, raw in enumerate(answers[size, shard][:folds]):
                    total[k, own] = unpack(raw, np.int64)
            self.seen[size] = total[0, at] - self.own.pop(size) if leave_one_out else total[1 - self.fold, at]
            del self.tables[size]

        def catch_up(self, upto: int, answers: pa.Table) -> None:
            said = {(r["round"], r["shard"]): (r["a"], r["b"]) for r in answers.select(["round", "shard", "a", "b"]).to_pylist()}
            for size in range(1, upto + 1):
                self.explode(size)
                self.read(size, said)

    def ask(group: pa.Table) -> pa.Table:
        words, out = Exploded(group), []
        for size in range(1, min(order, 2) + 1):
            words.explode(size)
            out += words.messages(group.column("block")[0].as_py(), size)
        return as_table(out)

    def ask_longer(size: int):
        def ask_on(group: pa.Table, answers: pa.Table) -> pa.Table:
            words = Exploded(group)
            words.catch_up(size - 1, answers)
            words.explode(size)
            return as_table(list(words.messages(group.column("block")[0].as_py(), size)))

        return ask_on

    def count(group: pa.Table) -> pa.Table:
        rounds, out = group.column("round").to_numpy(), []
        block, shard = group.column("block").to_pylist(), group.column("shard").to_pylist()
        for size in np.unique(rounds):
            own = np.flatnonzero(rounds == size).tolist()
            parts = [np.cumsum(unpack(group.column("a")[k].as_py(), U64), dtype=U64) for k in own]
            _, where = np.unique(np.concatenate(parts), return_inverse=True)
            edge = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            totals = []
            for c in "bc"[:folds]:
                values = np.concatenate([unpack(group.column(c)[k].as_py(), np.int64) for k in own])
                sums = np.zeros(int(where.max(initial=-1)) + 1, dtype=np.int64)
                np.add.at(sums, where, values)
                totals.append(sums[where])
            for j, k in enumerate(own):
                out.append(message(block[k], shard[k], int(size), *(pack(t[edge[j] : edge[j + 1]]) for t in totals)))
        return as_table(out)

    def sum_up(group: pa.Table, answers: pa.Table) -> pa.Table:
        block = Exploded(group)
        block.catch_up(order, answers)
        of, seen = block.of, [block.seen[size] for size in range(1, order + 1)]
        place = np.arange(len(of)) - np.searchsorted(of, of, side="left")
        if leave_one_out:
            words = (sizes[0] - np.bincount(of, minlength=group.num_rows)[of]).astype(float)
        else:
            words = np.array(sizes, dtype=float)[1 - block.fold]
        value = np.zeros(len(of))
        level = np.zeros(len(of), dtype=np.int64)  # 0: not yet scored
        for size in range(order, 0, -1):
            start = np.arange(len(of)) - (size - 1)
            fits = (place >= size - 1) & (level == 0)
            hit = np.flatnonzero(fits)
            hit = hit[seen[size - 1][start[hit]] > 0]
            below = words[hit] if size == 1 else seen[size - 2][start[hit]]
            steps = np.minimum(order - 1, place[hit]) - (size - 1)
            value[hit] = np.log(seen[size - 1][start[hit]]) - np.log(below) + steps * math.log(backoff)
            level[hit] = size
        lost = np.flatnonzero(level == 0)
        value[lost] = (np.minimum(order - 1, place[lost]) + 1) * math.log(backoff) - np.log(words[lost] + 1)
        rows = group.num_rows
        n_words = np.bincount(of, minlength=rows)
        full = np.bincount(of[level == np.minimum(order - 1, place) + 1], minlength=rows)
        total = np.bincount(of, weights=value, minlength=rows).astype(float)  # integers where there is no word
        mean = pa.array(total / np.maximum(n_words, 1), mask=n_words == 0)
        return pa.table({"doc_id": group.column("doc_id"), "n_words": n_words, "n_full": full, "log_score": total, "mean_log": mean})

    answers = blocks.groupBy("block").applyInArrow(ask, MESSAGE).groupBy("shard").applyInArrow(count, MESSAGE)
    for size in range(3, order + 1):
        asked = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(ask_longer(size), MESSAGE)
        answers = answers.unionByName(asked.groupBy("shard").applyInArrow(count, MESSAGE))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_full long, log_score double, mean_log double"
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(sum_up, schema)
