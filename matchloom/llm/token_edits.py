"""Token counts that follow edits.

A text is cut into pre-tokens (the pattern that a byte-level tokenizer applies before its merges), each with its own
number of tokens, so the count of a text is a sum. The pre-tokens lie in the leaves of a segment tree whose nodes hold
sums of characters and tokens. An edit descends by characters to the place, encodes again from the last boundary that
cannot have seen the change until the new boundaries meet the old ones, and updates the sums on the paths of the
leaves it touched. Everything else keeps its counts.

Cases: a null or empty text has no pre-tokens; edits beyond the end act at the end; an empty list of edits changes
nothing; repeated documents give repeated rows; an empty table gives an empty result; other columns are never read.
A document's edits are applied in the order of their list; the list travels with its row.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = 32  # pre-tokens of a leaf when the tree is built; a leaf of four times as many has the tree built anew
SEES = 2  # characters beyond its end that the choice of a pre-token may depend on
KNOWN = 200_000  # pre-tokens whose counts a task remembers


class Counter:
    """Pre-tokens and their numbers of tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex
        import tiktoken

        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def counts(self, pieces: list[str]) -> list[int]:
        known, out = self.known, []
        for piece in pieces:
            n = known.get(piece)
            if n is None:
                if len(known) >= KNOWN:
                    known.clear()
                n = known[piece] = len(self.encoding.encode_ordinary(piece))
            out.append(n)
        return out


class Tree:
    """Leaves are lists of pre-tokens with their counts; ``chars`` and ``tokens`` hold the sums of a heap of nodes."""

    def __init__(self, text: str, counter: Counter) -> None:
        self.counter = counter
        pieces = counter.pattern.findall(text)
        self.encoded = 0
        self._build(pieces, counter.counts(pieces))

    def _build(self, pieces: list[str], counts: list[int]) -> None:
        starts = range(0, max(len(pieces), 1), LEAF)
        self.leaves = [pieces[k : k + LEAF] for k in starts]
        self.counts = [counts[k : k + LEAF] for k in starts]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        blank = [0] * (self.width - len(self.leaves))
        self.chars = [0] * self.width + [sum(map(len, x)) for x in self.leaves] + blank
        self.tokens = [0] * self.width + [sum(x) for x in self.counts] + blank
        for node in range(self.width - 1, 0, -1):
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def total(self) -> int:
        return self.tokens[1]

    def size(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(piece for leaf in self.leaves for piece in leaf)

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character (the last one that holds any, for the end), and where the leaf starts."""
        node, start = 1, 0
        place = min(place, self.chars[1] - 1)
        while node < self.width:
            node *= 2
            if place - start >= self.chars[node]:
                start += self.chars[node]
                node += 1
        return max(node - self.width, 0), start

    def _set(self, leaf: int, pieces: list[str], counts: list[int]) -> None:
        self.leaves[leaf], self.counts[leaf] = pieces, counts
        node = leaf + self.width
        self.chars[node], self.tokens[node] = sum(map(len, pieces)), sum(counts)
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def edit(self, place: int, delete: int, insert: str) -> None:
        """Replace ``delete`` characters from ``place`` on by ``insert``."""
        size = self.size()
        place = max(0, min(place, size))
        delete = max(0, min(delete, size - place))
        if not delete and not insert:
            return
        if not size:
            pieces = self.counter.pattern.findall(insert)
            self.encoded += len(pieces)
            self._build(pieces, self.counter.counts(pieces))
            return
        first, start = self._leaf_at(max(place - SEES - 1, 0))
        head, at = [], start
        for piece in self.leaves[first]:  # pre-tokens that end early enough keep their counts
            if at + len(piece) > place - SEES:
                break
            head.append(piece)
            at += len(piece)
        kept = len(head)
        # Old pre-tokens from the restart on, leaf by leaf until the new boundaries meet theirs.
        last, old, old_end = first, self.leaves[first][kept:], start + self.chars[first + self.width]
        old_counts = self.counts[first][kept:]
        while True:
            while old_end < place + delete + SEES and last + 1 < len(self.leaves):
                last += 1
                old = old + self.leaves[last]
                old_counts = old_counts + self.counts[last]
                old_end += self.chars[last + self.width]
            gap = "".join(old)
            fresh = gap[: place - at] + insert + gap[place - at + delete :]
            new, met = self._meet(fresh, old, at, place, delete, len(insert), old_end == size)
            if met is not None:
                break
            last += 1
            old = old + self.leaves[last]
            old_counts = old_counts + self.counts[last]
            old_end += self.chars[last + self.width]
        self.encoded += len(new)
        pieces = head + new + old[met:]
        counts = self.counts[first][:kept] + self.counter.counts(new) + old_counts[met:]
        for leaf in range(first + 1, last + 1):
            self._set(leaf, [], [])
        self._set(first, pieces, counts)
        if len(pieces) > 4 * LEAF:
            self._build([p for x in self.leaves for p in x], [c for x in self.counts for c in x])

    def _meet(self, fresh: str, old: list[str], at: int, place: int, delete: int, added: int, whole: bool):
        """New pre-tokens of ``fresh`` up to the first boundary shared with the old ones behind the edit, and the number
        of old ones they replace; None if the stretch is too short to tell."""
        ends, reach = {}, at
        for k, piece in enumerate(old):
            if reach >= place + delete:
                ends[reach - at - delete + added] = k
            reach += len(piece)
        ends[reach - at - delete + added] = len(old)
        new, end = [], 0
        if 0 in ends and place == at and not added:
            return new, ends[0]
        for found in self.counter.pattern.finditer(fresh):
            if not whole and found.end() > len(fresh) - SEES:
                return new, None
            new.append(found[0])
            end = found.end()
            if end >= place - at + added and end in ends:
                return new, ends[end]
        return new, len(old) if whole else None


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file that the driver can read (a token in base 64 and its rank in each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}


def counts_after_edits(docs: DataFrame, ranks: dict[bytes, int], pattern: str, doc_id: str = "doc_id", text: str = "text", edits: str = "edits") -> DataFrame:
    """Rows (doc_id, n_pretokens, n_tokens, n_edits, n_reencoded, n_chars_edited, n_tokens_edited): counts before the
    edits, pre-tokens encoded again for them, and counts after them. ``edits`` is an array of (place, remove, add)."""
    shared = docs.sparkSession.sparkContext.broadcast((ranks, pattern))  # a vocabulary: one or two megabytes
    names = ["doc_id", "n_pretokens", "n_tokens", "n_edits", "n_reencoded", "n_chars_edited", "n_tokens_edited"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*shared.value)
        for batch in batches:
            rows = []
            for value, changes in zip(batch.column("text"), batch.column("edits")):
                tree = Tree(value.as_py() or "", counter)
                before = (sum(map(len, tree.leaves)), tree.total())
                changes = changes.as_py() or []
                for change in changes:
                    tree.edit(change["place"] or 0, change["remove"] or 0, change["add"] or "")
                rows.append((*before, len(changes), tree.encoded, tree.size(), tree.total()))
            columns = zip(*rows) if rows else [[]] * (len(names) - 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), pa.int64()) for c in columns)], names=names)

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names[1:])
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(edits).alias("edits"))
    return rows.mapInArrow(count, schema)


def with_trial_edits(docs: DataFrame, every: int = 2000) -> DataFrame:
    """``docs`` with ``edits``: one for each ``every`` characters and one more, at places a digest names; each removes up
    to 12 characters and adds up to 11 that stand elsewhere in the text."""
    size = F.coalesce(F.length("text"), F.lit(0))
    number = lambda j, salt, below: F.pmod(F.xxhash64(F.col("doc_id"), j, F.lit(salt)), below)

    def one(j):
        return F.struct(
            number(j, 0, size + 1).cast("long").alias("place"),
            number(j, 1, F.lit(13)).cast("long").alias("remove"),
            F.coalesce(F.substring("text", (number(j, 2, size + 1) + 1).cast("int"), number(j, 3, F.lit(12)).cast("int")), F.lit("")).alias("add"),
        )

    return docs.withColumn("edits", F.transform(F.sequence(F.lit(0), (size / every).cast("int")), one))
