"""Runs of words: stretches that repeat one period at least four times over, found octave by octave in overlapping tiles.

Octave k holds the periods from 2**k to 2**(k + 1) - 1. A text is cut into tiles: those of the small octaves have a fixed
width, those of a larger octave sixteen times its least period, and half a tile lies over the next one, which is room for
four of the greatest periods. So every stretch of four periods lies in some tile as a whole, and a tile is solved
without the others. A text of one tile is solved where it is read; tiles of longer texts become rows (word hashes
only) that any task may take.

In a tile a boundary stands every 2**k words. A run of period q of this octave has a boundary t within its first
q words, and the Z-function of the text from t is at least 2 q at place t + q. Places t + q of all boundaries and
periods are the positions of the tile, each once, so a few comparisons of words a position leave hardly any pair but
those of runs; their Z-values to the right and to the left are found by bisection on hashes of word ranges and give
the run's ends. Pairs whose stretch has a smaller period, a divisor of q, are dropped. Each fragment is compared word by
word in the end, and extended word by word should a hash have lied.

Fragments meet by document and period: two of one run overlap by at least its period, those of different runs by less.

Cases: null and empty texts have no words and no runs; null ids are never rewritten by the query's rule; repeated rows are
texts of their own; no documents give no rows; other columns are not read. A text is read in pieces cut between words; its
word hashes (8 bytes a word) are in memory where it is read, a tile's where it is solved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.llm.common import PIECE_BYTES, U64, Hasher, flat, pieces, slices, spaced_words, store, word_spans

TILE_WORDS = 1 << 16
REPEATS = 4
LEAST_WORDS = 6
WORD = r"[^\x20\x09-\x0D]+"
SPACE = 0x20


# Words


class Reader:
    """Hashes of the words of texts."""

    def __init__(self, limit: int = PIECE_BYTES) -> None:
        self.hasher, self.is_word, self.limit = Hasher(), spaced_words(), limit

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        long = np.flatnonzero(ends - starts >= self.limit)
        if not len(long):
            return self.hasher.ranges(self.hasher.prefix(data), starts, ends)
        # A word of this length is alone in its piece.
        words = (hashlib.blake2b(data[a:b], digest_size=8).digest() for a, b in zip(starts, ends))
        return np.array([int.from_bytes(x, "little") for x in words], dtype=U64)

    def text(self, data: np.ndarray) -> np.ndarray:
        """Word hashes of one text of any length."""
        found = [np.zeros(0, dtype=U64)]
        for a, b in pieces(data, self.is_word, self.limit):
            starts, ends, _ = word_spans(data[a:b], np.array([0, b - a]), self.is_word)
            found.append(self.hashes(data[a:b], starts, ends))
        return np.concatenate(found)


def squeezed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The given words of ``n`` texts joined by one space each, one text after another, and the offsets of the texts."""
    marks = np.zeros(len(data) + 1, dtype=np.int8)
    marks[starts] += 1
    marks[ends] -= 1
    keep = np.cumsum(marks[:-1], dtype=np.int8).view(bool)
    followed = ends[:-1][text[:-1] == text[1:]]  # words that another one follows, so a separator does
    copy = data.copy()
    keep[followed], copy[followed] = True, SPACE
    sizes = np.bincount(text, weights=ends - starts + 1, minlength=n).astype(np.int64)
    return copy[keep], np.concatenate(([0], np.cumsum(np.maximum(sizes - 1, 0))))


def squeezed_hash(data: np.ndarray, is_word: np.ndarray, dropped: np.ndarray | None = None, limit: int = PIECE_BYTES) -> str:
    """Hash of one text's words, but the dropped ones, joined by one space each."""
    running, seen, begun = hashlib.sha256(), 0, False
    for a, b in pieces(data, is_word, limit):
        starts, ends, _ = word_spans(data[a:b], np.array([0, b - a]), is_word)
        if dropped is not None:
            use = ~dropped[seen : seen + len(starts)]
            seen += len(starts)
            starts, ends = starts[use], ends[use]
        if len(starts):
            running.update(b" " if begun else b"")
            running.update(squeezed(data[a:b], starts, ends, np.zeros(len(starts), np.int64), 1)[0])
            begun = True
    return running.hexdigest()


# Runs within one tile


class Factors:
    """Smallest prime factors, grown as needed."""

    def __init__(self) -> None:
        self.least = np.zeros(2, dtype=np.int32)

    def upto(self, n: int) -> np.ndarray:
        if len(self.least) <= n:
            n = max(n, 1 << 12)
            least = np.arange(n + 1, dtype=np.int32)
            for p in range(2, int(n**0.5) + 1):
                if least[p] == p:
                    part = least[p * p :: p]
                    part[part == np.arange(p * p, n + 1, p, dtype=np.int32)] = p
            self.least = least
        return self.least


class Solver:
    """Repetitions in one or several short texts that lie one after another."""

    def __init__(self) -> None:
        self.hasher, self.factors = Hasher(), Factors()

    def runs(self, words: np.ndarray, at: np.ndarray, first_octave: int = 0, last_octave: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and periods of all stretches within the texts at ``at`` that repeat a smallest period of these
        octaves at least ``REPEATS`` times and cannot be extended."""
        sizes = np.diff(at)
        longest = int(sizes.max(initial=0))
        top = max(longest // REPEATS, 0).bit_length() - 1
        last_octave = top if last_octave is None else min(last_octave, top)
        out = [np.zeros((3, 0), dtype=np.int64)]
        prefix = None
        short = (words >> U64(32)).astype(np.uint32)
        for k in range(first_octave, last_octave + 1):
            of = np.flatnonzero(sizes >= REPEATS << k)
            size = sizes[of]
            # Places from the second boundary of each text on, as (start of text, place within it).
            begin = np.repeat(at[of], size - (1 << k))
            place = np.arange(len(begin), dtype=np.int64) - np.repeat(np.cumsum(size - (1 << k)) - size, size - (1 << k))
            boundary = begin + (((place >> k) - 1) << k)
            place += begin
            equal = np.flatnonzero(short[place] == short[boundary])
            t, x = boundary[equal], place[equal]
            end = np.repeat(at[of + 1], size - (1 << k))[equal]
            q = x - t
            for times in (1, 2):
                fits = np.flatnonzero((x + times * q < end) & (short[np.minimum(x + times * q, len(words) - 1)] == short[x]))
                t, x, q, end = t[fits], x[fits], q[fits], end[fits]
            if not len(t):
                continue
            if prefix is None:
                prefix = self.hasher.prefix(words)
            out.append(self._solved(words, prefix, at, t, x, q, end, k))
        found = np.concatenate(out, axis=1)
        return found[0], found[1], found[2]

    def _same(self, prefix: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.hasher.ranges(prefix, a, a + n) == self.hasher.ranges(prefix, b, b + n)

    def _solved(self, words, prefix, at, t, x, q, end, k) -> np.ndarray:
        # The Z-value at x of the text from t is at least twice the period where a run begins before t.
        fits = np.flatnonzero(x + 2 * q <= end)
        t, x, q, end = t[fits], x[fits], q[fits], end[fits]
        fits = np.flatnonzero(self._same(prefix, t, x, 2 * q))
        t, x, q, end = t[fits], x[fits], q[fits], end[fits]
        # Of boundaries in one run the first one is enough.
        order = np.lexsort((t, q))
        t, x, q, end = t[order], x[order], q[order], end[order]
        begin = at[np.searchsorted(at, t, side="right") - 1]
        again = np.zeros(len(t), dtype=bool)
        again[1:] = (q[1:] == q[:-1]) & (t[1:] - t[:-1] == 1 << k) & (begin[1:] == begin[:-1])
        t, x, q, end, begin = (v[~again] for v in (t, x, q, end, begin))
        # No divisor of the period is a period.
        whole, rest = np.ones(len(q), dtype=bool), q.copy()
        least = self.factors.upto(int(q.max(initial=1)))
        while True:
            open_ = np.flatnonzero(whole & (rest > 1))
            if not len(open_):
                break
            factor = least[rest[open_]].astype(np.int64)
            part = q[open_] // factor
            whole[open_] = ~self._same(prefix, t[open_], t[open_] + part, 2 * q[open_] - part)
            rest[open_] //= factor
        t, x, q, end, begin = (v[whole] for v in (t, x, q, end, begin))
        right = self._z(lambda i, n: self._same(prefix, t[i], x[i], n), end - x)
        left = self._z(lambda i, n: self._same(prefix, t[i] - n, x[i] - n, n), t - begin)
        start, stop = t - left, x + right
        for i in range(len(t)):
            start[i], stop[i] = checked(words, int(start[i]), int(stop[i]), int(t[i]), int(q[i]), int(begin[i]), int(end[i]))
        fits = stop - start >= REPEATS * q
        return np.unique(np.stack((start[fits], stop[fits], q[fits])), axis=1)

    @staticmethod
    def _z(same, most: np.ndarray) -> np.ndarray:
        """Greatest lengths up to ``most`` for which ``same`` holds, by bisection."""
        low, high = np.zeros(len(most), dtype=np.int64), most.astype(np.int64)
        while True:
            i = np.flatnonzero(low < high)
            if not len(i):
                return low
            middle = (low[i] + high[i] + 1) // 2
            holds = same(i, middle)
            low[i] = np.where(holds, middle, low[i])
            high[i] = np.where(holds, high[i], middle - 1)


def checked(words: np.ndarray, start: int, stop: int, t: int, q: int, begin: int, end: int) -> tuple[int, int]:
    """The stretch around ``t`` with period ``q``: the given one if words agree, else found word by word."""
    agrees = np.array_equal(words[start : stop - q], words[start + q : stop])
    if agrees and (start == begin or words[start - 1] != words[start - 1 + q]) and (stop == end or words[stop] != words[stop - q]):
        return start, stop
    differ = np.flatnonzero(words[begin : end - q] != words[begin + q : end]) + begin
    k = int(np.searchsorted(differ, t))
    left = int(differ[k - 1]) + 1 if k else begin
    right = int(differ[k]) if k < len(differ) else end - q
    return left, right + q


def tiles(n: int, tile_words: int = TILE_WORDS) -> Iterator[tuple[int, int, int, int]]:
    """(first octave, last octave, start, stop) of the tiles of a text of ``n`` words."""
    top = max(n // REPEATS, 0).bit_length() - 1
    if top < 0:
        return
    if n <= tile_words:
        yield 0, top, 0, n
        return
    low = tile_words.bit_length() - 5  # sixteen least periods of this octave fill a tile
    for first, last in [(0, low), *((k, k) for k in range(low + 1, top + 1))]:
        width = 16 << last
        start = 0
        while True:
            yield first, last, start, min(start + width, n)
            if start + width >= n:
                break
            start += width // 2


# Documents


FRAGMENT = "struct<start:long,stop:long,period:long>"
FRAGMENTS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("period", pa.int64())]))


def _nested(start: np.ndarray, stop: np.ndarray, period: np.ndarray, of: np.ndarray, n: int) -> pa.Array:
    """Fragments as a list for each of ``n`` texts, ``of`` in order."""
    at = pa.array(np.searchsorted(of, np.arange(n + 1)).astype(np.int32))
    return pa.ListArray.from_arrays(at, pa.StructArray.from_arrays([pa.array(v.astype(np.int64)) for v in (start, stop, period)], names=["start", "stop", "period"]))


def read(docs: DataFrame, tile_words: int = TILE_WORDS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Rows of (_key, doc_id, text), read and written once: for each document its number of words, the hash of its
    joined words, and, where it has runs or several tiles, its text and the fragments found so far; besides, a row for
    each tile that is still to be solved."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"_key long, doc_id {kind}, n_words long, joined string, text string, fragments array<{FRAGMENT}>, tile_first int, tile_last int, tile_start long, tile binary"
    rows = docs.select(F.monotonically_increasing_id().alias("_key"), "doc_id", F.col("text").cast("string").alias("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, solver = Reader(piece_bytes), Solver()
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            texts = batch.column("text")
            data, at = flat(texts)
            for first, last, part, offsets in slices(data, at, piece_bytes):
                n, own = last - first, texts.slice(first, last - first)
                head = [batch.column(c).slice(first, n) for c in ("_key", "doc_id")]
                if len(part) > piece_bytes:  # one long text
                    words = reader.text(part)
                    size = np.array([len(words)])
                    found, many = [np.zeros((3, 0), np.int64)], len(words) > tile_words
                    for low, high, a, b in tiles(len(words), tile_words):
                        if many:
                            tile = [pa.array([x], k) for x, k in ((low, pa.int32()), (high, pa.int32()), (a, pa.int64()), (words[a:b].tobytes(), pa.binary()))]
                            none = [pa.nulls(1, k) for k in (batch.column("doc_id").type, pa.int64(), pa.string(), pa.string(), FRAGMENTS)]
                            yield pa.RecordBatch.from_arrays([head[0], *none, *tile], names=names)
                        else:
                            found.append(np.stack(solver.runs(words, np.array([0, len(words)]))))
                    start, stop, period = np.concatenate(found, axis=1)
                    of = np.zeros(len(start), np.int64)
                    joined = [None]
                    kept = np.array([many or bool((stop - start >= LEAST_WORDS).any())])
                    if not kept[0]:
                        joined = [squeezed_hash(part, reader.is_word, limit=piece_bytes)]
                else:
                    starts, ends, text = word_spans(part, offsets, reader.is_word)
                    words = reader.hashes(part, starts, ends)
                    at_word = np.searchsorted(text, np.arange(n + 1))
                    size = np.diff(at_word)
                    start, stop, period = solver.runs(words, at_word)
                    real = stop - start >= LEAST_WORDS
                    order = np.argsort(start[real], kind="stable")
                    start, stop, period = (v[real][order] for v in (start, stop, period))
                    of = np.searchsorted(at_word, start, side="right") - 1
                    start, stop = start - at_word[of], stop - at_word[of]
                    kept = np.zeros(n, dtype=bool)
                    kept[of] = True
                    out, edge = squeezed(part, starts, ends, text, n)
                    joined = [None if k else hashlib.sha256(out[a:b]).hexdigest() for a, b, k in zip(edge, edge[1:], kept)]
                    many = False
                own = own.take(pa.array(np.arange(n), mask=~kept))
                found = _nested(start, stop, period, of, n)
                rest = [pa.nulls(n, k) for k in (pa.int32(), pa.int32(), pa.int64(), pa.binary())]
                yield pa.RecordBatch.from_arrays([*head, pa.array(size.astype(np.int64)), pa.array(joined, pa.string()), own, found, *rest], names=names)

    return store(rows.mapInArrow(task, schema), "runs-read")


def solved_tiles(rows: DataFrame) -> DataFrame:
    """Rows (_key, start, stop, period) of the tiles among ``rows``, which are spread anew."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver = Solver()
        for batch in batches:
            for i in range(batch.num_rows):
                key, first, last, at, raw = (batch.column(c)[i] for c in ("_key", "tile_first", "tile_last", "tile_start", "tile"))
                words = np.frombuffer(raw.as_buffer(), dtype=U64)
                start, stop, period = solver.runs(words, np.array([0, len(words)]), first.as_py(), last.as_py())
                columns = [np.full(len(start), key.as_py(), np.int64), start + at.as_py(), stop + at.as_py(), period]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["_key", "start", "stop", "period"])

    open_ = rows.where("tile is not null").select("_key", "tile_first", "tile_last", "tile_start", "tile")
    return open_.repartition("_key", "tile_last", "tile_start").mapInArrow(task, "_key long, start long, stop long, period long")


def stitched(fragments: DataFrame) -> DataFrame:
    """Whole runs (_key, start, length, period) of fragments: those of one text and period that overlap by the period."""
    before = Window.partitionBy("_key", "period").orderBy("start", "stop")
    fresh = F.coalesce(F.col("start") + F.col("period") > F.max("stop").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    numbered = fragments.withColumn("_fresh", fresh.cast("int")).withColumn("_run", F.sum("_fresh").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("_key", "period", "_run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    runs = whole.select("_key", "start", (F.col("stop") - F.col("start")).alias("length"), "period")
    return runs.where(F.col("length") >= F.greatest(F.lit(LEAST_WORDS), REPEATS * F.col("period")))


def runs_of(rows: DataFrame) -> DataFrame:
    """All runs (_key, start, length, period) of what ``read`` returned."""
    here = rows.select("_key", F.explode("fragments").alias("f")).select("_key", "f.start", "f.stop", "f.period")
    return stitched(here.unionByName(solved_tiles(rows)))


def document_runs(docs: DataFrame, tile_words: int = TILE_WORDS) -> DataFrame:
    """Rows (doc_id, start, length, period), one per run; rows of equal id are told apart by _key."""
    rows = read(docs, tile_words)
    return rows.where("n_words is not null").select("_key", "doc_id").join(runs_of(rows), "_key")


def digest(docs: DataFrame, tile_words: int = TILE_WORDS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Rows (doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256), one per document: the
    number of its runs, that of the greatest exponent, hashes of all runs and of the text without their repeats."""
    rows = read(docs, tile_words, piece_bytes)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    names = [c.split()[0] for c in schema.split(", ")]
    # A document's runs are fewer than its words.
    by_doc = runs_of(rows).groupBy(F.col("_key").alias("_of")).agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    texts = rows.where("text is not null").select("_key", "doc_id", "n_words", "text").join(by_doc, F.col("_key") == F.col("_of"), "left")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_word = spaced_words()
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                runs = batch.column("runs")[i].values
                values = [runs.field(c).to_numpy() for c in ("start", "length", "period")] if runs is not None else [np.zeros(0, np.int64)] * 3
                order = np.lexsort((values[2], values[0]))
                start, length, period = (v[order] for v in values)
                change = np.zeros(batch.column("n_words")[i].as_py() + 1, dtype=np.int32)
                np.add.at(change, start + period, 1)
                np.add.at(change, start + length, -1)
                data = np.frombuffer(batch.column("text")[i].as_buffer(), dtype=np.uint8)
                joined = squeezed_hash(data, is_word, np.cumsum(change[:-1]) > 0, piece_bytes)
                listed = "".join(f"{a},{b},{c}\n" for a, b, c in zip(start.tolist(), length.tolist(), period.tolist()))
                best = None
                for a, b, c in zip(start.tolist(), length.tolist(), period.tolist()):  # in order, so ties keep the first
                    if best is None or b * best[2] > best[1] * c:
                        best = (a, b, c)
                own = (*best, best[1] * 1000 // best[2]) if best else (None,) * 4
                out.append((len(start), *own, hashlib.sha256(listed.encode()).hexdigest(), joined))
            kinds = [*[pa.int64()] * 5, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), k) for c, k in zip(zip(*out) if out else [()] * 7, kinds))], names=names)

    none: dict[str, Column] = {c: F.lit(None).cast("long") for c in ("start", "length", "period", "exponent_milli")}
    plain = rows.where("n_words is not null and text is null").select(
        "doc_id", F.lit(0).cast("long").alias("n_runs"), *[v.alias(c) for c, v in none.items()], F.lit(hashlib.sha256(b"").hexdigest()).alias("runs_sha256"), F.col("joined").alias("collapsed_sha256")
    )
    return plain.unionByName(texts.drop("_of").mapInArrow(task, schema))


def with_trial_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one of ten documents, by a rule from the id, the words from some place on repeat their first ones."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    rows = docs.select("doc_id", "text", h.alias("_h"), words.alias("_w")).withColumns({"_n": F.size("_w"), "_g": F.floor(F.col("_h") / 10)})
    rows = rows.withColumn("_a", F.when(F.col("_n") > 0, (F.col("_g") % F.col("_n")).cast("int")))
    rows = rows.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    rest = F.col("_n") - F.col("_a")
    block = F.slice("_w", F.col("_a") + 1, F.col("_p"))
    repeated = F.slice(F.flatten(F.array_repeat(block, F.ceil(rest / F.col("_p")).cast("int"))), F.lit(1), rest)
    head = F.when(F.col("_a") > 0, F.slice("_w", F.lit(1), F.greatest("_a", F.lit(1)))).otherwise(F.array().cast(T.ArrayType(T.StringType())))
    made = F.array_join(F.concat(head, repeated), " ")
    return rows.select("doc_id", F.when(F.col("_a").isNotNull(), made).otherwise(F.col("text")).alias("text"))
