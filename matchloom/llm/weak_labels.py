"""Quality classifier from weak labels.

Two aspects are judged, poor form and toxicity. For each, several heuristic labellers vote on every document
(bad, good, or nothing); the ``labels`` table is one more labeller where it has a row. Expectation-maximisation
over the counts of vote patterns (at most 3 to the power of the labellers, counted over all documents) estimates
how often each labeller is right on either class, and so the chance of every pattern to be bad. With these
posteriors a linear scorer over hashed words, word beginnings and style classes is trained: logistic loss,
absolute penalty, so that only telling features keep a weight. The scorer alone decides, so it also judges
documents on which no labeller votes.

Bounds, all parameters: the word lists come from ``LEXICON_ROWS`` labelled documents, the scorer from ``TRAIN_ROWS``
different pairs of id and text (repeated ones count as often as they occur), both chosen by a digest and spread over the
whole table; the one training task gets their features, not their texts. Votes, pattern counts and scores
cover all documents.

Cases: a null or empty text has no features and keeps only the scorer's base rate, so it is kept; a null id has no
label; several labels of one id count as bad if any is; without labels the lists are empty, one labeller is left for
toxicity, whose accuracy nothing can tell, and little is rejected; an empty table gives an empty result; other columns pass unchanged through ``kept_documents``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.llm.common import GRAM, U64, Hasher, flat, grams, lower_table, mix, pieces, plain_words, slices, spaced_words, store, word_spans

LEXICON_ROWS = 6000
TRAIN_ROWS = 6000
BEGINNINGS = (4, 5)  # bytes
TEXT_BYTES = 256 << 10  # texts read at once; a longer one in pieces
MIN_SUPPORT = 4
PRECISION = 0.8
DOUBT = 1e-3  # chance that a word list holds any word by accident
EM_ROUNDS = 100
PENALTY = 0.0003
ROUNDS = 400

# A plain list of insults.
INSULTS = "idiot moron stupid loser trash scum pathetic worthless disgusting clown".split()

POOR = ("strict", "lax", "odd_words", "repeats", "label")
TOXIC = ("insults", "words", "beginnings", "label")
STYLE_CLASSES = 20
# Shares of a text from which the lax and the strict labeller object: symbols, capitals, repeated 5-grams, bars.
LAX = (0.02, 0.3, 0.1, 0.03)
STRICT = (0.05, 0.6, 0.2, 0.1)
ODD_WORDS = 0.25


class Features:
    """Hashed features and labeller inputs of a slice of texts."""

    def __init__(self, limit: int = TEXT_BYTES) -> None:
        self.hasher, self.lower, self.plain, self.spaced, self.limit = Hasher(), lower_table(), plain_words(), spaced_words(), limit
        self.symbol = np.isin(np.arange(256), np.frombuffer(b"#*$%&<>", np.uint8))
        byte = np.arange(256)
        self.upper = (byte >= 65) & (byte <= 90)
        self.letter = self.upper | (byte >= 97) & (byte <= 122)
        self.stop = np.isin(byte, np.frombuffer(b".,;:!?", np.uint8))

    def read(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text of each feature, feature, 0 word / 1 beginning / 2 style; style shares (texts x 5)."""
        n = len(at) - 1
        if n == 1 and len(data) > self.limit:
            sums, words, feature, kind = self._long(data)
            text = np.zeros(len(feature), np.int64)
            of_word = np.zeros(len(words), np.int64)
        else:
            sums, words, of_word = self._tally(data, at)
            text, feature, kind = self._plain(data, at)
        five = grams(words, 5)
        place = np.flatnonzero(of_word[: len(five)] == of_word[4:]) if len(five) else np.zeros(0, np.int64)
        _, same, times = np.unique(mix(five[place] + of_word[place].astype(U64) * U64(GRAM)), return_inverse=True, return_counts=True)
        repeated = np.bincount(of_word[place[times[same] > 1]], minlength=n)
        symbols, capitals, letters, count, bars, odd = sums
        count, size = np.maximum(count, 1), np.maximum(np.diff(at), 1)
        shares = np.stack((symbols / size, capitals / np.maximum(letters, 1), repeated / count, bars / count, odd / count), axis=1)
        of, found, kinds = [text], [feature], [kind]
        filled = np.flatnonzero(np.diff(at) > 0)
        for k in range(shares.shape[1]):
            of.append(filled)
            classes = np.minimum(shares[filled, k] * STYLE_CLASSES, STYLE_CLASSES - 1).astype(np.int64)
            found.append(mix((classes + 1000 * (k + 1)).astype(U64)))
            kinds.append(np.full(len(filled), 2, np.int8))
        return np.concatenate(of), np.concatenate(found), np.concatenate(kinds), shares

    def _tally(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text symbols, capitals, letters, words, bars, odd words (6 x texts); hash and text of each word."""
        n = len(at) - 1
        running = lambda flags: np.concatenate((np.zeros(1, np.int32), np.cumsum(flags, dtype=np.int32)))
        per_text = lambda flags: np.diff(running(flags)[at])
        starts, ends, text = word_spans(data, at, self.spaced)
        hashes = self.hasher.ranges(self.hasher.prefix(data), starts, ends)
        bar = (ends - starts == 1) & (data[starts] == 0x7C) if len(starts) else np.zeros(0, bool)
        letter, upper = running(self.letter[data] | (data >= 0x80)), running(self.upper[data])
        end = self.stop[data[ends - 1]] if len(ends) else np.zeros(0, bool)
        odd = (letter[ends] - letter[starts] + end < ends - starts) | (upper[ends] - upper[starts] > 1)
        by_word = [np.bincount(text[flags], minlength=n) for flags in (np.ones(len(text), bool), bar, odd)]
        return np.stack((per_text(self.symbol[data]), np.diff(upper[at]), per_text(self.letter[data]), *by_word)), hashes, text

    def _plain(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, hash and kind of each word and word beginning in lower case."""
        small = self.lower[data]
        starts, ends, text = word_spans(small, at, self.plain)
        prefix = self.hasher.prefix(small)
        of, found, kind = [text], [self.hasher.ranges(prefix, starts, ends)], [np.zeros(len(text), np.int8)]
        for size in BEGINNINGS:
            longer = np.flatnonzero(ends - starts > size)
            of.append(text[longer])
            found.append(self.hasher.ranges(prefix, starts[longer], starts[longer] + size) ^ U64(size))
            kind.append(np.ones(len(longer), np.int8))
        return np.concatenate(of), np.concatenate(found), np.concatenate(kind)

    def _long(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same of one long text, in pieces cut between words: sums, word hashes, different features, their kinds."""
        sums, words = np.zeros((6, 1), np.int64), [np.zeros(0, U64)]
        features = {0: np.zeros(0, U64), 1: np.zeros(0, U64)}
        for a, b in pieces(data, self.spaced, self.limit):
            one = np.array([0, b - a])
            part, hashes, _ = self._tally(data[a:b], one)
            sums += part
            words.append(hashes)
            _, found, kind = self._plain(data[a:b], one)
            for k, old in features.items():
                features[k] = np.union1d(old, found[kind == k])
        kind = np.repeat(np.array([0, 1], np.int8), [len(features[0]), len(features[1])])
        return sums, np.concatenate(words), np.concatenate((features[0], features[1])), kind

    def of_word(self, word: str) -> int:
        data = np.frombuffer(word.encode(), np.uint8)
        return int(self.hasher.ranges(self.hasher.prefix(data), np.array([0]), np.array([len(data)]))[0])


class Lookup:
    """Weights of a few features among many: a bit table first, then a sorted search."""

    def __init__(self, features: np.ndarray, weights: np.ndarray) -> None:
        order = np.argsort(features)
        self.features, self.weights = features[order], weights[order]
        self.bits = np.zeros(1 << 16, dtype=bool)
        self.bits[(features & U64(0xFFFF)).astype(np.int64)] = True

    def sums(self, text: np.ndarray, features: np.ndarray, n: int) -> np.ndarray:
        """Sum of weights over the different features of each text."""
        if not len(self.features):
            return np.zeros(n)
        near = np.flatnonzero(self.bits[(features & U64(0xFFFF)).astype(np.int64)])
        slot = np.minimum(np.searchsorted(self.features, features[near]), len(self.features) - 1)
        hit = self.features[slot] == features[near]
        pairs = np.unique(text[near][hit].astype(np.int64) * len(self.features) + slot[hit])
        return np.bincount(pairs // len(self.features), weights=self.weights[pairs % len(self.features)], minlength=n)


def any_label(labels: DataFrame) -> DataFrame:
    """One row per id: the worst of its labels."""
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_quality"), F.max("toxic").alias("_toxic"))


def chosen(rows: int, total: int, *columns: str) -> F.Column:
    """True for about ``rows`` of ``total`` rows, by a digest of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) < math.ceil(min(1.0, rows / max(total, 1)) * (1 << 30))


def lexicons(docs: DataFrame, labels: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Words and word beginnings that mark toxic labels beyond doubt, as hashes."""
    known = any_label(labels).where("_toxic is not null")
    total = known.count()
    picked = known.where(chosen(rows, total, "_id"))
    sample = docs.select("doc_id", "text").where(chosen(rows, total, "doc_id")).join(picked, F.col("doc_id") == F.col("_id")).select("text", "_toxic")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Features()
        for batch in batches:
            toxic = np.array(batch.column("_toxic").to_pylist(), dtype=np.int64)
            for first, last, data, at in slices(*flat(batch.column("text")), limit=TEXT_BYTES):
                text, feature, kind, _ = reader.read(data, at)
                word = kind < 2
                _, once = np.unique(mix(feature[word] + text[word].astype(U64) * U64(GRAM)), return_index=True)
                text, feature, kind = text[word][once], feature[word][once], kind[word][once]
                names, start, where = np.unique(feature, return_index=True, return_inverse=True)
                bad = np.bincount(where, weights=toxic[first + text], minlength=len(names)).astype(np.int64)
                every = np.bincount(where, minlength=len(names))
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(kind[start]), pa.array(bad), pa.array(every)], names=["f", "kind", "bad", "every"])

    sums = sample.mapInArrow(count, "f long, kind tinyint, bad long, every long").groupBy("f", "kind").agg(F.sum("bad").alias("bad"), F.sum("every").alias("every"))
    base = picked.agg(F.avg("_toxic"), F.count("*")).first()
    rate = min(max(base[0] or 0.5, 1e-6), 1 - 1e-6)
    if not base[1]:
        return np.zeros(0, U64), np.zeros(0, U64)
    share = F.col("bad") / F.col("every")
    good = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    evidence = F.col("every") * (share * F.log(share / rate) + good)
    sure = sums.where((F.col("bad") >= MIN_SUPPORT) & (share >= PRECISION) & (share > rate)).where(evidence > math.log(1e6 / DOUBT))
    # At most one entry for every MIN_SUPPORT features of the sample's toxic documents.
    found = [(r["f"], r["kind"]) for r in sure.select("f", "kind").collect()]
    pick = lambda k: np.sort(np.array([f for f, kind in found if kind == k], dtype=np.int64).view(U64))
    return pick(0), pick(1)


def votes(docs: DataFrame, words: np.ndarray, beginnings: np.ndarray, keep: tuple[str, ...] = ("doc_id",), features: bool = False) -> DataFrame:
    """The columns of ``keep`` and the vote (1 bad, 0 good, null none) of each labeller that reads the text; if asked for,
    the different features of the text from the same reading."""
    names = [f"poor_{x}" for x in POOR[:-1]] + [f"toxic_{x}" for x in TOXIC[:-1]]
    schema = T.StructType([*(docs.schema[c] for c in keep), *(T.StructField(x, T.ByteType()) for x in names)])
    if features:
        schema.add("features", T.BinaryType())

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Features()
        insults = np.array([reader.of_word(w) for w in INSULTS], dtype=U64)
        lists = [Lookup(x, np.ones(len(x))) for x in (insults, words, beginnings)]
        for batch in batches:
            out, found = np.full((len(names), batch.num_rows), -1, dtype=np.int8), []
            for first, last, data, at in slices(*flat(batch.column("text")), limit=TEXT_BYTES):
                text, feature, _, shares = reader.read(data, at)
                own = out[:, first:last]
                own[0] = (shares[:, :4] >= STRICT).any(axis=1)
                own[1] = (shares[:, :4] >= LAX).any(axis=1)
                own[2] = shares[:, 4] >= ODD_WORDS
                own[3] = shares[:, 2] >= STRICT[2]
                for k, lookup in enumerate(lists):
                    if len(lookup.features):
                        own[len(POOR) - 1 + k] = lookup.sums(text, feature, len(at) - 1) > 0
                if features:
                    _, once = np.unique(mix(feature + text.astype(U64) * U64(GRAM)), return_index=True)
                    once = once[np.argsort(text[once], kind="stable")]
                    edge = np.searchsorted(text[once], np.arange(last - first + 1))
                    found += [feature[once[a:b]].tobytes() for a, b in zip(edge, edge[1:])]
            columns = [*(batch.column(c) for c in keep), *(pa.array(x, mask=x < 0) for x in out), *([pa.array(found, pa.binary())] if features else [])]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(vote, schema)


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Chance of each pattern (votes 1, 0, or -1 for none) to be bad; per labeller its chance to vote bad on good
    and on bad documents. Starts from the belief that a labeller hardly ever accuses a good document and finds
    three in ten of the bad ones, as each looks for a fault of its own kind."""
    says, bad = patterns >= 0, patterns == 1
    believed = np.array([[0.002], [0.3]])
    rate, prior = np.tile(believed, patterns.shape[1]), 0.1
    post = np.zeros(len(patterns))
    for _ in range(rounds):
        log = [np.where(says, np.where(bad, np.log(r), np.log(1 - r)), 0).sum(axis=1) for r in rate]
        odds = np.clip(log[1] - log[0] + math.log(prior / (1 - prior)), -700, 700)
        post = 1 / (1 + np.exp(-odds))
        for k, weight in enumerate((counts * (1 - post), counts * post)):
            mass = (weight[:, None] * says).sum(axis=0)
            rate[k] = ((weight[:, None] * bad).sum(axis=0) + believed[k]) / (mass + 1)
        rate = np.clip(rate, 1e-4, 1 - 1e-4)
        prior = float(np.clip((counts * post).sum() / max(counts.sum(), 1), 1e-4, 0.5))
    return post, rate


def fit_scorer(text: np.ndarray, feature: np.ndarray, goal: np.ndarray, times: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS):
    """Features with their weights, and the base: logistic loss on soft goals with an absolute penalty, over the
    features whose occurrence goes with the goal beyond chance. A text counts ``times``."""
    texts, n = len(goal), int(times.sum())
    names, where = np.unique(feature, return_inverse=True)
    df = np.bincount(where, weights=times[text], minlength=len(names))
    mean = float(np.clip((goal * times).sum() / n, 1e-6, 1 - 1e-6))
    pull = np.bincount(where, weights=((goal - mean) * times)[text], minlength=len(names))
    z = np.abs(pull) / np.sqrt(df * mean * (1 - mean))
    often = (df >= MIN_SUPPORT) & (z > math.sqrt(2 * math.log(max(len(names), 2))) + 1)
    column = np.cumsum(often) - 1
    use = often[where]
    text, where, names = text[use], column[where[use]], names[often]
    scale = np.sqrt(n / df[often])  # columns of one length, or rare features would hardly move
    entry = scale[where]
    w, base = np.zeros(len(names)), math.log(mean / (1 - mean))
    look, base_look, t = w.copy(), base, 1.0
    v, norm = np.ones(len(names) + 1), 1.0  # power iterations for the curvature, the base included
    for _ in range(12):
        u = (np.bincount(text, weights=v[where] * entry, minlength=texts) + v[-1]) * times
        v = np.append(np.bincount(where, weights=u[text] * entry, minlength=len(names)), u.sum())
        norm = float(np.linalg.norm(v)) or 1.0
        v /= norm
    step = 4 * n / (1.1 * norm)
    for _ in range(rounds):
        margin = np.bincount(text, weights=look[where] * entry, minlength=texts) + base_look
        error = (1 / (1 + np.exp(-np.clip(margin, -60, 60))) - goal) * times
        new = look - step * np.bincount(where, weights=error[text] * entry, minlength=len(names)) / n
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty * scale, 0)
        new_base = base_look - step * float(error.sum()) / n
        t_new = (1 + math.sqrt(1 + 4 * t * t)) / 2
        look, base_look = new + (t - 1) / t_new * (new - w), new_base + (t - 1) / t_new * (new_base - base)
        w, base, t = new, new_base, t_new
    kept = w != 0
    return names[kept], (w * scale)[kept], base


def train(docs: DataFrame, labels: DataFrame, lexicon_rows: int = LEXICON_ROWS, train_rows: int = TRAIN_ROWS) -> dict:
    """The scorers of both aspects, and what the labellers were found to be worth."""
    words, beginnings = lexicons(docs, labels, lexicon_rows)
    known = any_label(labels)

    def with_labels(rows: DataFrame) -> DataFrame:
        joined = rows.join(known, F.col("doc_id") == F.col("_id"), "left")
        return joined.withColumns({"poor_label": (1 - F.col("_quality")).cast("byte"), "toxic_label": F.col("_toxic").cast("byte")})

    aspects = {"poor": [f"poor_{x}" for x in POOR], "toxic": [f"toxic_{x}" for x in TOXIC]}
    names = [c for columns in aspects.values() for c in columns]
    counted = store(with_labels(votes(docs, words, beginnings)).groupBy(*names).count(), "patterns").collect()  # at most 3 ** 9 rows, by the number of labellers
    table = np.array([[-1 if r[c] is None else r[c] for c in names] for r in counted], dtype=np.int8).reshape(len(counted), len(names))
    counts = np.array([r["count"] for r in counted], dtype=float)
    model: dict = {"labellers": {}, "scorers": {}}
    posterior = {}
    for aspect, columns in aspects.items():
        own = table[:, [names.index(c) for c in columns]]
        unique, where = np.unique(own, axis=0, return_inverse=True)
        chance, rate = expectation_maximisation(unique, np.bincount(where.ravel(), weights=counts, minlength=len(unique)))
        posterior[aspect] = {tuple(int(x) for x in p): float(c) for p, c in zip(unique, chance)}
        model["labellers"][aspect] = {c: (float(a), float(b)) for c, a, b in zip(columns, *rate)}
    total = int(counts.sum())
    sample = docs.select("doc_id", "text").where(chosen(train_rows, total, "doc_id", "text")).groupBy("doc_id", "text").agg(F.count("*").alias("times"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, times = [], []
        goals: dict[str, list[float]] = {a: [] for a in aspects}
        for batch in batches:
            parts += [np.frombuffer(x, U64) for x in batch.column("features").to_pylist()]
            times.append(batch.column("times").to_numpy())
            for aspect, columns in aspects.items():
                patterns = zip(*(batch.column(c).fill_null(-1).to_pylist() for c in columns))
                goals[aspect] += [posterior[aspect][p] for p in patterns]
        if not parts:
            return
        text, feature = np.repeat(np.arange(len(parts)), [len(p) for p in parts]), np.concatenate(parts)
        for aspect, goal in goals.items():
            found, weight, base = fit_scorer(text, feature, np.array(goal), np.concatenate(times))
            yield pa.RecordBatch.from_arrays([pa.array([aspect]), pa.array([found.tobytes()], pa.binary()), pa.array([weight.tobytes()], pa.binary()), pa.array([base])], names=["aspect", "features", "weights", "base"])

    # One reading of each text, and no step in Python feeds another in the same task: each would hold a worker process.
    rows = with_labels(votes(sample, words, beginnings, keep=("doc_id", "times"), features=True)).select("features", "times", *names)
    # One task: a bounded sample, see the module's text.
    for r in rows.repartition(1).mapInArrow(learn, "aspect string, features binary, weights binary, base double").collect():
        model["scorers"][r["aspect"]] = (np.frombuffer(r["features"], U64), np.frombuffer(r["weights"], np.float64), r["base"])
    return model


def judged(docs: DataFrame, model: dict, schema: T.StructType, give: Callable[[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray], pa.RecordBatch]) -> DataFrame:
    """What ``give`` makes of each batch of ``docs``, its chances to be poor and to be toxic, and whether it is kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model["scorers"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Features()
        scorers = {a: (Lookup(f, w), base) for a, (f, w, base) in shared.value.items()}
        for batch in batches:
            chance = {a: np.zeros(batch.num_rows) for a in ("poor", "toxic")}
            for first, last, data, at in slices(*flat(batch.column("text")), limit=TEXT_BYTES):
                text, feature, _, _ = reader.read(data, at)
                for aspect, (lookup, base) in scorers.items():
                    margin = lookup.sums(text, feature, len(at) - 1) + base
                    chance[aspect][first:last] = 1 / (1 + np.exp(-np.clip(margin, -60, 60)))
            yield give(batch, chance["poor"], chance["toxic"], (chance["poor"] < 0.5) & (chance["toxic"] < 0.5))

    return docs.mapInArrow(score, schema)


def scored(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with p_poor, p_toxic (chances to be bad) and kept."""
    schema = T.StructType([*docs.schema.fields, T.StructField("p_poor", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()), T.StructField("kept", T.BooleanType())])

    def give(batch: pa.RecordBatch, poor: np.ndarray, toxic: np.ndarray, kept: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(poor), pa.array(toxic), pa.array(kept)], schema=pa.schema([*batch.schema, ("p_poor", pa.float64()), ("p_toxic", pa.float64()), ("kept", pa.bool_())]))

    return judged(docs, model, schema, give)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, p_poor, p_toxic, kept), one per document."""
    return scored(docs.select("doc_id", "text"), train(docs, labels)).drop("text")


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rejected ones, all columns kept."""
    return judged(docs, train(docs, labels), docs.schema, lambda batch, poor, toxic, kept: batch.filter(pa.array(kept)))
