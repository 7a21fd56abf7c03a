"""Runs of words against a plain search of all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from matchloom.llm import word_runs
from matchloom.llm.common import table

from .conftest import ODD, SPACED, prose, whole_table


def plain_runs(words):
    """(start, length, period) of all runs, by comparing every word with that one period later."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and not any(q % d == 0 and all(words[m] == words[m + d] for m in range(i, j + q - d)) for d in range(1, q)):
                found.append((i, j - i + q, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc, text):
    words = SPACED.findall(text or "")
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    own = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc, len(runs), *own, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept))


def plain_trial(doc, text):
    words = SPACED.findall(text or "")
    if doc is None or zlib.crc32(str(doc).encode()) % 10 or not words:
        return text
    n, h = len(words), zlib.crc32(str(doc).encode())
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(w if i < a else words[a + (i - a) % p] for i, w in enumerate(words))


def order(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_given_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in whole_table("documents")]
    got = order(word_runs.digest(word_runs.with_trial_repeats(table(spark, "/root/testdata/sf0.001", "documents"))).collect())
    assert got == order(plain_row(d, plain_trial(d, t)) for d, t in docs)
    assert sum(r[1] > 0 for r in got) >= 10


def noisy(seed, n, kinds):
    draw = random.Random(seed)
    words = []
    while len(words) < n:
        block = [f"w{draw.randrange(kinds)}" for _ in range(draw.randrange(1, 40))]
        words += block * draw.choice((1, 1, 2, 3, 4, 5, 9))
        words = words[: len(words) - draw.randrange(2)]
    return " ".join(words[:n])


HARD = [
    (1, "a " * 5), (2, "a " * 6), (3, "a b " * 4), (4, "a b c d " * 3 + "a b c"), (5, "x " + "a b " * 4 + "a"), (6, "a " * 1000),
    (7, "a a b " * 50 + "c " + "b a a " * 40), (8, ("a " * 7 + "b ") * 9), (9, "\n".join(["same line here"] * 30)), (10, "a\ta\x0ba\x0ca\ra\na\xa0a"),
    (11, noisy(1, 800, 2)), (12, noisy(2, 900, 5)), (13, noisy(3, 700, 3)), (14, "a b " * 3 + "a b c " * 5 + "a b " * 5), (15, " ".join(format(i, "b") for i in range(400))),
    (16, " ".join("ab"[bin(i).count("1") % 2] for i in range(3000))),  # no run of three in a row
    (17, (prose(5, 100) + " ") * 6), (18, "é中 文 " * 9), (19, "A a " * 9), (19, "A a " * 9), (None, "q " * 9), (None, None), (20, ""), (21, " \n"),
]


@pytest.mark.parametrize("tile_words, piece_bytes", [(1 << 16, 1 << 20), (64, 1 << 20), (64, 60), (1 << 16, 7)])
def test_hard_texts_in_tiles(spark, tile_words, piece_bytes):
    """Small tiles (most texts in several, in all octaves) and small pieces (words longer than a piece too)."""
    docs = spark.createDataFrame([(*r, 1, "x") for r in HARD], "doc_id long, text string, start int, tile string").repartition(3)
    got = word_runs.digest(docs, tile_words=tile_words, piece_bytes=piece_bytes)
    assert order(got.collect()) == order(plain_row(*r) for r in HARD)


def test_odd_rows_and_none(odd, no_docs):
    want = order(plain_row(r[0], r[1]) for r in ODD if r[0] != 11)
    assert order(word_runs.digest(odd.where("doc_id is null or doc_id != 11")).collect()) == want
    assert word_runs.digest(no_docs).count() == 0
    assert word_runs.with_trial_repeats(no_docs).count() == 0


def test_trial_repeats(spark):
    docs = [(i, prose(i, 5 + i % 50)) for i in range(300)] + [(None, "a b"), (301, None), (302, "")]
    got = word_runs.with_trial_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert order(got) == order((d, plain_trial(d, t)) for d, t in docs)


def test_very_long_text(spark):
    """A text of 20 MB in many tiles of several octaves, with runs of a short, a long and a very long period."""
    short, middle = "la li " * 200_000, (prose(1, 3_000) + " ") * 5
    long = (prose(2, 150_000) + " ") * 4
    docs = spark.createDataFrame([(1, short + middle + long), (2, "calm words only")], "doc_id long, text string")
    got = sorted((r["period"], r["length"] // r["period"]) for r in word_runs.document_runs(docs).collect())
    assert got == [(2, 200_000), (3_000, 5), (150_000, 4)]


def test_fragments_cover_every_window():
    for n in (10, 63, 64, 65, 200, 1000, 5000):
        made = list(word_runs.tiles(n, 64))
        for k in range(max(n // 4, 1).bit_length()):
            width = 4 * min((2 << k) - 1, n // 4)
            mine = sorted((a, b) for low, high, a, b in made if low <= k <= high)
            if width >= 4 << k:
                assert all(any(a <= s and s + width <= b for a, b in mine) for s in range(n - width + 1))


def test_a_lying_hash_is_found_out():
    words = np.array([1, 2] * 10 + [3] + [1, 2] * 4, dtype=np.uint64)
    assert word_runs.checked(words, 0, 29, 4, 2, 0, 29) == (0, 20)
    assert word_runs.checked(words, 2, 18, 4, 2, 0, 29) == (0, 20)
    assert word_runs.checked(words, 0, 20, 4, 2, 0, 29) == (0, 20)
