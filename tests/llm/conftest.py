import re
from pathlib import Path

import pytest
from pyspark.sql import types as T

from matchloom.session import scratch_path

SMALL = "/root/testdata/sf0.001"
TABLES = "/root/testdata/sf0.01"

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use inside
        T.StructField("size", T.LongType()),
        T.StructField("block", T.StringType()),
        T.StructField("_text", T.StringType()),
        T.StructField("node", T.LongType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("items", T.StringType()),
    ]
)

WORDS = "amber birch cedar delta ember fjord grove hazel inlet jetty knoll larch meadow north otter pine quartz river stone tarn".split()


def prose(seed: int, n: int) -> str:
    """``n`` words that do not repeat in runs."""
    out, state = [], seed * 7919 + 1
    for _ in range(n):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(WORDS[(state >> 33) % len(WORDS)] + str((state >> 40) % 50))
    return " ".join(out)


BENCH = prose(500, 14)
LONG = prose(77, 30_000)
BASE = prose(3, 300)
NEAR = BASE.replace(BASE.split()[150], "changed", 1)
PASSAGE = prose(9, 60)

ODD = [
    (1, BASE, "en", "a"),
    (2, BASE, "en", "a"),  # a copy
    (3, NEAR, "en", "b"),  # a near copy
    (4, None, "en", "a"),
    (5, "", None, None),
    (6, " \n\t ", "de", "b"),
    (7, "One", "en", "a"),
    (8, "one", "en", "a"),
    (9, "two words", "en", None),
    (10, "Before it. " + BENCH.upper() + ", and after", "en", "c"),
    (11, LONG, "en", "c"),
    (None, prose(21, 40), "en", "a"),
    (None, None, None, None),
    (12, prose(31, 20) + " " + PASSAGE, "en", "a"),
    (13, PASSAGE + " " + prose(32, 25), "en", "a"),
    (14, "éè 中文 " * 30, "fr", "c"),  # bytes beyond ASCII, repeats itself
    (15, prose(41, 50), "en", "a"),
    (15, prose(41, 50), "en", "a"),  # the same row again
    (16, "### $$$ " * 40, "en", "b"),
    (17, "line one here\nline one here\nother\n\n", "en", "b"),
    (18, "nul \x00 byte \x1f end", "en", "b"),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, lang, source, None if t is None else len(t), 5, "x", "y", 1, True, "z") for i, t, lang, source in ODD]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def bench(spark):
    rows = [(1, BENCH, "x"), (2, "Two, WORDS!", "x"), (None, prose(500, 30), "x"), (3, None, "x"), (4, "", "x"), (20, BENCH, "x"), (3, BENCH, "x")]
    return spark.createDataFrame(rows, "item_id long, text string, items string")


@pytest.fixture
def scratch(spark):
    return lambda label: scratch_path(spark, label)


SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def whole_table(name: str, sf: str = SMALL) -> list:
    import pyarrow.parquet as pq

    return pq.read_table(Path(sf) / f"{name}.parquet").to_pylist()
