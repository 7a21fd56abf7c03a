"""Helpers of the operators: texts of an Arrow batch as flat byte arrays, hashes of words and n-grams,
tables in the shared scratch folder.

All text work is on UTF-8 bytes. That is exact for word classes that treat all bytes from 0x80 on alike.
Hashes have 64 bits; where a result hangs on equality across documents the callers compare bytes or join
two independent hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.session import scratch_path

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
GRAM = 0xD6E8FEB86659FD93
SLICE_BYTES = 2 << 20
WORK_BYTES = 256 << 10  # the same where each byte needs many bytes to work with
PIECE_BYTES = 1 << 20


def byte_class(separators: Callable[[int], bool]) -> np.ndarray:
    """A table of 256 booleans: True for bytes that belong to a word."""
    return np.array([not separators(b) for b in range(256)])


def lower_table() -> np.ndarray:
    """Bytes A-Z to a-z, all others to themselves."""
    return np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def spaced_words() -> np.ndarray:
    """Words are runs of anything but space and 0x09-0x0D."""
    return byte_class(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)


def plain_words() -> np.ndarray:
    """Words are runs of digits, a-z and all beyond ASCII (for texts in lower case)."""
    return byte_class(lambda b: b < 0x80 and not (48 <= b <= 57 or 97 <= b <= 122))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


class Hasher:
    """Hashes of byte ranges from one pass over the bytes (prefix sums of a polynomial modulo 2**64)."""

    def __init__(self, base: int = BASE) -> None:
        self.base, self.inverse = U64(base), U64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, dtype=U64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, min(2 * len(self.up), SLICE_BYTES + 1))
            self.up = np.cumprod(np.concatenate(([U64(1)], np.full(n - 1, self.base, dtype=U64))))
            self.down = np.cumprod(np.concatenate(([U64(1)], np.full(n - 1, self.inverse, dtype=U64))))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data) + 1)
        out = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum((data.astype(U64) + U64(1)) * self.up[: len(data)], out=out[1:])
        return out

    def ranges(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((prefix[ends] - prefix[starts]) * self.down[starts])


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(data: np.ndarray, at: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of whole texts of about ``limit`` bytes (a longer text stands alone): first, last + 1, bytes, offsets."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield first, last, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def pieces(data: np.ndarray, is_word: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of about ``limit`` bytes that end after a separator, so no word is cut; a longer word has a range of its own."""
    a = 0
    while a < len(data):
        b = min(a + limit, len(data))
        if b < len(data):
            gaps = np.flatnonzero(~is_word[data[a:b]])
            if len(gaps):
                b = a + int(gaps[-1]) + 1
            else:
                while b < len(data):
                    gaps = np.flatnonzero(~is_word[data[b : b + limit]])
                    b = b + int(gaps[0]) + 1 if len(gaps) else min(b + limit, len(data))
                    if len(gaps):
                        break
        yield a, b
        a = b


def word_spans(data: np.ndarray, at: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of all words; words end where their text ends."""
    inside = is_word[data]
    before = np.zeros_like(inside)
    before[1:] = inside[:-1]
    before[at[:-1][at[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros_like(inside)
    after[:-1] = inside[1:]
    after[at[1:][at[1:] > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(at, starts, side="right") - 1


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n values, by the place of their first one."""
    if len(hashes) < n:
        return np.zeros(0, dtype=U64)
    out = hashes[: len(hashes) - n + 1].copy()
    for j in range(1, n):
        out *= U64(GRAM)
        out += hashes[j : len(hashes) - n + 1 + j]
    return mix(out)


def pack(values: np.ndarray) -> bytes:
    """Integers by byte planes, compressed: high planes are nearly empty in most columns."""
    import zstandard

    flat_planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.ZstdCompressor(level=1).compress(flat_planes.tobytes())


def unpack(raw: bytes, kind: type) -> np.ndarray:
    import zstandard

    width = np.dtype(kind).itemsize
    flat_planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8)
    return np.ascontiguousarray(flat_planes.reshape(width, -1).T).view(kind).ravel()


# Messages between blocks of documents and shards of keys: a block asks, each shard answers the block in the order of the
# questions.
MESSAGE = "block long, shard long, round int, a binary, b binary, c binary, d binary, e binary"


def message(block: int, shard: int, number: int, *parts: bytes) -> dict:
    return {"block": block, "shard": shard, "round": number} | dict(zip("abcde", [*parts, *[None] * (5 - len(parts))]))


def as_table(messages: list[dict]) -> pa.Table:
    kinds = [("block", pa.int64()), ("shard", pa.int64()), ("round", pa.int32()), *((c, pa.binary()) for c in "abcde")]
    return pa.Table.from_pylist(messages, schema=pa.schema(kinds))


def by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard with the places of its entries, in order."""
    order = np.argsort(shard, kind="stable")
    edge = np.flatnonzero(np.diff(shard[order], prepend=-1))
    for a, b in zip(edge, np.append(edge[1:], len(order))):
        yield int(shard[order[a]]), order[a:b]


def store(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage where executors may be lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts (one column is read)."""
    return df.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0


def block_count(total_bytes: int, per_block: int) -> int:
    return max(1, -(-total_bytes // per_block))
