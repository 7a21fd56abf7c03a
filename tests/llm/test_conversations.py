"""The trie of conversations against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from matchloom.llm import prefix_trie
from matchloom.llm.common import table

from .conftest import whole_table


def plain_sequences(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            by_conv[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    return {c: [x for _, x in sorted(turns)] for c, turns in by_conv.items()}


def plain_heads(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain_nodes(sequences):
    members, ends, ways = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                ways[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not ways[node]
            saved[node[:d]] += (len(who) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(ways[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, who in members.items()
    )


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def wanted(sequences):
    return sorted(plain_nodes(sequences), key=lambda r: tuple((x is not None, x) for x in r))


def test_given_conversations(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in whole_table("conversations", "/root/testdata/sf0.01")]
    got = found(prefix_trie.conversation_nodes(table(spark, "/root/testdata/sf0.01", "conversations")))
    assert got == wanted(plain_heads(plain_sequences(rows)))
    assert max(r[3] for r in got if r[1] > 1) > 5


ODD = [
    (100, 0, "user", "same start"), (100, 1, "bot", "answer"), (100, 2, None, "x"), (100, 3, "user", None), (100, 4, "bot", "e"), (100, 5, "user", "f"),
    *[(100 + k, t, "user", f"own {k % 3} {t}") for k in range(1, 40) for t in range(k % 8)],
    (205, 0, "user", "no base"), (205, 1, "bot", "b"),
    (None, 0, "user", "nobody's"),
    (300, None, "user", "null turn"), (300, 0, "user", "after"), (300, 0, "bot", "tie"), (300, 0, "bot", "tie"),
    (-150, 0, "", ""), (-100, 0, "user", "below zero é中"),
    (400, 0, "user", "z" * 100_000),
    *[(500 + k, t, "u", "alike") for k in range(60) for t in range(5)],
    *[(700, t, "u", "long run") for t in range(600)], *[(701 + k, t, "u", "long run") for k in range(3) for t in range(200 * (k + 1))],
]


@pytest.fixture(scope="module")
def odd_turns(spark):
    # names that the operator uses inside
    return spark.createDataFrame([(*r, "x", 1, 2) for r in ODD], "conv_id long, turn long, role string, text string, path string, depth int, _turn long")


def test_odd_rows(odd_turns):
    assert found(prefix_trie.conversation_nodes(odd_turns)) == wanted(plain_heads(plain_sequences(ODD)))


def test_no_conversations(odd_turns):
    assert prefix_trie.conversation_nodes(odd_turns.limit(0)).count() == 0
    assert prefix_trie.conversation_nodes(odd_turns.where("conv_id is null")).count() == 0


def branching(seed, n, depth, ways):
    draw = random.Random(seed)
    return {i: [("u", "ab"[: draw.randrange(1, 3)] * draw.randrange(1, ways)) for _ in range(draw.randrange(depth))] for i in range(n)}


@pytest.mark.parametrize("depth, ways, batch", [(7, 2, 3), (40, 2, 50), (4, 30, 1000)])
def test_ranges_that_share_paths(spark, depth, ways, batch):
    """Many ranges of few sequences: nearly every inner node lies in several, and batches meet in one range."""
    own = branching(depth, 400, depth, ways)
    rows = [(c, t, *x) for c, turns in own.items() for t, x in enumerate(turns)]
    own = {c: x for c, x in own.items() if x}  # those without rows are in no table
    convs = prefix_trie.turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        assert found(prefix_trie.nodes_of(convs, range_turns=60)) == wanted(own)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_exit_nodes_are_found_with_few_lookups():
    draw = random.Random(5)
    paths = sorted({bytes(draw.choice(b"ab") for _ in range(draw.randrange(300))) for _ in range(200)})
    whole = [prefix_trie.Sequence(b"".join(bytes([c]) * 16 for c in p), bytes(4 * len(p)), 1, k) for k, p in enumerate(paths)]
    draw.shuffle(whole)
    trie = prefix_trie.ZFastTrie()
    seen = []
    for k in range(0, len(whole), 17):
        trie.insert_batch(whole[k : k + 17])
        seen += whole[k : k + 17]
        for x in whole:
            exits = max(common(x.path, y.path) for y in seen)
            node, depth = trie.locate(x)
            assert depth == exits and node.low < max(depth, 1) and depth <= node.high

    class Counted(dict):
        asked = 0

        def get(self, key):
            Counted.asked += 1
            return super().get(key)

    trie.handles = Counted(trie.handles)
    for x in whole:
        Counted.asked = 0
        trie.locate(x)
        assert Counted.asked <= max(x.length, 1).bit_length() + 1


def common(a, b):
    n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return n // 16


def test_two_fattest():
    for low in range(40):
        for high in range(low + 1, 60):
            power = lambda n: n & -n
            best = max(range(low + 1, high + 1), key=power)
            assert power(prefix_trie.two_fattest(low, high)) == power(best)
