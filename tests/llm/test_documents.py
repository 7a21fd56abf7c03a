"""Operators on documents against plain versions, on a table of odd rows and on a given table."""

import hashlib
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from matchloom.llm import common, decontaminate, jaccard_join, lm_score, mixing, quality_rules, suffix_dedup
from matchloom.llm.common import table

from .conftest import BENCH, LONG, LOWER, ODD, PLAIN, SMALL, SPACED, TABLES, prose, whole_table

KEY = lambda r: (r[0] is None, r[0] or 0, str(r))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=KEY)


# Benchmark decontamination


def plain_scan(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = PLAIN.findall((text or "").translate(LOWER))
        n = min(10, len(w))
        for k in range(len(w) - n + 1) if w else ():
            windows[tuple(w[k : k + n])] |= set() if item is None else {str(item)}
    out = []
    for doc, text in docs:
        w, hit, ids = PLAIN.findall((text or "").translate(LOWER)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    ids |= windows[x]
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(ids), sha, bool(hit)))
    return sorted(out, key=KEY)


@pytest.mark.parametrize("pass_bytes", [decontaminate.PASS_BYTES, 120])
def test_decontaminate_odd_rows(odd, bench, pass_bytes):
    got = rows(decontaminate.digest(decontaminate.scan(odd, bench, pass_bytes=pass_bytes)))
    assert got == plain_scan([(r[0], r[1]) for r in ODD], [tuple(r)[:2] for r in bench.collect()])
    assert sum(r[5] for r in got) >= 2


def test_decontaminate_drops_only_hit_documents(odd, bench, no_docs):
    kept = decontaminate.clean_documents(odd, bench)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 10 not in ids and 9 not in ids and len(ids) == len(ODD) - 2
    assert decontaminate.clean_documents(no_docs, bench).count() == 0
    assert decontaminate.clean_documents(odd, bench.limit(0)).count() == len(ODD)


def test_shift_table_skips_most_positions():
    patterns = decontaminate.Patterns([(1, BENCH)], 10)
    group = patterns.groups[0]
    assert group.length == 10 and group.shift.max() == 9
    assert (group.shift == 9).mean() > 0.99


# Stupid backoff


def plain_scores(docs):
    import math

    words = [(doc, (doc or 0) % 2, PLAIN.findall((text or "").translate(LOWER))) for doc, text in docs]
    counts = [Counter(), Counter()]
    for _, fold, w in words:
        for n in (1, 2, 3):
            counts[fold].update(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    total = [sum(c for g, c in counts[f].items() if len(g) == 1) for f in (0, 1)]
    out = []
    for doc, fold, w in words:
        c, big, score, full = counts[1 - fold], total[1 - fold], 0.0, 0
        for i in range(len(w)):
            context = min(i, 2)
            for n in range(context, -1, -1):
                if c[tuple(w[i - n : i + 1])]:
                    below = c[tuple(w[i - n : i])] if n else big
                    score += math.log(c[tuple(w[i - n : i + 1])] / below) + (context - n) * math.log(0.4)
                    full += n == context
                    break
            else:
                score += (context + 1) * math.log(0.4) - math.log(big + 1)
        out.append((doc, len(w), full, score, score / len(w) if w else None))
    return sorted(out, key=KEY)


def test_backoff_scores(odd, no_docs):
    for block_bytes in (lm_score.BLOCK_BYTES, 20_000):
        got = sorted((tuple(r) for r in lm_score.score(odd, block_bytes=block_bytes).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
        want = sorted(plain_scores([(r[0], r[1]) for r in ODD]), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
        assert [r[:3] for r in got] == [r[:3] for r in want]
        for a, b in zip(got, want):
            assert a[3] == pytest.approx(b[3], abs=1e-6) and (a[4] is None) == (b[4] is None)
    assert lm_score.score(no_docs).count() == 0


def plain_leave_one_out(docs):
    import math

    words = [(doc, PLAIN.findall((text or "").translate(LOWER))) for doc, text in docs]
    grams = [Counter(tuple(w[k : k + n]) for n in (1, 2, 3) for k in range(len(w) - n + 1)) for _, w in words]
    whole = sum(grams, Counter())
    out = []
    for (doc, w), own in zip(words, grams):
        big = sum(len(x) for _, x in words) - len(w)
        score, full = 0.0, 0
        for i in range(len(w)):
            context = min(i, 2)
            for n in range(context, -1, -1):
                gram = tuple(w[i - n : i + 1])
                if seen := whole[gram] - own[gram]:
                    below = whole[gram[:-1]] - own[gram[:-1]] if n else big
                    score += math.log(seen / below) + (context - n) * math.log(0.4)
                    full += n == context
                    break
            else:
                score += (context + 1) * math.log(0.4) - math.log(big + 1)
        out.append((doc, len(w), full, score))
    return out


@pytest.mark.parametrize("ids", [lambda k: k, lambda k: k and 2 * k])
def test_backoff_scores_by_all_other_documents(spark, ids):
    rows = [(ids(r[0]), r[1]) for r in ODD]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    want = sorted(plain_leave_one_out(rows), key=order)
    for block_bytes in (lm_score.BLOCK_BYTES, 20_000):
        got = sorted((tuple(r) for r in lm_score.score(docs, block_bytes=block_bytes, leave_one_out=True).collect()), key=order)
        assert [r[:3] for r in got] == [r[:3] for r in want]
        assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-6)
    assert sum(r[2] for r in got) > 0  # also where all ids share a parity
    assert lm_score.score(docs.limit(0), leave_one_out=True).count() == 0


# Mixing


def test_mix_meets_targets(spark, odd, no_docs):
    got = mixing.mix(odd).collect()
    sizes = {}
    for r in ODD:
        sizes[r[3]] = sizes.get(r[3], 0) + len(SPACED.findall(r[1] or ""))
    order = sorted(k for k in sizes if k is not None) + [None]
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    left, open_ = sum(sizes.values()), set(order)
    target = {}
    while True:
        share = {s: weight[s] * left / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 3 * sizes[s]
            left -= target[s]
            open_.discard(s)
    assert len(got) == len(ODD)
    assert sorted({r["target"] for r in got}) == pytest.approx(sorted(set(target.values())))
    for r in got:
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
    assert sorted(map(tuple, got), key=KEY) == rows(mixing.mix(odd.repartition(3)))
    assert mixing.mix(no_docs).count() == 0


def test_mix_words_come_near_targets(spark):
    got = mixing.mix(table(spark, "/root/testdata/sf0.01", "documents"))
    per = got.groupBy("source_size", "target").agg({"taken": "sum", "size": "max"}).collect()
    for r in per:
        assert abs(r["sum(taken)"] - r["target"]) <= r["max(size)"] / 2 + 1


def test_mixed_documents_replaces_clashing_columns(odd):
    got = mixing.mixed_documents(odd)
    assert sorted(got.columns) == sorted([*odd.columns, "copies"])
    assert got.where("copies < 1 or copies > 3").count() == 0


# Repeated byte strings


def plain_repeats(docs, length=100):
    seen, out = {}, []
    for doc, text in sorted(docs, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        for k in range(len(data) - length + 1):
            start = (doc is None, doc or 0, k)
            seen[data[k : k + length]] = min(seen.get(data[k : k + length], start), start)
    for doc, text in docs:
        data = (text or "").encode()
        cover = np.zeros(len(data) + 1, int)
        for k in range(len(data) - length + 1):
            if seen[data[k : k + length]] < (doc is None, doc or 0, k):
                cover[k] += 1
                cover[k + length] -= 1
        gone = np.cumsum(cover[:-1]) > 0
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if len(data) else 0
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((doc, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=KEY)


@pytest.mark.parametrize("block_bytes, hot", [(suffix_dedup.BLOCK_BYTES, suffix_dedup.HOT), (3000, 50_000), (3000, 1)])
def test_repeats(odd, block_bytes, hot):
    got = rows(suffix_dedup.removed(odd, block_bytes=block_bytes, hot=hot))
    assert got == plain_repeats([(r[0], r[1]) for r in ODD])
    assert sum(r[2] > 0 for r in got) >= 4


def test_repeats_of_a_table_and_short_strings(spark):
    docs = [(r["doc_id"], r["text"]) for r in whole_table("documents")]
    assert rows(suffix_dedup.removed(table(spark, SMALL, "documents"), block_bytes=50_000)) == plain_repeats(docs)
    few = spark.createDataFrame([(1, "abcabcabcabc"), (2, "cabcab"), (3, "aaaaaaaaaaaa"), (4, "bcabéééé")], "doc_id long, text string")
    assert rows(suffix_dedup.removed(few, length=6, leader=3)) == plain_repeats([tuple(r) for r in few.collect()], 6)


def test_a_block_works_in_small_steps():
    text = [prose(k, 2000) for k in range(60)]
    rows = pa.table({"_id": pa.array(range(len(text)), pa.int64()), "_digest": pa.array(range(len(text)), pa.int64()), "text": text})
    size = sum(map(len, text))
    tracemalloc.start()
    try:
        block = suffix_dedup.Block(rows, 100, 50)
        assert tracemalloc.get_traced_memory()[1] < 60 * size
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        which = np.arange(len(block.place))
        left, right = block.context(which)
        assert tracemalloc.get_traced_memory()[1] - before < left.nbytes + right.nbytes + (10 << 20)
    finally:
        tracemalloc.stop()
    for k in (0, 1, 4095, 4096, 4097, len(which) - 1):
        place, (a, b) = block.place[k], block.at[block.doc[k] : block.doc[k] + 2]
        whole = block.data[max(a, place - 50) : place][::-1], block.data[place + 50 : min(b, place + 100)]
        for got, want in zip((left[k], right[k]), whole):
            assert got.tolist() == want.tolist() + [suffix_dedup.PAD] * (50 - len(want))


def test_hashes_of_short_texts_need_short_tables():
    hasher, data = common.Hasher(), np.frombuffer(LONG.encode(), np.uint8)
    hasher.prefix(data[:100])
    assert len(hasher.up) < 1000
    starts, ends = np.array([0, 7, 5000]), np.array([len(data), 90, 70_000])
    grown = hasher.ranges(hasher.prefix(data), starts, ends)
    for k, (a, b) in enumerate(zip(starts, ends)):
        alone = common.Hasher()
        assert alone.ranges(alone.prefix(data[a:b]), np.array([0]), np.array([b - a]))[0] == grown[k]


def test_without_repeats_keeps_columns(odd, no_docs):
    got = suffix_dedup.without_repeats(odd)
    assert got.columns == odd.columns
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert 2 not in by_id and by_id[4]["text"] is None and by_id[5]["text"] == ""
    assert by_id[13]["n_chars"] == len(by_id[13]["text"]) and by_id[13]["text"].startswith("") and by_id[1]["text"] == ODD[0][1]
    assert suffix_dedup.without_repeats(no_docs).count() == 0
    assert suffix_dedup.removed(no_docs).count() == 0


# Jaccard join


def plain_groups(docs, n, percent):
    sets = []
    for _, text in docs:
        w = SPACED.findall((text or "").translate(LOWER))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    group = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]) and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
    out = []
    for k, (doc, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if group[j] == group[k] and docs[j][0] is not None]
        out.append((doc, len(sets[k]), min(ids, default=None)))
    return sorted(out, key=KEY)


@pytest.mark.parametrize("n, percent, tile_rows", [(3, 90, jaccard_join.TILE_ROWS), (5, 80, 2)])
def test_jaccard_groups(odd, n, percent, tile_rows):
    got = jaccard_join.grouped(odd, words=n, percent=percent, tile_rows=tile_rows).select("doc_id", "n_shingles", "component_id")
    assert rows(got) == plain_groups([(r[0], r[1]) for r in ODD], n, percent)


def test_jaccard_groups_of_many_near_copies(spark):
    base = ODD[0][1].split()
    docs = [(100 + k, " ".join([*base[:k], f"new{k}", *base[k + 1 :]])) for k in range(40)]
    docs += [(k, " ".join(base[: 300 - 12 * k])) for k in range(1, 12)]  # a chain: neighbours link, ends do not
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for tile_rows in (jaccard_join.TILE_ROWS, 7):
        got = jaccard_join.grouped(df, tile_rows=tile_rows).select("doc_id", "n_shingles", "component_id")
        assert rows(got) == plain_groups(docs, 3, 90)


@pytest.mark.parametrize("chunk_rows, most", [(jaccard_join.CHUNK_ROWS, 20), (7, 60)])
def test_components_in_few_jobs(spark, chunk_rows, most):
    chain = np.random.default_rng(5).permutation(400)  # paths of 100 nodes, then stars that share no node with them
    pairs = [(int(chain[k]), int(chain[k + 1])) for k in range(399) if k % 100 != 99]
    pairs += [(1000 + k, 1000 + 50 * (k // 50)) for k in range(200)] + pairs[:30] + [(b, a) for a, b in pairs[:30]] + [(-5, -9), (-9, -9)]
    want = {}
    for k in range(4):
        part = chain[100 * k : 100 * k + 100].tolist()
        want |= dict.fromkeys(part, min(part))
    want |= {1000 + k: 1000 + 50 * (k // 50) for k in range(200)} | {-5: -9, -9: -9}
    edges = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    context, group = spark.sparkContext, f"components-{chunk_rows}"
    context.setJobGroup(group, group)
    try:
        got = rows(jaccard_join.components(edges, chunk_rows))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert got == sorted(want.items(), key=KEY)
    assert 0 < len(context.statusTracker().getJobIdsForGroup(group)) <= most  # the driver keeps plans and figures of each
    assert jaccard_join.components(edges.limit(0), chunk_rows).count() == 0


def test_jaccard_one_of_each(odd, no_docs):
    got = jaccard_join.one_of_each(odd)
    assert got.columns == odd.columns
    ids = [r["doc_id"] for r in got.collect()]
    assert ids.count(15) == 1 and 1 in ids and 2 not in ids and 3 not in ids and 7 in ids and 8 not in ids
    assert {4, 5, 6} <= set(ids) and ids.count(None) == 2
    assert jaccard_join.one_of_each(no_docs).count() == 0
    assert jaccard_join.grouped(no_docs).count() == 0


def test_jaccard_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in whole_table("documents")]
    got = jaccard_join.grouped(table(spark, SMALL, "documents")).select("doc_id", "n_shingles", "component_id")
    assert rows(got) == plain_groups(docs, 3, 90)


# Quality rules


def plain_counts(text):
    w = SPACED.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    grams, hit = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)), set()
    for k in range(len(w) - 4):
        if grams[tuple(w[k : k + 5])] > 1:
            hit.update(range(k, k + 5))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit)


def test_quality_counts_and_base_rule(odd, no_docs):
    got = quality_rules.outliers(quality_rules.text_counts(odd)).collect()
    want = sorted(((r[0], *plain_counts(r[1])) for r in ODD), key=KEY)
    assert sorted(((r["doc_id"], *(r[c] for c in quality_rules.COUNTS)) for r in got), key=KEY) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules.outliers(quality_rules.text_counts(no_docs)).count() == 0


def test_robust_estimate_withstands_a_quarter_of_junk(spark):
    rng = np.random.default_rng(4)
    clean = [(k, int(n), int(5 * n + rng.integers(0, n)), int(rng.integers(0, 2)), 0, 0) for k, n in enumerate(rng.integers(80, 900, 600))]
    junk = [(1000 + k, 300, 3000, 1200, 0, 0) for k in range(150)]
    rows_ = [(i, "en", "a", *rest) for i, *rest in clean + junk]
    df = spark.createDataFrame(rows_, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in quality_rules.COUNTS))
    kept = {r["doc_id"] for r in quality_rules.outliers(df).where("kept").collect()}
    assert not any(k >= 1000 for k in kept) and len(kept) >= 595


def plain_outliers(table, share=0.75, steps=6, prior=20, tail=1e-5):
    """Distances and verdicts by (language, source) from arrays: the same starts and concentration steps without Spark."""
    names = list(quality_rules.FEATURES)
    floors = np.array([quality_rules.FEATURES[c][1] for c in names])
    p = len(names)

    def vector(r):
        words, chars, symbols, lines, repeats = (r[c] for c in quality_rules.COUNTS)
        return [np.log(1 + words), np.log(chars / words), np.sqrt(symbols / chars), np.log(1 + lines), np.sqrt(repeats / words)]

    def failed(r):
        return r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]

    def floored(scatter):
        scatter = scatter.copy()
        scatter[np.diag_indices(p)] = np.maximum(np.diag(scatter), floors**2)
        values, axes = np.linalg.eigh(scatter / np.outer(floors, floors))
        return axes @ np.diag(np.maximum(values, quality_rules.LEAST)) @ axes.T * np.outer(floors, floors)

    def distances(x, mean, scatter):
        return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(scatter), x - mean)

    def determinant(x):
        middle = lambda v: np.sort(v)[-(-len(v) // 2) - 1]
        cells = np.floor(x * 64) / 64 + 1 / 128
        center = np.array([middle(c) for c in cells.T])
        spread = np.array([1.4826 * middle(np.abs(c - m)) for c, m in zip(cells.T, center)])
        found = []
        for mean, scatter in ((center, floored(np.diag(spread**2))), (x.mean(0), floored(np.cov(x.T, bias=True).reshape(p, p)))):
            for _ in range(steps):
                cell = np.floor(np.log(distances(x, mean, scatter) + 1e-6) * quality_rules.CLASSES)
                last = np.sort(cell)[int(np.ceil(share * len(x))) - 1]
                near = x[cell <= last]
                mean, scatter = near.mean(0), floored(np.cov(near.T, bias=True).reshape(p, p))
            found.append((np.linalg.slogdet(scatter)[1], mean, scatter))
        return min(found, key=lambda f: f[0])[1:]

    fit = [r for r in table if not failed(r)]
    common = determinant(np.array([vector(r) for r in fit]))
    scale = quality_rules.chi2_cdf(quality_rules.chi2_quantile(share, p), p + 2) / share
    cut = quality_rules.chi2_quantile(1 - tail, p)
    groups, found = {}, {}
    for r in table:
        groups.setdefault((r["lang"], r["source"]), []).append(r)
    for members in groups.values():
        own = np.array([vector(r) for r in members if not failed(r)]).reshape(-1, p)
        mean, scatter = common
        if len(own):
            w = len(own) / (len(own) + prior)
            mean, scatter = (w * a + (1 - w) * b for a, b in zip(determinant(own), common))
        for r in members:
            d = float(distances(np.array([vector(r)]), mean, scatter)[0] * scale) if r["n_words"] else None
            found[r["doc_id"]] = (d, not failed(r) and (d or 0.0) <= cut)
    return found


def counted_groups(sizes):
    """Rows of counts in groups of their own means, a tenth of each far off."""
    out, rng = [], np.random.default_rng(11)
    for g, size in enumerate(sizes):
        for k in range(size):
            n = int(rng.integers(60 + 40 * g, 500 + 90 * g))
            chars, symbols = int(n * (4 + g % 3) + rng.integers(0, n)), int(rng.integers(0, 3))
            if k % 10 == 9:
                symbols = int(chars * rng.uniform(0.1, 0.5))
            out.append((len(out), ("en", "de", None)[g % 3], f"s{g}" if g else None, n, chars, symbols, int(rng.integers(0, 4)), int(rng.integers(0, n // 10))))
    out += [(len(out), "en", "lone", 0, 0, 0, 0, 0), (len(out) + 1, "de", "short", 4, 20, 0, 0, 0)]
    return out


@pytest.mark.parametrize("sizes", [(900, 300, 120, 49, 50, 51, 12, 3, 1), (7, 5, 2, 1)])
def test_verdicts_equal_a_plain_estimate(spark, sizes):
    """Groups of all sizes, above and below the weight of the common estimate."""
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in quality_rules.COUNTS)
    df = spark.createDataFrame(counted_groups(sizes), schema)
    want = plain_outliers([r.asDict() for r in df.collect()])
    got = {r["doc_id"]: (r["distance"], r["kept"]) for r in quality_rules.outliers(df).collect()}
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}
    for k, (d, _) in want.items():
        assert (d is None) == (got[k][0] is None) and (d is None or got[k][0] == pytest.approx(d, rel=1e-3, abs=1e-6)), k
    if len(sizes) > 4:
        assert not all(v[1] for k, v in want.items() if k % 10 == 9) and sum(v[1] for v in want.values()) > 0.8 * sum(sizes)


def test_verdicts_of_given_tables_equal_a_plain_estimate(spark):
    counts = quality_rules.text_counts(table(spark, TABLES, "documents"))
    want = plain_outliers([r.asDict() for r in counts.collect()])
    got = {r["doc_id"]: r["kept"] for r in quality_rules.outliers(counts).collect()}
    assert got == {k: v[1] for k, v in want.items()}
    more = {r["doc_id"]: r["kept"] for r in quality_rules.outliers(counts, steps=12).collect()}
    assert sum(got[k] != more[k] for k in got) <= 0.002 * len(got)  # the steps have settled


def test_chi2():
    assert quality_rules.chi2_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert quality_rules.chi2_cdf(6.6257, 5) == pytest.approx(0.75, abs=1e-4)
