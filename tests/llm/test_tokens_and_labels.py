"""Token counts through edits, the classifier, the pipeline."""

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from matchloom.llm import token_edits, weak_labels
from matchloom.llm.common import table

from .conftest import ODD, SMALL, TABLES, WORDS, prose


@pytest.fixture(scope="module")
def ranks():
    return token_edits.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def counter(ranks):
    return token_edits.Counter(ranks, public_tokenizers.PATTERN)


@pytest.mark.parametrize("leaf", [1, 3, 32])
def test_edits_give_the_count_of_the_edited_text(counter, monkeypatch, leaf):
    monkeypatch.setattr(token_edits, "LEAF", leaf)
    pick = random.Random(leaf)
    letters = "ab  '\n\tséll.d1 2!?ñ　rve 中"
    for _ in range(300):
        text = "".join(pick.choice(letters) for _ in range(pick.choice([0, 1, 5, 30, 200])))
        tree = token_edits.Tree(text, counter)
        for _ in range(pick.randint(1, 10)):
            place, gone, new = pick.randint(0, len(text) + 1), pick.choice([0, 1, 2, 5, 40]), "".join(pick.choice(letters) for _ in range(pick.choice([0, 1, 3, 12])))
            tree.edit(place, gone, new)
            place = min(place, len(text))
            text = text[:place] + new + text[place + gone :]
            assert tree.text() == text and tree.size() == len(text)
            assert [p for x in tree.leaves for p in x] == counter.pattern.findall(text)
            assert tree.total() == len(counter.encoding.encode_ordinary(text))


def test_an_edit_encodes_only_what_it_touches(counter):
    tree = token_edits.Tree(prose(5, 20_000), counter)
    tree.edit(60_000, 3, "new words")
    assert tree.encoded < 12


def test_token_counts(odd, no_docs, ranks, counter):
    edited = token_edits.with_trial_edits(odd.select("doc_id", "text"), every=100)
    got = token_edits.counts_after_edits(edited, ranks, public_tokenizers.PATTERN).collect()
    want = []
    for r in edited.collect():
        text = r["text"] or ""
        before = (len(counter.pattern.findall(text)), len(counter.encoding.encode_ordinary(text)))
        for e in r["edits"]:
            place = min(e["place"], len(text))
            text = text[:place] + e["add"] + text[place + e["remove"] :]
        want.append((r["doc_id"], *before, len(r["edits"]), len(text), len(counter.encoding.encode_ordinary(text))))
    have = [tuple(r[c] for c in ("doc_id", "n_pretokens", "n_tokens", "n_edits", "n_chars_edited", "n_tokens_edited")) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str) and len(have) == len(ODD)
    empty = token_edits.with_trial_edits(no_docs.select("doc_id", "text"))
    assert token_edits.counts_after_edits(empty, ranks, public_tokenizers.PATTERN).count() == 0
    none = odd.select("doc_id", "text").withColumn("edits", F.lit(None).cast("array<struct<place:long,remove:long,add:string>>"))
    assert token_edits.counts_after_edits(none, ranks, public_tokenizers.PATTERN).where("n_tokens <> n_tokens_edited or n_reencoded > 0").count() == 0


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.15
    hit, alarm = np.array([0.9, 0.6, 0.7, 0.95]), np.array([0.01, 0.02, 0.05, 0.03])
    votes = (rng.random((20_000, 4)) < np.where(truth[:, None], hit, alarm)).astype(np.int8)
    votes[rng.random(20_000) < 0.6, 3] = -1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    chance, rate = weak_labels.expectation_maximisation(patterns, counts.astype(float))
    assert rate[1] == pytest.approx(hit, abs=0.05) and rate[0] == pytest.approx(alarm, abs=0.02)
    own = {tuple(p): c for p, c in zip(patterns, chance)}
    assert np.mean([(own[tuple(v)] > 0.5) == t for v, t in zip(votes, truth)]) > 0.97


def test_classifier_on_labels_it_does_not_see(spark):
    docs = table(spark, TABLES, "documents")
    labels = table(spark, TABLES, "labels")
    seen, held_out = labels.where("pmod(xxhash64(doc_id), 4) > 0"), labels.where("pmod(xxhash64(doc_id), 4) = 0")
    got = weak_labels.judge(docs, seen)
    assert got.count() == docs.count()
    judged = got.join(held_out, "doc_id").collect()
    clean = [r["kept"] for r in judged if r["quality"] == 1 and r["toxic"] == 0]
    poor = [r["kept"] for r in judged if r["quality"] == 0]
    assert np.mean(clean) > 0.95 and np.mean(poor) < 0.2
    insulted = docs.where("text rlike '(?i)\\\\b(idiot|moron|scum|loser|trash)\\\\b'").select("doc_id")
    assert got.join(insulted, "doc_id").where("kept").count() <= 0.1 * insulted.count()


def test_repeated_rows_train_as_one_row_of_their_number(spark, monkeypatch):
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, 12)).astype(np.uint64) for _ in range(80)]
    goal, times = np.array([0.9 if 7 in s else 0.1 for s in sets]), rng.integers(1, 6, 80)

    def fit(which, counts):
        text = np.repeat(np.arange(len(which)), [len(sets[k]) for k in which])
        return weak_labels.fit_scorer(text, np.concatenate([sets[k] for k in which]), goal[which], counts)

    once, repeated = fit(np.arange(80), times), fit(np.repeat(np.arange(80), times), np.ones(times.sum(), dtype=np.int64))
    assert len(once[0]) and once[0].tolist() == repeated[0].tolist()
    assert once[1] == pytest.approx(repeated[1], abs=1e-6) and once[2] == pytest.approx(repeated[2], abs=1e-6)

    # all copies are picked, and one row stands for them
    rows = [(None, "the same text of all rows") for _ in range(3000)] + [(k, f"text number {k}") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    kind, sizes = type(docs), []
    monkeypatch.setattr(kind, "repartition", lambda self, n, f=kind.repartition: (sizes.append(self.count()), f(self, n))[1])
    assert weak_labels.judge(docs, labels).count() == len(rows) and sizes == [21]


def test_classifier_holds_one_worker_a_task_and_each_row_once(spark, monkeypatch):
    docs = spark.createDataFrame([(k, prose(k, 20), "en") for k in range(30)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    kind, plans, columns = type(docs), [], []
    monkeypatch.setattr(kind, "repartition", lambda self, n, f=kind.repartition: (plans.append(self._jdf.queryExecution().executedPlan().toString()), f(self, n))[1])
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a, f=kind.mapInArrow: (columns.append(self.dtypes), f(self, *a))[1])
    got = weak_labels.kept_documents(docs, labels)
    assert [p.count("MapInArrow") for p in plans] == [1]
    assert columns[-1] == docs.dtypes and got.schema == docs.schema
    assert sorted(got.collect()) == sorted(docs.collect())


def test_classifier_on_odd_rows(spark, odd, no_docs):
    def plain(seed, n):  # words of letters only
        return " ".join(w.rstrip("0123456789") + WORDS[int("".join(filter(str.isdigit, w))) % 20] for w in prose(seed, n).split())

    def spoiled(k):
        return plain(k, 25) + " " + " ".join((weak_labels.INSULTS * 2)[k % 10 : k % 10 + 3]) + " " + plain(k + 50, 25)

    insults = [(200 + k, spoiled(k), "en", "a", 1, 1, "", "", 1, True, "") for k in range(40)]
    clean = [(300 + k, plain(900 + k, 60), "en", "b", 1, 1, "", "", 1, True, "") for k in range(150)]
    docs = odd.unionByName(spark.createDataFrame(insults + clean, odd.schema))
    labels = spark.createDataFrame([(200, 1, 1), (200, 0, None), (300, 1, 0), (301, None, 0), (None, 1, 1), (999, 1, 1)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        got = weak_labels.kept_documents(docs, known)
        assert got.columns == docs.columns
        ids = [r["doc_id"] for r in got.collect()]
        assert sum((i or 0) >= 300 for i in ids) >= 148
        # one labeller alone, without any label: its accuracy cannot be told
        assert sum(200 <= (i or 0) < 300 for i in ids) <= (2 if known is labels else 40)
        assert 4 in ids and 5 in ids
    assert weak_labels.judge(no_docs, labels).count() == 0


def test_pipeline(spark):
    steps = []
    docs = table(spark, SMALL, "documents")
    before = {r["doc_id"]: r for r in docs.collect()}
    ids = set(before)
    for name, stage in corpus_pipeline.STAGES:
        from matchloom.llm.common import store

        out = store(stage(spark, docs, SMALL), "test-stage")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        now = {r["doc_id"] for r in out.collect()}
        assert now <= ids
        steps.append((name, len(now)))
        ids, docs = now, out
    assert len(steps) == 5 and steps[-1][1] > 50
    assert {"size", "copies"} <= set(docs.columns)
    rows = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(str, rows.collect())) == sorted(map(str, docs.collect()))


def test_every_query_is_registered():
    names = __spark_entry__.queries()
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert names["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", ["op2_warc_archives", "op3_decontaminate", "op4_backoff_scores", "op5_mix_sources", "op12_conversation_trie", "op13_url_filter"])
def test_sql_says_the_same(spark, name):
    import glob
    import os

    import duckdb

    got = __spark_entry__.queries()[name](spark, SMALL)
    db = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        db.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    columns = sorted(got.columns)
    want = db.sql(f"SELECT {', '.join(columns)} FROM ({__spark_entry__.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.select(*columns).collect()))) == sorted(map(str, want)) and want


def test_queries_cover_their_tables(spark):
    n_docs, n_pages = table(spark, SMALL, "documents").count(), table(spark, SMALL, "pages").count()
    for name, query in __spark_entry__.queries().items():
        if name in ("op1_token_counts", "op6_main_text", "op10_quality_rules"):
            assert query(spark, SMALL).count() == (n_pages if name.startswith("op6_") else n_docs)


def test_long_texts_are_read_in_pieces_alike():
    """Features of a text cut between words equal those of the whole, whatever the size of a piece."""
    text = ("One two IDIOT, | three a1b2 éü  four five six\n" * 40 + "#$% CAPS caps repeated words here repeated words here " * 30).encode()
    data, at = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    want = weak_labels.Features(limit=1 << 30).read(data, at)
    for limit in (50, 333, 2000):
        got = weak_labels.Features(limit=limit).read(data, at)
        assert np.array_equal(got[3], want[3])
        for k in (0, 1, 2):
            assert np.array_equal(np.unique(got[1][got[2] == k]), np.unique(want[1][want[2] == k]))


def test_a_very_long_text_is_judged(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "calm words of a garden " * 2_800_000), (2, "idiot")], "doc_id long, text string")  # 64 MB
    got = {r["doc_id"]: r["kept"] for r in weak_labels.judge(docs, labels).collect()}
    assert set(got) == {1, 2}
