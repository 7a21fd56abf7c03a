"""Training, scoring, game states and the stream over them."""

import json
import threading

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.serializers import CloudPickleSerializer
from pyspark.sql import functions as F

from matchloom.operators import features, jobs, metrics, models, nets, scoring, splits
from matchloom.plans.queries_features import game_states, kept_and_params
from matchloom.schemas import FLAGS, HEROES, OBJECTIVES, TRAIN_LOG
from matchloom.sources.tables import write_stage
from matchloom.streaming import states as state_stream


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """600 rows whose label follows x, with some noise."""
    rows = spark.range(600).select(
        F.col("id").alias("match_id"),
        F.lit(0).alias("time_s"),
        ((F.col("id") * 37 % 101) / 50.0 - 1).alias("x"),
        ((F.col("id") * 53 % 89) / 44.0 - 1).alias("z"),
    )
    noisy = rows.withColumn(
        "winning_team", F.when(F.col("match_id") % 11 == 0, F.col("x") < 0.3).otherwise(F.col("x") > 0.3).cast("int")
    )
    table = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(noisy)
    return write_stage(table.drop("x", "z"), str(tmp_path_factory.mktemp("planted") / "t"))


def test_models_beat_the_majority(spark, planted):
    fits = {
        "Logistic Regression": lambda t, s: models.fit_logreg(t),
        "Random Forest": lambda t, s: models.fit_forest(t, s, trees=10, depth=5),
        "Network": lambda t, s: models.fit_mlp(t, hidden=1, width=4, seed=s, max_iter=60),
    }
    runs = models.compare(planted, fits, runs=1)
    value = {(r["model"], r["metric"]): r["value"] for r in runs.collect()}
    floor = value["Dummy (Most Frequent)", "accuracy"]
    for name in fits:
        assert value[name, "accuracy"] > floor + 0.05
        assert value[name, "roc_auc"] > 0.8
    assert value["Dummy (Random)", "roc_auc"] == 0.5


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    assert {r["y"]: r["weight"] for r in splits.with_class_weight(df, "y").collect()} == {0: 4 / 6, 1: 2.0}


def test_many_classes(spark):
    """More classes than a map would hold: shares are kept, weights are attached, NULL labels stay."""
    df = spark.range(4004).select("id", F.when(F.col("id") < 4000, F.col("id") % 1001).alias("y"))
    placed = splits.split_stratified(df, "y", 0.25, 7, ["id"])
    assert placed.columns == ["id", "y", "part"] and placed.count() == 4004
    assert placed.where("part = 'train'").count() == 3000
    weighted = splits.with_class_weight(df, "y")
    assert weighted.count() == 4004 and weighted.where("y is not null and abs(weight - 4000 / (1001 * if(y < 997, 4, 3))) < 1e-9").count() == 4000


def test_early_stop_keeps_all_epochs(spark):
    rows = [(1, e, 500.0 - e) for e in range(1, 251)]
    df = spark.createDataFrame(rows, "run int, epoch int, loss double")
    got = models.early_stop(df, ["run"], "epoch", "loss", patience=300).first()
    assert (got["stop_epoch"], got["best_epoch"]) == (None, 250) and got["best_loss"] <= 500.0 - 250 + 3
    with pytest.raises(Exception, match="more than 100 epochs"):
        models.early_stop(df, ["run"], "epoch", "loss", most_epochs=100).collect()


def test_early_stop_fold_equals_the_loop(spark):
    losses = {
        1: [1.0, 0.995, 0.98, 0.98, 0.98, 0.98, 0.98, 0.98],
        2: [1.0, 0.9, 0.8],
        3: [1.0] * 9,
        4: [3.0, 2.0, 2.5, 2.5, 1.9, 1.9, 1.9, 1.9, 1.9, 1.9, 0.1],
    }
    rows = [(run, e, loss) for run, ls in losses.items() for e, loss in enumerate(ls, start=1)]
    folded = models.early_stop(spark.createDataFrame(rows, "run int, epoch int, loss double"), ["run"], "epoch", "loss")
    got = {r["run"]: (r["stop_epoch"], r["best_epoch"], r["best_loss"]) for r in folded.collect()}
    assert got == {1: (8, 3, 0.98), 2: (None, 3, 0.8), 3: (6, 1, 1.0), 4: (10, 5, 1.9)}
    for run, series in losses.items():
        rule, stop = models.EarlyStop(), None
        for epoch, loss in enumerate(series, start=1):
            rule.improved(loss)
            if rule.stopped:
                stop = epoch
                break
        assert (stop, rule.best) == (got[run][0], got[run][2])


def test_rounds_continue_from_the_last_weights(spark, planted, tmp_path):
    placed = splits.split_exact(planted, 0.2, 0.0, 1, models.KEY)
    train, val = (placed.where(F.col("part") == p) for p in ("train", "val"))
    model, log = models.train_rounds(train, val, hidden=1, width=3, epochs=4, k=5)
    assert [r["epoch"] for r in log] == [1, 2, 3, 4][: len(log)]
    assert log[-1]["train_loss"] < log[0]["train_loss"]
    models.write_train_log(spark, log, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == len(log)
    best = models.loss_and_accuracy(model, val)[0]
    assert best == pytest.approx(min(r["val_loss"] for r in log), rel=0.02)


def test_rounds_go_on_after_the_last_stored_one(spark, planted, tmp_path, monkeypatch):
    placed = splits.split_exact(planted, 0.2, 0.0, 1, models.KEY)
    train, val = (placed.where(F.col("part") == p).drop("part") for p in ("train", "val"))
    how = {"hidden": 1, "width": 3, "k": 2, "patience": 2, "min_gain": 0.0}
    whole_model, whole = models.train_rounds(train, val, epochs=4, path=str(tmp_path / "whole"), **how)
    models.train_rounds(train, val, epochs=2, path=str(tmp_path / "cut"), **how)
    judged, real = [], models.losses_and_accuracies

    def counted(*args, **more):
        judged.append(1)
        return real(*args, **more)

    monkeypatch.setattr(models, "losses_and_accuracies", counted)
    model, log = models.train_rounds(train, val, epochs=4, path=str(tmp_path / "cut"), **how)
    assert len(judged) == 2  # rounds 3 and 4, one evaluation each
    assert [r["epoch"] for r in log] == [r["epoch"] for r in whole]
    for a, b in zip(log, whole):
        assert all(a[c] == pytest.approx(b[c], rel=1e-6) for c in ("train_loss", "train_acc", "val_loss", "val_acc"))
    assert np.allclose(model.weights.toArray(), whole_model.weights.toArray(), rtol=1e-5)
    again, same = models.train_rounds(train, val, epochs=2, path=str(tmp_path / "cut"), **how)
    assert len(judged) == 2 and [r["epoch"] for r in same] == [1, 2]  # all found, nothing trained
    assert models.loss_and_accuracy(again, val)[0] == pytest.approx(min(r["val_loss"] for r in same), rel=1e-6)


def test_parts_are_judged_in_one_pass(spark, planted):
    placed = splits.split_exact(planted, 0.2, 0.0, 1, models.KEY)
    model = models.fit_logreg(planted, max_iter=3)
    found = models.losses_and_accuracies(model, placed)
    for part in ("train", "val"):
        assert found[part] == pytest.approx(models.loss_and_accuracy(model, placed.where(F.col("part") == part)))
    assert models.loss_and_accuracy(model, placed.where("false")) == (None, None)


# networks by mini-batches, concurrent jobs


def test_gradient_equals_differences():
    draw = np.random.default_rng(1)
    state = nets.start(5, 2, 4, seed=3)
    weights = [w.astype(np.float64) for w in state.weights]
    x, y = draw.normal(size=(7, 5)), draw.integers(0, 2, 7).astype(float)
    _, slopes = nets.gradient(weights, x, y)
    for w, g in zip(weights, slopes):
        for place in np.ndindex(w.shape):
            ends = []
            for move in (1e-6, -2e-6):
                w[place] += move
                ends.append(nets.row_losses(nets.logits(weights, x), y).mean())
            w[place] += 1e-6
            assert g[place] == pytest.approx((ends[0] - ends[1]) / 2e-6, abs=1e-5)


def test_steps_follow_the_published_rule():
    state = nets.start(3, 1, 2, seed=1)
    w, m, v = [a.astype(np.float64) for a in state.weights], [0.0] * 4, [0.0] * 4
    for t in range(1, 4):
        slopes = [np.full_like(a, 0.1 * t) for a in state.weights]
        for k, g in enumerate(slopes):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] = w[k] - 0.01 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        nets.step(state, [g.astype(np.float32) for g in slopes], 0.01)
    for a, b in zip(state.weights, w):
        assert np.allclose(a, b, atol=1e-5)
    assert [a.shape for a in nets.start(448, 6, 400, 1).weights][::2] == [(448, 400), *[(400, 400)] * 5, (400, 1)]
    with pytest.raises(ValueError):
        nets.start(448, 0, 400, 1)


@pytest.fixture(scope="module")
def two_parts(planted):
    placed = splits.split_exact(planted, 0.2, 0.0, 1, models.KEY)
    return {p: placed.where(F.col("part") == p).drop("part") for p in ("train", "val")}


def test_one_task_and_a_job_an_epoch_agree(spark, two_parts):
    """The path of many shards, run on one shard, gives what one task gives."""
    table = nets.new_shards(spark, two_parts, models.KEY, models.LABEL, 1)
    like = nets.start(2, 1, 3, seed=1)
    found = []
    for way in (nets._in_one_task, nets._by_epochs):
        found.append(way(table, like, 0.05, 4, 1, nets.Stopper(2, 0.01), 32))
    (log, weights, loss), (other_log, other_weights, other_loss) = found
    assert np.allclose(log, other_log, rtol=1e-5) and loss == pytest.approx(other_loss, rel=1e-5)
    assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(weights, other_weights))


def test_many_shards_learn(spark, two_parts):
    table = nets.new_shards(spark, two_parts, models.KEY, models.LABEL, 1, shard_rows=40)
    sizes = {p: [r["n"] for r in table.where(F.col("part") == p).collect()] for p in ("train", "val")}
    assert {p: sum(n) for p, n in sizes.items()} == {p: df.count() for p, df in two_parts.items()}
    assert min(map(len, sizes.values())) > 1
    weights, log, loss = nets.fit(table, hidden=1, width=4, rate=0.05, epochs=12, seed=1)
    assert [r[0] for r in log] == list(range(1, len(log) + 1)) and log[-1][1] < log[0][1] and loss < 0.69
    scores = nets.scored(two_parts["val"], weights)
    assert set(scores.columns) == (set(two_parts["val"].columns) | {"score"}) - {"features"}
    measured = scores.agg(F.avg(metrics.bce(F.col("score"), F.col(models.LABEL)))).first()[0]
    assert measured == pytest.approx(min(r[3] for r in log), rel=0.02)


def test_the_log_of_many_shards_is_stored(spark, two_parts, tmp_path):
    """Sums of many shards come as plain numbers, which a table takes; of the networks only the last and the best stay."""
    table = nets.new_shards(spark, two_parts, models.KEY, models.LABEL, 1, shard_rows=100)
    path = tmp_path / "epochs"
    weights, log, _ = nets.fit(table, hidden=1, width=4, rate=0.05, epochs=4, seed=1, path=str(path), keep=False)
    models.write_train_log(spark, [dict(zip(TRAIN_LOG.names, r)) for r in log], str(tmp_path / "log"))
    assert weights is None and [tuple(r) for r in spark.read.parquet(str(tmp_path / "log")).orderBy("epoch").collect()] == log
    assert 1 <= len([p for p in (tmp_path / "epochs-networks").iterdir() if not p.name.startswith(".")]) <= 2


def test_networks_are_drawn_in_the_tasks(spark, two_parts, monkeypatch):
    """What is sent with a task does not grow with the network, and no weights return that nobody asked for."""
    sent, real = [], CloudPickleSerializer.dumps
    monkeypatch.setattr(CloudPickleSerializer, "dumps", lambda self, x: sent.append(len(out := real(self, x))) or out)
    for shard_rows in (1000, 100):
        table = nets.new_shards(spark, two_parts, models.KEY, models.LABEL, 1, shard_rows=shard_rows)
        assert nets.fit(table, hidden=2, width=300, rate=0.01, epochs=1, seed=1, keep=False)[0] is None
    assert sent and max(sent) < 100_000
    drawn = nets.Untrained(2, 2, 300, 1)
    assert drawn.shapes() == [w.shape for w in drawn.begun().weights]
    assert all(np.array_equal(a, b) for a, b in zip(drawn.begun().weights, nets.start(2, 2, 300, 1).weights))


@pytest.mark.parametrize("patience", [50, 1])
def test_epochs_go_on_after_the_last_stored_one(spark, two_parts, tmp_path, monkeypatch, patience):
    """A run cut after two epochs and begun again gives what an unbroken one gives, also where it stops early."""
    table = nets.new_shards(spark, two_parts, models.KEY, models.LABEL, 1, shard_rows=100)
    how = {"hidden": 1, "width": 4, "rate": 0.05, "seed": 1, "patience": patience, "min_gain": 0.05}
    want_weights, want_log, want_loss = nets.fit(table, epochs=6, path=str(tmp_path / "whole"), **how)
    nets.fit(table, epochs=2, path=str(tmp_path / "cut"), **how)
    trained, real = [], nets._epoch_job

    def counted(table, like, shared, rate, seed, k, batch, train):
        trained.extend([k] if train else [])
        return real(table, like, shared, rate, seed, k, batch, train)

    monkeypatch.setattr(nets, "_epoch_job", counted)
    weights, log, loss = nets.fit(table, epochs=6, path=str(tmp_path / "cut"), **how)
    assert min(trained) == 3
    assert np.allclose(log, want_log, rtol=1e-4) and loss == pytest.approx(want_loss, rel=1e-4)
    assert all(np.allclose(a, b, atol=1e-4) for a, b in zip(weights, want_weights))
    trained.clear()
    nets.fit(table, epochs=6, path=str(tmp_path / "cut"), **how)
    assert all(k > len(jobs.finished(spark, str(tmp_path / "cut"), nets.EPOCH).collect()) for k in trained)


def test_grid_is_ranked_and_resumed(spark, two_parts, tmp_path):
    grid = models.parameter_grid(width=[3, 4], hidden=[1, 2], step=[0.05])
    path = str(tmp_path / "grid")
    first = models.grid_search(grid[:2], two_parts["train"], two_parts["val"], models.KEY, path, epochs=3).collect()
    assert [r["place"] for r in first] == [1, 2] and all(1 <= r["best_epoch"] <= 3 for r in first)
    both = models.grid_search(grid, two_parts["train"], two_parts["val"], models.KEY, path, epochs=3).collect()
    assert sorted((r["width"], r["hidden"]) for r in both) == [(3, 1), (3, 2), (4, 1), (4, 2)]
    assert [r["validation_loss"] for r in both] == sorted(r["validation_loss"] for r in both)
    took = {(r["width"], r["hidden"]): r["seconds"] for r in both}
    assert all(took[r["width"], r["hidden"]] == r["seconds"] for r in first)  # not trained again
    assert len(models.parameter_grid(**models.FULL_GRID)) == 180


def test_comparison_is_resumed(spark, planted, tmp_path):
    table = write_stage(planted, str(tmp_path / "rows"))
    asked = []

    def fit(train, seed):
        asked.append(seed)
        return lambda test: models.with_probability(models.fit_logreg(train, max_iter=3).transform(test))

    path = str(tmp_path / "runs")
    models.compare(table, {"Logistic Regression": fit}, path, runs=1, seed=7)
    rows = models.compare(table, {"Logistic Regression": fit}, path, runs=3, seed=7).collect()
    assert sorted(asked) == [7, 8, 9]
    assert len(rows) == 3 * 3 * 4 and {r["run"] for r in rows} == {0, 1, 2}
    for run in range(3):  # the split of each run is that of the single split
        want = splits.majority_dummy(*models.stratified_parts(planted, 0.15, 7 + run), models.LABEL)
        share = want.agg(F.avg((F.col("prediction") == F.col(models.LABEL)).cast("double"))).first()[0]
        got = next(r["value"] for r in rows if (r["run"], r["model"], r["metric"]) == (run, models.DUMMIES[0], "accuracy"))
        assert got == pytest.approx(share)


def test_finished_pieces_are_not_done_again(spark, tmp_path):
    path, done = str(tmp_path / "pieces"), []

    def piece(n, broken=False):
        def work():
            if broken:
                raise RuntimeError("lost")
            done.append(n)
            return [(n, spark.range(n).count())]

        return work

    with pytest.raises(RuntimeError, match="lost"):
        jobs.run_jobs(spark, path, "k long, rows long", ["k"], {(1,): piece(1), (2,): piece(2, broken=True)}, threads=1)
    rows = jobs.run_jobs(spark, path, "k long, rows long", ["k"], {(n,): piece(n) for n in (1, 2, 3)}, threads=3)
    assert sorted(map(tuple, rows.collect())) == [(1, 1), (2, 2), (3, 3)] and sorted(done) == [1, 2, 3]


def test_few_heavy_pieces_at_a_time(spark, tmp_path, monkeypatch):
    """Heavy pieces wait for each other and not for the light ones, and all are done."""
    monkeypatch.setattr(jobs, "HEAVY_THREADS", 1)
    now, most, light = [], [], threading.Event()

    def piece(name):
        def work():
            if name == "light":
                light.set()
            else:
                now.append(name)
                most.append(len(now))
                assert light.wait(60)
                now.remove(name)
            return [(name, 1)]

        return work

    pieces = {(n,): piece(n) for n in ("heavy 1", "heavy 2", "heavy 3", "light")}
    rows = jobs.run_jobs(spark, str(tmp_path / "p"), "name string, n int", ["name"], pieces, 3, heavy=lambda k: k[0] != "light")
    assert sorted(r["name"] for r in rows.collect()) == sorted(n for n, in pieces) and max(most) == 1
    one = jobs.run_jobs(spark, str(tmp_path / "q"), "name string, n int", ["name"], {("light",): piece("light"), ("heavy",): piece("heavy")}, 1, heavy=lambda k: k[0] == "heavy")
    assert one.count() == 2


def test_passes_of_a_fit_are_small(spark, planted, monkeypatch):
    """A pass of a regression has no more tasks than its rows need; a forest keeps its partitions, by which Spark draws, and
    the nodes its rows have reached."""
    seen = []
    for kind in (models.LogisticRegression, models.RandomForestClassifier):
        real = kind.fit
        monkeypatch.setattr(kind, "fit", lambda self, df, real=real: seen.append((self, df.rdd.getNumPartitions())) or real(self, df))
    spread = spark.createDataFrame(planted.collect(), planted.schema).repartition(8)
    models.fit_logreg(spread, max_iter=3)
    models.fit_forest(spread, 1, trees=2, depth=3)
    assert [n for _, n in seen] == [1, spread.rdd.getNumPartitions()] and seen[1][0].getCacheNodeIds()
    assert models._in_few_tasks(spread, 3 * models.TASK_ROWS).rdd.getNumPartitions() == 3


def test_model_is_stored_with_its_manifest(spark, planted, tmp_path):
    model = models.fit_logreg(planted)
    models.save_model(model, str(tmp_path / "m"), {"features": ["x", "z"]})
    loaded, manifest = models.load_model(spark, str(tmp_path / "m"), ["x", "z"])
    assert manifest == {"features": ["x", "z"]}
    a, b = (models.with_probability(m.transform(planted)).agg(F.sum("score")).first()[0] for m in (model, loaded))
    assert a == pytest.approx(b)
    with pytest.raises(ValueError):
        models.load_model(spark, str(tmp_path / "m"), ["z", "x"])


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(0.5, 1, 0), (0.9, 1, 0), (0.2, 0, 1)], "s double, y int, b int")
    assert metrics.accuracy(df, "s", "y").first()[0] == 1.0
    assert metrics.accuracy(df, "s", "y", strict=True).first()[0] == pytest.approx(2 / 3)
    assert metrics.mse(df, "s", "y").first()[0] == pytest.approx((0.25 + 0.01 + 0.04) / 3)
    losses = [-np.log(0.5), -np.log(0.9), -np.log(0.8)]
    assert metrics.log_loss(df, "s", "y").first()[0] == pytest.approx(np.mean(losses))
    batched = metrics.batch_mean_loss(df, "s", "y", "b").first()[0]
    assert batched == pytest.approx((np.mean(losses[:2]) + losses[2]) / 2)
    certain = spark.createDataFrame([(1.0, 0)], "s double, y int")
    assert metrics.log_loss(certain, "s", "y").first()[0] == pytest.approx(-np.log(1e-15), rel=0.01)


# game states

WORTH0, WORTH1 = (6288, 7100, 6278, 8845, 7881, 9232), (6853, 7977, 8266, 6687, 7161, 8365)
PARAMS = {
    "timestamp": (900.0, 600.0), "total_gold": (90000.0, 1000.0), "ability_points": (8.0, 2.0), "level": (12.0, 3.0),
    "net_worth_ratio": (1 / 12, 0.01),
}


def _state(match_id=1, **edit):
    def team(worth, first, lost):
        players = [
            {"hero": HEROES[first + i], "net_worth": w, "ability_points": 6 + i, "level": 10 + i} for i, w in enumerate(worth)
        ]
        return {"players": players, "lost_objectives": {o: True for o in lost}}

    state = {
        "match_id": match_id, "timestamp": 540, "team0": team(WORTH0, 0, ["Tier1Lane1"]),
        "team1": team(WORTH1, 6, ["Tier1Lane3", "Tier1Lane4"]),
    }
    return {**state, **edit}


def _states(spark, *states):
    return spark.createDataFrame(list(states), state_stream.STATE_ROW)


def test_flat_state(spark):
    flat = scoring.flatten_game_state(_states(spark, _state()))
    info = flat.info_timestamp.first().asDict()
    assert info["total_gold"] == sum(WORTH0) + sum(WORTH1)
    assert [f for f in FLAGS if info[f]] == ["team0_Tier1Lane1", "team1_Tier1Lane3", "team1_Tier1Lane4"]
    accounts = [r["account_id"] for r in flat.player_general.orderBy("account_id").collect()]
    assert accounts == list(range(1, 13))


def test_validation(spark):
    short, bad, late = _state(2), _state(3), _state(4, timestamp=-1)
    short["team1"]["players"].pop()
    bad["team0"]["players"][2] |= {"hero": "Nobody", "level": -1}
    bad["team1"]["lost_objectives"]["Tier1Lane2"] = True
    checked = scoring.validate(_states(spark, _state(), short, bad, late), list(HEROES))
    reasons = {r["match_id"]: r["reasons"] for r in checked.collect()}
    assert reasons == {
        1: [], 2: ["team1: player count"], 3: ["team0: hero", "team0: level", "team1: objective"], 4: ["timestamp"],
    }
    assert scoring.rejected(checked).count() == 3
    kept = scoring.accepted(checked).first()
    assert set(kept["team0"]["lost_objectives"]) == set(OBJECTIVES)
    assert sum(kept["team1"]["lost_objectives"].values()) == 2


def test_edits(spark):
    states = _states(spark, _state())
    richer = scoring.update_player(states, "team1", 5, net_worth=1, hero="Billy").first()["team1"]["players"]
    assert (richer[5]["net_worth"], richer[5]["hero"], richer[4]["net_worth"]) == (1, "Billy", WORTH1[4])
    lost = scoring.update_objective(states, "team0", "Core", True).first()["team0"]["lost_objectives"]
    assert lost["Core"] and lost["Tier1Lane1"] and not lost["Titan"]
    with pytest.raises(ValueError):
        scoring.update_player(states, "team1", 6, net_worth=1)
    with pytest.raises(ValueError):
        scoring.update_objective(states, "team1", "Tier1Lane2", True)


def test_state_vector_by_hand(spark):
    vector = scoring.state_vectors(_states(spark, _state()), PARAMS, list(HEROES)).first()["features"].toArray()
    gold = sum(WORTH0) + sum(WORTH1)
    assert len(vector) == 448
    assert vector[:2] == pytest.approx([(540 - 900) / 600, (gold - 90000) / 1000])
    assert vector[2:28].sum() == 3 and vector[3] == 1.0
    last = vector[-35:]
    assert last[:32].argmax() == 11 and last[:32].sum() == 1
    assert last[32:] == pytest.approx([(11 - 8) / 2, (15 - 12) / 3, (WORTH1[5] / gold - 1 / 12) / 0.01])


def test_unknown_hero_stops_scoring(spark):
    with pytest.raises(Exception, match="unknown hero"):
        scoring.state_vectors(_states(spark, _state()), PARAMS, list(HEROES[:5])).collect()


def test_states_give_the_training_rows(spark, sf_dir):
    """Flattened live states, the wide table and the direct vectors agree value by value."""
    info, player, heroes, params = kept_and_params(spark, sf_dir)
    names = features.feature_columns(heroes)
    wide = features.to_vector(features.feature_matrix(player, info, heroes, params), names, keep=["match_id", "time_s"])
    direct = features.feature_vectors(player, info, heroes, params)
    states = scoring.accepted(scoring.validate(game_states(spark, sf_dir), heroes))
    live = scoring.state_vectors(states.withColumn("time_s", F.col("timestamp")), params, heroes)

    def vectors(df):
        return {(r["match_id"], r["time_s"]): r["features"].toArray() for r in df.collect()}

    by_wide, by_direct, by_live = vectors(wide), vectors(direct), vectors(live)
    assert len(by_wide) == 9 and set(by_wide) == set(by_direct) <= set(by_live)
    for key, row in by_wide.items():
        assert np.allclose(row, by_direct[key]) and np.allclose(row, by_live[key])


def test_states_are_scored_as_they_arrive(spark, tmp_path):
    states = _states(spark, _state(1), _state(2, timestamp=600))
    trained = scoring.state_vectors(states, PARAMS, list(HEROES)).withColumn("winning_team", F.col("match_id") - 1)
    model = models.fit_logreg(trained, max_iter=5)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(json.dumps(s) for s in (_state(1), _state(2, timestamp=600), _state(3))))
    stream = state_stream.read_states(spark, str(folder))
    out = str(tmp_path / "out")
    state_stream.score_stream(stream, model, PARAMS, list(HEROES), out, str(tmp_path / "cp")).awaitTermination()
    got = {r["match_id"]: r["score"] for r in spark.read.parquet(out).collect()}
    batch = scoring.score(model, _states(spark, _state(1), _state(2, timestamp=600), _state(3)), PARAMS, list(HEROES))
    assert got == pytest.approx({r["match_id"]: r["score"] for r in batch.collect()})
