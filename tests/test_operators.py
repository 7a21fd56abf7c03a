"""Hand-made fixtures with worked-out results."""

from datetime import datetime, timezone

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from matchloom.functions import columns as c
from matchloom.operators import aggregates, analytics, encode, features, filters, listing, metrics, normalize, series
from matchloom.operators import ordered, skew, splits
from matchloom.sources import tables

INFO = "match_id bigint, winning_team string, duration_s bigint"


def values(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


def test_badge_linear(spark):
    badges = spark.createDataFrame([(b,) for b in (1, 6, 11, 16, 21, 101, 116)], "b int")
    assert [r[0] for r in badges.select(c.badge_linear(F.col("b"))).collect()] == [1, 6, 7, 12, 13, 61, 72]


def test_series_are_cut_by_their_own_length_and_padded(spark):
    df = spark.createDataFrame(
        [(1, 1, [], []), (2, 1, [5], [6]), (3, 1, [1, 2, 3], [10, 20, 30]), (4, 1, [1, 2, 3, 4], [7, 8]), (5, 1, [1, 2], None)],
        "match_id int, account_id int, t array<bigint>, w array<bigint>",
    )
    rows = series.explode_series(df, ["match_id"], {"timestamp_s": "t", "net_worth": "w"})
    assert sorted(values(rows, "match_id", "timestamp_s", "net_worth"), key=str) == [
        (3, 1, 10), (3, 2, 20), (4, 1, 7), (4, 2, None), (4, 3, None), (5, 1, None),
    ]


def test_objectives_zip_with_null_padding(spark):
    df = spark.createDataFrame(
        [(1, [1, 2, 3], ["Core"], ["Team0", "Team1", "x"])],
        "match_id int, `objectives.destroyed_time_s` array<bigint>, `objectives.team_objective` array<string>, `objectives.team` array<string>",
    )
    rows = series.explode_objectives(df)
    assert sorted(values(rows, "destroyed_time", "obj_name", "obj_team")) == [(1, "Core", 0), (2, None, 1), (3, None, None)]


OBJECTIVES = "match_id int, destroyed_time bigint, obj_name string, obj_team int"


def test_flag_needs_a_fall_and_the_time(spark):
    times = spark.createDataFrame([(1, 199), (1, 200), (1, 300), (2, 300)], "match_id int, timestamp bigint")
    falls = spark.createDataFrame([(1, 0, "Core", 0), (1, 200, "Titan", 1), (1, 250, "Titan", 1)], OBJECTIVES)
    flags = series.objective_flags(times, falls)
    assert sorted(values(flags, "match_id", "timestamp", "team0_Core", "team1_Titan")) == [
        (1, 199, 0, 0), (1, 200, 0, 1), (1, 300, 0, 1), (2, 300, 0, 0),
    ]


def test_falls_in_the_row_equal_falls_by_group(spark):
    schema = (
        "match_id int, `objectives.destroyed_time_s` array<bigint>, "
        "`objectives.team_objective` array<string>, `objectives.team` array<string>"
    )
    info = spark.createDataFrame(
        [(1, [300, 200, 0], ["Core", "Core", "Titan"], ["Team0", "Team0", "Team1"]), (2, None, None, None), (3, [5], ["Titan"], ["Team1"])],
        schema,
    )
    in_row = {r["match_id"]: r.asDict() for r in series.lost_at_in_row(info).collect()}
    grouped = {r["match_id"]: r.asDict() for r in series.lost_at(series.explode_objectives(info)).collect()}
    assert in_row[1]["team0_Core"] == 200 and in_row[1]["team1_Titan"] is None and in_row[3]["team1_Titan"] == 5
    for match, row in grouped.items():
        assert in_row[match] == row
    assert set(in_row[2].values()) == {2, None}


def _players(spark, rows):
    return spark.createDataFrame(rows, "match_id bigint, account_id bigint, abandon_match_time_s bigint")


def test_leavers(spark):
    info = spark.createDataFrame([(1, "Team0", 1000), (2, "Team0", 1000), (3, "Team0", 1000)], INFO)
    player = _players(spark, [(1, 1, 0), (2, 1, 930), (3, 1, 929)])
    assert values(filters.early_leavers(player, info), "match_id") == [(3,)]


def test_filter_matches(spark):
    start = datetime(2025, 11, 1, tzinfo=timezone.utc)
    base = dict(
        duration_s=1000, winning_team="Team0", rewards_eligible=True, not_scored=False, low_pri_pool=False,
        is_high_skill_range_parties=False, new_player_pool=False, average_badge_team0=101, average_badge_team1=103,
        start_time=datetime(2025, 11, 1, 12),
    )
    cases = {
        1: {},
        2: {"new_player_pool": None},
        3: {"duration_s": 479},
        4: {"duration_s": 480},
        5: {"average_badge_team1": 104},
        6: {"average_badge_team0": 96},
        7: {"start_time": datetime(2025, 10, 31, 23)},
        8: {},  # eleven players
        9: {},  # thirteen players
        10: {},  # a leaver
    }
    kinds = {int: "bigint", str: "string", bool: "boolean", datetime: "timestamp_ntz"}
    schema = "match_id bigint, " + ", ".join(f"{k} {kinds[type(v)]}" for k, v in base.items())
    info = spark.createDataFrame([(m, *{**base, **x}.values()) for m, x in cases.items()], schema)
    sizes = {8: 11, 9: 13}
    player = _players(
        spark, [(m, a, 500 if (m, a) == (10, 3) else 0) for m in cases for a in range(sizes.get(m, 12))]
    )
    args = (start, datetime(2025, 11, 2, tzinfo=timezone.utc), 101, 2)
    kept_info, kept_player = filters.filter_matches(info, player, *args)
    assert sorted(values(kept_info, "match_id")) == [(1,), (4,)]
    assert kept_player.count() == 24 and "abandon_match_time_s" not in kept_player.columns
    held = []
    again, _ = filters.filter_matches(info, player, *args, hold=lambda ids: held.append(ids) or ids)
    assert len(held) == 1 and sorted(values(again, "match_id")) == [(1,), (4,)]
    eligible = filters.filter_matches_eligible(info, *args)
    funnel = filters.filter_funnel(filters.match_verdicts(eligible, player))
    assert values(funnel, "stage", "matches", "player_rows") == [
        ("prefiltered", 5, 60), ("complete", 3, 36), ("without_leavers", 2, 24),
    ]


def _samples(spark, rows):
    return spark.createDataFrame(rows, "match_id int, timestamp_s int, team int, account_id bigint, net_worth bigint")


def test_slots_follow_account_order(spark):
    rows = _samples(spark, [(1, 0, 0, a, 10 * a) for a in (9, 3, 7, 1, 5, 2)])
    for numbered in (features.slot_numbers(rows), features.slot_numbers(rows, 6)):
        assert sorted(values(numbered, "player_num", "account_id")) == list(enumerate((1, 2, 3, 5, 7, 9), start=1))


def test_wide_row_needs_all_slots_and_ignores_the_rest(spark):
    full = [(1, 0, t, 10 * t + a, a) for t in (0, 1) for a in range(6)]
    extra = [(2, 0, t, 10 * t + a, a) for t in (0, 1) for a in range(6 + t)]
    short = [(3, 0, t, 10 * t + a, a) for t in (0, 1) for a in range(6 - t)]
    other_time = [(1, 180, 0, a, a) for a in range(6)]
    numbered = features.slot_numbers(_samples(spark, full + extra + short + other_time), 6)
    wide = features.slot_wide(numbered, ["account_id", "net_worth"])
    assert sorted(values(wide, "match_id", "timestamp", "p1_account_id", "p12_account_id")) == [(1, 0, 0, 15), (2, 0, 0, 15)]


def test_zscore(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 1.0)], "a double, b double")
    params = normalize.fit_normalizer(df, ["a", "b"])
    assert params == {"a": (2.0, 1.0), "b": (1.0, 0.0)}
    assert values(normalize.transform(df, ["a", "b"], params), "a", "b") == [(-1.0, None), (1.0, None)]
    assert normalize.fit_normalizer(df, ["a", "b"], {"a": (0.0, 2.0)})["a"] == (0.0, 2.0)


def test_normalised_columns_have_mean_0_and_deviation_1(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 97).alias("x"))
    scaled = normalize.transform(df, ["x"], normalize.fit_normalizer(df, ["x"]))
    mean, std = scaled.agg(F.avg("x"), F.stddev_pop("x")).first()
    assert abs(mean) < 1e-9 and abs(std - 1) < 1e-9


def test_merge_params(spark):
    old = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "feature string, mean double")
    new = spark.createDataFrame([("b", 3.0), ("c", 4.0)], "feature string, mean double")
    assert sorted(values(normalize.merge_params(old, new), "feature", "mean")) == [("a", 1.0), ("b", 3.0), ("c", 4.0)]


def test_bins_labels_and_lead(spark):
    times = spark.createDataFrame([(t,) for t in (0, 179, 180, 899, 900, 1199, 1200)], "t int")
    assert [r[0] for r in times.select(c.time_bin(F.col("t"))).collect()] == [0, 0, 3, 12, 15, 15, 20]
    diffs = spark.createDataFrame([(5,), (0,), (-1,), (None,)], "d int")
    assert [r[0] for r in diffs.select(c.lead_team(F.col("d"))).collect()] == ["Team0", "Team1", "Team1", "Team1"]
    assert one(spark, c.interval_label(F.lit(180), F.lit(360))) == "3–6 min"
    assert one(spark, c.pct_of_larger(F.lit(80), F.lit(100))) == -20.0
    assert one(spark, c.file_number(F.lit("match_info_45.parquet"))) == 45
    assert one(spark, c.file_number(F.lit("heroes.parquet"))) is None


def test_histograms(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (10,)], "v int")
    assert sorted(values(aggregates.histogram(df, "v", 5), "bin", "count")) == [(0, 2), (1, 1), (2, 0), (3, 0), (4, 1)]
    durations = spark.createDataFrame([(0,), (179,), (180,), (360,)], "d bigint")
    fixed = aggregates.fixed_histogram(durations, "d", 180)
    assert sorted(values(fixed, "low", "count")) == [(0, 2), (180, 1)]
    whole = aggregates.fixed_histogram(durations, "d", 180, drop_top_edge=False)
    assert sorted(values(whole, "low", "count")) == [(0, 2), (180, 1), (360, 1)]
    assert aggregates.histogram(df.where("v > 99"), "v", 5).count() == 0


def test_team_wide_refuses_two_rows_per_cell(spark):
    df = spark.createDataFrame([(1, "Team0", 5), (1, "Team0", 6)], "match_id int, team string, w int")
    with pytest.raises(PySparkException, match="more than one row"):
        aggregates.team_wide(df, ["match_id"], "w").collect()


def test_team_code(spark):
    df = spark.createDataFrame([("Team1",), ("Team0",), ("x",), (None,)], "team string")
    coded = encode.encode_team(df, "team")
    assert values(coded, "team") == [(1,), (0,), (0,), (None,)]
    assert values(encode.encode_team(coded, "team"), "team") == [(1,), (0,), (0,), (None,)]


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "O'Neil"), (2, "B")], "id int, hero_name string")
    hot = encode.one_hot(df, "hero_name", ["O'Neil", "B"])
    assert hot.columns == ["id", "hero_name_O'Neil", "hero_name_B"]
    assert sorted(tuple(r) for r in hot.collect()) == [(1, 1.0, 0.0), (2, 0.0, 1.0)]
    with pytest.raises(PySparkException, match="unknown category"):
        encode.one_hot(df, "hero_name", ["B"]).collect()
    assert encode.one_hot(df, "hero_name", ["B"], "ignore").agg(F.sum("hero_name_B")).first()[0] == 1.0


def test_missing_winner_counts_as_lost(spark):
    player = spark.createDataFrame([(1, "Team0", "A"), (2, "Team0", "A")], "match_id bigint, team string, hero_name string")
    info = spark.createDataFrame([(1, "Team0", 200)], INFO)
    stats = analytics.winrate_by_duration(player, info).first()
    assert (stats["winrate"], stats["hero_winrate_overall"], stats["hero_matches_overall"]) == (1.0, 0.5, 2)


def test_empty_guard_and_drop_matching(spark, capsys):
    df = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    assert values(filters.drop_matching(df, df.where("k = 3"), "k"), "k") == [(1,)]
    assert filters.empty_guard(df.where("k > 9")).columns == ["k"]
    assert "nothing found" in capsys.readouterr().out


def test_listing(spark):
    row = "<tr><td><i>description</i> match_info_46.parquet</td><td>2048 (2 KiB)</td><td></td><td>{}</td><td><li><a href=\"/x\">x</a></li></td></tr>"
    page = '<table class="striped"><tbody>' + row.format("2025-11-02 10:00:00.123456 +0100 UTC") + "</tbody></table>"
    parsed = listing.parse_listing(spark.createDataFrame([(page,)], "html string"))
    assert values(parsed.withColumn("s", F.unix_seconds("modified")), "is_dir", "name", "bytes", "s", "href") == [
        (False, "match_info_46.parquet", 2048, 1762074000, "/x")
    ]
    for broken in ("<p>no table</p>", page.replace("<td></td>", "")):
        with pytest.raises(PySparkException, match="listing"):
            listing.parse_listing(spark.createDataFrame([(broken,)], "html string")).collect()


def test_select_stale(spark):
    names = {"heroes.parquet": False, "other.parquet": False, "match_info_44.parquet": True, "match_info_45.parquet": True,
             "match_info_46.parquet": True, "match_info_47.parquet": True}
    remote = spark.createDataFrame([(n, m, 1000) for n, m in names.items()], "name string, in_metadata boolean, s bigint")
    local = spark.createDataFrame([("match_info_45.parquet", 941), ("match_info_46.parquet", 940)], "name string, s bigint")
    at = F.timestamp_seconds("s")
    stale = listing.select_stale(
        remote.withColumn("modified", at), local.withColumn("modified", at), ["heroes.parquet"], range(45, 48)
    )
    assert sorted(values(stale, "name")) == [("heroes.parquet",), ("match_info_46.parquet",), ("match_info_47.parquet",)]


def test_match_json(spark, tmp_path):
    (tmp_path / "m.json").write_text(
        '{"match_info":{"players":[{"team":1,"stats":[{"time_stamp_s":"180","net_worth":5},{"time_stamp_s":360,"net_worth":6}]},'
        '{"team":1,"stats":[{"time_stamp_s":180,"net_worth":7}]},{"team":0,"stats":[{"time_stamp_s":180,"net_worth":9}]}]}}'
    )
    income = analytics.net_income(tables.scan_match_json(spark, str(tmp_path)))
    assert sorted(values(income, "team", "timestamp_s", "net_worth")) == [(1, 180, 12), (1, 360, 6), (2, 180, 9)]


def test_scan_numbered(spark, tmp_path):
    for i in (45, 47):
        spark.range(i).write.parquet(str(tmp_path / f"match_info_{i}.parquet"))
    assert tables.scan_numbered(spark, str(tmp_path), "match_info", range(45, 48)).count() == 92
    with pytest.raises(FileNotFoundError):
        tables.scan_numbered(spark, str(tmp_path), "match_player", range(45, 48))


def test_params_roundtrip(spark, tmp_path):
    params = {"a": (1.5, 0.25), "b": (None, None)}
    tables.save_params(spark.range(1), params, str(tmp_path / "p"))
    assert tables.load_params(spark, str(tmp_path / "p")) == params


# ordering over whole tables


@pytest.mark.parametrize("n", [1, 2, 5, 1000])
def test_exact_quantiles_equal_numpy(spark, n):
    rng = np.random.default_rng(n)
    data = [("hot" if i % 3 else "cold", float(v)) for i, v in enumerate(rng.integers(0, 60, n) ** 2)]
    df = spark.createDataFrame(data, "g string, v double")
    got = ordered.exact_quantiles(df, ["g"], "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0})
    for row in got.collect():
        want = np.quantile([v for g, v in data if g == row["g"]], [0, 0.25, 0.5, 0.9, 1])
        assert np.allclose([row[x] for x in "abcde"], want)


def test_auc_equals_pairs_and_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = spark.range(500).select(
        (F.col("id") * 37 % 19 / 19.0).alias("s"), ((F.col("id") * 7 + F.col("id") % 5) % 3 == 0).cast("double").alias("y")
    )
    got = metrics.roc_auc(df, "s", "y").first()[0]
    rows = [(r["s"], r["y"]) for r in df.collect()]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(want)
    spark_auc = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(df)
    assert got == pytest.approx(spark_auc)
    assert metrics.roc_auc(df.where("y = 1"), "s", "y").first()[0] is None


def test_split_sizes_and_stability(spark):
    df = spark.range(1003).withColumnRenamed("id", "k")
    parts = {r["k"]: r["part"] for r in splits.split_exact(df, 0.15, 0.1, 7, ["k"]).collect()}
    sizes = {p: list(parts.values()).count(p) for p in ("train", "val", "test")}
    assert sizes == {"train": 753, "val": 150, "test": 100}
    again = splits.split_exact(df.repartition(7, "k"), 0.15, 0.1, 7, ["k"])
    assert {r["k"]: r["part"] for r in again.collect()} == parts
    other = splits.split_exact(df, 0.15, 0.1, 8, ["k"])
    assert {r["k"]: r["part"] for r in other.collect()} != parts
    with pytest.raises(ValueError):
        splits.split_exact(df, 0.6, 0.4, 7, ["k"])
    with pytest.raises(Exception, match="rounds down"):
        splits.split_exact(df.limit(3), 0.15, 0.1, 7, ["k"]).collect()


def test_split_by_match_keeps_matches_whole(spark):
    # one match holds a third of the rows
    df = spark.range(900).select("id", F.when(F.col("id") < 300, F.lit(0)).otherwise(F.col("id") % 40).alias("m"))
    placed = splits.split_exact(df, 0.2, 0.2, 1, ["m"], unit="match")
    whole = placed.groupBy("m").agg(F.count_distinct("part").alias("n"), F.first("part").alias("part"))
    assert whole.where("n > 1").count() == 0
    assert dict(whole.groupBy("part").count().collect()) == {"train": 24, "val": 8, "test": 8}


def test_stratified_sizes(spark):
    df = spark.range(101).select("id", (F.col("id") % 7 == 0).cast("int").alias("y"))
    placed = splits.split_stratified(df, "y", 0.15, 3, ["id"])
    counts = {(r["y"], r["part"]): r["count"] for r in placed.groupBy("y", "part").count().collect()}
    # 15 ones, 86 zeros; 16 rows in the test part
    assert counts == {(0, "train"): 72, (0, "test"): 14, (1, "train"): 13, (1, "test"): 2}


# skew


def test_spread_join_equals_plain_join(spark):
    left = spark.range(3000).select(F.when(F.col("id") < 1000, F.lit(0)).otherwise(F.col("id") % 50).alias("k"), "id")
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        got = skew.spread_join(left, right, ["k"], how, limit=500, salts=8)
        assert got.exceptAll(left.join(right, ["k"], how)).count() == 0
        assert got.count() == left.join(right, ["k"], how).count()


def test_slot_numbers_of_a_large_group(spark):
    hot = spark.range(5000).select(
        F.lit(1).alias("match_id"), F.lit(0).alias("timestamp_s"), F.lit(0).alias("team"), (F.col("id") * 7919 % 5003).alias("account_id")
    )
    numbered = features.slot_numbers(hot)
    assert numbered.agg(F.min("player_num"), F.max("player_num"), F.count_distinct("player_num")).first() == (1, 5000, 5000)
    ahead = numbered.alias("a").join(numbered.alias("b"), F.expr("a.player_num + 1 = b.player_num"))
    assert ahead.where("a.account_id >= b.account_id").count() == 0


def test_ratio_with_a_heavy_group(spark):
    rows = spark.range(600).select(
        F.when(F.col("id") < 200, F.lit(1)).otherwise(F.col("id")).alias("match_id"), F.lit(0).alias("timestamp_s"), F.lit(2).alias("net_worth")
    )
    ratios = normalize.net_worth_ratio(rows)
    assert ratios.where("match_id = 1").agg(F.min("net_worth_ratio"), F.count("*")).first() == (1 / 200, 200)
    assert ratios.count() == 600


def test_stale_files_need_a_readable_time(spark):
    from matchloom.operators import listing

    schema = "name string, modified timestamp, in_metadata boolean"
    remote = spark.createDataFrame([("match_info_3000000000.parquet", None, True), ("x.parquet", None, False)], schema)
    local = spark.createDataFrame([("match_info_3000000000.parquet", datetime(2025, 1, 1))], "name string, modified timestamp")
    big = range(2_999_999_999, 3_000_000_001)
    assert listing.select_stale(remote, local.limit(0), [], big).count() == 1  # numbers beyond 2**31, nothing local
    with pytest.raises(Exception, match="no readable time for match_info_3000000000"):
        listing.select_stale(remote, local, [], big).collect()


def test_describe_covers_all_types(spark):
    from matchloom.operators.profile import describe_all

    rows = [(1, True, datetime(2024, 1, 1), "a", [1], datetime(2024, 1, 1).date()), (3, False, datetime(2024, 1, 3), "a", [1], None), (None, True, None, None, None, None)]
    df = spark.createDataFrame(rows, "n int, b boolean, t timestamp, s string, l array<int>, d date")
    got = {r["column"]: r for r in describe_all(df).collect()}
    assert set(got) == set(df.columns)
    assert (got["b"]["count"], got["b"]["unique"], got["b"]["top"], got["b"]["freq"]) == (3, 2, "true", 2)
    assert (got["l"]["count"], got["l"]["unique"], got["l"]["freq"]) == (2, 1, 2)
    assert got["t"]["max"] - got["t"]["min"] == 2 * 86400 and got["t"]["std"] is None and got["d"]["count"] == 1
    assert (got["n"]["count"], got["n"]["mean"], got["n"]["q50"]) == (2, 2.0, 2.0)
    assert describe_all(df.select("b")).count() == 1


def test_broken_documents_come_out_with_their_reasons(spark, tmp_path):
    sound = '{"match_info":{"players":[{"team":0,"stats":[{"time_stamp_s":"60","net_worth":5}]},{"team":1,"stats":[]}]}}'
    lines = [
        (sound, []),
        ('{"match_info":{"players":[', ["not of the known form"]),
        ('{"match_info":{"players":[{"team":"x","stats":[]}]}}', ["not of the known form"]),
        ("[1, 2]", ["not of the known form"]),
        ("{}", ["no match_info"]),
        ('{"match_info":{}}', ["no players"]),
        ('{"match_info":{"players":[{"stats":[{"net_worth":1}]},{"team":1}]}}', ["a player without team", "a player without stats", "a time stamp that is no whole number"]),
        ('{"match_info":{"players":[{"team":0,"stats":[{"time_stamp_s":"1.5x"}]}]}}', ["a time stamp that is no whole number", "a sample without net worth"]),
        ("", ["no document"]),
        (None, ["no document"]),
        ('{"match_info":{"players":[]}}', []),
    ]
    docs = spark.createDataFrame([(k, line, "r") for k, (line, _) in enumerate(lines)], "k int, doc string, reason string")
    samples, rejected = tables.check_match_json(docs, "doc")
    assert [tuple(r) for r in samples.collect()] == [(0, "r", 0, 60, 5)]
    assert {r["k"]: (r["doc"], r["reasons"]) for r in rejected.collect()} == {k: line for k, line in enumerate(lines) if line[1]}
    with pytest.raises(Exception, match="a broken document: no match_info"):
        tables.parse_match_json(docs.where("k in (0, 4)"), "doc").collect()
    (tmp_path / "m.json").write_text("\n".join((sound, "{broken", sound)))
    with pytest.raises(Exception, match="a broken document: not of the known form"):
        tables.scan_match_json(spark, str(tmp_path)).collect()


def test_quantiles_and_numbers_over_many_ranges(spark):
    """Small ranges, so that groups and equal values meet their borders."""
    rows = [(k % 3, float((k * 7919) % 101) if k % 5 else float(k % 2)) for k in range(2000)] + [(9, 1.5), (None, 2.0), (1, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = {r["g"]: (r["q"], r["m"]) for r in ordered.exact_quantiles(df, ["g"], "v", {"q": 0.3, "m": 0.5}).collect()}
        slots = spark.createDataFrame([(k % 2, 5, "Team0", 1000 - k) for k in range(500)], "match_id int, timestamp_s int, team string, account_id int")
        numbers = {(r["match_id"], r["account_id"]): r["player_num"] for r in features.slot_numbers(slots).collect()}
        scores = [(k, (k * 37 % 50) / 50, int(k * 37 % 50 + k % 11 > 28)) for k in range(600)]
        auc = metrics.roc_auc(spark.createDataFrame(scores, "k int, s double, y int"), "s", "y").first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for g in (0, 1, 2, 9):
        own = [v for k, v in rows if k == g and v is not None]
        assert got[g] == pytest.approx((np.quantile(own, 0.3), np.quantile(own, 0.5)))
    for m in (0, 1):
        own = sorted(a for k, a in numbers if k == m)
        assert [numbers[m, a] for a in own] == list(range(1, len(own) + 1))
    up, down = ([s for _, s, y in scores if y == c] for c in (1, 0))
    assert auc == pytest.approx(sum((a > b) + 0.5 * (a == b) for a in up for b in down) / (len(up) * len(down)))


def test_histograms_of_groups_in_one_pass(spark):
    rows = [("a", float(v)) for v in (0, 1, 2, 10)] + [("b", 3.0), ("b", 3.0), ("c", 1.0), (None, 1.0), ("a", None)]
    df = spark.createDataFrame(rows, "side string, v double")
    got = aggregates.histograms(df, "side", "v", {"a": 5, "b": 2, "z": 3}).collect()
    for side, bins in (("a", 5), ("b", 2)):
        single = aggregates.histogram(df.where(F.col("side") == side), "v", bins).collect()
        assert sorted(tuple(r)[1:] for r in got if r["side"] == side) == sorted(map(tuple, single))
    assert {r["side"] for r in got} == {"a", "b"}
