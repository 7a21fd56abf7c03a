"""The whole preparation, the shape of the plans, and the catalog against SQL."""

import re
from datetime import datetime, timezone
from pathlib import Path

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from matchloom.functions.arrays import quoted
from matchloom.operators import analytics, features, filters, series
from matchloom.plans import views
from matchloom.plans.catalog import ORACLES, QUERIES
from matchloom.plans.prepare import Selection, prepare
from matchloom.plans.queries_features import feature_sql, kept_and_params
from matchloom.plans.queries_tables import CHOSEN, filtered, samples
from matchloom.schemas import FILTER_ONLY, MATCH_INFO, MATCH_PLAYER
from matchloom.operators.normalize import PLAYER_FEATURES
from matchloom.sources import tables
from matchloom.sources.tables import load_params, read_bucketed, scan_numbered, write_bucketed, write_stage
from matchloom.sources.testdata import EventMatches
from tools.compare import compare, connect


SQL_DIR = "/root/testdata/sf0.01"  # where every query has rows


def static_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """Raw tables as numbered files, and the hero list."""
    folder = str(tmp_path_factory.mktemp("raw"))
    raw = EventMatches(spark, sf_dir.replace("0.001", "0.01"))
    write_stage(raw.info, f"{folder}/match_info_45.parquet")
    write_stage(raw.player, f"{folder}/match_player_46.parquet")
    write_stage(raw.heroes, f"{folder}/heroes.parquet")
    return folder


def test_prepare_writes_all_tables(spark, stored, tmp_path):
    out = str(tmp_path / "out")
    matrix, params = prepare(spark, stored, f"{stored}/heroes.parquet", out, range(45, 48), CHOSEN)
    def counted(sql):
        return connect(SQL_DIR).execute(sql).fetchone()[0]

    # 28 + 12 * (6 heroes + 3) features, key, time and label
    assert (matrix.count(), len(matrix.columns)) == (counted(f"SELECT count(*) FROM ({feature_sql()})"), 136 + 3)
    assert matrix.count() > 10
    stored_params = load_params(spark, f"{out}/normalization_params")
    assert set(stored_params) == set(params) and all(stored_params[f] == pytest.approx(params[f]) for f in params)
    rows = {t: spark.read.parquet(f"{out}/match_{t}").count() for t in series.StageTables._fields}
    tables = {"info_general": "kept_info", "info_timestamp": "info_ts", "player_general": "named_player", "player_timestamp": "kept_ts"}
    assert rows == {t: counted(f"{views.FILTERED}, {views.INFO_TS} SELECT count(*) FROM {v}") for t, v in tables.items()}
    nothing = Selection(start=datetime(2020, 1, 1, tzinfo=timezone.utc), end=datetime(2020, 1, 2, tzinfo=timezone.utc))
    info, _ = filters.filter_matches(
        EventMatches(spark, "/root/testdata/sf0.001").info, EventMatches(spark, "/root/testdata/sf0.001").player,
        nothing.start, nothing.end, 101, 2,
    )
    assert info.isEmpty()


def test_unnested_rows_are_not_shuffled(spark, stored):
    """From stored tables: one shuffle of the compact player rows, then everything stays in place."""
    info = spark.read.parquet(f"{stored}/match_info_45.parquet")
    player = spark.read.parquet(f"{stored}/match_player_46.parquet").withColumn("hero_name", F.lit("x"))
    plan = static_plan(features.match_rows(features.co_locate(player), info))
    above = plan[: plan.index("Generate inline")]
    assert "Exchange hashpartitioning" not in above[above.rindex("Window") :]
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert all("match_id" in line and "timestamp" not in line for line in shuffled) and len(shuffled) <= 2


def test_bucketed_tables_need_no_shuffle_by_match(spark, stored, tmp_path):
    """Stage tables in buckets of match ids: training table, fit, leads and profiles join and group where the rows lie."""
    from matchloom.operators import aggregates, analytics
    from matchloom.plans.prepare import store_matches

    raw = (spark.read.parquet(f"{stored}/{t}.parquet") for t in ("match_info_45", "match_player_46", "heroes"))
    info, player = store_matches(*raw, CHOSEN, str(tmp_path / "out"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [
            features.match_rows(player, info),
            features.feature_vectors(player, info, ["x"], {f: (0.0, 1.0) for f in ("timestamp", "total_gold", *PLAYER_FEATURES)}, placed=True),
            analytics.winner_gold(player, info),
            filters.keep_matching(player, info, "match_id"),
            aggregates.group_stats(player, ["match_id"], worth=F.sum("net_worth")),
        ]
        for df in plans:
            assert "Exchange" not in static_plan(df).replace("BroadcastExchange", ""), static_plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    again = read_bucketed(spark, str(tmp_path / "out" / "kept_player"), player.schema, "match_id", 4)
    assert again.count() == player.count() == spark.read.parquet(str(tmp_path / "out" / "kept_player")).count()


def test_another_session_finds_the_buckets(spark, tmp_path):
    rows, path = spark.range(100).withColumn("stats.x", F.col("id") * 2), str(tmp_path / "b")
    made = write_bucketed(rows, path, "id", 3)
    spark.sql(f"DROP TABLE {tables._table_name(path)}")
    found = read_bucketed(spark, path, made.schema, "id", 3)
    assert found.agg(F.sum("`stats.x`")).first()[0] == 9900
    assert "Exchange" not in static_plan(found.groupBy("id").count())
    assert write_bucketed(rows.limit(5), path, "id", 3).count() == 5


def test_key_filter_stands_below_the_shuffle(spark, tmp_path):
    """All kept rows pass and few others do, before any exchange."""
    ids = write_stage(spark.range(0, 1_000_000, 97).select(F.col("id").alias("match_id")), str(tmp_path / "ids"))
    rows = spark.range(1_000_000).select(F.col("id").alias("match_id"), F.lit(0).alias("abandon_match_time_s"))
    player = write_stage(rows.unionByName(spark.createDataFrame([(None, 1)], "match_id long, abandon_match_time_s int")), str(tmp_path / "p"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = filters.players_of(player, ids, ids.count(), filter_from=100)
        plan = static_plan(kept)
        assert "bit_get" in plan[plan.index("Exchange hashpartitioning(match_id") :]
        assert kept.count() == ids.count()
        assert "bit_get" not in static_plan(filters.players_of(player, ids, ids.count()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    held = filters.key_filter(ids, "match_id", ids.count())
    passed = player.where(held(F.col("match_id"))).count()
    assert ids.count() <= passed < ids.count() + 20_000  # of 990 000 others
    assert filters.key_filter(ids, "match_id", 1 << 30) is None
    none = filters.key_filter(ids.limit(0), "match_id", 0)
    assert player.where(none(F.col("match_id"))).count() == 0


def test_lookup_reads_one_row_group(spark, tmp_path):
    rows = spark.range(400_000).select((F.col("id") * 7919 % 20_000).alias("match_id"), F.md5(F.col("id").cast("string")).alias("x"))
    path = str(tmp_path / "sorted")
    tables.write_sorted(rows, path, "match_id", group_bytes=1 << 20)
    found = tables.point_lookup(spark, path, 4242)
    assert found.count() == 20
    scan = found.select("x")
    scan.collect()
    leaves = scan._jdf.queryExecution().executedPlan()
    leaves = leaves.finalPhysicalPlan() if "Adaptive" in leaves.nodeName() else leaves
    read = leaves.collectLeaves().apply(0).metrics().apply("numOutputRows").value()
    files = [pq.ParquetFile(f) for f in Path(path).glob("*.parquet")]
    groups = [f.metadata.row_group(g) for f in files for g in range(f.metadata.num_row_groups)]
    assert len(groups) >= 8 and 20 <= read <= max(g.num_rows for g in groups) < 100_000
    bounds = [(c.statistics.min, c.statistics.max) for c in (g.column(0) for g in groups)]
    assert sum(low <= 4242 <= high for low, high in bounds) == 1


def test_funnel_is_counted_on_the_way(spark, stored, tmp_path):
    info, player = (spark.read.parquet(f"{stored}/{t}.parquet") for t in ("match_info_45", "match_player_46"))
    eligible = filters.filter_matches_eligible(info, CHOSEN.start, CHOSEN.end, CHOSEN.min_badge, CHOSEN.max_disparity)
    want = sorted(map(tuple, filters.filter_funnel(filters.match_verdicts(eligible, player)).collect()))
    out = str(tmp_path / "out")
    prepare(spark, stored, f"{stored}/heroes.parquet", out, range(45, 48), CHOSEN)
    assert sorted(map(tuple, spark.read.parquet(f"{out}/filter_funnel").collect())) == want


def test_slots_are_cut_before_the_shuffle(spark, sf_dir):
    plan = static_plan(features.slot_numbers(samples(EventMatches(spark, sf_dir)), 6))
    assert plan.count("WindowGroupLimit") == 2


def test_eligibility_reaches_the_scan(spark, stored):
    info = spark.read.parquet(f"{stored}/match_info_45.parquet")
    eligible = filters.filter_matches_eligible(info, CHOSEN.start, CHOSEN.end, 101, 2).select("match_id")
    plan = spark._jvm.PythonSQLUtils.explainString(eligible._jdf.queryExecution(), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    for column in ("start_time", "duration_s", "rewards_eligible", "low_pri_pool", "average_badge_team0"):
        assert column in pushed
    assert "objectives" not in re.search(r"ReadSchema: (\S+)", plan).group(1)


def test_verdicts_read_two_columns(spark, stored):
    info = spark.read.parquet(f"{stored}/match_info_45.parquet")
    player = spark.read.parquet(f"{stored}/match_player_46.parquet")
    plan = static_plan(filters.match_verdicts(info, player))
    assert re.findall(r"ReadSchema: struct<(\S+?)>", plan) == [
        "match_id:bigint,duration_s:bigint", "match_id:bigint,abandon_match_time_s:bigint",
    ]


def test_no_python_in_the_plans(spark, sf_dir):
    for name in ("feature_matrix", "gold_lead_by_time", "what_if", "validate_states", "gold_diff_box", "split_stratified"):
        plan = static_plan(entry_points.queries()[name](spark, sf_dir))
        assert "Python" not in plan and "Pandas" not in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_one_pass_fit_equals_the_stepwise_fit(spark, sf_dir):
    from matchloom.operators.normalize import normalize_features

    info, player, _, params = kept_and_params(spark, sf_dir)
    stages = series.split_general_timestamp(*filtered(spark, sf_dir))
    _, _, stepwise = normalize_features(stages.info_timestamp, stages.player_timestamp)
    for feature, pair in stepwise.items():
        assert params[feature] == pytest.approx(pair)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["timestamp_s", "lead_accuracy", "matchcount", "match_pct", "timestamp_min"]
    assert df.count() > 0


SLOW = {"model_comparison", "grid_search", "mlp_rounds", "train_log"}  # minutes of training each; tools/compare.py runs them


def test_catalog_is_complete():
    queries, oracles = entry_points.queries(), entry_points.oracle_sql()
    assert set(oracles) <= set(queries)
    assert len(queries) > 95


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_query_equals_sql(spark, name):
    con: duckdb.DuckDBPyConnection = connect(SQL_DIR)
    ok, note = compare(spark, con, SQL_DIR, name, QUERIES[name], ORACLES[name])
    assert ok, note


def test_comparison_rejects_empty_results_and_wrong_order(spark):
    con = connect(SQL_DIR)
    nothing = lambda spark, d: spark.range(0)
    assert not compare(spark, con, SQL_DIR, "nothing", nothing, "SELECT CAST(1 AS BIGINT) AS id WHERE FALSE")[0]
    down = lambda spark, d: spark.range(3).orderBy(F.desc("id"))
    up = "SELECT * FROM (VALUES (0::BIGINT), (1), (2)) t(id) ORDER BY id"
    assert compare(spark, con, SQL_DIR, "any", down, up)[0]
    assert not compare(spark, con, SQL_DIR, "head_rows", down, up)[0]


def test_every_rule_of_eligibility_rejects_a_row(spark):
    info = EventMatches(spark, SQL_DIR).info
    rules = ["rewards_eligible", "not not_scored", "not is_high_skill_range_parties", "not low_pri_pool", "not new_player_pool",
             "average_badge_team0 >= 101", "average_badge_team1 >= 101", "duration_s >= 480"]
    for rule in rules:
        assert 0 < info.where(rule).count() < info.count(), rule
    for column in ("rewards_eligible", "new_player_pool", "average_badge_team0", "average_badge_team1"):
        assert info.where(F.col(column).isNull()).count() > 0 or column == "average_badge_team1"


def test_prepare_reads_only_the_columns_it_needs(spark, stored, tmp_path):
    """Further columns of the raw files stay unread, and the player table is read twice."""
    wide = str(tmp_path / "wide")
    for name in ("match_info_45", "match_player_46", "heroes"):
        table = spark.read.parquet(f"{stored}/{name}.parquet")
        write_stage(table.withColumns({"_other": F.lit("x" * 100), "_more": F.lit(1)}), f"{wide}/{name}.parquet")
    info = scan_numbered(spark, wide, "match_info", range(45, 48)).select(*[quoted(n) for n in MATCH_INFO.names])
    player = scan_numbered(spark, wide, "match_player", range(45, 48)).select(*[quoted(n) for n in MATCH_PLAYER.names])
    kept = filters.kept_ids(filters.filter_matches_eligible(info, CHOSEN.start, CHOSEN.end, 101, 2), player)
    plan = static_plan(filters.players_of(player, kept))
    schemas = re.findall(r"ReadSchema: struct<(\S+?)>(?=\s|$)", plan)
    assert schemas and not any("_other" in s or "_more" in s for s in schemas)
    assert len([s for s in schemas if "abandon_match_time_s" in s or "account_id" in s]) <= 2
    assert prepare(spark, wide, f"{wide}/heroes.parquet", str(tmp_path / "out"), range(45, 48), CHOSEN)[0].count() > 0
    assert spark.read.parquet(str(tmp_path / "out" / "kept_info")).columns == [n for n in MATCH_INFO.names if n not in FILTER_ONLY]


def test_samples_carry_what_their_player_row_holds(spark, stored):
    """No exchange by match and account above the unnesting."""
    player = spark.read.parquet(f"{stored}/match_player_46.parquet").withColumn("hero_name", F.lit("x"))
    info = spark.read.parquet(f"{stored}/match_info_45.parquet")
    keys = ["match_id", "account_id", "team", "hero_name"]
    for df in (
        analytics.hero_time_samples(player, series.explode_series(player, keys), info),
        analytics.lead_end(series.last_samples(player, keys), player, info, "level"),
    ):
        exchanges = [line for line in static_plan(df).splitlines() if "Exchange hashpartitioning" in line]
        assert exchanges and not any("account_id" in line for line in exchanges)
    assert "Generate" not in static_plan(series.last_samples(player, keys))


def test_model_keys_run_the_whole_job(spark, monkeypatch):
    import inspect

    from matchloom.operators import models
    from matchloom.plans import queries_models

    seen = {}

    def record(name, schema):
        bind = inspect.signature(getattr(models, name)).bind

        def called(*args, **named):
            given = bind(*args, **named)
            given.apply_defaults()
            seen[name] = given.arguments
            return spark.createDataFrame([], schema)

        monkeypatch.setattr(models, name, called)

    monkeypatch.setattr(queries_models, "_parts", lambda *a: (None, None))
    monkeypatch.setattr(queries_models, "_vectors", lambda *a: (None, [], {}))
    record("grid_search", "place int, " + models.POINT)
    record("compare", models.RUN)
    for name in ("grid_search", "grid_search_full"):
        assert {"width", "hidden", "step"} <= set(QUERIES[name](spark, SQL_DIR).columns)
        assert seen["grid_search"]["grid"] == models.parameter_grid(**models.FULL_GRID) and seen["grid_search"]["epochs"] == 200
    for name in ("model_comparison", "model_comparison_full"):
        assert {"model", "metric"} <= set(QUERIES[name](spark, SQL_DIR).columns)
        assert seen["compare"]["runs"] == 25 and set(seen["compare"]["models"]) == set(models.default_models())


@pytest.mark.parametrize("name", ["profile_table", "gold_diff_box", "winner_gold_hist", "eval_auc", "slot_numbers", "split_stratified"])
def test_ordered_operators_read_their_rows_once_or_twice(spark, sf_dir, name):
    """Ranges, counts and bounds are stored; what remains are a few scans."""
    plan = static_plan(QUERIES[name](spark, sf_dir))
    assert plan.count("FileScan") <= (6 if name == "profile_table" else 4)  # its source alone has four
