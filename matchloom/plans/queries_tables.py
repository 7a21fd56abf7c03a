"""Queries over sources, filters, joins, series and stage tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.functions.arrays import quoted
from matchloom.functions.columns import badge_distance, badge_linear
from matchloom.operators import filters, joins, listing, series
from matchloom.operators.aggregates import head
from matchloom.operators.encode import encode_team
from matchloom.operators.normalize import collect_params, mean_std, params_table
from matchloom.plans import views
from matchloom.plans.prepare import Selection, store_matches
from matchloom.plans.registry import query, rounded

from matchloom.session import scratch_path
from matchloom.sources import tables
from matchloom.sources.testdata import EventMatches, OrderMatches, read_table

CHOSEN = Selection(
    start=datetime(2024, 1, 1, tzinfo=timezone.utc), end=datetime(2024, 1, 31, 23, 59, 59, tzinfo=timezone.utc)
)


def filtered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Kept info rows and kept player rows with hero names, written once for all that reads them."""
    raw = EventMatches(spark, sf_dir)
    return store_matches(raw.info, raw.player, raw.heroes, CHOSEN, scratch_path(spark, "kept"))


def stage_tables(spark: SparkSession, sf_dir: str) -> series.StageTables:
    """The four stage tables; the unnested samples are written, as several steps read them."""
    stages = series.split_general_timestamp(*filtered(spark, sf_dir))
    samples_path = scratch_path(spark, "player-timestamp")
    return stages._replace(player_timestamp=tables.write_stage(stages.player_timestamp, samples_path))


def eligible(raw: EventMatches) -> DataFrame:
    return filters.filter_matches_eligible(
        raw.info, CHOSEN.start, CHOSEN.end, CHOSEN.min_badge, CHOSEN.max_disparity
    )


def samples(raw: EventMatches) -> DataFrame:
    """All players' samples with their team."""
    return series.explode_series(raw.player, ["match_id", "account_id", "team"])


# sources and sinks


def _ts_as_number(events: DataFrame) -> DataFrame:
    """The time as microseconds, one form for both engines."""
    return events.withColumn("ts_us", F.unix_micros(F.col("ts").cast("timestamp"))).drop("ts")


@query("scan_numbered", views.EVENTS + "SELECT match_id, winning_team, duration_s FROM raw_info")
def scan_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, info = scratch_path(spark, "numbered"), EventMatches(spark, sf_dir).info
    for number, rest in ((45, 0), (47, 1)):
        tables.write_stage(info.where(F.col("match_id") % 2 == rest), f"{folder}/match_info_{number}.parquet")
    return series.general_columns(tables.scan_numbered(spark, folder, "match_info", range(45, 48), info.schema))


@query("scan_parquet", "SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props FROM events")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ts_as_number(tables.scan_parquet(spark, f"{sf_dir}/events.parquet"))


@query("hero_list", views.EVENTS + "SELECT CAST(id AS BIGINT) AS position, name FROM heroes")
def hero_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = tables.load_dim_list(EventMatches(spark, sf_dir).heroes)
    return spark.createDataFrame(list(enumerate(names)), "position bigint, name string")


def match_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per match; a match has at most twelve players here."""
    raw = EventMatches(spark, sf_dir).player
    times, worth = quoted("stats.time_stamp_s"), quoted("stats.net_worth")
    stats = F.transform(
        F.arrays_zip(times.alias("t"), worth.alias("w")),
        lambda s: F.struct(s["t"].cast("string").alias("time_stamp_s"), s["w"].alias("net_worth")),
    )
    player = F.struct(F.when(F.col("team") == "Team1", 1).otherwise(0).alias("team"), stats.alias("stats"))
    return raw.groupBy("match_id").agg(
        F.to_json(F.struct(F.struct(F.collect_list(player).alias("players")).alias("match_info"))).alias("doc")
    )


@query(
    "match_json_explode",
    views.EVENTS
    + """SELECT match_id, CAST(CASE WHEN team = 'Team1' THEN 1 ELSE 0 END AS INT) AS team, t AS time_stamp_s,
       nw AS net_worth FROM cum""",
)
def match_json_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.parse_match_json(match_documents(spark, sf_dir), "doc")


def damaged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match documents, five of six damaged by a rule from the match."""
    docs, kind = match_documents(spark, sf_dir), F.col("match_id") % 6
    return docs.withColumn(
        "doc",
        F.when(kind == 1, F.expr("substring(doc, 1, length(doc) - 5)"))
        .when(kind == 2, F.regexp_replace("doc", '"players"', '"people"'))
        .when(kind == 3, F.regexp_replace("doc", '"time_stamp_s":"', '"time_stamp_s":"t'))
        .when(kind == 4, F.lit(None))
        .when(kind == 5, F.lit("{}"))
        .otherwise(F.col("doc")),
    )


@query(
    "match_json_checked",
    views.EVENTS
    + """SELECT match_id, CAST(CASE WHEN team = 'Team1' THEN 1 ELSE 0 END AS INT) AS team, t AS time_stamp_s,
       nw AS net_worth FROM cum WHERE match_id % 6 = 0""",
)
def match_json_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples of the sound documents among damaged ones."""
    return tables.check_match_json(damaged_documents(spark, sf_dir), "doc").samples


@query(
    "match_json_rejected",
    views.EVENTS
    + """SELECT match_id, CASE match_id % 6 WHEN 1 THEN 'not of the known form' WHEN 2 THEN 'no players'
              WHEN 3 THEN 'a time stamp that is no whole number' WHEN 4 THEN 'no document' ELSE 'no match_info' END AS reasons
       FROM (SELECT DISTINCT match_id FROM raw_player) WHERE match_id % 6 <> 0""",
)
def match_json_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged documents with the reasons against them."""
    rejected = tables.check_match_json(damaged_documents(spark, sf_dir), "doc").rejected
    return rejected.select("match_id", F.array_join("reasons", ", ").alias("reasons"))


@query(
    "stage_roundtrip",
    views.FILTERED + "SELECT match_id, account_id, team, hero_name, net_worth, ability_points, player_level FROM named_player",
)
def stage_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.write_stage(stage_tables(spark, sf_dir).player_general, scratch_path(spark, "stage"))


@query(
    "stage_bucketed",
    views.FILTERED
    + """SELECT i.match_id, winning_team, CAST(count(*) AS BIGINT) AS players, CAST(sum(net_worth) AS BIGINT) AS worth
       FROM kept_info i JOIN named_player p ON p.match_id = i.match_id GROUP BY i.match_id, winning_team""",
)
def stage_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Worth and players of each kept match, joined and grouped where the buckets lie."""
    info, player = filtered(spark, sf_dir)
    both = info.select("match_id", "winning_team").join(player.select("match_id", "net_worth"), "match_id")
    return both.groupBy("match_id", "winning_team").agg(F.count("*").alias("players"), F.sum("net_worth").alias("worth"))


@query(
    "params_roundtrip",
    """SELECT 'o_totalprice' AS feature, round(avg(o_totalprice), 6) AS mean, round(stddev_pop(o_totalprice), 6) AS std
       FROM orders
       UNION ALL SELECT 'o_custkey', round(avg(o_custkey), 6), round(stddev_pop(o_custkey), 6) FROM orders""",
)
def params_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, path = read_table(spark, sf_dir, "orders"), scratch_path(spark, "params")
    tables.save_params(orders, collect_params(mean_std(orders, ["o_totalprice", "o_custkey"])), path)
    return rounded(params_table(orders, tables.load_params(spark, path)))


@query(
    "point_lookup",
    "SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props FROM events WHERE user_id = 5",
)
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ts_as_number(tables.point_lookup(spark, f"{sf_dir}/events.parquet", 5, "user_id"))


@query(
    "point_lookup_sorted",
    "SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type, value, props FROM events WHERE user_id = 5",
)
def point_lookup_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a copy written for look-ups: one row group is read."""
    path = scratch_path(spark, "by-user")
    tables.write_sorted(read_table(spark, sf_dir, "events"), path, "user_id")
    return _ts_as_number(tables.point_lookup(spark, path, 5, "user_id"))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of one folder and one file per web page, written as HTML from the page's columns."""
    pages = read_table(spark, sf_dir, "pages")
    ident = F.col("page_id").cast("string")
    folder = F.when(F.col("page_id") % 2 == 0, F.lit("match_metadata")).otherwise(F.concat(F.lit("other_"), ident))
    file = F.concat(F.lit("match_info_"), ident, F.lit(".parquet"))
    second = F.lpad((F.col("page_id") % 60).cast("string"), 2, "0")
    return pages.select(
        "page_id",
        F.concat(
            F.lit('<html><body><table class="striped"><thead><tr><th>x</th></tr></thead><tbody>\n<tr><td><i>folder</i> '),
            folder,
            F.lit('</td><td>-</td><td></td><td>-</td><td></td></tr><tr>\n<td> <i class="m">description</i>\n'),
            file,
            F.lit("</td><td>"),
            F.length("html").cast("string"),
            F.lit(" (x KiB)</td><td>-</td><td>2025-11-02 10:00:"),
            second,
            F.lit('.250000 +0200 UTC</td><td><ul><li><a href="'),
            F.col("url"),
            F.lit('">get</a></li><li><a href="/other">other</a></li></ul></td></tr></tbody></table></body></html>'),
        ).alias("html"),
    )


@query(
    "parse_listing",
    """SELECT page_id, TRUE AS is_dir,
              CASE WHEN page_id % 2 = 0 THEN 'match_metadata' ELSE 'other_' || page_id END AS name,
              CAST(NULL AS BIGINT) AS bytes, CAST(NULL AS BIGINT) AS modified_s, CAST(NULL AS VARCHAR) AS href,
              page_id % 2 = 0 AS entered
       FROM pages
       UNION ALL
       SELECT page_id, FALSE, 'match_info_' || page_id || '.parquet', CAST(length(html) AS BIGINT),
              CAST(epoch(TIMESTAMP '2025-11-02 08:00:00') AS BIGINT) + page_id % 60, url, FALSE
       FROM pages""",
)
def parse_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = listing.parse_listing(listing_pages(spark, sf_dir))
    return rows.select(
        "page_id",
        "is_dir",
        "name",
        "bytes",
        F.unix_seconds("modified").alias("modified_s"),
        "href",
        listing.entered().alias("entered"),
    )


@query(
    "page_links",
    r"""WITH found AS (
          SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS hrefs,
                 regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS texts
          FROM pages)
        SELECT page_id, CAST(unnest(range(len(hrefs))) AS INT) AS position, unnest(hrefs) AS href, unnest(texts) AS text
        FROM found""",
)
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.page_links(read_table(spark, sf_dir, "pages").select("page_id", "html"))


@query(
    "select_stale",
    """WITH remote AS (
         SELECT doc_id, doc_id % 3 <> 0 AS in_metadata, 1700000000 + doc_id * 10 AS remote_s,
                CASE WHEN doc_id % 3 <> 0 THEN 'match_info_' || doc_id || '.parquet' ELSE source || '.parquet' END AS name
         FROM documents),
       mine AS (
         SELECT 'match_info_' || doc_id || '.parquet' AS name, 1700000000 + doc_id * 10 - n_chars % 120 AS local_s
         FROM documents WHERE lang = 'en')
       SELECT name, in_metadata, remote_s AS modified_s FROM remote LEFT JOIN mine USING (name)
       WHERE (CASE WHEN in_metadata THEN doc_id BETWEEN 45 AND 100000 ELSE name IN ('src0.parquet', 'src7.parquet') END)
         AND (local_s IS NULL OR remote_s - local_s >= 60)""",
)
def select_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    inner = F.col("doc_id") % 3 != 0
    numbered = F.concat(F.lit("match_info_"), F.col("doc_id"), F.lit(".parquet"))
    at = F.lit(1700000000) + F.col("doc_id") * 10
    remote = documents.select(
        F.when(inner, numbered).otherwise(F.concat("source", F.lit(".parquet"))).alias("name"),
        inner.alias("in_metadata"),
        F.timestamp_seconds(at).alias("modified"),
    )
    local = documents.where(F.col("lang") == "en").select(
        numbered.alias("name"), F.timestamp_seconds(at - F.col("n_chars") % 120).alias("modified")
    )
    stale = listing.select_stale(remote, local, ["src0.parquet", "src7.parquet"], range(45, 100001))
    return stale.select("name", "in_metadata", F.unix_seconds("modified").alias("modified_s"))


# projections and filters


@query(
    "project_general",
    views.EVENTS
    + """SELECT match_id, account_id, team, net_worth, ability_points, player_level,
       CAST(len("stats.level") AS INT) AS samples FROM raw_player""",
)
def project_general(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EventMatches(spark, sf_dir).player.select(
        "match_id", "account_id", "team", "net_worth", "ability_points", "player_level",
        F.size("`stats.level`").alias("samples"),
    )


@query(
    "drop_cols",
    views.EVENTS
    + """SELECT * EXCLUDE ("stats.time_stamp_s", "stats.net_worth", "stats.ability_points", "stats.level") FROM raw_player""",
)
def drop_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    player = EventMatches(spark, sf_dir).player
    return player.drop(*[c for c in player.columns if c.startswith("stats.")])


@query(
    "encode_team",
    views.ORDERS + "SELECT match_id, CAST(winning_team = 'Team1' AS INT) AS winning_team, duration_s FROM om_info",
)
def encode_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    once = encode_team(OrderMatches(spark, sf_dir).info, "winning_team")
    return encode_team(once, "winning_team")


@query(
    "eligible_matches",
    views.FILTERED + "SELECT match_id, winning_team, duration_s, average_badge_team0, average_badge_team1 FROM eligible",
)
def eligible_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligible(EventMatches(spark, sf_dir)).select(
        "match_id", "winning_team", "duration_s", "average_badge_team0", "average_badge_team1"
    )


@query(
    "badge_distance",
    f"""SELECT o_orderkey, CAST({views.BADGE.format('(o_orderkey % 117)')} AS BIGINT) AS own,
       CAST({views.BADGE.format('(o_custkey % 117)')} AS BIGINT) AS other,
       CAST(abs({views.BADGE.format('(o_orderkey % 117)')} - {views.BADGE.format('(o_custkey % 117)')}) AS BIGINT) AS distance
       FROM orders""",
)
def badge_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, other = F.col("o_orderkey") % 117, F.col("o_custkey") % 117
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        badge_linear(own).alias("own"),
        badge_linear(other).alias("other"),
        badge_distance(own, other).alias("distance"),
    )


@query(
    "null_audit",
    views.ORDERS
    + """SELECT CAST(sum(CAST(match_id IS NULL AS INT) + CAST(winning_team IS NULL AS INT)
       + CAST(duration_s IS NULL AS INT)) AS BIGINT) AS missing_values FROM om_info""",
)
def null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.null_audit(OrderMatches(spark, sf_dir).info)


@query(
    "filter_funnel",
    views.FILTERED
    + """SELECT 'prefiltered' AS stage, (SELECT count(*) FROM eligible) AS matches,
       (SELECT count(*) FROM eligible_player) AS player_rows
       UNION ALL SELECT 'complete', (SELECT count(*) FROM full_matches),
       (SELECT count(*) FROM eligible_player SEMI JOIN full_matches USING (match_id))
       UNION ALL SELECT 'without_leavers', (SELECT count(*) FROM kept_info), (SELECT count(*) FROM kept_player)""",
)
def filter_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = EventMatches(spark, sf_dir)
    return filters.filter_funnel(filters.match_verdicts(eligible(raw), raw.player, CHOSEN.leniency_s))


@query(
    "filtered_matches",
    views.FILTERED
    + """SELECT match_id, account_id, team, hero_id, net_worth, winning_team, duration_s
       FROM kept_player JOIN kept_info USING (match_id)""",
)
def filtered_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = EventMatches(spark, sf_dir)
    info, player = filters.filter_matches(
        raw.info, raw.player, CHOSEN.start, CHOSEN.end, CHOSEN.min_badge, CHOSEN.max_disparity, CHOSEN.leniency_s,
        hold=lambda ids: tables.write_stage(ids, scratch_path(spark, "kept-ids")),
    )
    return player.join(info, "match_id").select(
        "match_id", "account_id", "team", "hero_id", "net_worth", "winning_team", "duration_s"
    )


# joins


@query("semi_players", views.FILTERED + "SELECT match_id, account_id, team, net_worth FROM eligible_player")
def semi_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = EventMatches(spark, sf_dir)
    players = raw.player.select("match_id", "account_id", "team", "net_worth")
    return filters.keep_matching(players, eligible(raw), "match_id")


def _leavers(raw: EventMatches) -> DataFrame:
    return filters.early_leavers(raw.player, raw.info, CHOSEN.leniency_s)


_LEFT = """SELECT DISTINCT match_id FROM raw_player JOIN raw_info USING (match_id)
       WHERE abandon_match_time_s > 0 AND duration_s - abandon_match_time_s > 70"""


@query("early_leavers", views.EVENTS + _LEFT)
def early_leavers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leavers(EventMatches(spark, sf_dir))


@query(
    "anti_leavers",
    views.EVENTS + f"SELECT match_id, account_id, team, net_worth FROM raw_player WHERE match_id NOT IN ({_LEFT})",
)
def anti_leavers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = EventMatches(spark, sf_dir)
    players = raw.player.select("match_id", "account_id", "team", "net_worth")
    return filters.drop_matching(players, _leavers(raw), "match_id")


@query("complete_matches", views.EVENTS + "SELECT match_id FROM raw_player GROUP BY match_id HAVING count(*) = 12")
def complete_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.complete_matches(EventMatches(spark, sf_dir).player)


@query(
    "hero_names",
    views.EVENTS
    + """SELECT match_id, account_id, team, net_worth, name AS hero_name
       FROM raw_player JOIN heroes ON hero_id = id""",
)
def hero_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = EventMatches(spark, sf_dir)
    players = raw.player.select("match_id", "account_id", "team", "hero_id", "net_worth")
    return joins.replace_hero_ids_with_names(players, raw.heroes)


@query(
    "player_ts_with_team",
    views.EVENTS
    + """SELECT match_id, account_id, timestamp_s, net_worth, ability_points, level, team FROM all_ts""",
)
def player_ts_with_team(spark: SparkSession, sf_dir: str) -> DataFrame:
    player = EventMatches(spark, sf_dir).player
    return joins.join_inner(
        series.explode_series(player), player.select("match_id", "account_id", "team"), ["match_id", "account_id"]
    )


@query(
    "attach_winner_inner",
    views.ORDERS + "SELECT match_id, team, hero_name, net_worth, winning_team FROM om_player JOIN om_info USING (match_id)",
)
def attach_winner_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = OrderMatches(spark, sf_dir)
    return joins.attach_winner(orders.player, orders.info)


@query(
    "attach_winner_left",
    views.ORDERS
    + """SELECT match_id, winning_team, coalesce(duration_s, -1) AS duration_s, team
       FROM (SELECT o_orderkey AS match_id, CASE WHEN o_orderkey % 2 = 0 THEN 'Team0' ELSE 'Team1' END AS team FROM orders)
       LEFT JOIN om_info USING (match_id)""",
)
def attach_winner_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = OrderMatches(spark, sf_dir).info
    matches = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("match_id"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("Team0")).otherwise(F.lit("Team1")).alias("team"),
    )
    left = joins.join_left(joins.attach_winner(matches, info, "left"), info.drop("winning_team"), ["match_id"])
    return left.select("match_id", "winning_team", F.coalesce("duration_s", F.lit(-1)).alias("duration_s"), "team")


# series and stage tables


@query(
    "player_timestamps",
    views.EVENTS + "SELECT match_id, account_id, timestamp_s, net_worth, ability_points, level FROM all_ts",
)
def player_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.explode_series(EventMatches(spark, sf_dir).player)


@query(
    "objectives_long",
    views.EVENTS
    + """SELECT match_id, destroyed_time, obj_name,
       CAST(CASE obj_side WHEN 'Team0' THEN 0 WHEN 'Team1' THEN 1 END AS INT) AS obj_team FROM all_objectives""",
)
def objectives_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.explode_objectives(EventMatches(spark, sf_dir).info)


@query("distinct_times", views.EVENTS + "SELECT DISTINCT match_id, timestamp_s FROM all_ts")
def distinct_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.distinct_rows(samples(EventMatches(spark, sf_dir)), ["match_id", "timestamp_s"])


@query(
    "total_gold",
    views.EVENTS
    + """SELECT match_id, timestamp_s AS timestamp, CAST(sum(net_worth) AS BIGINT) AS total_gold
       FROM all_ts GROUP BY match_id, timestamp_s""",
)
def total_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.total_gold(samples(EventMatches(spark, sf_dir)))


@query(
    "objective_flags",
    views.EVENTS
    + ", times AS (SELECT DISTINCT match_id, timestamp_s AS timestamp FROM all_ts)"
    + views.flags_over("times", ""),
)
def objective_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = EventMatches(spark, sf_dir)
    times = series.distinct_rows(
        samples(raw).withColumnRenamed("timestamp_s", "timestamp"), ["match_id", "timestamp"]
    )
    return series.objective_flags(times, series.explode_objectives(raw.info))


@query("info_timestamps", f"{views.FILTERED}, {views.INFO_TS} SELECT * FROM info_ts")
def info_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_tables(spark, sf_dir).info_timestamp


@query(
    "conditional_flags",
    views.EVENTS
    + """SELECT match_id, max(CASE WHEN destroyed_time <> 0 AND obj_side = 'Team0' THEN 1 ELSE 0 END) AS team0_lost_any,
       max(CASE WHEN destroyed_time <> 0 AND obj_side = 'Team1' THEN 1 ELSE 0 END) AS team1_lost_any
       FROM all_objectives GROUP BY match_id""",
)
def conditional_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    fallen = F.col("destroyed_time") != 0
    return series.conditional_max(
        series.explode_objectives(EventMatches(spark, sf_dir).info),
        ["match_id"],
        {f"team{t}_lost_any": fallen & (F.col("obj_team") == t) for t in (0, 1)},
    )


@query(
    "head_rows",
    views.ORDERS + "SELECT match_id, winning_team, duration_s FROM om_info ORDER BY match_id LIMIT 5",
)
def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return head(OrderMatches(spark, sf_dir).info, ["match_id"], 5)



