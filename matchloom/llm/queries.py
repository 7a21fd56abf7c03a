"""The queries of this package, each with its SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.llm import decontaminate, jaccard_join, lm_score, main_text, mixing, prefix_trie, quality_rules, suffix_dedup, token_edits, url_filter, warc, weak_labels, word_runs
from matchloom.llm.common import table
from matchloom.session import scratch_path

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM p),
o AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, lengths WHERE len(w) >= n)),
m AS (SELECT o.r, o.n, o.i, p.item_id FROM o JOIN p ON o.n = p.n AND o.s = p.s),
h AS (
  SELECT r, count(DISTINCT k) AS n_hit
  FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS k FROM (SELECT DISTINCT r, n, i FROM m)) GROUP BY r),
t AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""


@query("op3_decontaminate", OP3_SQL)
def op3_decontaminate(spark, sf_dir):
    """Which words of each document lie in a benchmark window, and whose."""
    return decontaminate.digest(decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


OP5_SQL = r"""
WITH s AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
u AS (
  SELECT *, (CAST(CAST('0x' || substr(md5(concat_ws(':', 'mix-1', coalesce(CAST(doc_id AS VARCHAR), '-'), CAST(size AS VARCHAR))), 1, 13)
             AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0 AS u FROM s),
t AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS total, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM s GROUP BY source),
w AS (
  SELECT *, CAST((r - 1) % 3 + 1 AS DOUBLE) AS weight, CAST(3 * total AS DOUBLE) AS cap, CAST(sum(total) OVER () AS DOUBLE) AS a FROM t),
f AS (
  SELECT *, sum(weight) OVER (ORDER BY cap / weight, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS o,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled FROM w),
g AS (SELECT *, cap * o < weight * (a - filled) AS is_full FROM f),
h AS (
  SELECT *, a - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (), 0) AS l, sum(CASE WHEN NOT is_full THEN weight END) OVER () AS among FROM g),
k AS (SELECT source, total, CASE WHEN is_full THEN cap ELSE weight * l / among END AS target FROM h),
c AS (SELECT *, CASE WHEN total > 0 THEN floor(target / total) ELSE 0 END AS whole FROM k),
p AS (
  SELECT u.doc_id, u.size, c.total, c.target, c.whole, c.target - c.whole * c.total AS rest,
         coalesce(sum(u.size) OVER (PARTITION BY u.source ORDER BY u.u, u.doc_id, u.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, total AS source_size, target,
       CAST(size * (whole + CASE WHEN total > 0 AND target / total > whole AND before + size / 2.0 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM p
"""


@query("op5_mix_sources", OP5_SQL)
def op5_mix_sources(spark, sf_dir):
    """How many words of each document the mix of all sources takes."""
    return mixing.mix(table(spark, sf_dir, "documents"))


OP2_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha1(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND n >= 1000
"""


@query("op2_warc_archives", OP2_SQL)
def op2_warc_archives(spark, sf_dir):
    """Each page as it comes back from compressed archives."""
    return warc.round_trip(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


@query("op6_main_text")
def op6_main_text(spark, sf_dir):
    """The main text of each page."""
    return main_text.main_texts(table(spark, sf_dir, "pages"))


@query("op10_quality_rules")
def op10_quality_rules(spark, sf_dir):
    """Counts and verdict for each document."""
    return quality_rules.outliers(quality_rules.text_counts(table(spark, sf_dir, "documents"))).drop("lang", "source")


@query("op7_weak_label_classifier")
def op7_weak_label_classifier(spark, sf_dir):
    """Chances of each document to be poor or toxic, and whether it is kept."""
    return weak_labels.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_jaccard_join")
def op9_jaccard_join(spark, sf_dir):
    """Size of each document's shingle set and the smallest id it is linked with."""
    return jaccard_join.grouped(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op8_suffix_dedup")
def op8_suffix_dedup(spark, sf_dir):
    """What remains of each document without byte strings that occur earlier."""
    return suffix_dedup.removed(table(spark, sf_dir, "documents"))


@query("op1_token_counts")
def op1_token_counts(spark, sf_dir):
    """Token counts of each document before and after a series of edits."""
    import public_tokenizers  # beside the vocabulary files; only this query needs it

    docs = token_edits.with_trial_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
    ranks = token_edits.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return token_edits.counts_after_edits(docs, ranks, public_tokenizers.PATTERN)


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT r, w, unnest(generate_series(1, len(w))) AS i FROM d),
g AS (
  SELECT r, i, w[i] AS a1, CASE WHEN i >= 2 THEN w[i - 1] || ' ' || w[i] END AS a2,
         CASE WHEN i >= 3 THEN w[i - 2] || ' ' || w[i - 1] || ' ' || w[i] END AS a3,
         CASE WHEN i >= 2 THEN w[i - 1] END AS b1, CASE WHEN i >= 3 THEN w[i - 2] || ' ' || w[i - 1] END AS b2 FROM p),
o1 AS (SELECT r, a1 AS g, count(*) AS c FROM g GROUP BY ALL),
o2 AS (SELECT r, a2 AS g, count(*) AS c FROM g WHERE a2 IS NOT NULL GROUP BY ALL),
o3 AS (SELECT r, a3 AS g, count(*) AS c FROM g WHERE a3 IS NOT NULL GROUP BY ALL),
c1 AS (SELECT r, g, sum(c) OVER (PARTITION BY g) - c AS c FROM o1),
c2 AS (SELECT r, g, sum(c) OVER (PARTITION BY g) - c AS c FROM o2),
c3 AS (SELECT r, g, sum(c) OVER (PARTITION BY g) - c AS c FROM o3),
n AS (SELECT r, sum(len(w)) OVER () - len(w) AS c FROM d),
s AS (
  SELECT g.r, least(i - 1, 2) AS ctx, x3.c AS t3, y2.c AS u2, x2.c AS t2, y1.c AS u1, x1.c AS t1, n.c AS total
  FROM g JOIN n ON n.r = g.r
  LEFT JOIN c1 x1 ON x1.r = g.r AND x1.g = a1 LEFT JOIN c1 y1 ON y1.r = g.r AND y1.g = b1
  LEFT JOIN c2 x2 ON x2.r = g.r AND x2.g = a2 LEFT JOIN c2 y2 ON y2.r = g.r AND y2.g = b2
  LEFT JOIN c3 x3 ON x3.r = g.r AND x3.g = a3),
v AS (
  SELECT r, CASE WHEN t3 > 0 THEN 3 WHEN t2 > 0 THEN 2 WHEN t1 > 0 THEN 1 ELSE 0 END = ctx + 1 AS is_full,
         CASE WHEN t3 > 0 THEN ln(t3) - ln(u2) WHEN t2 > 0 THEN ln(t2) - ln(u1) + (ctx - 1) * ln(0.4)
              WHEN t1 > 0 THEN ln(t1) - ln(total) + ctx * ln(0.4) ELSE (ctx + 1) * ln(0.4) - ln(total + 1) END AS x FROM s),
t AS (SELECT r, count(*) AS n, count(*) FILTER (WHERE is_full) AS n_full, sum(x) AS x FROM v GROUP BY r)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_words, CAST(coalesce(n_full, 0) AS BIGINT) AS n_full,
       round(coalesce(x, 0), 4) AS log_score, round(x / n, 4) AS mean_log
FROM d LEFT JOIN t USING (r)
"""


@query("op4_backoff_scores", OP4_SQL)
def op4_backoff_scores(spark, sf_dir):
    """Each document's score under the n-gram counts of all other documents."""
    scores = lm_score.score(table(spark, sf_dir, "documents"), leave_one_out=True)
    return scores.withColumns({c: F.round(c, 4) for c in ("log_score", "mean_log")})


_URL_ORDERS = ",\n".join(
    f"""
c{k} AS (SELECT m, y, (g // 39) % {39**k} AS ctx, g % 39 AS s, sum(n) AS n FROM spread GROUP BY ALL),
t{k} AS (SELECT m, y, ctx, sum(n) AS total, count(*) AS kinds FROM c{k} GROUP BY ALL),
"""
    + (
        """p0 AS (
  SELECT e.m, e.y, 0 AS ctx, e.s, (coalesce(c.n, 0) + 1) / CAST(coalesce(t.total, 0) + 39 AS DOUBLE) AS p
  FROM every e LEFT JOIN c0 c ON c.m = e.m AND c.y = e.y AND c.s = e.s LEFT JOIN t0 t ON t.m = e.m AND t.y = e.y)"""
        if k == 0
        else f"""k{k} AS (SELECT DISTINCT m, ctx FROM t{k} WHERE total >= 8),
p{k} AS (
  SELECT e.m, e.y, x.ctx, e.s,
         CASE WHEN t.total >= 8 THEN (coalesce(c.n, 0) + t.kinds * l.p) / CAST(t.total + t.kinds AS DOUBLE) ELSE l.p END AS p
  FROM every e JOIN k{k} x ON x.m = e.m
  JOIN p{k - 1} l ON l.m = e.m AND l.y = e.y AND l.s = e.s AND l.ctx = x.ctx % {39 ** (k - 1)}
  LEFT JOIN c{k} c ON c.m = e.m AND c.y = e.y AND c.s = e.s AND c.ctx = x.ctx
  LEFT JOIN t{k} t ON t.m = e.m AND t.y = e.y AND t.ctx = x.ctx)"""
    )
    + f""",
w{k} AS (
  SELECT a.m, a.ctx, a.s, CAST(least(greatest(floor((ln(a.p) - ln(r.p)) * 1e6 + 0.5), -20000000), 20000000) AS BIGINT) AS w
  FROM p{k} a JOIN p{k} r ON a.y = 1 AND r.y = 0 AND a.m = r.m AND a.ctx = r.ctx AND a.s = r.s)"""
    for k in range(4)
)

OP13_SQL = rf"""
WITH u AS (
  SELECT page_id, row_number() OVER () AS r, coalesce(url, '') AS raw, strpos(coalesce(url, ''), '://') AS pos FROM pages),
v AS (SELECT page_id, r, CASE WHEN pos > 0 THEN substr(raw, pos + 3) ELSE raw END AS x, CASE WHEN pos > 0 THEN substr(raw, pos + 3) ELSE '' END AS rest FROM u),
h AS (
  SELECT page_id, r, x, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM v),
rules AS (SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) t(verdict, h, p)),
fit AS (
  SELECT r, arg_max(verdict, length(rules.h || p)) AS verdict, arg_max(rules.h || p, length(rules.h || p)) AS rule
  FROM h JOIN rules ON (host = rules.h OR ends_with(host, '.' || rules.h)) AND starts_with(path, p) GROUP BY r),
d AS (
  SELECT h.*, fit.verdict, fit.rule, CAST(verdict = 'allow' AS INT) AS y, strpos('0123456789abcdef', substr(md5(x), 1, 1)) % 2 AS half
  FROM h LEFT JOIN fit USING (r)),
q AS (SELECT r, y, half, x, unnest(generate_series(1, length(x) + 1)) AS i FROM d WHERE length(x) > 0),
z AS (
  SELECT r, y, half, i,
         CASE WHEN i > length(x) THEN 0 WHEN c BETWEEN 97 AND 122 THEN c - 96 WHEN c BETWEEN 65 AND 90 THEN c - 64 WHEN c BETWEEN 48 AND 57 THEN 27
              WHEN strpos('/.-_?=&%:#', substr(x, i, 1)) > 0 THEN 27 + strpos('/.-_?=&%:#', substr(x, i, 1)) ELSE 38 END AS s
  FROM (SELECT *, unicode(substr(x, i, 1)) AS c FROM q)),
g AS (
  SELECT r, y, half, CAST(s + 39 * coalesce(lag(s, 1) OVER o, 0) + 1521 * coalesce(lag(s, 2) OVER o, 0) + 59319 * coalesce(lag(s, 3) OVER o, 0) AS BIGINT) AS g
  FROM z WINDOW o AS (PARTITION BY r ORDER BY i)),
spread AS (SELECT m, y, g, count(*) AS n FROM g, (VALUES (0), (1), (2)) t(m) WHERE y IS NOT NULL AND m != half GROUP BY ALL),
every AS (SELECT m, y, s FROM (VALUES (0), (1), (2)) a(m), (VALUES (0), (1)) b(y), range(39) c(s)),
{_URL_ORDERS},
f AS (SELECT r, y, g, CASE WHEN y IS NULL THEN 2 ELSE half END AS m FROM g),
scored AS (
  SELECT f.r, f.y, CAST(floor(sum(coalesce(w3.w, w2.w, w1.w, w0.w)) / (count(*) * CAST(1000.0 AS DOUBLE))) AS BIGINT) AS score
  FROM f LEFT JOIN w3 ON w3.m = f.m AND w3.s = f.g % 39 AND w3.ctx = f.g // 39
  LEFT JOIN w2 ON w2.m = f.m AND w2.s = f.g % 39 AND w2.ctx = (f.g // 39) % 1521
  LEFT JOIN w1 ON w1.m = f.m AND w1.s = f.g % 39 AND w1.ctx = (f.g // 39) % 39
  LEFT JOIN w0 ON w0.m = f.m AND w0.s = f.g % 39
  GROUP BY f.r, f.y),
n AS (SELECT score, sum(y) AS a, sum(1 - y) AS b FROM scored WHERE y IS NOT NULL GROUP BY score),
cut AS (
  SELECT arg_min(score, (err, abs(score), score)) AS least FROM (
    SELECT greatest(least(0, score), coalesce(lag(score) OVER (ORDER BY score) + 1, least(0, score))) AS score,
           coalesce(sum(a) OVER o, 0) / CAST(sum(a) OVER () AS DOUBLE)
                  + (sum(b) OVER () - coalesce(sum(b) OVER o, 0)) / CAST(sum(b) OVER () AS DOUBLE) AS err,
           sum(a) OVER () AS a_all, sum(b) OVER () AS b_all
    FROM n WINDOW o AS (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE a_all > 0 AND b_all > 0)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN score < least THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN rule IS NULL THEN score END AS score
FROM d LEFT JOIN scored USING (r) CROSS JOIN cut
"""


@query("op13_url_filter", OP13_SQL)
def op13_url_filter(spark, sf_dir):
    """Host, path, rule and verdict of each page's url."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


OP12_SQL = """
WITH bits AS (
  SELECT list(v ORDER BY i) AS crc FROM (
    SELECT i, list_reduce([CAST(i AS BIGINT), 1, 1, 1, 1, 1, 1, 1, 1],
                          lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a >> 1, CAST(3988292384 AS BIGINT)) ELSE a >> 1 END) AS v FROM range(256) t(i))),
t AS (
  SELECT conv_id, turn, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS d,
         CAST(length(coalesce(text, '')) AS BIGINT) AS z FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list(struct_pack(d := d, z := z) ORDER BY turn NULLS FIRST, d) AS ts FROM t GROUP BY conv_id),
h AS (
  SELECT conv_id, ts, conv_id - conv_id % 100 AS base,
         xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(unicode(c) AS BIGINT))),
                         lambda a, x: xor(a >> 8, crc[(xor(a, x) & 255) + 1])), CAST(4294967295 AS BIGINT)) % 6 AS n
  FROM o, bits),
r AS (SELECT h.conv_id, list_concat(coalesce(b.ts[1 : n], []), h.ts[n + 1 :]) AS ts FROM h LEFT JOIN o b ON b.conv_id = base),
p AS (SELECT conv_id, len(ts) AS n, d, ts[1 : d] AS p, ts[d].z AS z FROM (SELECT *, unnest(generate_series(0, len(ts))) AS d FROM r)),
v AS (
  SELECT p, d, any_value(z) AS z, min(conv_id) AS f, count(*) AS n,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends FROM p GROUP BY p, d),
c AS (SELECT p[1 : d - 1] AS p, count(*) AS k FROM v WHERE d > 0 GROUP BY 1),
w AS (SELECT v.*, coalesce(k, 0) AS k FROM v LEFT JOIN c USING (p)),
s AS (
  SELECT p[1 : a] AS p, sum((n - 1) * coalesce(z, 0)) AS saved, count(*) FILTER (k = 0) AS leaves
  FROM (SELECT *, unnest(generate_series(0, d)) AS a FROM w) GROUP BY 1)
SELECT w.f AS conv_id, CAST(w.d AS BIGINT) AS depth, u.f AS parent_conv_id, w.n AS n_convs, CAST(w.k AS BIGINT) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, w.ends AS ends_sha256
FROM w JOIN s ON s.p = w.p LEFT JOIN v u ON w.d > 0 AND u.d = w.d - 1 AND u.p = w.p[1 : w.d - 1]
"""


@query("op12_conversation_trie", OP12_SQL)
def op12_conversation_trie(spark, sf_dir):
    """Each node of the trie of all conversations: who passes it, what lies below it, what it saves."""
    return prefix_trie.conversation_nodes(table(spark, sf_dir, "conversations"))


@query("op11_word_runs")
def op11_word_runs(spark, sf_dir):
    """The runs of each document, a tenth of them made to repeat, and the text without repeats."""
    return word_runs.digest(word_runs.with_trial_repeats(table(spark, sf_dir, "documents")))
