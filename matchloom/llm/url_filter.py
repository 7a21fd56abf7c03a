"""URL filter: rules where one fits, else a ratio of two character language models. DataFrame functions only.

Urls that a rule allows train one model, those that a rule blocks the other. Both are Markov models of variable order
over a folded alphabet (letters, one digit, some signs, one symbol for all else, one for either end): the context of a
symbol is the longest one, up to ``ORDER`` symbols, that its model has seen ``MIN_SUPPORT`` times, and each
order is smoothed by the next lower one after Witten and Bell. A url's score is the sum of log ratios over its symbols
divided by their number, in thousandths of a nat.

The threshold is calibrated on urls that the scoring model has not seen: two more pairs of models leave out
one half of the urls each and score it, and the threshold is that with the least sum of both error rates (the one nearest
to 0 of equals). A url is blocked below it. Equal urls are in one half.

Sizes: every table of a model is bounded by the alphabet (39 symbols: at most 3 * 39 ** 3 contexts of 39 ratios), so
the broadcast is bounded by 28 MB however many urls there are. Urls are read twice for training and calibration
and once for judging; only counts are shuffled, after partial sums.

Cases: a null url, or one without ``://``, has an empty host and path and fits no rule; its text as a whole is judged;
an empty text is allowed; if either kind of training url is missing, nothing can be told apart and all that no
rule blocks is allowed; repeated rows count as often as they occur and are judged alike; columns other than page_id and url are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import store

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SIGNS = "/.-_?=&%:#"
SYMBOLS = 1 + 26 + 1 + len(SIGNS) + 1  # ends, letters, digit, signs, others
ORDER = 3
MIN_SUPPORT = 8
LIMIT = 20_000_000  # millionths of a nat: no single symbol may say more
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALL, BOTH = 2, (0, 1)  # the model of all urls; those that leave out a half


def symbol_table() -> list[int]:
    """The symbol of each ASCII code."""
    others = SYMBOLS - 1
    known = {ord(c): 1 + i for i, c in enumerate(LOWER)} | {ord(c): 1 + i for i, c in enumerate(UPPER)}
    known |= {ord(c): 27 for c in "0123456789"} | {ord(c): 28 + i for i, c in enumerate(SIGNS)}
    return [known.get(code, others) for code in range(128)]


def parts(url: str = "url") -> dict[str, Column]:
    """Text after the scheme (or all of it), host and path of a url."""
    raw = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(raw, "://")
    rest = F.when(at > 0, F.substring(raw, at + F.lit(3), F.length(raw))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return {"_text": F.when(at > 0, rest).otherwise(raw), "host": host, "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)}


def ruled(rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """The verdict and name of the longest rule that fits ``host`` and ``path``, else null."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(host + path).alias("rule"))).otherwise(found)
    return found


def symbols(text: str = "_text") -> Column:
    """The symbols of a text and the end; nothing for an empty text."""
    table = F.expr(f"array({', '.join(map(str, symbol_table()))})")
    codes = F.transform(F.split(F.col(text), ""), lambda c: F.coalesce(F.get(table, F.ascii(c)), F.lit(SYMBOLS - 1)))
    return F.when(F.length(text) > 0, F.concat(codes, F.array(F.lit(0)))).otherwise(F.array().cast("array<int>"))


def grams(codes: Column, order: int = ORDER) -> Column:
    """Each symbol with the ``order`` ones before it, as one number."""

    def gram(x: Column, i: Column) -> Column:
        before = [F.coalesce(F.get(codes, i - k), F.lit(0)) * SYMBOLS**k for k in range(1, order + 1)]
        return reduce(lambda a, b: a + b, before, x)

    return F.transform(codes, gram)


def labelled(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """Texts of urls that a rule decides: _good (1 allowed, 0 blocked) and _half (0 or 1, by a digest of the text)."""
    rows = pages.select(F.col("url")).withColumns(parts()).withColumn("_rule", ruled(rules)).where("_rule is not null")
    half = F.instr(F.lit("0123456789abcdef"), F.substring(F.md5("_text"), 1, 1)) % 2
    return rows.select("_text", (F.col("_rule.verdict") == "allow").cast("int").alias("_good"), half.alias("_half"))


def _listed(counts: str) -> Column:
    """A map of counts as a list with an entry for each symbol."""
    return F.transform(F.sequence(F.lit(0), F.lit(SYMBOLS - 1)), lambda s: F.coalesce(F.col(counts)[s], F.lit(0)).cast("long"))


def _lowest(counts: str, total: str) -> Column:
    """Chances of the lowest order: each symbol counts once more than seen."""
    return F.transform(counts, lambda c: (c + 1) / (F.col(total) + SYMBOLS))


def _mixed(counts: str, total: str, kinds: str, lower: str, support: int) -> Column:
    """Chances of one order: counts smoothed by the lower order, or the lower order where support is too small."""
    smooth = F.zip_with(counts, lower, lambda c, p: (c + F.col(kinds) * p) / (F.col(total) + F.col(kinds)))
    return F.when(F.col(total) >= support, smooth).otherwise(F.col(lower))


def models(examples: DataFrame, order: int = ORDER, support: int = MIN_SUPPORT) -> DataFrame:
    """Rows (_model, _ratios), written: for each context of each order, by ``offset`` of the order plus the context's number,
    the log ratios of all symbols in millionths of a nat, or null where neither model keeps the context."""
    seen = examples.select("_good", "_half", F.explode(grams(symbols(), order)).alias("_gram")).groupBy("_good", "_half", "_gram").count()
    seen = store(seen, "url-grams")
    spread = seen.withColumn("_model", F.explode(F.array(*map(F.lit, (*BOTH, ALL))))).where("_model != _half")
    spread = spread.groupBy("_model", "_good", "_gram").agg(F.sum("count").alias("_n"))
    session = examples.sparkSession
    lower, kept = None, []
    for k in range(order + 1):
        context = F.expr(f"(_gram div {SYMBOLS}) % {SYMBOLS**k}").cast("int").alias("_context")
        by_symbol = spread.groupBy("_model", "_good", context, (F.col("_gram") % SYMBOLS).alias("_symbol")).agg(F.sum("_n").alias("_n"))
        # At most one entry for each symbol of the alphabet.
        lists = {n: F.map_from_entries(F.collect_list(F.when(F.col("_good") == y, F.struct("_symbol", "_n")))) for y, n in ((1, "_a"), (0, "_r"))}
        rows = by_symbol.groupBy("_model", "_context").agg(*(e.alias(n) for n, e in lists.items()))
        if k == 0:
            names = session.range(ALL + 1).select(F.col("id").cast("int").alias("_model"), F.lit(0).alias("_context"))
            rows = names.join(rows, ["_model", "_context"], "left")
        rows = rows.withColumns({n: _listed(n) for n in ("_a", "_r")})
        sums = {f"{n}_total": F.aggregate(n, F.lit(0).cast("long"), lambda x, c: x + c) for n in ("_a", "_r")}
        rows = rows.withColumns(sums | {f"{n}_kinds": F.size(F.filter(n, lambda c: c > 0)) for n in ("_a", "_r")})
        if k == 0:
            rows = rows.withColumns({f"{n}_p": _lowest(n, f"{n}_total") for n in ("_a", "_r")})
        else:
            rows = rows.where((F.col("_a_total") >= support) | (F.col("_r_total") >= support)).withColumn("_suffix", F.col("_context") % SYMBOLS ** (k - 1))
            above = lower.select(F.col("_model").alias("_of"), F.col("_context").alias("_parent"), F.col("_a_p").alias("_a_low"), F.col("_r_p").alias("_r_low"))
            rows = rows.join(above, (F.col("_model") == F.col("_of")) & (F.col("_suffix") == F.col("_parent")))
            rows = rows.withColumns({f"{n}_p": _mixed(n, f"{n}_total", f"{n}_kinds", f"{n}_low", support) for n in ("_a", "_r")})
        lower = store(rows.select("_model", "_context", "_a_p", "_r_p"), f"url-order-{k}")
        ratio = F.zip_with("_a_p", "_r_p", lambda a, r: F.least(F.greatest(F.floor((F.log(a) - F.log(r)) * 1e6 + 0.5), F.lit(-LIMIT)), F.lit(LIMIT)).cast("int"))
        kept.append(lower.select("_model", (F.col("_context") + offset(k)).alias("_place"), ratio.alias("_ratio")))
    places = session.range(offset(order + 1)).select(F.col("id").cast("int").alias("_place"), F.explode(F.array(*map(F.lit, (*BOTH, ALL)))).alias("_model"))
    full = places.join(reduce(DataFrame.unionByName, kept), ["_model", "_place"], "left")
    return store(full.groupBy("_model").agg(F.transform(F.sort_array(F.collect_list(F.struct("_place", "_ratio"))), lambda x: x["_ratio"]).alias("_ratios")), "url-models")


def offset(order: int) -> int:
    """Contexts of all lower orders."""
    return sum(SYMBOLS**k for k in range(order))


def score(codes: str = "_codes", ratios: str = "_ratios", order: int = ORDER) -> Column:
    """Mean log ratio of the symbols in thousandths of a nat; null without symbols."""
    table = F.col(ratios)

    def step(state: Column, x: Column) -> Column:
        found = [F.get(F.get(table, state["context"] % SYMBOLS**k + offset(k)), x) for k in range(order, -1, -1)]
        return F.struct(
            ((state["context"] * SYMBOLS + x) % SYMBOLS**order).alias("context"),
            (state["total"] + F.coalesce(*found, F.lit(0))).alias("total"),
        )

    start = F.struct(F.lit(0).alias("context"), F.lit(0).cast("long").alias("total"))
    total = F.aggregate(codes, start, step, lambda s: s["total"])
    return F.when(F.size(codes) > 0, F.floor(total / (F.size(codes) * F.lit(1000.0))))


def threshold(examples: DataFrame, table: DataFrame, order: int = ORDER) -> DataFrame:
    """One row (_least): the lowest score that is allowed, or null if either kind of url is missing. The scores are whole
    numbers within the limit of one symbol, so the window sorts at most 40 001 rows."""
    scored = examples.select("_good", F.col("_half").alias("_model"), symbols().alias("_codes")).join(F.broadcast(table), "_model")
    counted = scored.select("_good", score(order=order).alias("_score")).where("_score is not null").groupBy("_score").agg(F.sum("_good").alias("_a"), F.sum(1 - F.col("_good")).alias("_r"))
    below = Window.orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    # Every threshold above the last lower score does the same; the one nearest to 0 is taken.
    nearest = F.least(F.lit(0), "_score")
    steps = counted.select(
        F.greatest(nearest, F.coalesce(F.lag("_score").over(Window.orderBy("_score")) + 1, nearest)).alias("_score"),
        F.coalesce(F.sum("_a").over(below), F.lit(0)).alias("_lost"),
        (F.sum("_r").over(every) - F.coalesce(F.sum("_r").over(below), F.lit(0))).alias("_passed"),
        F.sum("_a").over(every).alias("_a_all"),
        F.sum("_r").over(every).alias("_r_all"),
    ).where("_a_all > 0 and _r_all > 0")
    error = F.col("_lost") / F.col("_a_all") + F.col("_passed") / F.col("_r_all")
    return steps.agg(F.min(F.struct(error.alias("error"), F.abs("_score").alias("size"), F.col("_score").alias("score")))["score"].alias("_least"))


def judge(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, order: int = ORDER, support: int = MIN_SUPPORT) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, score), one per page; score is null where a rule decides or the text is empty."""
    examples = labelled(pages, rules)
    table = models(examples, order, support)
    # One row for the model of all urls, with the threshold beside it.
    last = table.where(F.col("_model") == ALL).join(F.broadcast(store(threshold(examples, table, order), "url-threshold")))
    rows = pages.select("page_id", "url").withColumns(parts()).withColumn("_rule", ruled(rules))
    rows = rows.withColumn("_codes", F.when(F.col("_rule").isNull(), symbols())).withColumn("_wants", F.when(F.col("_rule").isNull(), F.lit(ALL)))
    judged = rows.join(F.broadcast(last), F.col("_wants") == F.col("_model"), "left").withColumn("_score", F.when(F.col("_rule").isNull(), score(order=order)))
    own = F.when(F.coalesce(F.col("_score") < F.col("_least"), F.lit(False)), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", own).alias("verdict"), F.col("_score").alias("score"))
