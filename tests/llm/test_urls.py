"""The url filter against a plain version of both models, and on odd rows."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest

from matchloom.llm import url_filter
from matchloom.llm.common import table

from .conftest import SMALL, whole_table


def plain_parts(url):
    scheme, found, rest = (url or "").partition("://")
    text = rest if found else url or ""
    rest = rest if found else ""
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    path = tail[: min((tail.index(c) for c in "?#" if c in tail), default=len(tail))]
    return text, "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [(len(h + p), v, h + p) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def plain_symbols(text):
    if not text:
        return []
    lower = "abcdefghijklmnopqrstuvwxyz"
    names = {c: 1 + i for i, c in enumerate(lower)} | {c: 1 + i for i, c in enumerate(lower.upper())}
    names |= {c: 27 for c in "0123456789"} | {c: 28 + i for i, c in enumerate("/.-_?=&%:#")}
    return [names.get(c, 38) for c in text] + [0]


class PlainModel:
    def __init__(self, texts, order=3, support=8):
        self.seen, self.order, self.support = defaultdict(Counter), order, support
        for text in texts:
            codes = [0] * order + plain_symbols(text)
            for i in range(order, len(codes)):
                for k in range(order + 1):
                    self.seen[tuple(codes[i - k : i])][codes[i]] += 1

    def chance(self, context, symbol):
        seen = self.seen.get(context, Counter())
        if not context:
            return (seen[symbol] + 1) / (seen.total() + 39)
        lower = self.chance(context[1:], symbol)
        if seen.total() < self.support:
            return lower
        return (seen[symbol] + len(seen) * lower) / (seen.total() + len(seen))


def plain_score(good, bad, text):
    codes = [0, 0, 0, *plain_symbols(text)]
    total = 0
    for i in range(3, len(codes)):
        context = tuple(codes[i - 3 : i])
        total += math.floor((math.log(good.chance(context, codes[i])) - math.log(bad.chance(context, codes[i]))) * 1e6 + 0.5)
    return math.floor(total / ((len(codes) - 3) * 1000.0)) if text else None


def plain_judge(pages):
    rows = []
    for page, url in pages:
        text, host, path = plain_parts(url)
        half = "0123456789abcdef".index(hashlib.md5(text.encode()).hexdigest()[0]) + 1
        rows.append((page, text, host, path, *plain_rule(host, path), half % 2))
    def pair(use):
        return [PlainModel([r[1] for r in rows if r[4] == v and use(r)]) for v in ("allow", "block")]
    halves = [pair(lambda r, h=h: r[6] != h) for h in (0, 1)]
    known = [(plain_score(*halves[r[6]], r[1]), r[4] == "allow") for r in rows if r[4] and r[1]]
    n_good, n_bad = sum(g for _, g in known), sum(not g for _, g in known)
    least = None
    if n_good and n_bad:
        least_known, most_known = min(s for s, _ in known), max(s for s, _ in known)
        steps = range(min(least_known, 0), max(most_known, 0) + 1)
        errors = {t: sum(g and s < t for s, g in known) / n_good + sum(not g and s >= t for s, g in known) / n_bad for t in steps}
        least = min(errors, key=lambda t: (errors[t], abs(t), t))
    whole = pair(lambda r: True)
    out = []
    for page, text, host, path, verdict, rule, _ in rows:
        score = None if rule else plain_score(*whole, text)
        own = "block" if score is not None and least is not None and score < least else "allow"
        out.append((page, host, path, rule, verdict or own, score))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_given_pages_like_the_plain_version(spark):
    want = plain_judge([(r["page_id"], r["url"]) for r in whole_table("pages", "/root/testdata/sf0.01")])
    got = url_filter.judge(table(spark, "/root/testdata/sf0.01", "pages")).collect()
    assert order(got) == order(want)
    ruleless = [r for r in got if r["rule"] is None]
    assert {r["verdict"] for r in ruleless} == {"allow", "block"}


ODD = [
    (1, "HTTP://A.NET/x?y=1#z", "p"),
    (2, "https://b.example.net/en/story-1", "p"),
    (3, "https://b.example.net/en", None),  # the rule's path is longer
    (4, "https://example.com/de/1", "p"),
    (5, "https://myexample.com/de/1", "p"),  # no subdomain
    (6, "https://fr.org/fr/?q=://", "p"),
    (7, "https://net/", "p"),
    (8, "https://a.net", "p"),  # its path is empty
    (9, None, "p"),
    (10, "", "p"),
    (11, "no scheme at all", "p"),
    (12, "://", "p"),
    (None, "https://é中文.example/ü\n" + "x" * 200_000, "p"),
    (13, "https://a.net/twice", "p"),
    (13, "https://a.net/twice", "p"),
    (14, "https://x.org/fr/" + "%20" * 1000, "p"),
]


@pytest.fixture(scope="module")
def odd_pages(spark):
    # names that the operator uses inside
    rows = [(*r, 1, "t", 5, 0.5) for r in ODD]
    return spark.createDataFrame(rows, "page_id long, url string, rule string, _model int, _text string, score int, host double")


def test_odd_rows_like_the_plain_version(odd_pages):
    got = {str(tuple(r)) for r in url_filter.judge(odd_pages).collect()}
    assert got == {str(r) for r in plain_judge([r[:2] for r in ODD])}


def test_hosts_paths_and_rules(odd_pages):
    got = {r["page_id"]: r for r in url_filter.judge(odd_pages).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("a.net", "/x", "net/", "block")
    assert (got[2]["rule"], got[2]["verdict"]) == ("example.net/en/", "allow")
    assert [got[i]["rule"] for i in (3, 4, 5, 6, 7, 8)] == ["net/", "example.com/de/", None, "org/fr/", "net/", None]
    assert all((got[i]["host"], got[i]["path"], got[i]["rule"]) == ("", "", None) for i in (9, 10, 11, 12))
    assert got[9]["verdict"] == got[10]["verdict"] == got[12]["verdict"] == "allow"


def test_no_pages_and_one_kind_only(spark, odd_pages):
    assert url_filter.judge(odd_pages.limit(0)).count() == 0
    good = spark.createDataFrame([(1, "https://a.org/fr/1"), (2, "https://b.org/en/1")], "page_id long, url string")
    assert {r["verdict"] for r in url_filter.judge(good).collect()} == {"allow"}


def test_models_tell_unseen_urls_apart(spark):
    """Urls of either kind that no rule decides, of the same pattern as the ruled ones."""
    rows = [(i, f"https://s{i}.org/fr/garden-{i}-roses") for i in range(200)] + [(200 + i, f"https://s{i}.net/casino-{i}-bonus") for i in range(200)]
    rows += [(1000 + i, f"https://t{i}.info/garden-{i}-roses") for i in range(50)] + [(2000 + i, f"https://t{i}.info/casino-{i}-bonus") for i in range(50)]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert all(got[1000 + i] == "allow" and got[2000 + i] == "block" for i in range(50))


def test_native_plan(spark):
    plan = url_filter.judge(table(spark, SMALL, "pages"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
