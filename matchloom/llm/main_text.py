"""Main text of web pages by consensus of their host.

Every page's containers are scored by the text of their paragraphs, less link text; the best one votes for
its path of tags and classes (digits generalised). Spark counts the votes per host and joins them to the
paths each page has; the page is then extracted again by the one with most votes. A page without any of them,
and a page whose host has no vote, falls back on its own best container.

Known boilerplate is left out at any place: menus, headers and footers of the site, sidebars, notices, adverts,
forms, scripts, styles and reader comments, told by tag, role or the words in class and id. A class that is such a word
(comments, ad) leaves its element out, but no article unless it is a comment. A name of several words counts if it
names a part of boilerplate (ad-banner, comment-list), not if it only touches on it (has-comments, ad-free). Such parts,
words of layout (sidebar, widget, share, ...), forms and asides also wrap whole pages: these are left out only if they, with
all others of the same words that they do not lie in, hold less than half of the page's unlinked text. White space inside a block
becomes one space; blocks follow in page order. The work grows with the page, not with its depth.

Cases: a null or empty page gives an empty text; a null address is a host of its own; broken markup (open tags,
stray ends, a page cut inside a tag) is read as far as it goes; repeated pages vote as often as they occur; an
empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import store

LEAST_SHARE = 0.1  # votes of a path against those of its host's best path
SEMANTIC = 1.5
HINTED = 1.25

# Names of HTML elements and common words of class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg iframe textarea title object canvas audio video math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var label nobr picture".split()
)
CONTAINERS = frozenset("body main article section div td center".split())
DROPPED = frozenset("nav footer dialog select button fieldset head".split())
OFTEN_WRAPPERS = frozenset("aside form menu".split())  # dropped where they hold the minor part of the text
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section table ul".split()
)
OWN_KIND = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
P_SCOPE = frozenset("body article aside blockquote div dl dd dt figure footer form header li main nav ol section table td th tr ul".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NOISE = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored promo promotion comment comments disqus "
    "respond reply replies nav navbar navigation menu breadcrumb breadcrumbs toolbar pagination pager".split()
)
COMMENTS = frozenset("comment comments disqus respond reply replies".split())
PARTS = frozenset(
    "area bar banner block body bottom box container content count footer form group header holder inner item items left link links list "
    "menu outer panel right row section slot thread title top trail unit wrap wrapper".split()
)
DENIALS = frozenset("has is no not show with without".split())
LAYOUT = frozenset(
    "sidebar footer masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations widget widgets hidden copyright disclaimer alert".split()
)
HINTS = frozenset("article content post entry story main text body".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(?i)(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


LONGEST_PATH = 2000  # characters; a longer path goes on from its hash


def noise_kind(name: str) -> str:
    """Whether a class or id is a word for boilerplate itself (own), names a part of boilerplate (part), or neither: a name
    that only touches on it (has-comments, ad-free, advertising-history) does not speak against its element."""
    words = [w.lower() for w in WORD.findall(name)]
    if not words or not NOISE.intersection(words):
        return ""
    if len(words) == 1:
        return "own"
    if words[0] in DENIALS:
        return ""
    return "part" if words[-1] in NOISE or words[-1] in PARTS and any(w in NOISE for w in words[:-1]) else ""


class Page:
    """Containers and text pieces of one page."""

    def __init__(self, source: str) -> None:
        # Of each node: tag, path, parent, first piece, piece after the last, left out by tag, by class, holds the main part
        self.tags: list[str] = ["body"]
        self.paths: list[str] = ["body"]
        self.parents: list[int] = [-1]
        self.spans: list[list[int]] = [[0, 0]]
        self.out: list[str] = [""]
        self.layout: dict[int, frozenset[str]] = {}  # words of layout, of the nodes that have any
        self.main: list[bool] = [False]
        self.hinted: list[bool] = [False]
        self.pieces: list[tuple[int, str, bool]] = []  # node, text, inside a link
        self.stack = [0]
        self.open: Counter[str] = Counter()  # tags of the open nodes
        self.inside: list[bool] = [False]  # within an article or the main part
        self._read(source)
        while len(self.stack) > 1:
            self._pop()
        self.spans[0][1] = len(self.pieces)

    def _pop(self) -> None:
        node = self.stack.pop()
        self.open[self.tags[node]] -= 1
        self.pieces.append((self.stack[-1], " ", False))
        self.spans[node][1] = len(self.pieces)

    def _close_to(self, kinds, stop) -> None:
        if not any(self.open[kind] for kind in kinds):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.tags[self.stack[depth]]
            if tag in kinds:
                while len(self.stack) > depth:
                    self._pop()
                return
            if tag in stop:
                return

    def _read(self, source: str) -> None:
        at, links = 0, 0
        while at < len(source):
            found = TOKEN.search(source, at)
            text = source[at : found.start()] if found else source[at:]
            if text:
                self.pieces.append((self.stack[-1], html.unescape(text) if "&" in text else text, links > 0))
            if not found:
                return
            at = found.end()
            if (name := found[2] or found[5]) is None:
                continue
            tag, closing = name.lower(), found[1] or found[4]
            if tag in VOID:
                if tag in ("br", "hr"):
                    self.pieces.append((self.stack[-1], " ", False))
            elif tag in RAW:
                if not closing and not (found[3] or found[6] or "").rstrip().endswith("/"):
                    end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                    at = end.end() if end else len(source)
            elif tag in INLINE:
                if tag == "a":
                    links = 0 if closing else 1
            elif closing:
                links = 0
                self._close_to({tag}, ())
            elif tag not in ("html", "body"):
                links = 0
                self._open(tag, found[3] or found[6] or "")

    def _open(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P:
            self._close_to({"p"}, P_SCOPE)
        elif tag in OWN_KIND:
            self._close_to(*OWN_KIND[tag])
        given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes.strip() else {}
        names = f"{given.get('class', '')} {given.get('id', '')}".split()
        words = {w.lower() for name in names for w in WORD.findall(name)}
        kinds = {kind for name in names if (kind := noise_kind(name))} if words & NOISE else set()
        parent, node = self.stack[-1], len(self.tags)
        inside, out, minor = self.inside[parent], "", set(words & LAYOUT)
        if tag in DROPPED or tag == "header" and not inside:
            out = "tag"
        elif given.get("role", "").lower() in ROLES or given.get("aria-hidden") == "true" or "hidden" in given:
            out = "tag"
        elif re.search(r"display\s*:\s*none", given.get("style", "")):
            out = "tag"
        elif "own" in kinds and (tag not in ("main", "h1", "article") or tag == "article" and words & COMMENTS):
            out = "class"
        if tag in OFTEN_WRAPPERS:
            minor.add(tag)
        if "part" in kinds:
            minor |= words & NOISE
        if "header" in words and not inside:
            minor.add("header")
        if minor and not out and tag not in ("main", "h1", "article"):
            self.layout[node] = frozenset(minor)
        if tag in ("main", "h1"):
            for k in reversed(self.stack):
                if self.main[k]:
                    break
                self.main[k] = True
        classes = ".".join(sorted(set(re.sub(r"\d+", "#", given.get("class", "")).split())))
        self.pieces.append((parent, " ", False))
        self.tags.append(tag)
        path = f"{self.paths[parent]}>{tag}{'.' + classes if classes else ''}"
        self.paths.append(path if len(path) <= LONGEST_PATH else "~" + hashlib.md5(path.encode()).hexdigest())
        self.parents.append(parent)
        self.spans.append([len(self.pieces), 0])
        self.out.append(out)
        self.main.append(False)
        self.inside.append(inside or tag in ("article", "main"))
        self.open[tag] += 1
        self.hinted.append(bool(words & HINTS))
        self.stack.append(node)

    def left_out(self) -> list[bool]:
        """Whether a node or what holds it is boilerplate; a class does not speak against the main part."""
        out = []
        for k, parent in enumerate(self.parents):
            own = self.out[k] == "tag" or self.out[k] == "class" and not self.main[k]
            out.append(own or parent >= 0 and out[parent])
        if self.layout and (minor := self.minor_layout(out)):
            for k, parent in enumerate(self.parents):
                out[k] = out[k] or k in minor or parent >= 0 and out[parent]
        return out

    def minor_layout(self, out: list[bool]) -> set[int]:
        """Nodes with words of layout that hold less than half of the unlinked text, also all of the same words together; a
        wrapper of others does not count with them."""
        size = [0] * len(self.tags)
        for node, text, link in self.pieces:
            if not link and not out[node]:
                size[node] += len(text.strip())
        for k in range(len(size) - 1, 0, -1):  # a node follows its parent
            size[self.parents[k]] += size[k]
        marked = {k: words for k, words in self.layout.items() if not out[k] and not self.main[k]}

        above: dict[int, int] = {}  # the next node up that carries the same words
        open_: dict[frozenset[str], list[int]] = {}
        for k in sorted(marked):
            same = open_.setdefault(marked[k], [])
            while same and self.spans[same[-1]][1] <= self.spans[k][0]:
                same.pop()
            if same:
                above[k] = same[-1]
            same.append(k)
        wrappers = {h for h in above.values() if 2 * size[h] >= size[0]}
        together: dict[frozenset[str], int] = {}
        for k, words in marked.items():
            if k not in wrappers and (k not in above or above[k] in wrappers):  # the outermost below any wrapper
                together[words] = together.get(words, 0) + size[k]
        return {k for k, words in marked.items() if 2 * size[k] < size[0] and 2 * together.get(words, 0) < size[0]}

    def best(self, out: list[bool]) -> int:
        """The container with the highest score; the page's body if there is none."""
        score = [0.0] * len(self.tags)
        total, linked = [0] * len(self.tags), [0] * len(self.tags)
        # The nearest container of each node, itself included, and the one that holds that.
        near = [k if tag in CONTAINERS else -1 for k, tag in enumerate(self.tags)]
        for k, parent in enumerate(self.parents):
            if near[k] < 0 and parent >= 0:
                near[k] = near[parent]
        for node, text, link in self.pieces:
            if out[node] or not (size := len(text.strip())):
                continue
            total[node] += size
            linked[node] += size if link else 0
            if not link and (first := near[node]) >= 0:
                score[first] += size
                if self.parents[first] >= 0 and (second := near[self.parents[first]]) >= 0:
                    score[second] += size / 2
        for k in range(len(total) - 1, 0, -1):  # a node follows its parent
            total[self.parents[k]] += total[k]
            linked[self.parents[k]] += linked[k]
        whole = next((k for k, tag in enumerate(self.tags) if tag in ("article", "main") and not out[k] and 2 * (total[k] - linked[k]) > total[0] - linked[0]), None)
        if whole is not None:
            inner = [k for k in range(whole + 1, len(self.tags)) if self.tags[k] == "article" and self.spans[k][1] <= self.spans[whole][1] and not out[k]]
            return inner[0] if self.tags[whole] == "main" and len(inner) == 1 else whole
        for k, tag in enumerate(self.tags):
            if tag in CONTAINERS and total[k]:
                score[k] *= (1 - linked[k] / total[k]) * (SEMANTIC if tag in ("article", "main") else 1) * (HINTED if self.hinted[k] else 1)
        return max(range(len(score)), key=lambda k: (score[k], -k))

    def text(self, nodes: list[int], out: list[bool]) -> str:
        """Text of the nodes' subtrees without what is left out inside them."""
        parts = []
        for first, last in (self.spans[k] for k in nodes):
            parts.append(" ")
            parts += [text for node, text, _ in self.pieces[first:last] if not out[node] or text == " "]
        return " ".join("".join(parts).split())


def vote(source: str | None) -> tuple[str, list[str]]:
    """The path of the page's best container, empty for a page without text; the paths of all containers with text."""
    page = Page(source or "")
    out = page.left_out()
    k = page.best(out)
    full = set()
    for node, text, _ in page.pieces:
        if not out[node] and text.strip():
            while node >= 0 and node not in full:
                full.add(node)
                node = page.parents[node]
    return page.paths[k] if page.text([k], out) else "", sorted({page.paths[n] for n in full if page.tags[n] in CONTAINERS})


def extract(source: str | None, paths: list[str] | None) -> str:
    """The text of the containers on the first of ``paths`` that gives any, else of the page's best one."""
    page = Page(source or "")
    out = page.left_out()
    for path in paths or []:
        nodes, end = [], -1
        for k, own in enumerate(page.paths):
            if own == path and not out[k] and page.spans[k][0] >= end:
                nodes.append(k)
                end = page.spans[k][1]
        if nodes and (text := page.text(nodes, out)):
            return text
    return page.text([page.best(out)], out)


def host(url: str = "url") -> F.Column:
    return F.coalesce(F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def chosen_paths(pages: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """Rows (_host, _digest, _path): of the paths with at least ``least_share`` of the host's highest vote, the one with
    most votes that a page has; one row per host and content, none for pages without such a path."""

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [vote(x) for x in batch.column("html").to_pylist()]
            columns = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("_host"), batch.column("_digest"), *columns], names=["_host", "_digest", "_vote", "_paths"])

    # Written, so that votes and paths come from one reading of the pages.
    read = store(pages.select("_host", "_digest", "html").mapInArrow(votes, "_host string, _digest string, _vote string, _paths array<string>"), "votes")
    counted = read.where("_vote <> ''").groupBy("_host", F.col("_vote").alias("_path")).agg(F.count("*").alias("n"))
    most = counted.groupBy("_host").agg(F.max("n").alias("most"))
    near = counted.join(most, "_host").where(F.col("n") >= least_share * F.col("most")).drop("most")
    # Written, so that its size is known: few paths are broadcast, many are joined by a shuffle that may be split.
    winners = store(near, "paths")
    own = read.select("_host", "_digest", F.explode("_paths").alias("_path"))
    first = F.min(F.struct((-F.col("n")).alias("n"), "_path"))
    return own.join(winners, ["_host", "_path"]).groupBy("_host", "_digest").agg(first["_path"].alias("_path"))


def main_texts(pages: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """Rows (page_id, url, text, n_chars), one per page."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [extract(x, None if p is None else [p]) for x, p in zip(batch.column("html").to_pylist(), batch.column("_path").to_pylist())]
            sizes = pa.array([len(x) for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])

    digest = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    rows = pages.select("page_id", "url", "html").withColumns({"_host": host(), "_digest": digest})
    chosen = store(chosen_paths(rows, least_share), "chosen")
    kind = pages.schema["page_id"].dataType.simpleString()
    joined = rows.join(chosen, ["_host", "_digest"], "left").select("page_id", "url", "html", "_path")
    return joined.mapInArrow(texts, f"page_id {kind}, url string, text string, n_chars long")
