"""Archives and main texts of pages."""

import base64
import hashlib
import struct

import pytest
import zstandard

from matchloom.llm import main_text, warc

ARTICLE = "<p>First paragraph of the story, long enough to count.</p><p>Second one &amp; more&nbsp;text,<br>after a break.</p>"
TEXT = "A title First paragraph of the story, long enough to count. Second one & more text, after a break."


def page(body: str, head: str = "") -> str:
    return f"<!DOCTYPE html><html><head><title>no</title>{head}</head><body>{body}</body></html>"


NOISE = (
    '<header class="top"><a href="/">Site</a><h2>Slogan</h2></header><nav><ul><li><a href=/a>A</a></li></ul></nav>'
    '<div class="cookie-notice">We use cookies</div><!-- ad 1 --><div id="ad_7">Buy <b>now</b></div>'
)
TAIL = (
    '<aside>Aside words</aside><section class="comments"><article><p>First! A reader comment that is fairly long, longer than it should be.</p>'
    "</article></section><form><label>Mail</label><input name=q><button>Send</button></form><footer>&copy; site</footer><script>var t='</p>';</script>"
)


@pytest.mark.parametrize(
    "source, text",
    [
        (page(f"{NOISE}<article><h1>A title</h1>{ARTICLE}</article>{TAIL}"), TEXT),
        (page(f"{NOISE}<main><h1>A title</h1>{ARTICLE}</main>{TAIL}"), TEXT),
        (page(f'{NOISE}<div class="wrap"><div class="post-content"><h1>A title</h1>{ARTICLE}</div></div>{TAIL}'), TEXT),
        (page(f"{NOISE}<article><header><h1>A title</h1></header>{ARTICLE}<div class='ad'>Buy</div></article>{TAIL}"), TEXT),
        (page(f"{NOISE}<article><h1>A title</h1>{ARTICLE.replace('</p>', '')}</article><footer>x"), TEXT),
        (f"<article><h1>A title</h1>{ARTICLE}<div class=", TEXT),
        ("no markup at all,\n just  text", "no markup at all, just text"),
        ("<p>a < b and c<d>e</d></p>", "a < b and c e"),
        ("<article><p>one<style>p{}</style><b>bold</b>er &#x41;&lt;</p><!-- no --><p hidden>gone</p></article>", "onebolder A<"),
        ("", ""),
        (None, ""),
        ("<nav>only a menu</nav>", ""),
    ],
)
def test_own_container(source, text):
    assert main_text.extract(source, None) == text


PLAIN = "<h2>A title</h2><p>First paragraph of the story, long enough to count.</p><p>Second one follows it here.</p>"
PLAIN_TEXT = "A title First paragraph of the story, long enough to count. Second one follows it here."


@pytest.mark.parametrize(
    "body, text",
    [
        (f"<div class='page has-sidebar'>{PLAIN}</div>", PLAIN_TEXT),
        (f"<div class='page has-sidebar'><div class='sidebar'>Read more</div>{PLAIN}<div class='share'>Share it</div></div>", PLAIN_TEXT),
        (f"<article class='post share-enabled'>{PLAIN}</article>", PLAIN_TEXT),
        ("<div>" + "".join(f"<div class='elementor-widget elementor-widget-text-editor'><p>Paragraph {k} of a story.</p></div>" for k in range(4)) + "</div>", " ".join(f"Paragraph {k} of a story." for k in range(4))),
        (f"<div class='widget related'><a href=/x>linked words only</a></div><div class='story'>{PLAIN}</div><div class='footer'>imprint</div>", PLAIN_TEXT),
        (f"<div class='comments'>{PLAIN}</div>", ""),
        ("<div class='hidden'></div>", ""),
    ],
)
def test_layout_words_on_wrappers(body, text):
    assert main_text.extract(page(body), None) == text


def test_hosts_vote(spark):
    plain = page(f'<div class="x{{}}"><p>{"menu words " * 30}</p></div><div class="story"><h1>A title</h1>{ARTICLE}</div>')
    good = page(f'<div class="x1"><p>short</p></div><div class="story"><h1>A title</h1>{ARTICLE}</div>')
    rows = [(k, "http://a.example/x", good, "y") for k in range(5)]
    rows += [(5, "https://A.example:80/z", plain, "y"), (6, "http://b.example/", plain, "y"), (7, None, good, "y"), (8, "bad url", None, "y"), (None, "http://a.example", "", "y"), (0, "http://a.example/x", good, "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, _host string")
    got = main_text.main_texts(pages).collect()
    assert len(got) == len(rows)
    by_id = {r["page_id"]: r for r in got}
    assert by_id[5]["text"] == TEXT  # its own best container would be the other one
    assert by_id[6]["text"].startswith("menu words")
    assert by_id[7]["text"] == TEXT and by_id[8]["text"] == "" and by_id[None]["n_chars"] == 0
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert main_text.main_texts(pages.limit(0)).count() == 0


def test_many_templates_of_one_host(spark):
    """The 21st template and later ones count as well: their own container is not the longest of the last page."""
    tags = [chr(97 + k // 26) + chr(97 + k % 26) for k in range(30)]
    story = lambda t, menu: page(f"<div class='x'><p>{menu}</p></div><div class='{t}zz'><p>A story of its own, long enough to count.</p></div>")
    rows = [(k, None, story(t, "short")) for k, t in enumerate(tags) for _ in range(3)]
    rows.append((99, None, story(tags[-1], "other words " * 30)))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in main_text.main_texts(pages).collect()}
    assert set(got) == {*range(30), 99}
    assert set(got.values()) == {"A story of its own, long enough to count."}


def test_given_pages_give_their_article(spark):
    import html
    import re

    from matchloom.llm.common import table

    pages = table(spark, "/root/testdata/sf0.001", "pages")
    got = {r["page_id"]: r["text"] for r in main_text.main_texts(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        want = html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner)))
        assert got[r["page_id"]] == " ".join(want.split())


def big(k: int) -> str:
    return f"<p>{'é' * 300} payload {k} {'x' * 500}</p>"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, f"http://h.example/{k}", big(k % 7)) for k in range(40)]
    rows += [(100, None, None), (101, "http://h/\r\nX: y", ""), (102, "u", "small"), (103, "u", "small"), (None, "u", big(1)), (39, "u", big(4)), (200, "u", "y" * 1_000_000)]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string").repartition(3)


def test_archives_round_trip(spark, pages, scratch):
    path = scratch("warc")
    got = warc.round_trip(pages, path).collect()
    source = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    first = {}
    for i, data in source:
        if len(data) >= 1000 and i is not None:
            first[data] = max(first.get(data, i), i)
    want = []
    for i, data in source:
        to = first.get(data)
        again = to is not None and to != i
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", to if again else None))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    rows = warc.read_archives(spark, path).where("record_type = 'response' and page_id = 101").collect()
    assert rows[0]["url"] == "http://h/%0D%0AX:%20y" and bytes(rows[0]["payload"]) == b""
    assert warc.read_archives(spark, path).where("error is not null").count() == 0


def test_archives_are_plain_zstandard_with_a_dictionary_in_front(spark, pages, scratch):
    path = scratch("warc")
    warc.write_archives(warc.with_revisits(pages).coalesce(1), path)
    data = max((bytes(r["content"]) for r in spark.read.format("binaryFile").load(path).collect()), key=len)
    magic, size = struct.unpack_from("<II", data)
    assert magic == warc.DICTIONARY_MAGIC
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
    frames = list(warc._frames(data))
    assert len(frames) == pages.count() and all(e is None for _, _, e in frames)
    at = frames[0][0]
    first = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj().decompress(data[at : frames[1][0]])
    assert first.startswith(b"WARC/1.1\r\n") and first == frames[0][1]


def test_archives_are_bounded_by_bytes(spark, pages, scratch):
    """One task writes several archives, each whole by itself; only a record beyond the bound makes a larger one."""
    path, bound = scratch("warc"), 5_000
    warc.write_archives(warc.with_revisits(pages).coalesce(1), path, bound)
    files = [bytes(r["content"]) for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0").collect()]
    sizes = [[len(content) for _, content, error in warc._frames(f) if error is None] for f in files]
    assert len(files) > 2 and sum(map(len, sizes)) == pages.count()
    assert all(sum(own[:-1]) < bound for own in sizes) and any(sum(own) >= bound for own in sizes)
    whole = scratch("warc-whole")
    warc.write_archives(warc.with_revisits(pages), whole)
    got, want = (warc.read_archives(spark, p).drop("archive", "frame_offset") for p in (path, whole))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_broken_archives(spark, scratch):
    good = warc._record(7, "u", b"abc", 3, hashlib.sha1(b"abc").hexdigest(), "response", None)
    assert warc._parse(good)["payload"] == b"abc"
    sha = base64.b32encode(hashlib.sha1(b"abc").digest())
    for broken, fault in (
        (good.replace(b"WARC/1.1", b"WARC/9.9"), "no WARC header"),
        (good.replace(b"WARC-Date", b"X-Date"), "warc-date is missing"),
        (good.replace(b"abc", b"abcd"), "content-length"),
        (good.replace(b"abc", b"abd"), "digest"),
        (good.replace(sha, sha[::-1]), "digest|Incorrect padding|Non-base32"),
        (good[:-2], "content-length"),
    ):
        with pytest.raises(ValueError, match=fault):
            warc._parse(broken)
    frame = zstandard.ZstdCompressor().compress(good)
    assert [e for _, _, e in warc._frames(frame + frame[:-3])] == [None, "frame: cut short"]
    assert [e is None for _, _, e in warc._frames(frame + b"garbage!" + frame)] == [True, False]
    assert [c for _, c, _ in warc._frames(warc.EMPTY_FRAME.encode("latin-1") + frame)] == [good]


def test_no_pages(spark, pages, scratch):
    assert warc.round_trip(pages.limit(0), scratch("warc")).count() == 0


OWN_BODY = "<h2>Heading</h2><p>The first paragraph of the article is long enough.</p><p>The second one ends it here.</p>"
OWN_TEXT = "Heading The first paragraph of the article is long enough. The second one ends it here."


@pytest.mark.parametrize(
    "open_, close",
    [
        ("<article class='post comments-open'>", "</article>"), ("<article class='post sponsored'>", "</article>"),
        ("<div class='entry has-comments'>", "</div>"), ("<div class='ad-free content'>", "</div>"),
        ("<div id='page' class='nav-closed'>", "</div>"), ("<form id='aspnet'>", "</form>"), ("<form id='aspnet'><h1>Heading</h1>", "</form>"),
        ("<aside class='story'>", "</aside>"), ("<div class='nav-wrapper'>", "</div>"),
    ],
)
def test_wrappers_that_touch_on_boilerplate_keep_their_text(open_, close):
    own = OWN_BODY.replace("<h2>Heading</h2>", "") if "<h1>" in open_ else OWN_BODY
    assert main_text.extract(f"<html><body>{open_}{own}{close}</body></html>", None) == OWN_TEXT


def test_sections_about_adverts_stay_and_adverts_go():
    page = (
        "<body><article>" + OWN_BODY + "<section id='advertising-history'><p>Adverts have a history.</p></section>"
        "<div class='ad'>Buy now</div><div class='ad-banner'>Buy more</div><div class='commentList'><p>first!</p></div>"
        "<ul class='breadcrumb-trail'><li>Home</li></ul><form class='login'>Name</form><aside>Also read</aside>"
        "<article class='comment'><p>A reader writes.</p></article><div id='comments'><p>Another reader writes at length.</p></div></article></body>"
    )
    assert main_text.extract(page, None) == OWN_TEXT + " Adverts have a history."


def test_depth_is_no_square():
    import time

    for opened in ("<div>", "<div class='sidebar'>", "<div class='a b'><article>", "<li><div class='footer sidebar'>", "<ul><li>"):
        page = "".join(f"{opened}word{k % 7} " for k in range(50_000)) + "</span></p></form>" * 50_000
        began = time.monotonic()
        text = main_text.extract(page, None)
        main_text.vote(page)
        assert time.monotonic() - began < 60 and text.count("word") > 0
