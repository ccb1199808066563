"""WARC round trips and main-text extraction."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import time

import pytest

from legwise.llm import warc
from legwise.llm.tree_extract import extract, main_text

ROWS = [
    (1, "http://a/é b\r\nX: y", "<p>same</p>", "clash"), (5, "http://b", "<p>same</p>", "x"), (3, None, "<p>same</p>", "y"),
    (None, "http://null", "<p>same</p>", "z"), (7, "http://c", None, "n"), (8, "http://d", "", "n"), (9, "http://e", "ü" * 70_000, "n"),
    (10, "http://f", "WARC/1.1\r\n\r\n\x1f\x8b\x08", None),
]
SCHEMA = "page_id bigint, url string, html string, size string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def read_all(spark, rows, split, least=0):
    folder = warc.new_folder(spark)
    files = warc.write(spark.createDataFrame(rows, SCHEMA).repartition(2), folder, least=least)
    return warc.read(files, folder, split).collect()


@pytest.mark.parametrize("split", [1, 97, 1 << 20])
def test_round_trip_for_any_split(spark, split):
    rows = ROWS if split > 1 else ROWS[:2]
    got = read_all(spark, rows, split)
    assert len(got) == len(rows)
    by_id = {r.record_id: r for r in got}
    for key, _, text, _ in rows:
        r = by_id[f"<urn:x-record:{'' if key is None else key}>"]
        assert r.payload_bytes == len((text or "").encode()) and r.payload_digest == digest(text)
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == (text or "").encode()
    kinds = {r.record_id: (r.record_type, r.refers_to) for r in got}
    if split > 1:
        assert kinds["<urn:x-record:5>"] == ("response", None) == kinds["<urn:x-record:>"]
        assert kinds["<urn:x-record:1>"] == kinds["<urn:x-record:3>"] == ("revisit", "<urn:x-record:5>")
        assert kinds["<urn:x-record:7>"] == ("revisit", "<urn:x-record:8>")  # null and empty are equal payloads
        assert by_id["<urn:x-record:1>"].uri.startswith("http://a/%C3%A9%20b%0D%0A")


def test_short_payloads_are_all_responses(spark):
    assert [r.record_type for r in read_all(spark, ROWS, 1 << 20, least=1000)] == ["response"] * len(ROWS)


def test_empty_table_and_hot_payload(spark):
    assert read_all(spark, [], 100) == []
    got = read_all(spark, [(i, "u", "copy", "s") for i in range(500)], 1000)
    assert len(got) == 500 and sum(r.record_type == "response" for r in got) == 1
    assert {r.refers_to for r in got if r.refers_to} == {"<urn:x-record:499>"}


def test_every_split_point_gives_every_record_once():
    member = [warc.record(str(i), f"http://x/{i}", bytes([i]) * (i * 37 % 400)) for i in range(12)]
    data = b"".join(member)
    for cut in range(0, len(data) + 1, 13):
        both = [*warc.records_between(io.BytesIO(data), 0, cut), *warc.records_between(io.BytesIO(data), cut, len(data))]
        assert [r[0] for r in both] == [f"<urn:x-record:{i}>" for i in range(12)]


def test_magic_inside_a_member_is_not_a_record():
    stored = warc.record("1", None, b"\x1f\x8b\x08\x00 not a member \x1f\x8b\x08" * 3)
    assert [r[0] for r in warc.records_between(io.BytesIO(b"junk\x1f\x8b\x08junk" + stored), 0, 1 << 20)] == ["<urn:x-record:1>"]


def test_splits_are_read_by_as_many_tasks(spark):
    folder = warc.new_folder(spark)
    files = warc.write(spark.createDataFrame([(i, "u", f"page {i} " * 50, "s") for i in range(200)], SCHEMA).repartition(2), folder)
    few, many = warc.read(files, folder, 1 << 30), warc.read(files, folder, 512)
    assert many.rdd.getNumPartitions() > 20 > few.rdd.getNumPartitions()
    assert many.count() == few.count() == 200


def test_foreign_digests_and_damaged_records(spark, tmp_path):
    body = b"some payload"
    sha1, sha256 = hashlib.sha1(body), hashlib.sha256(body)

    def member(name, digest, length=len(body)):
        head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: {name}\r\nContent-Length: {length}\r\n"
        return gzip.compress((head + (f"WARC-Payload-Digest: {digest}\r\n" if digest else "") + "\r\n").encode() + body + b"\r\n\r\n")

    base32 = base64.b32encode(sha1.digest()).decode()
    good = [("a", f"sha1:{base32}"), ("b", f"SHA1:{base32.lower()}"), ("c", f"sha1:{sha1.hexdigest()}"), ("d", f"sha256:{sha256.hexdigest()}"),
            ("e", "blake3:whatever"), ("f", None), ("g", base32)]
    bad = [member("x", "sha1:" + "A" * 32), member("y", None, 500), gzip.compress(b"WARC/1.0 nothing else"), gzip.compress(b"no record at all")]
    data = b"".join([*(member(*g) for g in good), *bad, b"junk", member("z", None)])
    (tmp_path / "foreign.warc.gz").write_bytes(data)
    files = spark.createDataFrame([(str(tmp_path / "foreign.warc.gz"), len(data))], "path string, size bigint")
    for split in (100, 1 << 20):
        read = {r.record_id: r.payload_digest for r in warc.read(files, f"file://{tmp_path}", split).collect()}
        assert sorted(read) == ["a", "b", "c", "d", "e", "f", "g", "z"]
        assert read["a"] == read["b"] == read["c"] == read["g"] == base32 and read["d"] == good[3][1] and read["f"] is None
        left = warc.rejects(files, f"file://{tmp_path}", split).orderBy("place").collect()
        assert [r.reason for r in left] == ["payload of x does not have its digest"] + ["headers or length of no record"] * 2


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="<p>no</p>";</script><style>p{}</style></head><body
class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=1>Menu</a></li></ul></nav>
<div id="cookie-notice"><p>We use cookies, a lot of them, really, and you have to agree to it.</p></div>
<div class="wrap">%s</div><div class="sidebar"><p>Side text, with, commas, that is long enough to count.</p></div>
<section id="comments"><p>Great article, thanks, really, I liked it so much that I wrote this.</p></section>
<form><p>Subscribe, now, to, this</p></form><footer>&copy; all</footer></body></html>"""
BODY = """<h1>The title</h1><p>First paragraph, with some words &amp; an entity&nbsp;or two, long enough to matter.</p>
<p><b>Unclosed bold, in a paragraph<br>second part<p>Short.</p><ul><li>One</li><li>Two</li></ul>
<div class="ad"><p>Buy this, now, or never, it is a very good offer.</p></div><!-- no --><table><tr><td>Cell</td></tr></table>
<p>Last paragraph, again with a few words, <a href="x">a link</a> and &lt;tags&gt; in it, 3 < 4 and so on.</p>"""
TEXT = """The title
First paragraph, with some words & an entity or two, long enough to matter.
Unclosed bold, in a paragraph second part
Short.
One
Two
Cell
Last paragraph, again with a few words, a link and <tags> in it, 3 < 4 and so on."""


@pytest.mark.parametrize("body", [f"<article>{BODY}</article>", f'<div class="content">{BODY}</div>', BODY, f"<main><div>{BODY}</div></main>"])
def test_article_among_other_blocks(body):
    assert main_text(PAGE % body) == TEXT


def test_sections_of_one_article_stay_together():
    part = "<section><p>" + "Some sentence, with words. " * 10 + "</p></section>"
    assert main_text(PAGE % (part * 3)).count("\n") == 2


def test_odd_pages(spark):
    rows = [(1, "u", None, "x"), (2, "u", "", "x"), (3, None, "plain, words", "x"), (4, "u", "<p>a\n<i>b</i>\n<b>c</b>", "x"),
            (4, "u", "<p>a\n<i>b</i>\n<b>c</b>", "x"), (None, "u", "<nav>only a menu</nav>", "x"), (6, "u", "<" * 1000, "x")]
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()}
    assert got[1, "u"] == got[2, "u"] == got[None, "u"] == ("", 0)
    assert got[3, None] == ("plain, words", 12) and got[4, "u"] == ("a b c", 5) and got[6, "u"][1] == 1000
    assert extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_long_broken_pages_are_read():
    page = "<article>" + "<div><p>word, word</b></span> " * 20_000 + "<p title=\"unclosed > x" + "\" '" * 2000
    assert main_text(page).count("word, word") == 20_000


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_pages(spark, sf):
    """The given pages have their text between the article tags."""
    import html
    import re

    for row in extract(spark.read.parquet(f"/root/testdata/{sf}/pages.parquet"), ("page_id", "html")).collect():
        inside = re.search("<article>(.*?)</article>", row.html, re.S)[1]
        lines = (" ".join(html.unescape(re.sub("<[^>]*>", " ", part)).split()) for part in re.split("</?(?:p|h1)>", inside))
        assert row.text == "\n".join(line for line in lines if line)


@pytest.mark.parametrize("tag", ["svg class='i'", "math", "iframe src='x'", "object data=a", "video src='v'", "audio", "canvas", "noscript"])
def test_a_self_closed_raw_element_hides_nothing(tag):
    first, second = ("%s paragraph, with some words, long enough to matter here." % which for which in ("First", "Second"))
    page = f"<html><body><article><p>{first}</p><{tag} /><p>{second}</p></article></body></html>"
    assert main_text(page).splitlines() == [first, second]
    inside = f"<html><body><article><p>{first}</p><p><{tag}/>{second}</p></article></body></html>"
    assert main_text(inside).splitlines() == [first, second]


def test_a_slash_before_an_end_tag_of_its_own_hides_the_contents():
    text = "A paragraph, with some words, long enough to matter here."
    page = f"<html><body><article><script src=http://x/>var hidden = 1;</script><p>{text}</p></article></body></html>"
    assert main_text(page) == text


LONG = "A paragraph of the article, with some words, long enough to matter here."


@pytest.mark.parametrize(
    "element",
    ['<p title="The hidden valley">%s</p>', '<div data-src="/img/hidden/x.png">%s</div>', '<p data-hidden="false">%s</p>', '<p data-id="comments">%s</p>',
     '<p data-role="alert">%s</p>', '<div id="social-science">%s</div>', '<p class="share-price">%s</p>', '<div class="story-related">%s</div>',
     '<section id="notice-of-award">%s</section>', "<p title='class=\"ad\" hidden'>%s</p>", '<p data-x="a < b" class=lead>%s</p>', "<p title=\"it's\">%s</p>", "<p/ >%s</p>",
     '<blockquote cite="http://x/hidden" class="with-ad">%s</blockquote>'],
)
def test_article_text_stays(element):
    text = "What is said here, in this place, belongs to the article as well."
    for around in ("<article>%s</article>", "<main><div>%s</div></main>"):
        page = PAGE % (around % (f"<p>{LONG}</p>" + element % text + f"<p>{LONG}</p>"))
        assert main_text(page).splitlines() == [LONG, text, LONG]


@pytest.mark.parametrize(
    "element",
    ['<p hidden>%s</p>', '<div HIDDEN="">%s</div>', '<div class="ad">%s</div>', '<div class="ad-slot-2">%s</div>', '<div id="shareButtons">%s</div>', '<div class="comment-list">%s</div>',
     '<div role=alert>%s</div>', '<p style="color:red; display : none">%s</p>', '<div class="related-articles">%s</div>', '<article class="comment">%s</article>',
     '<div class="share-this-story"><a href=1>%s</a></div>', '<div aria-hidden="true">%s</div>', "<button>%s</button>"],
)
def test_what_is_not_article_text_goes(element):
    page = PAGE % ("<article>" + f"<p>{LONG}</p>" + element % "Something else, that is not the article, but long enough." + f"<p>{LONG}</p></article>")
    assert main_text(page).splitlines() == [LONG, LONG]


def test_linked_lists_and_second_articles_stay():
    links = "<ul><li><a href=1>First source of the claim</a></li><li><a href=2>Second source of the claim</a></li></ul>"
    assert main_text(PAGE % f"<article><p>{LONG}</p>{links}</article>").splitlines() == [LONG, "First source of the claim", "Second source of the claim"]
    two = f"<article><p>{LONG}</p><p>{LONG}</p></article><article><p>{LONG} Two.</p><p>{LONG}</p></article><article><p>Teaser.</p></article>"
    assert main_text(PAGE % two).splitlines() == [LONG, LONG, LONG + " Two.", LONG]


@pytest.mark.parametrize(
    "page",
    ["<a" * 100_000, "<a" * 100_000 + ">", "x<" + "y" * 1_000_000, "<p " + "z " * 500_000, "<div>" * 100_000 + "word", "<div><li>" * 50_000, "<ul>" + "<div><li></li>" * 50_000,
     "<b>" * 100_000 + "</i>" * 100_000, "<i><div>" + "<b>" * 50_000 + "</i>" * 50_000, "<script/>" * 100_000, "<p title=\"" * 100_000, "<a '" * 100_000, "<!-" * 100_000,
     "<p class=" + "ad" * 300_000 + ">word</p>", "</" * 200_000, "<svg/>" * 100_000, "<" * 300_000, "<p>" + "," * 500_000, "<table><tr>" * 30_000 + "<td>" * 30_000],
    ids=lambda page: page[:12].strip(),
)
def test_long_odd_pages_take_linear_time(page):
    begun = time.perf_counter()
    main_text(page)
    assert time.perf_counter() - begun < 12  # a second or so on a machine of its own; a quadratic walk takes minutes
