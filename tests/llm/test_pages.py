"""WARC archives and HTML extraction."""

import hashlib
import html
import re
import time

import pytest

from llm_cases import SF
from tidewright.llm.common import scratch
from tidewright.llm.html import extract, main_text
from tidewright.llm.warc import CorruptArchive, RecordReader, member, page_row, read_archives, record, write_archives


def reader(data, chunk=7):
    at = [0]

    def read(n):
        part = data[at[0]:at[0] + n]
        at[0] += n
        return part

    return RecordReader(read, chunk)


def one(page, payload, kind="response", refers=None, url="http://a/é\r\nX: y"):
    return member(record(page, url, kind, refers, payload, hashlib.sha256(payload).hexdigest(), "1970-01-01T00:00:00Z"))


def test_records_come_back_whatever_the_reads():
    data = one(1, b"") + one(2, b"x" * 5000) + one(3, b"x" * 5000, "revisit", 2) + one(None, b"WARC/1.1\r\n\r\n")
    for chunk in (1, 7, 4096, 1 << 20):
        rows = [page_row(h, b) for h, b in reader(data, chunk)]
        assert [(r[0], r[2], r[3], r[4]) for r in rows] == [(1, "response", None, 0), (2, "response", None, 5000),
                                                            (3, "revisit", 2, 5000), (None, "response", None, 12)]
        assert rows[2][5] == hashlib.sha256(b"x" * 5000).hexdigest() and rows[2][6] is None
        assert all("\r" not in r[1] and "\n" not in r[1] for r in rows)


def test_damage_is_told():
    whole = record(1, None, "response", None, b"abc" * 50, hashlib.sha256(b"abc" * 50).hexdigest(), "1970-01-01T00:00:00Z")
    for data in (member(whole)[:-3], member(whole)[:-20], member(whole.replace(b"abcabc", b"abcabd", 1)), member(whole[:-4]),
                 member(whole + b"more"), member(b"no record\r\n\r\n"), b"no gzip at all", member(whole.split(b"\r\n\r\n")[0])):
        with pytest.raises(CorruptArchive):
            list(reader(data))


def test_archives_of_awkward_pages(spark):
    same, other = "s" * 200, "é" * 60
    rows = [(5, "u", same, 1), (3, None, same, 1), (9, "u", same, 1), (3, "again", same, 1), (None, "n", same, 1), (1, "u", "tiny", 1),
            (2, "u", "tiny", 1), (7, "u", None, 1), (8, "u", "", 1), (None, "m", other, 1), (None, "m2", other, 1), (10, "long", "z" * 400_000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(3)
    folder = scratch(spark, "warc")
    listed = write_archives(pages, folder, archive_bytes=300)
    assert listed.count() > 1 and sum(r.records for r in listed.collect()) == len(rows)
    found = read_archives(listed, folder).collect()
    key = lambda x: tuple((v is not None, str(v)) for v in x)
    want = [(p, len((h or "").encode()), "revisit" if h == same and p != 3 else "response", 3 if h == same and p != 3 else None) for p, _, h, _ in rows]
    assert sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in found), key=key) == sorted(want, key=key)
    for r in found:
        if r.record_type == "response":
            assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest and len(r.payload) == r.payload_bytes
    empty = write_archives(pages.limit(0), scratch(spark, "warc"))
    assert empty.count() == 0 and read_archives(empty, folder).count() == 0


PAGE = """<html><head><title>T</title></head><body><header class="site-header"><h1>Site</h1><a href=/>home</a></header>
<div id=wrap><div class="sidebar"><p>Some side text, with commas, and long enough to count for something.</p></div>
<div class="content"><h2>Title &amp; more</h2><p>First para, it has  commas,
 and &lt;tags&gt; and enough text to be scored as a paragraph of an article, really.<p>Second one, with
 <b>bold <i>text</b> left</i> open and&nbsp;enough of it that it counts &eacute;.</p><form><p>Your email, please, now, and here, is it long
 enough to be a paragraph?</p></form><ul><li>one<li>two</ul><script>if(a<b){"</p>"}</script>
<div class="comments"><p>I think, that, this, is a comment that should go away, whatever it says.</p></div></div>
<div class="cookie-notice">We use cookies, ok, please, accept them all</div></div>
<aside><p>Read also, these, other, things, which are many, and long, and dull.</p></aside>
<footer><p>Copyright, all rights, reserved</p></footer></body></html>"""


def test_article_without_the_rest():
    assert main_text(PAGE).split("\n") == [
        "Title & more", "First para, it has commas, and <tags> and enough text to be scored as a paragraph of an article, really.",
        "Second one, with bold text left open and enough of it that it counts é.", "one", "two"]


def test_links_do_not_win():
    links = "".join(f"<p><a href=/{k}>A link, with commas, and quite a lot of text, number {k}</a></p>" for k in range(30))
    text = "<p>Prose, with commas, and enough of it, to be found among all those links.</p>" * 3
    assert main_text(f"<body><div>{links}</div><div>{text}</div></body>") == "\n".join(
        ["Prose, with commas, and enough of it, to be found among all those links."] * 3)


@pytest.mark.parametrize("page", ["", "   ", "<", "<p", "<!-- never closed", "<script>never closed", "</div></p>", "<p>" * 3000,
                                  "<div>" * 5000 + "deep" + "</div>" * 5000, "<b><i></b></i>", "<a href='x", "&#0;&#xD800;&bogus;",
                                  "<table><tr><td>a<td>b<tr><td>c</table>", "a < b > c", "<![CDATA[x]]>", "<?php echo 1 ?>"])
def test_broken_pages(page):
    assert isinstance(main_text(page), str)


def test_plain_text_and_long_pages():
    assert main_text("only  text,\n no markup") == "only text, no markup"
    long = "<article>" + "<p>word, and more words here</p>" * 20_000 + "</article>"
    assert main_text(long).count("\n") == 19_999


def test_table_of_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    odd = spark.createDataFrame([(None, None, None), (1, "u", ""), (1, "u", "")], "page_id long, url string, html string")
    found = extract(pages.union(odd).withColumn("Text", pages.page_id))
    assert found.columns == ["page_id", "url", "text", "n_chars"] and found.count() == pages.count() + 3
    texts = {r.page_id: r.text for r in found.collect() if r.page_id is not None}
    assert all(r.n_chars == len(r.text) for r in found.collect())
    for r in pages.collect():
        if r.page_id == 1:
            continue
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", article)]
        assert texts[r.page_id] == "\n".join(b for b in blocks if b)
    assert extract(pages.limit(0)).count() == 0


LONG = "Prose, with commas, and enough of it, to be a paragraph of an article, whatever it says."


def test_parts_of_an_article_in_several_containers():
    parts = (f"<section>{f'<p>{LONG}</p>' * 20}</section>bare words<section><p>Two, short.</p><p>ones</p></section>"
             "<h5>Small head</h5><blockquote>Quoted</blockquote><ul><li>one</ul><pre>x = 1</pre><table><tr><td>cell</table>")
    want = [LONG] * 20 + ["bare words", "Two, short.", "ones", "Small head", "Quoted", "one", "x = 1", "cell"]
    links = "".join(f"<li><a href=/{k}>Read, this, too, number {k}</a>" for k in range(9))
    for open_, close in (("<article>", "</article>"), ("<main><div>", "</div></main>"), ("<div>", "</div>")):
        assert main_text(f"<body><div><ul>{links}</ul></div>{open_}{parts}{close}</body>").split("\n") == want


def test_articles_beside_each_other():
    page = "".join(f"<article><h2>{k}</h2>{f'<p>{LONG}</p>' * k}</article>" for k in (1, 9, 2))
    assert main_text(f"<body><div>{page}</div></body>").split("\n") == ["1", LONG, "9", *[LONG] * 9, "2", LONG, LONG]


@pytest.mark.parametrize("names", ["content-area has-sidebar", "layout no-sidebar", "elementor-widget elementor-widget-text-editor",
                                   "sidebar", "with-nav page", "widget"])
def test_names_around_an_article(names):
    text = f"<article>{f'<p>{LONG}</p>' * 3}</article>"
    for inner in (text, text.replace("article>", "div>")):
        page = f"<body><div class='{names}'>{inner}</div><div class='cookie-notice'><p>We, use, cookies</p></div></body>"
        assert main_text(page) == "\n".join([LONG] * 3)


def test_names_within_an_article():
    page = (f"<article><p>{LONG}</p><section class='related-work'><p>Others, too</p></section><section class=legal><p>The law</p></section>"
            "<div class='related-posts'>Read on</div><div class='social-share'>Tell</div><div id=comments><p>No, never</p></div></article>")
    assert main_text(page).split("\n") == [LONG, "Others, too", "The law"]


def test_many_comments_are_not_the_article():
    said = f"<li><article class='comment-body'><p>{LONG} No.</p></article></li>" * 20
    page = f"<body><article><p>{LONG}</p></article><div class='comments-area'><ol>{said}</ol></div></body>"
    assert main_text(page) == LONG


LONG = "Some words of prose, with a comma, that go on for a while so that it counts as a paragraph of the article itself."


@pytest.mark.parametrize("page, want", [
    (f'<body><form id="aspnetForm"><input name="q"><div><p>{LONG}</p><p>{LONG} Two.</p></div></form></body>', f"{LONG}\n{LONG} Two."),
    (f'<body><form><article><h1>Title</h1><p>{LONG}</p></article></form></body>', f"Title\n{LONG}"),
    (f'<body role="form"><div role="form"><article><p>{LONG}</p></article></div></body>', LONG),
    (f'<body><article><p>{LONG}</p><form><p>Subscribe here</p></form></article></body>', LONG),
    ("<body><div>About us</div><article>" + "".join(f'<p><a href="/{k}">{LONG} {k}</a></p>' for k in range(8)) + "</article></body>",
     "\n".join(f"{LONG} {k}" for k in range(8))),
    (f'<body><ul><li><a href="/">Home</a></li></ul><div><p>{LONG}</p><p><a href="/r">Read the full report</a></p><p>{LONG} Two.</p>'
     f'<ul><li><a href="/1">First reference, 1999</a></li></ul></div></body>',
     f"{LONG}\nRead the full report\n{LONG} Two.\nFirst reference, 1999"),
    (f'<body><ul><li><a href="/">Home</a></li></ul><p>{LONG}</p><ul><li><a href="/1">A list, in between</a></li></ul><p>{LONG} Two.</p>'
     f'<div><a href="/x">More</a></div></body>', f"{LONG}\nA list, in between\n{LONG} Two."),
])
def test_nothing_of_the_article_goes(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize("piece", ["<a b", '<a b="', "<a b='>", "<!x ", "</a ", "<p", "<a b=\"'>", "<div>", "<svg>", "<ul><li>"])
def test_long_runs_of_open_tags(piece):
    start = time.perf_counter()
    main_text("<body><p>" + LONG + "</p>" + piece * (200_000 // len(piece)))
    assert time.perf_counter() - start < 20
