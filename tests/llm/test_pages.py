"""Page operators: rendering, archives, and the merged index."""

import base64
import collections
import hashlib
import random
from html.parser import HTMLParser

import pytest

from tagloom.llm import html_layout, warc
from tests.llm.cases import same_rows

LAYOUT = """<head><title>no</title></head><p>One<p>Two <b>bold</b>x<ul><li>a<li>b<ul><li>c</ul><li>d</ul><ol start=3><li>x<li>y</ol>
<table><tr><th>Name<th>N<tr><td>long name<td>1<tr><td colspan=2>wide</table><pre> a
  b</pre><div hidden>no</div><div style="display:none">no</div><span style="visibility:hidden">no<i style="visibility:visible">yes</i></span>
<details><summary>S</summary>no</details>&amp; end<br>line<script>var t="</p>";</script>"""
RENDERED = """One

Two boldx

- a
- b
  - c
- d

3. x
4. y

Name       N
long name  1
wide

 a
  b

yes
S
& end
line"""


class Visible(HTMLParser):
    """Words outside scripts, styles and heads, in order."""

    def __init__(self):
        super().__init__()
        self.skip, self.found = 0, []

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "head")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "head")

    def handle_data(self, data):
        if not self.skip:
            self.found.append(data)


def test_layout():
    made = html_layout.render(LAYOUT)
    assert made["text"] == RENDERED and made["n_items"] == 6 and made["n_rows"] == 3


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""), ("", ""), ("a < b", "a < b"), ('<a href="x>y">link</a>', "link"), ('z <b "unclosed> t <i>u</i>', "z t u"), ("<!-- c --><p>x<!-- open", "x"),
        ("<style>.ad,#i{display:none}</style><p class='b ad'>no<p id=i>no<p>yes", "yes"), ("<textarea> a\n b</textarea>", " a\n b"), ("<table><td>a<td>b\n c</table>", "a  b c"),
        ("<select><option>a<option>b</select>", "a\nb"), ("<dl><dt>t<dd>d</dl>", "t\n  d"), ("<p>a</b></div></p>b", "a\n\nb"), ("<div>" * 20000 + "x", "x"),
        ("<input type=submit value=Go><input type=hidden value=no>", "Go"), ("<noscript>no</noscript><svg><text>no</text></svg>yes", "yes"),
    ],
)
def test_odd_markup(source, text):
    assert html_layout.render(source)["text"] == text


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<style>@media print {.nav, aside {display:none}} .ad{display:none}</style><p class=nav>a<aside>b</aside><p class=ad>no", "a\n\nb"),
        ("<style>@media (max-width:600px){.a{display:none}} @media screen and (min-width:50em){.b{display:none}}</style><p class=a>a<p class=b>no", "a"),
        ("<style media=print>p{display:none}</style><p>a", "a"), ("<style media='screen, print'>p{display:none}</style><p>no<div>a</div>", "a"),
        ("<style>.t{display:none} .t{display:block}</style><p class=t>a", "a"), ("<style>.t{display:block} .t{display:none}</style><p class=t>no", ""),
        ("<style>.t{display:none} .t.on{display:block}</style><p class=t>no<p class='on t'>a", "a"),
        ("<style>#i{display:block} .t{display:none}</style><p class=t id=i>a<p class=t>no", "a"),
        ("<style>.t{display:none!important}</style><p class=t style='display:block'>no", ""), ("<style>.t{display:none}</style><p class=t style='display:block'>a", "a"),
        ("<style>@import 'x.css'; @keyframes k{from{display:none} p{display:none}} @media screen{@media print{p{display:none}} i{display:none}}</style><p>a<i>no</i>", "a"),
        ("<style>@supports (x:y){p{display:none}} .t{display:none} .m .t{display:block} .t:hover{display:none}</style><p>a<b class=t>b</b>", "ab"),
        ("<noscript><style>p{display:none}</style></noscript><p>a <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math>", "a x=1"),
        ("<style>@media(max-width:9px){p{display:none}} i{content:'}'; display:none}</style><p>a<i>no</i>", "a"), ("<style>p{display:none", ""), ("<style>p{display:none}@media print{", ""),
    ],
)
def test_only_styles_of_the_screen_hide(source, text):
    assert html_layout.render(source)["text"] == text


def test_all_visible_words_stay(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    sources = {r.page_id: r.html for r in pages.collect()}
    got = html_layout.extract_text(pages).collect()
    assert len(got) == len(sources)
    for r in got:
        parser = Visible()
        parser.feed(sources[r.page_id])
        want = collections.Counter("".join(parser.found).split())
        have = collections.Counter(w for w in r.text.split() if w != "-")
        # Blocks part words that stand side by side in the markup; nothing else differs.
        assert "".join(sorted("".join(want.elements()))) == "".join(sorted("".join(have.elements())))


def pages_frame(spark):
    rows = [(i, f"https://www.h{i % 3}.example/{i % 7}?q={i}", f"<p>{i % 11} é") for i in range(60)]
    rows += [(100, None, None), (101, "http://x.example\r\nEvil: 1", ""), (101, "http://x.example\r\nEvil: 1", ""), (None, "u", "<p>5 é"), (None, "u", "alone"), (102, "a\r\n\r\nb", "x\r\n\r\nWARC/1.1\r\n\r\ny"), (103, "", "z" * 300000)]
    return rows, spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, offset int").repartition(4)


@pytest.mark.parametrize("ranges", [50_000, 7])
def test_archives(spark, monkeypatch, ranges):
    monkeypatch.setattr(warc, "RANGE_ENTRIES", ranges)
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 9)
    rows, pages = pages_frame(spark)
    index = warc.archive_pages(pages)
    got = index.collect()
    first = {}
    for k, _, html in rows:
        if k is not None:
            first[html or ""] = min(k, first.get(html or "", k))
    want = []
    for k, _, html in rows:
        payload = (html or "").encode()
        of = first.get(html or "")
        again = of is not None and k != of
        want.append((k, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if again else "response", of if again else None))
    same_rows([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], want)
    got.sort(key=lambda r: (r.range_no, r.place))
    keys = [(r.urlkey, r.captured, -1 if r.page_id is None else r.page_id, r.file, r.offset) for r in got]
    assert keys == sorted(keys) and len({r.range_no for r in got}) == (1 if ranges > 100 else len({r.range_no for r in got}))
    assert {r.urlkey for r in got if r.page_id == 3} == {"example,h0)/3?q=3"}


def test_only_large_payloads_are_revisited(spark):
    _, pages = pages_frame(spark)
    got = warc.archive_pages(pages, min_bytes=7).collect()
    assert {r.record_type for r in got if r.payload_bytes < 7} == {"response"}
    assert warc.archive_pages(pages.limit(0)).collect() == []


def test_loser_tree_merges_any_runs():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted((rng.randrange(20), i) for _ in range(rng.randrange(9))) for i in range(k)]
        merged = list(warc.LoserTree([iter(r) for r in runs]))
        assert [x[0] for x in merged] == sorted(x[0] for r in runs for x in r) and sorted(merged) == sorted(x for r in runs for x in r)


def test_damaged_archives_are_errors():
    import gzip

    head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: 24\r\n\r\n"
    whole = head + b"HTTP/1.1 200 OK\r\n\r\npaylo\r\n\r\n"
    for data in (whole, whole[:-9], b"not a record\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.read_records(memoryview(gzip.compress(data))))
