import gzip
import hashlib
import html as entities
import random
import re

import pytest
from pyspark.sql import functions as F

from caseflow.llm import extract, warc
from caseflow.session import scratch_path

PAGES = [(1, "http://a.com/x/1", "<article><h1>T &amp; U</h1><p>one<br>two</p></article><footer>f</footer>"),
         (2, "http://a.com/x/2?q", "<body><div>menu line</div><div>own text</div></body>"),
         (3, "http://a.com/x/3", "<body><div>menu line</div><div>other text</div></body>"),
         (4, None, None), (5, "odd", ""), (6, "http://b.com/", "<p>menu line<p>cut off <b>here"),
         (7, "http://a.com/x/3", "<body><div>menu line</div><div>other text</div></body>"),
         (None, "http://c.com/\r\nX: y", "é" * 800), (8, "http://c.com/2", "é" * 800), (9, "u", "z" * 999), (10, "u", "z" * 999),
         (11, "http://d.com/", "<div class=ad>buy</div><script>var t='</p>'</script><p>" + "w " * 200_000)]
SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, SCHEMA).selectExpr("*", "1 as text", "2 as lines", "3 as place", "4 as value")


def test_lines_and_regions():
    page = ("<header>H</header><nav><ul><li>a<li>b</ul></nav><main><h2>x&nbsp; y</h2><aside>s</aside><p>p1<p>p2"
            "<section class='user-comments'>c</section></main><p>tail")
    assert extract.lines_of(page) == [("H", 0), ("a", 0), ("b", 0), ("x y", 2), ("s", 0), ("p1", 2), ("p2", 2), ("c", 0),
                                      ("tail", 1)]


@pytest.mark.parametrize("tag", [
    '<article style="overflow:hidden">', '<article title="The hidden coast">', '<article data-hidden="false">',
    "<article data-x='class=ad'>", '<article data-role="banner" data-id=ad>', '<article aria-hidden="false">', '<div href="/s?id=share">',
    "<div data-url=/s?class=ad>", '<body class="has-sidebar">', '<article class="post comments-open">', '<main id="no-menu">',
    '<html class="no-cookie">', '<article class="post" class="ad">', '<article data-a="x>y" aria-label="true">'])
def test_what_is_no_mark(tag):
    assert [x for x, r in extract.lines_of(f"{tag}<p>text") if r] == ["text"]


@pytest.mark.parametrize("tag", [
    "<div hidden>", "<DIV HIDDEN=''>", '<div aria-hidden="true">', "<div class='x ad'>", "<div id=share>", '<div role="banner">',
    '<div class="user-comments">', '<article class="post sponsored">', '<body id="popup">', "<div data-x=1 class = 'a\nads'>"])
def test_what_is_a_mark(tag):
    assert extract.lines_of(f"{tag}<p>text") == [("text", 0)]


@pytest.mark.parametrize("page", [
    '<article><p class="ad">buy<p>text', '<article><p class="ad">buy<div>text</div>', '<article><p class=ad>buy<h2>text</h2>',
    '<article><p class=ad><span class=ad>buy<p>text', "<article><ul><li class=ad>buy<li>text</ul>",
    "<article><ul><li class=ad><div>buy<li>text</ul>", "<article><ul><li class=ad>buy<ul><li>buy</ul><li>text</ul>",
    "<article><dl><dt class=ad>buy<dd>text</dl>", "<article><dl><dd class=ad>buy<dt>text</dl>",
    "<article><table><tr class=ad><td>buy<tr><td>text</table>", "<article><table><tr><td class=ad>buy<td>text</table>",
    "<article><table><tr class=ad><td>buy<table><tr><td>buy</table><tr><td>text</table>",
    "<article><table><tbody class=ad><tr><td>buy<tbody><tr><td>text</table>", "<head><meta charset=utf-8><title>t</title><body><article>text",
    "<head><link rel=x><p>text", "<article><ul><li class=ad><ul><li>buy</li></ul>buy</li><li>text</ul>",
    "<article><table><tr><td class=ad><table><tr><td>buy</td></table>buy</td><td>text</table>"])
def test_left_out_end_tags(page):
    lines = extract.lines_of(page)
    assert [x for x, r in lines if r] == ["text"] and {x for x, r in lines if not r} <= {"buy"}


@pytest.mark.parametrize("page, text", [
    ("<form id=f><article><p>Main text", "Main text"), ('<div class="page has-sidebar"><article><p>Main text', "Main text"),
    ('<div class="no-comments"><p>Main text', "Main text"), ('<div class="elementor-widget-text">Main text', "Main text"),
    ("<section id=widget-area-2><h1>T</h1><p>Main text", "T|Main text"), ('<div class="notice"><main>text', "text"),
    ("<article><p>Before</p><svg class=i /><p>After</p>", "Before|After"),
    ("<article><p>a</p><svg><svg><text>x</text></svg><text>y</text></svg><p>b", "a|b"),
    ("<template><p>no<template>n</template></p></template><p>yes", "yes"),
    ("<a title=Bob's href=x>link</a> main text don't drop</p>", "link main text don't drop"),
    ("<!--> <p>Main</p> <!-- x -->", "Main"), ("<!---> <p>Main</p>", "Main"), ("<p>a<!-- <p>b --!><p>c", "a|c"),
    ("<form action=/x><h1>T</h1><p>long main text</p><label>Name</label><button>go</button></form>", "T|long main text"),
    ("<p a=\"x>y\" b='x>y' c=>text<p d='>z", "text"), ("<p =a>text", "text"), ("<p/class=ad/>buy<p>text", "text")])
def test_the_main_text_is_kept(page, text):
    assert "|".join(x for x, r in extract.lines_of(page) if r) == text


@pytest.mark.parametrize("page", [
    "<article>text<form>Search: <p>q</form>", '<div class="comments"><article>c</article></div><article>text',
    '<div class="comments-area"><article class="comment">c</article></div><article>text',
    '<article>text<section class="user-comments">a much longer reader comment</section>',
    '<div class="sidebar-left">li</div><p>text',
    '<form>Search: <input><label>a long label</label></form><p>text', "<article>text<div class=ad-slot>buy this now</div>"])
def test_what_goes_beside_the_main_text(page):
    assert [x for x, r in extract.lines_of(page) if r] == ["text"]


def article_of(html):
    """The article of a given page, read without the operator."""
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1].replace("<br>", " ")
    blocks = (entities.unescape(re.sub(r"<[^>]+>", "", x)) for x in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def test_articles_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in extract.extract_report(pages).collect()}
    want = {r.page_id: article_of(r.html) for r in pages.collect()}
    assert got == {k: (v, len(v)) for k, v in want.items()}


@pytest.mark.parametrize("per_range", [2000, 5])
def test_pages_without_marks_lose_what_neighbours_share(spark, monkeypatch, per_range):
    """Nothing but differencing tells template and text apart here."""
    monkeypatch.setattr(extract, "PAGES_PER_RANGE", per_range)
    rng, rows = random.Random(5), []
    for k in range(120):
        host = rng.choice("abc")
        own = [f"own {k} {j}" for j in range(rng.randint(0, 4))]
        top, foot = [f"{host} top {j}" for j in range(3)], [f"{host} foot {j}" for j in range(rng.choice([2, 2, 0]))]
        rows.append((k, f"http://{host}.com/s{rng.randint(0, 3)}/{k:03}", [*top, *own, *foot]))
        if k % 9 == 0:
            rows.append((1000 + k, rows[-1][1], rows[-1][2]))  # a copy
    table = [(i, u, "<body>" + "".join(f"<div>{x}</div>" for x in lines)) for i, u, lines in rows]
    got = {r.page_id: r.text for r in extract.extract_text(spark.createDataFrame(table, SCHEMA)).collect()}
    order = sorted(rows, key=lambda r: (r[1], f"{r[0]:020}"))
    for at, (i, url, lines) in enumerate(order):
        shared = set()
        for step in (-1, 1):
            k = at + step
            while 0 <= k < len(order) and order[k][1][:12] == url[:12] and order[k][2] == lines:
                k += step
            if 0 <= k < len(order) and order[k][1][:12] == url[:12]:
                shared |= set(order[k][2])
        assert got[i] == "\n".join(x for x in lines if x not in shared), url


def test_alignment_is_a_common_subsequence():
    assert extract.aligned("abcab", "xacbab") == {0, 2, 3, 4}
    assert extract.aligned("", "a") == set() and extract.aligned("aaa", "aa") == {0, 1}


@pytest.mark.parametrize("pairs", [16, 0.1])
def test_alignment_is_the_longest(monkeypatch, pairs):
    monkeypatch.setattr(extract, "PAIRS", pairs)
    assert extract.aligned(["m", "A", "m", "B"], ["A", "m", "B"]) == {1, 2, 3}
    rng = random.Random(1)
    for _ in range(500):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 14))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        got = [a[k] for k in sorted(extract.aligned(a, b))]
        rest = iter(b)
        assert len(got) == best[-1][-1] and all(x in rest for x in got)


def test_long_pages_of_one_line_align():
    assert len(extract.aligned(["m"] * 5000 + ["A", "m"], ["m"] * 4000 + ["B", "m"])) == 4001


def test_extracted_text(pages):
    got = {r.page_id: r for r in extract.extract_text(pages).collect()}
    assert len(got) == len(PAGES)
    assert got[1].text == "T & U\none two"
    assert got[2].text == "own text" and got[3].text == "other text" and got[7].text == "other text"
    assert got[4].text == "" and got[5].text == "" and got[6].text == "menu line\ncut off here"
    assert got[11].n_chars == 399_999
    assert extract.extract_report(pages.limit(0)).isEmpty()


def test_ranges_do_not_change_the_text(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    one = {r.page_id: (r.text, r.n_shared) for r in extract.extract_text(pages).collect()}
    monkeypatch.setattr(extract, "PAGES_PER_RANGE", 7)
    many = {r.page_id: (r.text, r.n_shared) for r in extract.extract_text(pages).collect()}
    assert one == many


@pytest.mark.parametrize("per_range", [2000, 50])
def test_long_runs_of_copies_meet_their_neighbours(spark, monkeypatch, per_range):
    """Hosts a and b begin and end with 700 copies, c has them in the middle; d is nothing but copies."""
    monkeypatch.setattr(extract, "PAGES_PER_RANGE", per_range)
    copy, other = ("<body><div>menu</div><div>%s</div></body>" % x for x in ("own", "other"))
    rows = [(10_000 * h + k, f"http://{host}.com/{k:04}", other if k in others else copy)
            for h, (host, others) in enumerate({"a": {701}, "b": {0}, "c": {0, 701}, "d": set()}.items())
            for k in range(702) if k in others or 0 < k < 701]
    got = {r.page_id: (r.text, r.n_shared) for r in extract.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    for i, url, html in rows:
        expected = ("menu\nown", 0) if "d.com" in url else ("own" if html == copy else "other", 1)
        assert got[i] == expected, url


def test_archives_round_trip(spark, pages):
    folder = scratch_path(spark, "warc-test")
    index = warc.archive_pages(pages, folder).collect()
    files = {r.path.rsplit("/", 1)[-1]: bytes(r.content) for r in
             spark.read.format("binaryFile").load(f"{folder}/archives").collect()}
    payloads = {}
    for r in index:
        record = warc.read_member(files[r.archive], r.offset, r.length)
        assert warc.describe(record)["page_id"] == r.page_id
        if r.record_type == "response":
            payloads[r.page_id] = record.split(warc.END, 1)[1].split(warc.END, 1)[1][:r.payload_bytes]
    for i, _, html in PAGES:
        if i is not None:
            assert payloads[str(i)] == (html or "").encode()
    whole = b"".join(gzip.decompress(x) for x in files.values())
    assert whole.count(b"WARC/1.1\r\n") == len(PAGES)
    twin = next(r for r in index if r.page_id is None)
    assert (twin.record_type, twin.refers_to, twin.payload_bytes) == ("revisit", "8", 1600)
    assert twin.payload_digest == hashlib.sha1("é".encode() * 800).hexdigest()
    assert next(r for r in index if r.page_id == "9").record_type == "response"
    assert warc.warc_report(pages.limit(0)).isEmpty()


def test_revisits_name_their_response(spark, pages):
    index = warc.archive_pages(pages, scratch_path(spark, "warc-ids")).collect()
    ids = {r.record_id: r for r in index}
    assert len(ids) == len(index) and all(re.fullmatch("<urn:uuid:[0-9a-f-]{36}>", x) for x in ids)
    twin = next(r for r in index if r.record_type == "revisit")
    assert ids[twin.refers_to_record].page_id == twin.refers_to == "8"
    raw = warc.to_records(pages, date=F.lit("2020-02-03 04:05:06").cast("timestamp")).where("value LIKE '%revisit%'").first().value
    head = dict(x.split(": ", 1) for x in raw.split("\r\n\r\n")[0].split("\r\n")[1:])
    assert head["WARC-Profile"] == warc.PROFILE and head["WARC-Refers-To-Target-URI"] == "http://c.com/2"
    assert head["WARC-Date"] == head["WARC-Refers-To-Date"] == "2020-02-03T04:05:06Z" and head["X-Refers-To-Page-Id"] == "8"


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_hot_payloads(spark, broadcast):
    """A third of all pages is one payload; either way of joining gives the same."""
    rows = spark.range(3000).selectExpr("id AS page_id", "concat('http://h.com/', id) AS url",
                                        "repeat(CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN concat('u', id) "
                                        "ELSE concat('t', id DIV 6) END, 600) AS html")
    out = warc.to_records(rows, broadcast_payloads=broadcast)
    got = {d["page_id"]: d["refers_to"] for d in (warc.describe(r.value.encode() + warc.END) for r in out.collect())}
    last = {}
    for i in range(3000):
        last["hot" if i % 3 == 0 else f"u{i}" if i % 3 == 1 else f"t{i // 6}"] = str(i)
    want = {str(i): last["hot" if i % 3 == 0 else f"u{i}" if i % 3 == 1 else f"t{i // 6}"] for i in range(3000)}
    assert got == {i: None if i == x else x for i, x in want.items()}


def test_files_are_bounded_by_bytes(spark):
    folder = scratch_path(spark, "warc-files")
    rows = spark.range(400).selectExpr("id AS page_id", "'u' AS url", "concat(id, repeat('x', IF(id % 50 = 0, 900000, 20000))) AS html").coalesce(2)
    warc.write_monolithic(warc.to_records(rows), folder, file_bytes=1 << 20)
    sizes = [sum(len(x) for x in warc.inflate(bytes(r.content))) for r in
             spark.read.format("binaryFile").load(folder).collect()]
    assert max(sizes) <= 1 << 20 and len(sizes) < 40 and sum(sizes) > 400 * 20_000


def test_long_record_and_cut_streams():
    big = b"WARC/1.1\r\nContent-Length: 17000000\r\n\r\n" + b"q" * 17_000_000 + b"\r\n\r\n"
    data = warc.member(big) + warc.member(b"x")
    assert data[-1] == 0 and [len(x[2]) for x in warc.members(data)] == [len(big), 1]
    with pytest.raises(ValueError):
        list(warc.inflate(data[:-20]))
    assert [len(x) for x in warc.split_records([big[:50], big[50:]])] == [len(big)]
