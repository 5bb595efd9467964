"""Main text and archives."""

import hashlib
import io
import time

import pytest

from skyweave.llm import warc
from skyweave.llm.html import extracted, main_text
from skyweave.llm.queries import QUERIES


def text(page):
    return main_text(page)[0]


def test_article_without_its_surroundings():
    page = """<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style><script>var t="</p>";</script></head>
    <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
    <div id="cookie-notice"><p>We use cookies so that all of this is as good as it can be for you and for us.</p></div>
    <div class="ad">Buy this.</div><article><header><h1>Head &amp; tail</h1></header><p><b>One
    &lt;two&gt;\xa0&#233;.<br><p>Three <a href="#">four</a> five<br>six.</p><div class="share"><a>tweet</a></div><p>UND!!</p></article>
    <section id="comments"><article><p>I think that this is what we all have been waiting for, and so it is, is it not?</p></article>
    </section><aside>Most read of the day</aside><form>Mail <input><button>Go</button></form>
    <footer>&copy; The site &middot; x"""
    assert text(page) == "Head & tail\nOne <two> é.\nThree four five six.\nUND!!"


LONG = "This is the text of a page that has no container for what it says, and so we have to look at all of its words. " * 2


def test_rules_without_a_container():
    page = f"<div><a>Home</a> <a>News</a></div><h2>Title</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p><div>© firm</div>"
    assert text(page) == f"Title\n{LONG.strip()}\nShort.\n{LONG.strip()}"
    thin = "zq xv kp wj " * 30
    assert text(f"<nav><a>Home</a></nav><p>{thin}</p><div>© firm</div>") == thin.strip()
    menu = "<p><a>one two three</a></p>"
    assert text(f"<p>{LONG}</p>{menu}{menu}<p>{thin}</p>{menu}") == LONG.strip()
    assert text(f"<p>{LONG}</p><p>{thin}</p><p>{LONG}</p>") == "\n".join((LONG.strip(), thin.strip(), LONG.strip()))


TEMPLATES = [
    '<div class="sidebar"><h3>Hot</h3><p>{l}</p></div><div class="post-content"><h1>T</h1><p>{a}</p></div><div id="footer">x</div>',
    '<HEADER>Site</HEADER><MAIN><H1>T</H1><P>{a}</MAIN><ASIDE>{l}</ASIDE>',
    '<div role="navigation">a b</div><article><h1>T</h1><div class="ad-slot">buy</div><p>{a}</p><form>mail</form></article>'
    '<div class="comments-area"><div class="comment"><p>{l}</p></div></div>',
    '<div class="cookie-banner">{l}<button>ok</button></div><div id="content"><h1>T</h1><p>{a}</p><ul class="share-links"><li>x</ul></div>',
    '<div class="notice">{l}</div><!-- <p>no</p> --><section class="entry"><h1>T</h1>{a}</section><footer>{l}</footer>',
    '<div class="banner">ad<article><h1>T</h1><p>{a}</p></article>',
]


@pytest.mark.parametrize("template", TEMPLATES)
def test_templates(template):
    assert text(template.format(l=LONG, a="ALL CAPS &amp; more")) == "T\nALL CAPS & more"


WRAPPED = [
    "<form action=x><nav><a>Home</a></nav><div><h1>T</h1><p>{l}</p><p>{l}</p></div><div class=sidebar><p>zq xv</p></div></form>",
    "<form><main><h1>T</h1><p>{l}</p><p>{l}</p></main><footer>{l}</footer></form>",
    '<div class="content-sidebar-wrap"><main><h1>T</h1><p>{l}</p><p>{l}</p></main><aside class="sidebar"><p>{l}</p></aside></div>',
    '<article class="post sponsored"><h1>T</h1><p>{l}</p><p>{l}</p><div class="share">tell</div></article><div id="comments">{l}</div>',
    '<article class="post share-enabled"><h1>T</h1><p>{l}</p><p>{l}</p></article><section class="related"><article><p>{l}</p></article></section>',
    '<div class="nav-open"><div class="widget"><article><h1>T</h1><p>{l}</p><p>{l}</p></article></div><form>mail</form></div>',
    '<p data-x="{x}>{x}">x</p><article data-y="{x}>{x}"><h1>T</h1><p title=\'{x}>\'>{l}</p><p>{l}</p></article>',
]


@pytest.mark.parametrize("template", WRAPPED)
def test_marks_around_the_page_are_hints(template):
    page = template.format(l=LONG, x="y" * 5000)
    assert text(page) == f"T\n{LONG.strip()}\n{LONG.strip()}"


def test_marks_beside_the_text_stay():
    """What stands beside a text is no part of it, however long it is."""
    beside = f'<div class="sidebar"><p>{LONG * 5}</p></div><form><p>{LONG * 5}</p></form><section id="comments"><p>{LONG * 9}</p></section>'
    assert text(f"<div><p>{LONG}</p><p>{LONG * 3}</p></div>{beside}") == f"{LONG.strip()}\n{(LONG * 3).strip()}"
    assert text(f"<article><p>short</p></article>{beside}") == "short"
    assert text(f'<section id="comments"><article><p>{LONG}</p></article></section>') == ""


@pytest.mark.parametrize("page", ["", None, "<", "<a \"b", "<!-- x", "<script>x", "</p></div>", "&#xffffffff;", "<p" * 2000, "<![CDATA[x"])
def test_broken_markup(page):
    assert isinstance(text(page), str)


@pytest.mark.parametrize(
    "part", ["<p", "<", "<a '", '<a "', "<!", "</", "<div>x", "</section>", "<b>", "&amp", "<p>a</div>", "<!--", "<div><section></section>"]
)
def test_broken_markup_is_read_in_one_pass(part):
    start = time.perf_counter()
    main_text(part * 100_000)
    assert time.perf_counter() - start < 20


def test_long_page():
    body = "<p>" + "a word of it " * 60_000 + "</p>"
    assert len(text(f"<article>{body}</article>")) == 60_000 * 13 - 1


PAGES = "page_id long, url string, html string, text string, payload binary"


def test_rows_come_through(spark):
    rows = [(1, "u", None, "x", b""), (None, None, "<article><p>a</p></article>", "x", b""), (1, "u", None, "x", b"")]
    found = extracted(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in found) == [("1", "", 0), ("1", "", 0), ("None", "a", 1)]
    assert extracted(spark.createDataFrame([], PAGES)).count() == 0


def test_pages_of_the_table(spark, folder, con):
    import html
    import re

    pages = dict(con.sql("select page_id, html from pages").fetchall())
    for r in QUERIES["op3_html_extraction"](spark, folder).collect():
        body = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"</?(b|br)>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)


def archived(spark, workspace, rows):
    df = spark.createDataFrame(rows, PAGES).repartition(3)
    listing = warc.write_archives(df, workspace)
    return listing, warc.read_archives(listing, workspace.folder("archives")).collect()


def test_round_trip(spark, workspace):
    big, other = "<p>é" + "x" * 1200, "y" * 1000
    rows = [(i, f"http://h/{i}\r\nEvil: x" if i == 2 else f"http://h/{i}", big, "t", b"") for i in range(1, 6)]
    rows += [(6, None, other, "t", b""), (7, "u", "small", "t", b""), (8, "u", "small", "t", b""), (None, "u", None, "t", b"")]
    rows += [(9, "v", other, "t", b""), (9, "v", other, "t", b""), (None, "w", big, "t", b""), (10, "z", "", "t", b"")]
    listing, found = archived(spark, workspace, rows)
    assert len(found) == len(rows) == sum(r.records for r in listing.collect())
    sha = lambda s: hashlib.sha1(s.encode()).hexdigest()
    for r in found:
        if r.payload_digest == sha(big):
            assert r.payload_bytes == len(big.encode())
            assert (r.record_type, r.refers_to) == (("response", None) if r.page_id == 5 else ("revisit", 5))
        if r.record_type == "response":
            assert hashlib.sha1(r.payload).hexdigest() == r.payload_digest and len(r.payload) == r.payload_bytes
    nine = sorted((r.record_type, r.refers_to) for r in found if r.page_id == 9)
    assert nine == [("response", None), ("revisit", 9)]
    assert [(r.record_type, r.refers_to) for r in found if r.page_id == 6] == [("revisit", 9)]
    assert sum(r.payload_digest == sha("small") and r.record_type == "response" for r in found) == 2
    assert {r.url for r in found if r.page_id == 6} == {None}
    assert archived(spark, workspace.__class__(spark, "t"), rows[:1])[1][0].page_id == 1


def test_empty_table(spark, workspace):
    listing, found = archived(spark, workspace, [])
    assert listing.count() == 0 and found == []


def archive(payloads, raw=b""):
    tools = warc._tools(raw)
    press = warc.zstandard.ZstdCompressor(dict_data=tools) if tools else warc.zstandard.ZstdCompressor()
    out = [warc.archive_head(raw)]
    for i, payload in enumerate(payloads):
        row = {
            "page_id": i, "row_id": i, "url": "u", "record_type": "response", "refers_to": None, "refers_row": None,
            "payload_digest": hashlib.sha1(payload).hexdigest(),
        }
        out.append(press.compress(warc.record(row, payload)))
    return out


def test_reader_validates():
    raw = warc.dictionary([b"<html><body><p>%d</p></body></html>" % i * 20 for i in range(200)], 2048)
    parts = archive([b"one", b"two" * 5000, b"\r\n\r\n"], raw)
    whole = b"".join(parts)
    assert [r["payload"] for r in warc.records(io.BytesIO(whole))] == [b"one", b"two" * 5000, b"\r\n\r\n"]
    for broken in (b"", whole[8:], whole[:-3], parts[0][:20], whole[: len(whole) - 6] + b"xxxxxx"):
        with pytest.raises((warc.ArchiveError, warc.zstandard.ZstdError)):
            list(warc.records(io.BytesIO(broken)))
    good = warc.record(
        {"page_id": 1, "row_id": 1, "url": "u", "record_type": "response", "payload_digest": hashlib.sha1(b"abc").hexdigest()}, b"abc"
    )
    assert warc.parsed(good)["payload"] == b"abc"
    for old, new in ((b"WARC/1.1", b"WARC/9"), (b"abc\r\n\r\n", b"abd\r\n\r\n"), (b"abc\r\n\r\n", b"abc"), (b"WARC-Date", b"Date")):
        with pytest.raises(warc.ArchiveError):
            warc.parsed(good.replace(old, new))


def test_reader_takes_any_record_type():
    def made(kind, block, *extra, version="1.0"):
        head = [f"WARC/{version}", f"WARC-Type:{kind}", "WARC-Record-ID: <urn:x:1>", "WARC-Date:2020-01-01T00:00:00Z", *extra]
        return "\r\n".join([*head, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n"

    sha = lambda x: hashlib.sha1(x).hexdigest()
    http = "Content-Type: application/http; msgtype=response"
    page = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\nabc"
    cases = [
        (made("warcinfo", b"software: x\r\n"), "warcinfo", b"software: x\r\n"),
        (made("request", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http; msgtype=request"), "request", b"GET / HTTP/1.1\r\n\r\n"),
        (made("metadata", b"", version="1.1"), "metadata", b""),
        (made("response", page, http, "WARC-Target-URI: http://a/\r\n b"), "response", b"abc"),
        (made("resource", b"abc", f"WARC-Payload-Digest: sha1:{sha(b'abc').upper()}"), "resource", b"abc"),
        (made("resource", b"abc", "WARC-Payload-Digest: md9:00"), "resource", b"abc"),
    ]
    for record, kind, payload in cases:
        found = warc.parsed(record)
        assert (found["record_type"], found["payload"], found["payload_digest"]) == (kind, payload, sha(payload))
        assert found["payload_bytes"] == len(payload) and found["page_id"] is None
    again = warc.parsed(made("revisit", b"", http, f"WARC-Payload-Digest: sha1:{sha(b'abc')}"))
    assert (again["payload"], again["payload_bytes"], again["payload_digest"]) == (None, None, sha(b"abc"))
    broken = [
        made("resource", b"abd", f"WARC-Payload-Digest: sha1:{sha(b'abc')}"),
        made("resource", b"abd", f"WARC-Block-Digest: sha256:{hashlib.sha256(b'abc').hexdigest()}"),
        made("response", b"no header", http),
        made("response", b"HTTP/1.1 200 OK\r\nContent-Length: 4\r\n\r\nabc", http),
        made("revisit", page, http),
        made("metadata", b"x", "no colon"),
        made("metadata", b"x").replace(b"Content-Length: 1", b"Content-Length: -1"),
    ]
    for record in broken:
        with pytest.raises(warc.ArchiveError):
            warc.parsed(record)
