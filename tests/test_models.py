"""Queries without SQL against plain models, over all rows of a small table."""

import html as entities
import os
import re

import pytest

from docloom import queries as q
from docloom.functions import text as tx
from docloom.sources.html import to_markdown

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def derived():
    duckdb = pytest.importorskip("duckdb")
    return lambda table, key, sql: dict(duckdb.sql(f"select {key}, {sql} from '{SF}/{table}.parquet'").fetchall())


def spans(text, kinds=("$$", "$")):
    """(start, end) of math spans, found character by character."""
    out, i = [], 0
    while i < len(text):
        end = None
        if "$$" in kinds and text.startswith("$$", i):
            j = i + 2
            while j < len(text) and not (j > i + 2 and text.startswith("$$", j)):
                if text[j] == "\n" and text[j + 1 :].lstrip(" \t").startswith("\n"):
                    j = len(text)
                j += 1
            end = j + 2 if j < len(text) else None
        if end is None and "$" in kinds and text[i] == "$" and text[i - 1 : i] != "$" and text[i + 1 : i + 2] != "$":
            j = i + 1
            while j < len(text) and text[j] not in "$\n":
                j += 1
            if j > i + 1 and text[j : j + 1] == "$" and text[j + 1 : j + 2] != "$":
                end = j + 1
        if end is None:
            i += 1
        else:
            out.append((i, end))
            i = end
    return out


def mapped(text, change, kinds, outside=None):
    out, at = [], 0
    for a, b in spans(text, kinds):
        out += [(outside or str)(text[at:a]), change(text[a:b])]
        at = b
    return "".join([*out, (outside or str)(text[at:])])


def despaced(formula):
    t = re.findall(r"\\[A-Za-z]+|\\.|\s+|[^\\\s]", formula)
    keep = lambda k: 0 < k < len(t) - 1 and re.fullmatch(r"\\[A-Za-z]+", t[k - 1]) and t[k + 1][0].isalpha()
    return "".join((" " if keep(k) else "") if x.isspace() else x for k, x in enumerate(t))


def normalized(md):
    def inside(width, change):
        return lambda s: s[:width] + change(s[width:-width]) + s[-width:] if set("\\_^{}") & set(s[width:-width]) else s

    for change in (despaced, lambda f: f.replace(r"\mathsf{a_{b}}", "a_{b}"), lambda f: re.sub(r"(?<=\d)\\,(?=\d)", "", f)):
        for width in (2, 1):
            md = mapped(md, inside(width, change), ("$" * width,))
    return md


def standardized(md):
    found = {v for a, b in spans(md) for v in re.findall(r"([A-Za-z])_\{([A-Za-z][A-Za-z0-9]*)\}", md[a:b]) if len(v[1]) > 1}
    known = {b + s: f"${b}_{{{s}}}$" for b, s in found}
    if known:
        md = re.sub(r"(\w)<sub>(\w+)</sub>", lambda m: known.get(m[1] + m[2], m[0]), md)
        names = "|".join(f"{b}[ \t]?{s}" for b, s in sorted(found, key=lambda v: -len(v[1])))
        md = mapped(md, str, ("$$", "$"), lambda part: re.sub(rf"(?<![A-Za-z])(?:{names})(?![A-Za-z0-9])", lambda m: known[re.sub(r"\s", "", m[0])], part))
    return md


def cleaned(md):
    def part(text):
        for table in (tx.SYMBOL_ESCAPES, tx.PRIVATE_GLYPHS, {tx.MOJIBAKE: ""}, tx.PHRASES):
            for old, new in table.items():
                text = text.replace(old, new)
        text = "\n".join(re.sub(r"^([ \t]*)•[ \t]+", r"\1- ", re.sub(r"^([ \t]*[-*+][ \t]+)•[ \t]+", r"\1", x)) for x in text.split("\n"))
        text = re.sub(r"(?mi)^[ \t]{0,3}#{1,6}[ \t]+(?:AND\d{5,}/D|CONFIDENTIAL AND PROPRIETARY[^\n]*)[ \t]*\n?", "", text)
        text = re.sub(r"\n{2,}\d{1,4}[ \t]*\Z", "\n", text)
        lines, out, run = re.findall(r"[^\n]*\n|[^\n]+\Z", text), [], []
        for x in [*lines, ""]:
            if re.fullmatch(r"[ \t]*[0-9][0-9|.,:; \t-]*\n?", x):
                run.append(x)
            else:
                out += ([] if len(run) > 5 else run) + [x]
                run = []
        return "".join(out)

    return "".join(x if k % 2 else part(x) for k, x in enumerate(re.split(r"(?s)(```.*?```|~~~.*?~~~)", md)))


def got(spark, name, key, column):
    return {r[key]: r[column] for r in q.QUERIES[name](spark, SF).collect()}


def test_math_spans(spark, derived):
    want = {(d, k): md[a:b] for d, md in derived("documents", "doc_id", q.MATH).items() for k, (a, b) in enumerate(spans(md))}
    assert {(r.doc_id, r.pos): r.span for r in q.QUERIES["math_spans"](spark, SF).collect()} == want and len(want) > 400


def test_latex_unwrap(spark, derived):
    assert got(spark, "latex_unwrap", "doc_id", "md") == {d: md.replace(r"\mathsf{a_{b}}", "a_{b}") for d, md in derived("documents", "doc_id", q.MATH).items()}


def test_normalize_math(spark, derived):
    assert got(spark, "normalize_math", "doc_id", "md") == {d: normalized(md) for d, md in derived("documents", "doc_id", q.MATH).items()}


def test_standardize_subscripts(spark, derived):
    want = {d: standardized(normalized(md)) for d, md in derived("documents", "doc_id", q.MATH).items()}
    assert got(spark, "standardize_subscripts", "doc_id", "md") == want and all("or $V_{CR}$ with" not in x and "with $V_{CR}$" in x for x in want.values())


def test_text_pipeline(spark, derived):
    want = {d: standardized(normalized(cleaned(md))) for d, md in derived("documents", "doc_id", f"concat({q.FENCED}, {q.MATH})").items()}
    assert got(spark, "text_pipeline_query", "doc_id", "md") == want


def test_pages_to_markdown(spark, derived):
    article = {p: (re.search(r"(?is)<article\b.*?</article>", h or "") or [""])[0] for p, h in derived("pages", "page_id", "html").items()}
    tight = lambda md: re.sub(r"(\w)[ \t]+(<su[bp]>)", r"\1\2", md)
    want = {p: standardized(normalized(cleaned(tight(to_markdown(h))))) for p, h in article.items()}
    assert got(spark, "pages_to_markdown", "page_id", "md") == want


def visible(html):
    """Letters and digits that a page shows, by cutting tags out of the source."""
    html = re.sub(r"(?is)<(script|style|title|template)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ", html or "")
    return re.sub(r"[\W_]", "", entities.unescape(html))


def test_html_to_md(spark, derived):
    """What a page shows is in its Markdown, in order; headings, items and links are as many as in the source."""
    md = got(spark, "html_to_md", "page_id", "md")
    for page, html in derived("pages", "page_id", "html").items():
        links = re.findall(r"""(?is)<a\b[^>]*\bhref=["']([^"']+)""", html)
        text = md[page]
        for href in links:
            assert f"]({entities.unescape(href)})" in text
            text = text.replace(f"]({entities.unescape(href)})", "", 1)
        text = re.sub(r"!\[[^\]]*\]\([^)]*\)|(?m:^\| --- .*$)|</?su[bp]>|(?m:^ *\d+\. )", "", text)
        assert re.sub(r"[\W_]", "", text) == visible(html), page
        assert len(re.findall(r"(?m)^#{1,6} ", md[page])) >= len(re.findall(r"(?i)<h[1-6]\b[^>]*>\s*\w", html))


def test_html_fragment(spark, derived):
    pages = derived("pages", "page_id", "html")
    rows = q.QUERIES["html_fragment"](spark, SF).collect()
    assert {r.page_id for r in rows} == set(pages)
    for r in rows:
        assert r.section == "<div class='a subsection'><p>x</p></div>"
        found = re.search(r"(?is)<article\b.*?</article>", pages[r.page_id] or "")
        assert visible(r.topic) == visible(found[0] if found else "")


def test_image_map_align(spark):
    rows: dict = {}
    for r in q._deduped(spark, SF).filter("canonical is not null").collect():
        rows.setdefault(r.doc_id, []).append((r.pos, r.canonical))
    want = {}
    for d, refs in rows.items():
        names = [n for _, n in sorted(refs)]
        left = [n for i, n in enumerate(names) if i % 4 != 1]
        left = [re.sub(r"\.[^.]+$", ".svg", n) if i % 5 == 0 else n for i, n in enumerate(left)]
        for k, n in enumerate(names):
            head = left[0] if left else None
            twin = head is not None and head in (n, re.sub(r"\.[^.]+$", "", n) + ".svg")
            taken = twin or (head is not None and len(left) >= len(names) - k)
            want[d, k] = left.pop(0) if taken else None
    assert {(r.doc_id, r.pos): r.final_file for r in q.QUERIES["image_map_align"](spark, SF).collect()} == want
