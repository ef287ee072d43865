"""HTML trees: fragments of vendor pages, inlined images and Markdown, by the standard library's parser in Arrow batches."""

from __future__ import annotations

import base64
from collections.abc import Callable
from html import escape
from html.parser import HTMLParser
from pathlib import PurePosixPath
from urllib.parse import urljoin, urlsplit

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.text import subsup_tighten

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SKIPPED = frozenset({"script", "style", "title", "template", "head"})
BLOCKS = frozenset("address article aside blockquote body div dl dd dt fieldset figure figcaption footer form header html li main nav ol p pre section table tbody thead tfoot tr ul".split())


class Fragment(HTMLParser):
    """The source of the first element, in document order, that ``wanted`` accepts."""

    def __init__(self, wanted: Callable[[str, dict], bool]):
        super().__init__(convert_charrefs=False)
        self.wanted, self.parts, self.open, self.done = wanted, [], [], False

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        if not self.open and not self.wanted(tag, dict(attrs)):
            return
        self.parts.append(self.get_starttag_text())
        if tag not in VOID:
            self.open.append(tag)
        elif not self.open:
            self.done = True

    def handle_startendtag(self, tag, attrs):
        if self.open and not self.done:
            self.parts.append(self.get_starttag_text())

    def handle_endtag(self, tag):
        if self.done or tag not in self.open:
            return
        while True:
            last = self.open.pop()
            self.parts.append(f"</{last}>")
            if last == tag:
                break
        self.done = not self.open

    def _keep(self, text):
        if self.open and not self.done:
            self.parts.append(text)

    def handle_data(self, data):
        self._keep(data)

    def handle_entityref(self, name):
        self._keep(f"&{name};")

    def handle_charref(self, name):
        self._keep(f"&#{name};")


def fragment(html: str | None, *wanted: Callable[[str, dict], bool]) -> str:
    for test in wanted:
        parser = Fragment(test)
        parser.feed(html or "")
        parser.close()
        while parser.open:
            parser.parts.append(f"</{parser.open.pop()}>")
        if parser.parts:
            return "".join(parser.parts)
    return ""


def _div(name: str):
    return lambda tag, attrs: tag == "div" and name in (attrs.get("class") or "").split()


@F.pandas_udf(T.StringType())
def ti_fragment(html: pd.Series) -> pd.Series:
    """The first ``div.subsection``, else the first ``div.section``, else the empty text."""
    return html.map(lambda h: fragment(h, _div("subsection"), _div("section")))


@F.pandas_udf(T.StringType())
def oxygen_topic(html: pd.Series) -> pd.Series:
    return html.map(lambda h: fragment(h, lambda tag, _: tag == "article"))


class ToMarkdown(HTMLParser):
    """Headings, paragraphs, lists, tables, images, links, code, sub and sup as Markdown."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[str] = []
        self.line: list[str] = []
        self.skip = 0
        self.lists: list[list] = []
        self.prefix = ""
        self.pre = False
        self.rows: list[list[str]] | None = None
        self.cell = False
        self.hrefs: list[str | None] = []

    def close_cell(self):
        """Cells and rows may end without a tag."""
        if self.cell:
            self.rows[-1].append(" ".join("".join(self.line).split()).replace("|", "\\|"))
            self.line, self.cell = [], False

    def flush(self):
        text = "".join(self.line)
        text = text.strip("\n") if self.pre else " ".join(text.split())
        if text.strip():
            self.blocks.append(f"```\n{text}\n```" if self.pre else self.prefix + text)
            self.prefix = ""
        self.line = []

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag in SKIPPED:
            self.skip += tag != "head"
        elif self.skip:
            pass
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.flush()
            self.prefix = "#" * int(tag[1]) + " "
        elif tag in ("ul", "ol"):
            self.flush()
            self.lists.append([tag, 0])
        elif tag == "li":
            self.flush()
            if self.lists:
                self.lists[-1][1] += 1
            kind, n = self.lists[-1] if self.lists else ("ul", 0)
            self.prefix = "  " * max(0, len(self.lists) - 1) + ("- " if kind == "ul" else f"{n}. ")
        elif tag == "table":
            self.flush()
            self.rows = []
        elif tag == "tr" and self.rows is not None:
            self.close_cell()
            self.rows.append([])
        elif tag in ("td", "th") and self.rows is not None:
            self.close_cell()
            if not self.rows:
                self.rows.append([])
            self.line, self.cell = [], True
        elif tag == "img":
            if attrs.get("src"):
                self.line.append(f"![{attrs.get('alt') or 'Image'}]({attrs['src']})")
        elif tag == "a":
            self.hrefs.append(attrs.get("href"))
            if attrs.get("href"):
                self.line.append("[")
        elif tag in ("b", "strong"):
            self.line.append("**")
        elif tag in ("i", "em"):
            self.line.append("*")
        elif tag == "code" and not self.pre:
            self.line.append("`")
        elif tag in ("sub", "sup"):
            self.line.append(f"<{tag}>")
        elif tag == "br":
            self.line.append("\n" if self.pre else " ")
        elif tag in BLOCKS and self.rows is None:
            self.flush()
            self.pre = self.pre or tag == "pre"

    def handle_endtag(self, tag):
        if tag in SKIPPED:
            self.skip = max(0, self.skip - (tag != "head"))
        elif self.skip:
            pass
        elif tag in ("ul", "ol"):
            self.flush()
            if self.lists:
                self.lists.pop()
        elif tag in ("td", "th", "tr") and self.rows is not None:
            self.close_cell()
        elif tag == "table" and self.rows is not None:
            self.close_cell()
            rows = [r for r in self.rows if r]
            if rows:
                width = max(map(len, rows))
                rows = [r + [""] * (width - len(r)) for r in rows]
                self.blocks.append("\n".join("| " + " | ".join(r) + " |" for r in [rows[0], ["---"] * width, *rows[1:]]))
            self.rows, self.line = None, []
        elif tag == "a" and self.hrefs:
            if href := self.hrefs.pop():
                self.line.append(f"]({href})")
        elif tag in ("b", "strong"):
            self.line.append("**")
        elif tag in ("i", "em"):
            self.line.append("*")
        elif tag == "code" and not self.pre:
            self.line.append("`")
        elif tag in ("sub", "sup"):
            self.line.append(f"</{tag}>")
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6") or tag in BLOCKS and self.rows is None:
            self.flush()
            self.prefix = ""
            self.pre = self.pre and tag != "pre"

    def handle_data(self, data):
        if not self.skip:
            self.line.append(data)


def to_markdown(html: str | None) -> str:
    parser = ToMarkdown()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return "\n\n".join(parser.blocks) + ("\n" if parser.blocks else "")


@F.pandas_udf(T.StringType())
def _to_markdown(html: pd.Series) -> pd.Series:
    return html.map(to_markdown)


def html_to_md(html: Column) -> Column:
    return subsup_tighten(_to_markdown(html))


def with_markdown(rows: DataFrame, html: str, md: str = "md") -> DataFrame:
    """``rows`` with column ``html`` replaced by its Markdown, ``md``.

    One Arrow pass, so what follows reads a column and not an expression over a Python function, which the optimizer would
    repeat for each use.
    """
    kept = [c for c in rows.columns if c != html]

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(map(to_markdown, texts), pa.string())], [*kept, md])

    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField(md, T.StringType())])
    return rows.select(*kept, html).mapInArrow(run, schema).withColumn(md, subsup_tighten(F.col(md)))


class Inliner(HTMLParser):
    """Rewrites the source of images; all else stays as it is written."""

    def __init__(self, change: Callable[[str], str]):
        super().__init__(convert_charrefs=False)
        self.change, self.out = change, []

    def _tag(self, tag, attrs):
        src = dict(attrs).get("src")
        text = self.get_starttag_text()
        if tag == "img" and src and not src.startswith("data:"):
            close = " />" if text.endswith("/>") else ">"
            text = "<img" + "".join(f' {k}="{escape(self.change(src) if k == "src" else v or "")}"' for k, v in attrs) + close
        self.out.append(text)

    handle_starttag = _tag
    handle_startendtag = _tag

    def handle_endtag(self, tag):
        self.out.append(f"</{tag}>")

    def handle_data(self, data):
        self.out.append(data)

    def handle_entityref(self, name):
        self.out.append(f"&{name};")

    def handle_charref(self, name):
        self.out.append(f"&#{name};")

    def handle_comment(self, data):
        self.out.append(f"<!--{data}-->")

    def handle_decl(self, decl):
        self.out.append(f"<!{decl}>")


def joined(base: str, src: str) -> str:
    """An image's address; one that cannot be read stays as it is."""
    try:
        return urljoin(base, src)
    except ValueError:
        return src


def sources(html: str | None, base: str) -> list[str]:
    """The addresses of the images of ``html`` that are not data, in order, each once: those that ``inlined`` asks for."""
    found: dict[str, None] = {}
    parser = Inliner(lambda src: found.setdefault(joined(base, src)) or src)
    parser.feed(html or "")
    parser.close()
    return list(found)


@F.pandas_udf(T.ArrayType(T.StringType()))
def image_sources(html: pd.Series, base: pd.Series) -> pd.Series:
    return pd.Series([sources(h, b) for h, b in zip(html, base)])


def inlined(html: str | None, base: str, fetched: dict[str, bytes | None]) -> str:
    """Images of ``html`` as data addresses where ``fetched`` has their bytes, else as absolute addresses."""
    from .urls import MEDIA_TYPES

    def change(src: str) -> str:
        url = joined(base, src)
        data = fetched.get(url)
        if data is None:
            return url
        kind = MEDIA_TYPES.get(PurePosixPath(urlsplit(url).path).suffix.lower(), "image/png")
        return f"data:{kind};base64,{base64.b64encode(data).decode()}"

    parser = Inliner(change)
    parser.feed(html or "")
    parser.close()
    return "".join(parser.out)


@F.pandas_udf(T.StringType())
def inline_images(html: pd.Series, base: pd.Series, fetched: pd.Series) -> pd.Series:
    """``fetched`` is map<string,binary>: what was fetched for the page."""
    return pd.Series([inlined(h, b, dict(f) if f is not None else {}) for h, b, f in zip(html, base, fetched)])
