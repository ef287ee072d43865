"""Document addresses and vendor pages: routing, stems, tables of contents, as Column expressions."""

from __future__ import annotations

import html as entities

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docloom.functions.text import strip

# Patterns, vendors' hosts and media types.
GUID = r"GUID-[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}"
TI_VIEWER = r"(?i)/document-viewer/[^/]+.*?/datasheet"
TI_PART = r"(?i)/document-viewer/(?:[a-z]{2}-[a-z]{2}/)?([^/]+)/datasheet"
TI_SECTION = r"""/document-viewer/[^/"']+/datasheet/(GUID-[A-Fa-f0-9-]+)"""
TI_LITNUM = r"litnum\s*=\s*'([^']+)'"
OXYGEN_HOST = "onlinedocs.microchip.com"
OXYGEN_TOPIC = r"^GUID-[A-Fa-f0-9-]+\.html$"
MEDIA_TYPES = {".gif": "image/gif", ".png": "image/png", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".svg": "image/svg+xml", ".webp": "image/webp"}


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """The first match's group, or null."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def is_http(value: Column) -> Column:
    return F.coalesce(value.rlike("^(?i)https?:"), F.lit(False))


def stem_of_name(name: Column) -> Column:
    """A file name without its last suffix; a leading dot begins no suffix."""
    return F.regexp_replace(name, r"(?s)(?<=[^/])(?<!^\.)\.[^./]+$", "")


def url_stem(url: Column) -> Column:
    plain = F.replace(path(url), F.lit("+"), F.lit("%2B"))
    decoded = F.coalesce(F.try_url_decode(plain), path(url))
    name = F.regexp_extract(F.regexp_replace(decoded, "/+$", ""), r"([^/]*)$", 1)
    return F.coalesce(F.nullif(F.btrim(F.regexp_replace(stem_of_name(name), "[^A-Za-z0-9._-]", "_"), F.lit("._")), F.lit("")), F.lit("document"))


def sanitize_stem(text: Column) -> Column:
    clean = F.regexp_replace(strip(F.coalesce(text, F.lit(""))), "[^A-Za-z0-9._-]+", "-")
    return F.coalesce(F.nullif(F.btrim(clean, F.lit("-._")), F.lit("")), F.lit("document"))


def source_route(url: Column) -> Column:
    """The vendor whose adapter takes the address, the first that matches; null for a plain download."""
    ti = host(url).endswith("ti.com") & path(url).rlike(TI_VIEWER)
    return F.when(ti, "ti").when(host(url) == OXYGEN_HOST, "microchip")


def ti_part(url: Column) -> Column:
    return F.coalesce(F.lower(found(path(url), TI_PART)), F.lit("datasheet"))


def ti_litnum(html: Column) -> Column:
    return found(html, TI_LITNUM)


def root_guid(url: Column) -> Column:
    return found(url, GUID, 0)


def ti_guids(html: Column) -> Column:
    """Section identifiers in order, the first spelling of each."""
    every = F.regexp_extract_all(html, F.lit(TI_SECTION), F.lit(1))
    upper = F.transform(every, F.upper)
    return F.filter(every, lambda g, i: F.array_position(upper, F.upper(g)) == i + 1)


def toc_rows(pages: DataFrame, key: str, items: Column) -> DataFrame:
    """(key, pos, item): the items of each row, each once, in order of first appearance. For long lists: one aggregation."""
    rows = pages.select(key, F.posexplode(items).alias("at", "item")).groupBy(key, F.upper("item").alias("__upper")).agg(F.min("at").alias("at"), F.min_by("item", "at").alias("item"))
    return rows.select(key, (F.row_number().over(Window.partitionBy(key).orderBy("at")) - 1).cast("long").alias("pos"), "item")


@F.pandas_udf(T.StringType())
def _unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None else entities.unescape(t))


def unescaped(text: Column) -> Column:
    """With character references as characters; texts without one do not go to Python."""
    return F.coalesce(_unescaped(F.when(text.contains("&"), text)), text)


def page_title(html: Column, decode=unescaped, trim=strip) -> Column:
    """The title as text, null where nothing is left; ``decode`` and ``trim`` are what is done to its source."""
    return F.nullif(trim(decode(found(html, r"(?is)<title[^>]*>(.*?)</title>"))), F.lit(""))


def article(html: Column) -> Column:
    return F.regexp_extract(html, r"(?is)<article\b.*?</article>", 0)


def links(html: Column) -> Column:
    """Targets of the page's links in order, each once."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r"""(?is)<a\b[^>]*?href=["']([^"']*)["']"""), F.lit(1)))


def oxygen_topics(html: Column) -> Column:
    scope = F.coalesce(found(html, r"""(?is)<nav\b[^>]*id=["']wh_publication_toc["'].*?</nav>""", 0), html)
    return F.filter(links(scope), lambda x: x.rlike(OXYGEN_TOPIC))


def media_type(url: Column) -> Column:
    suffix = F.lower(F.regexp_extract(path(url), r"(\.[^./]+)$", 1))
    column = F.lit("image/png")
    for ext, kind in MEDIA_TYPES.items():
        column = F.when(suffix == ext, kind).otherwise(column)
    return column


def without_dots(url: Column) -> Column:
    """An absolute address without the segments ``.`` and ``..`` of its path; ``..`` at the root goes nowhere."""
    head, tail = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1), F.regexp_extract(url, r"([?#].*)$", 1)
    parts = F.slice(F.split(path(url), "/", -1), F.lit(2), F.lit(2**30))
    step = lambda a, x: F.when(x == ".", a).when(x == "..", F.slice(a, F.lit(1), F.greatest(F.lit(0), F.size(a) - 1))).otherwise(F.concat(a, F.array(x)))
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    kept = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path(url).rlike(r"/\.{1,2}(/|$)") & (head != ""), F.concat(head, F.lit("/"), F.array_join(kept, "/"), tail)).otherwise(url)


def resolve(base: Column, src: Column) -> Column:
    """An address relative to a page: absolute, of the same scheme, from the root, or from the page's folder; dot segments resolved."""
    scheme, root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(F.regexp_replace(base, r"[?#].*$", ""), r"^(.*://[^/]*(?:/.*/|/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    joined = F.when(src.startswith("/"), F.concat(root, src)).otherwise(F.concat(folder, src))
    return F.when(src.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), src).when(src.startswith("//"), F.concat(scheme, src)).otherwise(without_dots(joined))


def html_wrap(title: Column, body: Column) -> Column:
    for old, new in {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;", "'": "&#x27;"}.items():
        title = F.replace(title, F.lit(old), F.lit(new))
    return F.concat(F.lit('<!DOCTYPE html><html><head><meta charset="utf-8"><title>'), title, F.lit("</title></head><body>"), body, F.lit("</body></html>"))


def looks_like_pdf(content: Column) -> Column:
    return F.substring(content, 1, 4) == F.lit(b"%PDF")


def suffix_of(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"(\.[^./]+)$", 1))
