"""Fetching over HTTP: an agent's name, certificates, a time limit, the address after redirects, and PDF downloads that are PDFs."""

from __future__ import annotations

import ssl
import urllib.request

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import urls
from .registry import Fetch, fetched

#: Seconds for a page and for a section; vendors refuse the library's own agent.
PAGE_SECONDS, SECTION_SECONDS, AGENT = 60, 30, "Mozilla/5.0 (compatible; docloom)"


def http_fetch(url: str, seconds: float = SECTION_SECONDS, agent: str = AGENT, certificates: str | None = None) -> tuple[bytes, str]:
    """(body, address after redirects). Raises OSError or ValueError."""
    request = urllib.request.Request(url, headers={"User-Agent": agent})
    secure = ssl.create_default_context(cafile=certificates) if url.lower().startswith("https:") else None
    with urllib.request.urlopen(request, timeout=seconds, context=secure) as answer:
        return answer.read(), answer.geturl()


def page_fetch(url: str) -> tuple[bytes, str]:
    return http_fetch(url, PAGE_SECONDS)


def downloads(pages: DataFrame, fetch: Fetch = page_fetch) -> DataFrame:
    """(url, source_name, stem, suffix, content, error) of each distinct address: PDF downloads by their content's first bytes.

    What cannot be had, or is no PDF (a login page, say), has a null content and an error.
    """
    rows = fetched(pages.select("url").distinct(), "url", fetch)
    stem = urls.url_stem(F.col("url"))
    good = urls.looks_like_pdf(F.col("body"))
    error = F.when(F.col("body").isNull(), "failed to download").when(~good, "not a PDF")
    return rows.select("url", F.concat(stem, F.lit(".pdf")).alias("source_name"), stem.alias("stem"), F.lit(".pdf").alias("suffix"), F.when(good, F.col("body")).alias("content"), error.alias("error"))
