"""Extension points: vendor sources, fetchers and extractors.

A source is a pair of a predicate on addresses and a plan. Fetching is a function given by the caller, run in ``mapInPandas``
with a bounded number of partitions; a failed fetch is a null body. OCR, formula recognition, vectorising and PDF layout are hooks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.plans.tables import stored

from . import urls
from .html import html_to_md, image_sources, inline_images, oxygen_topic, ti_fragment

#: Fetches at a time.
FETCHERS = 6
#: Address to body, or to (body, address after redirects).
Fetch = Callable[[str], "bytes | tuple[bytes, str] | None"]


@dataclass(frozen=True)
class Source:
    """``matches``: address → condition. ``toc``: html → topics. ``topic_url``: (address, topic) → address. ``body``: html → fragment.

    ``redirected``: addresses of topics and the stem follow from the page's address after redirects.
    """

    name: str
    matches: Callable[[Column], Column]
    toc: Callable[[Column], Column]
    topic_url: Callable[[Column, Column], Column]
    body: Callable[[Column], Column]
    stem: Callable[[Column, Column], Column]
    image_base: Callable[[Column, Column], Column]
    redirected: bool = False


def _base(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"\?.*$", ""), "/+$", "")


TI = Source(
    "ti",
    lambda url: urls.source_route(url) == "ti",
    urls.ti_guids,
    lambda url, topic: F.concat(_base(url), F.lit("/"), topic, F.lit("?raw=1")),
    ti_fragment,
    lambda url, html: urls.ti_part(url),
    lambda url, topic_url: F.lit("https://www.ti.com/"),
)
MICROCHIP = Source(
    "microchip",
    lambda url: urls.host(url) == urls.OXYGEN_HOST,
    urls.oxygen_topics,
    lambda url, topic: urls.resolve(url, topic),
    oxygen_topic,
    lambda url, html: urls.sanitize_stem(F.coalesce(urls.page_title(html), urls.root_guid(url), F.lit("datasheet"))),
    lambda url, topic_url: topic_url,
    redirected=True,
)
_SOURCES: list[Source] = [TI, MICROCHIP]
_HOOKS: dict[str, Callable] = {}


def register_source(source: Source, first: bool = False) -> None:
    _SOURCES.insert(0 if first else len(_SOURCES), source)


def sources() -> list[Source]:
    return list(_SOURCES)


def route(url: Column) -> Column:
    """The first source that matches, or null."""
    out = F.lit(None).cast("string")
    for source in reversed(_SOURCES):
        out = F.when(F.coalesce(source.matches(url), F.lit(False)), source.name).otherwise(out)
    return out


def register(kind: str, hook: Callable) -> None:
    """``kind``: pdf_extractor, ocr, formula_model or vectorizer; ``hook``: a function of columns."""
    if kind not in ("pdf_extractor", "ocr", "formula_model", "vectorizer"):
        raise ValueError(kind)
    _HOOKS[kind] = hook


def hook(kind: str) -> Callable | None:
    return _HOOKS.get(kind)


def fetched(rows: DataFrame, url: str, fetch: Fetch, workers: int = FETCHERS) -> DataFrame:
    """``rows`` with ``body`` (binary) and ``final`` (the address after redirects): what ``fetch`` returns for column ``url``, null bodies where it fails."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [_try(fetch, x) for x in batch[url]]
            yield batch.assign(body=[x[0] for x in answers], final=[x[1] for x in answers])

    return rows.repartition(workers).mapInPandas(run, ", ".join(f"`{n}` {t}" for n, t in [*rows.dtypes, ("body", "binary"), ("final", "string")]))


def _try(fetch: Fetch, url: str) -> tuple[bytes | None, str]:
    try:
        answer = fetch(url)
    except Exception:  # a page that cannot be had is a null body, as for any other failed fetch
        answer = None
    return answer if isinstance(answer, tuple) else (answer, url)


def text_of(body: Column) -> Column:
    """UTF-8, with U+FFFD for what is none."""
    return F.make_valid_utf8(body.cast("string"))


def section_assemble(sections: DataFrame) -> DataFrame:
    """(url, body) from (url, pos, body): bodies that were found, in order, joined by line feeds."""
    found = sections.filter(F.col("body").isNotNull() & (F.col("body") != ""))
    rows = found.groupBy("url").agg(F.array_sort(F.collect_list(F.struct("pos", "body"))).alias("s"))
    return rows.select("url", F.array_join(F.transform("s", lambda x: x["body"]), "\n").alias("body"))


def fetch_documents(pages: DataFrame, fetch: Fetch, workers: int = FETCHERS) -> DataFrame:
    """(url, source, stem, html, error): vendor documents (url) assembled from their topics, images inlined.

    Each address is fetched once; what is fetched is stored. A document whose page, topics or contents cannot be had has a null
    html and an error; topics that fail beside others that do not are left out.
    """
    landing = pages.select("url").distinct().withColumn("source", route(F.col("url"))).filter("source is not null")
    landing = stored(fetched(landing, "url", fetch, workers).withColumn("html", text_of(F.col("body"))).drop("body"), "landing")
    out = None
    for source in _SOURCES:
        own = landing.filter(F.col("source") == source.name).withColumn("at", F.col("final" if source.redirected else "url"))
        topics = own.select("url", "at", F.posexplode(source.toc(F.col("html"))).alias("pos", "topic")).withColumn("topic_url", source.topic_url(F.col("at"), F.col("topic")))
        found = fetched(topics.drop("at"), "topic_url", fetch, workers).filter("body is not null").select("url", "pos", "topic_url", source.body(text_of(F.col("body"))).alias("body"))
        bodies = stored(found.withColumn("base", source.image_base(F.col("url"), F.col("topic_url"))), "topics")
        wanted = bodies.select("url", "pos", F.explode(image_sources("body", "base")).alias("at"))
        images = fetched(wanted.select("at").distinct(), "at", fetch, workers).filter("body is not null").select("at", F.col("body").alias("bytes"))
        images = wanted.join(images, "at").groupBy("url", "pos").agg(F.map_from_entries(F.collect_list(F.struct("at", "bytes"))).alias("fetched"))
        whole = bodies.join(images, ["url", "pos"], "left").withColumn("body", inline_images("body", "base", "fetched"))
        about = own.select("url", "source", source.stem(F.col("at"), F.col("html")).alias("stem"), F.col("html").isNull().alias("lost"), F.coalesce(F.size(source.toc(F.col("html"))) > 0, F.lit(False)).alias("topics"))
        part = about.join(section_assemble(whole.select("url", "pos", "body")), "url", "left")
        error = F.when(F.col("lost"), "failed to fetch").when(~F.col("topics"), "no sections found").when(F.col("body").isNull(), "no section content retrieved")
        part = part.select("url", "source", "stem", F.when(F.col("body").isNotNull(), urls.html_wrap(F.col("stem"), F.col("body"))).alias("html"), error.alias("error"))
        out = part if out is None else out.unionByName(part)
    return out


def read_files(spark, path: str) -> DataFrame:
    """(path, source_name, stem, suffix, content) of the .pdf and .html files below ``path``."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    rows = rows.select("path", name.alias("source_name"), urls.stem_of_name(name).alias("stem"), urls.suffix_of(name).alias("suffix"), "content")
    return rows.filter(F.col("suffix").isin(".pdf", ".html"))


def route_of(suffix: Column) -> Column:
    """Which reader a file goes to: html or pdf."""
    return F.when(suffix == ".html", "html").otherwise("pdf")


def extracted(files: DataFrame) -> DataFrame:
    """``files`` with md: HTML by the parser here, PDF by the registered extractor (null without one)."""
    pdf = hook("pdf_extractor")
    kind = route_of(F.col("suffix"))
    html = F.when(kind == "html", html_to_md(text_of(F.col("content"))))
    return files.withColumn("md", html.otherwise(pdf(F.col("content")) if pdf else F.lit(None).cast("string")))
