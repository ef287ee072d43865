"""Convert files or a document's address to Markdown with image files: ``python -m docloom INPUT... [OUTPUT] [options]``."""

from __future__ import annotations

import argparse
import os
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.plans.convert import ConvertOptions, convert, summary
from docloom.plans.export import export
from docloom.sources import registry
from docloom.sources.fetch import downloads, page_fetch


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="docloom", description="Convert PDF and HTML documents to Markdown with image files.")
    parser.add_argument("input", help="a .pdf or .html file, a folder or pattern of them, or an http(s) address")
    parser.add_argument("output", nargs="?", help="folder of the source's copy, images and Markdown (default: the input's folder, or the current one for an address)")
    parser.add_argument("-f", "--force", action="store_true", help="overwrite outputs")
    parser.add_argument("--no-ocr", dest="ocr", action="store_false", help="do not use the registered OCR")
    parser.add_argument("--no-postprocess", dest="postprocess", action="store_false", help="keep all images as they are")
    return parser.parse_args(argv)


def is_address(value: str) -> bool:
    return value.lower().startswith(("http:", "https:"))


def default_output(value: str) -> str:
    if is_address(value):
        return os.getcwd()
    path = Path(value).resolve()
    return str(path if path.is_dir() else path.parent)


def sources_of(spark: SparkSession, value: str) -> DataFrame:
    """(source_name, stem, suffix, content, error) of what the argument names."""
    if not is_address(value):
        return registry.read_files(spark, value).withColumn("error", F.lit(None).cast("string"))
    pages = spark.createDataFrame([(value,)], "url string")
    if pages.select(registry.route(F.col("url"))).first()[0] is None:
        return downloads(pages)
    found = registry.fetch_documents(pages, page_fetch)
    return found.select(F.concat("stem", F.lit(".html")).alias("source_name"), "stem", F.lit(".html").alias("suffix"), F.encode("html", "UTF-8").alias("content"), "error")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    asked = arguments(sys.argv[1:] if argv is None else argv)
    spark = spark or SparkSession.builder.appName("docloom").getOrCreate()
    rows = sources_of(spark, asked.input)
    bad = rows.filter("error is not null").select("error").first()
    if bad or rows.isEmpty():
        print(f"Error: {bad[0] if bad else 'no .pdf or .html file'}: {asked.input}", file=sys.stderr)
        return 1
    docs = registry.extracted(rows).withColumn("doc_id", F.xxhash64("source_name"))
    if not docs.filter("md is null").isEmpty():
        print("Error: PDF input needs a registered pdf_extractor", file=sys.stderr)
        return 1
    done = convert(docs.select("doc_id", "source_name", "stem", "md"), options=ConvertOptions(postprocess=asked.postprocess, ocr=asked.ocr, force=asked.force))
    uri = Path(asked.output or default_output(asked.input)).resolve().as_uri()
    try:
        n = export(done, uri, rows, asked.force)
    except FileExistsError as e:
        print(f"Error: {e}", file=sys.stderr)
        return 1
    print(f"{n} files in {uri}")
    for name, value in summary(done.stats).first().asDict().items():
        if value:
            print(f"  {name}: {value}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
