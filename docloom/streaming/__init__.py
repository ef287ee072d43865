"""Structured Streaming: the text passes are stateless and run on streams as they are; exact de-duplication keeps bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.plans.convert import text_pipeline


def cleaned_stream(docs: DataFrame, column: str = "md") -> DataFrame:
    return text_pipeline(docs, column)


def distinct_contents(images: DataFrame, time: str, late: str = "1 hour") -> DataFrame:
    """The first of each content (doc_id, sha256) within the watermark."""
    return images.withWatermark(time, late).dropDuplicatesWithinWatermark(["doc_id", "sha256"])


def counts_by_window(events: DataFrame, time: str, key: str, width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"))
