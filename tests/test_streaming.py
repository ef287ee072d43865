"""The text passes and the stateful operators on streams, against the same rows as tables."""

import datetime

from pyspark.sql import functions as F

from docloom.plans.convert import text_pipeline
from docloom.streaming import cleaned_stream, counts_by_window, distinct_contents


def drained(stream, name, mode="append"):
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def files(spark, tmp_path, rows, schema):
    for i, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{i:02d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/*")


def test_text_passes(spark, tmp_path):
    schema = "doc_id long, md string"
    rows = [[(1, "read - only $V _ { C R }$ then VCR"), (2, None)], [(3, "x\n" + "1\n" * 6 + "y"), (4, "")]]
    got = {r.doc_id: r.md for r in drained(cleaned_stream(files(spark, tmp_path, rows, schema)), "cleaned").collect()}
    assert got == {r.doc_id: r.md for r in text_pipeline(spark.createDataFrame(rows[0] + rows[1], schema)).collect()} and got[3] == "x\ny"


def test_distinct_contents(spark, tmp_path):
    schema = "doc_id long, sha256 string, at timestamp"
    at = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    rows = [[(1, "a", at(0)), (1, "a", at(1)), (2, "a", at(2))], [(1, "a", at(3)), (1, "b", at(4)), (1, None, at(4))]]
    got = drained(distinct_contents(files(spark, tmp_path, rows, schema), "at"), "distinct_rows").collect()
    assert sorted((r.doc_id, r.sha256 or "") for r in got) == [(1, ""), (1, "a"), (1, "b"), (2, "a")]


def test_counts_by_window(spark, tmp_path):
    schema = "at timestamp, kind string"
    at = lambda h, m: datetime.datetime(2024, 1, 1, h, m)
    rows = [[(at(0, 1), "a"), (at(0, 9), "a"), (at(0, 11), "a"), (at(0, 2), None)], [(at(5, 0), "b"), (at(0, 3), "late")]]
    got = drained(counts_by_window(files(spark, tmp_path, rows, schema), "at", "kind"), "counts", "complete")
    found = {(r.m, r.kind): r.n for r in got.select(F.minute("window.start").alias("m"), "kind", "n").collect()}
    assert found[0, "a"] == 2 and found[10, "a"] == 1 and found[0, None] == 1 and found[0, "b"] == 1
