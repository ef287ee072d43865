import datetime
import os
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docloom.llm.compaction import ShardStore, compacted


def rows(spark, lo, hi, parts):
    return spark.range(lo, hi, 1, parts).select(F.when(F.col("id") % 7 != 0, F.col("id")).alias("doc_id"), F.repeat(F.lit("é x"), (F.col("id") % 50).cast("int")).alias("text"), F.lit(None).cast("string").alias("bytes"))


def test_rows_survive_and_sizes_meet_the_target(spark, tmp_path):
    every = rows(spark, 0, 4000, 6)
    store = compacted(every, f"file://{tmp_path}/s", F.pmod(F.hash("text", F.coalesce("doc_id", F.lit(0))), F.lit(5)), 5, target=40_000, fan=3)
    assert sorted(store.read().collect(), key=str) == sorted(every.collect(), key=str)
    found = store.manifest()
    assert len(found["shards"]) < 15 and not store.plan(found["shards"])
    assert all(x["bytes"] <= 60_000 for x in found["shards"])
    assert sorted(store.versions()) == list(range(1, found["version"] + 1))


def test_versions_and_conflicts(spark, tmp_path):
    store = ShardStore(spark, f"file://{tmp_path}/s", target=10**6, fan=2)
    store.append(rows(spark, 0, 10, 1))
    base = store.manifest()
    store.append(rows(spark, 10, 30, 2))
    with pytest.raises(RuntimeError):
        store.commit(base, [], base["schema"])
    store.append(rows(spark, 0, 0, 1))
    assert store.read().count() == 30 and store.read(1).count() == 10
    assert store.compact() and store.read(1).count() == 10 and store.read().count() == 30
    assert store.compact() is None and store.vacuum() == 0 and store.vacuum(keep=1) == 0 and store.read(1).count() == 10
    assert store.vacuum(keep=1, age=-60) > 0 and store.read().count() == 30 and store.versions() == [store.manifest()["version"]]
    with pytest.raises(ValueError):
        store.append(spark.range(3))
    with pytest.raises(ValueError):
        ShardStore(spark, f"file://{tmp_path}/empty").read()


def test_a_killed_committer_blocks_nobody(spark, tmp_path, monkeypatch):
    store = ShardStore(spark, f"file://{tmp_path}/s", fan=2)
    store.append(rows(spark, 0, 10, 1))

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(os, "link", die)
        with pytest.raises(KeyboardInterrupt):
            store.append(rows(spark, 10, 20, 1))
    assert store.versions() == [1] and store.read().count() == 10
    other = ShardStore(spark, f"file://{tmp_path}/s", fan=2)
    assert other.append(rows(spark, 20, 25, 1)) == 2 and store.read().count() == 15


def test_two_writers_and_an_open_append(spark, tmp_path):
    one, two = (ShardStore(spark, f"file://{tmp_path}/s", fan=2) for _ in range(2))
    one.append(rows(spark, 0, 10, 1))
    base = two.manifest()
    one.append(rows(spark, 10, 20, 1))
    with pytest.raises(RuntimeError):  # the later of two commits on one version
        two.commit(base, base["shards"], base["schema"])
    assert two.manifest()["version"] == 2 and one.read().count() == 20
    rows(spark, 50, 60, 1).write.parquet(f"file://{tmp_path}/s/data/open")  # written, not committed
    one.vacuum(keep=1)
    assert spark.read.parquet(f"file://{tmp_path}/s/data/open").count() == 10


def test_types_ties_and_large_row_groups(spark, tmp_path):
    long = "word " * 300_000
    kind = "k long, t timestamp, d decimal(20,4), m map<string,array<int>>, x string, path string"
    data = [(i, datetime.datetime(2020, 1, 1, 0, 0, i % 60, 123456), Decimal("1.2345") * i, {"a": [1, None]}, long if i == 3 else "x", None) for i in range(3000)] + [(None,) * 6] * 2
    df = spark.createDataFrame(data, kind).repartition(6)
    store = compacted(df, f"file://{tmp_path}/s", F.coalesce(F.col("k") % 3, F.lit(0)), 3, fan=2)
    key = lambda r: str(r)[:80]
    assert sorted(map(key, store.read().collect())) == sorted(map(key, df.collect())) and store.read().columns == df.columns
    merged = [x["name"] for x in store.manifest()["shards"] if "merged" in x["name"]]
    assert merged and all(pq.ParquetFile(f"{tmp_path}/s/{x}").num_row_groups == 1 for x in merged)


@pytest.mark.parametrize("arrival", [None, -1, 5])
def test_rows_without_arrival_are_an_error(spark, tmp_path, arrival):
    with pytest.raises(ValueError):
        compacted(rows(spark, 0, 10, 1), f"file://{tmp_path}/s", F.when(F.col("text") != "", F.lit(0)).otherwise(F.lit(arrival).cast("int")), 5)
    assert ShardStore(spark, f"file://{tmp_path}/s").versions() == []
