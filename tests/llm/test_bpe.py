import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from docloom.llm.bpe import bpe_digests, decoded, packed, unpacked

PATH = public_tokenizers.path("byte_bpe_50k.json")


def rows():
    r = random.Random(3)
    parts = ["the", " the", "Straße", "é", " ", "\n", "\t", "  ", "<|endoftext|>", "12", "!!'s", "日本", "'ll", "՘", "֋", "👍🏽", "\x85", "\x1c", "\n\nspecial:", "￿"]
    out = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 60)))) for i in range(150)]
    return [*out, (500, None), (501, ""), (502, "same"), (502, "same"), (None, "x"), (503, "<|endoftext|>"), (504, "rareword " * 3), (505, "word " * 5000)]


@pytest.mark.parametrize("chunk_chars, buckets", [(10**7, 2048), (500, 7), (0, 1)])
def test_equals_library(spark, chunk_chars, buckets):
    t = Tokenizer.from_file(PATH)
    data = rows()
    df = spark.createDataFrame([(i, x, 1) for i, x in data], "doc_id long, text string, n_tokens int")
    want = []
    for i, x in data:
        ids = t.encode(x or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = [tuple(r) for r in bpe_digests(df, PATH, chunk_chars, buckets).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe_digests(df.limit(0), PATH, chunk_chars, buckets).count() == 0


def test_decoding_equals_library(spark):
    t = Tokenizer.from_file(PATH)
    texts = dict(enumerate([x or "" for _, x in rows()]))
    ids = {k: t.encode(x, add_special_tokens=False).ids for k, x in texts.items()} | {900: None, 901: [], 902: [10**6]}
    cut = {1000 + k: x[1:-1] for k, x in ids.items() if x}  # may begin or end within a character
    df = spark.createDataFrame([(k, x) for k, x in (ids | cut).items()], "key long, ids array<int>")
    got = {r.key: r.text for r in decoded(df, PATH).collect()}
    assert got == {k: t.decode(x or [], skip_special_tokens=False) for k, x in (ids | cut).items()}


def test_plan_holds_the_joins(spark):
    """By position and by id, at any size; no word table is broadcast."""
    df = spark.createDataFrame(rows(), "doc_id long, text string")
    plan = bpe_digests(df, PATH)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter, (chunk") == 2 and "Join Inner, (id" in plan, plan


@pytest.mark.parametrize("first", [None, "7"])
def test_texts_are_stored_once(spark, first):
    """They lie in buckets by chunk, so both joins read them without an exchange; the catalog keeps nothing."""
    df = spark.createDataFrame(rows(), "doc_id long, text string")
    want = sorted(map(tuple, bpe_digests(df, PATH).collect()), key=str)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1"} | ({"spark.sql.adaptive.coalescePartitions.initialPartitionNum": first} if first else {})
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = bpe_digests(df, PATH, 500)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(chunk") == 2 and plan.count("SortMergeJoin [chunk") == 2, plan
        assert sorted(map(tuple, out.collect()), key=str) == want
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert not any(t.name.startswith("chunks") for t in spark.catalog.listTables())


def test_numbers_pack():
    for x in ([], [0], [127, 128, 16383, 16384, 2**21, 2**31 - 1, 0, 5]):
        assert unpacked(packed(np.array(x, np.int64))).tolist() == x
