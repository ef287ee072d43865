import numpy as np
from pyspark.sql import functions as F

from docloom.llm.topk import Lists, top_k


def brute(rows, k):
    good = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in {(i, tuple(v)) for i, v in good if i % 50 == 0}:
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(b) == len(a))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_against_brute_force(spark):
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.round(r.normal(size=8) * 0.2, 2)]) for i in range(400)]
    rows += [(400, None), (401, [None] * 8), (402, [float("nan")] + [0.0] * 7), (450, [float("inf")] * 8), (500, [0.0] * 8), (501, rows[7][1]), (502, rows[7][1]), (503, []), (550, [1.0, -2.0]), (551, [1.0, 1.0]), (552, [-1e9, 3.0]), (None, [0.1] * 8), (553, [1e12, 1e12])]
    df = spark.createDataFrame([(*x, 1) for x in rows], "vec_id long, embedding array<float>, score int")
    got = sorted(tuple(x) for x in top_k(df, F.col("vec_id") % 50 == 0, 5, shard_rows=60, block_rows=4).drop("scored").collect())
    assert got == brute(rows, 5)
    assert top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert top_k(df.filter("vec_id = 400"), F.col("vec_id") % 50 == 0).count() == 0


def test_stops_early():
    r = np.random.default_rng(1)
    x = r.integers(-5, 5, size=(5000, 4))
    x[17] = [200, 200, 0, 0]
    x[18:40] = [150, 150, 0, 0]
    lists = Lists(np.arange(5000), x)
    rows, scores, scored = lists.search(-1, np.array([3, 3, 0, 0]), 5)
    assert rows.tolist() == [17, 18, 19, 20, 21] and scored < 500


def test_repeated_queries_and_clashing_columns(spark):
    rows = [(0, [0.5, 0.5]), (0, [0.25, -1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [-1.0, 2.0])]
    df = spark.createDataFrame([(*x, 7, "s") for x in rows], "vec_id long, embedding array<float>, shard int, dim string")
    got = [tuple(r)[:4] for r in top_k(df, F.col("vec_id") == 0, 4, shard_rows=2).orderBy("rank").collect()]
    v = lambda a, b: int(256 * a * 64) + int(-256 * 256 * b)
    assert got == [(0, 1, 1, v(1, 1)), (0, 2, 2, v(1, 1)), (0, 3, 2, v(1, 1)), (0, 4, 3, v(-1, 2))]


def test_bound_of_the_sample_stops_other_shards(spark):
    """Few vectors score high: with a bound most shards are left at once. Without a spread of scores nothing can be skipped."""
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.normal(size=4) * 0.01]) for i in range(1, 4000)] + [(5000 + i, [1.0, 1.0, 0.0, 0.0]) for i in range(600)] + [(0, [1.0, 1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = top_k(df, F.col("vec_id") == 0, 5, shard_rows=200).orderBy("rank").collect()
    assert [x.vec_id for x in got] == [5000, 5001, 5002, 5003, 5004] and got[0].scored < 2500
    flat = [(i, [float(x) for x in r.choice([-1, 1], size=32)]) for i in range(600)]
    got = top_k(spark.createDataFrame(flat, "vec_id long, embedding array<float>"), F.col("vec_id") == 0, 5, shard_rows=200)
    assert got.first().scored > 500
