from pyspark.sql import functions as F

from docloom.llm.mixing import mix, mixed_documents, targets


def fill(sizes):
    """Targets by resharing the excess in rounds."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, got, free = 1.5 * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while total > 1e-9 and free:
        for s in free:
            got[s] += total * w[s] / sum(w[x] for x in free)
            pass
        total = 0.0
        over = {s for s in free if got[s] > 2 * sizes[s]}
        for s in over:
            total += got[s] - 2 * sizes[s]
            got[s] = 2.0 * sizes[s]
        free -= over
        if not over:
            break
    return got


def rows(spark):
    data = [(i, f"s{i % 4}" if i % 4 else None, "w " * (i % 7) + "\n\tx", 3, "k") for i in range(200)]
    data += [(900, "big", "a b " * 3000, 3, "k"), (901, "empty", None, 3, "k"), (902, "empty", "", 3, "k"), (None, "s1", "a b", 3, "k"), (5, "s1", "a b", 3, "k"), (5, "s1", "a b", 3, "k")]
    return spark.createDataFrame(data, "doc_id long, source string, text string, n_chars int, target string"), data


def test_targets_and_budgets(spark):
    df, data = rows(spark)
    sizes: dict = {}
    for _, s, t, *_ in data:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = fill(sizes)
    got = mix(df).join(df.select("doc_id", "source").distinct(), "doc_id").collect()
    full = mix(df).collect()
    assert len(full) == len(data)
    by: dict = {}
    for r in full:
        assert 0 <= r.taken <= 2 * r.size
        by.setdefault((r.source_size, r.target), 0)
        by[r.source_size, r.target] += r.taken
    for s in sizes:
        hit = [v for (z, t), v in by.items() if z == sizes[s] and abs(t - want[s]) < 1e-6]
        assert hit and (sizes[s] == 0 or abs(hit[0] - want[s]) <= 1), (s, want[s], by)
    assert sorted(full, key=str) == sorted(mix(df.repartition(5)).collect(), key=str) and got
    assert mix(df.limit(0)).count() == 0


def test_documents_hold_the_words_taken(spark):
    df, _ = rows(spark)
    out = mixed_documents(df)
    assert out.columns == df.columns
    words = out.groupBy("source").agg(F.sum(F.size(F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"))).alias("n"))
    goal = {r["source"]: r["n"] for r in words.collect()}
    for r in mix(df).join(df.select("doc_id", "source").dropDuplicates(["doc_id"]), "doc_id").groupBy("source").agg(F.first("target").alias("t")).collect():
        assert abs(goal.get(r["source"], 0) - r["t"]) <= 1


def test_targets_alone(spark):
    for sizes in ({"a": 1, "b": 1000, "c": 5}, {"a": 100}, {"a": 0, "b": 0}, {"a": 7, "b": 7, "c": 7, None: 7}):
        df = spark.createDataFrame([("n" if s is None else "s" + s, n) for s, n in sizes.items()], "__source string, source_size long")
        want = fill(sizes)
        for r in targets(df).collect():
            assert abs(r.target - want[None if r["__source"] == "n" else r["__source"][1:]]) < 1e-6
