import random
import re
from itertools import combinations

import numpy as np
import pytest

from docloom.llm import jaccard_join as jj


def sets(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n, percent):
    s = [sets(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(s[i] & s[j])
        if both and 100 * both >= percent * len(s[i] | s[j]):
            parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return [(d, len(s[i]), low.get(root(i)) if s[i] else d) for i, (d, _) in enumerate(rows)]


def corpus(seed, n=220):
    r = random.Random(seed)
    word = lambda: r.choice("abcdefghijklmnop") + r.choice(["", "x", "É", "Z"]) + str(r.randint(0, 9))
    passage = [word() for _ in range(30)]
    rows = []
    for i in range(n):
        if rows and r.random() < 0.6:
            w = (r.choice(rows)[1] or "").split(" ")
            for _ in range(r.randint(0, 4)):
                k = r.randint(0, len(w))
                w[k : k + r.randint(0, 1)] = [word()] * r.randint(0, 1)
        else:
            w = [word() for _ in range(r.choice([0, 1, 2, 5, 12, 20, 40, 80, 300]))]
            if r.random() < 0.4:
                w += passage
        text = " ".join(w)
        rows.append((i, text.upper() if r.random() < 0.1 and text.isascii() else text))
    return [*rows, (900, None), (901, " \t\n"), (901, " \t\n"), (5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (None, "only here is null")]


@pytest.mark.parametrize("seed,n,percent", [(1, 3, 90), (2, 5, 80)])
def test_against_brute_force(spark, seed, n, percent):
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id long, text string, component_id int, node string")
    got = [tuple(r) for r in jj.components(df, n, percent).collect()]
    want = brute(rows, n, percent)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert len({w[2] for w in want}) < 0.8 * len(want)


def test_representatives(spark):
    rows = [(d, t) for d, t in corpus(4) if d is not None]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, component int")
    want = {(d if k else ("empty", d)) for d, k, c in brute(rows, 5, 80) if d == c}
    out = jj.representatives(df).collect()
    assert {r.doc_id if sets(r.text, 5) else ("empty", r.doc_id) for r in out} == want and len([r for r in out if r.doc_id == 901]) == 2
    assert len([r for r in out if sets(r.text, 5)]) == len({c for _, k, c in brute(rows, 5, 80) if k})
    assert jj.components(df.limit(0)).count() == 0 and jj.representatives(df.limit(0)).count() == 0


def test_similar_sets_share_a_signature():
    r = np.random.default_rng(0)
    for percent in (80, 90):
        for size in [*range(1, 60), 90, 140, 141, 400, 1000, 5000]:
            for _ in range(20):
                base = np.unique(r.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
                drop = r.integers(0, max(1, int(size * (100 - percent) / 100)) + 1)
                add = r.integers(0, max(1, int(size * (100 - percent) / 100)) + 1)
                other = np.unique(np.concatenate([r.permutation(base)[drop:], r.integers(0, 2**63, add).astype(np.uint64) * np.uint64(2) + np.uint64(1)]))
                if jj.similar(base, other, percent) and not np.array_equal(base, other):
                    for frequent in (None, np.sort(r.permutation(base)[: size // 2])):
                        assert len(np.intersect1d(jj.signatures(base, percent, frequent), jj.signatures(other, percent, frequent))), (size, percent)


def test_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 103), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in jj.connected(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 103: 100}


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK_SETS", 5)
    monkeypatch.setattr(jj, "SLICE", 7)
    rows = corpus(6, 120)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in jj.components(df, 3, 80).collect()), key=str) == sorted(brute(rows, 3, 80), key=str)


def test_overlaps():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 60, r.integers(1, 50)).astype(np.uint64)) for _ in range(40)]
    got = jj.overlaps(sets[:25], sets[10:], 40)
    assert got.any() and got.tolist() == [[jj.similar(a, b, 40) for b in sets[10:]] for a in sets[:25]]


@pytest.mark.parametrize("bits", [64, 5])
def test_unequal_sets_with_equal_numbers(spark, bits):
    """With five bits almost all first numbers are shared; the second ones tell the sets apart."""
    rows = corpus(9, 90)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in jj.components(df, 3, 90, bits=bits).collect()), key=str) == sorted(brute(rows, 3, 90), key=str)


def test_chain_of_neighbours(spark, monkeypatch):
    """Each set is similar to the next only, so groups stay open after the first comparison; small blocks, a component larger than a block."""
    monkeypatch.setattr(jj, "BLOCK_SETS", 3)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 100])) for i in range(60)] + [(200 + i, " ".join(words[:90] + [f"x{i}"] * 14)) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (80, 94):
        assert sorted((tuple(r) for r in jj.components(df, 3, percent).collect()), key=str) == sorted(brute(rows, 3, percent), key=str)


def test_similarity_must_be_high(spark):
    with pytest.raises(ValueError):
        jj.components(spark.createDataFrame([(1, "a")], "doc_id long, text string"), 3, 71)


def test_representatives_of_null_ids_and_clashing_columns(spark):
    long = "x y z " * 20000
    rows = [(None, "a b c d e f", 1, "p"), (None, "a b c d e f", 2, "q"), (3, "a b c d e f", 3, "r"), (None, "g h i j k l", 4, "s"), (None, "g h i j k l", 5, "t"), (6, long, 6, "u"), (7, long, 7, "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __node int, component string")
    out = jj.representatives(df).collect()
    assert df.columns == jj.representatives(df).columns
    assert sorted((r.doc_id, r.text[:1]) for r in out if r.doc_id is not None) == [(3, "a"), (6, "x")]
    assert [r.text[:1] for r in out if r.doc_id is None] == ["g"] and {r["__node"] for r in out} <= set(range(1, 8))



def test_sketches_bound_differences():
    r = np.random.default_rng(5)
    for size in (1, 5, 60, 700, 3000):
        a = np.unique(r.integers(0, 2**63, size).astype(np.uint64))
        for drop in (0, 1, size // 20, size // 3, size):
            b = np.unique(np.concatenate([a[drop:], r.integers(0, 2**63, drop + 1).astype(np.uint64)]))
            x, y = jj.sketch(a, 90), jj.sketch(b, 90)
            n = min(len(x), len(y))
            p, q = jj.folded([x], n), jj.folded([y], n)
            assert np.bitwise_count(p ^ q).sum() <= len(np.setxor1d(a, b))
