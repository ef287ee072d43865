import math
import random
import re
import zlib

import numpy as np

from docloom.llm.toxicity import BINS, bins_of, toxicity


def corpus(n=900):
    r = random.Random(4)
    words = ["table", "river", "über", "morning", "green", "walks", "seven", "letter", "cloud", "señor"]
    rows, labels = [], []
    for i in range(n):
        w = [r.choice(words) + r.choice(["", "s", "ly"]) for _ in range(r.randint(3, 80))]
        toxic = r.random() < 0.3
        if toxic:
            w.insert(r.randint(0, len(w)), r.choice(["blockhead", "NUMSKULL"]))
        rows.append((i, " ".join(w), "x", 0.5))
        labels.append((i, int(toxic), "t"))
    return rows, labels


def test_held_out_accuracy_and_defined_results(spark):
    rows, labels = corpus()
    extra = [(2000, None, "x", 0.1), (2001, "", "x", 0.1), (2002, "blockhead " + "calm " * 20000, "x", 0.1), (None, "river", "x", 0.1), (7, rows[7][1], "x", 0.1)]
    docs = spark.createDataFrame([*rows, *extra], "doc_id long, text string, lang string, score double")
    marks = spark.createDataFrame([*labels, (5000, 1, "t"), (None, 1, "t"), (8, None, "t")], "doc_id long, toxic int, text string")
    got = toxicity(docs, marks).collect()
    assert len(got) == len(rows) + len(extra)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = {i: t for i, t, _ in labels}
    test = [r for r in got if r.doc_id in truth and r.held_out]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.predicted == truth[r.doc_id] for r in test]) >= 0.97
    assert next(r for r in got if r.doc_id == 2002).predicted == 1
    assert sorted(got, key=str) == sorted(toxicity(docs.repartition(3), marks).collect(), key=str)


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 0, 0)], "doc_id long, toxic int, quality int")
    assert {r.score for r in toxicity(docs, marks.limit(0)).collect()} == {0.5}
    assert toxicity(docs.limit(0), marks).count() == 0


def test_bins_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    text = " ".join(str(i * 7919) for i in range(3000))
    whole = bins_of(text)
    monkeypatch.setattr("docloom.llm.toxicity.PIECE", 997)
    assert np.array_equal(whole, bins_of(text)) and whole.max() < BINS


def test_against_a_plain_model(spark):
    """n-grams, ratios, features and the fit again, from the module's text, with dense matrices."""
    rows, labels = corpus(300)
    rows += [(1000, "", "x", 0.1), (1001, None, "x", 0.1), (1002, " \t A\n\x0bb ", "x", 0.1), (1003, "a", "x", 0.1)]
    toxic = {i: t for i, t, _ in labels}

    def grams(text):
        if not text:
            return set()
        t = " " + " ".join(x for x in re.split("[ \t-\r]+", text.lower()) if x) + " "
        out = set()
        for n in (2, 3, 4, 5):
            for k in range(len(t) - n + 1):
                h = 0
                for c in t[k : k + n]:
                    h = (h ^ ord(c)) * 0x01000193 % 2**32
                x = h * 0x9E3779B1 % 2**32
                out.add((x ^ (x >> 15)) % BINS)
        return out

    sets = {i: grams(t) for i, t, *_ in rows}
    train = [i for i in toxic if zlib.crc32(str(i).encode()) % 5]
    n1, n = sum(toxic[i] for i in train), len(train)
    n0, ratio = n - n1, {}
    for b in sorted(set().union(*(sets[i] for i in train))):
        p, q = (sum(b in sets[i] for i in train if toxic[i] == k) for k in (1, 0))
        chi = (p * (n0 - q) - q * (n1 - p)) ** 2 * n / max(1, (p + q) * (n - p - q) * n0 * n1)
        if p + q >= 2 and chi >= 10.83:
            ratio[b] = math.log((p + 1) / (n1 + 2)) - math.log((q + 1) / (n0 + 2))
    r = np.array(list(ratio.values()))
    x = np.array([[b in sets[i] for b in ratio] for i in train]) * r
    y = np.array([toxic[i] for i in train], float)
    share = np.where(y > 0, math.sqrt(n0 / n1), 1.0)
    share /= share.mean()
    w, b = np.zeros(len(r)), math.log((n1 + 1) / (n0 + 1))
    m, v, mb, vb = np.zeros(len(r)), np.zeros(len(r)), 0.0, 0.0
    for t in range(1, 121):
        e = share * (1 / (1 + np.exp(-(x @ w + b))) - y) / n
        g, gb = x.T @ e + 1e-3 * w, e.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        step = 0.05 * (1 - t / 121)
        w = w - step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        b -= step * (mb / (1 - 0.9**t)) / (math.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    marks = spark.createDataFrame([(i, t) for i, t in toxic.items()], "doc_id long, toxic int")
    got = {z.doc_id: z.score for z in toxicity(docs, marks).collect()}
    want = {i: 1 / (1 + math.exp(-(sum(c * ratio[g] for g, c in zip(ratio, w) if g in sets[i]) + b))) for i in sets}
    assert len(ratio) > 20 and max(abs(got[i] - want[i]) for i in want) < 1e-6
