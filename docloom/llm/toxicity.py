"""Toxicity: a character n-gram linear classifier over features scaled by naive Bayes log-count ratios.

Texts are lower-cased, blanks collapsed; their distinct character n-grams are hashed into ``BINS`` bins. From the training
rows come, per bin, the log ratio r of its smoothed frequencies in toxic and other texts. The bins that set the classes
apart significantly (a chi-square of ``LEAST_CHI`` or more, that of one in a thousand by chance) are the features, all of
them; each is present (r) or absent (0), and a logistic regression with an L2 penalty is fitted on them. A score is the
regression's probability for the whole text.

Training takes the ``MAX_TRAIN`` labelled rows with the smallest hash of doc_id, a documented bound: what the driver gathers
is the features of that many texts at most and a row per bin. Every text is scored with one array of BINS weights.

Defined results: a null or empty text has no features and gets the score of the intercept; without training rows of both
classes every score is the smoothed share of toxic rows; null labels and labels of unknown documents are left out; of
several labels for a doc_id the largest counts; of several texts for one, each is a training row; null doc_ids are never
training rows and not held out; ties in the hash are broken by doc_id; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, shielded, small_batches, trimmed

BINS, SIZES, MAX_TRAIN = 1 << 18, (2, 3, 4, 5), 20_000
#: L2 penalty and steps of the regression; bins in fewer training texts, or with a smaller chi-square, are no features.
PENALTY, STEPS, LEAST_TEXTS, LEAST_CHI = 1e-3, 120, 2, 10.83
#: Training rows that a step of the regression takes at a time.
FIT_ROWS = 1000
_BLANKS = re.compile(r"[\x20\x09-\x0D]+")
#: Characters hashed at a time.
PIECE = 1 << 20


def bins_of(text: str | None) -> np.ndarray:
    """Sorted distinct bins of a text's character n-grams; one blank stands before and after the text."""
    if not text:
        return np.empty(0, np.int64)
    codes = np.frombuffer(f" {_BLANKS.sub(' ', text.lower()).strip(' ')} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(BINS, bool)
    most = max(SIZES)
    for start in range(0, max(1, len(codes) - 1), PIECE):
        part = codes[start : start + PIECE + most - 1].astype(np.uint32)
        h = np.zeros(len(part), np.uint32)
        for n in range(1, most + 1):
            if len(part) < n:
                break
            h = (h[: len(part) - n + 1] ^ part[n - 1 :]) * np.uint32(0x01000193)
            if n in SIZES:
                x = h * np.uint32(0x9E3779B1)
                seen[(x ^ (x >> np.uint32(15))) & np.uint32(BINS - 1)] = True
    return np.flatnonzero(seen)


def held_out(doc_id: Column | str) -> Column:
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, toxic, text) of at most ``most`` labelled rows that are not held out."""
    chosen = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = chosen.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(most).drop("h")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``most`` rows of two numbers


def train(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> tuple[np.ndarray, float]:
    """(weights by bin, intercept)."""
    small_batches(docs.sparkSession)
    rows = training_rows(docs, labels, most)

    def count(batches):
        found = np.zeros((2, BINS), np.int64)
        rows = np.zeros(2, np.int64)
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found[int(toxic > 0), bins_of(text)] += 1
                rows[int(toxic > 0)] += 1
        at = np.flatnonzero(found.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-1], at])), pa.array(np.concatenate([rows[:1], found[0, at]])), pa.array(np.concatenate([rows[1:], found[1, at]]))], ["bin", "other", "toxic"])

    totals = rows.select("toxic", "text").mapInArrow(trimmed(count), "bin long, other long, toxic long").groupBy("bin").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")).toArrow()
    other, toxic = np.zeros(BINS + 1, np.int64), np.zeros(BINS + 1, np.int64)
    other[totals["bin"].to_numpy()], toxic[totals["bin"].to_numpy()] = totals["other"].to_numpy(), totals["toxic"].to_numpy()
    n0, n1, p, q = int(other[-1]), int(toxic[-1]), toxic[:BINS].astype(float), other[:BINS].astype(float)
    weights = np.zeros(BINS)
    if not n0 or not n1:
        return weights, float(np.log((n1 + 1) / (n0 + 1)))
    ratio = np.log((p + 1) / (n1 + 2)) - np.log((q + 1) / (n0 + 2))
    seen = p + q
    chi = (p * (n0 - q) - q * (n1 - p)) ** 2 * (n0 + n1) / np.maximum(seen * (n0 + n1 - seen) * n0 * n1, 1)
    chosen = np.flatnonzero((seen >= LEAST_TEXTS) & (chi >= LEAST_CHI))
    place = np.full(BINS, -1, np.int32)
    place[chosen] = np.arange(len(chosen), dtype=np.int32)

    def features(batches):
        for batch in batches:
            found = [(x := place[bins_of(text)])[x >= 0] for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(pa.int32()))], ["doc_id", "toxic", "at"])

    kind = dict(rows.dtypes)["doc_id"]
    matrix = rows.select("doc_id", "toxic", "text").mapInArrow(trimmed(features), f"doc_id {kind}, toxic int, at array<int>").toArrow().sort_by("doc_id").combine_chunks()
    y = (matrix["toxic"].to_numpy() > 0).astype(float)
    lists = matrix["at"].combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    fitted, bias = fit(lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy()), y, ratio[chosen])
    weights[chosen] = fitted
    del matrix, lists
    give_back()
    return weights, bias


def fit(at: np.ndarray, lengths: np.ndarray, y: np.ndarray, ratio: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights (log-count ratio times coefficient) and intercept of an L2-penalised logistic regression, by Adam on all rows."""
    ends = np.cumsum(lengths)
    parts = []  # a few rows at a time, for small intermediates
    for first in range(0, len(y), FIT_ROWS):
        last = min(len(y), first + FIT_ROWS)
        parts.append((slice(first, last), at[(ends[first - 1] if first else 0) : ends[last - 1]], np.repeat(np.arange(last - first, dtype=np.int32), lengths[first:last])))
    balance = np.where(y > 0, np.sqrt((len(y) - y.sum()) / max(1, y.sum())), 1.0)
    balance /= balance.mean()
    w, b = np.zeros(len(ratio)), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    m, v, mb, vb = np.zeros(len(w)), np.zeros(len(w)), 0.0, 0.0
    for t in range(1, steps + 1):
        scaled, g, gb = ratio * w, np.zeros(len(w)), 0.0
        for rows, some, row in parts:
            score = np.bincount(row, weights=scaled[some], minlength=rows.stop - rows.start) + b
            error = balance[rows] * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - y[rows]) / len(y)
            g += np.bincount(some, weights=error[row], minlength=len(w))
            gb += error.sum()
        g = g * ratio + penalty * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.05 * (1 - t / (steps + 1))
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        b -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    return ratio * w, b


def score_column(docs: DataFrame, model: tuple[np.ndarray, float], keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with __score."""
    weights, bias = model
    held = docs.sparkSession.sparkContext.broadcast(weights)  # BINS numbers, whatever the corpus

    def run(batches):
        for batch in batches:
            raw = np.array([held.value[bins_of(t)].sum() for t in batch.column(batch.num_columns - 1).to_pylist()], float) + bias
            score = pa.array(1 / (1 + np.exp(-np.clip(raw, -30, 30))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], score], names)

    names = [*keep, "__score"]
    rows = docs.select(*keep, F.col("text").alias("__text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("__score", T.DoubleType())])
    return rows.mapInArrow(trimmed(run), schema)


def toxicity(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs`` (doc_id, text); see the module's text."""
    docs = docs.select("doc_id", "text")
    rows = score_column(docs, train(docs, labels, most), ["doc_id"])
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= 0.5).cast("int").alias("predicted"))


@shielded("doc_id", "text")
def clean_documents(docs: DataFrame, labels: DataFrame, below: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score less than ``below``, by a classifier trained on the labelled ones among them."""
    return score_column(docs, train(docs, labels), docs.columns).filter(F.col("__score") < below).select(*docs.columns)
