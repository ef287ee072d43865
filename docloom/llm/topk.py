"""Exact top-k search by inner product: Fagin's threshold algorithm over sorted per-dimension lists.

The vectors are dealt into shards of bounded size, whatever their ids. Each shard sorts one list per dimension, once; shards
with their lists are stored as one row each. A query is answered by sorted access to a shard's lists, the best end of each
first (the high end where the query's component is positive, the low end where it is negative; dimensions in which the query
is zero are left out), and random access to the full vectors of ids not seen before. It stops when the threshold, the score
of a vector that would hold the last value seen in every list, cannot beat the kth result: it must be below it, since a tie
goes to the smaller id. The kth result is the better of the shard's own and a bound that comes with the query: the kth score
among a sample of at most ``SAMPLE_ROWS`` candidates, the same for all shards. A shard returns nothing below that bound.

Queries meet shards in blocks: a task's unit is a shard's row and a block of queries that stream past it, so neither side is
broadcast (but the bounded sample) and memory is that of one shard. Results are merged in two steps, a query's shards in
groups of their number's square root first.

How far the lists are read depends on the data: few dimensions or skewed scores stop early, many even ones late. ``scored``
says how many vectors were scored for a query.

Scores are integers, exact: components are floor(256 * x); products are taken in floating point only where their sums
stay below 2^24 (float32) or 2^53 (float64), else in Python integers.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part, as queries or
candidates; so do rows without id. Vectors of other lengths meet only those of their own length. Repeated rows are
candidates once each; a query's own id is no candidate. Of query rows with one id the smallest vector is the query. A query
with fewer than k candidates gets all. Ties go to the smaller id. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches, trimmed

#: Vectors in a shard, queries in a block, candidates in the sample of the first bound.
SHARD_ROWS, BLOCK_ROWS, SAMPLE_ROWS = 16_384, 16_384, 2048


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v array<long>) of the vectors that take part."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).select("vec_id", x.alias("x")).filter(~bad.isNotNull() | ~bad).select("vec_id", F.transform("x", lambda e: F.floor(e * scale).cast("long")).alias("v"))


class Lists:
    """A shard: its vectors and, per dimension, its rows in order of the component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, order: np.ndarray | None = None):
        if order is None:
            by_id = np.argsort(ids, kind="stable")
            ids, vectors = ids[by_id], vectors[by_id]
            order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32).T.copy()
        self.ids, self.exact, self.order = ids, vectors, order
        self.most = int(max(abs(int(self.exact.max())), abs(int(self.exact.min()))))
        self.sorted = np.take_along_axis(self.exact.T, self.order, axis=1)
        self.forms: dict = {}

    def blobs(self) -> list[bytes]:
        return [x.tobytes() for x in (self.ids, self.exact, self.order)]

    @classmethod
    def of(cls, dim: int, ids: bytes, vectors: bytes, order: bytes) -> Lists:
        return cls(np.frombuffer(ids, np.int64), np.frombuffer(vectors, np.int64).reshape(-1, dim), np.frombuffer(order, np.int32).reshape(dim, -1))

    def form(self, query_most: int):
        """The vectors in the narrowest type in which every score is exact."""
        bound = self.most * query_most * self.exact.shape[1]
        kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else object
        if kind not in self.forms:
            self.forms[kind] = self.exact.astype(kind)
        return kind, self.forms[kind]

    def search(self, query_id: int, query: np.ndarray, k: int, step: int = 32, bound: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """(rows, scores, rows scored) of the best k, ties to smaller ids; none below ``bound``, which the kth result of all shards reaches."""
        n = len(self.ids)
        kind, vectors = self.form(int(np.abs(query).max()))
        q = query.astype(kind)
        dims = np.flatnonzero(query)
        up = query[dims] > 0
        seen = np.zeros(n, bool)
        own = slice(np.searchsorted(self.ids, query_id, "left"), np.searchsorted(self.ids, query_id, "right"))
        seen[own] = True
        rows, scores = np.empty(0, np.int64), np.empty(0, kind)
        depth, scored = 0, 0
        while depth < n:
            if bound is not None and len(dims):  # what the lists' next ends could still reach
                best = np.where(up, self.sorted[dims, n - 1 - depth], self.sorted[dims, depth])
                if sum(int(a) * int(b) for a, b in zip(best, query[dims])) < bound:
                    break
            upto = min(n, depth + step) if len(dims) else n
            new = np.zeros(n, bool)
            if len(dims):
                new[self.order[dims[up], n - upto : n - depth]] = True
                new[self.order[dims[~up], depth:upto]] = True
            else:  # a zero query scores 0 everywhere
                new[:] = True
            new &= ~seen
            seen |= new
            found = np.flatnonzero(new)
            scored += len(found)
            rows, scores = np.concatenate([rows, found]), np.concatenate([scores, vectors[found] @ q])
            if len(rows) > k:  # the kth score and all that may tie with it
                kth = np.partition(scores, len(scores) - k)[len(scores) - k] if kind is not object else sorted(scores)[-k]
                keep = scores >= kth
                rows, scores = rows[keep], scores[keep]
            depth, step = upto, step * 2
            if len(rows) >= k and depth < n:
                last = np.where(up, self.sorted[dims, n - depth], self.sorted[dims, depth - 1])
                if sum(int(a) * int(b) for a, b in zip(last, query[dims])) < int(scores.min()):
                    break
        if bound is not None:
            good = scores >= bound
            rows, scores = rows[good], scores[good]
        best = np.lexsort((self.ids[rows], -scores))[:k] if kind is not object else np.array(sorted(range(len(rows)), key=lambda i: (-scores[i], self.ids[rows[i]]))[:k], int)
        return rows[best], scores[best], scored


def bounds(queries: DataFrame, sample: dict[int, Lists], k: int) -> DataFrame:
    """``queries`` (vec_id, v, dim) with ``bound``: the kth score among the sample's other ids, null where it has fewer."""
    held = queries.sparkSession.sparkContext.broadcast(sample)  # SAMPLE_ROWS vectors at most

    def run(batches):
        for batch in batches:
            found = []
            for query_id, v, dim in zip(*(c.to_pylist() for c in batch.columns)):
                lists = held.value.get(dim)
                scores = lists.search(query_id, np.array(v, np.int64), k)[1] if lists else []
                found.append(int(scores[k - 1]) if len(scores) >= k else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], ["vec_id", "v", "dim", "bound"])

    return queries.select("vec_id", "v", "dim").mapInArrow(run, "vec_id long, v array<long>, dim int, bound long")


def stored_shards(rows: DataFrame, shard_rows: int) -> DataFrame:
    """(dim, shard, ids, vectors, lists): a row for each shard of ``rows`` (vec_id, v, dim, at), which are dealt by ``at``."""
    sizes = rows.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    dealt = rows.join(F.broadcast(sizes), "dim").withColumn("shard", F.pmod(F.xxhash64("at"), F.col("shards")).cast("int"))  # a row for each length of vectors

    def build(batches):
        key, ids, vectors = None, [], []

        def out():
            blobs = Lists(np.concatenate(ids), np.concatenate(vectors)).blobs()
            yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), *(pa.array([x], pa.binary()) for x in blobs)], ["dim", "shard", "ids", "vectors", "lists"])

        for batch in batches:
            dims, shards = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            starts = [0, *(np.flatnonzero((np.diff(dims) != 0) | (np.diff(shards) != 0)) + 1).tolist(), len(dims)]
            for a, b in zip(starts, starts[1:]):
                if key != (dims[a], shards[a]):
                    if key is not None:
                        yield from out()
                    key, ids, vectors = (dims[a], shards[a]), [], []
                ids.append(batch.column(2).slice(a, b - a).to_numpy())
                vectors.append(batch.column(3).slice(a, b - a).flatten().to_numpy().reshape(b - a, int(dims[a])))
        if key is not None:
            yield from out()

    ordered = dealt.select("dim", "shard", "vec_id", "v").repartition("dim", "shard").sortWithinPartitions("dim", "shard")
    return cut(ordered.mapInArrow(trimmed(build), "dim int, shard int, ids binary, vectors binary, lists binary"), "shards")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score, scored) of each row of ``vectors`` (vec_id, embedding) that ``is_query`` holds for; see the module's text.

    ``scored`` is how many vectors were scored for the query in all shards, without those of the sample.
    """
    small_batches(vectors.sparkSession)
    rows = cut(quantised(vectors).select("vec_id", "v", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("at")), "vectors")
    queries = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    chosen = rows.orderBy(F.xxhash64("at"), "at").limit(SAMPLE_ROWS).select("dim", "vec_id", "v").collect()
    sample = {dim: Lists(np.array([r["vec_id"] for r in chosen if r["dim"] == dim]), np.array([r["v"] for r in chosen if r["dim"] == dim], np.int64)) for dim in {r["dim"] for r in chosen}}
    queries = cut(bounds(queries, sample, k), "queries")
    blocks = max(1, -(-queries.count() // block_rows))
    shards = stored_shards(rows, shard_rows)
    held = shards.select("dim", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(0).alias("kind"), "ids", "vectors", "lists", *(F.lit(None).cast(t).alias(n) for n, t in (("vec_id", "long"), ("v", "array<long>"), ("bound", "long"))))
    number = shards.groupBy("dim").agg(F.max("shard").alias("last"))
    asked = queries.join(F.broadcast(number), "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("last"))))
    asked = asked.select("dim", "shard", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(1).alias("kind"), *(F.lit(None).cast("binary").alias(n) for n in ("ids", "vectors", "lists")), "vec_id", "v", "bound")
    met = held.unionByName(asked).repartition("dim", "shard", "block").sortWithinPartitions("dim", "shard", "block", "kind")

    def search(batches):
        lists = None
        for batch in batches:
            out = []
            for i, kind in enumerate(batch.column(3).to_pylist()):
                if kind == 0:
                    dim, shard = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                    lists = Lists.of(dim, *(batch.column(c)[i].as_py() for c in (4, 5, 6)))
                else:
                    query_id = batch.column(7)[i].as_py()
                    found, scores, scored = lists.search(query_id, batch.column(8)[i].values.to_numpy(), k, bound=batch.column(9)[i].as_py())
                    out += [(query_id, shard, int(lists.ids[r]), int(s), 0) for r, s in zip(found, scores)] + [(query_id, shard, None, None, scored)]
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()])], ["query_id", "shard", "vec_id", "score", "scored"])

    best = met.mapInArrow(trimmed(search), "query_id long, shard int, vec_id long, score long, scored long")
    last = number.agg(F.coalesce(F.max("last"), F.lit(0))).first()[0]
    part = F.pmod(F.col("shard"), F.lit(max(1, round((last + 1) ** 0.5))))
    struct = F.when(F.col("vec_id").isNotNull(), F.struct((-F.col("score")).alias("less"), "vec_id"))  # lists leave nulls out
    some = best.groupBy("query_id", part.alias("part")).agg(F.slice(F.sort_array(F.collect_list(struct)), 1, k).alias("best"), F.sum("scored").alias("scored"))
    merged = some.groupBy("query_id").agg(F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best"), F.sum("scored").alias("scored"))
    merged = merged.select("query_id", "scored", F.posexplode("best").alias("pos", "b"))
    return merged.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.less")).alias("score"), "scored")
