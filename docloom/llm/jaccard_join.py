"""N-gram Jaccard self-join of documents with PartEnum signatures, and its connected components.

A document's set is that of its distinct n-word shingles, as 64-bit hashes. Equal sets are one node, so copies of a text never
meet as pairs. A node's number has 64 bits; a second hash of 64 bits finds the numbers that unequal sets share, which are then
numbered anew from both, so sets are told apart by 128 bits.

Signatures (PartEnum): sizes fall into bands. For two sets of a band, a Jaccard similarity of at least t % bounds their
symmetric difference by k, the same for the band. The domain of shingles is cut into parts by hash and every set's
projections to certain unions of parts are hashed with the band's number.
 * k of at most 3: 8 parts, all unions of 8 - k of them. k differences miss 8 - k parts at least, so that projection is shared.
 * larger k: k + 1 + s parts. At least s + 1 of them are free of differences, so each set may leave out its s weakest
   parts: of the shared parts, one at least is then kept by both sets, whatever fixed order of contents is used. Weak are
   parts with few rare shingles, then with few shingles. Rare is what is not in ``frequent``, a table of bounded size from a
   bounded sample of texts: it decides how few unlike sets share a signature, never which links are found.
A set whose partner may lie in the next band also signs for that band. Sets that are similar enough thus share a signature.

Links, in three steps, none of which emits the pairs within a group:
 1. The sets of a signature's group are compared with the group's first set, by their texts. Tasks that sign link their own
    repeats of a signature, so a signature comes to the shuffle as one row per task's flush, however many sets share it.
 2. Groups whose sets then lie in several linked components are open. Open groups that hang together are one group as long as
    all their sets fit in one block, else each stays its own, and of those with the same sets one is kept. Sets are dealt into
    blocks of bounded size: a component that fills more than a block has blocks of its own, small ones share.
 3. Blocks of one group are compared with each other within a task, but for two blocks of one component, first by sketches: a
    set's shingles are hashed to bits, a bit tells whether an odd number of shingles fell on it. Two sets differ in at least as
    many shingles as their sketches in bits, so what is too far apart by the sketches cannot be linked. The sets that have a
    partner left are compared again by their texts; a task gives only links that join two components. Only sets that share a
    signature, or a block, are compared, and few texts are moved.
Components are found by large-star and small-star steps over tables in the shared folder.

Hot keys: hashes, counts and minima are aggregated in the map tasks first; joins on a node or signature that many rows share
are left to the adaptive skew join, or broadcast where the other side is small by count.

Defined results: texts that are null or without words have an empty set and no links; texts of fewer than n words are one
shingle; words are case-folded for A-Z only; repeated rows are copies; a null doc_id takes part but is never a smallest id
(a component of null ids alone has a null id); other columns are ignored by ``components`` and pass through
``representatives``; ties between equal doc_ids in ``representatives`` go to one row. A similarity below 72 % is an error.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, give_back, shielded, small, small_batches, trimmed

#: Rows of two numbers that are broadcast at most.
BROADCAST_ROWS = 1_000_000
#: Words whose hash a worker remembers; the growth of bands; further parts as a share of k.
MEMO_WORDS, BAND, SPARE = 300_000, 1.4, 0.4
#: Texts of the sample of frequent shingles, sample texts that hold one at least, and how many are kept; the similarity below which it is made.
SAMPLE_TEXTS, FREQUENT_IN, FREQUENT_MOST, FREQUENT_BELOW = 4000, 3, 1 << 18, 85
#: Bits of a sketch for each shingle that similar sets may differ in, and at least.
SKETCH, SKETCH_LEAST = 16, 64
#: Parts of the domain for small k; sets and bytes of text in a block, shingles in a slice of a comparison; signatures that a task holds.
PARTS, BLOCK_SETS, BLOCK_BYTES, SLICE, HELD_SIGNATURES = 8, 512, 4_000_000, 8192, 1 << 20
_LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = h
        return h


def shingles(text: str | None, n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of a text's n-word shingles."""
    words = (text or "").encode().translate(_LOWER).split()  # splits at space and tab to carriage return
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(n, len(h))
    x = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        x = mixed(x ^ h[k : len(h) - width + 1 + k])
    return np.unique(x)


@dataclass(frozen=True)
class Sets:
    """How texts become sets and nodes: words in a shingle, bits of a node's first number, numbers that unequal sets share."""

    n: int
    bits: int = 64
    shared: frozenset = frozenset()

    def numbers(self, sets: np.ndarray) -> tuple[int, int]:
        digest = hashlib.blake2b(sets.tobytes(), digest_size=16).digest()
        return int.from_bytes(digest[:8], "little", signed=True) >> (64 - self.bits), int.from_bytes(digest[8:], "little", signed=True)

    def node(self, sets: np.ndarray) -> int | None:
        """The node's number, None of an empty set."""
        if not len(sets):
            return None
        first, second = self.numbers(sets)
        return int(mixed(np.uint64([first % 2**64]) ^ mixed(np.uint64([second % 2**64])))[0].view(np.int64)) if first in self.shared else first

    def __call__(self, text: str | None, hashes: WordHashes) -> np.ndarray:
        return shingles(text, self.n, hashes)


def bands(upto: int) -> list[int]:
    """The largest size of each band, up to the band that holds ``upto``."""
    out, x = [1], 1.0
    while out[-1] < upto:
        x *= BAND
        out.append(max(out[-1] + 1, int(x)))
    return out


def signatures(sets: np.ndarray, percent: int, frequent: np.ndarray | None = None) -> np.ndarray:
    """The set's signatures for its band and, where a partner may be there, for the next."""
    size = len(sets)
    if not size:
        return np.empty(0, np.uint64)
    limits = bands(size)
    tags = [(len(limits) - 1, limits[-1])]
    if size * 100 // percent > limits[-1]:
        tags.append((len(limits), bands(limits[-1] + 1)[-1]))
    weight = mixed(sets)
    rare = np.ones(size, np.int64)
    if frequent is not None and len(frequent):
        rare = (frequent[np.minimum(np.searchsorted(frequent, sets), len(frequent) - 1)] != sets).astype(np.int64)
    out = []
    for band, limit in tags:
        k = 2 * limit * (100 - percent) // (100 + percent)
        if k:  # else only equal sets are similar
            out.append(mixed(projections(sets, weight, rare, k) ^ mixed(np.uint64([band]))))
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.uint64)


def projections(sets: np.ndarray, weight: np.ndarray, rare: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the projections that two sets with at most k differences share at least one of."""
    if k <= 3:
        part = (sets >> np.uint64(61)).astype(np.int64)
        sums = np.zeros(PARTS, np.uint64)
        np.add.at(sums, part, weight)
        out = np.array(list(combinations(range(PARTS), k)))
        return mixed(sums.sum() - sums[out].sum(axis=1)) ^ mixed((1 << out).sum(axis=1).astype(np.uint64))
    spare = max(1, int(SPARE * k))
    parts = k + 1 + spare
    part = ((sets >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)  # rises with the sorted set
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    sums, count, some = np.zeros(parts, np.uint64), np.zeros(parts, np.int64), np.zeros(parts, np.int64)
    sums[part[starts]] = np.add.reduceat(weight, starts)
    count[part[starts]] = np.diff(np.concatenate([starts, [len(part)]]))
    some[part[starts]] = np.add.reduceat(rare, starts)
    hashed = mixed(sums ^ mixed(np.arange(parts, dtype=np.uint64)))
    return hashed[np.lexsort((hashed, count, some))[spare:]]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both) and both > 0


def nodes(docs: DataFrame, of: Sets) -> DataFrame:
    """(doc_id, n_shingles, node, other) of each row; an empty set has no node. ``other`` is a second hash of the set."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sets = [of(t.as_py(), hashes) for t in batch.column(1)]
            other = [of.numbers(x)[1] if len(x) else None for x in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array(list(map(of.node, sets)), pa.int64()), pa.array(other, pa.int64())], ["doc_id", "n_shingles", "node", "other"])

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), f"doc_id {kind}, n_shingles long, node long, other long")


def known_nodes(docs: DataFrame, n: int, percent: int, bits: int = 64) -> tuple[DataFrame, Sets]:
    """The stored ``nodes`` of ``docs``, unequal sets with unequal nodes, and how texts become them."""
    if not 72 <= percent <= 100:
        raise ValueError("a similarity of 72 to 100 % is asked for: below, a partner may lie beyond the next band")
    small_batches(docs.sparkSession)
    of = Sets(n, bits)
    known = cut(nodes(docs, of), "nodes")
    clashes = known.filter("node is not null").groupBy("node").agg(F.min("other").alias("low"), F.max("other").alias("high")).filter("low <> high")
    shared = frozenset(r["node"] for r in clashes.select("node").collect())  # of N sets N^2 / 2^65 are expected: some three of 10^10
    if shared:
        of = Sets(n, bits, shared)
        known = cut(nodes(docs, of), "nodes")
    return known.drop("other"), of


def frequent_shingles(docs: DataFrame, of: Sets, texts: int) -> np.ndarray:
    """Sorted hashes of the shingles that most of a sample's texts share; ``texts`` is how many ``docs`` has."""

    def run(batches):
        hashes, held = WordHashes(), []
        for batch in batches:
            held += [of(t.as_py(), hashes) for t in batch.column(0)]
        found, times = np.unique(np.concatenate(held) if held else np.empty(0, np.uint64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times)], ["s", "n"])

    share = min(1.0, SAMPLE_TEXTS / max(1, texts))
    sample = docs.select("text").filter(F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    rows = sample.mapInArrow(trimmed(run), "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).filter(F.col("n") >= FREQUENT_IN)
    return np.sort(rows.orderBy(F.desc("n"), "s").limit(FREQUENT_MOST).select("s").toArrow()["s"].to_numpy().view(np.uint64))


def signed(docs: DataFrame, of: Sets, percent: int, texts: int) -> DataFrame:
    """(sig, node, rest): the signatures of each row's set. The sets of a task's flush that share a signature are one row, the first and the ``rest`` (null if none)."""
    held = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, of, texts)) if percent < FREQUENT_BELOW else None  # FREQUENT_MOST numbers at most

    def run(batches):
        frequent = held.value if held else None
        hashes = WordHashes()
        sigs, owners, lengths, done, total = [], [], [], set(), 0

        def out():
            sig, node = np.concatenate(sigs).view(np.int64), np.repeat(np.array(owners, np.int64), lengths)
            order = np.argsort(sig, kind="stable")
            sig, node = sig[order], node[order]
            starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            others = np.diff(np.concatenate([starts, [len(sig)]])) - 1
            rest = np.ones(len(sig), bool)
            rest[starts] = False
            rest = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(others)]), pa.int32()), pa.array(node[rest]), mask=pa.array(others == 0))
            whole = pa.RecordBatch.from_arrays([pa.array(sig[starts]), pa.array(node[starts]), rest], ["sig", "node", "rest"])
            for k in range(0, len(starts), 1 << 16):
                yield whole.slice(k, 1 << 16)

        for batch in batches:
            for text in batch.column(0):
                sets = of(text.as_py(), hashes)
                node = of.node(sets)
                if node is None or node in done:
                    continue
                done.add(node)
                found = signatures(sets, percent, frequent)
                sigs.append(found)
                owners.append(node)
                lengths.append(len(found))
                total += len(found)
                if total > HELD_SIGNATURES:
                    yield from out()
                    sigs, owners, lengths, done, total = [], [], [], set(), 0
        if total:
            yield from out()

    return docs.select("text").mapInArrow(trimmed(run), "sig long, node long, rest array<long>")


def groups(docs: DataFrame, of: Sets, percent: int, texts: int) -> DataFrame:
    """(sig, first, node): sets that share a signature, as trees of depth two. One shuffle; running windows over a row per flush and signature."""
    by = Window.partitionBy("sig").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    rows = signed(docs, of, percent, texts).withColumn("first", F.first("node").over(by)).filter(F.col("rest").isNotNull() | (F.col("node") != F.col("first")))
    own = F.array(F.struct("first", "node"))
    rest = F.transform(F.coalesce("rest", F.array().cast("array<bigint>")), lambda x: F.struct(F.col("node").alias("first"), x.alias("node")))
    rows = rows.select("sig", F.inline(F.concat(own, rest)))
    return rows.filter(F.col("node") != F.col("first")).distinct()


def verified(pairs: DataFrame, texts: DataFrame, of: Sets, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that are similar; ``texts`` is (node, text)."""

    def run(batches):
        hashes, last = WordHashes(), (None, None)
        for batch in batches:
            good = []
            for node, a, b in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if node != last[0]:
                    last = (node, of(a.as_py(), hashes))
                good.append(similar(last[1], of(b.as_py(), hashes), percent))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    of_a, of_b = (texts.select(F.col("node").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    joined = pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(trimmed(run), "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b), by alternating large-star and small-star steps."""
    edges = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        step = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = cut(step, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    out = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return out.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def linked(docs: DataFrame, known: DataFrame, of: Sets, percent: int) -> DataFrame:
    """(node, component) of the nodes that have links. ``known`` is ``nodes`` of ``docs``."""
    give_back()
    found = cut(groups(docs, of, percent, known.count()), "groups")
    pairs = cut(found.select(F.col("first").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    involved = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    first = known.filter("node is not null").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc"))).alias("x"))  # copies meet in the map tasks
    owners = cut(first.join(involved, "node", "left_semi").select("node", F.col("x.doc").alias("doc_id")), "owners")
    texts = cut(texts_of(docs, owners, of), "texts")
    links = cut(verified(pairs, texts, of, percent), "links")
    members = cut(open_groups(found, connected(links), cut(sketches(texts, of, percent), "sketches")), "members")
    more = cut(settled(near(members, percent), texts, of, percent), "links")
    return connected(links.unionByName(more))


def sketch(sets: np.ndarray, percent: int) -> bytes:
    """The parities of how many shingles fall on each bit; a power of two of bits."""
    apart = 2 * len(sets) * (100 - percent) // (100 + percent)
    bits = max(SKETCH_LEAST, 1 << (SKETCH * apart).bit_length())
    at = (mixed(sets ^ _M1) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches as rows of words, the longer ones folded to ``size`` bytes: the parity of a sum is that of its parts."""
    out = np.zeros((len(sketches), size), np.uint8)
    for row, x in zip(out, sketches):
        row[:] = np.bitwise_xor.reduce(np.frombuffer(x, np.uint8).reshape(-1, size), axis=0)
    return out.view(np.uint64)


def sketches(texts: DataFrame, of: Sets, percent: int) -> DataFrame:
    """(node, bytes, size, sketch) of each row of ``texts``."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sets = [of(t.as_py(), hashes) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([len(x) for x in sets], pa.int64()), pa.array([sketch(x, percent) for x in sets], pa.binary())], ["node", "bytes", "size", "sketch"])

    return texts.select("node", F.octet_length("text").cast("long").alias("bytes"), "text").mapInArrow(trimmed(run), "node long, bytes long, size long, sketch binary")


def open_groups(found: DataFrame, parts: DataFrame, about: DataFrame) -> DataFrame:
    """(sig, node, component, size, sketch, owner, part): the sets of groups of more than two sets and several linked components, dealt into blocks.

    ``owner`` is the component of a block that holds one alone, else null; ``part`` numbers the blocks of an owner, or those without.
    ``about`` is ``sketches``.
    """
    members = found.select("sig", "node").unionByName(found.select("sig", F.col("first").alias("node"))).distinct()
    placed = about.select("node", "bytes").join(parts, "node", "left").select("node", "bytes", F.coalesce("component", "node").alias("component"))
    members = cut(members.join(placed, "node"), "placed")
    open_sigs = members.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("total")).filter("low <> high and total > 2").select("sig")
    open_sigs = cut(open_sigs, "open")
    # Open groups that hang together share most of their sets: where all these fill one block at most, they are one group.
    closure = connected(found.join(open_sigs, "sig", "left_semi").select(F.col("first").alias("a"), F.col("node").alias("b"))).withColumnRenamed("component", "closure")
    closure = cut(closure, "closure")
    little = closure.join(about.select("node", "bytes"), "node").groupBy("closure").agg(F.count("*").alias("sets"), F.sum("bytes").alias("size")).filter((F.col("sets") <= BLOCK_SETS) & (F.col("size") <= BLOCK_BYTES)).select("closure", F.lit(True).alias("little"))
    group = F.when(F.col("little"), F.xxhash64("closure")).otherwise(F.xxhash64("sig", F.lit(1)))
    members = members.join(open_sigs, "sig", "left_semi").join(closure.join(little, "closure", "left"), "node")
    members = cut(members.select(group.alias("sig"), "node", "bytes", "component").distinct(), "placed")
    each = members.groupBy("sig", "component").agg(F.count("*").alias("sets"), F.sum("bytes").alias("bytes"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(7))).alias("y"))
    blocks = lambda sets, size: F.ceil(F.greatest(sets / BLOCK_SETS, size / BLOCK_BYTES)).cast("long")
    each = each.withColumn("blocks", blocks(F.col("sets"), F.col("bytes")))
    of_small = F.when(F.col("blocks") <= 1, F.lit(1)).otherwise(0)
    several = each.groupBy("sig").agg(F.sum("sets").alias("total"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum(of_small * F.col("sets")).alias("small_sets"), F.sum(of_small * F.col("bytes")).alias("small_bytes"))
    several = several.dropDuplicates(["x", "y", "total"]).select("sig", F.greatest(F.lit(1), blocks(F.col("small_sets"), F.col("small_bytes"))).alias("shared_blocks"))
    asked = each.select("sig", "component", "blocks").join(several, "sig")
    rows = members.join(asked, ["sig", "component"]).join(about.select("node", "size", "sketch"), "node")
    alone = F.col("blocks") > 1
    part = F.when(alone, F.pmod(F.xxhash64("node"), F.col("blocks"))).otherwise(F.pmod(F.xxhash64("component"), F.col("shared_blocks")))
    return rows.select("sig", "node", "component", "size", "sketch", F.when(alone, F.col("component")).alias("owner"), part.alias("part"))


def near(members: DataFrame, percent: int) -> DataFrame:
    """(work, node, component): the sets that have, in two blocks of a group, a partner of another component that their sketches do not rule out."""
    blocks = members.groupBy("sig", "owner", "part").agg(F.collect_list(F.struct("node", "component", "size", "sketch")).alias("m"), F.min("component").alias("low"), F.max("component").alias("high"))
    name = F.concat_ws("/", F.col("sig").cast("string"), F.coalesce(F.col("owner").cast("string"), F.lit("")), F.col("part").cast("string"))
    blocks = cut(blocks.withColumn("block", name), "blocks")
    names = blocks.select("sig", "block", "low", "high")
    other = names.select("sig", *(F.col(x).alias(f"{x}_b") for x in ("block", "low", "high")))
    work = names.join(other, "sig").filter("block <= block_b and (low <> high or low_b <> high_b or low <> low_b)")
    work = work.select("block", F.when(F.col("block") != F.col("block_b"), F.col("block_b")).alias("block_b"))
    work = work.join(blocks.select("block", "m"), "block").join(blocks.select(F.col("block").alias("block_b"), F.col("m").alias("m_b")), "block_b", "left").select(F.concat_ws(" ", "block", "block_b").alias("work"), "m", "m_b")

    def run(batches):
        for batch in batches:
            for name, left, right in zip(*(batch.column(k) for k in range(3))):
                sides = [side.as_py() for side in (left, right) if side.is_valid]
                of_size = [{n: [i for i, x in enumerate(side) if len(x["sketch"]) == n] for n in {len(x["sketch"]) for x in side}} for side in sides]
                counts = [np.array([x["size"] for x in side], np.int64) for side in sides]
                parts = [np.array([x["component"] for x in side], np.int64) for side in sides]
                some = [np.zeros(len(side), bool) for side in sides]
                for n, rows in of_size[0].items():
                    for m, others in of_size[-1].items():
                        if max(n, m) > 2 * min(n, m):  # similar sets are of like size, so their sketches are too
                            continue
                        words = [folded([side[i]["sketch"] for i in at], min(n, m)) for side, at in ((sides[0], rows), (sides[-1], others))]
                        size, part = counts[-1][others], parts[-1][others]
                        for i, word in zip(rows, words[0]):
                            apart = np.bitwise_count(word ^ words[1]).sum(axis=1, dtype=np.int64)
                            apart = np.maximum(apart, np.abs(counts[0][i] - size))
                            good = (apart * (100 + percent) <= (counts[0][i] + size) * (100 - percent)) & (parts[0][i] != part)
                            some[0][i] |= good.any()
                            some[-1][np.array(others)[good]] = True
                found = [(x["node"], x["component"]) for side, kept in zip(sides, some) for x, k in zip(side, kept.tolist()) if k]
                yield pa.RecordBatch.from_arrays([pa.array([name.as_py()] * len(found), pa.string()), pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], ["work", "node", "component"])

    rows = work.repartition(max(1, work.sparkSession.sparkContext.defaultParallelism * 4)).mapInArrow(trimmed(run), "work string, node long, component long")
    rows = cut(rows, "near")
    alike = rows.groupBy("work").agg(F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(7))).alias("y"), F.count("*").alias("n"))
    return rows.join(alike.dropDuplicates(["x", "y", "n"]).select("work"), "work")


def settled(members: DataFrame, texts: DataFrame, of: Sets, percent: int) -> DataFrame:
    """(a, b): links that join components, from comparing all sets of each ``work`` of ``members`` (work, node, component), those of two blocks at most."""
    work = members.join(texts, "node").groupBy("work").agg(F.collect_list(F.struct("node", "component", "text")).alias("m")).select("m")

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for m in batch.column(0):
                rows = m.as_py()
                sets = [of(x["text"], hashes) for x in rows]
                parent: dict[int, int] = {}
                out = []
                for i, j in np.argwhere(np.triu(overlaps(sets, sets, percent), 1)).tolist():
                    a, b = root(parent, rows[i]["component"]), root(parent, rows[j]["component"])
                    if a != b:
                        parent[a] = b
                        out.append((rows[i]["node"], rows[j]["node"]))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])

    return work.mapInArrow(trimmed(run), "a long, b long")


def root(parent: dict[int, int], x: int) -> int:
    while x in parent:
        x = parent[x]
    return x


def overlaps(left: list[np.ndarray], right: list[np.ndarray], percent: int) -> np.ndarray:
    """Whether each set of ``left`` is similar to each of ``right``: counts of common shingles as products of 0/1 matrices, a slice of shingles at a time."""
    values = np.concatenate([*left, *right])
    known, seen = np.unique(values, return_counts=True)
    known = known[seen > 1]  # others are in one set alone
    rows = [np.repeat(np.arange(len(side)), [len(x) for x in side]) for side in (left, right)]
    places = []
    for side, row in zip((left, right), rows):
        flat = np.concatenate(side)
        at = np.minimum(np.searchsorted(known, flat), max(0, len(known) - 1))
        good = known[at] == flat if len(known) else np.zeros(len(flat), bool)
        order = np.argsort(at[good], kind="stable")
        places.append((row[good][order], at[good][order]))
    common = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(known), SLICE):
        matrices = []
        for side, (row, at) in zip((left, right), places):
            lo, hi = np.searchsorted(at, [start, start + SLICE])
            x = np.zeros((len(side), min(SLICE, len(known) - start)), np.float32)
            x[row[lo:hi], at[lo:hi] - start] = 1
            matrices.append(x)
        common += matrices[0] @ matrices[1].T
    common = common.astype(np.int64)
    union = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None, :] - common
    return (100 * common >= percent * union) & (common > 0)


def texts_of(docs: DataFrame, owners: DataFrame, of: Sets) -> DataFrame:
    """(node, text) for each of ``owners`` (node, doc_id); rows that only share the doc_id are told apart by their set."""

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            good = [of.node(of(t.as_py(), hashes)) == node for node, t in zip(batch.column(0).to_pylist(), batch.column(1))]
            yield batch.filter(pa.array(good, pa.bool_()))

    asked = small(owners.withColumnRenamed("doc_id", "__of"), BROADCAST_ROWS)
    rows = docs.select("doc_id", "text").join(asked, F.col("doc_id").eqNullSafe(F.col("__of"))).select("node", "text")
    return rows.mapInArrow(trimmed(run), "node long, text string").dropDuplicates(["node"])


def components_of(docs: DataFrame, known: DataFrame, of: Sets, percent: int) -> DataFrame:
    """(doc_id, n_shingles, node, component, component_id) of each row of ``known``, the ``nodes`` of ``docs``.

    Smallest ids are found per node, then per component; rows whose set no other row has or links to need no join partner.
    """
    parts = linked(docs, known, of, percent)
    per_node = known.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"), F.count("*").alias("rows"))
    per_node = per_node.join(parts, "node", "left").filter("rows > 1 or component is not null").withColumn("component", F.coalesce("component", "node"))
    per_node = cut(per_node, "copies")
    least = per_node.groupBy("component").agg(F.min("low").alias("component_id"))
    # A null id marks a component of null ids: the flag tells it from a row without partner.
    named = per_node.select("node", "component").join(small(least, BROADCAST_ROWS), "component").withColumn("there", F.lit(True))
    rows = known.join(small(named, BROADCAST_ROWS), "node", "left")
    return rows.select("doc_id", "n_shingles", "node", F.coalesce("component", "node").alias("component"), F.when(F.col("there"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def components(docs: DataFrame, n: int = 3, percent: int = 90, bits: int = 64) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs`` (doc_id, text); see the module's text."""
    docs = docs.select("doc_id", "text")
    known, of = known_nodes(docs, n, percent, bits)
    return components_of(docs, known, of, percent).select("doc_id", "n_shingles", "component_id")


@shielded("doc_id", "text")
def representatives(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component: that with the smallest doc_id; rows with empty sets all stay."""
    texts = docs.select("doc_id", "text")
    known, of = known_nodes(texts, n, percent)
    found = cut(components_of(texts, known, of, percent).filter("node is not null"), "components")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    others = found.filter(~stays).select("doc_id", "node").distinct()

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            found = [of.node(of(t.as_py(), hashes)) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.int64())], names)

    names = [*docs.columns, "__node"]
    rows = docs.select("*", F.col("text").alias("__text"))
    rows = rows.mapInArrow(trimmed(run), T.StructType([*docs.schema.fields, T.StructField("__node", T.LongType())]))
    others = small(others.select(F.col("doc_id").alias("__doc"), F.col("node").alias("__other")), BROADCAST_ROWS)
    rows = rows.join(others, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__node") == F.col("__other")), "left_anti")
    ties = found.filter(stays).groupBy("component").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("component").alias("__component"))
    if not ties.isEmpty():  # rows that repeat a representative
        labelled = rows.join(found.select(F.col("node").alias("__node"), F.col("component").alias("__component")).distinct(), "__node", "left")
        single = labelled.join(ties, "__component", "left_anti").select(*docs.columns)
        rows = single.unionByName(labelled.join(ties, "__component").dropDuplicates(["__component"]).select(*docs.columns))
    return rows.select(*docs.columns)


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                          ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM d),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
c AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT c.a, l.b FROM c JOIN l ON c.b = l.a),
m AS (SELECT a, min(b) AS component_id FROM c GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM s JOIN m ON doc_id = a
"""
