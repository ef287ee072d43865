"""BPE encoding and decoding through a table of distinct words.

1. Texts are split in Spark into the words of the tokenizer's own pre-tokenizer, a chunk of texts at a time. A chunk is a row: its
   documents, the dictionary of its distinct words, and its texts as positions in that dictionary.
2. The dictionaries' words are dealt by hash into ``BUCKETS`` buckets of the distinct-word table, where each distinct word is
   encoded once. A word is there once per chunk, however frequent it is, so no key is hot. Words are compared as words.
3. Ids are joined back to the chunks by position: a join on the chunk, then the positions of its texts. Chunks are stored in
   buckets by chunk, so their texts are on disk once and in no shuffle.
4. Decoding joins the distinct ids of a chunk to the id-to-piece table, which has the size of the vocabulary. Bytes are
   joined and read as UTF-8 with U+FFFD for what is none, as the library's byte-level decoder does. ``decoded`` is the same
   join for stored sequences of ids.

One plan at every size: nothing that grows with the corpus is broadcast, collected or remembered from task to task. A task
holds one chunk, or ``HELD`` of a bucket's distinct words; words that it has to let go are encoded anew when they come again.

Words are split with the pre-tokenizer's pattern; characters that the pattern engine and the library put in different
classes (newer Unicode versions) are found by probing the library once per distinct character and worker, and texts that
hold one are split by the library itself. Special strings in a text become their special ids, which is the library's default.

Defined results: a null or empty text has no tokens and decodes to the empty text; repeated rows each give a row; ties
do not occur; other columns are ignored; a text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_by, small_batches, trimmed
from .token_counts import load

#: The byte-level pre-tokenizer's pattern, with the letters first (for speed), as no other branch can match where they do.
PATTERN = regex.compile(r" ?\p{L}++|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+")
#: Characters of text in a chunk, buckets of the word table, words that the library encodes at a time, words of the table that a task holds.
CHUNK_CHARS, BUCKETS, ENCODED, HELD = 16_000_000, 512, 20_000, 1 << 20
CODEC = pa.Codec("zstd", compression_level=3)
#: Numbers that are packed at a time, for small intermediates.
SOME = 1 << 18
#: Marks a special string among words. No word can equal it: the pattern never joins white space to what follows but for one space.
MARK = "\n\nspecial:"


class Splitter:
    """Splits texts into the words of the tokenizer."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.special = {x["content"]: x["id"] for x in json.load(open(path))["added_tokens"]}
        self.cut_at = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.agrees: dict[str, bool] = {}
        self.good: set[str] = set()

    def _library(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _same(self, c: str) -> bool:
        if c not in self.agrees:
            probe = f"a{c}1{c}!{c} {c}{c}"
            self.agrees[c] = PATTERN.findall(probe) == self._library(probe)
            if self.agrees[c]:
                self.good.add(c)
        return self.agrees[c]

    def plain(self, text: str) -> list[str]:
        if text.isascii() or all(map(self._same, set(text) - self.good)):
            return PATTERN.findall(text)
        return self._library(text)

    def words(self, text: str) -> list[str]:
        """Words in order; a special string is a word of its own behind MARK."""
        if self.cut_at is None or not self.cut_at.search(text):
            return self.plain(text)
        out: list[str] = []
        for k, part in enumerate(self.cut_at.split(text)):
            out += [MARK + part] if k % 2 else self.plain(part)
        return out

    def encode(self, words: list[str]) -> Iterator[list[int]]:
        for k in range(0, len(words), ENCODED):
            for x in self.tokenizer.encode_batch_fast([w.removeprefix(MARK) for w in words[k : k + ENCODED]], add_special_tokens=False):
                yield x.ids


@functools.lru_cache(maxsize=2)
def splitter(path: str) -> Splitter:
    return Splitter(path)


class Dictionary(dict):
    """Words to their places, in order of first sight."""

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        return at


def lists(values: pa.Array, lengths) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), values)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0, seven bits to a byte and the low ones first, the high bit where more follow; compressed."""
    parts = []
    for start in range(0, len(numbers), SOME):
        some = numbers[start : start + SOME].astype(np.uint32)
        sizes = 1 + sum((some >> np.uint32(7 * k) > 0).astype(np.int64) for k in range(1, 5))
        at = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), np.uint8)
        for k in range(int(sizes.max())):
            more = sizes > k
            out[at[more] + k] = (some[more] >> np.uint32(7 * k)) & np.uint32(127) | np.where(sizes[more] > k + 1, np.uint32(128), np.uint32(0))
        parts.append(out.tobytes())
    whole = b"".join(parts)
    return len(whole).to_bytes(8, "little") + CODEC.compress(whole, asbytes=True)


def unpacked(blob: bytes) -> np.ndarray:
    found = np.frombuffer(CODEC.decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True), np.uint8)
    out, n, start = np.empty(int((found < 128).sum()), np.int32), 0, 0
    while start < len(found):
        some = found[start : start + SOME]
        ends = np.flatnonzero(some < 128)  # a number that goes on beyond is left for the next round
        starts = np.concatenate([[0], ends[:-1] + 1])
        part = (some[starts] & 127).astype(np.int32)
        for k in range(1, 5):
            more = ends - starts >= k
            part[more] |= (some[starts[more] + k] & 127).astype(np.int32) << (7 * k)
        out[n : n + len(part)] = part
        n, start = n + len(part), start + int(ends[-1]) + 1
    return out


def packed_words(words: list[bytes]) -> tuple[bytes, int]:
    """Words with their lengths, compressed, and the size of that before."""
    sizes = np.fromiter(map(len, words), "<i4", len(words))
    whole = sizes.tobytes() + b"".join(words)
    return CODEC.compress(whole, asbytes=True), len(whole)


def unpacked_words(blob: bytes, size: int, n: int) -> list[str]:
    whole = CODEC.decompress(blob, size, asbytes=True)
    ends = (np.cumsum(np.frombuffer(whole, "<i4", n)) + 4 * n).tolist()
    return [whole[a:b].decode() for a, b in zip([4 * n, *ends], ends)]


def chunks(docs: DataFrame, path: str, chunk_chars: int, buckets: int) -> DataFrame:
    """Rows of two kinds. Of a chunk: (chunk, docs, lengths, places, order): its texts as words' ranks by frequency, and the steps
    from rank to rank over its words by bucket. Of a chunk and a bucket: (chunk, bucket, asked, asked_size, n_words), its distinct
    words of that bucket by rank."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        split, part, made = splitter(path), TaskContext.get().partitionId(), 0
        schema = held = None

        def out():
            nonlocal made
            chunk, made = (part << 32) + made, made + 1
            words = [w.encode() for w in held["words"]]
            places = np.concatenate([*held["places"], np.empty(0, np.int32)])
            bucket = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in words), np.int64, len(words))
            by_word = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
            by_rank = by_word[np.lexsort((bucket[by_word], -np.bincount(places, minlength=len(words))[by_word]))]
            rank = np.empty(len(words), np.int32)
            rank[by_rank] = np.arange(len(words), dtype=np.int32)
            order = np.argsort(bucket[by_rank], kind="stable")  # ranks by bucket
            found, sizes = np.unique(bucket, return_counts=True)
            n, ordered = len(found), list(map(words.__getitem__, by_rank[order].tolist()))
            ends = [0, *np.cumsum(sizes).tolist()]
            steps = np.diff(order, prepend=0) + np.where(np.isin(np.arange(len(order)), ends[1:]), len(order), 0)  # down only where a bucket begins
            asked = [packed_words(ordered[a:b]) for a, b in zip(ends, ends[1:])]
            columns = {"chunk": np.full(n, chunk), "bucket": found, "asked": [x for x, _ in asked], "asked_size": [x for _, x in asked], "n_words": sizes}
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)
            columns = {"chunk": chunk, "docs": held["docs"], "lengths": [len(x) for x in held["places"]], "places": packed(rank[places] if len(places) else places), "order": packed(steps)}
            yield pa.RecordBatch.from_arrays([pa.array([columns.get(f.name)], f.type) for f in schema], schema=schema)

        for batch in batches:
            if schema is None:
                schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("asked", pa.binary()), ("asked_size", pa.int32()), ("docs", pa.list_(batch.schema.field(0).type)), ("lengths", pa.list_(pa.int32())), ("places", pa.binary()), ("order", pa.binary()), ("n_words", pa.int32())])
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                if held is not None and held["chars"] + len(text) > chunk_chars:
                    yield from out()
                    held = None
                if held is None:
                    held = {"chars": 0, "docs": [], "places": [], "words": Dictionary()}
                words = split.words(text)
                held["chars"] += len(text)
                held["docs"].append(doc)
                held["places"].append(np.fromiter(map(held["words"].__getitem__, words), np.int32, len(words)))
        if held is not None:
            yield from out()

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), f"chunk long, bucket int, asked binary, asked_size int, docs array<{kind}>, lengths array<int>, places binary, order binary, n_words int")


def encode_words(asked: DataFrame, path: str, most: int = HELD) -> DataFrame:
    """(chunk, bucket, ids, sizes) of rows (chunk, bucket, asked, asked_size, n_words): the ids of each word. Rows come by bucket, so each distinct word is encoded once."""

    def run(batches):
        split, held = splitter(path), {}
        for batch in batches:
            bucket = batch.column(1).to_pylist()
            words = [unpacked_words(*x) for x in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))]
            flat = list(chain.from_iterable(words))
            new = list(set(flat) - held.keys())
            held.update(zip(new, split.encode(new)))
            found = list(map(held.__getitem__, flat))
            counts = np.fromiter(map(len, found), np.int32, len(found))
            ids = pa.array(np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum())))
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            borders = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(lengths)])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists(ids, np.diff(borders)), lists(pa.array(counts), lengths)], ["chunk", "bucket", "ids", "sizes"])
            # The next batch may go on with the last bucket.
            held = held if bucket[0] == bucket[-1] else {w: held[w] for k in range(bucket.index(bucket[-1]), len(bucket)) for w in words[k]}
            held = held if len(held) <= most else {}

    return asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(trimmed(run), "chunk long, bucket int, ids array<int>, sizes array<int>")


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The id-to-piece table (id, piece): the bytes of each id. Its size is that of the vocabulary."""
    order = [*range(33, 127), *range(161, 173), *range(174, 256)]
    to_byte = {chr(b): b for b in order} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(order))}
    rows = [(i, bytearray(bytes(map(to_byte.__getitem__, token)) if all(c in to_byte for c in token) else token.encode())) for token, i in load(path).get_vocab(with_added_tokens=True).items()]
    return spark.createDataFrame(rows, "id int, piece binary")


def decoded(sequences: DataFrame, path: str) -> DataFrame:
    """(key, text) of rows (key, ids array<int>) with distinct keys, through a join of each id to its piece.

    Null or empty sequences decode to the empty text; ids that the vocabulary lacks are left out, as the library does.
    """

    @F.pandas_udf("string")
    def read(found):
        return found.map(lambda x: bytes.fromhex(x).decode("utf-8", "replace"))

    each = sequences.select("key", F.posexplode("ids").alias("at", "id"))
    joined = each.join(F.broadcast(pieces(sequences.sparkSession, path)), "id").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", F.hex("piece").alias("piece")))).alias("x"))
    rows = sequences.select("key").join(joined, "key", "left")
    return rows.select("key", read(F.coalesce(F.array_join(F.transform("x", lambda p: p["piece"]), ""), F.lit(""))).alias("text"))


def bpe_digests(docs: DataFrame, path: str, chunk_chars: int = CHUNK_CHARS, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row of ``docs`` (doc_id, text); see the module's text."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = cut_by(chunks(docs, path, chunk_chars, buckets), "chunks", "chunk")  # texts are stored once and stay out of shuffles
    answers = encode_words(held.filter("bucket is not null").select("chunk", "bucket", "asked", "asked_size", "n_words"), path)
    grouped = answers.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("bucket", "ids", "sizes"))).alias("x"))  # one exchange for both uses
    by_chunk = grouped.select("chunk", flat(F.col("x"), "ids"), flat(F.col("x"), "sizes"))
    texts = held.filter("bucket is null").drop("bucket", "asked", "asked_size", "n_words").join(by_chunk, "chunk", "left")
    used = grouped.select("chunk", F.explode(F.array_distinct(flat(F.col("x"), "ids"))).alias("id")).join(F.broadcast(pieces(spark, path)), "id")  # the size of the vocabulary
    used = used.groupBy("chunk").agg(F.collect_list(F.struct("id", "piece")).alias("p"))
    rows = texts.join(used.select("chunk", F.col("p.id").alias("piece_ids"), F.col("p.piece").alias("pieces")), "chunk", "left")

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k] for name in batch.schema.names}
                numbers = lambda name: row[name].values.to_numpy() if row[name].is_valid else np.empty(0, np.int32)
                number = numbers("piece_ids").tolist()
                piece, digits = dict(zip(number, row["pieces"].as_py() or [])), dict(zip(number, map(str, number)))
                ids, counts, lengths = numbers("ids"), numbers("sizes").astype(np.int64), numbers("lengths").tolist()
                order = unpacked(row["order"].as_py())
                n = len(order)
                order = np.cumsum(order) % max(1, n)  # where a bucket begins, n was added
                if len(counts) != n:
                    raise ValueError("a word of the chunk has no ids")
                ends = np.concatenate([[0], np.cumsum(counts)]).tolist()
                part, content, sizes = [""] * n, [b""] * n, np.zeros(n, np.int64)
                sizes[order] = counts
                said, held = (list(map(x.__getitem__, ids.tolist())) for x in (digits, piece))
                for at, a, b in zip(order.tolist(), ends, ends[1:]):
                    part[at], content[at] = ",".join(said[a:b]), b"".join(held[a:b])
                del said, held
                places, start, out = unpacked(row["places"].as_py()), 0, []
                for doc, length in zip(row["docs"].as_py(), lengths):
                    some = places[start : start + length]
                    start += length
                    at = some.tolist()
                    text = b"".join(map(content.__getitem__, at)).decode("utf-8", "replace")
                    out.append((doc, int(sizes[some].sum()), hashlib.sha256(",".join(map(part.__getitem__, at)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [batch.schema.field("docs").type.value_type, pa.int64(), pa.string(), pa.string()])], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(trimmed(run), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def flat(rows: Column, field: str) -> Column:
    return F.flatten(F.transform(rows, lambda x: x[field])).alias(field)
