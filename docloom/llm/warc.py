"""WARC archives: a writer of monolithic gzip files, and a normaliser that makes them seekable.

``write_archives`` writes records as a single gzip stream per archive, the layout that needs normalising. ``normalise``
inflates each whole-file stream once, in pieces of bounded size, rewrites every record as a gzip member of its own and
writes a sidecar index of (offset, length) per record. ``read_archives`` opens members by the index alone.

Files go to the shared folder through ``pyarrow.fs``, first under a name of the task attempt, then renamed: a lost
executor or a second attempt leaves whole files only. Archive numbers come from the record's key, so reruns agree.

Payloads of at least ``min_bytes`` that are equal are stored once: the row with the largest page_id is the response, the
others are revisits that name it. Counting is pre-aggregated by digest, so a payload that a third of all pages share
is one small row per map task; the groups of two and more are broadcast only up to ``BROADCAST_ROWS`` rows.

Defined results: page_ids are integers; rows that repeat one have equal record ids. A null html is an empty payload; a null url is an empty target; repeated rows with the largest page_id
are responses each; a null page_id is never referred to unless all of its group are null, which then are all responses;
other columns are ignored; an empty table gives no archives and no rows.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_path, scratch, small

#: Rows of (digest, page_id) that are broadcast at most: some 100 MB.
BROADCAST_ROWS = 1_000_000
#: Bytes that are inflated or read at a time.
PIECE = 1 << 20
#: A fixed time stamp: reruns give the same bytes.
DATE = "2024-01-01T00:00:00Z"


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def with_revisits(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """(page_id, url, payload binary, digest, record_type, refers_to) of each row of ``pages`` (page_id, url, html)."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    large = pages.select("page_id", payload.alias("payload")).filter(F.length("payload") >= min_bytes).select("page_id", F.sha1("payload").alias("digest"))
    first = large.groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = rows.join(small(first, BROADCAST_ROWS), "digest", "left")
    again = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "payload", "digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first_id")).alias("refers_to"))


def record(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """A WARC 1.1 record with its two closing line ends. Revisits hold no payload."""
    body = b"" if kind == "revisit" else payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {' '.join((url or '').split())}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def records(chunks: Iterator[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """(head, body) of each record in a stream of inflated bytes; holds one record and one piece."""
    held = bytearray()
    for chunk in chunks:
        held += chunk
        at = 0
        while True:
            while held[at : at + 2] == b"\r\n":
                at += 2
            end = held.find(b"\r\n\r\n", at)
            if end < 0:
                break
            stop = end + 4 + int(parse_head(bytes(held[at:end])).get("content-length", 0))
            if stop + 4 > len(held):
                break
            yield bytes(held[at:end]), bytes(held[end + 4 : stop])
            at = stop + 4
        del held[:at]
    if held.strip(b"\r\n"):
        raise ValueError(f"the archive ends within a record, {len(held)} bytes are left")


def inflated(stream) -> Iterator[bytes]:
    """The bytes of a gzip file of one or more members, in pieces."""
    one = zlib.decompressobj(31)
    while data := stream.read(PIECE):
        while data:
            yield one.decompress(data, PIECE)
            while one.unconsumed_tail:
                yield one.decompress(one.unconsumed_tail, PIECE)
            data = one.unused_data
            if one.eof:
                one = zlib.decompressobj(31)
    if rest := one.flush():
        yield rest


class Put:
    """A file that appears under its name when it is whole."""

    def __init__(self, uri: str):
        self.fs, self.path = store(uri)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"

    def __enter__(self):
        self.stream = self.fs.open_output_stream(self.part, compression=None)
        return self.stream

    def __exit__(self, kind, *_):
        self.stream.close()
        if kind is None:
            if self.fs.get_file_info(self.path).type == pafs.FileType.File:
                self.fs.delete_file(self.path)
            self.fs.move(self.part, self.path)
        else:
            self.fs.delete_file(self.part)


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``rows`` (as of ``with_revisits``) as monolithic gzip WARC files, one for each task; returns (archive, records, bytes)."""

    def run(batches):
        from pyspark import TaskContext

        name, n, total = f"part-{TaskContext.get().partitionId():06d}.warc.gz", 0, 0
        batches = iter(batches)
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        with Put(f"{folder}/{name}") as out:
            z = zlib.compressobj(6, zlib.DEFLATED, 31)
            for batch in (b for part in ([first], batches) for b in part):
                for row in zip(*(c for c in batch.columns)):
                    data = record(*(x.as_py() for x in row))
                    n, total = n + 1, total + len(data)
                    out.write(z.compress(data))
            out.write(z.flush())
        yield pa.RecordBatch.from_pydict({"archive": [name], "records": pa.array([n], pa.int64()), "bytes": pa.array([total], pa.int64())})

    fs, path = store(folder)
    fs.create_dir(path, recursive=True)
    return rows.mapInArrow(run, "archive string, records long, bytes long")


def normalise(archives: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite each file of ``archives`` (archive) below ``source`` with one member per record; returns (archive, records) of ``target``.

    Next to each file goes ``<archive>.idx``: a JSON line (offset, length, type, id) for each record.
    """

    def run(batches):
        for batch in batches:
            done = []
            for name in batch.column(0).to_pylist():
                fs, path = store(f"{source}/{name}")
                n = offset = 0
                with fs.open_input_stream(path, compression=None, buffer_size=PIECE) as raw, Put(f"{target}/{name}") as out, Put(f"{target}/{name}.idx") as index:
                    for head, body in records(inflated(raw)):
                        z = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = z.compress(head + b"\r\n\r\n" + body + b"\r\n\r\n") + z.flush()
                        out.write(member)
                        got = parse_head(head)
                        index.write(json.dumps([offset, len(member), got.get("warc-type"), got.get("warc-record-id")]).encode() + b"\n")
                        offset, n = offset + len(member), n + 1
                done.append((name, n))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())], ["archive", "records"])

    fs, path = store(target)
    fs.create_dir(path, recursive=True)
    return archives.select("archive").mapInArrow(run, "archive string, records long")


def index_of(uri: str) -> list[list]:
    fs, path = store(uri)
    with fs.open_input_stream(path, compression=None) as f:
        return [json.loads(line) for line in f.read().splitlines()]


def read_member(stream, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """The head's fields and the body of the record whose member lies at ``offset``."""
    stream.seek(offset)
    head, _, rest = zlib.decompress(stream.read(length), 31).partition(b"\r\n\r\n")
    fields = parse_head(head)
    return fields, rest[: int(fields["content-length"])]


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, verified) of each record, read through the index.

    ``verified``: the stored body has the digest and length that its head states (revisits hold no body to compare).
    """
    number = lambda x: None if x is None or x == "<urn:page:None>" else int(x.removeprefix("<urn:page:").removesuffix(">"))

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                fs, path = store(f"{folder}/{name}")
                with fs.open_input_file(path) as f:
                    entries = index_of(f"{folder}/{name}.idx")
                    for k in range(0, len(entries), 2000):
                        out = []
                        for offset, length, *_ in entries[k : k + 2000]:
                            head, body = read_member(f, offset, length)
                            digest, size, kind = head["warc-payload-digest"].removeprefix("sha1:"), int(head["x-payload-length"]), head["warc-type"]
                            if kind == "response":
                                own = hashlib.sha1(body).hexdigest()
                                good, digest, size = (own, len(body)) == (digest, size), own, len(body)
                            else:
                                good = True
                            out.append((number(head["warc-record-id"]), head["warc-target-uri"], size, digest, kind, number(head.get("warc-refers-to")), good))
                        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified"])

    return archives.select("archive").mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, verified boolean")


def spread(spark: SparkSession, names: list[str]) -> DataFrame:
    """A table of archive names, one to a task: one name for each map task that wrote, never for each row."""
    rows = spark.createDataFrame([(x,) for x in names], "archive string")
    return rows.repartition(max(1, min(len(names), 4096)))


def round_trip(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """Write ``pages`` as archives, normalise them and read them back, in the shared folder."""
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    written = write_archives(with_revisits(pages, min_bytes), f"{folder}/raw").collect()
    names = [r["archive"] for r in written]
    done = normalise(spread(spark, names), f"{folder}/raw", f"{folder}/members").collect()
    if sum(r["records"] for r in done) != sum(r["records"] for r in written):
        raise ValueError("records were lost in normalising")
    drop_path(spark, f"{folder}/raw")  # read no more
    return read_archives(spread(spark, names), f"{folder}/members")
