import gzip
import hashlib
import io
import zlib

import pytest

from docloom.llm import warc


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")


def test_round_trip(spark):
    big = "é" * 600
    rows = [(1, "u1", big), (2, "u2", big), (3, None, big), (4, "u\r\n4", None), (5, "u5", ""), (6, "u6", "short"), (7, "u7", "short"), (8, "u8", "z" * 3_000_000), (9, "u9", "a\r\n\r\nWARC/1.1\r\n\r\nb"), (9, "u9", "c")]
    got = sorted((tuple(r) for r in warc.round_trip(pages(spark, rows).repartition(3)).collect()), key=str)
    first = {big: 3}
    want = []
    for i, u, h in rows:
        data = (h or "").encode()
        again = first.get(h, i) != i
        want.append((i, " ".join((u or "").split()), len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", 3 if again else None, True))
    assert got == sorted(want, key=str)
    assert warc.round_trip(pages(spark, rows).limit(0)).count() == 0


def test_members_stand_alone(spark, tmp_path):
    raw = [warc.record(i, "u", b"<p>%d</p>" % i * i, "d", "response", None) for i in range(50)]
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/a.warc.gz").write_bytes(gzip.compress(b"".join(raw[:20])) + gzip.compress(b"".join(raw[20:])))
    out = warc.normalise(warc.spread(spark, ["a.warc.gz"]), f"file://{tmp_path}/raw", f"file://{tmp_path}/out").collect()
    assert [r["records"] for r in out] == [50]
    data = (tmp_path / "out/a.warc.gz").read_bytes()
    assert gzip.decompress(data) == b"".join(raw)
    for (offset, length, *_), whole in zip(warc.index_of(f"file://{tmp_path}/out/a.warc.gz.idx"), raw, strict=True):
        assert zlib.decompress(data[offset : offset + length], 31) == whole


def test_broken_archive_is_an_error():
    data = gzip.compress(warc.record(1, "u", b"abc", "d", "response", None)[:-6])
    with pytest.raises(ValueError):
        list(warc.records(warc.inflated(io.BytesIO(data))))
