import base64
import json
import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.__main__ import arguments, main
from docloom.operators import images as im
from docloom.operators import layout, vision
from docloom.plans.export import export
from docloom.plans.convert import ConvertOptions, convert, map_json, summary, text_pipeline, violations, write


def png(w, h, seed):
    raw = b"".join(b"\x00" + bytes((seed * 40 + (x // 12 + y // 12) % 2 * 120) % 256 for x in range(w) for _ in range(3)) for y in range(h))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def embed(alt, data):
    return f"![{alt}](data:image/png;base64,{base64.b64encode(data).decode()})"


def docs(spark):
    logo, figure, other = png(160, 25, 1), png(160, 80, 2), png(50, 50, 3)
    md = "\n\n".join(["# T", embed("logo", logo), embed(" fig  ure ", figure), embed("", figure), embed("logo", logo), embed("x", other), "![bad](data:image/png;base64,AAA)", "![ext](http://e/x.png)", "read - only $V _ { C R }$ then VCR"])
    return spark.createDataFrame([(1, "a.pdf", "a", md), (2, "b.pdf", "b", "plain")], "doc_id long, source_name string, stem string, md string")


def test_convert(spark, tmp_path):
    done = convert(docs(spark))
    md = {r.doc_id: r.md for r in done.documents.collect()}
    assert md[2] == "plain"
    assert "base64,AAA" in md[1] and "http://e/x.png" in md[1] and "logo" not in md[1] and md[1].endswith("read-only $V_{CR}$ then $V_{CR}$")
    rows = sorted(done.image_map.collect(), key=lambda r: r.occurrence)
    assert [r.status for r in rows] == ["inlined", "kept", "deduped", "inlined", "kept"]
    assert [r.alt for r in rows] == ["logo", "fig ure", "Image", "logo", "x"] and rows[1].final_file == rows[2].final_file == rows[1].content_sha256[:16] + ".png"
    stats = {r.doc_id: r for r in done.stats.collect()}
    assert (stats[1].total_refs, stats[1].in_scope_refs, stats[1].unique_images, stats[1].duplicate_refs, stats[1].removed_refs) == (7, 5, 3, 2, 2)
    assert {r.problem for r in violations(done).collect()} <= {"embedded image left"}
    assert summary(done.stats).first().total_refs == 7
    assert sorted(len(r.image_map) > 60 for r in map_json(done).collect()) == [True, True]
    write(done, str(tmp_path / "out"))
    try:
        write(done, str(tmp_path / "out"))
        raise AssertionError("overwrote")
    except Exception as e:
        assert "exist" in str(e).lower()
    again = convert(docs(spark), options=ConvertOptions(postprocess=False))
    paths = [x.removeprefix("file://") for x in again.paths]
    assert paths and all(map(os.path.exists, paths))
    write(again, str(tmp_path / "out"), ConvertOptions(force=True))
    assert not any(map(os.path.exists, paths)) and sorted(os.listdir(tmp_path)) == ["out"]
    assert {r.doc_id: r.md for r in spark.read.parquet(str(tmp_path / "out/documents")).collect()} == md


def test_text_pipeline_goldens(spark):
    cases = [
        ("R _ { B L k } = 1 5 costs $5 to $10", "R _ { B L k } = 1 5 costs $5 to $10"),
        ("$R _ { B L k } = 1 5$", "$R_{BLk}=15$"),
        (r"$$\mu A \max off$$", r"$$\mu A\max off$$"),
        (r"$$\mathsf{V_{TH}} \times \mathsf{N}$$", r"$$V_{TH}\times N$$"),
        (r"$1\,2\,\mu H_{x}$", r"$12\,\mu H_{x}$"),
        ("$V_{CR}$ and VCR or V CR but not VCRX, V<sub>CR</sub>", "$V_{CR}$ and $V_{CR}$ or $V_{CR}$ but not VCRX, $V_{CR}$"),
        ("```\nread - only •\n```\n• item\n- • two\nread - only", "```\nread - only •\n```\n- item\n- two\nread-only"),
        ("text\n1\n2\n3\n4\n5\n6\nend\n1\n2\n", "text\nend\n1\n2\n"),
        ("end\n\n\n12", "end\n"),
        ("## CONFIDENTIAL AND PROPRIETARY x\nbody", "body"),
        (None, None),
        ("", ""),
    ]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i long, md string")
    got = {r.i: r.md for r in text_pipeline(df).collect()}
    assert [got[i] for i in range(len(cases))] == [b for _, b in cases]


def test_hashes_and_metrics():
    a, b = vision.decode_png(png(160, 80, 2)), vision.decode_png(png(161, 81, 2))
    assert bin((vision.difference_hash(a) ^ vision.difference_hash(b)) & (2**64 - 1)).count("1") <= 16
    assert vision.pixel_metrics(a)[3:] == (2, 80, 160) and vision.pixel_metrics(None)[2] == 1.0
    assert vision.decode_png(b"x") is None and vision.decode_png(png(4, 4, 1)[:40]) is None


def filtered_png(pixels, mode, color, depth=8):
    """A PNG whose rows are filtered by the standard's formulas, byte by byte."""
    h, w, n = pixels.shape
    size = n * depth // 8
    rows = [bytearray(r.astype(">u2").tobytes() if depth == 16 else r.astype(np.uint8).tobytes()) for r in pixels]
    out = bytearray()
    for y, row in enumerate(rows):
        kind = mode if mode < 5 else y % 5
        out.append(kind)
        for i, v in enumerate(row):
            a, b, c = (row[i - size] if i >= size else 0), (rows[y - 1][i] if y else 0), (rows[y - 1][i - size] if y and i >= size else 0)
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            out.append((v - (0, a, b, (a + b) // 2, paeth)[kind]) % 256)
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, color, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(bytes(out))) + chunk(b"IEND", b"")


@pytest.mark.parametrize("mode", range(6))
def test_png_filters(mode):
    r = np.random.default_rng(mode)
    for color, n in ((0, 1), (2, 3), (4, 2), (6, 4)):
        for h, w in ((1, 1), (7, 13), (13, 7)):
            x = r.integers(0, 256, (h, w, n))
            got = vision.decode_png(filtered_png(x, mode, color))
            assert np.array_equal(got[..., :3], np.broadcast_to(x[..., :1], (h, w, 3)) if n < 3 else x[..., :3])
            assert np.array_equal(got[..., 3], x[..., -1] if color in (4, 6) else np.full((h, w), 255))
    wide = r.integers(0, 65536, (5, 6, 3))
    assert np.array_equal(vision.decode_png(filtered_png(wide, mode, 2, 16))[..., :3], wide >> 8)


def test_small_depths_and_large_images():
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    bits = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 3, 2, 1, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\x00\xa0\x00\x40")) + chunk(b"IEND", b"")
    assert vision.decode_png(bits)[..., 0].tolist() == [[255, 0, 255], [0, 255, 0]]
    x = np.random.default_rng(1).integers(0, 256, (300, 400))
    assert np.array_equal(vision.decode_png(vision.encode_png(x))[..., 0], x)
    assert vision.decode_image(None) is None and vision.decode_image(b"") is None and vision.decode_image(b"GIF89a") is None


def jpeg(w, h, sof=0xC0):
    return b"\xff\xd8\xff\xe0" + struct.pack(">H", 4) + b"ab" + b"\xff\xff" + bytes([sof]) + struct.pack(">HBHHB", 11, 8, h, w, 1) + b"\x01\x11\x00\xff\xd9"


def test_dimensions(spark):
    cases = {png(7, 9, 1): (7, 9), b"GIF89a" + struct.pack("<HH", 300, 20): (300, 20), b"GIF87a" + struct.pack("<HH", 1, 2): (1, 2), jpeg(160, 25): (160, 25), jpeg(9, 8, 0xC2): (9, 8), jpeg(9, 8, 0xC4): None, b"\xff\xd8\xff": None, b"": None, b"x" * 50: None}
    assert {k: vision.dims(k) for k in cases} == cases and vision.dims(None) is None
    df = spark.createDataFrame([(i, bytearray(k)) for i, k in enumerate(cases)] + [(99, None)], "i long, c binary")
    w, h = im.image_dims(F.col("c"))
    got = {r.i: (r.w, r.h) for r in df.select("i", w.alias("w"), h.alias("h")).collect()}
    assert got == {**{i: v or (None, None) for i, v in enumerate(cases.values())}, 99: (None, None)}


def test_jpeg_banners_are_furniture(spark):
    image = f"![x](data:image/jpeg;base64,{base64.b64encode(jpeg(160, 25)).decode()})"
    df = spark.createDataFrame([(1, "a.pdf", "a", f"{image} text {image}")], "doc_id long, source_name string, stem string, md string")
    assert convert(df).documents.first().md == " text "


def test_hamming_pairs_at_any_distance(spark):
    r = np.random.default_rng(3)
    rows = [(int(d), int(p), int(h)) for d, p, h in zip(r.integers(0, 3, 160), range(160), r.integers(-(2**63), 2**63 - 1, 160))]
    rows += [(d, 1000 + i, h ^ (1 << int(r.integers(0, 63)))) for i, (d, _, h) in enumerate(rows[:40])]
    df = spark.createDataFrame(rows, "doc_id long, pos long, hash long")
    for distance in (0, 2, 8, 20, 30):
        want = {(d, min(p, q), max(p, q), bin((a ^ b) % 2**64).count("1")) for d, p, a in rows for e, q, b in rows if d == e and p < q and bin((a ^ b) % 2**64).count("1") <= distance}
        assert {tuple(x) for x in vision.hamming_pairs(df, distance).collect()} == want
        assert {tuple(x) for x in vision.block_pairs(df, distance, block=7).collect()} == want
    assert vision.hamming_pairs(df.limit(0), 20).count() == 0


def test_first_match_and_drawings_that_fail(spark):
    df = spark.createDataFrame([([0, 1, 0b111, 7 << 58], [False, True, True, False])], "h array<long>, able array<boolean>")
    row = df.select(vision.first_match(F.col("h"), 1).alias("a"), vision.first_match(F.col("h"), 1, F.col("able")).alias("b"), vision.first_match(F.col("h"), 2, F.col("able")).alias("c")).first()
    assert row.a == [0, 0, 7, 7 << 58] and row.b == [None, 1, 7, None] and row.c == [None, 1, 1, None]


def test_rows_keep_the_order_of_regions_at_one_place(spark):
    df = spark.createDataFrame([([(5.0, 1.0, "b", 9), (5.0, 1.0, "a", 1), (0.0, 7.0, "c", 1), (40.0, 0.0, "d", 1)],)], "r array<struct<y:double,x:double,text:string,z:int>>")
    assert df.select(vision.rows_text(vision.group_rows(F.col("r"))).alias("t")).first().t == "b a c\nd"


def test_near_duplicate_diagrams(spark, monkeypatch):
    """Three like diagrams, the first of which cannot be drawn, two references to the last; counts are of targets."""
    def stripes(pad, color):
        x = np.full((120, 200), 255, np.uint8)
        x[pad : 120 - pad, pad : 200 - pad] = 0
        x[pad + 10 : 110 - pad, pad + 10 : 100] = color
        return vision.encode_png(x)

    first, second, third = stripes(2, 200), stripes(2, 201), stripes(2, 202)
    monkeypatch.setattr("docloom.plans.convert.hook", lambda kind: (lambda c: F.when(c != F.lit(bytearray(first)), F.lit(b"<svg/>"))) if kind == "vectorizer" else None)
    md = "\n".join(embed(n, x) for n, x in (("a", first), ("b", second), ("c", third), ("d", third)))
    done = convert(spark.createDataFrame([(1, "a.pdf", "a", md)], "doc_id long, source_name string, stem string, md string"))
    names = [r.final_file for r in done.image_map.orderBy("occurrence").collect()]
    statuses = [r.status for r in done.image_map.orderBy("occurrence").collect()]
    stats = done.stats.first()
    assert names[0].endswith(".png") and names[1].endswith(".svg") and names[1] == names[2] == names[3]
    assert statuses == ["kept", "vectorized", "vectorized", "vectorized"]
    assert (stats.n_diagram, stats.visual_dedupe_files, stats.visual_dedupe_refs, stats.unreferenced_files) == (3, 1, 1, 1)
    assert {r.name for r in done.files.collect()} == {names[0], names[1]} and violations(done).count() == 0


def test_formulas_of_layout_items(spark):
    x = np.full((10, 100), 255, np.uint8)
    x[:, 5:40], x[:, 90:95] = 0, 0
    items = spark.createDataFrame([(1, "text", "formula", bytearray(vision.encode_png(x)), "old"), (2, "Text", "FORMULA", None, "kept"), (3, "text", "caption", bytearray(b"x"), "c"), (4, "picture", "formula", bytearray(b"x"), "p"), (5, "text", "formula", bytearray(b"broken"), "old")], "i long, kind string, label string, image binary, text string")
    said = lambda c: F.when(c.isNotNull(), F.concat(F.lit("w="), im.image_dims(c)[0].cast("string")))
    out = {r.i: r.text for r in layout.with_formulas(items, said, lambda c: F.when(c.isNotNull(), F.lit("( 4 )"))).collect()}
    assert out == {1: "w=35 \\tag{4}", 2: "kept", 3: "c", 4: "p", 5: "old"}


def test_export_and_command_line(spark, tmp_path, capsys):
    done = convert(docs(spark))
    out = tmp_path / "out"
    sources = spark.createDataFrame([("a.pdf", bytearray(b"%PDF"))], "source_name string, content binary")
    n = export(done, out.as_uri(), sources)
    files = sorted(str(p.relative_to(out)) for p in out.rglob("*") if p.is_file())
    assert len(files) == n and {"a.pdf", "a.md", "a.image-map.json", "b.md", "b.image-map.json"} <= set(files) and (out / "b.md").read_text() == "plain"
    assert {p for p in files if p.startswith("a.images/")} == {f"a.images/{r.name}" for r in done.files.collect()} and json.loads((out / "b.image-map.json").read_text())["entries"] == []
    with pytest.raises(FileExistsError):
        export(done, out.as_uri())
    (out / "a.images/old.png").write_bytes(b"x")
    export(done, out.as_uri(), force=True)
    assert not (out / "a.images/old.png").exists() and (out / "a.pdf").exists()
    page = tmp_path / "in"
    page.mkdir()
    (page / "P.HTML").write_text(f"<h1>T</h1><p>read - only <img src='data:image/png;base64,{base64.b64encode(png(50, 50, 3)).decode()}'>")
    assert main([str(page / "P.HTML"), str(tmp_path / "made")], spark) == 0
    assert sorted(os.listdir(tmp_path / "made")) == ["P.HTML", "P.image-map.json", "P.images", "P.md"] and (tmp_path / "made/P.md").read_text().startswith("# T\n\nread-only ![Image](P.images/")
    assert main([str(page / "P.HTML"), str(tmp_path / "made")], spark) == 1 and "force" in capsys.readouterr().err
    assert main([str(page / "P.HTML"), str(tmp_path / "made"), "--force"], spark) == 0
    assert main([str(tmp_path / "made" / "P.md")], spark) == 1
    assert vars(arguments(["x", "--no-ocr", "-f"])) == {"input": "x", "output": None, "force": True, "ocr": False, "postprocess": True}
