"""What images show: OCR geometry, classes, perceptual hashes. Models are hooks; geometry and rules are Column expressions."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Thresholds.
TEXT_MIN_REGIONS, TEXT_MIN_AREA, TEXT_MIN_CONFIDENCE, TEXT_MAX_UNIQUENESS = 5, 0.10, 0.65, 0.05
DIAGRAM_MIN_SCORE, DIAGRAM_MAX_REGIONS, DIAGRAM_MAX_COLORS = 0.5, 3, 1024
HASH_DISTANCE, ROW_DISTANCE = 8, 20.0
GAP_MIN_SHARE, RIGHT_MAX_SHARE, INK_BELOW = 0.12, 0.4, 200


def quad_to_bbox(xs: Column, ys: Column) -> Column:
    return F.struct(F.array_min(xs).alias("x"), F.array_min(ys).alias("y"), (F.array_max(xs) - F.array_min(xs)).alias("w"), (F.array_max(ys) - F.array_min(ys)).alias("h"))


def group_rows(regions: Column, distance: float = ROW_DISTANCE) -> Column:
    """Rows of regions (y, x, ...): a region belongs to the row whose first region is at most ``distance`` above; rows are sorted by x.

    ``regions`` is an array of structs with fields y and x; regions at one place keep their order.
    """
    kind = "array<struct<first:double,row:int>>"
    placed = F.array_sort(F.transform(regions, lambda r, i: F.struct(r["y"].alias("y"), r["x"].alias("x"), i.alias("i"))))
    ordered = F.transform(placed, lambda p: F.get(regions, p["i"]))
    starts = F.aggregate(ordered, F.array().cast(kind), lambda a, r: F.concat(a, F.array(F.when(F.size(a) == 0, F.struct(r["y"].alias("first"), F.lit(0).alias("row"))).when(F.abs(r["y"] - F.element_at(a, -1)["first"]) <= distance, F.element_at(a, -1)).otherwise(F.struct(r["y"].alias("first"), (F.element_at(a, -1)["row"] + 1).alias("row"))))))
    numbered = F.zip_with(ordered, starts, lambda r, s: F.struct(s["row"].alias("row"), r.alias("r")))
    many = F.coalesce(F.array_max(F.transform(starts, lambda s: s["row"])), F.lit(-1))
    rows = F.transform(F.when(many >= 0, F.sequence(F.lit(0), many)).otherwise(F.array().cast("array<int>")), lambda k: F.transform(F.filter(numbered, lambda x: x["row"] == k), lambda x: x["r"]))
    return F.transform(rows, lambda row: F.array_sort(row, lambda a, b: F.when(a["x"] < b["x"], -1).when(a["x"] > b["x"], 1).otherwise(0)))


def rows_text(rows: Column) -> Column:
    """Words joined by blanks, rows by line feeds."""
    lines = F.transform(rows, lambda row: F.regexp_replace(F.array_join(F.transform(row, lambda r: r["text"]), " "), r"(?U)^\s+|\s+\z", ""))
    return F.regexp_replace(F.array_join(lines, "\n"), r"(?U)^\s+|\s+\z", "")


def is_text_image(regions: Column, covered: Column, confidence: Column, area: Column, uniqueness: Column) -> Column:
    """From the count of regions, their area, mean confidence, the image's area and share of distinct colours."""
    return F.coalesce((regions >= TEXT_MIN_REGIONS) & (area > 0) & (covered / F.nullif(area, F.lit(0)) >= TEXT_MIN_AREA) & (confidence >= TEXT_MIN_CONFIDENCE) & (uniqueness <= TEXT_MAX_UNIQUENESS), F.lit(False))


def classify(is_text: Column, text: Column, score: Column, regions: Column, colors: Column) -> Column:
    return F.when(is_text & (text != ""), "text").when((score > DIAGRAM_MIN_SCORE) & (regions <= DIAGRAM_MAX_REGIONS) & (colors <= DIAGRAM_MAX_COLORS), "diagram").otherwise("photo")


def diagram_score(edge_density: Column, color_std: Column, uniqueness: Column) -> Column:
    score = edge_density * 0.4 + (1 - color_std) * 0.3 + (1 - F.least(uniqueness * 10, F.lit(1.0))) * 0.3
    return score + F.when(edge_density > 0.15, 0.15).otherwise(0.0)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def sign_hash(vector: Column, bits: int = 64) -> Column:
    """A hash of a vector: the signs of its steps, the first in the highest bit; vectors of fewer values leave low bits zero."""
    steps = F.sequence(F.lit(0), F.lit(bits - 1))
    bit = lambda i: F.when(F.coalesce(F.get(vector, i + 1) > F.get(vector, i), F.lit(False)), F.call_function("shiftleft", F.lit(1).cast("long"), bits - 1 - i)).otherwise(F.lit(0).cast("long"))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, i: a.bitwiseOR(bit(i)))


def first_match(hashes: Column, distance: int = HASH_DISTANCE, able: Column | None = None) -> Column:
    """The canonical hash of each, in order: the first canonical one within ``distance``, else itself, which becomes canonical.

    ``hashes`` is an array of bigint in reference order. One that is false in ``able`` (drawings that cannot be made) may share
    another's but never becomes canonical: without a near one its result is null.
    """
    able = F.transform(hashes, lambda _: F.lit(True)) if able is None else able
    start = F.struct(F.array().cast("array<bigint>").alias("canon"), F.array().cast("array<bigint>").alias("out"))

    def step(a: Column, x: Column) -> Column:
        near = F.get(F.filter(a["canon"], lambda c: hamming(c, x["h"]) <= distance), F.lit(0))
        new = near.isNull() & x["able"]
        return F.struct(F.when(new, F.concat(a["canon"], F.array(x["h"]))).otherwise(a["canon"]).alias("canon"), F.concat(a["out"], F.array(F.coalesce(near, F.when(x["able"], x["h"])))).alias("out"))

    pairs = F.zip_with(hashes, able, lambda h, b: F.struct(h.alias("h"), F.coalesce(b, F.lit(False)).alias("able")))
    return F.aggregate(pairs, start, step, lambda a: a["out"])


#: Narrower bands than this would let most pairs meet in some band; hashes of a block that are compared at a time.
LEAST_BAND, BLOCK = 6, 4096


def hamming_pairs(rows: DataFrame, distance: int = HASH_DISTANCE, bits: int = 64) -> DataFrame:
    """(doc_id, a, b, distance): pairs of a document's hashes (pos, hash) within ``distance``, exact.

    Of distance + 1 bands of the bits, one at least is equal, so pairs meet in an equi-join on bands. Where the distance leaves
    bands of few bits, a document's hashes are dealt into blocks instead, and two blocks are compared within a task.
    """
    if bits // (distance + 1) < LEAST_BAND:
        return block_pairs(rows, distance)
    parts = distance + 1
    cuts = [round(k * bits / parts) for k in range(parts + 1)]
    band = F.array(*(F.struct(F.lit(k).alias("k"), F.shiftrightunsigned("hash", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1 if hi - lo < 64 else -1).cast("long")).alias("v")) for k, (lo, hi) in enumerate(zip(cuts, cuts[1:]))))
    banded = rows.select("doc_id", "pos", "hash", F.explode(band).alias("band")).select("doc_id", "pos", "hash", "band.k", "band.v")
    other = banded.select("doc_id", F.col("pos").alias("b"), F.col("hash").alias("__h"), "k", "v")
    near = banded.join(other, ["doc_id", "k", "v"]).filter(F.col("pos") < F.col("b")).withColumn("distance", hamming(F.col("hash"), F.col("__h"))).filter(F.col("distance") <= distance)
    return near.select("doc_id", F.col("pos").alias("a"), "b", "distance").distinct()


def block_pairs(rows: DataFrame, distance: int, block: int = BLOCK) -> DataFrame:
    """``hamming_pairs`` by comparing blocks of at most some ``block`` hashes; only blocks' numbers are paired in a join."""
    kinds = {n: rows.schema[n].dataType.simpleString() for n in ("doc_id", "pos")}
    sizes = rows.groupBy("doc_id").agg(F.ceil(F.count("*") / block).alias("blocks"))
    dealt = rows.join(sizes, "doc_id").withColumn("k", F.pmod(F.xxhash64("pos"), F.col("blocks")))
    blocks = dealt.groupBy("doc_id", "k").agg(F.collect_list(F.struct("pos", "hash")).alias("m"))
    work = blocks.join(blocks.select("doc_id", F.col("k").alias("k_b"), F.col("m").alias("m_b")), "doc_id").filter("k <= k_b").select("doc_id", "k", "k_b", "m", "m_b")

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                (at, x), (bt, y) = (([v["pos"] for v in m], np.array([v["hash"] for v in m], np.int64).view(np.uint64)) for m in (r["m"], r["m_b"]))
                out = []
                for i, a in enumerate(at):
                    apart = np.bitwise_count(x[i] ^ y)
                    out += [(min(a, bt[j]), max(a, bt[j]), int(apart[j])) for j in np.flatnonzero(apart <= distance).tolist() if a < bt[j] or (r["k"] != r["k_b"] and a != bt[j])]
                columns = list(zip(*out)) or [(), (), ()]
                pos = batch.schema.field("m").type.value_type.field("pos").type
                yield pa.RecordBatch.from_arrays([pa.array([r["doc_id"]] * len(out), batch.schema.field("doc_id").type), pa.array(columns[0], pos), pa.array(columns[1], pos), pa.array(columns[2], pa.int32())], ["doc_id", "a", "b", "distance"])

    return work.mapInArrow(run, f"doc_id {kinds['doc_id']}, a {kinds['pos']}, b {kinds['pos']}, distance int")


def widest_gap(ink: Column) -> Column:
    """(start, length) of the widest run of columns without ink between inked columns, the first of equals; length 0 if there is none."""
    at = F.filter(F.transform(ink, lambda v, i: F.when(v, i)), lambda i: i.isNotNull())
    gaps = F.transform(F.slice(at, F.lit(1), F.greatest(F.lit(0), F.size(at) - 1)), lambda a, k: F.struct((F.get(at, k + 1) - a - 1).alias("length"), (a + 1).alias("start")))
    best = F.array_max(F.transform(gaps, lambda g: F.struct(g["length"].alias("length"), (-g["start"]).alias("less"))))
    return F.struct(F.coalesce(-best["less"], F.lit(0)).alias("start"), F.coalesce(best["length"], F.lit(0)).alias("length"))


def filled(raw: np.ndarray, mode: np.ndarray, n: int) -> np.ndarray:
    """The bytes (h, w, n) of filtered rows (h, w, n). Rows that look left and up are solved along diagonals, all rows at once."""
    h, w = raw.shape[:2]
    if not (mode > 2).any():
        out = np.zeros((h, w, n), np.uint8)
        for y in range(h):
            row = np.cumsum(raw[y], axis=0, dtype=np.uint8) if mode[y] == 1 else raw[y]
            out[y] = row + out[y - 1] if mode[y] == 2 and y else row
        return out
    ys = np.arange(h)
    is_left, is_up, is_mean, is_paeth = ((mode == k)[:, None] for k in (1, 2, 3, 4))
    out = np.zeros((h, w, n), np.int16)
    before = np.zeros((h, n), np.int16)  # the diagonal of pixels left of those asked, and the one left of it
    further = np.zeros((h, n), np.int16)
    shift = lambda x: np.concatenate([np.zeros((1, n), np.int16), x[:-1]])
    for t in range(w + h - 1):
        xs = t - ys
        good = (xs >= 0) & (xs < w)
        a, b, c = before, shift(before), shift(further)
        p, q, r = np.abs(b - c), np.abs(a - c), np.abs(a + b - 2 * c)
        paeth = np.where((p <= q) & (p <= r), a, np.where(q <= r, b, c))
        guess = np.where(is_left, a, 0) + np.where(is_up, b, 0) + np.where(is_mean, (a + b) // 2, 0) + np.where(is_paeth, paeth, 0)
        now = np.zeros((h, n), np.int16)
        now[good] = (raw[ys[good], xs[good]] + guess[good]) & 255
        out[ys[good], xs[good]] = now[good]
        before, further = now, before
    return out.astype(np.uint8)


def decode_png(data: bytes) -> np.ndarray | None:
    """Pixels (h, w, 4) of a PNG that is not interlaced, else None. Of 16 bits the high eight count."""
    if not data or data[:8] != b"\x89PNG\r\n\x1a\n":
        return None
    at, body, palette, clear = 8, [], None, None
    try:
        while at < len(data):
            size, kind = struct.unpack(">I4s", data[at : at + 8])
            chunk = data[at + 8 : at + 8 + size]
            at += size + 12
            if kind == b"IHDR":
                w, h, depth, color, _, _, laced = struct.unpack(">IIBBBBB", chunk)
                if laced or depth not in (1, 2, 4, 8, 16):
                    return None
            elif kind == b"PLTE":
                palette = np.frombuffer(chunk, np.uint8).reshape(-1, 3)
            elif kind == b"tRNS":
                clear = np.frombuffer(chunk, np.uint8)
            elif kind == b"IDAT":
                body.append(chunk)
        n = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[color]
        wide = max(1, n * depth // 8)  # bytes from a pixel to the next
        line = -(-w * n * depth // 8)
        raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(h, 1 + line)
        x = filled(raw[:, 1:].reshape(h, line // wide, wide).astype(np.uint8), raw[:, 0], wide).reshape(h, line)
        if depth < 8:
            bits = np.unpackbits(x, axis=1).reshape(h, -1, depth)[:, : w * n]
            x = (bits << np.arange(depth - 1, -1, -1, dtype=np.uint8)).sum(axis=2, dtype=np.uint8)
            x = x if color == 3 else x * np.uint8(255 // (2**depth - 1))
        elif depth == 16:
            x = x[:, ::2]
        x = x.reshape(h, w, n)
        rgba = np.full((h, w, 4), 255, np.uint8)
        if color == 3:
            rgba[..., :3] = palette[x[..., 0]]
            if clear is not None:
                rgba[..., 3] = np.concatenate([clear, np.full(256 - len(clear), 255, np.uint8)])[x[..., 0]]
        else:
            rgba[..., :3] = x[..., :1] if color in (0, 4) else x[..., :3]
    except (struct.error, zlib.error, ValueError, KeyError, IndexError, TypeError, UnboundLocalError):
        return None
    if color in (4, 6):
        rgba[..., 3] = x[..., -1]
    return rgba


def decode_image(data: bytes | None) -> np.ndarray | None:
    """Pixels (h, w, 4): PNG by the reader above; other formats, and what it leaves, by Pillow where that is installed."""
    pixels = decode_png(data) if data else None
    if pixels is not None or not data:
        return pixels
    try:
        from io import BytesIO

        from PIL import Image
    except ImportError:
        return None
    try:
        return np.asarray(Image.open(BytesIO(data)).convert("RGBA"))
    except (OSError, ValueError, SyntaxError):
        return None


def encode_png(pixels: np.ndarray) -> bytes:
    """A PNG of 8-bit grey pixels (h, w)."""
    h, w = pixels.shape
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    raw = np.concatenate([np.zeros((h, 1), np.uint8), pixels.astype(np.uint8)], axis=1).tobytes()
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def dims(data: bytes | None) -> tuple[int, int] | None:
    """(width, height) from the head of a PNG, GIF or JPEG."""
    if not data:
        return None
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return struct.unpack(">II", data[16:24])
    if data[:6] in (b"GIF87a", b"GIF89a") and len(data) >= 10:
        return struct.unpack("<HH", data[6:10])
    if data[:2] != b"\xff\xd8":
        return None
    at = 2
    while at + 9 <= len(data):
        if data[at] != 0xFF:
            return None
        kind = data[at + 1]
        if kind == 0xFF or kind == 0x01 or 0xD0 <= kind <= 0xD8:  # fill bytes and markers without a length
            at += 1 if kind == 0xFF else 2
        elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", data[at + 5 : at + 9])
            return width, height
        else:
            at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None


@F.pandas_udf(T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))
def image_dims(content: pd.Series) -> pd.DataFrame:
    """Nulls where the format is not known."""
    return pd.DataFrame([x or (None, None) for x in map(dims, content)], columns=["width", "height"])


def pixel_metrics(pixels: np.ndarray | None) -> tuple[float, float, float, int, int, int]:
    """(edge density, colour deviation, share of distinct colours, distinct colours, height, width); unreadable images count as all distinct."""
    if pixels is None or not pixels.size:
        return 0.0, 1.0, 1.0, 0, 0, 0
    rgb = pixels[..., :3]
    gray = np.pad(rgb.mean(axis=2), 1, mode="symmetric")
    across = gray[:, 2:] - gray[:, :-2]
    edges = across[:-2] + 2 * across[1:-1] + across[2:]
    colors = len(np.unique(rgb.reshape(-1, 3), axis=0))
    h, w = rgb.shape[:2]
    return float(np.abs(edges).mean() / 255), float(rgb.std() / 255), colors / (h * w), colors, h, w


def difference_hash(pixels: np.ndarray | None) -> int:
    """64 bits: whether a pixel of the 9 x 8 grey thumbnail of the drawn area is brighter than its left neighbour; 0 if there are no pixels."""
    if pixels is None or not pixels.size:
        return 0
    alpha = pixels[..., 3:].astype(float) / 255
    flat = np.round(pixels[..., :3] * alpha + 255 * (1 - alpha))
    drawn = np.abs(flat - flat[0, 0]).max(axis=2) > 8
    if drawn.any():
        ys, xs = np.flatnonzero(drawn.any(axis=1)), np.flatnonzero(drawn.any(axis=0))
        flat = flat[max(0, ys[0] - 1) : ys[-1] + 2, max(0, xs[0] - 1) : xs[-1] + 2]
    small = resample(resample(flat, 9, 1), 8, 0)
    gray = np.round(np.clip(np.round(small), 0, 255) @ np.array([0.299, 0.587, 0.114]))
    return int.from_bytes(np.packbits(gray[:, 1:] > gray[:, :-1]).tobytes(), "big", signed=True)


def resample(pixels: np.ndarray, size: int, axis: int) -> np.ndarray:
    """Lanczos with three lobes, widened by the scale when shrinking."""
    n = pixels.shape[axis]
    scale = n / size
    wide = max(scale, 1.0)
    center = (np.arange(size)[:, None] + 0.5) * scale
    x = (np.arange(n)[None, :] + 0.5 - center) / wide
    weight = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0)
    weight /= weight.sum(axis=1, keepdims=True)
    return np.moveaxis(np.tensordot(weight, pixels, axes=(1, axis)), 0, axis)


METRICS = T.StructType([T.StructField(n, t) for n, t in (("edge_density", T.DoubleType()), ("color_std", T.DoubleType()), ("color_uniqueness", T.DoubleType()), ("unique_colors", T.IntegerType()), ("height", T.IntegerType()), ("width", T.IntegerType()), ("hash", T.LongType()))])


@F.pandas_udf(METRICS)
def image_metrics(content: pd.Series) -> pd.DataFrame:
    rows = [(*pixel_metrics(x), difference_hash(x)) for x in map(decode_image, content)]
    return pd.DataFrame(rows, columns=METRICS.fieldNames())


def split_formula(pixels: np.ndarray) -> tuple[slice, slice | None]:
    """Columns of a formula and, after a wide gap, of its number."""
    ink = (pixels < INK_BELOW).any(axis=0)
    at = np.flatnonzero(ink)
    width = pixels.shape[1]
    if not len(at):
        return slice(0, width), None
    whole = slice(int(at[0]), int(at[-1]) + 1)
    gaps = np.diff(at) - 1
    if not len(gaps) or gaps.max() <= GAP_MIN_SHARE * width:
        return whole, None
    k = int(gaps.argmax())
    left, right = slice(int(at[0]), int(at[k]) + 1), slice(int(at[k + 1]), int(at[-1]) + 1)
    return (left, right) if right.stop - right.start < RIGHT_MAX_SHARE * width else (whole, None)


@F.pandas_udf(T.StructType([T.StructField("formula", T.BinaryType()), T.StructField("number", T.BinaryType())]))
def formula_parts(content: pd.Series) -> pd.DataFrame:
    """PNGs of an image's formula and of its number (null without one); what cannot be read is the formula as it is."""
    rows = []
    for data in content:
        pixels = decode_image(data)
        if pixels is None or not pixels.size:
            rows.append((data, None))
            continue
        gray = np.round(pixels[..., :3] @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)
        formula, number = split_formula(gray)
        rows.append((encode_png(gray[:, formula]), None if number is None else encode_png(gray[:, number])))
    return pd.DataFrame(rows, columns=["formula", "number"])


def class_counts(rows: DataFrame) -> DataFrame:
    """(doc_id, kind, n): of equations the references, of other classes the distinct targets. ``rows`` is (doc_id, rel_name, kind)."""
    return rows.groupBy("doc_id", "kind").agg(F.count("*").alias("__refs"), F.count_distinct("rel_name").alias("__targets")).select("doc_id", "kind", F.when(F.col("kind") == "equation", F.col("__refs")).otherwise(F.col("__targets")).alias("n"))
