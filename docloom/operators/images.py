"""Embedded images, references and their provenance: relational operators over whole corpora.

Tables are keyed by (doc_id, pos) or (doc_id, occurrence); per-document order is always an explicit column. Windows are per
document, and contents stay out of shuffles where a digest will do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions.segments import interleaved, outside
from docloom.functions.text import ALT_DEFAULT, alt_sanitize, strip

from .vision import image_dims as vision_dims

# Patterns, name lengths, furniture limits, statuses.
EMBEDDED = r"!\[([^\]]*)\]\(data:image/(png|jpeg|jpg);base64,([A-Za-z0-9+/=]+)\)"
REFERENCE = r"!\[([^\]]*)\]\(([^)]+)\)"
NAME_DIGITS = 16
FURNITURE_MIN_REFS, FURNITURE_MAX_HEIGHT, FURNITURE_MIN_WIDTH, FURNITURE_MIN_ASPECT = 2, 40, 80, 3.0
STATUSES = ("kept", "deduped", "missing", "inlined", "vectorized")


def decoded(base64: Column) -> Column:
    """Bytes, or null where the text is no whole base64."""
    good = (F.length(base64) % 4 == 0) & base64.rlike("^[A-Za-z0-9+/]*={0,2}$")
    return F.when(good, F.try_to_binary(base64, F.lit("base64")))


def encoded(content: Column) -> Column:
    """Base64 without the line ends that the built-in puts in."""
    return F.translate(F.base64(content), "\r\n", "")


def embedded_images(docs: DataFrame) -> DataFrame:
    """(doc_id, at, occurrence, alt, fmt, content, original_file, sha256): images embedded in md; those that cannot be decoded have no occurrence."""
    groups = [F.regexp_extract_all("md", F.lit(EMBEDDED), F.lit(g)) for g in (1, 2, 3)]
    rows = docs.select("doc_id", F.posexplode(F.arrays_zip(*(g.alias(x) for g, x in zip(groups, ("alt", "fmt", "data"))))).alias("at", "i"))
    rows = rows.select("doc_id", "at", F.coalesce(alt_sanitize(F.col("i.alt")), F.lit(ALT_DEFAULT)).alias("alt"), F.col("i.fmt").alias("fmt"), decoded(F.col("i.data")).alias("content"))
    good = F.col("content").isNotNull()
    number = F.when(good, F.sum(good.cast("int")).over(Window.partitionBy("doc_id").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("occurrence", number.cast("int"))
    ext = F.when(F.col("fmt") == "jpeg", "jpg").otherwise(F.col("fmt"))
    sha256, md5 = digests(F.col("content"))
    name = F.concat(F.lit("image_"), F.when(F.col("occurrence") < 1000, F.lpad(F.col("occurrence").cast("string"), 3, "0")).otherwise(F.col("occurrence").cast("string")), F.lit("_"), F.substring(md5, 1, 8), F.lit("."), ext)
    return rows.withColumn("original_file", F.when(good, name)).withColumn("sha256", sha256)


def split_images(docs: DataFrame, images: DataFrame) -> DataFrame:
    """``docs`` (doc_id, stem, md) with embedded images replaced by references to files of ``<stem>.images``."""
    named = images.filter("occurrence is not null").groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("at", F.struct("alt", "original_file")))).alias("__named"))
    joined = docs.join(named, "doc_id", "left")

    def one(found: Column, i: Column) -> Column:
        x = F.element_at(F.coalesce(F.col("__named"), F.create_map().cast("map<int,struct<alt:string,original_file:string>>")), i)
        return F.when(x.isNull(), found).otherwise(F.concat(F.lit("!["), x["alt"], F.lit("]("), F.col("stem"), F.lit(".images/"), x["original_file"], F.lit(")")))

    every = F.regexp_extract_all("md", F.lit(EMBEDDED), F.lit(0))
    return joined.withColumn("md", interleaved(outside(F.col("md"), EMBEDDED), F.transform(every, one))).drop("__named")


def references(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, alt, target, rel_name): every image reference in order; rel_name is set for files right in ``<stem>.images``."""
    groups = [F.regexp_extract_all("md", F.lit(REFERENCE), F.lit(g)) for g in (1, 2)]
    rows = docs.select("doc_id", "stem", F.posexplode(F.arrays_zip(groups[0].alias("alt"), groups[1].alias("target"))).alias("pos", "r"))
    return rows.select("doc_id", "pos", F.col("r.alt").alias("alt"), F.col("r.target").alias("target"), in_scope(F.col("r.target"), F.col("stem")).alias("rel_name"))


def in_scope(target: Column, stem: Column) -> Column:
    prefix = F.concat(stem, F.lit(".images/"))
    name = F.substring(strip(target), F.length(prefix) + 1, F.lit(2**30))
    return F.when(F.startswith(strip(target), prefix) & (name != "") & ~name.contains("/"), name)


def below_prefix(target: Column, stem: Column) -> Column:
    """What follows ``<stem>.images/``, folders and the empty name included; null for other targets."""
    prefix = F.concat(stem, F.lit(".images/"))
    return F.when(F.startswith(strip(target), prefix), F.substring(strip(target), F.length(prefix) + 1, F.lit(2**30)))


def digests(content: Column) -> tuple[Column, Column]:
    """(sha256, md5) of a content."""
    return F.sha2(content, 256), F.md5(content)


def join_metadata(images: DataFrame, metadata: DataFrame) -> DataFrame:
    """Images with the layout's metadata (doc_id, pos from 0, page, bbox, coord_system, meta_alt): the nth with the nth."""
    return images.join(metadata.withColumn("occurrence", (F.col("pos") + 1).cast("int")).drop("pos"), ["doc_id", "occurrence"], "left")


def canonical_names(refs: DataFrame) -> DataFrame:
    """``refs`` (doc_id, pos, rel_name, sha256) of existing files with ``canonical`` and ``rank`` within their content, in reference order.

    Contents are named by 16 digits of their hash and the suffix of their first reference; where that name is another content's, by all digits.
    """
    by = Window.partitionBy("doc_id", "sha256").orderBy("pos")
    suffix = F.coalesce(F.nullif(F.lower(F.regexp_extract("rel_name", r"[^.](\.[^.]+)$", 1)), F.lit("")), F.lit(".img"))
    rows = refs.withColumn("rank", F.row_number().over(by)).withColumn("__suffix", F.first(suffix).over(by)).withColumn("__first", F.first("pos").over(by))
    short = F.concat(F.substring("sha256", 1, NAME_DIGITS), F.col("__suffix"))
    owner = F.min_by("sha256", "__first").over(Window.partitionBy("doc_id", short))
    return rows.withColumn("canonical", F.when(owner == F.col("sha256"), short).otherwise(F.concat("sha256", "__suffix"))).drop("__suffix", "__first")


def dedupe_references(refs: DataFrame, files: DataFrame) -> DataFrame:
    """All ``refs`` with canonical, rank and status; ``files`` is (doc_id, name, sha256)."""
    known = files.select("doc_id", F.col("name").alias("rel_name"), "sha256")
    joined = refs.join(known, ["doc_id", "rel_name"], "left")
    named = canonical_names(joined.filter("sha256 is not null"))
    rest = joined.filter("sha256 is null").withColumn("rank", F.lit(None).cast("int")).withColumn("canonical", F.lit(None).cast("string"))
    status = F.when(F.col("rel_name").isNull(), "external").when(F.col("canonical").isNull(), "missing").when(F.col("rank") > 1, "deduped").otherwise("kept")
    return named.unionByName(rest.select(named.columns)).withColumn("status", status)


def dedupe_stats(deduped: DataFrame) -> DataFrame:
    """Totals of ``dedupe_references`` for each document."""
    stats = deduped.groupBy("doc_id").agg(F.count("*").alias("total_refs"), F.count("rel_name").alias("in_scope_refs"), F.count_if(F.col("rank") == 1).alias("unique_images"), F.count_if(F.col("rank") > 1).alias("duplicate_refs"), F.count_if(F.col("status") == "missing").alias("missing_files"))
    first = deduped.filter("rank = 1").groupBy("doc_id").agg(F.count_if(F.col("rel_name") != F.col("canonical")).alias("renamed_files"))
    touched = deduped.filter("canonical is not null").select("doc_id", "rel_name").distinct()
    kept = deduped.filter("canonical is not null").select("doc_id", F.col("canonical").alias("rel_name")).distinct()
    moved = deduped.filter("rank = 1").select("doc_id", "rel_name").distinct()
    removed = touched.join(kept, ["doc_id", "rel_name"], "left_anti").join(moved, ["doc_id", "rel_name"], "left_anti").groupBy("doc_id").agg(F.count("*").alias("removed_files"))
    return stats.join(first, "doc_id", "left").join(removed, "doc_id", "left").na.fill(0, ["renamed_files", "removed_files"])


def status_counts(deduped: DataFrame) -> DataFrame:
    """(doc_id, status, n)."""
    return deduped.groupBy("doc_id", "status").agg(F.count("*").alias("n"))


def rewrite_references(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """``docs`` (doc_id, md) with the reference at each pos replaced by ``new`` of ``targets`` (doc_id, pos, new); others stay."""
    found = targets.filter("new is not null").groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("pos", "new"))).alias("__new"))
    joined = docs.join(found, "doc_id", "left")
    every = F.regexp_extract_all("md", F.lit(REFERENCE), F.lit(0))
    one = lambda m, i: F.coalesce(F.element_at(F.coalesce(F.col("__new"), F.create_map().cast("map<int,string>")), i), m)
    return joined.withColumn("md", interleaved(outside(F.col("md"), REFERENCE), F.transform(every, one))).drop("__new")


def orphan_files(files: DataFrame, refs: DataFrame) -> DataFrame:
    return files.join(refs.select("doc_id", F.col("rel_name").alias("name")), ["doc_id", "name"], "left_anti")


def missing_refs(refs: DataFrame, files: DataFrame) -> DataFrame:
    return refs.filter("rel_name is not null").join(files.select("doc_id", F.col("name").alias("rel_name")), ["doc_id", "rel_name"], "left_anti")


def png_dims(content: Column) -> tuple[Column, Column]:
    """(width, height) of a PNG, else nulls."""
    good = (F.substring(content, 1, 8) == F.lit(b"\x89PNG\r\n\x1a\n")) & (F.length(content) >= 24)
    number = lambda at: F.when(good, F.conv(F.hex(F.substring(content, at, 4)), 16, 10).cast("int"))
    return number(17), number(21)


def image_dims(content: Column) -> tuple[Column, Column]:
    """(width, height) of a PNG, in the JVM, or of a GIF or JPEG, whose head is read in Python; else nulls."""
    width, height = png_dims(content)
    other = vision_dims(F.when(width.isNull(), content))
    return F.coalesce(width, other["width"]), F.coalesce(height, other["height"])


def is_furniture(refs: Column, width: Column, height: Column) -> Column:
    return F.coalesce((refs >= FURNITURE_MIN_REFS) & (height <= FURNITURE_MAX_HEIGHT) & (width >= FURNITURE_MIN_WIDTH) & (width / height >= FURNITURE_MIN_ASPECT), F.lit(False))


def reference_counts(refs: DataFrame) -> DataFrame:
    """(doc_id, rel_name, refs): how often a document refers to each of its files."""
    return refs.filter("rel_name is not null").groupBy("doc_id", "rel_name").agg(F.count("*").alias("refs"))


def page_furniture(refs: DataFrame, dims: DataFrame) -> DataFrame:
    """(doc_id, rel_name, refs): thin wide images that a document shows twice or more. ``dims`` is (doc_id, name, width, height)."""
    counted = reference_counts(refs)
    return counted.join(dims.withColumnRenamed("name", "rel_name"), ["doc_id", "rel_name"]).filter(is_furniture(F.col("refs"), F.col("width"), F.col("height"))).select("doc_id", "rel_name", "refs")


def image_map(entries: DataFrame) -> DataFrame:
    """(doc_id, image_map): the provenance of each document's images as JSON, version 1."""
    fields = ["occurrence", "alt", "original_file", "final_file", "status", "page", "bbox", "coord_system", "content_sha256"]
    rows = entries.groupBy("doc_id", "source", "markdown", "images_dir").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("entries"))
    return rows.select("doc_id", F.to_json(F.struct(F.lit(1).alias("version"), "source", "markdown", "images_dir", "entries"), {"ignoreNullFields": "false"}).alias("image_map"))


def align(entries: Column, targets: Column) -> Column:
    """The final file of each entry, or null where the text no longer shows it.

    ``entries`` holds the files expected, in order, ``targets`` those that the text refers to. Both are walked once: a target is
    taken if the counts are equal, if it is the file expected or its vector twin, or if enough targets are left for all entries.
    """
    same = F.size(entries) == F.size(targets)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"), F.lit(0).alias("n"))

    def step(a: Column, e: Column) -> Column:
        t = F.get(targets, a["at"])
        twin = F.concat(F.regexp_replace(e, r"(?<=[^/])\.[^./]+$", ""), F.lit(".svg"))
        enough = F.size(targets) - a["at"] >= F.size(entries) - a["n"]
        taken = t.isNotNull() & (same | F.coalesce(t == e, F.lit(False)) | F.coalesce(t == twin, F.lit(False)) | enough)
        return F.struct((a["at"] + taken.cast("int")).alias("at"), F.concat(a["out"], F.array(F.when(taken, t))).alias("out"), (a["n"] + 1).alias("n"))

    return F.aggregate(entries, start, step, lambda a: a["out"])


def final_status(final: Column, original: Column, before: Column, exists: Column) -> Column:
    svg = F.lower(final).endswith(".svg") & ~F.lower(original).endswith(".svg")
    return F.when(final.isNull(), "inlined").when(~exists, "missing").when(svg, "vectorized").when(before == "deduped", "deduped").otherwise("kept")
