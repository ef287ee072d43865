"""From documents with embedded images to clean Markdown, image files, a provenance map and statistics, as one plan per table."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import math as latex
from docloom.functions.text import alt_sanitize, clean_markdown, drop_guid_lines, preceded_by_equation_label, wrap_latex
from docloom.operators import images as im
from docloom.operators import vision
from docloom.sources.registry import hook

from .tables import dropped, stored


@dataclass(frozen=True)
class ConvertOptions:
    """``postprocess``: classify images and rewrite their references. ``ocr``: use the registered OCR. ``force``: overwrite outputs."""

    postprocess: bool = True
    ocr: bool = True
    force: bool = False


@dataclass(frozen=True)
class Converted:
    documents: DataFrame  # doc_id, source_name, stem, md
    files: DataFrame  # doc_id, name, content
    image_map: DataFrame  # doc_id, occurrence, alt, original_file, final_file, status, page, bbox, coord_system, content_sha256
    stats: DataFrame  # doc_id and counts
    paths: list = field(default_factory=list)  # written intermediates that the tables read


def text_pipeline(docs: DataFrame, column: str = "md") -> DataFrame:
    """Cleanup, math normalisation and subscripts of a Markdown column. One projection each, so that no pass is inlined twice."""
    rows = docs.withColumn(column, clean_markdown(F.col(column)))
    return latex.standardize_subscripts(latex.normalize_math(rows, column), column)


def reference(alt: Column, stem: Column, name: Column) -> Column:
    return F.concat(F.lit("!["), alt, F.lit("]("), stem, F.lit(".images/"), name, F.lit(")"))


def offsets(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, start): where each reference of md starts, in characters from 0."""
    parts, found = F.split("md", im.REFERENCE, -1), F.regexp_extract_all("md", F.lit(im.REFERENCE), F.lit(0))
    sizes = F.zip_with(parts, found, lambda p, m: F.struct(F.length(p).alias("p"), F.coalesce(F.length(m), F.lit(0)).alias("m")))
    starts = F.aggregate(sizes, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda a, x: F.struct((a["at"] + x["p"] + x["m"]).alias("at"), F.concat(a["out"], F.array(a["at"] + x["p"])).alias("out")), lambda a: a["out"])
    return docs.select("doc_id", F.posexplode(F.slice(starts, F.lit(1), F.size(found))).alias("pos", "start"))


#: Classes that statistics count.
KINDS = ("text", "equation", "diagram", "photo")


def postprocess(docs: DataFrame, files: DataFrame, options: ConvertOptions = ConvertOptions(), log: list | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(docs, files, classes, counts): references rewritten by what their images are, unreferenced files dropped, a class per reference, statistics.

    Equations and texts become their recognised content, diagrams become vector files where the hook can draw them. A diagram
    like an earlier drawn one shares its file, whether it can be drawn itself or not. Without hooks all images stay as they are.
    Each distinct image is looked at once.
    """
    refs = im.references(docs).filter("rel_name is not null").join(docs.select("doc_id", "stem", "md"), "doc_id").join(offsets(docs), ["doc_id", "pos"])
    refs = refs.withColumn("labelled", preceded_by_equation_label(F.col("md"), F.col("start"))).drop("md")
    ocr, formula, draw = (hook("ocr") if options.ocr else None), hook("formula_model"), hook("vectorizer")
    regions = ocr(F.col("content")) if ocr else F.array().cast("array<struct<y:double,x:double,w:double,h:double,confidence:double,text:string>>")
    seen = files.withColumn("m", vision.image_metrics("content")).withColumn("regions", regions)
    covered = F.aggregate("regions", F.lit(0.0), lambda a, r: a + r["w"] * r["h"])
    confidence = F.aggregate("regions", F.lit(0.0), lambda a, r: a + r["confidence"]) / F.nullif(F.size("regions"), F.lit(0))
    text = vision.rows_text(vision.group_rows(F.col("regions")))
    score = vision.diagram_score(F.col("m.edge_density"), F.col("m.color_std"), F.col("m.color_uniqueness"))
    is_text = vision.is_text_image(F.size("regions"), covered, confidence, F.col("m.width") * F.col("m.height"), F.col("m.color_uniqueness"))
    kind = vision.classify(is_text, text, score, F.size("regions"), F.col("m.unique_colors"))
    seen = seen.select("doc_id", "name", "content", kind.alias("kind"), text.alias("text"), F.col("m.hash").alias("hash"), (formula(F.col("content")) if formula else F.lit(None).cast("string")).alias("formula"), (draw(F.col("content")) if draw else F.lit(None).cast("binary")).alias("svg"))
    rows = refs.join(seen.drop("content").withColumn("rel_name", F.col("name")), ["doc_id", "rel_name"])
    rows = stored(rows, "seen", log).withColumn("kind", F.when(F.col("labelled") & (F.length("formula") > 0), "equation").otherwise(F.col("kind")))
    diagrams = rows.filter(F.col("kind") == "diagram")
    first = diagrams.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "hash", "name", F.col("svg").isNotNull().alias("able")))).alias("d"))
    first = first.withColumn("canon", vision.first_match(F.transform("d", lambda x: x["hash"]), able=F.transform("d", lambda x: x["able"]))).select("doc_id", F.explode(F.arrays_zip("d", "canon")).alias("z")).filter("z.canon is not null")
    first = first.select("doc_id", F.col("z.d.pos").alias("pos"), F.col("z.canon").alias("canon"), F.col("z.d.name").alias("own"), (F.col("z.d.able") & (F.col("z.d.hash") == F.col("z.canon"))).alias("drawn"))
    owner = F.first(F.when(F.col("drawn"), F.col("own")), ignorenulls=True).over(Window.partitionBy("doc_id", "canon").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    rows = stored(rows.join(first.withColumn("shared", owner).select("doc_id", "pos", "shared"), ["doc_id", "pos"], "left"), "shared", log)
    svg_name = F.concat(F.regexp_replace("shared", r"\.[^.]+$", ""), F.lit(".svg"))
    new = F.when(F.col("kind") == "equation", wrap_latex(F.col("formula"))).when(F.col("kind") == "text", F.concat(F.lit("\n"), F.col("text"), F.lit("\n"))).when(F.col("shared").isNotNull(), reference(F.col("alt"), F.col("stem"), svg_name))
    out = im.rewrite_references(docs, rows.select("doc_id", "pos", new.alias("new"))).withColumn("md", drop_guid_lines(F.col("md")))
    vectors = rows.filter("shared is not null and rel_name = shared").select("doc_id", svg_name.alias("name"), F.col("svg").alias("content"), "pos").groupBy("doc_id", "name").agg(F.min_by("content", "pos").alias("content"))
    every = files.select("doc_id", "name", "content").unionByName(vectors)
    kept = every.join(im.references(out).select("doc_id", F.col("rel_name").alias("name")), ["doc_id", "name"], "left_semi")
    classes = rows.select("doc_id", "pos", "rel_name", "kind")
    counts = vision.class_counts(classes).groupBy("doc_id").agg(*(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(f"n_{k}") for k in KINDS))
    alike = rows.filter("shared is not null and rel_name <> shared").groupBy("doc_id").agg(F.count_distinct("rel_name").alias("visual_dedupe_files")).withColumn("visual_dedupe_refs", F.col("visual_dedupe_files"))
    gone = every.join(kept.select("doc_id", "name"), ["doc_id", "name"], "left_anti").groupBy("doc_id").agg(F.count("*").alias("gone"))
    counts = counts.join(alike, "doc_id", "full").join(gone, "doc_id", "full").na.fill(0)
    return out, kept, classes, counts.withColumn("unreferenced_files", F.col("gone") - F.col("visual_dedupe_files")).drop("gone")


def convert(docs: DataFrame, metadata: DataFrame | None = None, options: ConvertOptions = ConvertOptions()) -> Converted:
    """``docs`` is (doc_id, source_name, stem, md); ``metadata`` the extractor's (doc_id, pos, page, bbox, coord_system, meta_alt)."""
    log: list[str] = []
    images = stored(im.embedded_images(docs), "images", log)
    good = images.filter("occurrence is not null")
    if metadata is None:
        kind = "struct<l:double,t:double,r:double,b:double>"
        entries = good.withColumns({"page": F.lit(None).cast("int"), "bbox": F.lit(None).cast(kind), "coord_system": F.lit(None).cast("string"), "meta_alt": F.lit(None).cast("string")})
    else:
        entries = im.join_metadata(good, metadata)
    base = stored(im.split_images(docs.select("doc_id", "source_name", "stem", "md"), images), "split", log)
    named = good.select("doc_id", F.col("original_file").alias("name"), "sha256")
    deduped = im.dedupe_references(im.references(base), named)
    deduped = stored(deduped.join(base.select("doc_id", "stem"), "doc_id"), "deduped", log)
    contents = deduped.filter("rank = 1").select("doc_id", F.col("canonical").alias("name"), "sha256").join(good.dropDuplicates(["doc_id", "sha256"]).select("doc_id", "sha256", "content"), ["doc_id", "sha256"]).drop("sha256")
    width, height = im.image_dims(F.col("content"))
    # As the text will name them: files by their content, all else below the folder as it is. So the text is rewritten once.
    refs = deduped.withColumn("rel_name", F.coalesce("canonical", im.below_prefix(F.col("target"), F.col("stem"))))
    thin = stored(im.page_furniture(refs, contents.select("doc_id", "name", width.alias("width"), height.alias("height"))), "furniture", log)
    refs = refs.join(thin.select("doc_id", "rel_name", F.lit(True).alias("thin")), ["doc_id", "rel_name"], "left")
    new = F.when(F.col("thin"), F.lit("")).when(F.col("canonical").isNotNull(), reference(F.col("alt"), F.col("stem"), F.col("canonical")))
    slim = stored(im.rewrite_references(base, refs.select("doc_id", "pos", new.alias("new"))), "slim", log)
    dropped_refs = refs.filter("thin")
    files = contents.join(thin.select("doc_id", F.col("rel_name").alias("name")), ["doc_id", "name"], "left_anti")
    if options.postprocess:
        slim, files, _, counts = postprocess(slim, files, options, log)
    else:
        counts = docs.select("doc_id").limit(0)
    final, files = stored(text_pipeline(slim), "final", log), stored(files, "files", log)
    status = deduped.filter("canonical is not null").select("doc_id", F.col("rel_name").alias("original_file"), "canonical", F.col("status").alias("before"))
    entries = entries.join(status, ["doc_id", "original_file"], "left")
    ordered = entries.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("occurrence", "canonical"))), lambda x: x["canonical"]).alias("expected"))
    targets = below(final).filter("rel_name is not null").groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "rel_name"))), lambda x: x["rel_name"]).alias("targets"))
    aligned = ordered.join(targets, "doc_id", "left").select("doc_id", F.posexplode(im.align(F.col("expected"), F.coalesce("targets", F.array().cast("array<string>")))).alias("at", "final_file"))
    rows = entries.join(aligned.select("doc_id", (F.col("at") + 1).alias("occurrence"), "final_file"), ["doc_id", "occurrence"])
    rows = rows.join(files.select("doc_id", F.col("name").alias("final_file"), F.lit(True).alias("there")), ["doc_id", "final_file"], "left")
    rows = rows.select("doc_id", "occurrence", F.coalesce(alt_sanitize(F.col("meta_alt")), F.col("alt")).alias("alt"), "original_file", "final_file", im.final_status(F.col("final_file"), F.col("original_file"), F.col("before"), F.coalesce("there", F.lit(False))).alias("status"), "page", "bbox", "coord_system", F.col("sha256").alias("content_sha256"))
    stats = docs.select("doc_id").join(im.dedupe_stats(deduped), "doc_id", "left").join(dropped_refs.groupBy("doc_id").agg(F.count("*").alias("removed_refs"), F.count_distinct("rel_name").alias("removed_furniture")), "doc_id", "left").join(counts, "doc_id", "left")
    stats = stats.join(final.select("doc_id", (F.size(F.regexp_extract_all("md", F.lit(r"(?s)\$\$.+?\$\$"), F.lit(0)))).cast("long").alias("equations")), "doc_id", "left")
    return Converted(final.select("doc_id", "source_name", "stem", "md"), files, rows, stats.na.fill(0), log)


def below(docs: DataFrame) -> DataFrame:
    """``references`` with all that lies below ``<stem>.images/`` in scope."""
    return im.references(docs).join(docs.select("doc_id", "stem"), "doc_id").withColumn("rel_name", im.below_prefix(F.col("target"), F.col("stem"))).drop("stem")


def map_json(done: Converted) -> DataFrame:
    """(doc_id, image_map) of every document, also of those without images."""
    docs = done.documents.select("doc_id", F.col("source_name").alias("source"), F.concat("stem", F.lit(".md")).alias("markdown"), F.concat("stem", F.lit(".images")).alias("images_dir"))
    found = im.image_map(done.image_map.join(docs, "doc_id"))
    none = F.to_json(F.struct(F.lit(1).alias("version"), "source", "markdown", "images_dir", F.array().alias("entries")))
    return docs.join(found, "doc_id", "left").select("doc_id", F.coalesce("image_map", none).alias("image_map"))


def summary(stats: DataFrame) -> DataFrame:
    """Totals of the statistics over all documents."""
    return stats.agg(*(F.sum(c).alias(c) for c in stats.columns if c != "doc_id"))


def write(done: Converted, path: str, options: ConvertOptions = ConvertOptions()) -> None:
    """Four Parquet tables below ``path``; refuses to overwrite unless ``force``.

    They are written beside ``path`` and renamed together when whole, so readers never see old and new tables mixed. The
    conversion's intermediates are then deleted: ``done`` can be written once.
    """
    spark = done.documents.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    final, part = hadoop(path), f"{path.rstrip('/')}.{uuid.uuid4().hex}.part"
    files = final.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(final) and not options.force:
        raise FileExistsError(f"{path} exists; force overwrites it")
    done.documents.write.parquet(f"{part}/documents")
    done.files.write.parquet(f"{part}/files")
    map_json(done).write.parquet(f"{part}/image_map")
    done.stats.write.parquet(f"{part}/stats")
    old = hadoop(f"{part}.old")
    if files.exists(final) and not files.rename(final, old):
        raise OSError(f"cannot move {path} away")
    if not files.rename(hadoop(part), final):
        raise OSError(f"cannot rename {part}")
    files.delete(old, True)
    dropped(spark, done.paths)


def violations(done: Converted) -> DataFrame:
    """(doc_id, problem): outputs that break the invariants of a conversion; none is expected."""
    left = done.documents.filter(F.col("md").contains("data:image/png;base64,")).select("doc_id", F.lit("embedded image left").alias("problem"))
    odd = done.image_map.filter(~F.col("status").isin(*im.STATUSES)).select("doc_id", F.lit("unknown status").alias("problem"))
    refs = im.references(done.documents)
    dangling = im.missing_refs(refs, done.files).select("doc_id", F.lit("dangling reference").alias("problem"))
    orphans = im.orphan_files(done.files, refs.filter("rel_name is not null")).select("doc_id", F.lit("orphan file").alias("problem"))
    return left.unionByName(odd).unionByName(dangling).unionByName(orphans)
