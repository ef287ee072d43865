"""Converted documents as files: ``<stem>.md``, ``<stem>.images/``, ``<stem>.image-map.json`` and the sources' copies."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .convert import Converted, map_json


def write_files(rows: DataFrame, uri: str) -> int:
    """Write ``content`` (binary) of each of ``rows`` (name, content) to ``uri``/``name``, by the executors; returns how many.

    A file appears under its name when it is whole. Rows with a null name or content are left out.
    """

    def run(batches):
        fs, root = pafs.FileSystem.from_uri(uri)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                target = f"{root.rstrip('/')}/{name}"
                fs.create_dir(target.rpartition("/")[0], recursive=True)
                with fs.open_output_stream(f"{target}.part") as out:
                    out.write(content.as_buffer())
                fs.move(f"{target}.part", target)
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    good = rows.select("name", "content").filter("name is not null and content is not null")
    return good.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def export(done: Converted, uri: str, sources: DataFrame | None = None, force: bool = False) -> int:
    """Write all documents below ``uri``; returns how many files. ``sources`` is (source_name, content), copied under their names as they are.

    Refuses where one of the outputs exists, unless ``force``; then a document's old images go first.
    """
    fs, root = pafs.FileSystem.from_uri(uri)
    fs.create_dir(root, recursive=True)
    names = [F.concat("stem", F.lit(x)).alias(n) for n, x in (("md", ".md"), ("images", ".images"), ("map", ".image-map.json"))]

    def old(batches):
        fs, root = pafs.FileSystem.from_uri(uri)
        for batch in batches:
            found = [n for row in batch.to_pylist() for n in row.values() if fs.get_file_info(f"{root.rstrip('/')}/{n}").type != pafs.FileType.NotFound]
            for n in found if force else []:
                path = f"{root.rstrip('/')}/{n}"
                fs.delete_dir(path) if n.endswith(".images") else fs.delete_file(path)
            yield pa.RecordBatch.from_pydict({"name": pa.array(found, pa.string())})

    there = done.documents.select(*names).mapInArrow(old, "name string").agg(F.min("name")).first()[0]
    if there is not None and not force:
        raise FileExistsError(f"output exists (force overwrites it): {there}")
    stems = done.documents.select("doc_id", "stem")
    text = done.documents.select(F.concat("stem", F.lit(".md")).alias("name"), F.encode("md", "UTF-8").alias("content"))
    images = done.files.join(stems, "doc_id").select(F.concat("stem", F.lit(".images/"), "name").alias("name"), "content")
    maps = map_json(done).join(stems, "doc_id").select(F.concat("stem", F.lit(".image-map.json")).alias("name"), F.encode("image_map", "UTF-8").alias("content"))
    rows = text.unionByName(images).unionByName(maps)
    if sources is not None:
        rows = rows.unionByName(sources.select(F.col("source_name").alias("name"), "content"))
    return write_files(rows, uri)
