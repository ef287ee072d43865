"""Size-tiered compaction of immutable Parquet shards under a versioned manifest.

``append`` writes an arrival as small shards and commits a manifest that adds them. ``compact`` looks at the shards below the
target size: those of one tier (sizes within ``FAN`` times of each other) are merged, in runs of up to the target size, once
a tier holds ``FAN`` of them. A merge is a task that streams its shards into one new file in row groups of ``GROUP_BYTES``, so
nothing is shuffled and memory is that of a row group.

New files appear under their final names when whole. A manifest is written whole beside the others and committed by one
rename that fails if another writer took the version: a writer that dies before leaves nothing in the way, and of two writers
one gets an error and may try again on the new version. Readers take the latest version; older ones stay readable until
``vacuum``, which spares the last ``keep`` versions' shards and all files younger than ``age`` seconds, so it neither disturbs
readers nor takes the files of an append that is not committed yet.

Defined results: rows are kept as they are, nulls, repeats and all columns; an empty arrival commits a version without
shards; a shard above the target is never rewritten; shards of equal size are merged in order of name; compaction without
work commits nothing; arrivals of other columns than the first are an error; so are rows whose arrival is null or out of
range, before anything is written.
"""

from __future__ import annotations

import json
import math
import os
import time
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a finished shard; shards of a tier that are merged at least, and how far sizes of a tier are apart; rows read at a time; bytes in memory of a row group.
TARGET, FAN, ROWS, GROUP_BYTES = 128 << 20, 4, 2000, 64 << 20
#: Versions whose shards a vacuum keeps, and the least age in seconds of what it deletes.
KEEP, AGE = 10, 7 * 24 * 3600


class ShardStore:
    def __init__(self, spark: SparkSession, uri: str, target: int = TARGET, fan: int = FAN):
        self.spark, self.uri, self.target, self.fan = spark, uri.rstrip("/"), target, fan
        self.fs, self.path = pafs.FileSystem.from_uri(self.uri)
        for name in ("data", "manifest"):
            self.fs.create_dir(f"{self.path}/{name}", recursive=True)

    # Manifests
    def versions(self) -> list[int]:
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.path}/manifest"))
        return sorted(int(x.base_name[1:-5]) for x in found if x.base_name.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """{version, schema, shards: [{name, bytes, rows}]}; version 0 is empty."""
        known = self.versions()
        if version is None:
            version = known[-1] if known else 0
        if version == 0:
            return {"version": 0, "schema": None, "shards": []}
        with self.fs.open_input_stream(f"{self.path}/manifest/v{version:010d}.json") as f:
            return json.loads(f.read())

    def commit(self, base: dict, shards: list[dict], schema: str | None) -> int:
        """Commit the version after ``base``; fails if another writer took it."""
        version = base["version"] + 1
        name, part = f"manifest/v{version:010d}.json", f"manifest/{uuid.uuid4().hex}.part"
        with self.fs.open_output_stream(f"{self.path}/{part}") as f:
            f.write(json.dumps({"version": version, "schema": schema, "shards": shards}).encode())
        try:
            self._rename_new(part, name)
        except Exception as e:
            self.fs.delete_file(f"{self.path}/{part}")
            if version in self.versions():
                raise RuntimeError(f"version {version} was committed by another writer") from e
            raise
        return version

    def _rename_new(self, old: str, new: str) -> None:
        """One step that gives the file its name, or fails if there is one of that name."""
        if isinstance(self.fs, pafs.LocalFileSystem):
            os.link(f"{self.path}/{old}", f"{self.path}/{new}")
            os.unlink(f"{self.path}/{old}")
            return
        hadoop, gateway = self.spark._jvm.org.apache.hadoop.fs, self.spark.sparkContext._gateway
        old, new = (hadoop.Path(f"{self.uri}/{x}") for x in (old, new))
        hadoop.FileContext.getFileContext(old.toUri(), self.spark._jsc.hadoopConfiguration()).rename(old, new, gateway.new_array(hadoop.Options.Rename, 0))

    # Shards
    def append(self, rows: DataFrame) -> int:
        """Add the rows as new shards, one for each task that has some."""
        base = self.manifest()
        schema = rows.schema.json()
        if base["schema"] not in (None, schema):
            raise ValueError("the arrival has other columns than the store")
        run = f"data/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.uri}/{run}")
        found = [x for x in self.fs.get_file_info(pafs.FileSelector(f"{self.path}/{run}")) if x.base_name.endswith(".parquet")]
        shards = [{"name": f"{run}/{x.base_name}", "bytes": x.size} for x in sorted(found, key=lambda x: x.base_name)]
        return self.commit(base, base["shards"] + shards, schema)

    def tier(self, size: int) -> int:
        return int(math.log(max(size, 1), self.fan))

    def plan(self, shards: list[dict]) -> list[list[dict]]:
        """Runs to merge: of each tier with enough shards, in order of size, cut at the target."""
        tiers: dict[int, list[dict]] = {}
        for x in shards:
            if x["bytes"] < self.target // 2:
                tiers.setdefault(self.tier(x["bytes"]), []).append(x)
        out = []
        for _, members in sorted(tiers.items()):
            if len(members) < self.fan:
                continue
            run: list[dict] = []
            for x in sorted(members, key=lambda x: (x["bytes"], x["name"])):
                if run and sum(y["bytes"] for y in run) + x["bytes"] > self.target:
                    out.append(run)
                    run = []
                run.append(x)
            out.append(run)
        return [run for run in out if len(run) > 1]

    def compact(self) -> int | None:
        """Merge one round of runs and commit; None if there is nothing to merge."""
        base = self.manifest()
        runs = self.plan(base["shards"])
        if not runs:
            return None
        uri, folder, group_bytes = self.uri, f"data/{uuid.uuid4().hex}", GROUP_BYTES
        self.fs.create_dir(f"{self.path}/{folder}", recursive=True)

        def merge(batches):
            fs, path = pafs.FileSystem.from_uri(uri)
            for batch in batches:
                for number, names in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    name = f"{folder}/merged-{number:06d}.parquet"
                    part = f"{path}/{name}.{uuid.uuid4().hex}.part"
                    with fs.open_output_stream(part) as out:
                        writer, held, size = None, [], 0
                        for x in names:
                            with fs.open_input_file(f"{path}/{x}") as f:
                                for piece in pq.ParquetFile(f).iter_batches(ROWS):
                                    writer = writer or pq.ParquetWriter(out, piece.schema, compression="snappy", use_deprecated_int96_timestamps=True)
                                    held, size = [*held, piece], size + piece.nbytes
                                    if size >= group_bytes:
                                        writer.write_table(pa.Table.from_batches(held), row_group_size=sum(map(len, held)))
                                        held, size = [], 0
                        if held:
                            writer.write_table(pa.Table.from_batches(held), row_group_size=sum(map(len, held)))
                        if writer:
                            writer.close()
                    fs.move(part, f"{path}/{name}")
                    yield pa.RecordBatch.from_pydict({"number": pa.array([number], pa.int64()), "name": [name], "bytes": pa.array([fs.get_file_info(f"{path}/{name}").size], pa.int64())})

        work = self.spark.createDataFrame([(i, [x["name"] for x in run]) for i, run in enumerate(runs)], "number long, names array<string>").repartition(len(runs))
        made = work.mapInArrow(merge, "number long, name string, bytes long").collect()  # a row for each merged file
        gone = {x["name"] for run in runs for x in run}
        shards = [x for x in base["shards"] if x["name"] not in gone] + [{"name": r["name"], "bytes": r["bytes"]} for r in sorted(made, key=lambda r: r["number"])]
        return self.commit(base, shards, base["schema"])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the latest by default."""
        from pyspark.sql.types import StructType

        found = self.manifest(version)
        if found["schema"] is None:
            raise ValueError("the store is empty")
        schema = StructType.fromJson(json.loads(found["schema"]))
        if not found["shards"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.uri}/{x['name']}" for x in found["shards"]))

    def vacuum(self, keep: int = KEEP, age: float = AGE) -> int:
        """Delete files older than ``age`` seconds that none of the last ``keep`` versions names, and the manifests before those; returns how many shards."""
        versions, before, n = self.versions(), time.time() - age, 0
        kept = {x["name"] for v in versions[-max(1, keep) :] for x in self.manifest(v)["shards"]}
        for v in versions[: -max(1, keep)]:
            name = f"{self.path}/manifest/v{v:010d}.json"
            if self.fs.get_file_info(name).mtime.timestamp() <= before:
                self.fs.delete_file(name)
        for x in self.fs.get_file_info(pafs.FileSelector(f"{self.path}/data", recursive=True)):
            name = x.path.removeprefix(f"{self.path}/")
            if x.type == pafs.FileType.File and name not in kept and x.mtime.timestamp() <= before:
                self.fs.delete_file(x.path)
                n += name.endswith(".parquet")
        return n


def compacted(rows: DataFrame, uri: str, arrival, arrivals: int, target: int = TARGET, fan: int = FAN) -> ShardStore:
    """Append ``rows`` in ``arrivals`` parts by the number that column ``arrival`` holds, compacting after each. What merges replace stays for a ``vacuum``."""
    store = ShardStore(rows.sparkSession, uri, target, fan)
    if not rows.filter(~F.coalesce(arrival.between(0, arrivals - 1), F.lit(False))).isEmpty():
        raise ValueError(f"rows whose arrival is not one of 0 to {arrivals - 1}")
    for k in range(arrivals):
        store.append(rows.filter(arrival == k))
        while store.compact():
            pass
    return store
