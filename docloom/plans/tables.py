"""Written intermediate tables: they cut the lineage of long plans and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where it is unset, a temporary one in local mode, as in tests, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="docloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stored(df: DataFrame, name: str, log: list[str] | None = None) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read again. Its path is added to ``log``."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if log is not None:
        log.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, paths: list[str]) -> None:
    """Delete written tables that no later plan reads, and forget them."""
    while paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
