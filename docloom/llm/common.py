"""What the operators of this subpackage share: the word pattern, the shared folder and written intermediate tables."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.plans.tables import shared_dir

#: A word: a run of anything but space and the ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: The characters between words, for translate().
BLANKS = " \t\n\x0b\x0c\r"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again: cuts the lineage, and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """As ``cut``, dealt by ``key`` into as many buckets as a shuffle has partitions: joins on it read the table as it lies, without an exchange."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    plain, first = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    adaptive = all(spark.conf.get(f"spark.sql.adaptive.{x}") == "true" for x in ("enabled", "coalescePartitions.enabled"))
    entry = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.format("parquet").bucketBy(int(first if first and adaptive else plain), key).option("path", path).saveAsTable(entry)
    written = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")  # only the catalog's entry: what has a path of its own keeps its files
    return written


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a written intermediate that no later plan reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def small(df: DataFrame, rows: int, known: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows; else as it is, so that the join shuffles and skewed partitions are split."""
    return F.broadcast(df) if (df.count() if known is None else known) <= rows else df


def shielded(*needed: str):
    """For an operator that returns ``docs``'s columns: columns that it does not name are renamed meanwhile, so none can clash with its own."""

    def wrap(change):
        @functools.wraps(change)
        def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
            names = {c: c if c in needed else f"other {i}" for i, c in enumerate(docs.columns)}
            out = change(docs.select(*(F.col(f"`{c}`").alias(x) for c, x in names.items())), *args, **kwargs)
            return out.select(*(F.col(f"`{x}`").alias(c) for c, x in names.items()))

        return run

    return wrap


def words(text: Column | str) -> Column:
    """The words of a text, null or empty texts have none."""
    return F.regexp_extract_all(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(WORD), F.lit(0))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Give freed memory back to the system."""
    import ctypes
    import gc

    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only glibc has it
        pass


def trimmed(run):
    """``run`` for mapInArrow, giving memory back when its task ends: workers live on, and their memory counts as the executor's."""

    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidy


def small_batches(spark: SparkSession, size: str = "8m", rows: str = "2000") -> None:
    """Arrow batches of texts of at most so many bytes and rows, for bounded workers."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
