"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed by the task: words are maximal runs of anything but these white-space bytes.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor shares (``spark.checkpoint.dir``).

    Where the session names none, a folder under /tmp serves a local master;
    on a cluster that is an error, because executors would not see each
    other's files.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = "/tmp/aislekit-checkpoints"
    spark.sparkContext.setCheckpointDir(path)
    return path


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Bound what one Arrow batch holds, so that long texts don't add up in a Python worker.

    Spark's own 10,000 rows a batch may be gigabytes of long documents.  Lower settings stay.
    """
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        key = f"spark.sql.execution.arrow.{name}"
        now = re.fullmatch(r"(-?\d+)b?", spark.conf.get(key))  # with a unit it was set on purpose
        if now and not 0 < int(now[1]) <= most:
            spark.conf.set(key, most)


class Scratch:
    """Intermediate tables in the shared folder; they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        small_batches(spark)
        self.root = f"{shared_dir(spark)}/aislekit-llm/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the written rows.

        The shuffle files of the write are deleted at its end: later steps read the rows.
        """
        key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(key)
        self.spark.conf.set(key, "true")
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        finally:
            self.spark.conf.set(key, before)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ascii_lower(c: Column | str) -> Column:
    """Lower-case A-Z only, as the word rule says (other letters keep their case)."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def words(c: Column | str, lower=ascii_lower) -> Column:
    """Words of a text as an array; null and blank texts give an empty array."""
    parts = F.split(lower(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))), SPACES)
    return F.array_remove(parts, "")


def frequency_class(freq: str, per_doubling: int = 8) -> Column:
    """Class of a count: 8 classes per factor of two, so a few hundred at most."""
    return F.floor(F.log2(freq) * per_doubling).cast("int")


def frequency_cut(counts: DataFrame, freq: str, most: int) -> int:
    """The lowest frequency class such that it and the classes above hold at most ``most`` rows."""
    cut, total = 1 << 20, 0
    for r in counts.groupBy(frequency_class(freq).alias("c")).count().orderBy(F.desc("c")).collect():
        total += r["count"]
        if total > most:
            break
        cut = r["c"]
    return cut


def gapless_rank(df: DataFrame, keys: list[str], order: list[str], rows: int, out: str,
                 rows_per_chunk: int = 20_000) -> DataFrame:
    """Number the rows of each ``keys`` group from 0 without gaps.

    A group may hold most of the table: rows are dealt into chunks by a hash
    of ``order``, numbered inside (group, chunk), and shifted by the running
    count of the chunks before.  Only counts meet in one place.  ``order``
    must tell rows apart for chunks to be even (add a row id).
    """
    n = max(1, -(-rows // rows_per_chunk))
    dealt = df.withColumn("__chunk", F.pmod(F.xxhash64(*order), F.lit(n)))
    inside = Window.partitionBy(*keys, "__chunk").orderBy(*order)
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = (dealt.groupBy(*keys, "__chunk").agg(F.count(F.lit(1)).alias("__n"))
              .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n"))
    return (dealt.withColumn("__i", F.row_number().over(inside) - 1)
            .join(counts, [*keys, "__chunk"])
            .withColumn(out, (F.col("__i") + F.col("__before")).cast("long"))
            .drop("__chunk", "__i", "__before"))
