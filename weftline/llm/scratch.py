"""Shared scratch tables, size-checked joins and other plumbing of the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with at least 1/HOT_SHARE of the rows is hot, so there are at most HOT_SHARE such keys.
HOT_SHARE = 1000


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the setting is absent and all runs in one process (local tests) a folder of this
    machine is made and set; on a cluster a missing setting is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="weftline-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Scratch:
    """Tables written to the shared folder, to cut lineage and to read a costly stage more than once.

    A result may read them whenever it is run, so they stay until ``clear`` is called.
    """

    made: list[str] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{scratch_dir(spark)}/weftline-{name}-{uuid.uuid4().hex}"
        Scratch.made.append(self.base)

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write df as a Parquet table and read it again."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        _delete(self.spark, self.path(name))


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear(spark: SparkSession, since: int = 0) -> None:
    """Delete the scratch tables made from the ``since``-th on; results that read them must have been written."""
    while len(Scratch.made) > since:
        _delete(spark, Scratch.made.pop())


#: Bytes of an Arrow batch that a Python worker gets at once, whatever the length of texts.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Python workers: batches by bytes rather than 10,000 rows of any length.

    Results are lazy, so the session's setting has to stay lowered until they have run.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, BATCH_BYTES)


#: Rows that Spark's Parquet reader holds at once where they have whole texts.
READ_ROWS = 256


def short_reads(spark: SparkSession) -> None:
    """Bound the memory of the Parquet reader: its 4096 rows of text are arrays of many megabytes, doubled as they grow.

    As with ``small_batches`` the session's setting has to stay lowered until the results have run.
    """
    name = "spark.sql.parquet.columnarReaderBatchSize"
    if int(spark.conf.get(name)) > READ_ROWS:
        spark.conf.set(name, READ_ROWS)


def unused(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, whatever case names are compared in."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_order(rows: DataFrame, key: str, *more: str) -> DataFrame:
    """Rows dealt and sorted so that partitions ascend by a long ``key``, nulls first; ties by ``more``.

    The bounds are quantiles of the key column alone, one per partition, so that the other
    columns are read once only (a range partitioning samples whole rows first).
    """
    from pyspark.ml.feature import Bucketizer

    n = parts(rows.sparkSession)
    found = rows.select(F.percentile_approx(key, F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array(F.lit(1.0)), 20 * n)).first()[0]
    bounds = sorted({float(x) for x in found or []})
    low = float("-inf")
    if bounds:
        at = Bucketizer(splits=[low, *bounds, float("inf")], inputCol="_x", outputCol="_slot")
        rows = at.transform(rows.withColumn("_x", F.coalesce(F.col(key).cast("double"), F.lit(low))))
        rows = rows.repartitionById(n, F.col("_slot").cast("int")).drop("_x", "_slot")
    return rows.sortWithinPartitions(key, *more)


def lookup(left: DataFrame, right: DataFrame, key: str, salt: Column, size: str, total: int) -> DataFrame:
    """Left join to one row per key where a key may hold a large share of left.

    ``right`` has unique keys and in ``size`` the number of left rows of each. Keys with at least
    1/HOT_SHARE of ``total`` rows number at most HOT_SHARE, so these alone are broadcast; the
    rows they match are dealt by ``salt`` (of the key's type) instead of the key. ``size`` stays.
    """
    cols = [c for c in right.columns if c != key]
    hot = F.col(size) >= max(2.0, total / HOT_SHARE)
    few = right.where(hot).select(F.col(key).alias("_hk"), F.struct(*cols).alias("_hot"))
    rest = right.where(~hot).select(F.col(key).alias("_ck"), F.struct(*cols).alias("_cold"))
    out = left.join(F.broadcast(few), F.col(key) == F.col("_hk"), "left").withColumn("_at", F.when(F.col("_hot").isNull(), F.col(key)).otherwise(salt))
    out = out.join(rest, F.col("_at") == F.col("_ck"), "left").withColumn("_row", F.coalesce("_hot", "_cold"))
    return out.select(*left.columns, *[F.col(f"_row.{c}").alias(c) for c in cols])
