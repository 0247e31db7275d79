"""Writing models down: tables, views, and results kept for the rest of a run."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACT_CLUSTER = ("customer_id", "agent_id")
ROWS_PER_FILE = 1_000_000


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_files(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_table(df: DataFrame, name: str) -> DataFrame:
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def rows_per_day(rows: DataFrame, count: str | None = None) -> DataFrame:
    """txn_date and its number of rows, or the sum of a `count` column over its rows."""
    return rows.groupBy("txn_date").agg((F.sum(count) if count else F.count("*")).alias("day_rows"))


def fact_layout(txns: DataFrame, days: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """The transactions dealt out as they are written: by day, and by customer within a day of several files.

    The rows of a day decide how many files it gets, so nothing is sampled and `txns` is computed once. The
    rows of a customer's day meet in one file, unless they are more than Spark wants in a partition: it splits
    such partitions, and merges small ones, once it sees their sizes.
    """
    files = days.select("txn_date", F.ceil(F.col("day_rows") / rows_per_file).alias("_files"))
    file = F.pmod(F.xxhash64("customer_id"), F.greatest(F.coalesce("_files", F.lit(1)), F.lit(1)))
    return (
        txns.join(files, "txn_date", "left")
        .withColumn("_file", file)
        .hint("rebalance", F.col("txn_date"), F.col("_file"))
        .sortWithinPartitions("txn_date", *FACT_CLUSTER)
        .select(*txns.columns)
    )


def write_fact(
    txns: DataFrame, path: str, days: DataFrame | None = None, rows_per_file: int = ROWS_PER_FILE
) -> DataFrame:
    """Store transactions in a folder per day, clustered by customer and agent.

    `days` is the number of rows of each day (`rows_per_day`), where it is known; else they are counted.
    """
    fact_layout(txns, rows_per_day(txns) if days is None else days, rows_per_file).write.mode("overwrite").partitionBy(
        "txn_date"
    ).parquet(path)
    return txns.sparkSession.read.schema(txns.schema).parquet(path).select(*txns.columns)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in its terms."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see, as named in spark.checkpoint.dir."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tillwatch-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


class Store:
    """Keeps intermediate results as Parquet in the shared folder.

    A kept result is computed once, survives lost executors, and is read with column pruning and
    a known size. The files go with `drop` or `clear`, or when the Spark application ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths = []

    def folder(self, name: str) -> str:
        """A new folder of the store."""
        folder = f"{shared_folder(self.spark).rstrip('/')}/tillwatch/{name}-{uuid.uuid4().hex}"
        system, path = file_system(self.spark, folder)
        system.deleteOnExit(path)
        self._paths.append((name, system, path))
        return folder

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        return as_files(df, self.folder(name))

    def drop(self, name: str, but: int = 0) -> None:
        """Delete what was kept under a name but for the last `but` results; nothing may read it any more."""
        named = [entry for entry in self._paths if entry[0] == name]
        for entry in named[: max(0, len(named) - but)]:
            self._paths.remove(entry)
            _, system, path = entry
            system.delete(path, True)

    def clear(self) -> None:
        """Delete everything kept so far; results that read it are no longer usable."""
        while self._paths:
            _, system, path = self._paths.pop()
            system.delete(path, True)
