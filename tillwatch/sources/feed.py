"""The feed as files: CSV in, typed tables out."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillwatch import schemas
from tillwatch.functions.timekeys import utc_now


@dataclass(frozen=True)
class Feed:
    """The raw tables. Labels are withheld from a production feed, so they may be missing.

    `rejected` has the lines that could not be read (relation, file, line), where they were set aside.
    """

    agents: DataFrame
    customers: DataFrame
    transactions: DataFrame
    ground_truth: DataFrame | None = None
    rejected: DataFrame | None = None


#: Columns of a table read with `set_aside`: the text of a line that does not fit, else NULL, and its file.
BAD_LINE, BAD_FILE = "_bad_line", "_bad_file"


def _read_csv(spark: SparkSession, path: str, schema: StructType, set_aside: bool = False) -> DataFrame:
    """A CSV file as a table. A line that does not fit the schema ends the run, or is set aside."""
    # enforceSchema=False compares the file's header with the schema instead of ignoring it.
    options = {"header": True, "enforceSchema": False}
    if not set_aside:
        return spark.read.schema(schema).csv(path, mode="FAILFAST", **options)
    lines = spark.read.schema(StructType([*schema.fields, StructField(BAD_LINE, StringType())])).csv(
        path, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE, **options
    )
    return lines.withColumn(BAD_FILE, F.when(F.col(BAD_LINE).isNotNull(), F.col("_metadata.file_path")))


def without_bad_lines(rows: DataFrame, relation: str) -> tuple[DataFrame, DataFrame]:
    """A table read with `set_aside`, once it is written down, as (its rows, the rejected lines)."""
    rejected = rows.where(F.col(BAD_LINE).isNotNull()).select(
        F.lit(relation).alias("relation"), F.col(BAD_FILE).alias("file"), F.col(BAD_LINE).alias("line")
    )
    return rows.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE, BAD_FILE), rejected


def stamp_load_time(df: DataFrame, loaded_at: dt.datetime | None = None) -> DataFrame:
    """Add loaded_at, which the feed does not carry; by default the time in UTC, taken now."""
    stamp = (loaded_at or utc_now()).isoformat(sep=" ")
    return df.withColumn("loaded_at", F.lit(stamp).cast("timestamp_ntz"))


def read_agents(
    spark: SparkSession, path: str, loaded_at: dt.datetime | None = None, set_aside: bool = False
) -> DataFrame:
    return stamp_load_time(_read_csv(spark, path, schemas.AGENTS, set_aside), loaded_at)


def read_customers(
    spark: SparkSession, path: str, loaded_at: dt.datetime | None = None, set_aside: bool = False
) -> DataFrame:
    return stamp_load_time(_read_csv(spark, path, schemas.CUSTOMERS, set_aside), loaded_at)


def read_transactions(
    spark: SparkSession,
    path: str,
    loaded_at: dt.datetime | None = None,
    partitions: int | None = None,
    set_aside: bool = False,
) -> DataFrame:
    """Read the transaction feed.

    One gzip file is one task. `partitions` deals its rows out evenly afterwards; by rows and not
    by customer, because one customer may own much of the file.
    """
    rows = _read_csv(spark, path, schemas.FEED_TRANSACTIONS, set_aside)
    if partitions:
        rows = rows.repartition(partitions)
    return stamp_load_time(rows.withColumnRenamed("timestamp", "txn_timestamp"), loaded_at)


def read_ground_truth(spark: SparkSession, path: str, set_aside: bool = False) -> DataFrame | None:
    """Read the labels, or None where there are none."""
    try:
        return _read_csv(spark, path, schemas.GROUND_TRUTH, set_aside)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def split_labels(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A labelled feed as (feed without labels, labels by transaction)."""
    labels = [f.name for f in schemas.GROUND_TRUTH.fields]
    hidden = [c for c in labels if c != "transaction_id"]
    return labelled.drop(*hidden), labelled.select(*labels)


def in_time_order(df: DataFrame, ts: str = "txn_timestamp") -> DataFrame:
    """By time and id; deliveries of one id by load time and a hash of the row."""
    last = [F.col("loaded_at")] if "loaded_at" in df.columns else []
    return df.orderBy(ts, "transaction_id", *last, F.xxhash64(*df.columns))
