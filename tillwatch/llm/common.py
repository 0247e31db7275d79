"""Small helpers shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 10_000


ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose machines don't have it there, ship it with --py-files.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A null text counts as an empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def unused(name: str, columns: list[str]) -> str:
    """`name`, with as many underscores before it as keep it apart from `columns` (names ignore case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered_copies(df: DataFrame, count: str, number: str) -> DataFrame:
    """Each row as often as its column `count` says, numbered from 0 in `number`.

    Rows that occur very often are cut into blocks, which are spread before they unfold.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest, block = [c for c in df.columns if c != count], unused("_block", df.columns)
    blocks = df.withColumn(block, F.explode(F.expr(f"sequence(0L, (`{count}` - 1) div {BLOCK})")))
    spread = blocks.repartition(partitions, F.xxhash64(*rest), block)
    first = F.col(block) * BLOCK
    last = F.least(F.col(count).cast("long"), first + BLOCK) - 1
    return spread.select(*rest, F.explode(F.sequence(first, last)).alias(number))


def map_arrow(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    importable(df.sparkSession)
    return df.mapInArrow(run, schema)


def arrow_rows(
    make: Callable[[pa.RecordBatch], Iterator[tuple] | list[tuple]], schema: pa.Schema
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A `mapInArrow` function from one that turns a batch into rows; it emits as it goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(make(batch))
            columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    return run
