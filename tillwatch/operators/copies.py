"""Rows that stand for several identical ones.

Two rules can raise the same alert many times. They carry the number in a `copies` column through
joins and aggregates, and only a reader who asks for every copy pays for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES = "copies"
BLOCK = 10_000


def repeat_rows(df: DataFrame, build: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Write out each row `copies` times and drop the column; `build` may add to the rows before they unfold.

    Rows of at most one block of copies unfold where they are. Others are cut into blocks, which are spread
    over the cluster before they unfold, so one row with a very large count is not unfolded by one task. Those
    are few, and what shuffles is one row per block.

    `df` is read twice, so it should be written down, or narrow; what `build` joins to it is read for the second
    part only if there are such rows, once Spark sees that (it plans again after each shuffle or broadcast).
    """
    few, many = F.col(COPIES) <= BLOCK, F.col(COPIES) > BLOCK
    return _unfolded(build(df.where(few))).unionByName(_unfolded(_in_blocks(build(df.where(many)))))


def _in_blocks(df: DataFrame) -> DataFrame:
    """A row for each block, dealt out with the copies of its block.

    The partition number is given explicitly because AQE would merge the blocks, which are tiny until they unfold.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [c for c in df.columns if c != COPIES]
    blocks = df.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({COPIES} - 1) div {BLOCK}"))))
    in_block = F.least(F.lit(BLOCK).cast("long"), F.col(COPIES) - F.col("block") * BLOCK)
    return blocks.withColumn(COPIES, in_block).repartition(partitions, F.xxhash64(*columns), "block").drop("block")


def _unfolded(df: DataFrame) -> DataFrame:
    columns = [c for c in df.columns if c != COPIES]
    return df.withColumn("_", F.explode(F.array_repeat(F.lit(1), F.col(COPIES).cast("int")))).select(*columns)
