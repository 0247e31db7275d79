"""Joins with a twist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = 1_024


def left_join_sparse(df: DataFrame, dimension: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Left join on a key that is NULL in many rows.

    A shuffle would send all NULL keys to one task. A second key, zero wherever the first is
    present, spreads them by a hash of another column; they match nothing either way.
    The dimension's zero is computed from its rows: Spark would fold a literal into a filter and
    shuffle by the first key alone.
    """
    zero = F.pmod(F.xxhash64(key), F.lit(1))
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(SPREAD)) + 1).otherwise(
        F.lit(0).cast("long")
    )
    return (
        df.withColumn("_spread", spread)
        .join(dimension.withColumn("_spread", zero), [key, "_spread"], "left")
        .drop("_spread")
    )
