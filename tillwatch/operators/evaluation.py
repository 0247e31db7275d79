"""Scoring the flagged transactions against withheld labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.grading import ratio


def scored(truth: DataFrame, summary: DataFrame) -> DataFrame:
    """Each label, with whether any rule flagged its transaction."""
    flagged = summary.select("transaction_id").distinct().withColumn("hit", F.lit(True))
    return truth.join(flagged, "transaction_id", "left").select(
        "transaction_id",
        "is_fraud",
        "fraud_pattern",
        F.coalesce("hit", F.lit(False)).alias("was_flagged"),
    )


def _count(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def rule_evaluation(truth: DataFrame, summary: DataFrame, zero_for_undefined: bool = False) -> DataFrame:
    """Counts, recall and precision over all labels.

    Flagged transactions without a label do not count. Undefined rates are NULL, or 0 with
    `zero_for_undefined`; so are the sums when there are no labels at all.
    """
    fraud, flagged = F.col("is_fraud"), F.col("was_flagged")
    sums = {
        "total_actual_fraud": _count(fraud),
        "total_flagged": _count(flagged),
        "true_positives": _count(fraud & flagged),
        "false_positives": _count(~fraud & flagged),
        "false_negatives": _count(fraud & ~flagged),
    }

    def defined(value: Column, zero) -> Column:
        return F.coalesce(value, F.lit(zero)) if zero_for_undefined else value

    def rate(total: str) -> Column:
        return defined(F.round(ratio(F.col("true_positives"), F.col(total)), 4), 0.0)

    return (
        scored(truth, summary)
        .agg(F.count("*").alias("total_transactions"), *[defined(v, 0).alias(k) for k, v in sums.items()])
        .select("*", rate("total_actual_fraud").alias("recall"), rate("total_flagged").alias("precision"))
    )


def recall_by_pattern(truth: DataFrame, summary: DataFrame) -> DataFrame:
    """Recall per labelled pattern, over the fraudulent transactions."""
    return (
        scored(truth, summary)
        .where("is_fraud and fraud_pattern is not null")
        .groupBy("fraud_pattern")
        .agg(
            F.count("transaction_id").alias("actual"),
            _count(F.col("was_flagged")).alias("caught"),
        )
        .withColumn("recall", ratio(F.col("caught"), F.col("actual")))
    )
