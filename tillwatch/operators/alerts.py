"""The alert queue, and its summary per transaction."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.grading import severity_name, severity_rank
from tillwatch.functions.timekeys import utc_now
from tillwatch.operators.copies import COPIES, repeat_rows

ALERT = ["transaction_id", "customer_id", "txn_timestamp", "fraud_pattern", "severity"]


def all_flags(*flags: DataFrame) -> DataFrame:
    """Union of rule outputs on their common columns, with the number of copies of each."""
    once = F.lit(1).cast("long").alias(COPIES)
    return reduce(
        DataFrame.unionByName,
        [one.select(*ALERT, F.col(COPIES) if COPIES in one.columns else once) for one in flags],
    )


def combined_flags(*flags: DataFrame) -> DataFrame:
    """Union of rule outputs with their metrics, one row per copy."""
    columns = ["transaction_id", "fraud_pattern", "severity", F.col("rule_metric").cast("double").alias("rule_metric")]
    every = [repeat_rows(one) if COPIES in one.columns else one for one in flags]
    return reduce(DataFrame.unionByName, [one.select(*columns) for one in every])


def one_per_rule(flags: DataFrame) -> DataFrame:
    """One row per transaction and rule, with the worst severity."""
    keys = [c for c in ALERT if c != "severity"]
    return (
        flags.groupBy(*keys)
        .agg(F.max(severity_rank(F.col("severity"))).alias("rank"))
        .select(*keys, severity_name(F.col("rank")).alias("severity"), F.lit(1).cast("long").alias(COPIES))
    )


def fraud_alerts(
    flags: DataFrame,
    txns: DataFrame,
    customers: DataFrame,
    alert_created_at: dt.datetime | None = None,
    dedupe: bool = False,
    every_copy: bool = True,
) -> DataFrame:
    """Flags with the transaction and customer they concern, open for review."""
    if dedupe:
        flags = one_per_rule(flags)
    created = F.lit((alert_created_at or utc_now()).isoformat(sep=" ")).cast("timestamp_ntz")
    about = txns.select("transaction_id", "txn_type", "amount", "region", "agent_id")
    who = customers.select("customer_id", "kyc_tier", "account_age_days")

    def enriched(flags: DataFrame) -> DataFrame:
        return (
            flags.join(about, "transaction_id")
            .join(who, "customer_id")
            .select(
                *ALERT,
                "txn_type",
                "amount",
                "region",
                "agent_id",
                "kyc_tier",
                "account_age_days",
                F.lit("open").alias("review_status"),
                created.alias("alert_created_at"),
                COPIES,
            )
        )

    return repeat_rows(flags, enriched) if every_copy else enriched(flags)


def per_transaction(flags: DataFrame) -> DataFrame:
    """One row per flagged transaction: customer, time, the rules it tripped, the worst severity."""
    return (
        flags.groupBy("transaction_id", "customer_id", "txn_timestamp")
        .agg(
            F.sort_array(F.collect_set("fraud_pattern")).alias("patterns"),
            F.max(severity_rank(F.col("severity"))).alias("max_severity_rank"),
        )
        .withColumn("rules_tripped", F.size("patterns").cast("long"))
        .withColumn("fraud_patterns", F.concat_ws(", ", "patterns"))
        .drop("patterns")
    )


def alert_summary(flags: DataFrame, txns: DataFrame, customers: DataFrame) -> DataFrame:
    """What `fraud_alert_summary` makes of the alerts, straight from the flags.

    The flags are collapsed before the joins: fewer and narrower rows are joined, and as nothing
    aggregates behind the join with the customers, Spark can split a busy one.
    """
    about = txns.select("transaction_id", "txn_type", "amount", "region")
    who = customers.select("customer_id", "kyc_tier")
    return (
        per_transaction(flags)
        .join(about, "transaction_id")
        .join(who, "customer_id")
        .select(
            "transaction_id", "customer_id", "txn_timestamp", "txn_type", "amount", "region", "kyc_tier",
            "rules_tripped", "fraud_patterns", "max_severity_rank",
            severity_name(F.col("max_severity_rank")).alias("max_severity"),
            F.lit("open").alias("review_status"),
        )
    )


def analyst_summary(flags: DataFrame, txns: DataFrame) -> DataFrame:
    """The analyst's summary: flags keep their row even if their transaction or customer is missing."""
    about = txns.select("transaction_id", "txn_type", "amount", "region")
    return (
        per_transaction(flags)
        .join(about, "transaction_id", "left")
        .select(
            "transaction_id", "txn_timestamp", "customer_id", "txn_type", "amount", "region",
            "rules_tripped", "fraud_patterns",
        )
    )


def fraud_alert_summary(alerts: DataFrame) -> DataFrame:
    """One row per flagged transaction. Takes alerts with or without their copies written out.

    In no order: a table this large is sorted by whoever reads the top of it.
    """
    return (
        alerts.groupBy("transaction_id", "customer_id", "txn_timestamp", "txn_type", "amount", "region", "kyc_tier")
        .agg(
            # At most one entry per rule.
            F.sort_array(F.collect_set("fraud_pattern")).alias("patterns"),
            F.max(severity_rank(F.col("severity"))).alias("max_severity_rank"),
            F.min("review_status").alias("review_status"),
        )
        .select(
            "transaction_id",
            "customer_id",
            "txn_timestamp",
            "txn_type",
            "amount",
            "region",
            "kyc_tier",
            F.size("patterns").cast("long").alias("rules_tripped"),
            F.concat_ws(", ", "patterns").alias("fraud_patterns"),
            "max_severity_rank",
            severity_name(F.col("max_severity_rank")).alias("max_severity"),
            "review_status",
        )
    )
