"""The small datasets an analyst looks at."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.grading import ratio
from tillwatch.operators.copies import COPIES


def headline_kpis(txns: DataFrame, summary: DataFrame, agent_day_flags: DataFrame) -> DataFrame:
    """One row: transactions, flagged transactions, their share, agent-day alerts."""
    flagged = summary.agg(F.countDistinct("transaction_id")).scalar()
    agent_days = agent_day_flags.agg(F.count("*")).scalar()
    return (
        txns.agg(F.count("*").alias("total_transactions"))
        .select("total_transactions", flagged.alias("flagged_transactions"), agent_days.alias("agent_imbalance_alerts"))
        .withColumn("flag_rate", ratio(F.col("flagged_transactions"), F.col("total_transactions")))
    )


def alert_queue(summary: DataFrame, rows: int = 200) -> DataFrame:
    """The top of the review queue: most rules first, then the worst severity where the summary has it."""
    worst = [F.desc("max_severity_rank")] if "max_severity_rank" in summary.columns else []
    return (
        summary.orderBy(F.desc("rules_tripped"), *worst, "transaction_id")
        .limit(rows)
        .select(
            "transaction_id", "txn_timestamp", "customer_id", "txn_type", "amount", "region",
            "rules_tripped", "fraud_patterns",
        )
    )


def alerts_by_rule(flags: DataFrame) -> DataFrame:
    """Alerts per rule; copies that are not written out count in full."""
    count = F.sum(COPIES) if COPIES in flags.columns else F.count("*")
    return flags.groupBy("fraud_pattern").agg(count.alias("alert_count")).orderBy(
        F.desc("alert_count"), "fraud_pattern"
    )


def daily_volume_by_type(txns: DataFrame) -> DataFrame:
    return txns.groupBy("txn_date", "txn_type").agg(F.count("*").alias("txn_count"))


def value_by_region(txns: DataFrame) -> DataFrame:
    return txns.groupBy("region").agg(F.sum("amount").alias("total_amount")).orderBy(
        F.desc("total_amount"), "region"
    )


def imbalance_list(pivot_flags: DataFrame) -> DataFrame:
    """Imbalanced agent-days, worst ratio first, those without cash-in last."""
    return pivot_flags.orderBy(F.desc_nulls_last("ratio"), "agent_id", "txn_date")


def busiest_agents(txns: DataFrame, rows: int = 20) -> DataFrame:
    return (
        txns.where(F.col("agent_id").isNotNull())
        .groupBy("agent_id")
        .agg(F.count("*").alias("txn_count"))
        .orderBy(F.desc("txn_count"), "agent_id")
        .limit(rows)
    )


def validation_metrics(evaluation: DataFrame) -> DataFrame:
    return evaluation.select("recall", "precision", "false_positives")
