"""Dimensions, the fact table, and daily aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.functions.grading import ratio
from tillwatch.operators.joins import left_join_sparse
from tillwatch.operators.rules import cash_ratio, cash_sum, imbalance_severity
from tillwatch.params import AgentImbalance
from tillwatch.schemas import CASH_TYPES


def dim_agents(stg_agents: DataFrame) -> DataFrame:
    return stg_agents.select(
        "agent_id", "agent_name", "region", "tier", "registration_date", "opening_cash_float", "agent_tenure_days"
    )


def dim_customers(stg_customers: DataFrame) -> DataFrame:
    return stg_customers.select("customer_id", "kyc_tier", "home_region", "registration_date", "account_age_days")


def fct_transactions(txns: DataFrame, customers: DataFrame, agents: DataFrame) -> DataFrame:
    """Transactions with their customer's and agent's attributes.

    The dimensions are broadcast if Spark finds them small enough, and else joined by shuffles,
    where most transactions have no agent.
    """
    who = customers.select("customer_id", "kyc_tier", "account_age_days")
    agent = agents.select("agent_id", F.col("tier").alias("agent_tier"))
    return (
        left_join_sparse(txns.join(who, "customer_id", "left"), agent, "agent_id", "transaction_id")
        .select(
            "transaction_id",
            "txn_timestamp",
            "txn_date",
            "txn_hour",
            "txn_type",
            "amount",
            "region",
            "customer_id",
            "kyc_tier",
            "account_age_days",
            "agent_id",
            "agent_tier",
            "counterparty_customer_id",
        )
    )


def agent_daily_health(txns: DataFrame, agents: DataFrame, rule: AgentImbalance = AgentImbalance()) -> DataFrame:
    """Agent-days with cash flow, customers served and the imbalance grade.

    The imbalance rule sums the same cash amounts over the same agent-days, so its grade is read
    off these sums: one aggregation, and no join with the rule's output.
    """
    daily = (
        txns.where(F.col("agent_id").isNotNull())
        .groupBy("agent_id", "txn_date")
        .agg(
            cash_sum("cash_in").alias("cash_in_amount"),
            cash_sum("cash_out").alias("cash_out_amount"),
            F.count("*").alias("total_txns"),
            F.countDistinct("customer_id").alias("unique_customers_served"),
            # Agent-days without any cash transaction are not graded.
            F.count_if(F.col("txn_type").isin(*CASH_TYPES)).alias("cash_txns"),
        )
    )
    grade = F.when(F.col("cash_txns") > 0, imbalance_severity(rule))
    return daily.join(agents.select("agent_id", "region", "tier"), "agent_id").select(
        "agent_id",
        "region",
        "tier",
        "txn_date",
        "cash_in_amount",
        "cash_out_amount",
        "total_txns",
        "unique_customers_served",
        F.round(cash_ratio(), 2).alias("cash_out_to_in_ratio"),
        F.coalesce(grade, F.lit("none")).alias("imbalance_flag"),
    )


def transaction_velocity_daily(txns: DataFrame) -> DataFrame:
    total, count = F.sum("amount"), F.count("amount")
    return txns.groupBy("txn_date", "region", "txn_type").agg(
        F.count("*").alias("txn_count"),
        total.alias("total_amount"),
        # avg() would round once to six digits and then again.
        F.round(ratio(total, count.cast("decimal(20,0)")), 2).alias("avg_amount"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )
