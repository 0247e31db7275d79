"""Cleaning, typing and deduplication of the raw tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.functions.timekeys import utc_now


def _days_until(as_of: dt.date | None, since: str) -> Column:
    day = F.lit(as_of or utc_now().date())
    return F.datediff(day, F.col(since))


def stg_agents(agents: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return agents.select(
        "agent_id",
        "agent_name",
        F.trim("region").alias("region"),
        "tier",
        "registration_date",
        "opening_cash_float",
        _days_until(as_of, "registration_date").alias("agent_tenure_days"),
    )


def stg_customers(customers: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    return customers.select(
        "customer_id",
        "kyc_tier",
        F.trim("home_region").alias("home_region"),
        "registration_date",
        _days_until(as_of, "registration_date").alias("account_age_days"),
    )


def latest_copy(transactions: DataFrame) -> DataFrame:
    """The last loaded copy of each transaction.

    Spark turns `row_number() = 1` into a group limit on both sides of the exchange, so each map
    task sends one copy per id however often the feed repeated it. Copies loaded at the same
    instant are told apart by a hash of the whole row: every run, retry and branch of a plan keeps
    the same one, and only eight bytes of it travel.
    """
    newest_first = Window.partitionBy("transaction_id").orderBy(
        F.desc("loaded_at"), F.desc("row_hash")
    )
    return (
        transactions.withColumn("row_hash", F.xxhash64(*transactions.columns))
        .withColumn("copy", F.row_number().over(newest_first))
        .where("copy = 1")
        .drop("copy", "row_hash")
    )


def stg_transactions(transactions: DataFrame) -> DataFrame:
    return latest_copy(transactions).select(
        "transaction_id",
        "txn_timestamp",
        F.to_date("txn_timestamp").alias("txn_date"),
        F.hour("txn_timestamp").alias("txn_hour"),
        "customer_id",
        "agent_id",
        "counterparty_customer_id",
        "txn_type",
        "amount",
        "region",
    )
