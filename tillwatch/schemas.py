"""Declared schemas and enumerations. Nothing in this package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(14, 2)


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


AGENTS = _struct(
    ("agent_id", T.StringType()),
    ("agent_name", T.StringType()),
    ("region", T.StringType()),
    ("tier", T.StringType()),
    ("registration_date", T.DateType()),
    ("opening_cash_float", MONEY),
)

CUSTOMERS = _struct(
    ("customer_id", T.StringType()),
    ("kyc_tier", T.StringType()),
    ("home_region", T.StringType()),
    ("registration_date", T.DateType()),
)

# The feed calls the event time `timestamp`; tables call it `txn_timestamp`.
FEED_TRANSACTIONS = _struct(
    ("transaction_id", T.StringType()),
    ("timestamp", T.TimestampNTZType()),
    ("customer_id", T.StringType()),
    ("agent_id", T.StringType()),
    ("counterparty_customer_id", T.StringType()),
    ("txn_type", T.StringType()),
    ("amount", MONEY),
    ("region", T.StringType()),
)

GROUND_TRUTH = _struct(
    ("transaction_id", T.StringType()),
    ("is_fraud", T.BooleanType()),
    ("fraud_pattern", T.StringType()),
)

# Fixed values.
TXN_TYPES = ("cash_in", "cash_out", "p2p_transfer", "bill_pay", "airtime_topup")
CASH_TYPES = ("cash_in", "cash_out")
KYC_SINGLE_LIMITS = {"tier_1": 1_000, "tier_2": 10_000, "tier_3": 100_000}
SEVERITY_RANK = {"high": 2, "medium": 1}

# Columns the raw tables declare as mandatory.
REQUIRED = {
    "agents": ("agent_id", "agent_name", "region", "tier", "registration_date",
               "opening_cash_float", "loaded_at"),
    "customers": ("customer_id", "kyc_tier", "home_region", "registration_date", "loaded_at"),
    "transactions": ("transaction_id", "txn_timestamp", "customer_id", "txn_type", "amount",
                     "region", "loaded_at"),
    "fraud_ground_truth": ("transaction_id", "is_fraud"),
}
