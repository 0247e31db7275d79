"""The data-quality checks of all tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillwatch import schemas
from tillwatch.operators import quality
from tillwatch.operators.quality import Check
from tillwatch.plans.models import Models

KEYS = {
    "raw.agents": "agent_id",
    "raw.customers": "customer_id",
    "raw.transactions": "transaction_id",
    "eval.fraud_ground_truth": "transaction_id",
    "stg_agents": "agent_id",
    "stg_customers": "customer_id",
    "stg_transactions": "transaction_id",
    "dim_agents": "agent_id",
    "dim_customers": "customer_id",
    "fct_transactions": "transaction_id",
}
REQUIRED = {
    **{relation: (key,) for relation, key in KEYS.items()},
    "raw.agents": schemas.REQUIRED["agents"],
    "raw.customers": schemas.REQUIRED["customers"],
    "raw.transactions": schemas.REQUIRED["transactions"],
    "eval.fraud_ground_truth": schemas.REQUIRED["fraud_ground_truth"],
    "stg_transactions": ("transaction_id", "amount"),
}
ACCEPTED = {
    ("stg_customers", "kyc_tier"): tuple(schemas.KYC_SINGLE_LIMITS),
    ("stg_transactions", "txn_type"): schemas.TXN_TYPES,
}
# Columns of the raw transactions, and the raw table and key they refer to.
REFERENCES = {
    "customer_id": ("raw.customers", "customer_id"),
    "agent_id": ("raw.agents", "agent_id"),
    "counterparty_customer_id": ("raw.customers", "customer_id"),
}


def relations(models: Models) -> dict[str, DataFrame]:
    """The checked tables by name; the labels only where there are any."""
    tables = {
        "raw.agents": models.feed.agents,
        "raw.customers": models.feed.customers,
        "raw.transactions": models.feed.transactions,
        "eval.fraud_ground_truth": models.feed.ground_truth,
        "stg_agents": models.stg_agents,
        "stg_customers": models.stg_customers,
        "stg_transactions": models.stg_transactions,
        "dim_agents": models.dim_agents,
        "dim_customers": models.dim_customers,
        "fct_transactions": models.fct_transactions,
    }
    return {name: table for name, table in tables.items() if table is not None}


def _unique(tables) -> list[Check]:
    return [Check("unique", r, KEYS[r]) for r in tables]


def _references() -> list[Check]:
    return [Check("foreign_key", "raw.transactions", column, parent=parent) for column, parent in REFERENCES.items()]


def unique_report(models: Models) -> DataFrame:
    """Repeated keys per table."""
    tables = relations(models)
    return quality.counted_report(tables, _unique(tables))


def not_null_report(models: Models) -> DataFrame:
    """NULLs per mandatory column."""
    return quality.null_report({r: (df, REQUIRED[r]) for r, df in relations(models).items()})


def accepted_values_report(models: Models) -> DataFrame:
    """Rows outside the accepted values per column."""
    tables = relations(models)
    return quality.accepted_report({r: (tables[r], {c: values}) for (r, c), values in ACCEPTED.items()})


def foreign_key_report(models: Models) -> DataFrame:
    """Rows without a parent per referring column."""
    return quality.counted_report(relations(models), _references(), count_rows=True)


def violations(models: Models) -> DataFrame:
    """The offending values of every check, and the lines that could not be read."""
    tables, rejected = relations(models), getattr(models.feed, "rejected", None)
    found = quality.offences(
        tables,
        [
            *_unique(tables),
            *[Check("not_null", r, c) for r in tables for c in REQUIRED[r]],
            *[Check("accepted_values", r, c, accepted=values) for (r, c), values in ACCEPTED.items()],
            *_references(),
        ],
    )
    return found if rejected is None else found.unionByName(quality.malformed(rejected))
