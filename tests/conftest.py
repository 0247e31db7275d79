from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # A zone with daylight saving: nothing may depend on the session's zone.
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.codegen.cache.maxEntries", "5000")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


STAGED = (
    "transaction_id string, txn_timestamp timestamp_ntz, customer_id string, agent_id string, "
    "counterparty_customer_id string, txn_type string, amount decimal(14,2), region string"
)


def at(text: str) -> dt.datetime:
    """'10:20:00', '3 10:20:00' (day of January) or a full timestamp."""
    if "-" in text:
        return dt.datetime.fromisoformat(text)
    day, clock = text.split() if " " in text else ("1", text)
    return dt.datetime.fromisoformat(f"2026-01-{int(day):02d} {clock}")


class Transactions:
    """Collects hand-made staged transactions."""

    def __init__(self, spark):
        self.spark = spark
        self.rows = []

    def add(self, txn, when, customer, type_="cash_in", amount="10.00", region="R1", agent="AGT00000", to=None):
        when = at(when) if isinstance(when, str) else when
        self.rows.append((txn, when, customer, agent, to, type_, None if amount is None else Decimal(amount), region))
        return self

    def frame(self):
        df = self.spark.createDataFrame(self.rows, STAGED)
        return df.withColumn("txn_date", F.to_date("txn_timestamp")).withColumn("txn_hour", F.hour("txn_timestamp"))


@pytest.fixture
def txns(spark):
    return Transactions(spark)


@pytest.fixture
def customers(spark):
    def build(*pairs):
        return spark.createDataFrame(
            [(c, tier, "R1", dt.date(2025, 1, 1), 396) for c, tier in pairs],
            "customer_id string, kyc_tier string, home_region string, registration_date date, account_age_days int",
        )

    return build


@pytest.fixture
def agents(spark):
    def build(*triples):
        return spark.createDataFrame(
            [(a, f"Agent {a}", r, t, dt.date(2025, 1, 1), Decimal("100.00"), 396) for a, r, t in triples],
            "agent_id string, agent_name string, region string, tier string, registration_date date, "
            "opening_cash_float decimal(14,2), agent_tenure_days int",
        )

    return build


def rows(df, *columns):
    """Sorted tuples of the given columns (all if none)."""
    selected = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in selected.collect()), key=repr)
