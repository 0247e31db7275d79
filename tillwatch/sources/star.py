"""The feed, derived from a star schema of suppliers, customers and events.

Suppliers play the agents, customers the wallet holders and events the transactions.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.functions.grading import single_limit
from tillwatch.operators.copies import COPIES
from tillwatch.operators.joins import left_join_sparse
from tillwatch.schemas import GROUND_TRUTH, MONEY
from tillwatch.sources.feed import split_labels
from tillwatch.sources.store import Store

# Fixed values.
FIRST_DAY = "2024-01-01"
TYPE_OF_EVENT = {
    "click": "cash_in",
    "purchase": "cash_out",
    "view": "p2p_transfer",
    "signup": "bill_pay",
    "error": "airtime_topup",
}
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
LABELS = ("cycling", "structuring", "takeover", "agent_imbalance", "geo_impossible")


def _id(prefix: str, number: Column, digits: int) -> Column:
    """Zero-padded id. Longer numbers keep all their digits; lpad alone would cut them."""
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(digits)), F.lit("0")))


def _agent_id(number: Column) -> Column:
    return _id("AGT", number, 5)


def _customer_id(number: Column) -> Column:
    return _id("CUS", number, 7)


def _before_first_day(days: Column) -> Column:
    return F.date_sub(F.lit(FIRST_DAY).cast("date"), days.cast("int"))


def _kyc_tier(custkey: Column) -> Column:
    bucket = custkey % 20
    return F.when(bucket < 11, "tier_1").when(bucket < 18, "tier_2").otherwise("tier_3")


def _loaded(df: DataFrame) -> DataFrame:
    return df.withColumn("loaded_at", F.lit(f"{FIRST_DAY} 00:00:00").cast("timestamp_ntz"))


class StarFeed:
    """A feed (see sources/feed.py) whose tables are derived on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def _region_of(self, nationkey: str) -> Column:
        """Region name of a nation. There are 25 nations whatever the scale: one map holds them,
        and Spark's size estimate of the table that looks them up is not multiplied by a join."""
        nation, region = self._table("nation"), self._table("region")
        names = nation.join(region, nation.n_regionkey == region.r_regionkey).agg(
            F.map_from_entries(F.collect_list(F.struct("n_nationkey", "r_name")))
        )
        return F.element_at(names.scalar(), F.col(nationkey))

    @cached_property
    def agents(self) -> DataFrame:
        return _loaded(
            self._table("supplier").select(
                _agent_id(F.col("s_suppkey")).alias("agent_id"),
                F.col("s_name").alias("agent_name"),
                self._region_of("s_nationkey").alias("region"),
                F.when(F.col("s_acctbal") >= 7500, "super_agent").otherwise("standard").alias("tier"),
                _before_first_day(30 + F.col("s_suppkey") % 871).alias("registration_date"),
                (F.abs("s_acctbal") * 10).cast(MONEY).alias("opening_cash_float"),
            )
        )

    @cached_property
    def customers(self) -> DataFrame:
        return _loaded(
            self._table("customer").select(
                _customer_id(F.col("c_custkey")).alias("customer_id"),
                _kyc_tier(F.col("c_custkey")).alias("kyc_tier"),
                self._region_of("c_nationkey").alias("home_region"),
                _before_first_day(1 + F.col("c_custkey") % 1200).alias("registration_date"),
            )
        )

    @cached_property
    def _events(self) -> DataFrame:
        """One row per event, with its label, and the numbers of its agent and customer."""
        agents = self._table("supplier").agg(F.count("*")).scalar()
        customers = self._table("customer").agg(F.count("*")).scalar()
        event, user = F.col("event_id"), F.col("user_id")
        kind = F.col("txn_type")

        txn_type = F.lit(None).cast("string")
        for name, value in TYPE_OF_EVENT.items():
            txn_type = F.when(F.col("event_type") == name, value).otherwise(txn_type)
        limit = single_limit(_kyc_tier(user))
        part = F.col("value").cast(MONEY) * limit * F.lit("0.02").cast("decimal(4,2)")
        fraud = F.get_json_object("props", "$.k").cast("int") >= 95
        label = F.element_at(F.array(*[F.lit(x) for x in LABELS]), (event % 5 + 1).cast("int"))
        agent = F.when(kind.isin("cash_in", "cash_out"), (event * 31 + user) % agents)

        return self._table("events").withColumn("txn_type", txn_type).select(
            _id("TXN_", event, 10).alias("transaction_id"),
            F.col("ts").alias("txn_timestamp"),
            _customer_id(user).alias("customer_id"),
            _agent_id(agent).alias("agent_id"),
            F.when(
                kind == "p2p_transfer", _customer_id((user + 1 + event) % customers)
            ).alias("counterparty_customer_id"),
            "txn_type",
            F.least(part, limit).cast(MONEY).alias("amount"),
            (event % 50 == 0).alias("redelivered"),
            fraud.alias("is_fraud"),
            F.when(fraud, label).alias("fraud_pattern"),
            agent.alias("s_suppkey"),
            user.alias("c_custkey"),
        )

    @cached_property
    def labelled_transactions(self) -> DataFrame:
        """One row per event, with its label."""
        events = self._events.drop("s_suppkey", "c_custkey")
        at_agent = self.agents.select("agent_id", F.col("region").alias("agent_region"))
        at_home = self.customers.select("customer_id", "home_region")
        return (
            left_join_sparse(events, at_agent, "agent_id", "transaction_id")
            .join(at_home, "customer_id", "left")
            .select(
                "transaction_id",
                "txn_timestamp",
                "customer_id",
                "agent_id",
                "counterparty_customer_id",
                "txn_type",
                "amount",
                F.coalesce("agent_region", "home_region").alias("region"),
                "is_fraud",
                "fraud_pattern",
                "redelivered",
            )
        )

    @cached_property
    def transactions(self) -> DataFrame:
        """The production feed: no labels, and every fiftieth row delivered twice.

        The first delivery came an hour after the event, with an amount of zero.
        """
        feed, _ = split_labels(self.labelled_transactions)
        final = F.timestamp_add("DAY", F.lit(1), F.col("txn_timestamp")).alias("loaded_at")
        early = F.timestamp_add("HOUR", F.lit(1), F.col("txn_timestamp")).alias("loaded_at")
        delivery = F.struct(final, F.col("amount").alias("amount"))
        stale = F.struct(early, F.lit(0).cast(MONEY).alias("amount"))
        return (
            feed.withColumn(
                "delivery",
                F.explode(F.when(F.col("redelivered"), F.array(delivery, stale)).otherwise(F.array(delivery))),
            )
            .select(
                "transaction_id",
                "txn_timestamp",
                "customer_id",
                "agent_id",
                "counterparty_customer_id",
                "txn_type",
                F.col("delivery.amount").alias("amount"),
                "region",
                F.col("delivery.loaded_at").alias("loaded_at"),
            )
        )

    @cached_property
    def ground_truth(self) -> DataFrame:
        """The labels of `labelled_transactions`, without its joins.

        All that these could do to a label is repeat it, where the key of its agent or customer is repeated. Such
        keys are few or none; they are written down, so Spark knows how few before it plans the joins with them.
        """
        keys = {"supplier": "s_suppkey", "customer": "c_custkey"}
        labels = self._events.select(*GROUND_TRUTH.names, *keys.values())
        store = Store(self.spark)
        for table, key in keys.items():
            rows = self._table(table).where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(COPIES))
            repeated = store.keep(rows.where(F.col(COPIES) > 1), f"repeated_{table}")
            each = F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce(COPIES, F.lit(1).cast("long"))))
            labels = labels.join(repeated, key, "left").withColumn("_", each).drop(key, COPIES, "_")
        return labels
