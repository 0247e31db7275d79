"""All models over one feed.

Each model is a lazy DataFrame, built on first use. With a store, what several models share is
written down once: the staged transactions, the few instants the window rules find, the flags.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from tillwatch.operators import alerts, evaluation, marts, readouts, rules, staging
from tillwatch.operators.copies import repeat_rows
from tillwatch.params import RuleSettings
from tillwatch.sources.feed import Feed
from tillwatch.sources.store import Store, as_files, rows_per_day, write_fact


class Models:
    def __init__(
        self,
        feed: Feed,
        settings: RuleSettings = RuleSettings(),
        as_of: dt.date | None = None,
        alert_created_at: dt.datetime | None = None,
        store: Store | None = None,
        both_sets: bool = False,
    ):
        self.feed = feed
        self.settings = settings
        self.as_of = as_of
        self.alert_created_at = alert_created_at
        self.store = store
        #: Whether the analyst's flags will be asked for as well as those of all rules: with a store, the travel
        #: rule's two variants are then one job. Else only the variant that is asked for is computed.
        self.both_sets = both_sets

    @property
    def keep(self):
        """What writes an intermediate result down, if there is a store."""
        return self.store.keep if self.store else None

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        return self.store.keep(df, name) if self.store else df

    # staging

    @cached_property
    def stg_agents(self) -> DataFrame:
        return staging.stg_agents(self.feed.agents, self.as_of)

    @cached_property
    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.feed.customers, self.as_of)

    @cached_property
    def stg_transactions(self) -> DataFrame:
        return self._kept(staging.stg_transactions(self.feed.transactions), "stg_transactions")

    # rules

    # With a store, the rules that look ahead in time share with the analyst's variant what they read.

    @cached_property
    def velocity_edges(self) -> DataFrame:
        return rules.velocity_edges(self.stg_transactions, self.settings.velocity, self.keep)

    @cached_property
    def structuring_edges(self) -> DataFrame:
        return rules.structuring_edges(
            self.stg_transactions, self.stg_customers, self.settings.structuring, self.keep
        )

    def _velocity(self, settings: RuleSettings) -> DataFrame:
        if self.store:
            return rules.velocity_opening(self.velocity_edges, settings.velocity)
        return rules.velocity_flags(self.stg_transactions, settings.velocity)

    def _structuring(self, settings: RuleSettings) -> DataFrame:
        if self.store:
            return rules.structuring_opening(self.structuring_edges, settings.structuring)
        return rules.structuring_flags(self.stg_transactions, self.stg_customers, settings.structuring)

    def _geo(self, settings: RuleSettings) -> DataFrame:
        rule = settings.geo_impossible
        if self.store and self.both_sets:
            return self.geo_of_both_gaps[rule.gap]
        if rule.gap not in self._geo_of_one_gap:
            found = rules.geo_impossible_flags(self.stg_transactions, rule, every_copy=False)
            self._geo_of_one_gap[rule.gap] = self._kept(found, f"geo_{rule.gap}")
        return self._geo_of_one_gap[rule.gap]

    @cached_property
    def _geo_of_one_gap(self) -> dict[str, DataFrame]:
        return {}

    @cached_property
    def geo_of_both_gaps(self) -> dict[str, DataFrame]:
        return rules.geo_of_both_gaps(self.stg_transactions, self.settings.geo_impossible, self.keep)

    @cached_property
    def fr_velocity_flags(self) -> DataFrame:
        return self._velocity(self.settings)

    @cached_property
    def fr_structuring_flags(self) -> DataFrame:
        return self._structuring(self.settings)

    @cached_property
    def fr_agent_imbalance_flags(self) -> DataFrame:
        return rules.agent_imbalance_flags(self.stg_transactions, self.settings.agent_imbalance)

    @cached_property
    def fr_agent_imbalance_pivot(self) -> DataFrame:
        return rules.agent_imbalance_pivot(
            self.stg_transactions, self.stg_agents, self.settings.agent_imbalance
        )

    @cached_property
    def geo_once(self) -> DataFrame:
        """The geo rule's output with copies counted."""
        return self._geo(self.settings)

    @cached_property
    def fr_geo_impossible_flags(self) -> DataFrame:
        return repeat_rows(self.geo_once)

    @cached_property
    def dormant_once(self) -> DataFrame:
        """The dormant rule's output with copies counted."""
        found = rules.dormant_flags(
            self.stg_transactions, self.settings.dormant, every_copy=False, keep=self.keep
        )
        return self._kept(found, "dormant_once")

    @cached_property
    def fr_dormant_reactivation_flags(self) -> DataFrame:
        return repeat_rows(self.dormant_once)

    # alerts

    @cached_property
    def flags(self) -> DataFrame:
        """Output of the four transaction rules, with copies counted."""
        by_rule = ("fr_velocity_flags", "fr_structuring_flags", "geo_once", "dormant_once")
        if self.store:
            # Some of them write down what they find on the way. These jobs wait for nothing but
            # the staged tables, so they run side by side.
            self.stg_customers
            inherit = inheritable_thread_target(self.stg_transactions.sparkSession)
            with ThreadPoolExecutor(len(by_rule)) as pool:
                union = alerts.all_flags(*pool.map(inherit(partial(getattr, self)), by_rule))
        else:
            union = alerts.all_flags(*[getattr(self, name) for name in by_rule])
        return self._kept(union, "flags")

    def _alerts(self, **options) -> DataFrame:
        return alerts.fraud_alerts(
            self.flags, self.stg_transactions, self.stg_customers, self.alert_created_at, **options
        )

    @cached_property
    def fraud_alerts(self) -> DataFrame:
        return self._alerts()

    @cached_property
    def fraud_alerts_deduped(self) -> DataFrame:
        return self._alerts(dedupe=True)

    @cached_property
    def fraud_alert_summary(self) -> DataFrame:
        return alerts.alert_summary(self.flags, self.stg_transactions, self.stg_customers)

    @cached_property
    def kept_summary(self) -> DataFrame:
        """The summary, written down for whoever joins it with a large table."""
        return self._kept(self.fraud_alert_summary, "fraud_alert_summary")

    # the analyst's variant: three rules on exact times, and flags keep their row even if their customer
    # or transaction is missing

    @cached_property
    def analyst_by_rule(self) -> tuple[DataFrame, ...]:
        """Velocity, structuring and impossible travel, the last with copies counted."""
        exact = self.settings.to_the_microsecond()
        return self._velocity(exact), self._structuring(exact), self._geo(exact)

    @cached_property
    def combined_flags(self) -> DataFrame:
        """The analyst's flags with their metrics, one row per copy."""
        return alerts.combined_flags(*self.analyst_by_rule)

    @cached_property
    def analyst_flags(self) -> DataFrame:
        return self._kept(alerts.all_flags(*self.analyst_by_rule), "analyst_flags")

    @cached_property
    def analyst_summary(self) -> DataFrame:
        return self._kept(alerts.analyst_summary(self.analyst_flags, self.stg_transactions), "analyst_summary")

    # evaluation

    def _truth(self) -> DataFrame:
        if self.feed.ground_truth is None:
            raise ValueError("the feed has no labels to score against")
        return self.feed.ground_truth

    @cached_property
    def fraud_rule_evaluation(self) -> DataFrame:
        return evaluation.rule_evaluation(self._truth(), self.kept_summary)

    @cached_property
    def recall_by_pattern(self) -> DataFrame:
        return evaluation.recall_by_pattern(self._truth(), self.kept_summary)

    # marts

    @cached_property
    def dim_agents(self) -> DataFrame:
        return marts.dim_agents(self.stg_agents)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return marts.dim_customers(self.stg_customers)

    @cached_property
    def fct_transactions(self) -> DataFrame:
        return marts.fct_transactions(self.stg_transactions, self.stg_customers, self.stg_agents)

    @cached_property
    def day_rows(self) -> DataFrame:
        """The number of transactions of each day, from the daily mart."""
        return rows_per_day(self.transaction_velocity_daily, "txn_count")

    @cached_property
    def agent_daily_health(self) -> DataFrame:
        return marts.agent_daily_health(
            self.stg_transactions, self.stg_agents, self.settings.agent_imbalance
        )

    @cached_property
    def transaction_velocity_daily(self) -> DataFrame:
        return marts.transaction_velocity_daily(self.stg_transactions)


TABLES = (
    "fr_velocity_flags",
    "fr_structuring_flags",
    "fr_agent_imbalance_flags",
    "fr_geo_impossible_flags",
    "fr_dormant_reactivation_flags",
    "fraud_alerts",
    "fraud_alert_summary",
    "dim_agents",
    "dim_customers",
    "agent_daily_health",
    "transaction_velocity_daily",
)


def write_all(models: Models, folder: str) -> dict[str, DataFrame]:
    """Write every rule and mart to `folder`, the fact table by day; return them as read back.

    What is written takes the place of the model: whatever is built on it reads the files.
    """
    folder = folder.rstrip("/")
    models.both_sets = True  # for the read-outs
    written = {}

    def put(name: str, df: DataFrame) -> None:
        written[name] = models.__dict__[name] = df

    for name in TABLES:
        put(name, as_files(getattr(models, name), f"{folder}/{name}"))
    models.__dict__["kept_summary"] = written["fraud_alert_summary"]
    put("fct_transactions", write_fact(models.fct_transactions, f"{folder}/fct_transactions", models.day_rows))
    if models.feed.ground_truth is not None:
        put("fraud_rule_evaluation", as_files(models.fraud_rule_evaluation, f"{folder}/fraud_rule_evaluation"))
    return written


def read_outs(models: Models) -> dict[str, DataFrame]:
    """The analyst's read-outs by name; those that depend on the flags also over all rules (`_all_rules`)."""
    txns, truth, imbalance = models.stg_transactions, models.feed.ground_truth, models.fr_agent_imbalance_pivot
    found = {
        "combined_flags_exact": models.combined_flags,
        "alert_summary_exact": models.analyst_summary,
        "daily_volume_by_type": readouts.daily_volume_by_type(txns),
        "value_by_region": readouts.value_by_region(txns),
        "imbalance_list": readouts.imbalance_list(imbalance),
        "busiest_agents": readouts.busiest_agents(txns),
    }
    sets = {"": (models.analyst_summary, models.analyst_flags), "_all_rules": (models.kept_summary, models.flags)}
    for suffix, (summary, flags) in sets.items():
        over = {
            "kpis": readouts.headline_kpis(txns, summary, imbalance),
            "alert_queue": readouts.alert_queue(summary),
            "alerts_by_rule": readouts.alerts_by_rule(flags),
        }
        if truth is not None:
            zero = evaluation.rule_evaluation(truth, summary, zero_for_undefined=True)
            over["fraud_rule_evaluation_zero"] = zero
            over["validation_metrics"] = readouts.validation_metrics(zero)
            over["recall_by_pattern"] = evaluation.recall_by_pattern(truth, summary)
        found |= {f"{name}{suffix}": df for name, df in over.items()}
    return found


def write_readouts(models: Models, folder: str) -> dict[str, DataFrame]:
    """Write the analyst's read-outs to `folder`/readouts; return them as read back."""
    folder = folder.rstrip("/")
    return {name: as_files(df, f"{folder}/readouts/{name}") for name, df in read_outs(models).items()}
