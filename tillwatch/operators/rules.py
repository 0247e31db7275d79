"""The five fraud rules, over staged transactions.

Four rules return transaction_id, customer_id, txn_timestamp, fraud_pattern, rule_metric,
rule_threshold, severity. The agent rule returns agent-days.

The geo and dormant rules may raise one alert several times. With `every_copy=False` they return
it once with a `copies` column (see operators/copies.py).
"""

from __future__ import annotations

from dataclasses import replace
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.functions.grading import graded, ratio, single_limit
from tillwatch.functions.timekeys import MICROS, epoch_micros, epoch_seconds, floor_div, from_epoch_micros
from tillwatch.operators.ahead import (
    COUNT, crowded_seconds, crowded_starts, edge_rows, in_slices, opening_rows, rows_at,
)
from tillwatch.operators.copies import COPIES, repeat_rows
from tillwatch.params import AgentImbalance, Dormant, GeoImpossible, Structuring, Velocity
from tillwatch.schemas import CASH_TYPES, KYC_SINGLE_LIMITS


def _flag(pattern: str, metric: Column, threshold, severity: Column, *extra) -> list:
    return [
        "transaction_id",
        "customer_id",
        "txn_timestamp",
        F.lit(pattern).alias("fraud_pattern"),
        metric.alias("rule_metric"),
        F.lit(threshold).alias("rule_threshold"),
        severity.alias("severity"),
        *extra,
    ]


# --- velocity -------------------------------------------------------------------------------


def velocity_flags(txns: DataFrame, rule: Velocity = Velocity(), keep=None) -> DataFrame:
    """Transactions that open a window with too many transactions of their customer.

    `keep` may write the opening instants down (see sources/store.py). There are few, and Spark
    then knows how few: it broadcasts them and the transactions are not shuffled again.
    """
    rows = _timed(txns)
    starts = crowded_starts(rows, rule.window_minutes * 60, rule.min_transactions, rule.precision)
    if keep:
        starts = keep(starts, "velocity_starts")
    return _velocity(rows_at(rows, starts), rule)


def velocity_edges(txns: DataFrame, rule: Velocity, keep) -> DataFrame:
    """The rows at the edges of crowded windows, from which `velocity_opening` reads the flags of either precision."""
    rows, span = _timed(txns), rule.window_minutes * 60
    crowded = keep(crowded_seconds(rows, span, rule.min_transactions), "velocity_starts")
    return keep(edge_rows(rows, crowded, span), "velocity_edges")


def velocity_opening(edges: DataFrame, rule: Velocity) -> DataFrame:
    return _velocity(opening_rows(edges, rule.precision, rule.min_transactions), rule)


def _timed(txns: DataFrame) -> DataFrame:
    return txns.select("transaction_id", "customer_id", "txn_timestamp")


def _velocity(opening: DataFrame, rule: Velocity) -> DataFrame:
    return opening.select(
        *_flag("velocity_cycling", F.col(COUNT), rule.min_transactions,
               graded(F.col(COUNT), rule.min_transactions))
    )


# --- structuring ----------------------------------------------------------------------------


def near_limit_transfers(txns: DataFrame, customers: DataFrame, near_limit: Decimal) -> DataFrame:
    """Transfers just under the single-transaction limit of the sender's tier."""
    amount = F.col("amount")
    # Any tier's band. Implied by the test after the join, but it reaches the scan and leaves
    # few rows to join.
    some_band = reduce(
        or_, [amount.between(limit * near_limit, Decimal(limit)) for limit in KYC_SINGLE_LIMITS.values()]
    )
    limit = F.col("single_limit")
    return (
        txns.where((F.col("txn_type") == "p2p_transfer") & some_band)
        .select("transaction_id", "customer_id", "txn_timestamp", "amount")
        .join(customers.select("customer_id", "kyc_tier"), "customer_id")
        .withColumn("single_limit", single_limit(F.col("kyc_tier")))
        .where((amount >= limit * F.lit(near_limit)) & (amount <= limit))
        # Else what aggregates by customer and second takes the join's partitions as they are, and
        # Spark may not split those of a busy customer.
        .repartition("customer_id", "txn_timestamp")
    )


def structuring_flags(
    txns: DataFrame,
    customers: DataFrame,
    rule: Structuring = Structuring(),
    with_totals: bool = False,
    keep=None,
) -> DataFrame:
    """Near-limit transfers that open a window with too many near-limit transfers.

    `with_totals` adds total_amount_in_window.
    """
    near = near_limit_transfers(txns, customers, rule.near_limit)
    total = _TOTAL if with_totals or rule.require_total_over_limit else None
    starts = crowded_starts(
        near.withColumnRenamed("amount", _TOTAL), rule.window_minutes * 60, rule.min_splits, rule.precision, total
    )
    if keep:
        starts = keep(starts, "structuring_starts")
    return _structuring(rows_at(near, starts), rule, with_totals)


_TOTAL = "total_amount_in_window"


def structuring_edges(txns: DataFrame, customers: DataFrame, rule: Structuring, keep) -> DataFrame:
    """The near-limit transfers at the edges of crowded windows, for `structuring_opening` at either precision."""
    near = keep(near_limit_transfers(txns, customers, rule.near_limit), "near_limit").withColumnRenamed("amount", _TOTAL)
    span = rule.window_minutes * 60
    crowded = keep(crowded_seconds(near, span, rule.min_splits, _TOTAL), "structuring_starts")
    return keep(edge_rows(near, crowded, span, _TOTAL), "structuring_edges")


def structuring_opening(edges: DataFrame, rule: Structuring) -> DataFrame:
    return _structuring(opening_rows(edges, rule.precision, rule.min_splits, _TOTAL), rule)


def _structuring(opening: DataFrame, rule: Structuring, with_totals: bool = False) -> DataFrame:
    if rule.require_total_over_limit:
        opening = opening.where(F.col(_TOTAL) > F.col("single_limit"))
    extra = [_TOTAL] if with_totals else []
    return opening.select(
        *_flag("structuring", F.col(COUNT), rule.min_splits, graded(F.col(COUNT), rule.min_splits), *extra)
    )


# --- agent imbalance ------------------------------------------------------------------------


def cash_sum(txn_type: str) -> Column:
    return F.sum(F.when(F.col("txn_type") == txn_type, F.col("amount")).otherwise(F.lit(0)))


def cash_ratio() -> Column:
    return ratio(F.col("cash_out_amount"), F.col("cash_in_amount"))


def imbalance_severity(rule: AgentImbalance) -> Column:
    return F.when(
        F.col("cash_in_amount") == 0, F.lit(rule.zero_cash_in_severity).cast("string")
    ).otherwise(graded(cash_ratio(), rule.ratio))


def agent_imbalance_flags(txns: DataFrame, rule: AgentImbalance = AgentImbalance()) -> DataFrame:
    """Agent-days that pay out far more cash than they take in."""
    daily = (
        txns.where(F.col("agent_id").isNotNull() & F.col("txn_type").isin(*CASH_TYPES))
        .groupBy("agent_id", "txn_date")
        .agg(
            cash_sum("cash_in").alias("cash_in_amount"),
            cash_sum("cash_out").alias("cash_out_amount"),
            F.count("*").alias("total_txns"),
        )
    )
    return daily.where((F.col("cash_in_amount") == 0) | (cash_ratio() >= F.lit(rule.ratio))).select(
        "agent_id",
        "txn_date",
        "cash_in_amount",
        "cash_out_amount",
        "total_txns",
        F.lit("agent_imbalance").alias("fraud_pattern"),
        F.round(cash_ratio(), 2).alias("rule_metric"),
        F.lit(rule.ratio).alias("rule_threshold"),
        imbalance_severity(rule).alias("severity"),
    )


def agent_imbalance_pivot(txns: DataFrame, agents: DataFrame, rule: AgentImbalance = AgentImbalance()) -> DataFrame:
    """The analyst's variant: every agent transaction opens an agent-day, the ratio is not
    rounded, no cash-in at all is medium, and the agent's region and tier are added."""
    daily = (
        txns.where(F.col("agent_id").isNotNull())
        .groupBy("agent_id", "txn_date")
        .pivot("txn_type", list(CASH_TYPES))
        .sum("amount")
        .select(
            "agent_id",
            "txn_date",
            *[F.coalesce(F.col(t), F.lit(0)).alias(t) for t in CASH_TYPES],
        )
    )
    exact = ratio(F.col("cash_out"), F.col("cash_in"))
    flagged = daily.where((F.col("cash_in") == 0) | (exact >= F.lit(rule.ratio))).select(
        "*",
        ratio(F.col("cash_out").cast("double"), F.col("cash_in").cast("double")).alias("ratio"),
        F.when(exact >= F.lit(rule.ratio * 2), "high").otherwise("medium").alias("severity"),
    )
    return flagged.join(agents.select("agent_id", "region", "tier"), "agent_id", "left").select(
        "agent_id", "region", "tier", "txn_date", "cash_in", "cash_out", "ratio", "severity"
    )


# --- impossible travel ----------------------------------------------------------------------


def _next_elsewhere(groups: DataFrame, tie: str, ties_count: bool, reach: int) -> DataFrame:
    """For each (customer, instant, region): the first row afterwards in another region.

    No pair of rows is ever formed. Looking back in time from the end, two answers are enough at
    every point: the first row ahead (`head`), and the first one ahead whose region differs from
    that of `head` (`turn`). Whoever stands in another region than `head` goes to `head`, whoever
    stands in the same goes to `turn`.

    The answers are made within each second first, then over seconds, for which one row per
    second is enough. So no group holds more than the microseconds of a second or the seconds of
    a slice, times the regions, however busy the customer is.
    """
    place = F.struct("at", "transaction_id")
    order = ["at", "transaction_id", "region"] if tie == "transaction_id" else ["at", "region", "transaction_id"]
    second = ["customer_id", "second"]
    back = Window.partitionBy(*second).orderBy(F.desc("at"), F.desc(tie))
    past = back.rowsBetween(Window.unboundedPreceding, -1)
    before = F.lead("region").over(back)

    within = groups.withColumn(
        "opens", F.when(before.isNull() | (before != F.col("region")), place)
    ).withColumn("turn", F.last("opens", ignorenulls=True).over(past))
    if ties_count:
        within = within.withColumn("found", F.col("turn"))
    else:
        later = Window.partitionBy(*second).orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, -1)
        within = within.withColumn("head", F.min(F.struct(*order, "turn")).over(later)).withColumn(
            "found", _elsewhere("head")
        )
    within = within.select(*second, "at", "region", "n", "transaction_id", "turn", "found")

    # One row per second from here on.
    heads = within.groupBy(*second).agg(F.min(F.struct(*order, "turn")).alias("head"))
    seconds = in_slices(heads, "second", reach)
    back = Window.partitionBy("customer_id", "slice").orderBy(F.desc("second"))
    past = back.rowsBetween(Window.unboundedPreceding, -1)
    before = F.lead("head").over(back)
    mixed = F.col("head.turn").isNotNull()
    opens = mixed | before.isNull() | before["turn"].isNotNull() | (before["region"] != F.col("head.region"))
    ahead = (
        seconds.withColumn("opens", F.when(opens, F.col("head")))
        .withColumn("other", F.last("opens", ignorenulls=True).over(past))
        .withColumn(
            "turn",
            F.when(mixed, F.col("head.turn"))
            .when(F.col("other.region") != F.col("head.region"), F.struct("other.at", "other.transaction_id"))
            .otherwise(F.col("other.turn")),
        )
        .withColumn(
            "next",
            F.lag(F.struct("head.at", "head.transaction_id", "head.region", "turn")).over(back),
        )
        .where(F.col("slice") == F.col("home"))
        .where(F.col("next.at") <= (F.col("second") + reach + 1) * MICROS)
        .select(*second, "next")
    )
    return (
        within.join(ahead, second, "left")
        .withColumn("found", F.coalesce(F.col("found"), _elsewhere("next")))
        .select("customer_id", "at", "n", "found.transaction_id", F.col("found.at").alias("found_at"))
        .where("found_at is not null")
    )


def _elsewhere(head: str) -> Column:
    """Where someone in `region` goes, given the first row ahead and its turn."""
    return F.when(
        F.col(f"{head}.region") != F.col("region"), F.struct(f"{head}.at", f"{head}.transaction_id")
    ).otherwise(F.col(f"{head}.turn"))


def geo_impossible_flags(
    txns: DataFrame, rule: GeoImpossible = GeoImpossible(), every_copy: bool = True, keep=None
) -> DataFrame:
    """Agent transactions too soon after one of the same customer in another region.

    Each transaction accuses the first one after it in another region, if that one comes within
    the travel time; a transaction accused by several is flagged several times. Rows of one
    customer, instant and region accuse the same one, so they are one row with a count until the
    end.
    """
    exact = rule.gap == "exact"
    minute = 60 * MICROS
    # Truncated minutes admit gaps of up to one microsecond less than the next minute.
    longest = rule.max_minutes * minute if exact else (rule.max_minutes + 1) * minute - 1
    groups = (
        txns.where(F.col("agent_id").isNotNull() & F.col("region").isNotNull())
        .groupBy("customer_id", epoch_micros(F.col("txn_timestamp")).alias("at"), "region")
        .agg(F.min("transaction_id").alias("transaction_id"), F.count("*").alias("n"))
        .withColumn("second", floor_div(F.col("at"), MICROS))
    )
    # Where ties count, rows of one instant follow each other by region.
    tie = "region" if exact else "transaction_id"
    found = _next_elsewhere(groups, tie, ties_count=exact, reach=longest // MICROS + 1)
    gap = F.col("found_at") - F.col("at")
    if exact:
        # Rounds the binary value, halves to even; F.round rounds the decimal text's halves up.
        metric = F.call_function("format_number", gap / F.lit(minute), F.lit("0.0")).cast("double")
        severity = F.when(gap * 2 <= rule.max_minutes * minute, "high").otherwise("medium")
    else:
        minutes = floor_div(gap, minute)
        metric = minutes
        severity = F.when(minutes <= rule.max_minutes // 2, "high").otherwise("medium")
    flags = (
        found.where(gap <= longest)
        .withColumn("txn_timestamp", from_epoch_micros(F.col("found_at")))
        .select(*_flag("geo_impossible", metric, rule.max_minutes, severity, F.col("n").alias(COPIES)))
    )
    if not every_copy:
        return flags
    return repeat_rows(keep(flags, "geo_once") if keep else flags)


def geo_of_both_gaps(txns: DataFrame, rule: GeoImpossible, keep) -> dict[str, DataFrame]:
    """The flags, with copies counted, in truncated minutes ("minute") and in exact ones ("exact").

    Written by one job, in which both share the scans and the shuffles of the instants.
    """
    both = [
        geo_impossible_flags(txns, replace(rule, gap=gap), every_copy=False)
        .withColumn("rule_metric", F.col("rule_metric").cast("double"))
        .withColumn("gap", F.lit(gap))
        for gap in ("minute", "exact")
    ]
    kept = keep(reduce(DataFrame.unionByName, both), "geo_of_both_gaps")
    minute, exact = (kept.where(F.col("gap") == gap).drop("gap") for gap in ("minute", "exact"))
    return {"minute": minute.withColumn("rule_metric", F.col("rule_metric").cast("long")), "exact": exact}


# --- dormant reactivation -------------------------------------------------------------------

FRACTIONS = 8


def dormant_flags(
    txns: DataFrame, rule: Dormant = Dormant(), every_copy: bool = True, keep=None
) -> DataFrame:
    """First transactions after a long silence that open a burst.

    The silence is counted in calendar days, so only the first transaction of a day can end one:
    days per customer are enough to find it, and they are few. The burst is then counted by a
    join on customer and a fraction of the window against those few instants, which `keep` may
    write down as in `velocity_flags`. Fractions cut a busy customer's busy day.

    Each flagged transaction appears once per transaction of its burst.
    """
    rows = txns.select("transaction_id", "customer_id", "txn_timestamp", "txn_date")
    by_day = Window.partitionBy("customer_id").orderBy("txn_date")
    days = (
        rows.groupBy("customer_id", "txn_date")
        .agg(F.min("txn_timestamp").alias("woke_at"))
        .withColumn("silent_days", F.datediff("txn_date", F.lag("txn_date").over(by_day)))
    )
    fraction = rule.window_hours * 3600 // FRACTIONS

    def part(ts: str) -> Column:
        return floor_div(epoch_seconds(F.col(ts)), fraction)

    woken = (
        days.where(F.col("silent_days") >= rule.dormancy_days)
        .withColumn("until", F.timestamp_add("HOUR", F.lit(rule.window_hours), F.col("woke_at")))
        .select(
            "customer_id",
            "woke_at",
            "until",
            "silent_days",
            F.explode(F.sequence(part("woke_at"), part("until"))).alias("part"),
        )
    )
    if keep:
        woken = keep(woken, "dormant_woken")
    burst = (
        rows.withColumn("part", part("txn_timestamp"))
        .join(woken, ["customer_id", "part"])
        .where(F.col("txn_timestamp").between(F.col("woke_at"), F.col("until")))
        .groupBy("customer_id", "woke_at", "silent_days")
        .agg(
            F.count("*").alias(COPIES),
            F.min(F.when(F.col("txn_timestamp") == F.col("woke_at"), F.col("transaction_id"))).alias("transaction_id"),
        )
        .where(F.col(COPIES) >= rule.burst_count)
        .withColumnRenamed("woke_at", "txn_timestamp")
    )
    severity = F.when(F.col("silent_days") >= rule.dormancy_days * 2, "high").otherwise("medium")
    flags = burst.select(
        *_flag("dormant_reactivation", F.col("silent_days"), rule.dormancy_days, severity, COPIES)
    )
    if not every_copy:
        return flags
    return repeat_rows(keep(flags, "dormant_once") if keep else flags)
