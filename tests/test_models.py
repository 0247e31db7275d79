"""Staging, alerts, evaluation, marts, read-outs and quality checks on hand-made rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import at, rows

from tillwatch.operators import alerts, evaluation, marts, quality, readouts, rules, staging
from tillwatch.operators.copies import COPIES
from tillwatch.params import AgentImbalance
from tillwatch.plans.checks import REQUIRED

RAW = (
    "transaction_id string, txn_timestamp timestamp_ntz, customer_id string, agent_id string, "
    "counterparty_customer_id string, txn_type string, amount decimal(14,2), region string, loaded_at timestamp_ntz"
)


def test_stage_transactions(spark):
    first, second = at("2 10:00:00"), at("2 11:00:00")
    ts = at("1 23:59:59")

    def row(txn, amount, loaded):
        return (txn, ts, "c", None, None, "bill_pay", Decimal(amount), "R1", loaded)

    raw = spark.createDataFrame(
        [
            row("late", "1.00", first), row("late", "2.00", second),
            row("once", "3.00", first),
            row("same", "4.00", first), row("same", "5.00", first),
            row("twin", "6.00", first), row("twin", "6.00", first),
        ],
        RAW,
    )
    staged = staging.stg_transactions(raw)
    assert staged.columns == [
        "transaction_id", "txn_timestamp", "txn_date", "txn_hour", "customer_id", "agent_id",
        "counterparty_customer_id", "txn_type", "amount", "region",
    ]
    kept = dict(rows(staged, "transaction_id", "amount"))
    assert kept.pop("same") in (Decimal("4.00"), Decimal("5.00"))
    assert kept == {"late": Decimal("2.00"), "once": Decimal("3.00"), "twin": Decimal("6.00")}
    assert rows(staged, "txn_date", "txn_hour")[0] == (dt.date(2026, 1, 1), 23)
    # Copies loaded together: the same one is kept whatever the order of the rows.
    again = staging.stg_transactions(raw.orderBy("amount").repartition(3, "amount"))
    assert rows(staged) == rows(again)


def test_stage_dimensions(spark):
    agents = spark.createDataFrame(
        [("a", "Agent", "  R1 ", "standard", dt.date(2026, 1, 1), Decimal("5.00"))],
        "agent_id string, agent_name string, region string, tier string, registration_date date, opening_cash_float decimal(14,2)",
    )
    assert rows(staging.stg_agents(agents, dt.date(2026, 3, 1)))[0] == (
        "a", "Agent", "R1", "standard", dt.date(2026, 1, 1), Decimal("5.00"), 59,
    )
    people = spark.createDataFrame(
        [("c", "tier_1", " R2", dt.date(2026, 1, 31))],
        "customer_id string, kyc_tier string, home_region string, registration_date date",
    )
    assert rows(staging.stg_customers(people, dt.date(2026, 2, 1)))[0] == ("c", "tier_1", "R2", dt.date(2026, 1, 31), 1)
    today = staging.stg_customers(people).first()["account_age_days"]
    assert abs(today - (dt.date.today() - dt.date(2026, 1, 31)).days) <= 1  # the session's day, not the machine's


@pytest.fixture
def queue(txns, customers):
    """x trips two rules, y one rule three times with both severities, z one rule."""
    for txn, who in (("x", "c1"), ("y", "c2"), ("z", "c1"), ("quiet", "c2"), ("stranger", "c9")):
        txns.add(txn, "10:00:00", who, amount="7.00")
    df = txns.frame()
    ts = at("10:00:00")
    schema = "transaction_id string, customer_id string, txn_timestamp timestamp_ntz, fraud_pattern string, severity string"
    velocity = df.sparkSession.createDataFrame(
        [("x", "c1", ts, "velocity_cycling", "medium"), ("z", "c1", ts, "velocity_cycling", "medium"),
         ("stranger", "c9", ts, "velocity_cycling", "high")],
        schema,
    )
    geo = df.sparkSession.createDataFrame(
        [("x", "c1", ts, "geo_impossible", "high", 1), ("y", "c2", ts, "geo_impossible", "medium", 2),
         ("y", "c2", ts, "geo_impossible", "high", 1)],
        schema + ", copies long",
    )
    return alerts.all_flags(velocity, geo), df, customers(("c1", "tier_1"), ("c2", "tier_2"))


CREATED = dt.datetime(2026, 2, 1)


def test_alerts(queue):
    flags, txns, people = queue
    found = alerts.fraud_alerts(flags, txns, people, CREATED)
    assert COPIES not in found.columns
    assert rows(found, "transaction_id", "fraud_pattern", "severity", "kyc_tier") == [
        ("x", "geo_impossible", "high", "tier_1"),
        ("x", "velocity_cycling", "medium", "tier_1"),
        ("y", "geo_impossible", "high", "tier_2"),
        ("y", "geo_impossible", "medium", "tier_2"),
        ("y", "geo_impossible", "medium", "tier_2"),
        ("z", "velocity_cycling", "medium", "tier_1"),
    ]
    one = found.where("transaction_id = 'z'").first()
    assert (one["review_status"], one["alert_created_at"], one["amount"], one["account_age_days"]) == (
        "open", CREATED, Decimal("7.00"), 396,
    )
    deduped = alerts.fraud_alerts(flags, txns, people, CREATED, dedupe=True)
    assert rows(deduped, "transaction_id", "fraud_pattern", "severity") == [
        ("x", "geo_impossible", "high"),
        ("x", "velocity_cycling", "medium"),
        ("y", "geo_impossible", "high"),
        ("z", "velocity_cycling", "medium"),
    ]


@pytest.mark.parametrize("every_copy", [True, False])
def test_summary(queue, every_copy):
    flags, txns, people = queue
    summary = alerts.fraud_alert_summary(alerts.fraud_alerts(flags, txns, people, CREATED, every_copy=every_copy))
    assert rows(
        summary, "transaction_id", "rules_tripped", "fraud_patterns", "max_severity_rank", "max_severity", "review_status"
    ) == [
        ("x", 2, "geo_impossible, velocity_cycling", 2, "high", "open"),
        ("y", 1, "geo_impossible", 2, "high", "open"),
        ("z", 1, "velocity_cycling", 1, "medium", "open"),
    ]


def test_summary_of_an_unknown_severity(queue):
    flags, txns, people = queue
    found = alerts.fraud_alerts(flags, txns, people, CREATED).selectExpr("* except (severity)", "'odd' as severity")
    assert {r[0] for r in rows(alerts.fraud_alert_summary(found), "max_severity")} == {"low"}


def truth_of(spark, *labels):
    return spark.createDataFrame(list(labels), "transaction_id string, is_fraud boolean, fraud_pattern string")


def test_evaluation(spark):
    truth = truth_of(
        spark, ("a", True, "cycling"), ("b", True, "cycling"), ("c", True, "takeover"), ("d", False, None), ("e", False, None),
        ("f", True, None),
    )
    summary = spark.createDataFrame([("a",), ("d",), ("d",), ("unlabelled",)], "transaction_id string")
    assert rows(evaluation.rule_evaluation(truth, summary))[0] == (6, 4, 2, 1, 1, 3, 0.25, 0.5)
    assert rows(evaluation.recall_by_pattern(truth, summary)) == [("cycling", 2, 1, 0.5), ("takeover", 1, 0, 0.0)]


def test_evaluation_without_fraud_flags_or_labels(spark):
    nothing = spark.createDataFrame([], "transaction_id string")
    honest = truth_of(spark, ("a", False, None))
    assert rows(evaluation.rule_evaluation(honest, nothing))[0] == (1, 0, 0, 0, 0, 0, None, None)
    assert rows(evaluation.rule_evaluation(honest, nothing, zero_for_undefined=True))[0] == (1, 0, 0, 0, 0, 0, 0.0, 0.0)
    assert rows(evaluation.rule_evaluation(honest.limit(0), nothing))[0] == (0, None, None, None, None, None, None, None)


def test_marts(txns, customers, agents):
    txns.add("1", "10:00:00", "c1", "cash_in", "100.00", agent="a1")
    txns.add("2", "10:00:00", "c1", "cash_out", "300.00", agent="a1")
    txns.add("3", "10:00:00", "c2", "bill_pay", "5.00", agent="a1")
    txns.add("4", "10:00:00", "c2", "cash_out", "5.00", agent="a2")
    txns.add("5", "10:00:00", "c9", "airtime_topup", "5.01", agent="a3", region="R2")
    txns.add("6", "10:00:00", "c9", "airtime_topup", "5.00", agent=None, region="R2")
    txns.add("7", "10:00:00", "c9", "cash_out", "5.00", agent="gone")
    df = txns.frame()
    net = agents(("a1", "R1", "standard"), ("a2", "R1", "standard"), ("a3", "R1", "super_agent"))

    health = marts.agent_daily_health(df, net)
    assert rows(
        health, "agent_id", "total_txns", "unique_customers_served", "cash_out_to_in_ratio", "imbalance_flag"
    ) == [("a1", 3, 2, Decimal("3.00"), "medium"), ("a2", 1, 1, None, "none"), ("a3", 1, 1, None, "none")]
    graded = marts.agent_daily_health(df, net, AgentImbalance(zero_cash_in_severity="medium"))
    # a3 had no cash transaction at all, so the rule has no row for it.
    assert rows(graded, "agent_id", "imbalance_flag") == [("a1", "medium"), ("a2", "medium"), ("a3", "none")]

    facts = marts.fct_transactions(df, customers(("c1", "tier_1"), ("c2", "tier_2")), net)
    assert rows(facts, "transaction_id", "kyc_tier", "agent_tier") == [
        ("1", "tier_1", "standard"), ("2", "tier_1", "standard"), ("3", "tier_2", "standard"), ("4", "tier_2", "standard"),
        ("5", None, "super_agent"), ("6", None, None), ("7", None, None),
    ]
    daily = marts.transaction_velocity_daily(df)
    assert rows(daily.where("region = 'R2'"), "txn_type", "txn_count", "total_amount", "avg_amount", "unique_customers") == [
        ("airtime_topup", 2, Decimal("10.01"), Decimal("5.01"), 1)
    ]
    assert marts.dim_agents(net).columns[-1] == "agent_tenure_days"
    assert marts.dim_customers(customers(("c1", "tier_1"))).columns[-1] == "account_age_days"


def test_readouts(queue, agents):
    flags, txns, people = queue
    summary = alerts.fraud_alert_summary(alerts.fraud_alerts(flags, txns, people, CREATED))
    assert [r[0] for r in readouts.alert_queue(summary, rows=2).select("transaction_id").collect()] == ["x", "y"]
    assert [tuple(r) for r in readouts.alerts_by_rule(flags).collect()] == [("geo_impossible", 4), ("velocity_cycling", 3)]
    expanded = alerts.fraud_alerts(flags, txns, people, CREATED)
    assert [tuple(r) for r in readouts.alerts_by_rule(expanded).collect()] == [("geo_impossible", 4), ("velocity_cycling", 2)]
    listed = rules.agent_imbalance_pivot(txns, agents())
    kpis = readouts.headline_kpis(txns, summary, listed).first().asDict()
    assert kpis == {"total_transactions": 5, "flagged_transactions": 3, "agent_imbalance_alerts": 0, "flag_rate": 0.6}
    assert rows(readouts.value_by_region(txns)) == [("R1", Decimal("35.00"))]
    assert rows(readouts.daily_volume_by_type(txns)) == [(dt.date(2026, 1, 1), "cash_in", 5)]
    assert rows(readouts.busiest_agents(txns)) == [("AGT00000", 5)]


def test_quality_checks_find_one_broken_row_each(spark):
    bad = spark.createDataFrame(
        [("1", "tier_1", "p1"), ("1", "tier_2", None), (None, "tier_3", "p2"), (None, None, "p2"), ("2", "tier_4", "p3")],
        "id string, tier string, parent string",
    )
    parents = spark.createDataFrame([("p1",), ("p2",), (None,)], "key string")
    tiers = ("tier_1", "tier_2", "tier_3")
    checks = (
        quality.not_unique(bad, "t", "id"),
        quality.is_null(bad, "t", "id"),
        quality.not_accepted(bad, "t", "tier", tiers),
        quality.orphans(bad, "t", "parent", parents, "key"),
    )
    assert rows(quality.violations(*checks)) == [
        ("accepted_values", "t", "tier", "tier_4", 1),
        ("foreign_key", "t", "parent", "p3", 1),
        ("not_null", "t", "id", None, 2),
        ("unique", "t", "id", "1", 2),
    ]
    assert rows(quality.report({("t", "id"): checks[0], ("t", "parent"): checks[3]})) == [("t", "id", 1), ("t", "parent", 1)]
    assert rows(quality.report({("t", "id"): checks[1]}, count_rows=True)) == [("t", "id", 2)]
    fine = quality.not_unique(bad.limit(0), "t", "id")
    assert rows(quality.report({("t", "id"): fine}, count_rows=True)) == [("t", "id", 0)]
    assert rows(quality.null_report({"t": (bad, ("id", "tier", "parent"))})) == [("t", "id", 2), ("t", "parent", 1), ("t", "tier", 1)]
    assert rows(quality.accepted_report({"t": (bad, {"tier": tiers})})) == [("t", "tier", 1)]


def test_every_mandatory_column_is_listed(spark):
    """A NULL in each mandatory column shows up among the violations."""
    for relation, columns in REQUIRED.items():
        data = [tuple(None if i == j else "x" for j in range(len(columns))) for i in range(len(columns))]
        frame = spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))
        found = quality.nulls(frame, relation, columns).collect()
        assert {(r.relation, r.column_name, r.row_count) for r in found} == {(relation, c, 1) for c in columns}
    assert quality.nulls(frame.dropna(), relation, columns).collect() == []


def test_analyst_summary_keeps_flags_without_customer_or_transaction(spark, txns):
    frame = txns.add("t1", "10:00:00", "gone").frame()
    flags = spark.createDataFrame(
        [("t1", "gone", at("10:00:00"), "velocity_cycling", "high"), ("t2", "gone", at("11:00:00"), "structuring", "medium"),
         ("t1", "gone", at("10:00:00"), "structuring", "medium")],
        "transaction_id string, customer_id string, txn_timestamp timestamp_ntz, fraud_pattern string, severity string",
    )
    out = {r.transaction_id: r for r in alerts.analyst_summary(flags, frame).collect()}
    assert set(out) == {"t1", "t2"} and out["t1"].fraud_patterns == "structuring, velocity_cycling"
    assert out["t2"].amount is None and out["t1"].rules_tripped == 2


def test_many_checks_in_one_pass(spark):
    Check = quality.Check
    people = spark.createDataFrame(
        [("p1",), ("p2",), ("p2",), ("p2",), (None,), ("é",), ("",)], "key string"
    )
    shops = spark.createDataFrame([("s1",), ("p9",)], "key string")
    bad = spark.createDataFrame(
        [("1", "tier_1", "p1", "p9", "s1"), ("1", "tier_2", None, "p1", "s9"), (None, "tier_3", "p3", "p3", None),
         (None, None, "p3", None, "p1"), ("2", "tier_4", "p2", "é", "s1"), ("3", "tier_4", "", "p3", "s1")],
        "id string, tier string, parent string, other string, shop string",
    )
    tables = {"t": bad, "people": people, "shops": shops}
    checks = [
        Check("unique", "t", "id"), Check("not_null", "t", "id"), Check("not_null", "t", "tier"),
        Check("accepted_values", "t", "tier", accepted=("tier_1", "tier_2", "tier_3")), Check("unique", "people", "key"),
        Check("foreign_key", "t", "parent", parent=("people", "key")),
        Check("foreign_key", "t", "other", parent=("people", "key")),
        Check("foreign_key", "t", "shop", parent=("shops", "key")),
    ]
    found = quality.offences(tables, checks)
    assert rows(found) == sorted([
        ("unique", "t", "id", "1", 2), ("not_null", "t", "id", None, 2), ("not_null", "t", "tier", None, 1),
        ("accepted_values", "t", "tier", "tier_4", 2), ("unique", "people", "key", "p2", 3),
        ("foreign_key", "t", "parent", "p3", 2), ("foreign_key", "t", "other", "p3", 2),
        ("foreign_key", "t", "other", "p9", 1), ("foreign_key", "t", "shop", "s9", 1), ("foreign_key", "t", "shop", "p1", 1),
    ], key=repr)
    # As each check finds alone.
    alone = (
        quality.not_unique(bad, "t", "id"), quality.nulls(bad, "t", ("id", "tier")),
        quality.not_accepted(bad, "t", "tier", checks[3].accepted), quality.not_unique(people, "people", "key"),
        quality.orphans(bad, "t", "parent", people, "key"), quality.orphans(bad, "t", "other", people, "key"),
        quality.orphans(bad, "t", "shop", shops, "key"),
    )
    assert rows(found) == rows(quality.violations(*alone))
    assert rows(quality.counted_report(tables, checks[5:], count_rows=True)) == [("t", "other", 3), ("t", "parent", 2), ("t", "shop", 2)]
    assert rows(quality.counted_report(tables, checks[:1])) == [("t", "id", 1)]
    none = {name: df.limit(0) for name, df in tables.items()}
    assert rows(quality.offences(none, checks)) == []
    assert rows(quality.counted_report(none, checks[5:7])) == [("t", "other", 0), ("t", "parent", 0)]
