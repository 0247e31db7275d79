"""Each rule at its edges, with the default settings."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import Transactions, at, rows

from tillwatch.operators import rules
from tillwatch.operators.copies import COPIES
from tillwatch.params import AgentImbalance, Dormant, GeoImpossible, Structuring, Velocity

FLAG = ("transaction_id", "rule_metric", "severity")


def burst(txns, customer, *times, **kw):
    for i, when in enumerate(times):
        txns.add(f"{customer}-{i}", when, customer, **kw)


def test_velocity_edges(txns):
    burst(txns, "edge", "10:00:00", "10:05:00", "10:10:00", "10:20:00")
    burst(txns, "late", "10:00:00", "10:05:00", "10:10:00", "10:20:01")
    burst(txns, "high", *["10:00:00"] * 3, *["10:01:00"] * 5)
    # In whole seconds these are 20 minutes apart, in microseconds a little more.
    burst(txns, "fine", "10:00:00.400000", "10:00:01", "10:00:02", "10:20:00.900000")
    # Around midnight and around the edge of a slice of the time line.
    burst(txns, "night", "1 23:50:00", "1 23:59:59", "2 00:00:00", "2 00:09:59")
    df = txns.frame()

    coarse = rows(rules.velocity_flags(df), *FLAG)
    assert coarse == [
        ("edge-0", 4, "medium"),
        ("fine-0", 4, "medium"),
        ("high-0", 8, "high"), ("high-1", 8, "high"), ("high-2", 8, "high"),
        ("high-3", 5, "medium"), ("high-4", 5, "medium"), ("high-5", 5, "medium"),
        ("high-6", 5, "medium"), ("high-7", 5, "medium"),
        ("night-0", 4, "medium"),
    ]
    exact = rows(rules.velocity_flags(df, Velocity(precision="micro")), *FLAG)
    assert exact == [r for r in coarse if r[0] != "fine-0"]


def test_velocity_columns(txns):
    burst(txns, "c", *["10:00:00"] * 4)
    flagged = rules.velocity_flags(txns.frame())
    assert flagged.columns == [
        "transaction_id", "customer_id", "txn_timestamp", "fraud_pattern", "rule_metric", "rule_threshold", "severity",
    ]
    assert rows(flagged)[0] == ("c-0", "c", at("10:00:00"), "velocity_cycling", 4, 4, "medium")


def test_velocity_over_the_hour_that_daylight_saving_skips(txns):
    # 02:30 does not exist in the session's zone on this day.
    burst(txns, "dst", "2026-03-08 01:55:00", "2026-03-08 02:05:00", "2026-03-08 02:10:00", "2026-03-08 02:14:59")
    burst(txns, "far", "2026-03-08 01:55:00", "2026-03-08 02:55:00", "2026-03-08 03:05:00", "2026-03-08 03:10:00")
    assert rows(rules.velocity_flags(txns.frame()), *FLAG) == [("dst-0", 4, "medium")]


def p2p(txns, customer, amounts, times, **kw):
    for i, (amount, when) in enumerate(zip(amounts, times, strict=True)):
        txns.add(f"{customer}-{i}", when, customer, "p2p_transfer", amount, agent=None, **kw)


def test_structuring_edges(txns, customers):
    hour = ("10:00:00", "10:30:00", "11:00:00")
    p2p(txns, "edges", ("800.00", "900.00", "1000.00"), hour)
    p2p(txns, "late", ("800.00", "900.00", "1000.00"), ("10:00:00", "10:30:00", "11:00:01"))
    p2p(txns, "below", ("799.99", "900.00", "1000.00"), hour)
    p2p(txns, "above", ("800.00", "900.00", "1000.01"), hour)
    p2p(txns, "tier3", ("80000.00", "90000.00", "100000.00"), hour)
    # Near the limit of another tier only.
    p2p(txns, "wrong", ("800.00", "900.00", "1000.00"), hour)
    p2p(txns, "unknown", ("800.00", "900.00", "1000.00"), hour)
    p2p(txns, "nobody", ("800.00", "900.00", "1000.00"), hour)
    p2p(txns, "six", ["850.00"] * 6, ["10:00:00", *["10:10:00"] * 5])
    burst(txns, "cash", *hour, amount="900.00")
    # A row that is not near the limit must not count towards the window.
    p2p(txns, "mixed", ("900.00", "100.00", "900.00"), hour)
    who = customers(
        ("edges", "tier_1"), ("late", "tier_1"), ("below", "tier_1"), ("above", "tier_1"), ("tier3", "tier_3"),
        ("wrong", "tier_2"), ("unknown", "tier_9"), ("six", "tier_1"), ("cash", "tier_1"), ("mixed", "tier_1"),
    )
    df = txns.frame()
    assert rows(rules.structuring_flags(df, who), *FLAG) == [
        ("edges-0", 3, "medium"),
        ("six-0", 6, "high"),
        *[(f"six-{i}", 5, "medium") for i in range(1, 6)],
        ("tier3-0", 3, "medium"),
    ]
    totals = rules.structuring_flags(df, who, with_totals=True)
    assert rows(totals, "transaction_id", "total_amount_in_window")[0] == ("edges-0", Decimal("2700.00"))
    strict = Structuring(min_splits=1, require_total_over_limit=True)
    flagged = {r[0] for r in rows(rules.structuring_flags(df, who, strict), "transaction_id")}
    assert {"edges-0", "edges-1", "below-1", "six-0"} <= flagged
    assert not {"edges-2", "above-1"} & flagged  # one transfer within the limit remains


def test_structuring_to_the_microsecond(txns, customers):
    p2p(txns, "c", ["900.00"] * 3, ("10:00:00.500000", "10:00:00.600000", "11:00:00.500000"))
    p2p(txns, "d", ["900.00"] * 3, ("10:00:00.500000", "10:00:00.600000", "11:00:00.500001"))
    who = customers(("c", "tier_1"), ("d", "tier_1"))
    exact = rules.structuring_flags(txns.frame(), who, Structuring(precision="micro"), with_totals=True)
    assert rows(exact, "transaction_id", "rule_metric", "total_amount_in_window") == [("c-0", 3, Decimal("2700.00"))]


def agent_days(txns):
    def day(agent, cash_in, cash_out):
        if cash_in is not None:
            txns.add(f"{agent}-in", "10:00:00", "c1", "cash_in", cash_in, agent=agent)
        if cash_out is not None:
            txns.add(f"{agent}-out", "11:00:00", "c2", "cash_out", cash_out, agent=agent)

    day("a299", "100.00", "299.00")
    day("a300", "100.00", "300.00")
    day("a599", "100.00", "599.99")
    day("a600", "100.00", "600.00")
    day("cents", "0.10", "0.30")  # three times exactly; 0.3 / 0.1 in binary is less
    day("only_out", None, "50.00")
    day("only_in", "50.00", None)
    day("zero", "0.00", None)
    txns.add("other", "10:00:00", "c1", "bill_pay", agent="no_cash")
    txns.add("p2p", "10:00:00", "c1", "p2p_transfer", agent=None)
    return txns.frame()


def test_agent_imbalance(txns):
    df = agent_days(txns)
    expected = [
        ("a300", Decimal("3.00"), "medium"),
        ("a599", Decimal("6.00"), "medium"),
        ("a600", Decimal("6.00"), "high"),
        ("cents", Decimal("3.00"), "medium"),
        ("only_out", None, None),
        ("zero", None, None),
    ]
    assert rows(rules.agent_imbalance_flags(df), "agent_id", "rule_metric", "severity") == expected
    graded = rules.agent_imbalance_flags(df, AgentImbalance(zero_cash_in_severity="medium"))
    assert rows(graded, "agent_id", "severity") == [(a, s or "medium") for a, _, s in expected]


def test_agent_imbalance_pivot(txns, agents):
    listed = rules.agent_imbalance_pivot(agent_days(txns), agents(("a300", "R1", "standard")))
    assert rows(listed, "agent_id", "tier", "ratio", "severity") == [
        ("a300", "standard", 3.0, "medium"),
        ("a599", None, 5.9999, "medium"),
        ("a600", None, 6.0, "high"),
        ("cents", None, 0.3 / 0.1, "medium"),
        ("no_cash", None, None, "medium"),
        ("only_out", None, None, "medium"),
        ("zero", None, None, "medium"),
    ]


def trip(txns, customer, *stops):
    for i, (when, region) in enumerate(stops):
        txns.add(f"{customer}-{i}", when, customer, region=region)


def test_geo_edges(txns):
    trip(txns, "in", ("10:00:00", "R1"), ("10:45:59.999999", "R2"))
    trip(txns, "out", ("10:00:00", "R1"), ("10:46:00", "R2"))
    trip(txns, "fast", ("10:00:00", "R1"), ("10:22:59", "R2"))
    trip(txns, "slow", ("10:00:00", "R1"), ("10:23:00", "R2"))
    trip(txns, "tied", ("10:00:00", "R1"), ("10:00:00", "R2"))
    trip(txns, "between", ("10:00:00", "R1"), ("10:10:00", "R1"), ("10:20:00", "R2"))
    # The first other region is in time, a later one is too, only the first is accused.
    trip(txns, "first", ("10:00:00", "R1"), ("10:10:00", "R2"), ("10:11:00", "R3"))
    # Two rows at the next instant; the smaller id in another region is accused.
    trip(txns, "pick", ("10:00:00", "R1"), ("10:10:00", "R1"), ("10:10:00", "R3"), ("10:10:00", "R2"))
    trip(txns, "night", ("1 23:59:59.5", "R1"), ("2 00:00:00.2", "R2"))
    txns.add("no-agent", "10:00:00", "home", region="R1", agent=None)
    txns.add("no-agent-2", "10:01:00", "home", region="R2")
    df = txns.frame()
    flagged = rows(rules.geo_impossible_flags(df), *FLAG)
    assert flagged == [
        ("between-2", 10, "high"), ("between-2", 20, "high"),
        ("fast-1", 22, "high"),
        ("first-1", 10, "high"), ("first-2", 1, "high"),
        ("in-1", 45, "medium"),
        ("night-1", 0, "high"),
        ("pick-2", 10, "high"),
        ("slow-1", 23, "medium"),
    ]
    times = dict(rows(rules.geo_impossible_flags(df), "transaction_id", "txn_timestamp"))
    assert times["in-1"] == dt.datetime(2026, 1, 1, 10, 45, 59, 999999)


def test_geo_exact(txns):
    trip(txns, "in", ("10:00:00", "R1"), ("10:45:00", "R2"))
    trip(txns, "out", ("10:00:00", "R1"), ("10:45:00.000001", "R2"))
    trip(txns, "fast", ("10:00:00", "R1"), ("10:22:30", "R2"))
    trip(txns, "slow", ("10:00:00", "R1"), ("10:22:31", "R2"))
    trip(txns, "tied", ("10:00:00", "R1"), ("10:00:00", "R2"))
    assert rows(rules.geo_impossible_flags(txns.frame(), GeoImpossible(gap="exact")), *FLAG) == [
        ("fast-1", 22.5, "high"), ("in-1", 45.0, "medium"), ("slow-1", 22.5, "medium"), ("tied-1", 0.0, "high"),
    ]


def test_geo_copies(txns):
    trip(txns, "c", *[("10:00:00", "R1")] * 3, ("10:01:00", "R2"))
    df = txns.frame()
    assert rows(rules.geo_impossible_flags(df), *FLAG) == [("c-3", 1, "high")] * 3
    assert rows(rules.geo_impossible_flags(df, every_copy=False), "transaction_id", COPIES) == [("c-3", 3)]


def wake(txns, customer, silent_days, *times):
    slept = dt.datetime(2026, 1, 1, 23, 0)
    woke = dt.datetime(2026, 1, 1) + dt.timedelta(days=silent_days)
    txns.add(f"{customer}-old", slept, customer)
    for i, clock in enumerate(times):
        txns.add(f"{customer}-{i}", dt.datetime.combine(woke, dt.time.fromisoformat(clock)), customer)


def test_dormant_edges(txns):
    five = ("10:00:00", "10:10:00", "11:00:00", "12:00:00", "13:00:00")
    wake(txns, "d29", 29, *five)
    wake(txns, "d30", 30, *five)
    wake(txns, "d60", 60, *five)
    wake(txns, "late", 30, *five[:4], "13:00:00.000001")
    wake(txns, "four", 30, *five[:4])
    wake(txns, "tied", 30, *["10:00:00"] * 5)
    burst(txns, "new", *five)  # the first transaction ever ends no silence
    wake(txns, "night", 30, "23:00:00")
    for i in range(4):  # the burst goes on after midnight
        txns.add(f"night-x{i}", dt.datetime(2026, 2, 1, 1, i), "night")
    df = txns.frame()
    flagged = rows(rules.dormant_flags(df), *FLAG)
    assert flagged == (
        [("d30-0", 30, "medium")] * 5
        + [("d60-0", 60, "high")] * 5
        + [("night-0", 30, "medium")] * 5
        + [("tied-0", 30, "medium")] * 5
    )
    assert rows(rules.dormant_flags(df, every_copy=False), "transaction_id", COPIES) == [
        ("d30-0", 5), ("d60-0", 5), ("night-0", 5), ("tied-0", 5),
    ]


def test_settings_are_checked():
    for bad in (
        lambda: Velocity(window_minutes=0),
        lambda: Velocity(precision="hour"),
        lambda: Structuring(min_splits=0),
        lambda: GeoImpossible(gap="about"),
        lambda: Dormant(dormancy_days=0),
    ):
        with pytest.raises(ValueError):
            bad()


def test_exact_gap_is_rounded_as_the_binary_value(spark):
    """All whole-second gaps up to 45:00 (the rule's limit) against Python's round."""
    data, start = Transactions(spark), dt.datetime(2026, 1, 1)
    for gap in range(1, 2_701):
        data.add(f"a{gap}", start, f"C{gap}", region="R1")
        data.add(f"b{gap}", start + dt.timedelta(seconds=gap), f"C{gap}", region="R2")
    found = rules.geo_impossible_flags(data.frame(), GeoImpossible(gap="exact"))
    assert {(r.customer_id, r.rule_metric) for r in found.collect()} == {(f"C{g}", round(g / 60, 1)) for g in range(1, 2_701)}
