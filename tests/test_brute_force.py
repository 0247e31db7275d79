"""The rules on crowded random data, against definitions written as loops.

Times are drawn from few instants, so many rows tie; one customer owns a third of all rows.
"""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from conftest import Transactions, rows

from tillwatch.operators import rules
from tillwatch.params import Dormant, GeoImpossible, Structuring, Velocity

START = dt.datetime(2026, 1, 1, 23, 30)
MICRO = dt.timedelta(microseconds=1)


def crowd(spark, seed: int, grain_us: int, span_s: int, n: int = 360, customers: int = 8):
    """Rows over `span_s` seconds at multiples of `grain_us` microseconds."""
    draw = random.Random(seed)
    txns = Transactions(spark)
    for i in draw.sample(range(n), n):
        who = "hot" if draw.random() < 1 / 3 else f"c{draw.randrange(customers)}"
        when = START + dt.timedelta(microseconds=draw.randrange(0, span_s * 1_000_000, grain_us))
        region = draw.choice(["R1"] * draw.choice((1, 5)) + ["R2", "R3"])
        agent = None if draw.random() < 0.2 else "AGT00000"
        txns.add(f"t{i:04d}", when, who, "p2p_transfer", draw.choice(("500.00", "850.00", "990.00")), region, agent)
    return txns


def by_customer(txns):
    groups: dict[str, list] = {}
    for r in txns.rows:
        groups.setdefault(r[2], []).append(r)
    return groups.values()


def whole(ts):
    return ts.replace(microsecond=0)


def crowded(group, span, at_least, clock):
    for a in group:
        n = sum(clock(a[1]) <= clock(b[1]) <= clock(a[1]) + span for b in group)
        if n >= at_least:
            yield a[0], n, "high" if n >= 2 * at_least else "medium"


SHAPES = [
    # whole seconds, many ties
    pytest.param(1, 60_000_000, 4_000, id="minutes"),
    # sub-second instants within few seconds: ties and edges within a second
    pytest.param(2, 250_000, 90, id="quarter-seconds"),
    pytest.param(3, 1, 4_000, id="microseconds"),
    # several days, so that many slices meet
    pytest.param(4, 400_000_000, 400_000, id="days"),
]


@pytest.mark.parametrize("seed, grain, span", SHAPES)
@pytest.mark.parametrize("precision", ["second", "micro"])
def test_velocity(spark, seed, grain, span, precision):
    txns = crowd(spark, seed, grain, span)
    minutes = 1 if span < 100 else 20 if span < 5_000 else 2_000
    clock = whole if precision == "second" else (lambda ts: ts)
    expected = sorted(
        f for g in by_customer(txns) for f in crowded(g, dt.timedelta(minutes=minutes), 4, clock)
    )
    rule = Velocity(window_minutes=minutes, precision=precision)
    found = rows(rules.velocity_flags(txns.frame(), rule), "transaction_id", "rule_metric", "severity")
    assert expected and found == expected


@pytest.mark.parametrize("seed, grain, span", SHAPES)
def test_structuring(spark, customers, seed, grain, span):
    txns = crowd(spark, seed, grain, span)
    minutes = 1 if span < 100 else 60 if span < 5_000 else 3_000
    groups = [[r for r in g if 800 <= r[6] <= 1000] for g in by_customer(txns)]
    expected = sorted(f for g in groups for f in crowded(g, dt.timedelta(minutes=minutes), 3, whole))
    who = customers(*[(c, "tier_1") for c in {r[2] for r in txns.rows}])
    rule = Structuring(window_minutes=minutes)
    found = rows(rules.structuring_flags(txns.frame(), who, rule), "transaction_id", "rule_metric", "severity")
    assert expected and found == expected


def accused(group, exact):
    """(accused id, metric, severity) for every accusing row."""
    group = [r for r in group if r[3]]
    for a in group:
        if exact:
            later = [b for b in group if b[7] != a[7] and (b[1], b[7]) > (a[1], a[7])]
            order = lambda b: (b[1], b[7], b[0])
        else:
            later = [b for b in group if b[7] != a[7] and b[1] > a[1]]
            order = lambda b: (b[1], b[0])
        if not later:
            continue
        b = min(later, key=order)
        us = (b[1] - a[1]) // MICRO
        if exact and us <= 45 * 60_000_000:
            yield b[0], "high" if 2 * us <= 45 * 60_000_000 else "medium"
        if not exact and us // 60_000_000 <= 45:
            yield b[0], us // 60_000_000, "high" if us // 60_000_000 <= 22 else "medium"


@pytest.mark.parametrize("seed, grain, span", SHAPES)
@pytest.mark.parametrize("gap", ["minute", "exact"])
def test_geo(spark, seed, grain, span, gap):
    txns = crowd(spark, seed, grain, span)
    expected = sorted((f for g in by_customer(txns) for f in accused(g, gap == "exact")), key=repr)
    columns = ("transaction_id", "severity") if gap == "exact" else ("transaction_id", "rule_metric", "severity")
    found = rows(rules.geo_impossible_flags(txns.frame(), GeoImpossible(gap=gap)), *columns)
    assert expected and found == expected


def bursts(group, rule):
    group = sorted(group, key=lambda r: (r[1], r[0]))
    for before, r in zip(group, group[1:], strict=False):
        silent = (r[1].date() - before[1].date()).days
        if silent < rule.dormancy_days:
            continue
        n = sum(r[1] <= b[1] <= r[1] + dt.timedelta(hours=rule.window_hours) for b in group)
        if n >= rule.burst_count:
            yield from [(r[0], silent, "high" if silent >= 2 * rule.dormancy_days else "medium")] * n


@pytest.mark.parametrize("rule", [Dormant(1, 2, 3), Dormant(1, 3, 60), Dormant(2, 2, 24)])
def test_dormant(spark, rule):
    txns = crowd(spark, 5, 3_600_000_000, 5_000_000, n=400, customers=24)
    expected = sorted((f for g in by_customer(txns) for f in bursts(g, rule)), key=repr)
    found = rows(rules.dormant_flags(txns.frame(), rule), "transaction_id", "rule_metric", "severity")
    assert expected and Counter(found) == Counter(expected)
