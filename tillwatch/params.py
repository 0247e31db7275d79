"""Rule settings. The defaults are the published thresholds."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, replace
from decimal import Decimal


def _positive(**values: int) -> None:
    for name, value in values.items():
        if value < 1:
            raise ValueError(f"{name} must be at least 1, got {value}")


def _one_of(name: str, value, allowed: tuple) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {allowed}, got {value!r}")


@dataclass(frozen=True)
class Velocity:
    min_transactions: int = 4
    window_minutes: int = 20
    precision: str = "second"  # "second": whole seconds; "micro": the full timestamp

    def __post_init__(self):
        _positive(min_transactions=self.min_transactions, window_minutes=self.window_minutes)
        _one_of("precision", self.precision, ("second", "micro"))


@dataclass(frozen=True)
class Structuring:
    min_splits: int = 3
    window_minutes: int = 60
    near_limit: Decimal = Decimal("0.80")
    precision: str = "second"
    require_total_over_limit: bool = False

    def __post_init__(self):
        _positive(min_splits=self.min_splits, window_minutes=self.window_minutes)
        _one_of("precision", self.precision, ("second", "micro"))


@dataclass(frozen=True)
class AgentImbalance:
    ratio: Decimal = Decimal("3.0")
    # What an agent-day without any cash-in is graded: None keeps it NULL.
    zero_cash_in_severity: str | None = None

    def __post_init__(self):
        if self.ratio <= 0:
            raise ValueError(f"ratio must be positive, got {self.ratio}")
        _one_of("zero_cash_in_severity", self.zero_cash_in_severity, (None, "high", "medium"))


@dataclass(frozen=True)
class GeoImpossible:
    max_minutes: int = 45
    # "minute": strictly later rows, gap in truncated minutes.
    # "exact": ties count as later rows, gap in exact minutes rounded to one decimal.
    gap: str = "minute"

    def __post_init__(self):
        _positive(max_minutes=self.max_minutes)
        _one_of("gap", self.gap, ("minute", "exact"))


@dataclass(frozen=True)
class Dormant:
    dormancy_days: int = 30
    burst_count: int = 5
    window_hours: int = 3

    def __post_init__(self):
        _positive(dormancy_days=self.dormancy_days, burst_count=self.burst_count,
                  window_hours=self.window_hours)


@dataclass(frozen=True)
class RuleSettings:
    velocity: Velocity = field(default_factory=Velocity)
    structuring: Structuring = field(default_factory=Structuring)
    agent_imbalance: AgentImbalance = field(default_factory=AgentImbalance)
    geo_impossible: GeoImpossible = field(default_factory=GeoImpossible)
    dormant: Dormant = field(default_factory=Dormant)

    def to_the_microsecond(self) -> RuleSettings:
        """The same thresholds on exact times, as the analyst's read-outs use them."""
        return replace(
            self,
            velocity=replace(self.velocity, precision="micro"),
            structuring=replace(self.structuring, precision="micro"),
            geo_impossible=replace(self.geo_impossible, gap="exact"),
        )


def settings_from_json(text: str) -> RuleSettings:
    """Settings from a JSON object of rules, each an object of its parameters."""
    given, rules = json.loads(text, parse_float=Decimal), {f.name: f.default_factory for f in fields(RuleSettings)}
    if unknown := sorted(set(given) - set(rules)):
        raise ValueError(f"no such rule: {unknown}")

    def typed(rule: type, name: str, value):
        return Decimal(value) if isinstance(getattr(rule, name, None), Decimal) else value

    return RuleSettings(
        **{rule: rules[rule](**{k: typed(rules[rule], k, v) for k, v in own.items()}) for rule, own in given.items()}
    )
