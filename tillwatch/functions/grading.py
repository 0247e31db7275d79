"""Severity grades, KYC limits and safe ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwatch.schemas import KYC_SINGLE_LIMITS, SEVERITY_RANK


def graded(metric: Column, threshold) -> Column:
    """medium from the threshold on, high from twice the threshold on, else NULL."""
    return F.when(metric >= F.lit(threshold * 2), "high").when(metric >= F.lit(threshold), "medium")


def severity_rank(severity: Column) -> Column:
    rank = F.lit(0)
    for name, value in SEVERITY_RANK.items():
        rank = F.when(severity == name, F.lit(value)).otherwise(rank)
    return rank


def severity_name(rank: Column) -> Column:
    name = F.lit("low")
    for label, value in SEVERITY_RANK.items():
        name = F.when(rank == value, F.lit(label)).otherwise(name)
    return name


def single_limit(kyc_tier: Column) -> Column:
    """Largest single transaction a tier may send; NULL for an unknown tier."""
    limit = F.lit(None).cast("int")
    for tier, value in KYC_SINGLE_LIMITS.items():
        limit = F.when(kyc_tier == tier, F.lit(value)).otherwise(limit)
    return limit


def ratio(numerator: Column, denominator: Column) -> Column:
    """NULL where the denominator is zero; ANSI mode would raise on `/`."""
    return F.try_divide(numerator, denominator)
