"""Data-quality checks.

A check returns the offending values with their number of rows, grouped before anything else is
done with them: one broken value in a billion rows is one row. The reports count offences per
column, zeros included.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _offences(df: DataFrame, check: str, relation: str, column: str) -> DataFrame:
    return df.select(
        F.lit(check).alias("check_name"),
        F.lit(relation).alias("relation"),
        F.lit(column).alias("column_name"),
        F.col("value").cast("string").alias("offending_value"),
        F.col("rows").alias("row_count"),
    )


def _by_value(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))


def not_unique(df: DataFrame, relation: str, column: str) -> DataFrame:
    repeated = _by_value(df.where(F.col(column).isNotNull()), column).where("rows > 1")
    return _offences(repeated, "unique", relation, column)


def is_null(df: DataFrame, relation: str, column: str) -> DataFrame:
    return _offences(_by_value(df.where(F.col(column).isNull()), column), "not_null", relation, column)


def not_accepted(df: DataFrame, relation: str, column: str, accepted: Iterable[str]) -> DataFrame:
    """Values outside the list. NULL passes."""
    wrong = _by_value(df.where(~F.col(column).isin(*accepted)), column)
    return _offences(wrong, "accepted_values", relation, column)


def orphans(child: DataFrame, relation: str, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Values without a parent. NULL passes.

    Grouped before the join, so a value that most rows share is one row in it.
    """
    used = _by_value(child.where(F.col(column).isNotNull()), column)
    known = parent.select(F.col(key).alias("value"))
    return _offences(used.join(known, "value", "left_anti"), "foreign_key", relation, column)


def malformed(rejected: DataFrame) -> DataFrame:
    """The lines that could not be read, as offences of their relation."""
    lines = rejected.groupBy("relation", F.col("line").alias("value")).agg(F.count("*").alias("rows"))
    return lines.select(
        F.lit("well_formed").alias("check_name"),
        "relation",
        F.lit(None).cast("string").alias("column_name"),
        F.col("value").alias("offending_value"),
        F.col("rows").alias("row_count"),
    )


def violations(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def report(checks: Mapping[tuple[str, str], DataFrame], count_rows: bool = False) -> DataFrame:
    """Offending values (or their rows) per (relation, column)."""
    counted = F.coalesce(F.sum("row_count"), F.lit(0)) if count_rows else F.count("*")
    lines = [
        found.agg(counted.alias("violations")).select(
            F.lit(relation).alias("relation"), F.lit(column).alias("column_name"), "violations"
        )
        for (relation, column), found in checks.items()
    ]
    return reduce(DataFrame.unionByName, lines)


def nulls(df: DataFrame, relation: str, columns: Iterable[str]) -> DataFrame:
    """A line for each of the columns that holds NULLs, from one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (
        counts.unpivot([], list(columns), "column_name", "row_count")
        .where("row_count > 0")
        .select(
            F.lit("not_null").alias("check_name"),
            F.lit(relation).alias("relation"),
            "column_name",
            F.lit(None).cast("string").alias("offending_value"),
            "row_count",
        )
    )


def null_report(relations: Mapping[str, tuple[DataFrame, Iterable[str]]]) -> DataFrame:
    """NULLs per column, all columns of a relation in one scan."""
    return _one_scan_report(relations, lambda c: F.col(c).isNull())


def accepted_report(relations: Mapping[str, tuple[DataFrame, Mapping[str, Iterable[str]]]]) -> DataFrame:
    """Rows outside the accepted values per column, all columns of a relation in one scan."""
    lines = []
    for relation, (df, accepted) in relations.items():
        lines.append(
            _one_scan_report({relation: (df, accepted)}, lambda c, a=accepted: ~F.col(c).isin(*a[c]))
        )
    return reduce(DataFrame.unionByName, lines)


def _one_scan_report(relations, wrong) -> DataFrame:
    lines = []
    for relation, (df, columns) in relations.items():
        counts = df.agg(*[F.count_if(wrong(c)).alias(c) for c in columns])
        lines.append(
            counts.unpivot([], list(columns), "column_name", "violations").select(
                F.lit(relation).alias("relation"), "column_name", "violations"
            )
        )
    return reduce(DataFrame.unionByName, lines)


# --- many checks at once ----------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A check of one column: `unique`, `not_null`, `accepted_values` or `foreign_key`."""

    name: str
    relation: str
    column: str
    accepted: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None

    @property
    def keys(self) -> tuple[str, str]:
        """The (relation, column) whose values are the keys that the check is about."""
        return self.parent or (self.relation, self.column)


def offences(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """The offending values of all checks, from one scan of each relation, one shuffle and no join.

    Each row of a relation contributes (group, side, value) facts, which are counted per group and value,
    first within the map tasks. A unique column is a group, and the columns that refer to it are in
    the same one, each on a side of its own: a key counted twice is not unique, and a value with references
    but no key is an orphan. NULLs and values that are not accepted are facts only where they occur.

    A filter of the parents' keys (a Bloom filter) in front of a join would not be exact here: what passes it may be
    a false positive, so all that passes had to be joined too.
    """
    keyed = sorted({c.keys for c in checks if c.name in ("unique", "foreign_key")})
    groups = {keys: i for i, keys in enumerate(keyed)}
    sides: dict[tuple[str, str], list[int]] = {keys: [] for keys in keyed}
    facts: dict[str, list[Column]] = {}

    def fact(relation: str, when: Column, group: int, side: int, value: Column) -> None:
        entry = F.struct(
            F.lit(group).alias("group"), F.lit(side).alias("side"), value.cast("string").alias("value")
        )
        facts.setdefault(relation, []).append(F.when(when, entry))

    for (relation, column), group in groups.items():
        fact(relation, F.col(column).isNotNull(), group, 0, F.col(column))
    found = []
    for number, check in enumerate(checks):
        column = F.col(check.column)
        if check.name == "unique":
            found.append((groups[check.keys], F.col("side_0") > 1, F.col("side_0")))
        elif check.name == "foreign_key":
            sides[check.keys].append(number)
            side = len(sides[check.keys])
            fact(check.relation, column.isNotNull(), groups[check.keys], side, column)
            found.append((groups[check.keys], (F.col("side_0") == 0) & (F.col(f"side_{side}") > 0), F.col(f"side_{side}")))
        else:
            wrong = column.isNull() if check.name == "not_null" else ~column.isin(*check.accepted)
            fact(check.relation, wrong, len(groups) + number, 0, column)
            found.append((len(groups) + number, F.lit(True), F.col("side_0")))

    each = [
        tables[relation].select(F.explode(F.filter(F.array(*own), lambda e: e.isNotNull())).alias("e")).select("e.*")
        for relation, own in facts.items()
    ]
    most = max(map(len, sides.values()), default=0)
    counted = (
        reduce(DataFrame.unionByName, each)
        .groupBy("group", "value")
        .agg(*[F.count_if(F.col("side") == i).alias(f"side_{i}") for i in range(most + 1)])
        # One key, however often referred to, is as it should be.
        .where((F.col("group") >= len(groups)) | (F.col("side_0") != 1))
    )
    entries = [
        F.when(
            (F.col("group") == group) & wrong,
            F.struct(
                F.lit(check.name).alias("check_name"),
                F.lit(check.relation).alias("relation"),
                F.lit(check.column).alias("column_name"),
                F.col("value").alias("offending_value"),
                rows.alias("row_count"),
            ),
        )
        for check, (group, wrong, rows) in zip(checks, found, strict=True)
    ]
    offending = F.filter(F.array(*entries), lambda e: e.isNotNull())
    return counted.select(F.explode(offending).alias("e")).select("e.*")


def counted_report(tables: Mapping[str, DataFrame], checks: Sequence[Check], count_rows: bool = False) -> DataFrame:
    """Offending values (or their rows) per (relation, column) of the checks, zeros included."""
    lines = F.array(*[F.struct(F.lit(c.relation).alias("relation"), F.lit(c.column).alias("column_name")) for c in checks])
    found = offences(tables, checks)
    spark = found.sparkSession
    none = spark.range(1).select(F.explode(lines).alias("line"), F.lit(0).cast("long").alias("violations")).select("line.*", "violations")
    one = F.col("row_count") if count_rows else F.lit(1).cast("long")
    return (
        found.select("relation", "column_name", one.alias("violations"))
        .unionByName(none)
        .groupBy("relation", "column_name")
        .agg(F.sum("violations").alias("violations"))
    )
