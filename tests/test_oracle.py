"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import os

import compare
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


PAYMENTS = sorted(set(entry.queries()) - set(entry._training_data()))


def test_every_query_has_sql():
    assert set(PAYMENTS) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", PAYMENTS)
def test_query(spark, duck, name):
    kinds, found = compare.spark_result(entry.queries()[name](spark, SF))
    expected_kinds, expected = compare.duck_result(duck, entry.oracle_sql()[name])
    assert kinds == expected_kinds
    assert found == expected


def test_entry(spark):
    assert entry.entry(spark).count() > 0
