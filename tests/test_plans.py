"""What the physical plans of the registered queries must and must not contain."""

from __future__ import annotations

import datetime as dt
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillwatch.operators import quality, rules, staging
from tillwatch.operators.copies import BLOCK, repeat_rows
from tillwatch.operators.quality import Check
from tillwatch.plans import checks
from tillwatch.plans.models import Models, write_all, write_readouts
from tillwatch.sources.feed import split_labels
from tillwatch.sources.star import SCHEMAS, StarFeed
from tillwatch.sources.store import Store, as_files, fact_layout, write_fact

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonRDD", "MapInPandas")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def models(spark):
    return entry._models(spark, SF)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry._training_data())))
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert not [node for node in FORBIDDEN if node in text]


def test_dedupe_keeps_one_copy_before_the_shuffle(models):
    text = plan(models.stg_transactions)
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_filters_and_columns_reach_the_scan(spark, models, tmp_path):
    path = str(tmp_path / "staged")
    models.stg_transactions.write.parquet(path)
    staged = spark.read.parquet(path)

    imbalance = plan(rules.agent_imbalance_flags(staged))
    assert "IsNotNull(agent_id)" in imbalance and "In(txn_type, [cash_in,cash_out])" in imbalance
    assert "ReadSchema: struct<txn_date:date,agent_id:string,txn_type:string,amount:decimal(14,2)>" in imbalance

    velocity = plan(rules.velocity_flags(staged))
    assert "amount" not in " ".join(re.findall(r"ReadSchema: struct<[^>]*>", velocity))

    structuring = plan(rules.structuring_flags(staged, models.stg_customers))
    assert "EqualTo(txn_type,p2p_transfer)" in structuring
    assert "GreaterThanOrEqual(amount,800" in structuring


def test_kept_instants_are_broadcast_by_size(spark, models, tmp_path):
    path = str(tmp_path / "staged")
    models.stg_transactions.write.parquet(path)
    flagged = rules.velocity_flags(spark.read.parquet(path), keep=Store(spark).keep)
    text = plan(flagged)
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_the_running_sum_reuses_its_partitioning(spark, models):
    text = plan(rules.velocity_flags(models.stg_transactions))
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id#\d+, slice#\d+L?", text)) == 1


def test_fact_store_prunes_days(spark, models, tmp_path):
    fact = write_fact(models.fct_transactions, str(tmp_path / "fact"))
    assert fact.columns == models.fct_transactions.columns
    text = plan(fact.where(F.col("txn_date") == F.lit("2024-01-05").cast("date")))
    assert re.search(r"PartitionFilters: \[[^]]*txn_date", text)


def test_sparse_join_is_not_folded_away(spark, models):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert re.search(r"hashpartitioning\(agent_id#\d+, _spread#\d+L?", plan(models.fct_transactions))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_latest_copy_keeps_the_schema(models):
    raw = models.feed.transactions
    assert staging.latest_copy(raw).columns == raw.columns


def final_plan(df) -> str:
    """The plan after the run; Spark plans again while it runs."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_one_scan_of_a_relation_for_all_checks(spark, models, tmp_path):
    tables = {}
    for name in ("agents", "customers", "transactions"):
        getattr(models.feed, name).write.parquet(str(tmp_path / name))
        tables[f"raw.{name}"] = spark.read.parquet(str(tmp_path / name))
    every = [
        *checks._unique(tables), *[Check("not_null", r, c) for r in tables for c in checks.REQUIRED[r]], *checks._references()
    ]
    text = final_plan(quality.offences(tables, every))
    assert text.count("Scan parquet") == 3
    assert len(re.findall(r"(?<!Reused)Exchange ", text)) == 1
    assert "Join" not in text


def test_both_gaps_share_their_scans(spark, models, tmp_path):
    path = str(tmp_path / "staged")
    models.stg_transactions.write.parquet(path)
    seen = []

    def keep(df, name):
        seen.append(df)
        return df

    rules.geo_of_both_gaps(spark.read.parquet(path), entry.SETTINGS.geo_impossible, keep)
    text, one = final_plan(seen[0]), final_plan(rules.geo_impossible_flags(spark.read.parquet(path), every_copy=False))
    assert text.count("Scan parquet") == one.count("Scan parquet") and text.count("ReusedExchange") >= 2


class RecordingStore(Store):
    """Remembers the plans and files of what it keeps."""

    def __init__(self, spark):
        super().__init__(spark)
        self.kept = []

    def keep(self, df, name):
        self.kept.append((name, plan(df), " ".join(df.inputFiles())))
        return super().keep(df, name)


def test_the_job_joins_each_rules_starts_once(spark, tmp_path):
    kept = RecordingStore(spark)
    settings = (entry.SETTINGS, entry.AS_OF, entry.ALERT_CREATED_AT, kept)
    models = Models(entry._feed(spark, SF), *settings)
    write_all(models, str(tmp_path))
    write_readouts(models, str(tmp_path))
    names = [name for name, _, _ in kept.kept]
    assert len(names) == len(set(names)), "nothing is kept twice"
    plans = {name: text for name, text, _ in kept.kept}
    # The union of the flags reads what was written, and so do the analyst's flags.
    assert "Join" not in plans["flags"] and "Window" not in plans["flags"]
    for rule in ("velocity", "structuring"):
        assert [name for name, _, files in kept.kept if f"{rule}_starts" in files] == [f"{rule}_edges"]
    kept.clear()


@pytest.fixture
def star(spark, tmp_path):
    """Star tables with repeated, missing and null keys."""
    moment = dt.datetime(2024, 1, 1)
    tables = {
        "region": [(0, "R0"), (1, "R1")],
        "nation": [(n, f"N{n}", n % 2) for n in range(4)],
        "customer": [(k, "c", 0 if k is None else k % 4, 1.0, "m") for k in (0, 1, 1, 2, 2, 2, 3, None, None)],
        "supplier": [(k, "s", 0 if k is None else k % 4, 1.0) for k in (0, 1, 2, 2, None, None)],
        "events": [
            (i, moment + dt.timedelta(hours=i), (*range(6), None)[i // 3 % 7], ("click", "view", "purchase", "error")[i % 4], 5.0, f'{{"k": {i}}}')
            for i in range(100)
        ],
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, SCHEMAS[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    return StarFeed(spark, str(tmp_path))


def test_labels_are_those_of_the_joined_transactions(star):
    def counted(df):
        return Counter(map(tuple, df.collect()))

    found = counted(star.ground_truth)
    assert found == counted(split_labels(star.labelled_transactions)[1]) and max(found.values()) == 6


def test_labels_are_read_without_the_dimensions(star):
    """The events meet neither dimension, only the repeated keys, and stay where they are."""
    text = final_plan(star.ground_truth)
    assert "customer.parquet" not in text and "hashpartitioning" not in text and "region.parquet" not in text


@pytest.mark.parametrize(("asked", "kept_gap"), [("flags", "geo_minute"), ("analyst_flags", "geo_exact")])
def test_one_flag_set_computes_one_gap(star, spark, asked, kept_gap):
    kept = RecordingStore(spark)
    getattr(Models(star, entry.SETTINGS, entry.AS_OF, entry.ALERT_CREATED_AT, kept), asked)
    assert [name for name, _, _ in kept.kept if name.startswith("geo")] == [kept_gap]
    kept.clear()


def test_only_crowded_rows_are_dealt_out(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", BLOCK), ("c", 3 * BLOCK)], "id string, copies long")
    df.write.parquet(str(tmp_path / "flags"))
    text = final_plan(repeat_rows(spark.read.parquet(str(tmp_path / "flags"))))
    (exchange,) = re.findall(r"(?<!Reused)Exchange hashpartitioning\(xxhash64.*", text)
    below = text[text.index(exchange) :]
    assert f"GreaterThan(copies,{BLOCK})" in below and f"LessThanOrEqual(copies,{BLOCK})" in text[: text.index(exchange)]


def test_nothing_is_joined_for_crowded_rows_where_there_are_none(spark, models, tmp_path):
    spark.createDataFrame([("a", 1), ("b", 2)], "id string, copies long").write.parquet(str(tmp_path / "flags"))
    spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("more")).write.parquet(str(tmp_path / "about"))
    about = spark.read.parquet(str(tmp_path / "about"))
    text = final_plan(repeat_rows(spark.read.parquet(str(tmp_path / "flags")), lambda rows: rows.join(about, "id")))
    assert text.count("Join") == 1


def test_the_facts_are_joined_once_as_they_are_written(spark, tmp_path):
    models = Models(entry._feed(spark, SF), entry.SETTINGS, entry.AS_OF, entry.ALERT_CREATED_AT, Store(spark))
    models.__dict__["transaction_velocity_daily"] = as_files(models.transaction_velocity_daily, str(tmp_path / "daily"))
    text = final_plan(fact_layout(models.fct_transactions, models.day_rows))
    assert len(re.findall(r"FileScan parquet \[transaction_id[^]]*txn_hour", text)) == 1
    assert "RangePartitioning" not in text and "rangepartitioning" not in text
    models.store.clear()
