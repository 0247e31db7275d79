"""Files in, tables out."""

from __future__ import annotations

import datetime as dt
import gzip
import os
import signal
import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import compare
import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillwatch.__main__ import landed, run
from tillwatch.functions.timekeys import epoch_micros, epoch_seconds, from_epoch_micros
from tillwatch.params import AgentImbalance, RuleSettings, Structuring, settings_from_json
from tillwatch.plans.models import TABLES, Models, write_all, write_readouts
from tillwatch.sources import feed as feeds
from tillwatch.sources import store
from tillwatch.sources.feed import Feed
from tillwatch.sources.releases import Releases

LOADED = dt.datetime(2026, 3, 1)
FEED = """transaction_id,timestamp,customer_id,agent_id,counterparty_customer_id,txn_type,amount,region
TXN_1,2026-01-01T14:03:22,CUS0000001,AGT00001,,cash_in,120.50,North
TXN_2,2026-03-08T02:30:00,CUS0000001,,CUS0000002,p2p_transfer,20.00,North
"""
TRUTH = """transaction_id,is_fraud,fraud_pattern
TXN_1,True,cycling
TXN_2,False,
"""


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "agents.csv").write_text(
        "agent_id,agent_name,region,tier,registration_date,opening_cash_float\n"
        "AGT00001,Agent 00001,North,standard,2025-01-10,60550.08\n"
    )
    (tmp_path / "customers.csv").write_text(
        "customer_id,kyc_tier,home_region,registration_date\n"
        "CUS0000001,tier_1,North,2025-01-10\nCUS0000002,tier_2,South,2025-02-10\n"
    )
    (tmp_path / "transactions.csv.gz").write_bytes(gzip.compress(FEED.encode()))
    (tmp_path / "fraud_ground_truth.csv.gz").write_bytes(gzip.compress(TRUTH.encode()))
    return tmp_path


def read(spark, folder) -> Feed:
    return Feed(
        feeds.read_agents(spark, str(folder / "agents.csv"), LOADED),
        feeds.read_customers(spark, str(folder / "customers.csv"), LOADED),
        feeds.read_transactions(spark, str(folder / "transactions.csv.gz"), LOADED, partitions=4),
        feeds.read_ground_truth(spark, str(folder / "fraud_ground_truth.csv.gz")),
    )


def test_csv_feed(spark, folder):
    feed = read(spark, folder)
    assert rows(feed.agents) == [
        ("AGT00001", "Agent 00001", "North", "standard", dt.date(2025, 1, 10), Decimal("60550.08"), LOADED)
    ]
    assert rows(feed.customers)[1] == ("CUS0000002", "tier_2", "South", dt.date(2025, 2, 10), LOADED)
    # 02:30 on that day does not exist in the session's time zone and must stay as it is.
    assert rows(feed.transactions) == [
        ("TXN_1", dt.datetime(2026, 1, 1, 14, 3, 22), "CUS0000001", "AGT00001", None, "cash_in", Decimal("120.50"), "North", LOADED),
        ("TXN_2", dt.datetime(2026, 3, 8, 2, 30), "CUS0000001", None, "CUS0000002", "p2p_transfer", Decimal("20.00"), "North", LOADED),
    ]
    assert rows(feed.ground_truth) == [("TXN_1", True, "cycling"), ("TXN_2", False, None)]
    assert feeds.read_ground_truth(spark, str(folder / "missing.csv.gz")) is None
    stamped = feeds.read_agents(spark, str(folder / "agents.csv")).first()["loaded_at"]
    assert isinstance(stamped, dt.datetime)


def test_csv_with_other_columns_is_refused(spark, folder):
    (folder / "customers.csv").write_text("customer_id,home_region,kyc_tier,registration_date\nc,North,tier_1,2025-01-10\n")
    with pytest.raises(Exception, match="(?i)header"):
        feeds.read_customers(spark, str(folder / "customers.csv")).collect()
    (folder / "agents.csv").write_text(
        "agent_id,agent_name,region,tier,registration_date,opening_cash_float\nA,B,C,D,not a date,1.00\n"
    )
    with pytest.raises(Exception, match="(?i)malformed"):
        feeds.read_agents(spark, str(folder / "agents.csv")).collect()


def test_label_split_and_time_order(spark):
    labelled = spark.createDataFrame(
        [("b", dt.datetime(2026, 1, 2), True, "cycling"), ("a", dt.datetime(2026, 1, 1), False, None)],
        "transaction_id string, txn_timestamp timestamp_ntz, is_fraud boolean, fraud_pattern string",
    )
    feed, truth = feeds.split_labels(labelled)
    assert feed.columns == ["transaction_id", "txn_timestamp"]
    assert truth.columns == ["transaction_id", "is_fraud", "fraud_pattern"]
    assert [r[0] for r in feeds.in_time_order(feed).collect()] == ["a", "b"]


def test_time_keys(spark):
    times = [
        dt.datetime(2026, 3, 8, 2, 30, 0, 123456),
        dt.datetime(2026, 11, 1, 1, 30, 0, 700000),
        dt.datetime(1969, 12, 31, 23, 59, 59, 500000),
        dt.datetime(2262, 1, 1, 0, 0, 0, 999999),
    ]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    epoch = dt.datetime(1970, 1, 1)
    for t, s, us, back in df.select(
        "ts", epoch_seconds(F.col("ts")), epoch_micros(F.col("ts")), from_epoch_micros(epoch_micros(F.col("ts")))
    ).collect():
        assert us == (t - epoch) // dt.timedelta(microseconds=1)
        assert s == (t - epoch) // dt.timedelta(seconds=1)
        assert back == t


def test_views_tables_and_files(spark, tmp_path):
    df = spark.range(3)
    assert store.as_view(df, "three").count() == 3
    assert store.as_files(df, str(tmp_path / "three")).count() == 3
    try:
        assert store.as_table(df, "three_table").count() == 3
    finally:
        spark.sql("DROP TABLE IF EXISTS three_table")


def test_store_uses_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert store.shared_folder(spark) == named
    kept = store.Store(spark).keep(spark.range(5), "five")
    assert kept.count() == 5
    assert all(named in f for f in kept.inputFiles())


def test_store_can_be_cleared(spark):
    kept = store.Store(spark)
    folder = kept.folder("mine")
    spark.range(2).write.parquet(folder)
    kept.clear()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folder)


def test_outdated_results_can_be_dropped(spark):
    kept = store.Store(spark)
    steps = [kept.keep(spark.range(n), "step").inputFiles()[0].rsplit("/", 1)[0] for n in range(1, 4)]
    other = kept.keep(spark.range(7), "other")
    kept.drop("step", but=1)
    for gone in steps[:2]:
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(gone)
    assert spark.read.parquet(steps[2]).count() == 3 and other.count() == 7
    kept.drop("nothing")
    kept.drop("step")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(steps[2])
    assert other.count() == 7


def test_write_all(spark, folder, tmp_path):
    models = Models(read(spark, folder), as_of=dt.date(2026, 3, 1), alert_created_at=LOADED, store=store.Store(spark))
    written = write_all(models, str(tmp_path / "out"))
    assert set(written) == {*TABLES, "fct_transactions", "fraud_rule_evaluation"}
    assert written["fct_transactions"].count() == 2
    assert written["dim_agents"].first()["agent_tenure_days"] == 415
    assert rows(written["fraud_rule_evaluation"])[0] == (2, 1, 0, 0, 0, 1, 0.0, None)


def test_run_over_a_folder(spark, folder, tmp_path):
    (folder / "fraud_ground_truth.csv.gz").unlink()
    written = run(spark, str(folder), str(tmp_path / "out"), as_of=dt.date(2026, 3, 1), read_partitions=2)
    by_flags = {"kpis", "alert_queue", "alerts_by_rule"}
    readouts = {"daily_volume_by_type", "value_by_region", "imbalance_list", "busiest_agents", "combined_flags_exact", "alert_summary_exact"}
    readouts |= by_flags | {f"{name}_all_rules" for name in by_flags}
    assert set(written) == {*TABLES, "fct_transactions", "dq_violations", *readouts}
    assert written["kpis"].first()["total_transactions"] == 2
    assert written["dim_customers"].count() == 2
    assert written["dq_violations"].count() == 0


def test_run_reads_out_labels(spark, folder, tmp_path):
    written = run(spark, str(folder), str(tmp_path / "out"), as_of=dt.date(2026, 3, 1))
    assert rows(written["recall_by_pattern"]) == [("cycling", 1, 0, 0.0)]
    assert rows(written["validation_metrics"]) == [(0.0, 0.0, 0)]


def test_run_over_many_files_with_other_rules(spark, folder, tmp_path):
    (folder / "transactions.csv.gz").unlink()
    (folder / "transactions").mkdir()
    header, *lines = FEED.splitlines()
    for i, line in enumerate(lines):
        with gzip.open(folder / "transactions" / f"part-{i}.csv.gz", "wt") as out:
            out.write(f"{header}\n{line}\n")
    settings = settings_from_json('{"velocity": {"min_transactions": 1, "window_minutes": 5}}')
    written = run(spark, str(folder), str(tmp_path / "out"), as_of=dt.date(2026, 3, 1), settings=settings)
    assert written["fct_transactions"].count() == 2
    assert written["fr_velocity_flags"].count() == 2


def test_settings_from_json():
    found = settings_from_json('{"agent_imbalance": {"ratio": 4}, "structuring": {"near_limit": 0.9}}')
    assert found == RuleSettings(
        agent_imbalance=AgentImbalance(ratio=Decimal(4)), structuring=Structuring(near_limit=Decimal("0.9"))
    )
    assert settings_from_json("{}") == RuleSettings()
    with pytest.raises(ValueError, match="no such rule"):
        settings_from_json('{"speed": {}}')
    with pytest.raises(TypeError):
        settings_from_json('{"velocity": {"minutes": 3}}')
    with pytest.raises(ValueError):
        settings_from_json('{"velocity": {"window_minutes": 0}}')


def test_a_failed_run_leaves_nothing_behind(spark, folder, tmp_path):
    shared = Path(spark.conf.get("spark.checkpoint.dir")) / "tillwatch"
    before = {p for p in shared.glob("raw_*")}
    with gzip.open(folder / "transactions.csv.gz", "wt") as out:
        out.write(FEED + "TXN_3,not a time,CUS0000001,,,bill_pay,1.00,North\n")
    with pytest.raises(Exception, match="(?i)malformed|cast|parse"):
        run(spark, str(folder), str(tmp_path / "out"))
    assert {p for p in shared.glob("raw_*")} == before


def test_models_without_labels(spark, folder):
    feed = read(spark, folder)
    unlabelled = Models(Feed(feed.agents, feed.customers, feed.transactions))
    with pytest.raises(ValueError, match="labels"):
        unlabelled.fraud_rule_evaluation


def test_write_all_agrees_with_the_lazy_models(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    written = write_all(entry._models(spark, sf, store=True), str(tmp_path / "out"))
    lazy = entry._models(spark, sf)
    for name in ("fr_velocity_flags", "fr_geo_impossible_flags", "fr_dormant_reactivation_flags", "fraud_alerts", "fraud_alert_summary", "fct_transactions"):
        assert rows(written[name]) == rows(getattr(lazy, name).select(*written[name].columns)), name


#: The job's read-outs whose queries have other names.
QUERY_OF = {"alert_queue": "alert_queue_top200", "busiest_agents": "top20_agents", "alert_queue_all_rules": "alert_queue_top200_all_rules"}


def test_the_jobs_read_outs_equal_the_queries(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    models = Models(entry._feed(spark, sf), entry.SETTINGS, as_of=entry.AS_OF, alert_created_at=entry.ALERT_CREATED_AT, store=store.Store(spark))
    write_all(models, str(tmp_path / "out"))
    written = write_readouts(models, str(tmp_path / "out"))
    assert len(written) == 18
    con = compare.connect(sf)
    for name in written:
        df = entry._plain(spark.read.parquet(str(tmp_path / "out" / "readouts" / name)))
        sql = entry.oracle_sql()[QUERY_OF.get(name, name)]
        assert compare.spark_result(df) == compare.duck_result(con, sql), name
    models.store.clear()


# --- releases -------------------------------------------------------------------------------


def snapshot(release):
    return {name: rows(release.read(name)) for name in release.tables}


def test_a_run_is_published_as_a_whole(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    releases = Releases(spark, out)
    assert releases.release() is None and releases.numbers() == []
    written = run(spark, str(folder), out, as_of=dt.date(2026, 3, 1))
    first = releases.release()
    assert first.number == 1 and len(first.tables) == len(written)
    assert rows(first.read("dim_customers")) == rows(written["dim_customers"])
    assert first.read("readouts/kpis").first()["total_transactions"] == 2
    with pytest.raises(KeyError):
        first.path("no such table")

    with gzip.open(folder / "transactions.csv.gz", "wt") as feed:
        feed.write(FEED + "TXN_3,2026-01-01T15:00:00,CUS0000002,,,bill_pay,1.00,North\n")
    run(spark, str(folder), out, as_of=dt.date(2026, 3, 1))
    second = releases.release()
    assert second.number == 2 and second.read("fct_transactions").count() == 3
    # Who has opened the first release still reads it.
    assert first.read("fct_transactions").count() == 2
    assert releases.release(1).run == first.run


DIES = """
import datetime as dt, os, signal, sys
from pyspark.sql import SparkSession
from tillwatch import __main__ as job
from tillwatch.plans import models

spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", sys.argv[3]).getOrCreate())
write = models.write_fact

def killed(*args):
    write(*args)
    os.kill(os.getpid(), signal.SIGKILL)

models.write_fact = killed
job.run(spark, sys.argv[1], sys.argv[2], as_of=dt.date(2026, 3, 1))
"""


def test_a_killed_run_leaves_the_old_one_whole(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    run(spark, str(folder), out, as_of=dt.date(2026, 3, 1))
    before = snapshot(Releases(spark, out).release())
    with gzip.open(folder / "transactions.csv.gz", "wt") as feed:
        feed.write(FEED.replace("120.50", "99.50"))
    root = str(Path(entry.__file__).parent)
    ended = subprocess.run(
        [sys.executable, "-c", DIES, str(folder), out, str(tmp_path / "shared")],
        cwd=root, env=os.environ | {"PYTHONPATH": root}, capture_output=True, timeout=600,
    )
    assert ended.returncode == -signal.SIGKILL
    runs = list((tmp_path / "out" / "runs").iterdir())
    assert len(runs) == 2, "the killed run has written some of its tables"
    releases = Releases(spark, out)
    assert releases.numbers() == [1] and snapshot(releases.release()) == before
    run(spark, str(folder), out, as_of=dt.date(2026, 3, 1))
    assert rows(releases.release().read("fct_transactions"), "amount")[1] == (Decimal("99.50"),)


def test_a_failed_run_publishes_nothing(spark, folder, tmp_path):
    out = tmp_path / "out"
    with gzip.open(folder / "transactions.csv.gz", "wt") as feed:
        feed.write(FEED + "TXN_3,not a time,CUS0000001,,,bill_pay,1.00,North\n")
    with pytest.raises(Exception, match="(?i)malformed|cast|parse"):
        run(spark, str(folder), str(out))
    assert Releases(spark, str(out)).release() is None
    assert not (out / "runs").exists() or not list((out / "runs").iterdir())


def test_old_releases_are_pruned(spark, tmp_path):
    releases = Releases(spark, str(tmp_path))
    runs = []
    for i in range(4):
        runs.append(releases.new_run())
        spark.range(i).write.parquet(f"{runs[-1]}/t")
        assert releases.publish(runs[-1], ["t"]).number == i + 1
    assert releases.prune(2) == [1, 2] and releases.numbers() == [3, 4]
    assert [Path(r).exists() for r in runs] == [False, False, True, True]
    assert releases.release().read("t").count() == 3 and releases.release(3).read("t").count() == 2
    assert releases.prune(5) == []
    with pytest.raises(ValueError):
        releases.prune(0)


# --- lines that do not fit ------------------------------------------------------------------


def test_bad_lines_are_set_aside_and_listed(spark, folder, tmp_path):
    bad = [
        "TXN_3,not a time,CUS0000001,,,bill_pay,1.00,North",
        "TXN_4,2026-01-01T15:00:00,CUS0000001,,,bill_pay,much,North",
        "TXN_5,2026-01-01T15:00:00,CUS0000001",
    ]
    with gzip.open(folder / "transactions.csv.gz", "wt") as feed:
        feed.write(FEED + "\n".join(bad) + "\n")
    with open(folder / "customers.csv", "a") as feed:
        feed.write("CUS0000009,tier_1,North,some day\n")
    out = str(tmp_path / "out")
    written = run(spark, str(folder), out, as_of=dt.date(2026, 3, 1), set_aside=True)
    assert rows(written["fct_transactions"], "transaction_id") == [("TXN_1",), ("TXN_2",)]
    assert written["dim_customers"].count() == 2
    listed = rows(written["rejected"], "relation", "line")
    assert listed == sorted([("raw.transactions", line) for line in bad] + [("raw.customers", "CUS0000009,tier_1,North,some day")], key=repr)
    files = {Path(r.file).name for r in written["rejected"].collect()}
    assert files == {"transactions.csv.gz", "customers.csv"}
    counted = written["dq_violations"].where("check_name = 'well_formed'").groupBy("relation").sum("row_count")
    assert rows(counted) == [("raw.customers", 1), ("raw.transactions", 3)]
    assert "rejected" in Releases(spark, out).release().tables


def test_good_lines_are_all_kept(spark, folder):
    feed = Feed(
        feeds.read_agents(spark, str(folder / "agents.csv"), LOADED, set_aside=True),
        feeds.read_customers(spark, str(folder / "customers.csv"), LOADED, set_aside=True),
        feeds.read_transactions(spark, str(folder / "transactions.csv.gz"), LOADED, set_aside=True),
        feeds.read_ground_truth(spark, str(folder / "fraud_ground_truth.csv.gz"), set_aside=True),
    )
    kept = store.Store(spark)
    land, strict = landed(feed, kept), read(spark, folder)
    assert land.rejected.count() == 0
    for name in ("agents", "customers", "transactions", "ground_truth"):
        assert rows(getattr(land, name)) == rows(getattr(strict, name))
    assert feeds.read_ground_truth(spark, str(folder / "missing.csv.gz"), set_aside=True) is None
    kept.clear()


def test_a_wrong_header_still_ends_the_run(spark, folder):
    (folder / "customers.csv").write_text("customer_id,home_region,kyc_tier,registration_date\nc,North,tier_1,2025-01-10\n")
    with pytest.raises(Exception, match="(?i)header"):
        feeds.read_customers(spark, str(folder / "customers.csv"), set_aside=True).collect()


# --- the fact table's layout ----------------------------------------------------------------


def test_fact_layout(spark, tmp_path):
    hot = F.col("id") % 3 == 0
    df = spark.range(30_000).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("customer_id"),
        F.lit(None).cast("string").alias("agent_id"),
        F.when(F.col("id") % 1_000 > 0, F.date_add(F.lit(dt.date(2026, 1, 1)), F.when(F.col("id") % 7 == 0, F.lit(1)).otherwise(F.lit(0)))).alias("txn_date"),
    )
    df.write.parquet(str(tmp_path / "txns"))
    txns = spark.read.parquet(str(tmp_path / "txns"))
    laid = store.fact_layout(txns, store.rows_per_day(txns).where("txn_date is not null"), rows_per_file=2_000)
    assert rows(laid) == rows(txns)
    assert "rangepartitioning" not in laid._jdf.queryExecution().toString()
    placed = laid.withColumn("at", F.spark_partition_id())
    # A customer's day is in one place, but for the hot one's where partitions of its size are split.
    spread = placed.where("txn_date is not null").groupBy("txn_date", "customer_id").agg(F.countDistinct("at").alias("n"))
    assert spread.agg(F.max("n")).first()[0] == 1
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    try:
        placed = store.fact_layout(txns, store.rows_per_day(txns), rows_per_file=2_000).withColumn("at", F.spark_partition_id())
        sizes = [r["count"] for r in placed.where("customer_id = 'hot'").groupBy("at").count().collect()]
        assert sum(sizes) == 10_000 and len(sizes) > 3
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    fact = store.write_fact(txns, str(tmp_path / "fact"), store.rows_per_day(txns), rows_per_file=2_000)
    assert rows(fact) == rows(txns)
    for file in (tmp_path / "fact").glob("txn_date=2026-01-01/*.parquet"):
        own = [r[0] for r in spark.read.parquet(str(file)).select("customer_id").collect()]
        assert own == sorted(own)
