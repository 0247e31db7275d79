"""Run everything over one feed:

    python -m tillwatch FEED OUT [--as-of 2026-03-01] [--read-partitions 400] [--rules rules.json]
                                 [--set-bad-lines-aside] [--keep-releases 3]

FEED holds agents.csv, customers.csv, transactions.csv.gz and, for scoring, fraud_ground_truth.csv.gz.
Transactions and labels may also be many files or a folder whose names begin alike. The rules' thresholds
come from a JSON file such as {"velocity": {"window_minutes": 10}}; what it leaves out keeps its default.
Every rule and mart, the read-outs (readouts/NAME) and the offending values of the data-quality checks
(dq_violations) are written as Parquet to a folder of the run below OUT/runs, and published together once all
are there; see sources/releases.py for how to read them. A line that does not fit its table ends the
run, or is set aside into the table `rejected` and counted among the violations.
"""

from __future__ import annotations

import argparse
import datetime as dt
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tillwatch.functions.timekeys import utc_now
from tillwatch.params import RuleSettings, settings_from_json
from tillwatch.plans import checks
from tillwatch.plans.models import Models, write_all, write_readouts
from tillwatch.sources import feed as feeds
from tillwatch.sources.releases import Releases
from tillwatch.sources.store import Store, as_files


def read_feed(
    spark: SparkSession, folder: str, read_partitions: int | None = None, set_aside: bool = False
) -> feeds.Feed:
    """The feed's tables, all with one load time.

    The transactions are dealt out over `read_partitions`, by default those of a shuffle; 0 leaves them as
    the files are. With `set_aside` the tables still hold their bad lines, for `landed` to take out.
    """
    folder, now = folder.rstrip("/"), utc_now()
    if read_partitions is None:
        read_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return feeds.Feed(
        feeds.read_agents(spark, f"{folder}/agents.csv", now, set_aside),
        feeds.read_customers(spark, f"{folder}/customers.csv", now, set_aside),
        feeds.read_transactions(spark, f"{folder}/transactions*", now, read_partitions, set_aside),
        feeds.read_ground_truth(spark, f"{folder}/fraud_ground_truth*", set_aside),
    )


RELATIONS = {
    "agents": "raw.agents",
    "customers": "raw.customers",
    "transactions": "raw.transactions",
    "ground_truth": "eval.fraud_ground_truth",
}


def landed(feed: feeds.Feed, store: Store) -> feeds.Feed:
    """The feed as Parquet: its files are read once, however many rules and checks read the tables."""
    tables, rejected = {}, []
    for name, relation in RELATIONS.items():
        table = getattr(feed, name)
        if table is not None:
            table = store.keep(table, f"raw_{name}")
            if feeds.BAD_LINE in table.columns:
                table, bad = feeds.without_bad_lines(table, relation)
                rejected.append(bad)
        tables[name] = table
    return feeds.Feed(**tables, rejected=reduce(DataFrame.unionByName, rejected) if rejected else None)


def run(
    spark: SparkSession,
    feed_folder: str,
    out: str,
    as_of: dt.date | None = None,
    read_partitions: int | None = None,
    settings: RuleSettings | None = None,
    set_aside: bool = False,
    keep_releases: int | None = None,
) -> dict:
    """Run everything and publish it below `out`; the tables as read back."""
    store, releases = Store(spark), Releases(spark, out)
    folder = releases.new_run()
    try:
        feed = landed(read_feed(spark, feed_folder, read_partitions, set_aside), store)
        models = Models(feed, settings or RuleSettings(), as_of=as_of, store=store)
        written = write_all(models, folder)
        readouts = write_readouts(models, folder)
        if feed.rejected is not None:
            written["rejected"] = as_files(feed.rejected, f"{folder}/rejected")
        written["dq_violations"] = as_files(checks.violations(models), f"{folder}/dq_violations")
        releases.publish(folder, [*written, *[f"readouts/{name}" for name in readouts]])
    except BaseException:
        releases.discard(folder)
        raise
    finally:
        store.clear()
    if keep_releases:
        releases.prune(keep_releases)
    return written | readouts


if __name__ == "__main__":
    parser = argparse.ArgumentParser(prog="tillwatch")
    parser.add_argument("feed")
    parser.add_argument("out")
    parser.add_argument("--as-of", type=dt.date.fromisoformat)
    parser.add_argument("--read-partitions", type=int)
    parser.add_argument("--rules", type=Path)
    parser.add_argument("--set-bad-lines-aside", action="store_true")
    parser.add_argument("--keep-releases", type=int)
    args = parser.parse_args()
    chosen = settings_from_json(args.rules.read_text()) if args.rules else None
    session = SparkSession.builder.appName("tillwatch").getOrCreate()
    options = {"set_aside": args.set_bad_lines_aside, "keep_releases": args.keep_releases}
    run(session, args.feed, args.out, args.as_of, args.read_partitions, chosen, **options)
    session.stop()
