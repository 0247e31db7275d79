"""How much happens from each event on, within a span of time.

The plain way is a RANGE window per customer. It puts a busy customer on one task, and Spark
re-adds the whole frame for every row of a sliding window. Here

* rows are first summed per (key, second), which combines before the shuffle and bounds a second
  to one row however many transactions share it;
* the time line is cut into slices, so a busy key is many small groups. A slice also gets what
  its last rows look ahead to in the next slice;
* within a slice a running sum replaces the sliding frame: a second adds its weight `span` before
  itself and takes it away at itself, so the sum at t is the weight in (t, t + span].

A group holds at most two rows per second of its slice plus one per second of the look-ahead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwatch.functions.timekeys import DAY_SECONDS, epoch_seconds, micro_of_second, slice_start

COUNT = "n"


def slice_width(span: int) -> int:
    """Wide enough that little is copied into the slice before, at most a day unless span is."""
    return max(span, min(24 * span, DAY_SECONDS))


def in_slices(ticks: DataFrame, tick: str, reach: int) -> DataFrame:
    """Add `slice` and `home`: each row in its own slice, and in the slice before if that one's
    last rows reach it."""
    width = slice_width(reach)
    home = F.col("home")
    slices = F.when(F.col(tick) - home < reach, F.array(home, home - width)).otherwise(F.array(home))
    return ticks.withColumn("home", slice_start(F.col(tick), width)).withColumn("slice", F.explode(slices))


def totals_ahead(ticks: DataFrame, keys: list[str], tick: str, span: int, weights: list[str]) -> DataFrame:
    """Sum each weight over [tick, tick + span]; `ticks` has one row per (keys, tick)."""
    at = F.col(tick)

    def entry(when: Column, own: bool, sign: int) -> Column:
        return F.struct(
            when.alias("at"), F.lit(own).alias("own"), *[(F.col(w) * sign).alias(w) for w in weights]
        )

    enters = entry(at - span, False, 1)
    leaves = entry(at, True, -1)
    entries = F.when(F.col("slice") == F.col("home"), F.array(enters, leaves)).otherwise(F.array(enters))
    # Shuffled before the entries unfold; the window finds its partitioning in place.
    spread = in_slices(ticks, tick, span).repartition(*keys, "slice")
    swept = spread.select(*keys, "slice", F.explode(entries).alias("e")).select(*keys, "slice", "e.*")
    # Keys often begin alike. The hash in front of them tells rows apart by their first eight bytes, which is all
    # that a sort looks at as long as they differ.
    swept = swept.withColumn("hash", F.xxhash64(*keys, "slice"))
    sweep = Window.partitionBy("hash", *keys, "slice").orderBy("at", "own").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    # An own row carries its weight with the sign turned: the sum so far plus the weight itself.
    summed = swept.select(
        *keys, "at", "own", *[(F.sum(w).over(sweep) - F.col(w)).alias(w) for w in weights]
    )
    return summed.where("own").select(*keys, F.col("at").alias(tick), *weights)


def crowded_seconds(rows: DataFrame, span: int, at_least: int, amount: str | None = None) -> DataFrame:
    """The seconds from which a customer makes `at_least` transactions within `span` seconds.

    `rows` needs customer_id and txn_timestamp. Returns customer_id, second, n and, with `amount`, its sum
    under the same name.
    """
    ticks = _with_second(rows).groupBy("customer_id", "second").agg(
        F.count("*").alias(COUNT), *([F.sum(amount).alias(amount)] if amount else [])
    )
    return totals_ahead(ticks, ["customer_id"], "second", span, _weights(amount)).where(F.col(COUNT) >= at_least)


def crowded_starts(
    rows: DataFrame,
    span: int,
    at_least: int,
    precision: str = "second",
    amount: str | None = None,
) -> DataFrame:
    """The instants from which a customer makes `at_least` transactions within `span` seconds.

    As `crowded_seconds`, with the column micro too if precision is "micro".
    """
    crowded = crowded_seconds(rows, span, at_least, amount)
    if precision == "second":
        return crowded
    return exact_starts(edge_rows(rows, crowded, span, amount), amount).where(F.col(COUNT) >= at_least)


def edge_rows(rows: DataFrame, crowded: DataFrame, span: int, amount: str | None = None) -> DataFrame:
    """The rows in the two edge seconds of each crowded window, with its `start` and whole-second totals (`upper_`).

    A row is in the first second of one window at most, and in the last second of one.
    """
    edges = crowded.select(
        "customer_id",
        F.col("second").alias("start"),
        *[F.col(w).alias(f"upper_{w}") for w in _weights(amount)],
        F.explode(F.array(F.col("second"), F.col("second") + span)).alias("second"),
    )
    return _with_second(rows).withColumn("micro", micro_of_second(F.col("txn_timestamp"))).join(
        edges, ["customer_id", "second"]
    )


def exact_starts(near: DataFrame, amount: str | None = None) -> DataFrame:
    """Bring the totals over whole seconds [s, s + span] down to the microsecond.

    Only the two edge seconds matter: from a start at s + f, what second s holds before f and
    what second s + span holds after f is not in the window. The counts over whole seconds are
    upper bounds, so starts that are not crowded by them need no second look.
    """
    weights = _weights(amount)
    own = F.col("second") == F.col("start")
    one = {COUNT: F.lit(1).cast("long"), **({amount: F.col(amount)} if amount else {})}
    summed = near.groupBy("customer_id", "start", "micro").agg(
        F.count_if(own).alias("starts"),
        *[F.max(f"upper_{w}").alias(f"upper_{w}") for w in weights],
        *[F.sum(F.when(own, one[w]).otherwise(F.lit(0))).alias(f"own_{w}") for w in weights],
        *[F.sum(F.when(own, F.lit(0)).otherwise(one[w])).alias(f"late_{w}") for w in weights],
    )
    # At most a million microseconds per group.
    group = Window.partitionBy("customer_id", "start")
    upto = group.orderBy("micro").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def exact(w: str) -> Column:
        before = F.sum(f"own_{w}").over(upto) - F.col(f"own_{w}")
        after = F.sum(f"late_{w}").over(group) - F.sum(f"late_{w}").over(upto)
        return (F.col(f"upper_{w}") - before - after).alias(w)

    return summed.select(
        "customer_id", F.col("start").alias("second"), "micro", "starts", *[exact(w) for w in weights]
    ).where("starts > 0").drop("starts")


def opening_rows(near: DataFrame, precision: str, at_least: int, amount: str | None = None) -> DataFrame:
    """What `rows_at` finds at the starts of that precision, from the edge rows alone.

    Both precisions share the edge rows: the transactions are searched once for the two of them.
    """
    weights = _weights(amount)
    own = near.where("second = start")
    if precision == "second":
        return own.drop(*weights).withColumnsRenamed({f"upper_{w}": w for w in weights}).drop("start", "second", "micro")
    starts = exact_starts(near, amount).where(F.col(COUNT) >= at_least)
    own = own.drop(*weights, *[f"upper_{w}" for w in weights])
    return own.join(starts, ["customer_id", "second", "micro"]).drop("start", "second", "micro")


def _weights(amount: str | None) -> list[str]:
    return [COUNT, *([amount] if amount else [])]


def _with_second(rows: DataFrame) -> DataFrame:
    return rows.withColumn("second", epoch_seconds(F.col("txn_timestamp")))


def rows_at(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """The rows at the given instants, with what the instants carry.

    An instant appears once in `starts`. If many rows share one, AQE splits their side of the
    join; if `starts` is small, Spark broadcasts it after looking at its size.
    """
    on = [c for c in ("customer_id", "second", "micro") if c in starts.columns]
    keyed = _with_second(rows)
    if "micro" in on:
        keyed = keyed.withColumn("micro", micro_of_second(F.col("txn_timestamp")))
    return keyed.join(starts, on).drop("second", "micro")
