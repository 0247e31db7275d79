"""Integer keys for timestamps without time zone.

All of them read the wall clock itself. `timestampdiff`, `unix_seconds` and friends go through the
session time zone, which moves the wall-clock hour that daylight saving skips.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000
DAY_SECONDS = 86_400


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01, rounded down."""
    return (
        F.unix_date(ts.cast("date")).cast("long") * DAY_SECONDS
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def micro_of_second(ts: Column) -> Column:
    """The part below the second, 0..999999."""
    seconds = F.extract(F.lit("SECOND"), ts)  # decimal(8,6)
    return (seconds * MICROS).cast("long") - F.second(ts).cast("long") * MICROS


def epoch_micros(ts: Column) -> Column:
    return epoch_seconds(ts) * MICROS + micro_of_second(ts)


def from_epoch_micros(micros: Column) -> Column:
    """Inverse of `epoch_micros`."""
    return F.timestamp_add("MICROSECOND", micros, _epoch())


def floor_div(value: Column, unit: int) -> Column:
    """Integer quotient rounded down, exact below 2**53."""
    return ((value - F.pmod(value, F.lit(unit))) / F.lit(unit)).cast("long")


def slice_start(tick: Column, width: int) -> Column:
    """Start of the `width`-wide slice of the number line that holds `tick`."""
    return tick - F.pmod(tick, F.lit(width))


def utc_now() -> dt.datetime:
    """The clock of the driver, so that no session's zone matters and a plan has one time throughout."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
