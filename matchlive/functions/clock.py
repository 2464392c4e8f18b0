"""The match clock. Minutes run on through all periods of a match."""

from pyspark.sql import Column
from pyspark.sql import functions as F

FULL_TIME = 90

# The minute after which a period counts as stoppage time.
STOPPAGE_AFTER = {1: 45, 2: 90, 3: 90, 4: 105}
STOPPAGE_AFTER_OTHERS = 105


def match_second(minute: Column, second: Column) -> Column:
    """Seconds since kick-off; null if a part is missing or too large for an int.

    The try_ forms keep one absurd clock value from failing an ANSI job.
    """
    return F.try_add(F.try_multiply(minute, F.lit(60)), second)


def clock_or_zero(minute: Column, second: Column) -> Column:
    """Seconds since kick-off, a missing part counting as 0."""
    return match_second(F.coalesce(minute, F.lit(0)), F.coalesce(second, F.lit(0)))


def minute_label(minute: Column, period: Column) -> Column:
    """``"32"`` in normal time, ``"45+2"`` in stoppage time."""
    base = F.lit(STOPPAGE_AFTER_OTHERS)
    for number, after in STOPPAGE_AFTER.items():
        base = F.when(period == number, after).otherwise(base)
    stoppage = F.concat_ws("+", base.cast("string"), (minute - base).cast("string"))
    return F.when(minute > base, stoppage).otherwise(minute.cast("string"))


def minutes_remaining(latest_minute: Column) -> Column:
    """Minutes left to full time, 0 all through extra time, null if the minute is."""
    return F.when(latest_minute >= FULL_TIME, 0).otherwise(FULL_TIME - latest_minute)
