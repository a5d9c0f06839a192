"""Dates and frequencies of time series."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Day-first layouts that are tried in this order, ISO last.
DAY_FIRST_LAYOUTS = ("d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "d/M/yyyy H:mm:ss", "d/M/yyyy H:mm",
                     "yyyy-M-d", "yyyy-M-d H:mm:ss")


def parse_day_first(c: Column) -> Column:
    """Day-first text to a zone-less timestamp; NULL when no layout fits."""
    text = F.trim(c)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(layout)) for layout in DAY_FIRST_LAYOUTS]
                      ).cast("timestamp_ntz")


def frequency_of(gap_days: Column) -> Column:
    """Name of the frequency with the given usual gap: D, W or ME; D when unknown."""
    return (F.when(gap_days == 1, "D").when(gap_days == 7, "W")
            .when(gap_days.between(28, 31), "ME").otherwise("D"))


def advance(ts: Column, steps: Column, freq: Column) -> Column:
    """The point ``steps`` periods after ``ts``: days, weeks or month ends."""
    day = F.to_date(ts)
    # a date that is not a month end rolls to the end of its own month first
    on_end = F.when(day == F.last_day(day), steps).otherwise(steps - 1)
    moved = (F.when(freq == "W", F.date_add(day, (steps * 7).cast("int")))
             .when(freq == "ME", F.last_day(F.add_months(day, on_end.cast("int"))))
             .otherwise(F.date_add(day, steps.cast("int"))))
    return moved.cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a zone-less timestamp, whatever the session time zone."""
    zero = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", zero, ts.cast("timestamp_ntz")) / 1e6
