"""Time expressions: zones, numeric axes, and the keys of composite periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brinedeck.fixed_values import WEEKLY_EPOCH, WEEKLY_ORIGIN_DAY


def utc_from_local(local: Column, zone: Column | str) -> Column:
    """Wall time in ``zone`` to UTC wall time.

    A wall time inside a daylight-saving gap moves to the first valid time,
    which is the hour of the transition.
    """
    stamp = local.cast("timestamp")
    utc = F.to_utc_timestamp(stamp, zone)
    in_gap = F.from_utc_timestamp(utc, zone) != stamp
    rolled = F.to_utc_timestamp(F.date_trunc("hour", stamp), zone)
    return F.when(in_gap, rolled).otherwise(utc)


def local_from_utc(utc: Column, zone: Column | str) -> Column:
    return F.from_utc_timestamp(utc, zone)


def micros(ts: Column) -> Column:
    """Microseconds since 1970; a zoneless timestamp is read as UTC."""
    return F.unix_micros(ts.cast("timestamp"))


def hours_between(a: Column, b: Column) -> Column:
    return F.abs(micros(a) - micros(b)) / F.lit(3.6e9)


def from_days_since(days: Column, epoch: str) -> Column:
    """Days since ``epoch`` to a zoneless timestamp, to the second."""
    seconds = F.bround(days * 86400.0).cast("bigint")
    return F.timestamp_seconds(seconds + F.unix_seconds(F.lit(epoch).cast("timestamp"))).cast("timestamp_ntz")


def days_since(ts: Column, epoch: str) -> Column:
    return (micros(ts) - F.unix_micros(F.lit(epoch).cast("timestamp"))) / F.lit(8.64e10)


def decimal_year(ts: Column) -> Column:
    """Year plus the elapsed share of that year."""
    start = F.make_date(F.year(ts), F.lit(1), F.lit(1))
    end = F.make_date(F.year(ts) + 1, F.lit(1), F.lit(1))
    length = F.datediff(end, start) * F.lit(8.64e10)
    return F.year(ts) + (micros(ts) - F.unix_micros(start.cast("timestamp"))) / length


def _span_key(ts: Column, first: Column, last: Column) -> Column:
    """``YYYYdddYYYYddd`` from the first and last day of year of a period."""
    year = F.year(ts).cast("string")
    return F.concat(year, F.lpad(first.cast("string"), 3, "0"), year, F.lpad(last.cast("string"), 3, "0"))


def month_key(ts: Column) -> Column:
    """``YYYYdddYYYYddd``: first and last day of year of the month."""
    return _span_key(ts, F.dayofyear(F.trunc(ts, "month")), F.dayofyear(F.last_day(ts)))


def composite8_bounds(ts: Column, mode: str = "calendar") -> tuple[Column, Column]:
    """First and last day of year of the 8-day period holding ``ts``.

    ``calendar`` starts a period every eight days from 1 January and ends the
    last one with the year.  ``as_written`` is the rounding rule of the older
    processing, which is off by a period for half of the days.
    """
    doy = F.dayofyear(ts)
    if mode == "calendar":
        start = (F.floor((doy - 1) / 8) * 8 + 1).cast("int")
        year_end = F.dayofyear(F.make_date(F.year(ts), F.lit(12), F.lit(31)))
        return start, F.least(start + 7, year_end)
    if mode != "as_written":
        raise ValueError(f"unknown mode {mode!r}")
    capped = F.least(doy, F.lit(361))
    rounded = (F.bround(capped / 8.0) * 8).cast("int")
    end = F.when(rounded == 0, 8).otherwise(rounded)
    leap_patch = F.year(ts).isin(2004, 2008, 2012, 2016) & (capped > 360)
    start = F.when(leap_patch, 366).when(end - 7 > 362, 365).otherwise(end - 7)
    return start, end


def composite8_key(ts: Column, mode: str = "calendar") -> Column:
    return _span_key(ts, *composite8_bounds(ts, mode))


def weekly_cycle(ts: Column) -> Column:
    """Number of the 7-day cycle nearest to ``ts``, counted from the fixed origin day."""
    day = F.bround(days_since(ts, WEEKLY_EPOCH))
    return F.bround((day - WEEKLY_ORIGIN_DAY) / 7.0).cast("bigint")


PERIOD_FORMATS = {"1d": "yyyyMMdd", "1m": "yyyyMM", "1y": "yyyy", "1mNy": "MM"}


def period_key(ts: Column, resolution: str) -> Column:
    """Partition value of the grid layer that holds ``ts`` at a resolution.

    ``1d`` day, ``1m`` month, ``1y`` year, ``1mNy`` month over many years,
    ``12mNy`` one layer for all.
    """
    if resolution == "12mNy":
        return F.lit("all")
    if resolution not in PERIOD_FORMATS:
        raise ValueError(f"unknown resolution {resolution!r}")
    return F.date_format(ts, PERIOD_FORMATS[resolution])
