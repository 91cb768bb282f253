"""Schedules, buckets and times of day beyond midnight."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column, functions as F

UNITS = {"s": "seconds", "m": "minutes", "h": "hours", "d": "days", "w": "weeks"}
#: Buckets are counted from the first day of year 1, a Monday.
ORIGIN = datetime(1, 1, 1)


def period(text: str) -> timedelta:
    """20s, 5m, 1h, 1d, 1w."""
    found = re.fullmatch(r"\s*(\d+)([smhdw])\s*", text)
    if not found:
        raise ValueError(f"{text!r} is no period")
    return timedelta(**{UNITS[found[2]]: int(found[1])})


def schedule(text: str) -> dict:
    """HH:MM is a time each day, else a period (weeks are none): {"at": (hour, minute)} or {"every": timedelta}."""
    if found := re.fullmatch(r"(\d{1,2}):(\d{2})", text):
        hour, minute = int(found[1]), int(found[2])
        if hour > 23 or minute > 59:
            raise ValueError(f"{text!r} is no time of day")
        return {"at": (hour, minute)}
    if text.endswith("w"):
        raise ValueError("a schedule has no weeks")
    return {"every": period(text)}


def floor(moment: datetime, delta: timedelta) -> datetime:
    """The start of the bucket that a moment is in."""
    return moment - (moment - ORIGIN) % delta


def moment(value) -> Column:
    """A time without time zone as a literal of that type, so that filters on such columns reach the scan; other values as they are."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz") if isinstance(value, datetime) else F.lit(value)


def bucket(time: Column, delta: timedelta) -> Column:
    """The same for a column of timestamps without time zone."""
    step = int(delta.total_seconds() * 1_000_000)
    # Microseconds from a Monday at midnight, 4 January 2021; earlier times count backwards.
    base = moment(datetime(2021, 1, 4))
    passed = F.timestamp_diff("MICROSECOND", base, time)
    shift = int((datetime(2021, 1, 4) - ORIGIN).total_seconds()) * 1_000_000 % step
    return time - F.make_dt_interval(secs=(F.pmod(passed + F.lit(shift), F.lit(step)) / 1_000_000).cast("decimal(18,6)"))


def seconds_of_day(text: Column) -> Column:
    """hh:mm:ss, where hh may exceed 23, in seconds."""
    parts = F.split(text, ":")
    return (parts[0].cast("int") * 3600 + parts[1].cast("int") * 60 + parts[2].cast("int")).cast("int")


def moment_of(day: Column, text: Column) -> Column:
    """Epoch seconds of a service day's start plus a time of day that may lie beyond it."""
    return day + seconds_of_day(text)


def clock(seconds: Column) -> Column:
    """Seconds as HH:MM:SS; the day part of times beyond midnight is left out."""
    s = F.pmod(seconds, F.lit(86400))
    two = lambda x: F.lpad(x.cast("int").cast("string"), 2, "0")
    return F.concat_ws(":", two(F.floor(s / 3600)), two(F.floor(s % 3600 / 60)), two(s % 60))


def blob_name(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd_HH-mm-ss")


def iso_micros(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
