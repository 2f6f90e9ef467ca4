"""Epoch seconds and calendar days, always in UTC whatever the session time zone is."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EPOCH = date(1970, 1, 1)
# Column, and folder, of the calendar day in tables that are laid out by day.
DAY = "day"


def epoch_of(day: date) -> int:
    """Epoch seconds of midnight UTC."""
    return (day - _EPOCH).days * 86400


def date_of(epoch: Column) -> Column:
    """Calendar day (UTC) of an epoch-seconds column."""
    return F.date_from_unix_date(F.floor(epoch.cast("bigint") / F.lit(86400)).cast("int"))


def epoch_within(epoch: Column, first: date, last: date) -> Column:
    """Days first..last, inclusive, as a range on the raw epoch column, so that the scan can use it."""
    return (epoch >= F.lit(epoch_of(first))) & (epoch < F.lit(epoch_of(last + timedelta(days=1))))


def within_period(df: DataFrame, epoch: str, first: date, last: date) -> Column:
    """Rows of days first..last; of a table laid out by day only those days' folders are listed and read."""
    within = epoch_within(F.col(epoch), first, last)
    if DAY in df.columns and dict(df.dtypes)[DAY] == "date":
        return F.col(DAY).between(F.lit(first), F.lit(last)) & within
    return within


def day_within(day: str, first: date, last: date) -> str:
    """SQL condition for days first..last, inclusive."""
    return f"{day} BETWEEN DATE '{first}' AND DATE '{last}'"


def monday_of(day: date) -> date:
    return day - timedelta(days=day.weekday())


def bit_words(offset: str, length: int, when: str) -> list[str]:
    """SQL aggregates that mark 0-based offsets below `length` in 64-bit words.

    Together with :func:`bits_set` this is an exact distinct count of a small integer range
    in a few long buffers: it merges map-side and needs no Expand per distinct count.
    """
    bit = f"shiftleft(1L, CAST(pmod({offset}, 64) AS INT))"
    return [f"bit_or(IF({when} AND {offset} DIV 64 = {k}, {bit}, NULL))" for k in range(-(-length // 64))]


def bits_set(words: list[str]) -> str:
    """SQL for the number of marked offsets."""
    return "CAST(" + " + ".join(f"bit_count(coalesce({word}, 0L))" for word in words) + " AS BIGINT)"
