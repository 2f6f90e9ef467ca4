"""Tolerant parsing, guarded ratios, caps and score bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthlift.schemas import FALSE_TEXTS, TRUE_TEXTS


def clean_text(value: Column) -> Column:
    return F.lower(F.trim(value.cast("string")))


def filled_text(value: Column, default: str = "missing") -> Column:
    return F.coalesce(F.trim(value.cast("string")), F.lit(default))


def has_text(value: Column) -> Column:
    """Neither null nor blank."""
    return value.isNotNull() & (F.trim(value.cast("string")) != "")


def whole(value: Column) -> Column:
    """Integer part of a number or numeric text, null for any other text."""
    return value.try_cast("double").try_cast("int")


def parse_flag(value: Column, default: int = 0) -> Column:
    """yes/no words to 1/0, other whole numbers as they are, anything else to `default`."""
    text = clean_text(value)
    return (
        F.when(text.isin(*TRUE_TEXTS), F.lit(1))
        .when(text.isin(*FALSE_TEXTS), F.lit(0))
        .otherwise(F.coalesce(whole(value), F.lit(default)))
    )


def ratio(numerator: str, denominator: str) -> str:
    """SQL for the quotient where the denominator is positive, otherwise 0."""
    return f"IF({denominator} > 0, {numerator} / {denominator}, 0.0D)"


def flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def capped(value: Column, cap: float | None) -> Column:
    """Upper winsorisation. Unlike `least`, a null value stays null."""
    if cap is None:
        return value
    return F.when(value > F.lit(cap), F.lit(cap)).otherwise(value)


def clipped(score: Column, low: float, high: float) -> Column:
    return F.when(score > F.lit(high), F.lit(high)).when(score < F.lit(low), F.lit(low)).otherwise(score)


def caliper_bin(score: Column, width: float) -> Column:
    return F.floor(score / F.lit(width)).cast("int")
