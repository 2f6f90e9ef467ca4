"""Exact quantiles of any window from sketches that are made once a day.

A table of sketches has one row per day (or file, or any other key) with a KLL sketch of every column. Sketches of
a window are merged, whatever days it has, and narrow the search to a strip of values around the quantile, so that
the table itself is read twice: once to count the rows below the strip and in PARTS parts of it, once for the
values of the part that has the rank. Sketches are not exact and need not be: a strip without the rank is widened.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size of a sketch, and the share of rows by which its ranks may be off, with room.
SKETCH_SIZE, MARGIN = 200, 0.02
PARTS = 1_000
# Distinct values of a part that are brought to the driver; a part with more is divided again.
MOST_VALUES = 100_000


def _sketch(name: str) -> str:
    return f"{name}_sketch"


def sketches(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """One row per value of `by`, with a mergeable sketch of every column. To be written and kept."""
    return df.groupBy(by).agg(
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(SKETCH_SIZE)).alias(_sketch(c)) for c in columns]
    )


@dataclass
class _Search:
    """Rank `wanted` (from 1) among the values of a column from `low` to `high`."""

    low: float
    high: float
    wanted: int | None = None
    found: float | None = None


def _part(value: Column, search: _Search) -> Column:
    """-1 below the strip, PARTS + 2 above it, within it 0 to PARTS + 1; its ends are parts of their own."""
    width = search.high / 2 - search.low / 2
    inside = F.floor((value / 2 - search.low / 2) / width * PARTS).cast("long") if width > 0 else F.lit(0)
    inside = F.least(F.greatest(inside, F.lit(0)), F.lit(PARTS - 1)) + 1
    return (
        F.when(value < search.low, -1)
        .when(value > search.high, PARTS + 2)
        .when(value == search.low, 0)
        .when(value == search.high, PARTS + 1)
        .otherwise(inside)
    )


def _by_name(searches: dict[str, _Search], make) -> Column:
    return reduce(
        lambda rest, c: F.when(F.col("name") == c, make(F.col("value"), searches[c])).otherwise(rest), searches, F.lit(None).cast("long")
    )


def quantiles(df: DataFrame, merged: DataFrame, columns: Sequence[str], share: float) -> tuple[dict[str, float | None], int]:
    """For every column the smallest value with at least `share` of the values up to it, and how often `df` was
    read. `merged`: the rows of the window's sketches. A column without values has None."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    strips = merged.agg(*[F.kll_merge_agg_double(_sketch(c)).alias(c) for c in columns])
    rows = strips.select(
        *[F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(F.col(c), F.array(F.lit(max(share - MARGIN, 0.0)), F.lit(min(share + MARGIN, 1.0))))).alias(c) for c in columns]
    ).first()
    # Without sketched values the search begins around 0; a column without any value ends it.
    searches = {c: _Search(*(rows[c] or (0.0, 0.0))) for c in columns}
    out: dict[str, float | None] = dict.fromkeys(columns)
    reads = 0
    long = numbers.unpivot([], list(columns), "name", "value").where("value IS NOT NULL AND NOT isnan(value)")
    while searches:
        open_ = list(searches)
        own = long.where(F.col("name").isin(open_)).groupBy("name", _by_name(searches, _part).alias("part"))
        counts = own.agg(F.count("*").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high")).collect()
        reads += 1
        wide = {}
        for c in open_:
            parts = sorted((r for r in counts if r["name"] == c), key=lambda r: r["part"])
            search = searches.pop(c)
            if not parts:
                continue
            if search.wanted is None:
                search.wanted = max(1, math.ceil(share * sum(r["rows"] for r in parts)))
            before = 0
            for r in parts:
                if search.wanted <= before + r["rows"]:
                    break
                before += r["rows"]
            if r["low"] == r["high"]:
                out[c] = r["low"]
            else:
                # Ranks stay those among all values, since those below the part are counted again.
                wide[c] = (_Search(r["low"], r["high"], search.wanted), before, r["rows"])
        few = {c: s for c, (s, _, n) in wide.items() if n <= MOST_VALUES}
        searches = {c: s for c, (s, _, n) in wide.items() if n > MOST_VALUES}
        if few:
            inside = reduce(lambda a, b: a | b, [(F.col("name") == c) & F.col("value").between(s.low, s.high) for c, s in few.items()])
            values = long.where(inside).groupBy("name", "value").agg(F.count("*").alias("rows")).collect()
            reads += 1
            for c, search in few.items():
                rank = wide[c][1]
                for r in sorted((r for r in values if r["name"] == c), key=lambda r: r["value"]):
                    rank += r["rows"]
                    if search.wanted <= rank:
                        out[c] = r["value"]
                        break
    return out, reads
