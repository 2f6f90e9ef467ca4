"""Exact quantiles from kept sketches."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthlift.operators import quantiles as Q
from hearthlift.sources.staging import stage


@pytest.fixture(scope="module")
def days(spark):
    """Days of very different spend, a column that mostly repeats, one with nulls, one without any value."""
    df = spark.range(120_000).selectExpr(
        "CAST(id % 40 AS INT) AS day", "pow(pmod(xxhash64(id), 1000003) / 1000.0D, 1 + (id % 40) / 40) AS a", "IF(id % 3 = 0, 7.0D, id % 5) AS b",
        "IF(id % 4 = 0, NULL, CAST(id % 1000 AS DOUBLE)) AS c", "CAST(NULL AS DOUBLE) AS d", "-CAST(id AS DOUBLE) AS e",
    )
    return stage(df, "days")


@pytest.fixture(scope="module")
def kept(days):
    return stage(Q.sketches(days, "day", list("abcde")), "day-sketches")


def plain(df, column, share):
    values = np.sort([r[0] for r in df.select(column).where(F.col(column).isNotNull()).collect()])
    return values[max(1, math.ceil(share * len(values))) - 1] if len(values) else None


@pytest.mark.parametrize("window", ["day < 40", "day BETWEEN 3 AND 9", "day = 39", "day > 99"])
@pytest.mark.parametrize("share", [0.99, 0.5, 0.0, 1.0])
def test_quantiles_of_any_window_in_two_reads(days, kept, window, share):
    rows = days.where(window)
    found, reads = Q.quantiles(rows, kept.where(window), list("abcde"), share)
    assert found == {c: plain(rows, c, share) for c in "abcde"}
    assert reads <= 2


@pytest.mark.parametrize("most", [0, 50])
def test_parts_with_many_values_are_divided_again(days, kept, monkeypatch, most):
    monkeypatch.setattr(Q, "MOST_VALUES", most)
    monkeypatch.setattr(Q, "PARTS", 7)
    found, reads = Q.quantiles(days, kept, list("ace"), 0.99)
    assert found == {c: plain(days, c, 0.99) for c in "ace"} and reads > 2


def test_a_strip_beside_the_rank_does_not_matter(days, kept):
    """Sketches of other days: wrong strips cost reads, not the result."""
    found, _ = Q.quantiles(days.where("day = 39"), kept.where("day = 0"), list("abce"), 0.99)
    assert found == {c: plain(days.where("day = 39"), c, 0.99) for c in "abce"}
