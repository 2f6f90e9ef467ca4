"""Pick one row per key, and match controls to treated rows by a distributed rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthlift.functions.hashing import order_hash, order_slice
from hearthlift.sources.staging import stage

# Rows of the slice table up to which it is broadcast, some tens of megabytes.
BROADCAST_SLICES = 500_000
SCORE_SLICES = 4_096


def first_per_key(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under `order`.

    The constant limit lets Spark drop all but one row per key before the shuffle
    (WindowGroupLimit), so a key with very many copies does not end up in one task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, key: str, dated: str, ties: Sequence[str]) -> DataFrame:
    """Newest row per key, rows without a date last; `ties` makes the choice unique."""
    order = [F.col(dated).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]]
    return first_per_key(df, [key], order)


def match_one_to_one(
    df: DataFrame,
    groups: Sequence[str],
    key: str,
    treatment: str = "treatment",
    hash_method: str = "xxhash64",
) -> DataFrame:
    """All treated rows, and per group as many controls as it has treated rows.

    Controls are taken in the order of a hash of `key`, then `key`. Adds `arm_rank` (position
    within group and arm), `group_treated` and `group_controls`. Groups must not be null.

    A group can hold a third of all rows, so it is never sorted in one task: rows are counted
    per group, arm and hash slice, the counts give each slice its starting rank, and only rows
    inside a slice are sorted. Slices that start beyond the quota are dropped unsorted; where the
    table of slices is small enough to broadcast, they are dropped before anything is shuffled.
    Reads `df` twice, the first time at once: pass a written table.
    """
    arm = [*groups, treatment]
    sliced = df.withColumn("_hash", order_hash(F.col(key), hash_method)).withColumn(
        "_slice", order_slice(F.col("_hash"), hash_method)
    )
    starts = stage(_slice_starts(sliced, groups, treatment), "slice-starts")
    if starts.count() <= BROADCAST_SLICES:
        starts = F.broadcast(starts)
    within = Window.partitionBy(*arm, "_slice").orderBy("_hash", key)
    return (
        sliced.join(starts, [*arm, "_slice"])
        .withColumn("arm_rank", F.col("_before") + F.row_number().over(within))
        .where((F.col(treatment) == 1) | (F.col("arm_rank") <= F.col("group_treated")))
        .drop("_hash", "_slice", "_before")
    )


def _slice_starts(sliced: DataFrame, groups: Sequence[str], treatment: str) -> DataFrame:
    """Per group, arm and slice that can be chosen from: rows of the arm in earlier slices, and
    the sizes of both arms. A group has at most 4,096 slices per arm, so its windows are small."""
    arm = [*groups, treatment]
    rows, is_treated = F.col("_rows"), F.col(treatment) == 1
    sizes = sliced.groupBy(*arm, "_slice").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*arm).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*groups)
    starts = sizes.select(
        *arm,
        "_slice",
        F.coalesce(F.sum(rows).over(earlier), F.lit(0)).alias("_before"),
        F.sum(F.when(is_treated, rows).otherwise(0)).over(group).alias("group_treated"),
        F.sum(F.when(~is_treated, rows).otherwise(0)).over(group).alias("group_controls"),
    )
    needed = is_treated | (F.col("_before") < F.col("group_treated"))
    return starts.where((F.col("group_treated") > 0) & needed)


def area_under_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row, `auc`: the share of pairs of a positive and a negative row in which the positive one has the higher
    score, ties half; null if there are no such pairs. Rows without a score count nowhere.

    Rows are counted per distinct score before anything is sorted, and counts are added up within slices of the
    scores' range, then over the slices, so that no task sorts all scores. Exact, since all counts are whole."""
    counts = df.where(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("positive"), F.count_if(F.col(label) != 1).alias("negative")
    )
    counts = stage(counts, "score-counts")
    ends = counts.agg(F.min("score").alias("low"), F.max("score").alias("high"))
    part = (F.col("score") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0)) * SCORE_SLICES
    sliced = counts.join(F.broadcast(ends)).withColumn("slice", F.coalesce(F.floor(part), F.lit(0)))  # one row
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sliced.groupBy("slice").agg(F.sum("negative").alias("own")).select(
        "slice", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("below")
    )
    within = Window.partitionBy("slice").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.col("below") + F.coalesce(F.sum("negative").over(within), F.lit(0))
    pairs = F.col("positive") * (2 * F.col("lower") + F.col("negative"))  # twice the pairs won
    ranked = sliced.join(F.broadcast(starts), "slice").withColumn("lower", lower)  # a row a slice
    total = F.sum("positive") * F.sum("negative")
    won = F.sum(pairs.cast("decimal(38,0)")).cast("double")
    return ranked.agg((won / F.nullif(2.0 * total, F.lit(0.0))).alias("auc"))
