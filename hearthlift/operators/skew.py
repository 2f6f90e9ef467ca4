"""Joins that stay spread out when single keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot if it holds both this share and this many of the rows.
HOT_SHARE = 0.0005
HOT_ROWS = 1_000_000
# Hot keys number at most 1 / HOT_SHARE, so their copies stay within a few million rows.
MAX_WAYS = 4_000


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE, min_rows: int = HOT_ROWS) -> list:
    """Keys that hold at least `share` of the rows; there can be no more than 1/share of them.

    The counts are combined map-side, and only the few hot keys reach the driver.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    heavy = counts.where(F.col("rows") >= min_rows).orderBy(F.desc("rows")).limit(int(1 / share)).collect()
    if not heavy:
        return []
    total = df.count()
    return [row[key] for row in heavy if row["rows"] >= share * total]


# Names of join types, and what they are called here.
_JOINS = {
    name: kind
    for kind, names in {
        "inner": ("inner",),
        "left": ("left", "leftouter"),
        "right": ("right", "rightouter"),
        "full": ("full", "fullouter", "outer"),
        "left_semi": ("semi", "leftsemi"),
        "left_anti": ("anti", "leftanti"),
    }.items()
    for name in names
}


def join_kind(how: str) -> str:
    kind = _JOINS.get(how.replace("_", "").lower())
    if kind is None:
        raise ValueError(f"unknown type of join: {how}")
    return kind


def spread_join(
    many: DataFrame,
    one: DataFrame,
    many_key: str,
    one_key: str,
    how: str,
    hot: list,
    spread_by: Column,
    ways: int | None = None,
) -> DataFrame:
    """Equi-join in which the hot keys of `many` are split into `ways` parts each.

    By default there are four parts per shuffle partition, so that a single key can keep the whole
    cluster busy. Only rows of `one` that carry a hot key are copied, once per part. `spread_by`
    decides the part of a hot row and must be a function of the row, so that a repeated task
    routes its rows as before.

    In a right or full join a row of `one` without partner must come out once, but its copies meet
    different parts. A key that `many` has is never without partner, so what its copies leave over is
    taken out again; a key that `many` does not have is not split. Which hot keys it has takes a job at once.
    """
    how = join_kind(how)
    if hot and how in ("right", "full"):
        present = many.where(F.col(many_key).isin(hot)).select(F.col(many_key).alias("key")).distinct()
        hot = [row["key"] for row in present.collect()]
    if not hot:
        return many.join(one, many[many_key] == one[one_key], how)
    if ways is None:
        ways = min(4 * int(many.sparkSession.conf.get("spark.sql.shuffle.partitions")), MAX_WAYS)
    way = F.when(F.col(many_key).isin(hot), F.pmod(F.xxhash64(spread_by), F.lit(ways))).otherwise(F.lit(0))
    copies = F.when(F.col(one_key).isin(hot), F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(F.array(F.lit(0)))
    left = many.withColumn("_way", way.cast("int"))
    right = one.withColumn("_copy", F.explode(copies))
    joined = left.join(right, (left[many_key] == right[one_key]) & (left["_way"] == right["_copy"]), how)
    if how in ("right", "full"):
        left_over = left["_way"].isNull() & F.coalesce(right[one_key].isin(hot), F.lit(False))
        joined = joined.where(~left_over)
    return joined.drop("_way", "_copy")


def lookup_join(big: DataFrame, small: DataFrame, key: str, how: str = "left", max_rows: int = 200_000) -> DataFrame:
    """Join to a table that is expected to be small and has one row per key.

    It is broadcast only after a count has shown that it is small; a larger one is joined by
    shuffle, with the big side's hot keys spread.
    """
    if small.limit(max_rows + 1).count() <= max_rows:
        return big.join(F.broadcast(small), key, how)
    renamed = small.withColumnRenamed(key, "_key")
    others = [F.col(c) for c in big.columns if c != key] or [F.col(key)]
    joined = spread_join(big, renamed, key, "_key", how, hot_keys(big, key), F.struct(*others))
    return joined.drop("_key")
