"""Hot keys, groups and copies: same rows as the plain computation, and not in one task."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hearthlift.operators import skew
from hearthlift.operators.ranking import first_per_key, latest_per_key, match_one_to_one
from tests.conftest import rows


@pytest.fixture(scope="module")
def lopsided(spark):
    """A third of the rows under one key, and null keys."""
    return spark.range(6000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE CAST(id % 400 AS STRING) END AS k"
    )


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(0, 300).selectExpr("CAST(id AS STRING) AS j", "id * 10 AS v").unionAll(
        spark.createDataFrame([("hot", -1)], "j string, v bigint")
    )


def test_hot_keys_are_found(lopsided):
    assert skew.hot_keys(lopsided, "k", share=0.1, min_rows=100) == ["hot"]
    assert skew.hot_keys(lopsided, "k", share=0.5, min_rows=100) == []
    assert skew.hot_keys(lopsided, "k") == []


EVERY = ["inner", "left", "left_outer", "right", "rightouter", "full", "outer", "full_outer", "left_semi", "semi", "left_anti", "anti"]


@pytest.mark.parametrize("how", EVERY)
@pytest.mark.parametrize("hot", [["hot"], ["hot", "7", "299", "nowhere"]])
def test_spread_join_equals_the_plain_join(spark, lopsided, lookup, how, hot):
    """Hot keys on both sides, with copies of the second side; one that only the second side has; null keys."""
    extra = spark.createDataFrame([("hot", -2), ("nowhere", 5), ("nowhere", 6), (None, 8)], "j string, v bigint")
    other = lookup.unionAll(extra)
    plain = lopsided.join(other, lopsided.k == other.j, how)
    spread = skew.spread_join(lopsided, other, "k", "j", how, hot, F.col("id"))
    assert spread.columns == plain.columns
    assert rows(spread) == rows(plain)


def test_unknown_joins_are_refused(lopsided, lookup):
    with pytest.raises(ValueError):
        skew.spread_join(lopsided, lookup, "k", "j", "sideways", [], F.col("id"))


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "anti"])
def test_no_task_has_a_tenth_of_a_key_with_most_rows(spark, conf, how):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "64")
    many = spark.range(50_000).selectExpr("id", "IF(id % 10 < 9, 'hot', CAST(id % 300 AS STRING)) AS k")
    one = spark.range(300).selectExpr("CAST(id AS STRING) AS j")
    one = one if how == "anti" else one.unionAll(spark.createDataFrame([("hot",)], "j string"))
    spread = skew.spread_join(many, one, "k", "j", how, skew.hot_keys(many, "k", share=0.1, min_rows=100), F.col("id"))
    per_task = spread.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 45_000
    assert max(r["count"] for r in per_task) < 5_000


def test_bridge_join_of_every_type_with_a_hot_identity(spark, monkeypatch):
    from hearthlift.operators import identity as I

    base = spark.range(2000).selectExpr("IF(id % 10 < 9, 'm0', CONCAT('m', id % 50)) AS tp_id", "id AS n")
    links = spark.range(60).selectExpr("CONCAT('d', id) AS rampid_dpm", "CONCAT('m', id) AS rampid_meta", "IF(id % 4 = 0, 'r0', CONCAT('r', id)) AS rampid_rmn")
    orders = spark.range(80).selectExpr("CONCAT('r', id % 70) AS lr_id", "id AS orders")
    plain = {}
    for how in ("inner", "left", "right", "full"):
        tables = [I.BridgedTable(orders, "lr_id", "rampid_rmn", how)]
        plain[how] = rows(I.bridge_join(base, "tp_id", "rampid_meta", links, tables))
    monkeypatch.setattr(I, "hot_keys", lambda df, key: skew.hot_keys(df, key, share=0.02, min_rows=2))
    for how, want in plain.items():
        tables = [I.BridgedTable(orders, "lr_id", "rampid_rmn", how)]
        assert rows(I.bridge_join(base, "tp_id", "rampid_meta", links, tables)) == want
    assert sum(r[0] is None for r in plain["full"]) == sum(r[0] is None for r in plain["right"]) > 0
    assert {r[0] for r in plain["left"]} == {r[0] for r in rows(base)}


def test_spread_join_spreads(spark, conf, lopsided, lookup):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")
    spread = skew.spread_join(lopsided, lookup, "k", "j", "inner", ["hot"], F.col("id"))
    per_task = spread.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 8
    assert max(r["count"] for r in per_task) < 700


def test_lookup_join_small_and_large(lopsided, lookup):
    table = lookup.withColumnRenamed("j", "k")
    plain = rows(lopsided.join(table, "k", "left"))
    assert rows(skew.lookup_join(lopsided, table, "k")) == plain
    assert rows(skew.lookup_join(lopsided, table, "k", max_rows=10).select("k", "id", "v")) == plain


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_are_dropped_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 2 AS k", "id % 3 AS amount", "concat('t', id % 5) AS text")
    unique = first_per_key(df, ["k"], [F.col("amount").desc(), F.col("text")])
    assert rows(unique) == [(0, 2, "t0"), (1, 2, "t0")]
    plan = plan_of(unique)
    assert plan.index(", 1, Final") < plan.index("Exchange") < plan.index(", 1, Partial")


def test_latest_per_key_is_stable(spark):
    data = [("a", "2020-01-01", i) for i in range(50)] + [("a", None, 99), ("b", None, 1)]
    df = spark.createDataFrame(data, "k string, d string, v int")
    want = [("a", "2020-01-01", 0), ("b", None, 1)]
    for parts in (1, 3, 11):
        assert rows(latest_per_key(df.repartition(parts), "k", "d", ["v"])) == want


def test_adaptive_execution_splits_a_hot_identity(spark, conf):
    from hearthlift.operators.conversions import to_households

    for name, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }.items():
        conf(name, value)
    purchases = spark.range(0, 60000, 1, 8).selectExpr("id", "IF(id % 3 = 0, 'hot', CAST(id % 500 AS STRING)) AS lr_id")
    identities = spark.range(500).selectExpr("CAST(id AS STRING) AS lr_id", "id AS household").unionAll(
        spark.createDataFrame([("hot", -1)], "lr_id string, household bigint")
    )
    joined = to_households(purchases, identities).groupBy("household", "id").count()
    assert joined.count() == 60000
    joined.collect()
    assert "skew=true" in plan_of(joined)


def brute_force_match(df, groups, key):
    """Plain windows over whole groups."""
    treated = F.sum(F.when(F.col("treatment") == 1, 1).otherwise(0)).over(Window.partitionBy(*groups))
    rank = F.row_number().over(
        Window.partitionBy(*groups, "treatment").orderBy(F.xxhash64(F.col(key).cast("string")), key)
    )
    ranked = df.withColumns({"group_treated": treated, "arm_rank": rank})
    return ranked.where(
        "group_treated > 0 AND (treatment = 1 OR arm_rank <= group_treated)"
    ).select(key, "treatment", *groups, "arm_rank", "group_treated")


@pytest.fixture(scope="module")
def households(spark):
    """Two thirds in one stratum; strata with only treated, only controls, and few controls."""
    return spark.range(9000).selectExpr(
        "CAST(id AS STRING) AS h",
        "IF(id % 3 < 2, 'big', CAST(id % 40 AS STRING)) AS a",
        "IF(id % 3 < 2, 'x', CAST(id % 2 AS STRING)) AS b",
        "CASE WHEN id % 40 IN (3, 5) THEN 1 WHEN id % 40 IN (4, 7) THEN 0 ELSE IF(hash(id) % 5 = 0, 1, 0) END AS treatment",
    )


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_match_equals_brute_force(households, monkeypatch, broadcast_rows):
    monkeypatch.setattr("hearthlift.operators.ranking.BROADCAST_SLICES", broadcast_rows)
    for layout in (households, households.repartition(13)):
        got = match_one_to_one(layout, ["a", "b"], "h").select("h", "treatment", "a", "b", "arm_rank", "group_treated")
        assert rows(got) == rows(brute_force_match(households, ["a", "b"], "h"))


def test_match_properties(households):
    matched = match_one_to_one(households, ["a", "b"], "h")
    assert matched.groupBy("h").count().where("count > 1").count() == 0
    arms = matched.groupBy("a", "b").agg(
        F.count_if(F.col("treatment") == 1).alias("t"),
        F.count_if(F.col("treatment") == 0).alias("c"),
        F.max("group_treated").alias("gt"),
        F.max("group_controls").alias("gc"),
    )
    for r in arms.collect():
        assert r.t == r.gt and r.c == min(r.gt, r.gc)


def test_big_groups_are_not_ranked_in_one_task(spark, conf, households):
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")
    matched = match_one_to_one(households, ["a", "b"], "h")
    per_task = matched.where("a = 'big'").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) == 16
