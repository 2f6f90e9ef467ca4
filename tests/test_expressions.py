from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from hearthlift import schemas as S
from hearthlift.functions import calendar, hashing, labels, values


def column(spark, kind, items, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def test_flag_texts(spark):
    texts = [" TRUE ", "n", "2", "abc", None, "Yes", "f", "-1", "2.7"]
    assert column(spark, "string", texts, values.parse_flag(F.col("v"))) == [1, 0, 2, 0, 0, 1, 0, -1, 2]
    assert column(spark, "boolean", [True, False, None], values.parse_flag(F.col("v"), 7)) == [1, 0, 7]


def test_spend_tier_edges(spark):
    edges = [0.0, 0.01, 10, 50, 100, 250, 500, 1000, 2000, 3500, 5000, 7500, 12000]
    got = column(spark, "double", [float(e) for e in edges], labels.spend_tier("v"))
    assert got == list(S.SPEND_TIER_ORDER)
    below = [9.99, 49.99, 99.99, 249.99, 499.99, 999.99, 1999.99, 3499.99, 4999.99, 7499.99, 11999.99]
    assert column(spark, "double", below, labels.spend_tier("v")) == list(S.SPEND_TIER_ORDER[1:-1])


def test_ordinal_is_tier_position(spark):
    got = column(spark, "string", [*S.SPEND_TIER_ORDER, "unknown", None], labels.ordinal("v", S.SPEND_TIER_ORDER))
    assert got == [float(i) for i in range(13)] + [0.0, 0.0]


def test_caliper_bins_keep_double_arithmetic(spark):
    scores = [0.29, 0.57, 0.58, 0.02, 0.99]
    clipped = values.clipped(F.col("v"), 0.05, 0.95)
    assert column(spark, "double", scores, clipped) == [0.29, 0.57, 0.58, 0.05, 0.95]
    got = column(spark, "double", scores, values.caliper_bin(clipped, 0.01))
    assert got == [int(min(max(s, 0.05), 0.95) / 0.01) for s in scores]
    assert got[:3] == [28, 56, 57]


def test_capping_keeps_nulls(spark):
    assert column(spark, "double", [1.0, 9.0, None], values.capped(F.col("v"), 5.0)) == [1.0, 5.0, None]


def test_days_are_utc_in_any_session(spark, conf):
    instants = [datetime(2025, 11, 12, 0, 0, 0), datetime(2025, 11, 12, 23, 59, 59), datetime(1969, 12, 31, 23, 0, 0)]
    epochs = [int(t.replace(tzinfo=timezone.utc).timestamp()) for t in instants]
    for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
        conf("spark.sql.session.timeZone", zone)
        assert column(spark, "bigint", epochs, calendar.date_of(F.col("v"))) == [t.date() for t in instants]


def test_period_includes_both_end_days(spark):
    first, last = date(2025, 11, 12), date(2026, 1, 6)
    start, end = calendar.epoch_of(first), calendar.epoch_of(last) + 86400
    inside = calendar.epoch_within(F.col("v"), first, last)
    assert column(spark, "bigint", [start - 1, start, end - 1, end], inside) == [False, True, True, False]


def test_bit_words_count_distinct_offsets(spark):
    df = spark.range(0, 5000).selectExpr("id % 7 AS g", "CAST(id * id % 365 AS INT) AS day", "id % 3 <> 0 AS keep")
    words = calendar.bit_words("day", 365, "keep")
    assert len(words) == 6
    marked = df.groupBy("g").agg(*[F.expr(f"{w} AS w{i}") for i, w in enumerate(words)])
    got = marked.selectExpr("g", calendar.bits_set([f"w{i}" for i in range(6)]) + " AS n")
    want = df.where("keep").groupBy("g").agg(F.countDistinct("day").alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_profiles(spark):
    df = spark.createDataFrame([(2, 0, 1), (0, 0, 0)], "a int, b int, c int")
    counts = {"x": "a", "y": "b", "z": "c"}
    got = df.select(labels.count_profile(counts), labels.presence_profile(counts, "a + b + c")).collect()
    assert [tuple(r) for r in got] == [("x:2|z:1", "x|z"), ("missing", "missing")]


def test_folds_and_samples_ignore_the_layout(spark):
    keys = spark.range(5000).selectExpr("CAST(id AS STRING) AS k")
    for method in ("xxhash64", "md5"):
        def assigned(df):
            fold = hashing.hash_bucket(F.col("k"), 5, 42, method)
            kept = hashing.sampled(F.col("k"), 0.3, 42, method)
            return {r.k: (r.f, r.s) for r in df.select("k", fold.alias("f"), kept.alias("s")).collect()}

        once = assigned(keys)
        assert once == assigned(keys.repartition(7))
        sizes = [sum(f == i for f, _ in once.values()) for i in range(5)]
        assert min(sizes) > 850
        assert 1350 < sum(s for _, s in once.values()) < 1650


def test_slices_sort_like_their_hashes(spark):
    keys = spark.range(3000).selectExpr("CAST(id AS STRING) AS k")
    for method in ("xxhash64", "md5"):
        h = hashing.order_hash(F.col("k"), method)
        ordered = keys.select(h.alias("h")).select("h", hashing.order_slice(F.col("h"), method).alias("s"))
        slices = [r.s for r in ordered.orderBy("h").collect()]
        assert slices == sorted(slices) and len(set(slices)) > 1000


def test_very_small_samples_keep_their_share(spark):
    keys = spark.range(3_000_000).select(F.col("id").alias("k"))
    for method in ("xxhash64", "md5"):
        kept = keys.where(hashing.sampled(F.col("k"), 4e-6, 42, method)).count()
        assert 2 <= kept <= 30
