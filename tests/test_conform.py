import pytest

from hearthlift import schemas as S
from hearthlift.operators import conform as C


def test_names_are_canonical_only_where_needed(spark):
    df = spark.createDataFrame([("h", 1)], "ADDRESSLINK string, Treatment int")
    assert C.canonical_names(df, ["addressLink", "treatment"]).columns == ["addressLink", "treatment"]


def test_older_names_do_not_replace_current_ones(spark):
    old = spark.createDataFrame([(1.0,)], "baseline_12m_revenue double")
    both = spark.createDataFrame([(1.0, 2.0)], "baseline_12m_revenue double, baseline_12m_revenue_sum double")
    assert C.current_names(old).columns == ["baseline_12m_revenue_sum"]
    assert C.current_names(both).columns == both.columns


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="lacks the columns b, c; it has a"):
        C.require_columns(df, ["a", "b", "c"], "table")
    with pytest.raises(ValueError):
        C.require_any_column(df, ["x", "y"], "table")


def test_filled_and_typed(spark):
    df = spark.createDataFrame([(None, "5")], "poc_label string, treatment string")
    row = C.typed(C.filled(df, {"poc_label": "missing", "state_label": "missing"}), S.ALL_FEATURES).first()
    assert len(row) == 100
    assert (row.poc_label, row.state_label, row.treatment, row.min_exposure_ts) == ("missing", "missing", 5, None)


def test_baseline_flag_is_derived_only_if_absent(spark):
    df = spark.createDataFrame([(365, 0), (366, 1)], "days_since_last_baseline_purchase int, has_baseline_purchase int")
    assert [r.has_baseline_purchase for r in C.with_baseline_flag(df).collect()] == [0, 1]
    derived = C.with_baseline_flag(df.drop("has_baseline_purchase"))
    assert [r.has_baseline_purchase for r in derived.collect()] == [1, 0]


def test_column_or(spark):
    df = spark.createDataFrame([("7",)], "a string")
    row = df.select(C.column_or(df, "a", 0, "bigint"), C.column_or(df, "b", None, "bigint")).first()
    assert tuple(row) == (7, None)
