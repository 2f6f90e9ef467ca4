"""Effects on generated households with a known answer."""

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthlift import GROCERY_CAMPAIGN
from hearthlift import schemas as S
from hearthlift.operators import diagnostics as D
from hearthlift.operators import estimation as E
from hearthlift.operators import matching as M

CONFIG = replace(GROCERY_CAMPAIGN)
QUICK_TREES = E.Learner("trees", tree_iterations=3, tree_depth=2)


def uniform(seed: int) -> str:
    """Noise that depends on the row alone."""
    return f"(pmod(xxhash64(id, {seed}), 1000003) / 1000003.0D)"


SHARES = (
    "baseline_12m_quantity_sum", "baseline_60d_orders", "baseline_campaign_product_revenue",
    "campaign_product_revenue_share", "recent_60d_revenue_share", "recent_60d_order_share",
)
FLAGS = ("prior_campaign_product_buyer", "recent_60d_buyer", "lapsed_60d_buyer")


def generated(spark, n: int, effect: float, treatment: str):
    """Households whose spend drives both treatment and outcome."""
    spend = f"500 * {uniform(1)} * {uniform(2)}"
    df = spark.range(n).selectExpr(
        "id",
        "concat('h', id) AS addressLink",
        f"{spend} AS baseline_12m_revenue_sum",
        f"CAST(20 * {uniform(3)} AS BIGINT) AS baseline_12m_orders",
        f"100 * {uniform(4)} AS baseline_60d_revenue",
        f"CAST(366 * {uniform(5)} AS BIGINT) AS days_since_last_baseline_purchase",
        f"CAST(365 * {uniform(6)} AS BIGINT) AS baseline_purchase_tenure_days",
        f"30 * {uniform(7)} AS baseline_12m_avg_order_value",
        f"1 + 4 * {uniform(8)} AS baseline_12m_avg_items_per_order",
        f"CAST({uniform(9)} > 0.4 AS INT) AS has_baseline_purchase",
        f"element_at(array('CA', 'NY', 'TX', 'missing'), 1 + CAST(4 * {uniform(10)} AS INT)) AS state_label",
        f"element_at(array('has_child', 'no_child', 'missing'), 1 + CAST(3 * {uniform(11)} AS INT)) AS poc_label",
        f"element_at(array('recent_buyer', 'lapsed_buyer', 'no_12m_purchase'), 1 + CAST(3 * {uniform(12)} AS INT)) AS baseline_buyer_label",
        "'no_prior_campaign_product' AS campaign_product_affinity_label",
        "'100_to_249' AS baseline_12m_revenue_sum_bin",
        *[f"CAST(3 * {uniform(20 + i)} AS BIGINT) AS {c}" for i, c in enumerate((*S.AGE_COUNTS, *S.GENDER_COUNTS))],
        f"1 + CAST(35 * {uniform(13)} AS INT) AS income",
        *[f"{uniform(40 + i)} AS {c}" for i, c in enumerate(SHARES)],
        *[f"CAST({uniform(50 + i)} > 0.5 AS INT) AS {c}" for i, c in enumerate(FLAGS)],
        "1L AS exposure_frequency_deduped",
        "2L AS person_record_count",
    )
    df = df.selectExpr("*", *[f"CAST(income = {i} AS BIGINT) AS {c}" for i, c in zip(S.INCOME_CODES, S.CODED_INCOME_COUNTS)])
    df = df.selectExpr("*", f"{treatment} AS treatment")
    noise = f"(20 * ({uniform(14)} + {uniform(15)} - 1))"
    return df.selectExpr("*", f"20 + 0.2 * baseline_12m_revenue_sum + {effect} * treatment + {noise} AS {E.TOTAL_OUTCOME}").selectExpr(
        "*", f"{E.TOTAL_OUTCOME} / 10 AS {E.PRODUCT_OUTCOME}", "1 AS is_eligible_control",
        "0 AS has_partial_exposure_within_addresslink", f"CAST({uniform(16)} > 0.5 AS INT) AS outcome_campaign_product_buyer",
    )


CONFOUNDED = f"CAST({uniform(17)} < 0.3 + 0.4 * baseline_12m_revenue_sum / 500 AS INT)"


@pytest.fixture(scope="module")
def few(spark):
    return generated(spark, 300, 5, "CAST(id % 2 AS INT)").cache()


@pytest.mark.parametrize("learner", [E.LINEAR, QUICK_TREES], ids=["linear", "trees"])
def test_one_complete_row(few, learner):
    summary = E.estimate_lift(few, CONFIG, learner)
    assert summary.schema.fieldNames() == S.LIFT_SUMMARY.fieldNames()
    (row,) = summary.collect()
    assert all(v is not None and math.isfinite(v) for v in row)
    assert row.total_row_count == 300 and row.treated_count == 150.0
    assert row.lift_percent == pytest.approx(row.incremental_lift / row.expected_amount * 100)
    assert row.expected_amount == pytest.approx(row.avg_treatment_amount - row.incremental_lift)
    assert row.lift_ci_lower < row.incremental_lift < row.lift_ci_upper


def test_product_revenue_stands_in_for_an_absent_total(few, caplog):
    without = few.drop(E.TOTAL_OUTCOME)
    assert E.outcome_column(without) == E.PRODUCT_OUTCOME
    assert "absent" in caplog.text
    with pytest.raises(ValueError):
        E.outcome_column(without, "no_such_column")
    row = E.estimate_lift(without, CONFIG).first()
    assert row.avg_treatment_amount < 20


def test_planted_effect_is_found_despite_confounding(spark):
    df = generated(spark, 20_000, 5, CONFOUNDED)
    arms = {r.treatment: r.y for r in df.groupBy("treatment").agg(F.avg(E.TOTAL_OUTCOME).alias("y")).collect()}
    row = E.estimate_lift(df, CONFIG).first()
    assert arms[1] - arms[0] > 7
    assert row.lift_ci_lower < 5 < row.lift_ci_upper
    assert row.lift_p_value < 0.001 and row.outcome_r2 > 0.5 and row.treatment_auc > 0.55


def test_planted_null_passes_as_placebo(spark):
    df = generated(spark, 20_000, 0, CONFOUNDED).withColumn(
        E.PLACEBO_OUTCOME, F.col(E.TOTAL_OUTCOME)
    )
    verdict = D.placebo_verdict(E.estimate_lift(df, CONFIG, outcome=E.PLACEBO_OUTCOME)).first()
    assert verdict.lift_ci_lower < 0 < verdict.lift_ci_upper
    assert verdict.placebo_passed is True


def test_estimate_ignores_the_layout(few):
    one, other = (E.estimate_lift(df, CONFIG).first() for df in (few, few.repartition(7)))
    assert one.incremental_lift == pytest.approx(other.incremental_lift, rel=1e-6)
    assert one.lift_p_value == pytest.approx(other.lift_p_value, rel=1e-4)


def test_collinear_segments_have_no_p_values(spark):
    df = spark.range(50).selectExpr("CAST(id % 7 AS DOUBLE) AS a", "CAST(id % 7 AS DOUBLE) * 2 AS b", "CAST(id AS DOUBLE) AS y")
    fit = E.least_squares(df, "y", ["a", "b"])
    assert fit.p_values == [None, None] and fit.standard_errors == [None, None]


def test_least_squares_equals_the_aggregate_slope(few):
    fit = E.least_squares(few, E.TOTAL_OUTCOME, ["baseline_12m_revenue_sum"])
    y, x = E.TOTAL_OUTCOME, "baseline_12m_revenue_sum"
    row = few.selectExpr(
        f"regr_slope({y}, {x}) AS slope",
        f"sqrt((regr_syy({y}, {x}) - pow(regr_sxy({y}, {x}), 2) / regr_sxx({y}, {x})) / (regr_count({y}, {x}) - 2) / regr_sxx({y}, {x})) AS se",
    ).first()
    assert fit.coefficients[0] == pytest.approx(row.slope)
    assert fit.standard_errors[0] == pytest.approx(row.se)


def test_undefined_lift_percent_is_null(spark):
    columns = E.lift_columns(F.lit(2.0), F.lit(1.0), F.lit(2.0))
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()
    assert row.lift_percent is None and row.lift_pct_ci_lower is None
    assert (row.expected_amount, row.lift_ci_lower) == (0.0, pytest.approx(0.04))


def test_limits_and_capping(spark):
    df = spark.range(1, 1001).selectExpr("CAST(id AS DOUBLE) AS a", "IF(id % 3 = 0, NULL, CAST(id AS DOUBLE)) AS b")
    limits = E.upper_limits(df, ["a", "b"])
    assert limits["a"] == 990.0
    capped = E.winsorised(df, limits)
    assert capped.agg(F.max("a")).first()[0] == 990.0
    assert capped.where("b IS NULL").count() == 333


def test_limits_of_a_large_table_are_exact(spark):
    """More rows than the sketch keeps; a third of one column is a single value."""
    df = spark.range(200_000).selectExpr(
        f"pow({uniform(1)}, 3) AS a", f"IF(id % 3 = 0, 0, {uniform(2)}) AS b", "IF(id % 2 = 0, 7.0D, 1.0D) AS c",
        "CAST(NULL AS DOUBLE) AS d", f"IF(id % 5 = 0, NULL, floor(1000 * {uniform(3)})) AS e",
    )
    pdf = df.toPandas()
    want = {c: pdf[c].dropna().quantile(0.99, interpolation="higher") for c in "abce"}
    for layout in (df, df.repartition(11)):
        got = E.upper_limits(layout, list("abcde"))
        assert got.pop("d") is None
        for c in "abce":
            values = pdf[c].dropna().sort_values(ignore_index=True)
            assert got[c] == values[math.ceil(0.99 * len(values)) - 1]
            assert abs(got[c] - want[c]) <= 1


def test_segment_rules(spark):
    df = spark.createDataFrame(
        [(1, 30, 35.0, 20.0), (0, 29, 55.0, 19.9)],
        "has_baseline_purchase int, days_since_last_baseline_purchase int, est_age double, est_income_code double",
    )
    got = df.select(*[c.alias(n) for n, c in E.segment_flags().items()]).collect()
    assert tuple(got[0]) == (1.0, 1.0, 1.0, 0.0, 1.0)
    assert tuple(got[1]) == (0.0, 0.0, 0.0, 1.0, 0.0)


def test_nulls_are_filled_for_trees_and_left_out_for_linear(few):
    holes = few.withColumn("baseline_12m_avg_order_value", F.when(F.col("id") >= 30, F.col("baseline_12m_avg_order_value")))
    assert E.design_matrix(holes, E.LINEAR, CONFIG, E.TOTAL_OUTCOME).count() == 270
    assert E.design_matrix(holes, QUICK_TREES, CONFIG, E.TOTAL_OUTCOME).count() == 300


def test_propensity_match(spark):
    df = generated(spark, 3000, 0, f"CAST({uniform(17)} < 0.05 + 0.4 * baseline_12m_revenue_sum / 500 AS INT)").cache()
    scored = M.propensity_scores(df, CONFIG)
    assert scored.count() == 3000
    matched = M.propensity_match(scored, CONFIG)
    assert matched.schema.fieldNames() == S.PROPENSITY_MATCHED.fieldNames()
    arms = {r.treatment_group: r["count"] for r in matched.groupBy("treatment_group").count().collect()}
    assert arms["treatment"] == df.where("treatment = 1").count()
    assert 0 < arms["matched_control"] <= arms["treatment"]
    assert matched.groupBy("addressLink").count().where("count > 1").count() == 0
    assert M.propensity_auc(scored) > 0.6
    assert matched.where("treatment = 1 AND stratum_rank IS NOT NULL").count() == 0
    before, after = D.covariate_balance(df).first(), D.covariate_balance(matched).first()
    assert abs(after.smd_baseline_12m_revenue_sum) < abs(before.smd_baseline_12m_revenue_sum)
    report = D.match_report(df, matched, 0.7).first()
    assert report.treated_count == arms["treatment"] and report.matched_control_count == arms["matched_control"]
    assert report.match_rate == pytest.approx(arms["matched_control"] / arms["treatment"])
    trimmed = M.propensity_scores(df, replace(CONFIG, score_floor=0.2), trim=True)
    assert 0 < trimmed.count() < 3000 and trimmed.where("propensity_score_raw < 0.2").count() == 0


def test_rebalancing_takes_two_controls_per_treated(spark):
    df = spark.range(20_000).selectExpr("CAST(id AS STRING) AS addressLink", "CAST(id % 10 = 0 AS INT) AS treatment")
    kept = {r.treatment: r["count"] for r in M.rebalanced(df, CONFIG).groupBy("treatment").count().collect()}
    assert kept[1] == 2000 and 3800 < kept[0] < 4200
    balanced = df.where("treatment = 1 OR CAST(addressLink AS INT) % 7 = 0")
    assert M.rebalanced(balanced, CONFIG).count() > 0


def test_comparison_names_the_designs(spark):
    row = spark.createDataFrame([tuple([0.0] * 4 + [1] + [0.0] * 19)], S.LIFT_SUMMARY)
    assert [r.design for r in D.compare_estimates({"a": row, "b": row}).collect()] == ["a", "b"]


def test_segment_effects_equal_plain_least_squares(spark):
    flags = [f"CAST({uniform(60 + i)} > 0.5 AS DOUBLE) AS seg_{s}" for i, s in enumerate(E.SEGMENTS)]
    df = spark.range(2000).selectExpr("id", f"{uniform(70)} - 0.5 AS t_res", *flags)
    df = df.selectExpr("*", f"t_res * (2 + 3 * seg_young - seg_lapsed) + {uniform(71)} AS y_res")
    fit = E.segment_effects(df)

    pdf = df.toPandas()
    t = pdf["t_res"].to_numpy()
    x = np.column_stack([t, *[t * pdf[f"seg_{s}"] for s in E.SEGMENTS], np.ones(len(t))])
    y = pdf["y_res"].to_numpy()
    inverse = np.linalg.inv(x.T @ x)
    beta = inverse @ x.T @ y
    errors = np.sqrt(np.diag(inverse) * ((y - x @ beta) ** 2).sum() / (len(y) - x.shape[1]))
    assert fit.coefficients == pytest.approx(list(beta[:-1]))
    assert fit.standard_errors == pytest.approx(list(errors[:-1]))
    by_name = dict(zip(("base", *E.SEGMENTS), fit.p_values))
    assert by_name["young"] < 0.001 and by_name["lapsed"] < 0.001 and by_name["senior"] > 0.001


def test_trees_take_many_labels_and_ignore_the_layout(few):
    states = few.withColumn("state_label", F.concat(F.lit("s"), F.pmod(F.xxhash64("addressLink"), F.lit(60))))
    lifts = [
        E.estimate_lift(layout, CONFIG, QUICK_TREES).first().incremental_lift
        for layout in (states.coalesce(1), states.repartition(7))
    ]
    assert lifts[0] == pytest.approx(lifts[1], abs=1e-9)


def test_placebo_features_do_not_see_its_days(few):
    before = E.with_model_columns(few, E.PLACEBO_OUTCOME)
    more = few.withColumns(
        {
            "baseline_60d_revenue": F.col("baseline_60d_revenue") + 70,
            "baseline_12m_revenue_sum": F.col("baseline_12m_revenue_sum") + 70,
            "baseline_60d_orders": F.col("baseline_60d_orders") + 2,
            "baseline_12m_orders": F.col("baseline_12m_orders") + 2,
        }
    )
    after = E.with_model_columns(more, E.PLACEBO_OUTCOME)
    for learner in (E.LINEAR, E.TREES):
        names = learner.numeric(E.PLACEBO_OUTCOME)
        sums = [F.round(F.sum(F.col(c).cast("double")), 4).alias(c) for c in names]
        assert before.agg(*sums).first() == after.agg(*sums).first()


def test_unknown_learner_is_refused():
    with pytest.raises(ValueError):
        E.Learner("forest")


def test_recency_of_never_buyers_comes_from_the_configuration(few):
    never = few.drop("has_baseline_purchase").withColumn("days_since_last_baseline_purchase", F.lit(181))
    flagged = E.with_model_columns(never, E.TOTAL_OUTCOME, 181)
    assert flagged.where("has_baseline_purchase = 1").count() == 0
