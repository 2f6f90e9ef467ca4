"""How good the match is, and whether the estimate can be believed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthlift.sources.staging import stage

# The covariates that the match report shows.
BALANCE_COVARIATES = ("baseline_12m_revenue_sum", "baseline_12m_orders", "days_since_last_baseline_purchase")


def _arm(value: int) -> Column:
    return F.col("treatment") == value


def _percent_over(treated: str, control: str) -> Column:
    base = F.nullif(F.col(control), F.lit(0.0))
    return (F.col(treated) - F.col(control)) / base * 100


def _balance_moments(covariates: Sequence[str], among: Column) -> list[Column]:
    return [
        function(F.when(among & _arm(arm), F.col(c))).alias(f"_{name}_{arm}_{c}")
        for c in covariates
        for arm in (1, 0)
        for name, function in (("mean", F.avg), ("var", F.var_samp))
    ]


def _standardised_differences(covariates: Sequence[str]) -> list[Column]:
    def difference(c: str) -> Column:
        pooled = F.sqrt((F.col(f"_var_1_{c}") + F.col(f"_var_0_{c}")) / 2)
        return (F.col(f"_mean_1_{c}") - F.col(f"_mean_0_{c}")) / F.nullif(pooled, F.lit(0.0))

    return [difference(c).alias(f"smd_{c}") for c in covariates]


def covariate_balance(matched: DataFrame, covariates: Sequence[str] = BALANCE_COVARIATES) -> DataFrame:
    """Standardised mean difference of every covariate, one column each, from one aggregation."""
    moments = matched.agg(*_balance_moments(covariates, F.lit(True)))
    return moments.select(*_standardised_differences(covariates))


# Slices of a covariate's values, of about as many rows each, within which counts are added up.
BALANCE_SLICES = 256


def balance_table(matched: DataFrame, covariates: Sequence[str], treatment: str = "treatment") -> DataFrame:
    """One row per covariate: rows of either arm, standardised mean difference, variance ratio (treated over
    control), and the Kolmogorov distance of the two distributions. Missing values count nowhere; a measure that
    is not defined is missing.

    All covariates go through the same two aggregations: moments by covariate, and counts of either arm by covariate
    and distinct value. The counts are added up in the order of the values within slices, whose edges are
    quantiles from the first aggregation, and then over the slices, so that no task has all values of a covariate."""
    values = [F.col(c).cast("double").alias(c) for c in covariates]
    long = matched.select(F.col(treatment).alias("arm"), *values).unpivot(["arm"], list(covariates), "covariate", "value")
    long = stage(long.where("value IS NOT NULL AND arm IN (0, 1)"), "balance-values")
    arms = {"treated": F.col("arm") == 1, "control": F.col("arm") == 0}
    shares = [k / BALANCE_SLICES for k in range(1, BALANCE_SLICES)]
    moments = long.groupBy("covariate").agg(
        *[F.count_if(arm).alias(f"{name}_rows") for name, arm in arms.items()],
        *[f(F.when(arm, F.col("value"))).alias(f"{part}_{name}") for name, arm in arms.items() for part, f in (("mean", F.avg), ("var", F.var_samp))],
        F.percentile_approx("value", shares, 1_000).alias("edges"),
    )
    moments = stage(moments, "balance-moments")  # a row a covariate
    counts = long.groupBy("covariate", "value").agg(*[F.count_if(arm).alias(name) for name, arm in arms.items()])
    counts = counts.join(F.broadcast(moments.select("covariate", "edges")), "covariate")
    below = F.size(F.filter("edges", lambda e: e < F.col("value")))
    counts = stage(counts.select("covariate", "value", *arms, below.alias("slice")), "balance-counts")
    earlier = Window.partitionBy("covariate").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.groupBy("covariate", "slice").agg(*[F.sum(a).alias(a) for a in arms])
    starts = starts.select("covariate", "slice", *[F.coalesce(F.sum(a).over(earlier), F.lit(0)).alias(f"{a}_before") for a in arms])
    upto = Window.partitionBy("covariate", "slice").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    sums = counts.withColumns({f"{a}_upto": F.sum(a).over(upto) for a in arms}).join(starts, ["covariate", "slice"])
    sums = sums.join(F.broadcast(moments.drop("edges")), "covariate")

    def reached(arm: str) -> Column:
        return (F.col(f"{arm}_before") + F.col(f"{arm}_upto")) / F.nullif(F.col(f"{arm}_rows"), F.lit(0))

    apart = sums.groupBy("covariate").agg(F.max(F.abs(reached("treated") - reached("control"))).alias("ks_distance"))
    pooled = F.sqrt((F.col("var_treated") + F.col("var_control")) / 2)
    return moments.join(F.broadcast(apart), "covariate").select(
        "covariate",
        "treated_rows",
        "control_rows",
        ((F.col("mean_treated") - F.col("mean_control")) / F.nullif(pooled, F.lit(0.0))).alias("smd"),
        (F.col("var_treated") / F.nullif(F.col("var_control"), F.lit(0.0))).alias("variance_ratio"),
        "ks_distance",
    )


def match_report(
    eligible: DataFrame,
    matched: DataFrame,
    propensity_auc: float | None = None,
    outcome: str = "outcome_campaign_product_revenue",
    buyer: str = "outcome_campaign_product_buyer",
    covariates: Sequence[str] = BALANCE_COVARIATES,
) -> DataFrame:
    """One row: arm sizes, match rate, outcome and conversion per matched arm, balance, model AUC.

    Both tables are reduced together, in a single aggregation over their union.
    """
    columns = ["treatment", outcome, buyer, *covariates]
    before = eligible.select(*columns, F.lit(False).alias("_chosen"))
    after = matched.select(*columns, F.lit(True).alias("_chosen"))
    chosen = F.col("_chosen")
    rows = before.unionByName(after).agg(
        F.count_if(~chosen & _arm(1)).alias("treated_count"),
        F.count_if(~chosen & _arm(0)).alias("control_count_pre_match"),
        F.count_if(chosen & _arm(0)).alias("matched_control_count"),
        F.avg(F.when(chosen & _arm(1), F.col(outcome))).alias("avg_revenue_treated"),
        F.avg(F.when(chosen & _arm(0), F.col(outcome))).alias("avg_revenue_control"),
        F.avg(F.when(chosen & _arm(1), F.col(buyer))).alias("conversion_rate_treated"),
        F.avg(F.when(chosen & _arm(0), F.col(buyer))).alias("conversion_rate_control"),
        *_balance_moments(covariates, chosen),
    )
    gain = F.col("avg_revenue_treated") - F.col("avg_revenue_control")
    return rows.select(
        "treated_count",
        "control_count_pre_match",
        "matched_control_count",
        (F.col("matched_control_count") / F.nullif(F.col("treated_count"), F.lit(0))).alias("match_rate"),
        F.lit(propensity_auc).cast("double").alias("propensity_model_auc"),
        "avg_revenue_treated",
        "avg_revenue_control",
        (gain * F.col("treated_count")).alias("incremental_revenue"),
        _percent_over("avg_revenue_treated", "avg_revenue_control").alias("lift_revenue_pct"),
        "conversion_rate_treated",
        "conversion_rate_control",
        _percent_over("conversion_rate_treated", "conversion_rate_control").alias("lift_conversion_pct"),
        *_standardised_differences(covariates),
    )


def placebo_verdict(summary: DataFrame) -> DataFrame:
    """Adds `placebo_passed`: no significant effect, and the limits span zero."""
    spans_zero = (F.col("lift_ci_lower") <= 0) & (F.col("lift_ci_upper") >= 0)
    return summary.withColumn("placebo_passed", (F.col("lift_p_value") > 0.05) & spans_zero)


def compare_estimates(summaries: Mapping[str, DataFrame]) -> DataFrame:
    """Result rows of several designs under one another, each with its name in `design`."""
    named = [row.select(F.lit(name).alias("design"), "*") for name, row in summaries.items()]
    return reduce(DataFrame.unionByName, named)
