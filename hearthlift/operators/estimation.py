"""Average and per-segment treatment effects by cross-fitted double machine learning."""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlift import schemas as S
from hearthlift.config import CampaignConfig
from hearthlift.functions.hashing import hash_bucket
from hearthlift.functions.labels import estimated_age, estimated_income_code, majority_gender, ordinal
from hearthlift.functions.values import capped, clipped, flag
from hearthlift.operators import boosting, newton
from hearthlift.operators.conform import conform, with_baseline_flag
from hearthlift.operators.least_squares import cross_products, fitted
from hearthlift.operators.matching import assemble
from hearthlift.operators.ranking import area_under_curve
from hearthlift.sources.staging import stage

log = logging.getLogger(__name__)

TOTAL_OUTCOME = "outcome_total_campaign_revenue"
PRODUCT_OUTCOME = "outcome_campaign_product_revenue"
PLACEBO_OUTCOME = "baseline_60d_revenue"

# Features of the linear nuisance models and of the tree models.
LINEAR_NUMERIC = (
    "pre_campaign_total_order_value",
    "baseline_60d_revenue",
    "baseline_purchase_tenure_days",
    "days_since_last_baseline_purchase",
    "baseline_12m_avg_order_value",
    "baseline_12m_avg_items_per_order",
    "baseline_12m_orders",
    "est_age",
    "est_income_code",
)
LINEAR_CATEGORICAL = ("gender", "state_label")
TREE_NUMERIC = (
    "pre_campaign_total_order_value",
    "baseline_60d_revenue",
    "baseline_purchase_tenure_days",
    "days_since_last_baseline_purchase",
    "baseline_12m_avg_order_value",
    "baseline_12m_avg_items_per_order",
    "baseline_12m_orders",
    "baseline_12m_quantity_sum",
    "baseline_60d_orders",
    "baseline_campaign_product_revenue",
    "campaign_product_revenue_share",
    "recent_60d_revenue_share",
    "recent_60d_order_share",
    "has_baseline_purchase",
    "prior_campaign_product_buyer",
    "recent_60d_buyer",
    "lapsed_60d_buyer",
    *[name for name in S.AGE_COUNTS if name != "age_lt_18_count"],
    *S.CODED_INCOME_COUNTS,
    "revenue_bin_ordinal",
    "buyer_label_ordinal",
)
TREE_CATEGORICAL = ("gender", "state_label", "poc_label", "campaign_product_affinity_label")
# Treated households have exposures and controls have none, so the first of these gives the
# treatment away. Only for comparison with results that were made with them.
EXPOSURE_FEATURES = ("exposure_frequency_deduped", "person_record_count")

# Features made from the days of an outcome that is itself a baseline column. Spend, orders and order value
# are not among them: with_model_columns takes those days out of them.
OUTCOME_PARTS = {
    PLACEBO_OUTCOME: (
        "baseline_60d_revenue",
        "days_since_last_baseline_purchase",
        "baseline_12m_avg_items_per_order",
        "baseline_12m_quantity_sum",
        "baseline_60d_orders",
        "baseline_campaign_product_revenue",
        "campaign_product_revenue_share",
        "recent_60d_revenue_share",
        "recent_60d_order_share",
        "has_baseline_purchase",
        "prior_campaign_product_buyer",
        "recent_60d_buyer",
        "lapsed_60d_buyer",
        "revenue_bin_ordinal",
        "buyer_label_ordinal",
        "campaign_product_affinity_label",
    )
}


@dataclass(frozen=True)
class Learner:
    """Nuisance models of one kind: their features, what is capped, and the models themselves."""

    kind: str = "linear"
    exposure_features: bool = False
    # Iterations, depth, step, row share and bins of the boosted trees.
    tree_iterations: int = 50
    tree_depth: int = 5
    tree_step: float = 0.1
    tree_rows: float = 0.8
    tree_bins: int = 32
    # Ridge weight of the treatment model, and where the outcome model's loss turns linear.
    ridge: float = 0.1
    epsilon: float = 1.35

    def __post_init__(self):
        if self.kind not in ("linear", "trees"):
            raise ValueError(f"unknown kind of learner: {self.kind}")

    def numeric(self, outcome: str) -> list[str]:
        names = LINEAR_NUMERIC if self.kind == "linear" else TREE_NUMERIC
        if self.kind != "linear" and self.exposure_features:
            names = (*names, *EXPOSURE_FEATURES)
        return [name for name in names if name not in OUTCOME_PARTS.get(outcome, ())]

    @property
    def categorical(self) -> tuple[str, ...]:
        return LINEAR_CATEGORICAL if self.kind == "linear" else TREE_CATEGORICAL

    def labelled(self, outcome: str) -> list[str]:
        """The categorical features for an outcome."""
        return [name for name in self.categorical if name not in OUTCOME_PARTS.get(outcome, ())]

    @property
    def invalid(self) -> str:
        """Linear models leave out rows with a null feature; for trees nulls are filled before."""
        return "skip" if self.kind == "linear" else "error"

    def capped_columns(self, outcome: str) -> list[str]:
        names = ["post_campaign_total_order_value", "pre_campaign_total_order_value", "baseline_60d_revenue"]
        if self.kind != "linear":
            names.append("baseline_campaign_product_revenue")
        return [name for name in names if name not in OUTCOME_PARTS.get(outcome, ())]


SKETCH_ACCURACY = 10_000
PARTS = 1_000

LINEAR = Learner("linear")
TREES = Learner("trees")


def outcome_column(df: DataFrame, wanted: str = TOTAL_OUTCOME) -> str:
    """The wanted outcome, or product revenue, with a warning, where total revenue is not carried."""
    if wanted in df.columns:
        return wanted
    if wanted == TOTAL_OUTCOME and PRODUCT_OUTCOME in df.columns:
        log.warning("%s is absent; the effect is estimated on %s", TOTAL_OUTCOME, PRODUCT_OUTCOME)
        return PRODUCT_OUTCOME
    raise ValueError(f"outcome column {wanted} is absent")


def with_model_columns(df: DataFrame, outcome: str, never_days: int = 366) -> DataFrame:
    """Outcome, earlier spend, household attributes and ordinal encodings for the models.

    For the placebo, whose outcome is spend in the last 60 days, earlier spend, orders and order value
    end where those days begin. `never_days` is the recency of households that never bought.
    """
    df = with_baseline_flag(df, never_days)
    spend = F.col("baseline_12m_revenue_sum").cast("double")
    before = {}
    if outcome == PLACEBO_OUTCOME:
        spend = spend - F.coalesce(F.col(outcome).cast("double"), F.lit(0.0))
        orders = F.col("baseline_12m_orders") - F.coalesce(F.col("baseline_60d_orders"), F.lit(0))
        before = {
            "baseline_12m_orders": orders,
            "baseline_12m_avg_order_value": F.coalesce(spend / F.nullif(orders.cast("double"), F.lit(0.0)), F.lit(0.0)),
        }
    return df.withColumns(
        {
            **before,
            "post_campaign_total_order_value": F.col(outcome).cast("double"),
            "pre_campaign_total_order_value": spend,
            "baseline_60d_revenue": F.col("baseline_60d_revenue").cast("double"),
            "gender": majority_gender(),
            "est_age": estimated_age(),
            "est_income_code": estimated_income_code(),
            **{
                name: ordinal(label, order)
                for name, label, order in (
                    ("revenue_bin_ordinal", "baseline_12m_revenue_sum_bin", S.SPEND_TIER_ORDER),
                    ("buyer_label_ordinal", "baseline_buyer_label", S.BUYER_LABEL_ORDER),
                )
                if label in df.columns
            },
        }
    )


def upper_limits(df: DataFrame, columns: Sequence[str], share: float = 0.99) -> dict[str, float | None]:
    """Exact quantile of every column: the smallest value with at least `share` of the values up to it.

    A mergeable sketch narrows each column to a strip around the quantile. If the table is large
    enough for the sketch to be inexact, the values inside the strips are counted part by part until one
    is left, which touches a few ten-thousandths of the rows and needs no sort. The result
    therefore does not depend on how rows are merged, as a sketch alone would.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    margin = 2 / SKETCH_ACCURACY
    while True:
        shares = [max(share - margin, 0.0), share, min(share + margin, 1.0)]
        strips = numbers.agg(
            *[F.percentile_approx(c, shares, SKETCH_ACCURACY).alias(c) for c in columns],
            F.count("*").alias("_rows"),
        ).first()
        if strips["_rows"] * margin < 1:
            return {c: strips[c][1] if strips[c] else None for c in columns}
        known = {c: strips[c] for c in columns if strips[c]}
        if margin > 1:
            known = {c: [-math.inf, strip[1], math.inf] for c, strip in known.items()}
        limits = _ranked_in_strip(numbers, known, share)
        if limits is not None:
            return {c: limits.get(c) for c in columns}
        if margin > 1:
            raise ArithmeticError(f"no quantile of {', '.join(known)} was found")
        margin *= 10


def _part_of(value: Column, low: float, high: float) -> Column:
    """Part of low..high, whose ends are parts of their own so that every round narrows them."""
    within = F.floor((value / 2 - low / 2) / (high / 2 - low / 2) * PARTS).cast("long")
    return F.when(value == low, -1).when(value == high, PARTS + 1).otherwise(within)


def _ranked_in_strip(numbers: DataFrame, strips: dict[str, list[float]], share: float) -> dict[str, float] | None:
    """Quantile by rank among the values of each strip; None if a quantile lies outside its strip.

    Values are counted by PARTS parts of the strip, and the part that holds the rank is the next strip, until
    one value is left. Nothing is sorted, and a part per row is all that reaches the driver.
    """
    inside = {c: F.when(F.col(c).between(low, high), F.col(c)) for c, (low, _, high) in strips.items()}
    sides = numbers.agg(
        *[F.count(c).alias(f"n_{c}") for c in strips],
        *[F.count_if(F.col(c) < low).alias(f"below_{c}") for c, (low, _, _) in strips.items()],
        *[f(v).alias(f"{f.__name__}_{c}") for c, v in inside.items() for f in (F.count, F.min, F.max)],
    ).first()
    wanted = {c: math.ceil(share * sides[f"n_{c}"]) - sides[f"below_{c}"] for c in strips}
    if any(not 1 <= wanted[c] <= sides[f"count_{c}"] for c in strips):
        return None
    ends = {c: (sides[f"min_{c}"], sides[f"max_{c}"]) for c in strips}
    while open_ := [c for c, (low, high) in ends.items() if low < high]:
        values = numbers.select(*[F.when(F.col(c).between(*ends[c]), F.col(c)).alias(c) for c in open_])
        part = reduce(
            lambda rest, c: F.when(F.col("name") == c, _part_of(F.col("value"), *ends[c])).otherwise(rest),
            open_,
            F.lit(None).cast("long"),
        )
        parts = values.unpivot([], open_, "name", "value").where(F.col("value").isNotNull())
        parts = parts.groupBy("name", part.alias("part")).agg(
            F.count("*").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high")
        )
        found = parts.orderBy("name", "low").collect()
        for c in open_:
            for row in (r for r in found if r["name"] == c):
                if wanted[c] <= row["rows"]:
                    ends[c] = (row["low"], row["high"])
                    break
                wanted[c] -= row["rows"]
    return {c: low for c, (low, _) in ends.items()}


def winsorised(df: DataFrame, limits: dict[str, float]) -> DataFrame:
    return df.withColumns({name: capped(F.col(name).cast("double"), limit) for name, limit in limits.items()})


# The effect segments, in the order of the result columns.
SEGMENTS = ("existing_buyer", "lapsed", "young", "senior", "high_income")


def segment_flags() -> dict[str, Column]:
    conditions = {
        "lapsed": F.col("days_since_last_baseline_purchase") >= 30,
        "young": F.col("est_age") <= 35,
        "senior": F.col("est_age") >= 55,
        "high_income": F.col("est_income_code") >= 20,
    }
    buyer = F.col("has_baseline_purchase").cast("double")
    return {"existing_buyer": buyer, **{name: flag(c).cast("double") for name, c in conditions.items()}}


def design_matrix(matched: DataFrame, learner: Learner, config: CampaignConfig, outcome: str) -> DataFrame:
    """Written table of outcome, treatment, features, segments and fold, partitioned by fold."""
    df = conform(matched, S.ALL_FEATURES, [S.HOUSEHOLD, "treatment"], "matched households")
    df = with_model_columns(df, outcome, config.never_purchased_days)
    numeric, categorical = learner.numeric(outcome), learner.labelled(outcome)
    if learner.kind != "linear":
        never = {"days_since_last_baseline_purchase": config.never_purchased_days}  # also a segment's column
        texts = {name: "missing" for name in categorical}
        df = df.fillna({**{name: 0 for name in numeric}, **never, **texts})
    df = winsorised(df, upper_limits(df, learner.capped_columns(outcome)))
    df = assemble(df, numeric, categorical, learner.invalid)
    fold = hash_bucket(F.col(S.HOUSEHOLD), config.folds, config.seed, config.order_hash)
    design = df.select(
        S.HOUSEHOLD,
        F.col("treatment").cast("int").alias("treatment"),
        "post_campaign_total_order_value",
        "features",
        *[value.alias(f"seg_{name}") for name, value in segment_flags().items()],
        fold.alias("fold"),
    )
    return stage(design, "design", ["fold"])


def linear_fits(design: DataFrame, learner: Learner, config: CampaignConfig) -> list[newton.Solution]:
    """The outcome and the treatment model of every fold, fitted on the rows outside it, all in the same passes."""
    rows = design.select("fold", "treatment", "post_campaign_total_order_value", vector_to_array("features").alias("features"))
    problems = [
        problem
        for fold in range(config.folds)
        for problem in (
            newton.Problem(newton.HUBER, "post_campaign_total_order_value", fold, epsilon=learner.epsilon),
            newton.Problem(newton.LOGISTIC, "treatment", fold, learner.ridge),
        )
    ]
    return newton.solve(rows, problems, len(boosting.feature_names(design)))


def linear_predictions(design: DataFrame, fits: Sequence[newton.Solution]) -> DataFrame:
    """Every row with `y_hat` and `t_score` by the models of its own fold."""
    df = design.withColumn("features", vector_to_array("features"))

    def by_fold(kind: str) -> Column:
        cases = [
            (F.col("fold") == s.problem.fold, s.linear(F.col("features"))) for s in fits if s.problem.kind == kind and s.rows
        ]
        return reduce(lambda rest, case: F.when(*case).otherwise(rest), cases, F.lit(None).cast("double"))

    score = 1.0 / (1.0 + F.exp(-by_fold(newton.LOGISTIC)))
    return df.withColumns({"y_hat": by_fold(newton.HUBER), "t_score": score}).drop("features")


def cross_fit(design: DataFrame, learner: Learner, config: CampaignConfig) -> DataFrame:
    """Written table of out-of-fold predictions `y_hat` and `t_score`.

    All models are fitted in passes that they share, each on the rows outside its fold, and every row is scored
    once, by the models of its own fold."""
    if learner.kind == "linear":
        return stage(linear_predictions(design, linear_fits(design, learner, config)), "out-of-fold")
    binned, settings = boosting.binned_rows(design, learner, config)
    return stage(boosting.out_of_fold(binned, boosting.boosted_trees(binned, settings), settings), "out-of-fold")


def residuals(predicted: DataFrame, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Outcome and treatment residuals; the treatment score is clipped first."""
    return predicted.withColumns(
        {
            "y_res": F.col("post_campaign_total_order_value") - F.col("y_hat"),
            "t_res": F.col("treatment") - clipped(F.col("t_score"), low, high),
        }
    )


@dataclass(frozen=True)
class Fit:
    """Coefficients of a least-squares fit; errors and p-values are None if it is singular."""

    coefficients: list[float]
    standard_errors: list[float | None]
    p_values: list[float | None] = field(default_factory=list)


def least_squares(df: DataFrame, label: str, columns: Sequence[str]) -> Fit:
    """OLS with intercept from one aggregation of centred products."""
    sums = df.agg(*cross_products(F.col(label), [F.col(c) for c in columns], "fit"))
    row = fitted(sums, {"fit": len(columns)}).first()
    return Fit(row["fit_b"], row["fit_e"], row["fit_p"])


def segment_terms() -> list[Column]:
    """The treatment residual, and its product with every segment."""
    return [F.col("t_res"), *[F.col("t_res") * F.col(f"seg_{name}") for name in SEGMENTS]]


def residual_effect(df: DataFrame) -> Fit:
    """Average effect: slope of outcome residuals on treatment residuals."""
    return least_squares(df, "y_res", ["t_res"])


def segment_effects(df: DataFrame) -> Fit:
    """Base effect and its change per segment, from interactions of the treatment residual.

    A segment that follows from the earlier ones changes nothing."""
    products = {f"_t_{name}": term for name, term in zip(SEGMENTS, segment_terms()[1:], strict=True)}
    return least_squares(df.withColumns(products), "y_res", ["t_res", *products])


def effect_row(df: DataFrame) -> DataFrame:
    """One row from one pass: statistics of the fit, average effect (`mean_b`, `_e` and `_p`, arrays of one) and
    segment effects (`part_b`: the base, then the changes; `_e` and `_p` alike)."""
    terms = segment_terms()
    sums = [*cross_products(F.col("y_res"), terms[:1], "mean"), *cross_products(F.col("y_res"), terms, "part")]
    return fitted(df.agg(*statistics(), *sums), {"mean": 1, "part": len(terms)})


def statistics() -> list[Column]:
    """Aggregates: row and treated counts, mean outcome of the treated, R² of the outcome predictions."""
    y, treated = F.col("post_campaign_total_order_value"), F.col("treatment") == 1
    return [
        F.count("*").alias("total_row_count"),
        F.sum(F.col("treatment").cast("double")).alias("treated_count"),
        F.avg(F.when(treated, y)).alias("avg_treatment_amount"),
        (1 - F.sum((y - F.col("y_hat")) ** 2) / F.nullif(F.var_pop(y) * F.count(y), F.lit(0.0))).alias("outcome_r2"),
    ]


def fit_statistics(df: DataFrame) -> DataFrame:
    return df.agg(*statistics())


def treatment_auc(df: DataFrame, score: str = "t_score") -> DataFrame:
    """One row with `treatment_auc`."""
    return area_under_curve(df, "treatment", score).withColumnRenamed("auc", "treatment_auc")


def lift_columns(effect: Column, error: Column, treated_mean: Column) -> dict[str, Column]:
    """Counterfactual mean, lift in percent of it, and 95 % limits; percents are null if it is 0."""
    expected = treated_mean - effect
    low, high = effect - 1.96 * error, effect + 1.96 * error
    return {
        "expected_amount": expected,
        "lift_percent": effect / F.nullif(expected, F.lit(0.0)) * 100,
        "lift_ci_lower": low,
        "lift_ci_upper": high,
        "lift_pct_ci_lower": low / F.nullif(expected, F.lit(0.0)) * 100,
        "lift_pct_ci_upper": high / F.nullif(expected, F.lit(0.0)) * 100,
    }


def lift_summary(predicted: DataFrame, config: CampaignConfig) -> DataFrame:
    """The 24-column result row from out-of-fold predictions."""
    df = residuals(predicted, config.score_floor, config.score_ceiling)
    base = F.col("part_b")[0]
    row = effect_row(df).withColumns(
        {
            "avg_treatment_amount": F.coalesce(F.col("avg_treatment_amount"), F.lit(0.0)),
            "treatment_auc": F.lit(treatment_auc(df).first()[0]).cast("double"),
            "incremental_lift": F.col("mean_b")[0],
            "lift_p_value": F.col("mean_p")[0],
            "ate_base": base,
            **{f"cate_{name}": base + F.col("part_b")[j] for j, name in enumerate(SEGMENTS, 1)},
            **{f"cate_{name}_p_value": F.col("part_p")[j] for j, name in enumerate(SEGMENTS, 1)},
        }
    )
    lift = lift_columns(F.col("incremental_lift"), F.col("mean_e")[0], F.col("avg_treatment_amount"))
    return row.withColumns(lift).select(*[F.col(f.name).cast(f.dataType) for f in S.LIFT_SUMMARY.fields])


def estimate_lift(
    matched: DataFrame, config: CampaignConfig, learner: Learner = LINEAR, outcome: str = TOTAL_OUTCOME
) -> DataFrame:
    """Lift of the campaign among matched households, as one row.

    Reads `matched` a few times (quantiles, labels, design): pass a written table.
    With outcome 'baseline_60d_revenue' this is the placebo run: nothing the campaign did can have
    changed it, and features made from it are left out.
    """
    design = design_matrix(matched, learner, config, outcome_column(matched, outcome))
    return lift_summary(cross_fit(design, learner, config), config)
