"""Comparable control households: by exact strata or by propensity score."""

from __future__ import annotations

import logging
from functools import reduce
from operator import or_

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlift import schemas as S
from hearthlift.config import CampaignConfig
from hearthlift.functions.hashing import sampled
from hearthlift.functions.values import caliper_bin, clipped, filled_text, has_text
from hearthlift.operators import newton
from hearthlift.operators.conform import conform, filled, typed
from hearthlift.operators.ranking import area_under_curve, match_one_to_one
from hearthlift.sources.staging import stage

log = logging.getLogger(__name__)

_REQUIRED = [S.HOUSEHOLD, "treatment", "is_eligible_control", "has_partial_exposure_within_addresslink"]


def is_treated() -> Column:
    return F.col("treatment").cast("int") == 1


def eligible_households(features: DataFrame) -> DataFrame:
    """Treated households, and controls in which nobody at all was exposed."""
    df = conform(features, S.ALL_FEATURES, _REQUIRED, "household features")
    clean_control = (
        (F.col("treatment").cast("int") == 0)
        & (F.col("is_eligible_control").cast("int") == 1)
        & (F.coalesce(F.col("has_partial_exposure_within_addresslink").cast("int"), F.lit(0)) == 0)
    )
    return df.where(has_text(F.col(S.HOUSEHOLD)) & (is_treated() | clean_control))


def stratum_counts(eligible: DataFrame) -> DataFrame:
    """Treated households and candidate controls of every stratum that has a treated household."""
    return (
        eligible.groupBy(*S.STRATA)
        .agg(
            F.count_if(is_treated()).alias("treatment_addresslinks"),
            F.count_if(~is_treated()).alias("candidate_control_addresslinks"),
        )
        .where(F.col("treatment_addresslinks") > 0)
    )


def stratify(features: DataFrame, config: CampaignConfig) -> DataFrame:
    """The StratifiedFeatures table: within every stratum up to one control per treated household.

    Treated households without a control in their stratum stay. Reads `features` twice: pass a
    written table.
    """
    eligible = eligible_households(features)
    eligible = eligible.withColumns(
        {S.HOUSEHOLD: F.trim(F.col(S.HOUSEHOLD).cast("string")), **{c: filled_text(F.col(c)) for c in S.STRATA}}
    ).withColumn("treatment", F.col("treatment").cast("int"))
    matched = match_one_to_one(eligible, S.STRATA, S.HOUSEHOLD, hash_method=config.order_hash)
    return typed(
        matched.withColumnsRenamed(
            {
                "arm_rank": "stratum_rank",
                "group_treated": "treatment_addresslinks",
                "group_controls": "candidate_control_addresslinks",
            }
        ).withColumns(
            {
                "treatment_group": F.when(is_treated(), "treatment").otherwise("candidate_control"),
                "sampled_unit": F.lit(1),
            }
        ),
        S.STRATIFIED,
    )


def propensity_matrix(eligible: DataFrame) -> DataFrame:
    """Adds the vector of propensity features; rows with a null feature are left out."""
    defaults = {c: "missing" for c in S.PROPENSITY_CATEGORICAL}
    absent = {c: 0.0 for c in S.PROPENSITY_NUMERIC if c not in eligible.columns}
    df = filled(eligible, {**defaults, **absent})
    return assemble(df, S.PROPENSITY_NUMERIC, S.PROPENSITY_CATEGORICAL, "skip")


def assemble(df: DataFrame, numeric, categorical, invalid: str) -> DataFrame:
    """Vector of the numeric columns and of frequency-ranked labels, all labels in one fit.

    With `invalid` "skip" rows without one of the numbers are left out, and their number is logged."""
    if invalid == "skip":
        left_out = rows_left_out(df, numeric)
        if left_out:
            log.warning("%d rows without one of the numeric features are left out", left_out)
    indexes = [f"{c}_index" for c in categorical]
    if categorical:
        indexer = StringIndexer(inputCols=list(categorical), outputCols=indexes, handleInvalid="keep")
        df = indexer.fit(df).transform(df)
    assembler = VectorAssembler(inputCols=[*numeric, *indexes], outputCol="features", handleInvalid=invalid)
    return assembler.transform(df).drop(*indexes)


def rows_left_out(df: DataFrame, numeric) -> int:
    """Rows in which a numeric feature is null or not a number."""
    return df.where(reduce(or_, [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in numeric])).count()


def rebalanced(matrix: DataFrame, config: CampaignConfig) -> DataFrame:
    """All treated rows and a hash sample of controls, `control_ratio` per treated row."""
    arms = matrix.agg(F.count_if(is_treated()).alias("treated"), F.count_if(~is_treated()).alias("control")).first()
    wanted = arms["treated"] * config.control_ratio
    if arms["treated"] == 0 or arms["control"] <= wanted:
        return matrix
    keep = sampled(F.col(S.HOUSEHOLD), wanted / arms["control"], config.seed, config.order_hash)
    return matrix.where(is_treated() | keep)


# Fixed value: ridge weight of the propensity model.
PROPENSITY_RIDGE = 0.1


def propensity_fit(features: DataFrame, config: CampaignConfig) -> tuple[DataFrame, newton.Solution]:
    """Eligible households with the vector of their features, and the model fitted on the rebalanced sample."""
    eligible = eligible_households(features).withColumn("treatment", F.col("treatment").cast("int"))
    matrix = propensity_matrix(eligible)
    sample = rebalanced(matrix, config).select("treatment", vector_to_array("features").alias("features"), F.lit(0).alias("fold"))
    width = len(S.PROPENSITY_NUMERIC) + len(S.PROPENSITY_CATEGORICAL)
    problem = newton.Problem(newton.LOGISTIC, "treatment", ridge=PROPENSITY_RIDGE)
    return matrix, newton.solve(stage(sample, "propensity-sample"), [problem], width)[0]


def propensity_scores(features: DataFrame, config: CampaignConfig, trim: bool = False) -> DataFrame:
    """Eligible households with `propensity_score_raw` and the clipped `propensity_score`.

    The model is fitted on the rebalanced sample, which is written for its steps, and scores everybody. `trim`
    drops households outside the clipping limits instead of moving them to the limits. Reads `features` four
    times (labels, arm sizes, sample, scoring): pass a written table. The result is a written table too.
    """
    matrix, fit = propensity_fit(features, config)
    score = 1.0 / (1.0 + F.exp(-fit.linear(vector_to_array("features"))))
    scored = matrix.withColumn("propensity_score_raw", score)
    raw = F.col("propensity_score_raw")
    if trim:
        scored = scored.where(raw.between(config.score_floor, config.score_ceiling))
    scored = scored.withColumn("propensity_score", clipped(raw, config.score_floor, config.score_ceiling))
    return stage(scored.drop("features"), "propensity-scores")


def caliper_match(scored: DataFrame, config: CampaignConfig) -> DataFrame:
    """Within every score bin up to one control per treated household; treated households all stay."""
    binned = scored.withColumn("ps_bin", caliper_bin(F.col("propensity_score"), config.caliper))
    return match_one_to_one(binned, ["ps_bin"], S.HOUSEHOLD, hash_method=config.order_hash)


def propensity_match(scored: DataFrame, config: CampaignConfig) -> DataFrame:
    """The PSMMatchedFeatures table from scored households."""

    def only(condition: Column, value: Column) -> Column:
        return F.when(condition, value)

    household = F.col(S.HOUSEHOLD)
    return typed(
        caliper_match(scored, config).withColumns(
            {
                "treatment_group": F.when(is_treated(), "treatment").otherwise("matched_control"),
                "sampled_unit": F.lit(1),
                "stratum_rank": only(~is_treated(), F.col("arm_rank")),
                "treatment_addresslinks": only(is_treated(), household),
                "candidate_control_addresslinks": only(~is_treated(), household),
            }
        ),
        S.PROPENSITY_MATCHED,
    )


def propensity_auc(scored: DataFrame) -> float | None:
    """Area under the ROC curve of the unclipped score on all eligible households."""
    return area_under_curve(scored, "treatment", "propensity_score_raw").first()[0]


def in_report_order(df: DataFrame) -> DataFrame:
    """Sorted for reading. Not part of the tables: it shuffles everything and changes no row."""
    if "propensity_score" in df.columns:
        return df.orderBy(F.desc("treatment"), "treatment_group", F.desc("propensity_score"), S.HOUSEHOLD)
    if "stratum_rank" in df.columns:
        return df.orderBy(F.desc("treatment"), *S.STRATA, F.desc("treatment_group"), "stratum_rank", S.HOUSEHOLD)
    return df.orderBy(F.desc("treatment"), S.HOUSEHOLD)
