"""All steps of a lift measurement in order, each result a written table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from hearthlift.config import CampaignConfig
from hearthlift.operators.conversions import household_conversions
from hearthlift.operators.diagnostics import compare_estimates, match_report, placebo_verdict
from hearthlift.operators.estimation import LINEAR, PLACEBO_OUTCOME, TOTAL_OUTCOME, TREES, estimate_lift
from hearthlift.operators.exposures import household_assignment
from hearthlift.operators.features import household_features
from hearthlift.operators.identity import identity_households
from hearthlift.operators.matching import (
    eligible_households,
    propensity_auc,
    propensity_match,
    propensity_scores,
    stratify,
)
from hearthlift.sources.staging import stage


def prepare_households(sources: Mapping[str, DataFrame], config: CampaignConfig) -> dict[str, DataFrame]:
    """raw_conversion, raw_exposure and AllFeatures from campaign, conversion, exposure,
    demographics and mapping. The identity table is written once and read by both sides."""
    mapping, demographics = sources["mapping"], sources["demographics"]
    identities = stage(identity_households(mapping, demographics), "identities")
    conversions = stage(
        household_conversions(sources["conversion"], identities, sources["campaign"], config), "raw-conversion"
    )
    assignment = stage(household_assignment(sources["exposure"], identities, mapping, config), "raw-exposure")
    features = stage(household_features(assignment, conversions, demographics, config), "all-features")
    return {"raw_conversion": conversions, "raw_exposure": assignment, "AllFeatures": features}


def match_households(features: DataFrame, config: CampaignConfig) -> dict[str, DataFrame]:
    """Both matched tables and the report on the propensity match. `features` is a written table."""
    stratified = stage(stratify(features, config), "stratified")
    scored = propensity_scores(features, config)
    matched = stage(propensity_match(scored, config), "propensity-matched")
    report = match_report(eligible_households(features), matched, propensity_auc(scored))
    return {"StratifiedFeatures": stratified, "PSMMatchedFeatures": matched, "match_report": report}


def estimate_all(
    stratified: DataFrame, matched: DataFrame, config: CampaignConfig, trees: bool = True
) -> dict[str, DataFrame]:
    """The lift row and the placebo row of every design."""
    designs = {"psm_linear": (matched, LINEAR), "strata_linear": (stratified, LINEAR)}
    if trees:
        designs["psm_trees"] = (matched, TREES)
    lifts = {name: estimate_lift(df, config, learner, TOTAL_OUTCOME) for name, (df, learner) in designs.items()}
    placebos = {
        name: placebo_verdict(estimate_lift(df, config, learner, PLACEBO_OUTCOME))
        for name, (df, learner) in designs.items()
    }
    return {"lift": compare_estimates(lifts), "placebo": compare_estimates(placebos)}


def measure_campaign(
    sources: Mapping[str, DataFrame], config: CampaignConfig, trees: bool = True
) -> dict[str, DataFrame]:
    tables = prepare_households(sources, config)
    tables |= match_households(tables["AllFeatures"], config)
    tables |= estimate_all(tables["StratifiedFeatures"], tables["PSMMatchedFeatures"], config, trees)
    return tables
