"""The single jobs of a lift measurement, run on named tables.

Each step reads its tables by name through :class:`TableAccess` (with the tables' column maps),
computes one result table and publishes it as the view `result`, so that steps can be scheduled
one by one with any storage between them. `plans.campaign` runs them all in one session.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from hearthlift.config import CampaignConfig
from hearthlift.operators.conversions import household_conversions
from hearthlift.operators.diagnostics import placebo_verdict
from hearthlift.operators.estimation import LINEAR, PLACEBO_OUTCOME, TREES, Learner, estimate_lift
from hearthlift.operators.exposures import household_assignment
from hearthlift.operators.features import household_features
from hearthlift.operators.identity import identity_households
from hearthlift.operators.matching import propensity_match, propensity_scores, stratify
from hearthlift.sources.staging import stage
from hearthlift.sources.tables import TableAccess


@dataclass(frozen=True)
class Step:
    """Names of the tables a step reads, and its function of them and the configuration."""

    reads: tuple[str, ...]
    run: Callable[..., DataFrame]


def _conversions(conversion, mapping, demographics, campaign, config):
    identities = stage(identity_households(mapping, demographics), "identities")
    return household_conversions(conversion, identities, campaign, config)


def _assignment(exposure, mapping, demographics, config):
    return household_assignment(exposure, identity_households(mapping, demographics), mapping, config)


def _features(raw_exposure, raw_conversion, sample_insights, config):
    return household_features(raw_exposure, raw_conversion, sample_insights, config)


def _propensity(features, config):
    return propensity_match(propensity_scores(features, config), config)


def _lift(learner: Learner):
    return lambda matched, config: estimate_lift(matched, config, learner)


def _placebo(learner: Learner):
    return lambda matched, config: placebo_verdict(estimate_lift(matched, config, learner, PLACEBO_OUTCOME))


# The table names that the jobs exchange.
STEPS = {
    "raw_conversion": Step(("conversion", "mapping", "demographics", "campaign"), _conversions),
    "raw_exposure": Step(("exposure", "mapping", "demographics"), _assignment),
    "AllFeatures": Step(("raw_exposure", "raw_conversion", "sample_insights"), _features),
    "StratifiedFeatures": Step(("AllFeatures",), stratify),
    "PSMMatchedFeatures": Step(("AllFeatures",), _propensity),
    "lift_psm": Step(("PSMMatchedFeatures",), _lift(LINEAR)),
    "lift_strata": Step(("StratifiedFeatures",), _lift(LINEAR)),
    "lift_trees": Step(("PSMMatchedFeatures",), _lift(TREES)),
    "placebo_psm": Step(("PSMMatchedFeatures",), _placebo(LINEAR)),
    "placebo_strata": Step(("StratifiedFeatures",), _placebo(LINEAR)),
    "placebo_trees": Step(("PSMMatchedFeatures",), _placebo(TREES)),
}


def run_step(name: str, access: TableAccess, config: CampaignConfig) -> DataFrame:
    """Run one step, publish its table as the result view, and return it."""
    if name not in STEPS:
        raise ValueError(f"unknown step {name}; there are {', '.join(STEPS)}")
    step = STEPS[name]
    result = step.run(*[access.read_mapped(table) for table in step.reads], config)
    access.publish(result)
    return result
