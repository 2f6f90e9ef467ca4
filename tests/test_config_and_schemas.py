from datetime import date

import pytest

from hearthlift import GROCERY_CAMPAIGN, CampaignConfig
from hearthlift import schemas as S
from hearthlift.operators import estimation as E


def test_windows_follow_from_the_flight():
    assert GROCERY_CAMPAIGN.baseline_start == date(2024, 11, 12)
    assert GROCERY_CAMPAIGN.recent_start == date(2025, 9, 13)
    assert GROCERY_CAMPAIGN.baseline_end == date(2025, 11, 11)
    assert GROCERY_CAMPAIGN.never_purchased_days == 366


@pytest.mark.parametrize(
    "wrong",
    [
        {"flight_end": date(2025, 1, 1)},
        {"recent_days": 0},
        {"recent_days": 400},
        {"order_hash": "sha1"},
        {"no_history_labels": "guess"},
    ],
)
def test_config_is_checked(wrong):
    values = {"campaign_id": 1, "flight_start": date(2025, 2, 1), "flight_end": date(2025, 3, 1), **wrong}
    with pytest.raises(ValueError):
        CampaignConfig(**values)


def test_table_widths():
    assert len(S.RAW_CONVERSION) == 16
    assert len(S.RAW_EXPOSURE) == 10
    assert len(S.ALL_FEATURES) == 100
    assert len(S.STRATIFIED) == 103 + 2
    assert len(S.PROPENSITY_MATCHED) == 104 + 2
    assert len(S.LIFT_SUMMARY) == 24
    assert len(S.PROPENSITY_NUMERIC) + len(S.PROPENSITY_CATEGORICAL) == 79


def test_model_features_exclude_assignment_and_outcomes():
    for outcome in (E.TOTAL_OUTCOME, E.PLACEBO_OUTCOME):
        for learner in (E.LINEAR, E.TREES):
            assert not set(learner.numeric(outcome)) & S.NEVER_FEATURES
            assert not set(learner.categorical) & S.NEVER_FEATURES
    assert not set(S.PROPENSITY_NUMERIC) & S.NEVER_FEATURES


def test_feature_counts():
    assert len(E.LINEAR.numeric(E.TOTAL_OUTCOME)) + len(E.LINEAR.categorical) == 11
    assert len(E.LINEAR.numeric(E.PLACEBO_OUTCOME)) + len(E.LINEAR.labelled(E.PLACEBO_OUTCOME)) == 8
    with_exposure = E.Learner("trees", exposure_features=True)
    assert len(with_exposure.numeric(E.TOTAL_OUTCOME)) + len(with_exposure.categorical) == 68


def test_placebo_leaves_out_what_is_made_from_its_outcome():
    names = E.TREES.numeric(E.PLACEBO_OUTCOME)
    assert "baseline_60d_revenue" not in names and "recent_60d_revenue_share" not in names
    assert "baseline_60d_revenue" not in E.TREES.capped_columns(E.PLACEBO_OUTCOME)
