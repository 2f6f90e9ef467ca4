"""Household-level advertising lift on Spark: assignment, features, matching, effects."""

from hearthlift.config import GROCERY_CAMPAIGN, CampaignConfig

__all__ = ["CampaignConfig", "GROCERY_CAMPAIGN"]
