"""The household feature table: assignment, demographics, baseline and outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType

from hearthlift import schemas as S
from hearthlift.config import CampaignConfig
from hearthlift.functions.labels import affinity_label, buyer_label, spend_tier
from hearthlift.functions.values import parse_flag, ratio
from hearthlift.operators.conform import column_or, conform, typed
from hearthlift.operators.demographics import current_people, household_demographics
from hearthlift.operators.purchases import household_purchases

_COUNTS = ("exposure_frequency_deduped", "mapped_online_identity_count", "exposed_online_identity_count")
_PARTIAL = "has_partial_exposure_within_addresslink"
_LABELS = ("baseline_12m_revenue_sum_bin", "campaign_product_affinity_label", "baseline_buyer_label")


def household_roster(assignment: DataFrame) -> DataFrame:
    """All assigned households with typed assignment columns; absent counts are 0."""
    df = conform(assignment, S.RAW_EXPOSURE, [S.HOUSEHOLD, "treatment", "is_eligible_control"], "assignment")
    partial = parse_flag(F.col(_PARTIAL)) if _PARTIAL in df.columns else F.lit(0)
    return df.where(F.col(S.HOUSEHOLD).isNotNull()).select(
        S.HOUSEHOLD,
        F.col("treatment").cast("int").alias("treatment"),
        F.col("is_eligible_control").cast("int").alias("is_eligible_control"),
        partial.alias(_PARTIAL),
        column_or(df, "min_exposure_ts", None, "bigint"),
        *[F.coalesce(column_or(df, c, 0, "bigint"), F.lit(0)).alias(c) for c in _COUNTS],
        *[F.coalesce(column_or(df, c, 0, "bigint"), F.lit(0)).alias(c) for c in ("hhpel_count", "person_record_count")],
        F.coalesce(column_or(df, "mapped_online_identity_count", 0, "bigint"), F.lit(0)).alias("online_identity_count"),
    )


def with_behaviour(df: DataFrame, config: CampaignConfig) -> DataFrame:
    """Recency, tenure, ratios, flags and labels from zero-filled counts and sums.

    Filling comes first: a household without any purchase row and one with purchases during the
    campaign only then look alike before the campaign, as they should. Otherwise the labels, which
    are matching keys, would tell who bought during the campaign.
    """
    orders, revenue = "baseline_12m_orders", "baseline_12m_revenue_sum"
    recent, product = "baseline_60d_orders", "baseline_campaign_product_orders"
    labels = dict(zip(_LABELS, (spend_tier(revenue), affinity_label(product), buyer_label(recent, orders))))
    if config.no_history_labels == "missing":
        labels = {name: F.when(F.col("has_rows"), label).otherwise("missing") for name, label in labels.items()}
    derived = {
        "has_baseline_purchase": "IF(last_baseline_day IS NOT NULL, 1, 0)",
        "days_since_last_baseline_purchase": (
            f"coalesce(datediff(DATE '{config.baseline_end}', last_baseline_day), {config.never_purchased_days})"
        ),
        "baseline_purchase_tenure_days": "coalesce(datediff(last_baseline_day, first_baseline_day), 0)",
        "baseline_12m_avg_order_value": ratio(revenue, orders),
        "baseline_12m_avg_items_per_order": ratio("baseline_12m_quantity_sum", orders),
        "recent_60d_revenue_share": ratio("baseline_60d_revenue", revenue),
        "recent_60d_order_share": ratio(recent, orders),
        "campaign_product_revenue_share": ratio("baseline_campaign_product_revenue", revenue),
        "prior_campaign_product_buyer": f"IF({product} > 0, 1, 0)",
        "recent_60d_buyer": f"IF({recent} > 0, 1, 0)",
        "lapsed_60d_buyer": f"IF({orders} > 0 AND {recent} = 0, 1, 0)",
        "outcome_campaign_product_buyer": "IF(outcome_campaign_product_orders > 0, 1, 0)",
    }
    return df.withColumns({**{name: F.expr(text) for name, text in derived.items()}, **labels})


def household_features(
    assignment: DataFrame, conversions: DataFrame, demographics: DataFrame, config: CampaignConfig
) -> DataFrame:
    """The AllFeatures table: one row per assigned household, with or without history.

    Purchases and demographics arrive aggregated, hence partitioned, by household; each join adds
    no more than the assignment's own shuffle, and no side has a household twice.
    """
    roster = household_roster(assignment)
    purchases = household_purchases(conversions, config).withColumn("has_rows", F.lit(True))
    people = household_demographics(current_people(demographics))
    joined = roster.join(purchases, S.HOUSEHOLD, "left").join(people, S.HOUSEHOLD, "left")
    # What a household has no rows for: counts 0, sums 0.0, texts 'missing', flags false.
    kinds = {StringType(): "missing", DoubleType(): 0.0, LongType(): 0, BooleanType(): False}
    fills = {f.name: kinds[f.dataType] for f in [*purchases.schema, *people.schema] if f.dataType in kinds}
    del fills[S.HOUSEHOLD]
    return typed(with_behaviour(joined.fillna(fills), config), S.ALL_FEATURES)
