"""Table contracts: names and types of every source and result table.

Everything here is fixed by the data contract (column names, labels, code ranges,
bucket edges); the rest of the package refers to these names.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

HOUSEHOLD = "addressLink"

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "money": DecimalType(18, 2),
}


def struct(columns: str) -> StructType:
    """A schema from 'name type, name type, ...'; needs no running session."""
    schema = StructType()
    for column in columns.split(", "):
        name, kind = column.split(" ")
        schema.add(name, _TYPES[kind])
    return schema


# Source tables.
CAMPAIGN = struct(
    "campaign_id string, product_brand string, product_manufacturer string, product_id string, "
    "flight_start date, flight_end date, campaign_id_long bigint, publisher_name string"
)
CONVERSION = struct(
    "lr_id string, transaction_category string, order_id string, product_brand string, banner string, "
    "division string, transaction_timestamp_unix int, transaction_amount money, quantity int, product_id int"
)
EXPOSURE = struct(
    "ts bigint, tp_id string, experiment_id string, ad_id bigint, adset_id bigint, campaign_id bigint, "
    "account_id bigint, event_type string, placement_type string, device_platform string, impression_device string"
)
DEMOGRAPHICS = struct(
    "rampid string, Grouping_Indicator string, hhpel string, addressLink string, gender string, age int, "
    "state int, county int, hh_income int, poc boolean, install_date date"
)
MAPPING = struct("install_date date, rampid_dpm string, rampid_meta string, rampid_rmn string")

# Income codes, age buckets (label, first age, last age, midpoint), flag texts.
INCOME_CODES = range(1, 36)
AGE_BUCKETS = (
    ("lt_18", None, 18, None),
    ("18_24", 18, 24, 21.0),
    ("25_34", 25, 34, 29.5),
    ("35_44", 35, 44, 39.5),
    ("45_54", 45, 54, 49.5),
    ("55_64", 55, 64, 59.5),
    ("65_74", 65, 74, 69.5),
    ("75_84", 75, 84, 79.5),
    ("85_plus", 85, None, 90.0),
)
DEFAULT_AGE = 40.0
DEFAULT_INCOME_CODE = 18.0
TRUE_TEXTS = ("1", "true", "t", "yes", "y")
FALSE_TEXTS = ("0", "false", "f", "no", "n")

# Yearly spend tiers in ascending order, each with its exclusive upper edge.
SPEND_TIERS = (
    ("lt_10", 10),
    ("10_to_49", 50),
    ("50_to_99", 100),
    ("100_to_249", 250),
    ("250_to_499", 500),
    ("500_to_999", 1000),
    ("1000_to_1999", 2000),
    ("2000_to_3499", 3500),
    ("3500_to_4999", 5000),
    ("5000_to_7499", 7500),
    ("7500_to_11999", 12000),
)
NO_SPEND_TIER = "zero"
TOP_SPEND_TIER = "12000_plus"
SPEND_TIER_ORDER = (NO_SPEND_TIER, *(name for name, _ in SPEND_TIERS), TOP_SPEND_TIER)
BUYER_LABEL_ORDER = ("no_12m_purchase", "lapsed_buyer", "recent_buyer")

AGE_COUNTS = tuple(f"age_{label}_count" for label, *_ in AGE_BUCKETS)
CODED_INCOME_COUNTS = tuple(f"num_hh_income_code_{code}_in_addresslink" for code in INCOME_CODES)
INCOME_COUNTS = (
    "num_hh_income_missing_in_addresslink",
    "num_hh_income_zero_or_negative_in_addresslink",
    *CODED_INCOME_COUNTS,
    "num_hh_income_code_other_in_addresslink",
)
GENDER_COUNTS = (
    "num_male_in_addresslink",
    "num_female_in_addresslink",
    "num_unknown_or_other_gender_in_addresslink",
)


def _typed(kind: str, names) -> str:
    return ", ".join(f"{name} {kind}" for name in names)


# Result tables.
RAW_CONVERSION = struct(
    "addressLink string, hhpel string, Grouping_Indicator string, online_identity_id string, campaign_id string, "
    "order_id string, product_id bigint, product_brand string, banner string, division string, "
    "transaction_category string, transaction_timestamp_unix bigint, transaction_date date, "
    "transaction_amount double, quantity double, is_campaign_product int"
)
RAW_EXPOSURE = struct(
    "addressLink string, treatment int, is_eligible_control int, min_exposure_ts bigint, "
    "exposure_frequency_deduped bigint, mapped_online_identity_count bigint, exposed_online_identity_count bigint, "
    "person_record_count bigint, hhpel_count bigint, has_partial_exposure_within_addresslink int"
)
_ASSIGNMENT = (
    "addressLink string, treatment int, is_eligible_control int, has_partial_exposure_within_addresslink int, "
    "min_exposure_ts bigint, exposure_frequency_deduped bigint, mapped_online_identity_count bigint, "
    "exposed_online_identity_count bigint, hhpel_count bigint, person_record_count bigint, online_identity_count bigint"
)
_DEMOGRAPHIC = ", ".join(
    [
        "poc_label string, hh_income_code_profile_label string",
        _typed("bigint", INCOME_COUNTS),
        "state_label string",
        _typed("bigint", GENDER_COUNTS),
        "age_bucket_profile_label string, age_missing_count bigint",
        _typed("bigint", AGE_COUNTS),
    ]
)
_BASELINE = (
    "baseline_12m_orders bigint, baseline_12m_revenue_sum double, baseline_12m_quantity_sum double, "
    "baseline_60d_orders bigint, baseline_60d_revenue double, baseline_60d_quantity double, "
    "baseline_campaign_product_orders bigint, baseline_campaign_product_revenue double, "
    "baseline_campaign_product_quantity double, baseline_12m_negative_transaction_count bigint, "
    "baseline_12m_distinct_banners bigint, baseline_12m_distinct_divisions bigint, "
    "baseline_12m_active_purchase_days bigint, num_weeks_purchased_in_last_365_days bigint, "
    "has_baseline_purchase int, days_since_last_baseline_purchase bigint, baseline_purchase_tenure_days bigint, "
    "baseline_12m_avg_order_value double, baseline_12m_avg_items_per_order double, recent_60d_revenue_share double, "
    "recent_60d_order_share double, campaign_product_revenue_share double, prior_campaign_product_buyer int, "
    "recent_60d_buyer int, lapsed_60d_buyer int, baseline_12m_revenue_sum_bin string, "
    "campaign_product_affinity_label string, baseline_buyer_label string"
)
_PRODUCT_OUTCOME = (
    "outcome_campaign_product_orders bigint, outcome_campaign_product_revenue double, "
    "outcome_campaign_product_quantity double, outcome_campaign_product_buyer int"
)
_TOTAL_OUTCOME = "outcome_total_campaign_orders bigint, outcome_total_campaign_revenue double"
_HOUSEHOLD_FEATURES = ", ".join([_ASSIGNMENT, _DEMOGRAPHIC, _BASELINE, _PRODUCT_OUTCOME, _TOTAL_OUTCOME])
ALL_FEATURES = struct(_HOUSEHOLD_FEATURES)

# The matched tables keep the total outcomes, so that the estimators can use them.
STRATIFIED = struct(
    _HOUSEHOLD_FEATURES + ", treatment_group string, sampled_unit int, stratum_rank bigint, "
    "treatment_addresslinks bigint, candidate_control_addresslinks bigint"
)
PROPENSITY_MATCHED = struct(
    _HOUSEHOLD_FEATURES + ", propensity_score double, treatment_group string, sampled_unit bigint, "
    "stratum_rank bigint, treatment_addresslinks string, candidate_control_addresslinks string"
)
LIFT_SUMMARY = struct(
    "incremental_lift double, lift_percent double, avg_treatment_amount double, expected_amount double, "
    "total_row_count bigint, treated_count double, outcome_r2 double, treatment_auc double, "
    "lift_pct_ci_lower double, lift_pct_ci_upper double, lift_ci_lower double, lift_ci_upper double, "
    "lift_p_value double, ate_base double, cate_existing_buyer double, cate_lapsed double, cate_young double, "
    "cate_senior double, cate_high_income double, cate_existing_buyer_p_value double, cate_lapsed_p_value double, "
    "cate_young_p_value double, cate_senior_p_value double, cate_high_income_p_value double"
)

# Older names of three feature columns, and the four columns that define a stratum.
OLD_NAMES = {
    "baseline_12m_revenue": "baseline_12m_revenue_sum",
    "baseline_12m_quantity": "baseline_12m_quantity_sum",
    "baseline_12m_revenue_bin": "baseline_12m_revenue_sum_bin",
}
STRATA = ("poc_label", "state_label", "baseline_buyer_label", "baseline_12m_revenue_sum_bin")

# Columns that must never be model features (identifiers, assignment, outcomes).
NEVER_FEATURES = frozenset(
    {
        "addressLink",
        "treatment",
        "is_eligible_control",
        "treatment_group",
        "sampled_unit",
        "stratum_rank",
        "treatment_addresslinks",
        "candidate_control_addresslinks",
        "has_partial_exposure_within_addresslink",
        "min_exposure_ts",
        "exposure_frequency_deduped",
        "mapped_online_identity_count",
        "exposed_online_identity_count",
        "hhpel_count",
        "person_record_count",
        "online_identity_count",
        "outcome_campaign_product_orders",
        "outcome_campaign_product_revenue",
        "outcome_campaign_product_quantity",
        "outcome_campaign_product_buyer",
        "outcome_total_campaign_orders",
        "outcome_total_campaign_revenue",
    }
)

# Features of the propensity model, numeric and categorical.
PROPENSITY_NUMERIC = (
    "baseline_12m_orders",
    "baseline_12m_revenue_sum",
    "baseline_12m_quantity_sum",
    "baseline_12m_negative_transaction_count",
    "baseline_12m_distinct_banners",
    "baseline_12m_distinct_divisions",
    "baseline_12m_active_purchase_days",
    "baseline_12m_avg_order_value",
    "baseline_12m_avg_items_per_order",
    "baseline_60d_orders",
    "baseline_60d_revenue",
    "baseline_60d_quantity",
    "baseline_campaign_product_orders",
    "baseline_campaign_product_revenue",
    "baseline_campaign_product_quantity",
    "has_baseline_purchase",
    "days_since_last_baseline_purchase",
    "baseline_purchase_tenure_days",
    "num_weeks_purchased_in_last_365_days",
    "recent_60d_revenue_share",
    "recent_60d_order_share",
    "campaign_product_revenue_share",
    "prior_campaign_product_buyer",
    "recent_60d_buyer",
    "lapsed_60d_buyer",
    *CODED_INCOME_COUNTS,
    "num_hh_income_missing_in_addresslink",
    "num_hh_income_zero_or_negative_in_addresslink",
    "age_missing_count",
    *AGE_COUNTS,
    *GENDER_COUNTS,
)
PROPENSITY_CATEGORICAL = (
    "poc_label",
    "state_label",
    "baseline_buyer_label",
    "campaign_product_affinity_label",
)
