"""Purchases at household grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthlift.config import CampaignConfig
from hearthlift.functions.calendar import date_of, within_period
from hearthlift.functions.values import flag
from hearthlift.operators.conform import typed
from hearthlift.operators.ranking import first_per_key
from hearthlift.operators.skew import lookup_join
from hearthlift.schemas import HOUSEHOLD, RAW_CONVERSION

_TEXTS = ("transaction_category", "product_brand", "banner", "division")


def campaign_products(campaign: DataFrame, config: CampaignConfig) -> DataFrame:
    """Products of the campaign, which may be given by number or by text."""
    wanted = (F.col("campaign_id_long") == config.campaign_id) | (
        F.col("campaign_id") == str(config.campaign_id)
    )
    return (
        campaign.where(wanted)
        .groupBy(F.col("product_id").cast("string").alias("product_id"))
        .agg(F.coalesce(F.max(F.col("campaign_id").cast("string")), F.lit(str(config.campaign_id))).alias("campaign_id"))
    )


def conversions_in_period(conversion: DataFrame, config: CampaignConfig) -> DataFrame:
    """Purchases from the start of the baseline to the end of the flight; the scan sees the range."""
    epoch = F.col("transaction_timestamp_unix")
    period = within_period(conversion, "transaction_timestamp_unix", config.baseline_start, config.flight_end)
    return conversion.where(period).select(
        "lr_id",
        "order_id",
        *_TEXTS,
        epoch.cast("bigint").alias("transaction_timestamp_unix"),
        date_of(epoch).alias("transaction_date"),
        "transaction_amount",
        "quantity",
        F.col("product_id").cast("string").alias("product_id"),
    )


def resolvable_conversions(conversions: DataFrame, identities: DataFrame) -> DataFrame:
    """Purchases whose identity belongs to a household."""
    known = identities.where(F.col("lr_id").isNotNull()).select("lr_id")
    return conversions.join(known, "lr_id", "left_semi")


def _best_first() -> list[Column]:
    return [
        F.col("transaction_amount").desc_nulls_last(),
        F.col("quantity").desc_nulls_last(),
        *[F.col(c).asc_nulls_first() for c in _TEXTS],
    ]


def dedupe_by_identity(conversions: DataFrame) -> DataFrame:
    """One row per identity, order, time and product: the largest amount, then quantity, then texts."""
    keys = ["lr_id", "order_id", "transaction_timestamp_unix", "product_id"]
    return first_per_key(conversions, keys, _best_first())


def household_of_identity(identities: DataFrame) -> DataFrame:
    """One row per purchase identity and household: the one that dedupe_by_household would choose.

    An identity's other rows would only multiply its purchases before the dedup takes them out again.
    """
    known = identities.where(F.col("lr_id").isNotNull())
    return first_per_key(known, ["lr_id", HOUSEHOLD], _identity_order())


def _identity_order() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in ("hhpel", "Grouping_Indicator", "online_identity_id")]


def to_households(conversions: DataFrame, identities: DataFrame) -> DataFrame:
    """Every purchase once per household identity it resolves to.

    Both sides of the join come straight from a shuffle, which is what lets adaptive execution
    split an identity that holds a large share of the purchases.
    """
    known = identities.where(F.col("lr_id").isNotNull())
    return conversions.join(known, "lr_id")


def dedupe_by_household(conversions: DataFrame) -> DataFrame:
    """One row per household, order, time and product, in the same order of preference.

    Two identities of a household may carry the same purchase. Remaining ties are decided by
    the identity columns, so the choice does not depend on partitioning.
    """
    keys = [HOUSEHOLD, "order_id", "transaction_timestamp_unix", "product_id"]
    return first_per_key(conversions, keys, [*_best_first(), *_identity_order()])


def mark_campaign_products(conversions: DataFrame, products: DataFrame) -> DataFrame:
    marked = lookup_join(conversions, products.withColumn("_listed", F.lit(True)), "product_id")
    return marked.withColumn("is_campaign_product", flag(F.col("_listed").isNotNull())).drop("_listed")


def household_conversions(
    conversion: DataFrame, identities: DataFrame, campaign: DataFrame, config: CampaignConfig
) -> DataFrame:
    """The raw_conversion table.

    dedupe_by_identity and the semi join are not run on the way: the household dedup orders rows
    by the same preference and its groups contain the identity groups whole, so the best row of a
    household group is the same with or without them. That leaves two shuffles of the purchases,
    by identity and by household order; the household dedup drops copies before its shuffle.
    Products are looked up on the scanned purchases, where that shuffles nothing if the list is small,
    and where hot products can be counted without repeating the joins. Runs Spark jobs at once.
    """
    scoped = conversions_in_period(conversion, config)
    marked = mark_campaign_products(scoped, campaign_products(campaign, config))
    unique = dedupe_by_household(to_households(marked, household_of_identity(identities)))
    return typed(unique.withColumn("product_id", F.col("product_id").try_cast("bigint")), RAW_CONVERSION)
