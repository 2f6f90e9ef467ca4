"""Treatment assignment of households from ad exposures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlift.config import CampaignConfig
from hearthlift.functions.calendar import within_period
from hearthlift.functions.values import flag
from hearthlift.operators.conform import typed
from hearthlift.operators.skew import hot_keys, spread_join
from hearthlift.schemas import EXPOSURE, HOUSEHOLD, RAW_EXPOSURE


def flight_exposures(exposure: DataFrame, config: CampaignConfig) -> DataFrame:
    """Exposures of the campaign within its flight, exact repeats once.

    The repeat filter covers every column, so it is a distinct and combines map-side.
    """
    during = within_period(exposure, "ts", config.flight_start, config.flight_end)
    return exposure.where((F.col("campaign_id") == config.campaign_id) & during).select(*EXPOSURE.fieldNames()).distinct()


def exposed_identities(exposures: DataFrame) -> DataFrame:
    """First exposure and number of exposures of every exposed identity."""
    return exposures.groupBy("tp_id").agg(
        F.min("ts").alias("min_exposure_ts"), F.count("*").alias("exposure_frequency_deduped")
    )


def identities_with_exposure(identities: DataFrame, exposed: DataFrame, hot: list) -> DataFrame:
    """Household identities, marked and filled where they were exposed."""
    known = identities.where(F.col("online_identity_id").isNotNull()).drop("lr_id")
    joined = spread_join(
        known, exposed, "online_identity_id", "tp_id", "left", hot, F.struct(HOUSEHOLD, "Grouping_Indicator", "hhpel")
    )
    return joined.withColumn("online_identity_exposed", flag(F.col("tp_id").isNotNull())).drop("tp_id")


def roll_up_households(marked: DataFrame) -> DataFrame:
    """Assignment row per household.

    Identities, persons and household ids are each reduced to their distinct values first, by one
    grouping-sets aggregation. An identity shared by several persons therefore counts its exposures
    once, the distinct counts become plain sums, and a very large household is spread over its members.
    """
    exposed = F.col("online_identity_exposed") == 1
    kinds = ["online_identity_id", "Grouping_Indicator", "hhpel"]
    members = marked.groupingSets([[HOUSEHOLD, kind] for kind in kinds], HOUSEHOLD, *kinds).agg(
        *[F.grouping(kind).alias(f"_not_{kind}") for kind in kinds],
        F.max("online_identity_exposed").alias("online_identity_exposed"),
        F.min("min_exposure_ts").alias("min_exposure_ts"),
        F.max("exposure_frequency_deduped").alias("exposure_frequency_deduped"),
    )

    def is_a(kind: str):
        return (F.col(f"_not_{kind}") == 0) & F.col(kind).isNotNull()

    identity = is_a("online_identity_id")
    rolled = members.groupBy(HOUSEHOLD).agg(
        F.max("online_identity_exposed").alias("treatment"),
        F.min("min_exposure_ts").alias("min_exposure_ts"),
        F.sum(F.when(identity & exposed, F.col("exposure_frequency_deduped")).otherwise(0)).alias(
            "exposure_frequency_deduped"
        ),
        F.count_if(identity).alias("mapped_online_identity_count"),
        F.count_if(identity & exposed).alias("exposed_online_identity_count"),
        F.count_if(is_a("Grouping_Indicator")).alias("person_record_count"),
        F.count_if(is_a("hhpel")).alias("hhpel_count"),
    )
    reached = F.col("exposed_online_identity_count")
    partial = (reached > 0) & (reached < F.col("mapped_online_identity_count"))
    return rolled.withColumns(
        {
            "has_partial_exposure_within_addresslink": flag(partial),
            "is_eligible_control": flag(F.col("treatment") == 0),
        }
    )


def household_assignment(
    exposure: DataFrame, identities: DataFrame, mapping: DataFrame, config: CampaignConfig
) -> DataFrame:
    """The raw_exposure table. `mapping` only tells which identities are shared very widely."""
    exposed = exposed_identities(flight_exposures(exposure, config))
    marked = identities_with_exposure(identities, exposed, hot_keys(mapping, "rampid_meta"))
    return typed(roll_up_households(marked), RAW_EXPOSURE)
