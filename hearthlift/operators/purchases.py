"""Baseline behaviour and campaign outcomes per household."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlift import schemas as S
from hearthlift.config import CampaignConfig
from hearthlift.functions.calendar import bit_words, bits_set, date_of, day_within, monday_of
from hearthlift.functions.values import whole
from hearthlift.operators.conform import conform, require_any_column

_REQUIRED = [S.HOUSEHOLD, "order_id", "transaction_amount", "quantity", "is_campaign_product"]


def prepared_conversions(conversions: DataFrame) -> DataFrame:
    """Typed purchase rows; the day comes from the date column or else from the epoch column."""
    df = conform(conversions, S.RAW_CONVERSION, _REQUIRED, "household conversions")
    require_any_column(df, ["transaction_date", "transaction_timestamp_unix"], "household conversions")
    if "transaction_date" in df.columns:
        day = F.to_date("transaction_date")
    else:
        day = date_of(F.col("transaction_timestamp_unix"))
    optional = [c for c in ("banner", "division") if c in df.columns]
    return df.select(
        S.HOUSEHOLD,
        "order_id",
        *optional,
        day.alias("day"),
        F.col("transaction_amount").cast("decimal(18,4)").alias("amount"),
        F.col("quantity").cast("double").alias("quantity"),
        F.coalesce(whole(F.col("is_campaign_product")), F.lit(0)).alias("product"),
    )


def purchase_windows(config: CampaignConfig) -> dict[str, str]:
    """SQL conditions of the five row sets that purchases are counted in."""
    baseline = day_within("day", config.baseline_start, config.baseline_end)
    campaign = day_within("day", config.flight_start, config.flight_end)
    return {
        "baseline_12m": baseline,
        "baseline_60d": day_within("day", config.recent_start, config.baseline_end),
        "baseline_campaign_product": f"{baseline} AND product = 1",
        "outcome_campaign_product": f"{campaign} AND product = 1",
        "outcome_total_campaign": campaign,
    }


# Window -> result columns for orders, revenue and quantity.
_MEASURES = {
    "baseline_12m": ("baseline_12m_orders", "baseline_12m_revenue_sum", "baseline_12m_quantity_sum"),
    "baseline_60d": ("baseline_60d_orders", "baseline_60d_revenue", "baseline_60d_quantity"),
    "baseline_campaign_product": (
        "baseline_campaign_product_orders",
        "baseline_campaign_product_revenue",
        "baseline_campaign_product_quantity",
    ),
    "outcome_campaign_product": (
        "outcome_campaign_product_orders",
        "outcome_campaign_product_revenue",
        "outcome_campaign_product_quantity",
    ),
    "outcome_total_campaign": ("outcome_total_campaign_orders", "outcome_total_campaign_revenue", None),
}


def household_purchases(conversions: DataFrame, config: CampaignConfig) -> DataFrame:
    """Counts and sums per household from household conversions.

    Two aggregations: first per household and order, and of the baseline's banners and divisions the distinct
    ones per household, which carry no sums; then all of these per household. Distinct orders, banners and
    divisions are then plain counts of groups; distinct days and weeks are bits in fixed long buffers. A purchase
    is thus shuffled once with its sums, however much is counted, and a very large household is spread over its
    orders before it is brought together. Reads `conversions` twice: pass a written table.
    """
    df = prepared_conversions(conversions)
    windows = purchase_windows(config)
    baseline = windows["baseline_12m"]
    labels = [c for c in ("banner", "division") if c in df.columns]

    monday = monday_of(config.baseline_start)
    weeks = (config.baseline_end - monday).days // 7 + 1
    day_words = bit_words(f"datediff(day, DATE '{config.baseline_start}')", config.baseline_days, baseline)
    week_words = bit_words(f"(datediff(day, DATE '{monday}') DIV 7)", weeks, baseline)
    words = {f"days_{i}": w for i, w in enumerate(day_words)} | {f"weeks_{i}": w for i, w in enumerate(week_words)}

    # Returns have negative amounts: they count in quantities but not in revenue.
    # Revenue is summed in decimals, so that the order of rows cannot move a sum across a tier's edge.
    sums = {revenue: f"{windows[name]} AND amount > 0, amount" for name, (_, revenue, _) in _MEASURES.items()}
    sums |= {quantity: f"{windows[name]}, quantity" for name, (_, _, quantity) in _MEASURES.items() if quantity}
    groups = df.groupBy(S.HOUSEHOLD, "order_id").agg(
        *[F.expr(f"max(IF({condition}, 1, 0)) AS in_{name}") for name, condition in windows.items()],
        *[F.expr(f"sum(IF({value}, 0)) AS {name}") for name, value in sums.items()],
        F.expr(f"count_if({baseline} AND amount < 0) AS returns"),
        F.expr(f"min(IF({baseline}, day, NULL)) AS first_day"),
        F.expr(f"max(IF({baseline}, day, NULL)) AS last_day"),
        *[F.expr(f"{aggregate} AS {name}") for name, aggregate in words.items()],
    )

    groups = groups.withColumn("kind", F.lit("order"))
    for label in labels:
        seen = df.where(f"{baseline} AND {label} IS NOT NULL").select(S.HOUSEHOLD, label).distinct()
        groups = groups.unionByName(seen.select(S.HOUSEHOLD, F.lit(label).alias("kind")), allowMissingColumns=True)

    def distinct(label: str, name: str):
        return F.expr(f"count_if(kind = '{label}') AS {name}")

    return (
        groups.groupBy(S.HOUSEHOLD)
        .agg(
            *[F.expr(f"count_if(order_id IS NOT NULL AND in_{name} = 1) AS {orders}") for name, (orders, _, _) in _MEASURES.items()],
            *[F.expr(f"CAST(sum({name}) AS DOUBLE) AS {name}") for name in sums],
            F.expr("sum(returns) AS baseline_12m_negative_transaction_count"),
            distinct("banner", "baseline_12m_distinct_banners"),
            distinct("division", "baseline_12m_distinct_divisions"),
            F.expr("min(first_day) AS first_baseline_day"),
            F.expr("max(last_day) AS last_baseline_day"),
            *[F.expr(f"bit_or({name}) AS {name}") for name in words],
        )
        .selectExpr(
            "* EXCEPT (" + ", ".join(words) + ")",
            bits_set([w for w in words if w.startswith("days")]) + " AS baseline_12m_active_purchase_days",
            bits_set([w for w in words if w.startswith("weeks")]) + " AS num_weeks_purchased_in_last_365_days",
        )
    )
