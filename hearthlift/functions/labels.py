"""Household labels and model encodings derived from counts and sums.

Long CASE expressions and profiles are built as SQL text and parsed once, which plans much
faster than assembling them from single Column calls. Arguments are column names or SQL text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthlift import schemas as S


def label_by(cases: Sequence[tuple[str, str]], otherwise: str) -> Column:
    """Text of the first condition that holds, else `otherwise`."""
    branches = " ".join(f"WHEN {condition} THEN '{label}'" for condition, label in cases)
    return F.expr(f"CASE {branches} ELSE '{otherwise}' END")


def spend_tier(spend: str) -> Column:
    below = [(f"{spend} < {edge}", name) for name, edge in S.SPEND_TIERS]
    return label_by([(f"{spend} = 0", S.NO_SPEND_TIER), *below], S.TOP_SPEND_TIER)


def buyer_label(recent_orders: str, baseline_orders: str) -> Column:
    never, lapsed, recent = S.BUYER_LABEL_ORDER
    return label_by([(f"{recent_orders} > 0", recent), (f"{baseline_orders} > 0", lapsed)], never)


def affinity_label(product_orders: str) -> Column:
    return label_by(
        [
            (f"{product_orders} > 1", "repeat_campaign_product_buyer"),
            (f"{product_orders} = 1", "single_campaign_product_buyer"),
        ],
        "no_prior_campaign_product",
    )


def child_label(with_child: str, without_child: str) -> Column:
    return label_by([(f"{with_child} > 0", "has_child"), (f"{without_child} > 0", "no_child")], "missing")


def state_label(lowest: str, highest: str) -> Column:
    """One state, none, or several; two or more distinct states exist exactly if lowest < highest."""
    one = f"CAST({highest} AS STRING)"
    return F.expr(
        f"CASE WHEN {lowest} IS NULL THEN 'missing' WHEN {lowest} <> {highest} THEN 'mixed_or_multiple' ELSE {one} END"
    )


def presence_profile(counts: Mapping[str, str], known: str) -> Column:
    """Names of the non-empty buckets joined by '|'; the mapping goes from bucket to count column."""
    present = ", ".join(f"IF({count} > 0, '{name}', NULL)" for name, count in counts.items())
    return F.expr(f"IF({known} = 0, 'missing', concat_ws('|', {present}))")


def count_profile(counts: Mapping[str, str]) -> Column:
    """'name:count' of the non-empty buckets joined by '|'."""
    present = ", ".join(f"IF({count} > 0, concat('{name}:', {count}), NULL)" for name, count in counts.items())
    return F.expr(f"IF({' + '.join(counts.values())} = 0, 'missing', concat_ws('|', {present}))")


def weighted_mean(weights: Mapping[str, float], default: float) -> Column:
    """Mean of the weights, each counted as often as its column says; `default` if nothing is counted."""
    total = " + ".join(weights)
    weighted = " + ".join(f"{float(weight)}D * {column}" for column, weight in weights.items())
    return F.expr(f"CASE WHEN {total} > 0 THEN ({weighted}) / ({total}) ELSE {default}D END")


def estimated_age() -> Column:
    midpoints = {f"age_{name}_count": middle for name, _, _, middle in S.AGE_BUCKETS if middle is not None}
    return weighted_mean(midpoints, S.DEFAULT_AGE)


def estimated_income_code() -> Column:
    return weighted_mean(dict(zip(S.CODED_INCOME_COUNTS, S.INCOME_CODES)), S.DEFAULT_INCOME_CODE)


def majority_gender() -> Column:
    male, female, _ = S.GENDER_COUNTS
    return label_by([(f"{male} > {female}", "male"), (f"{female} > {male}", "female")], "unknown")


def ordinal(label: str, order: Sequence[str]) -> Column:
    """Position of the label in `order` as a double; unknown labels and nulls count as the first."""
    branches = " ".join(f"WHEN '{name}' THEN {i}.0D" for i, name in enumerate(order))
    return F.expr(f"CASE {label} {branches} ELSE 0.0D END")
