"""Demographic counts and labels per household."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from hearthlift import schemas as S
from hearthlift.functions.labels import child_label, count_profile, presence_profile, state_label
from hearthlift.functions.values import clean_text, has_text, whole
from hearthlift.operators.conform import conform
from hearthlift.operators.ranking import latest_per_key

_ATTRIBUTES = ("gender", "age", "state", "hh_income", "poc")


def current_people(demographics: DataFrame) -> DataFrame:
    """The newest record per online identity, or per household where identities are not given.

    Records without household are left out first, and so are records without identity: they
    cannot be told apart, so there is no newest one to keep.
    """
    df = conform(demographics, S.DEMOGRAPHICS, [S.HOUSEHOLD], "demographics")
    df = df.where(has_text(F.col(S.HOUSEHOLD)))
    keys = [c for c in ("rampid", "install_date") if c in df.columns]
    attributes = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in _ATTRIBUTES]
    df = df.select(S.HOUSEHOLD, *keys, *attributes)
    if "install_date" not in keys:
        return df.drop("rampid")
    if "rampid" in keys:
        df = latest_per_key(df.where(F.col("rampid").isNotNull()), "rampid", "install_date", [S.HOUSEHOLD, *_ATTRIBUTES])
    else:
        df = latest_per_key(df, S.HOUSEHOLD, "install_date", _ATTRIBUTES)
    return df.drop(*keys)


# Profile name -> condition, in the order of the income count columns.
_INCOME_CONDITIONS = {
    "missing": "income IS NULL",
    "zero_or_negative": "income <= 0",
    **{f"code_{n}": f"income = {n}" for n in S.INCOME_CODES},
    "other": f"income > {S.INCOME_CODES[-1]}",
}


def _age_condition(first: int | None, last: int | None) -> str:
    if first is None:
        return f"age < {last}"
    if last is None:
        return f"age >= {first}"
    return f"age BETWEEN {first} AND {last}"


def _count_conditions() -> dict[str, str]:
    male, female, other = S.GENDER_COUNTS
    is_male, is_female = "gender IN ('m', 'male')", "gender IN ('f', 'female')"
    return {
        "with_child": "child IN ('true', '1', 'yes', 'y')",
        "without_child": "child IN ('false', '0', 'no', 'n')",
        **dict(zip(S.INCOME_COUNTS, _INCOME_CONDITIONS.values())),
        male: is_male,
        female: is_female,
        other: f"gender IS NULL OR NOT ({is_male} OR {is_female})",
        "age_known": "age IS NOT NULL",
        "age_missing_count": "age IS NULL",
        **{f"age_{name}_count": _age_condition(first, last) for name, first, last, _ in S.AGE_BUCKETS},
    }


def household_demographics(people: DataFrame) -> DataFrame:
    """One aggregation of conditional counts, then labels. Every aggregate combines map-side; the
    number of states is only needed as none, one or several, which min and max tell. Numeric state
    codes are compared as numbers, which keeps the whole aggregation a hash aggregation."""
    state = F.col("state")
    if isinstance(people.schema["state"].dataType, StringType):
        state = F.when(has_text(state), F.trim(state))
    cleaned = people.select(
        S.HOUSEHOLD,
        clean_text(F.col("poc")).alias("child"),
        clean_text(F.col("gender")).alias("gender"),
        state.alias("state"),
        F.col("age").try_cast("double").alias("age"),
        whole(F.col("hh_income")).alias("income"),
    )
    counted = cleaned.groupBy(S.HOUSEHOLD).agg(
        *[F.expr(f"count_if({condition}) AS {name}") for name, condition in _count_conditions().items()],
        F.expr("min(state) AS lowest_state"),
        F.expr("max(state) AS highest_state"),
    )
    ages = {name: f"age_{name}_count" for name, *_ in S.AGE_BUCKETS}
    return counted.select(
        S.HOUSEHOLD,
        child_label("with_child", "without_child").alias("poc_label"),
        count_profile(dict(zip(_INCOME_CONDITIONS, S.INCOME_COUNTS))).alias("hh_income_code_profile_label"),
        *S.INCOME_COUNTS,
        state_label("lowest_state", "highest_state").alias("state_label"),
        *S.GENDER_COUNTS,
        presence_profile(ages, "age_known").alias("age_bucket_profile_label"),
        "age_missing_count",
        *S.AGE_COUNTS,
    )
