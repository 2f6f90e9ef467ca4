"""Physical plans: what the scans get, what is shuffled, and what is not."""

import re

import pytest
from pyspark.sql import functions as F

from hearthlift.operators import conversions as C
from hearthlift.operators import estimation as E
from hearthlift.operators import exposures as X
from hearthlift.operators import identity as I
from hearthlift.operators.features import household_features
from hearthlift.operators.matching import stratify
from hearthlift.plans.campaign import prepare_households
from hearthlift.plans.retail_sources import RETAIL_CAMPAIGN, retail_sources
from hearthlift.sources.staging import stage
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def sources(spark):
    return {name: stage(df, name) for name, df in retail_sources(spark, SMALL).items()}


@pytest.fixture(scope="module")
def tables(sources):
    return prepare_households(sources, RETAIL_CAMPAIGN)


@pytest.fixture(scope="module")
def identities(sources):
    return stage(I.identity_households(sources["mapping"], sources["demographics"]), "identities")


@pytest.fixture
def big(conf):
    """Plan as for tables that are too large to broadcast."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")


def plan_of(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def exchanges(plan: str) -> int:
    return len(re.findall(r"\n\(\d+\) Exchange", plan))


def assert_no_pairing(plan: str) -> None:
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_purchases_are_filtered_by_the_scan_and_shuffled_twice(big, sources, identities):
    conversions = C.dedupe_by_household(
        C.to_households(C.conversions_in_period(sources["conversion"], RETAIL_CAMPAIGN), identities)
    )
    plan = plan_of(conversions)
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(transaction_timestamp_unix,\d+\)", plan)
    assert re.search(r"PushedFilters: .*LessThan\(transaction_timestamp_unix,\d+\)", plan)
    # The identities' own shuffle, and two of the purchases.
    assert exchanges(plan) == 3
    assert plan.count("WindowGroupLimit") > 0
    assert_no_pairing(plan)


def test_exposures_are_filtered_by_the_scan(sources):
    plan = plan_of(X.exposed_identities(X.flight_exposures(sources["exposure"], RETAIL_CAMPAIGN)))
    pushed = re.search(r"PushedFilters: (.*)", plan).group(1)
    assert "EqualTo(campaign_id,1)" in pushed and "GreaterThanOrEqual(ts," in pushed and "LessThan(ts," in pushed
    assert exchanges(plan) == 2


def test_identity_scan_reads_only_what_it_needs(sources):
    plan = plan_of(I.current_demographics(sources["demographics"]))
    schema = re.search(r"ReadSchema: (.*)", plan).group(1)
    assert "hh_income" not in schema and "county" not in schema and "addressLink" in schema


def test_features_join_without_further_shuffles(big, tables, sources):
    plan = plan_of(household_features(tables["raw_exposure"], tables["raw_conversion"], sources["demographics"], RETAIL_CAMPAIGN))
    # Assignment 1; purchases by order and by household 2; demographics by identity and by household 2.
    assert exchanges(plan) == 5
    assert "SortAggregate" not in plan
    assert_no_pairing(plan)


def test_assignment_has_no_pairing_and_no_sorted_aggregation(big, tables, sources, identities):
    plan = plan_of(X.household_assignment(sources["exposure"], identities, sources["mapping"], RETAIL_CAMPAIGN))
    assert "SortAggregate" not in plan
    assert_no_pairing(plan)


def test_matching_shuffles_only_what_can_be_chosen(tables):
    plan = plan_of(stratify(tables["AllFeatures"], RETAIL_CAMPAIGN))
    assert "BroadcastHashJoin" in plan
    # One for the rank within slices; the broadcast join comes before it.
    assert exchanges(plan) == 1
    assert_no_pairing(plan)


def test_a_fold_is_read_from_its_folder(tables):
    design = E.design_matrix(tables["AllFeatures"], E.LINEAR, RETAIL_CAMPAIGN, E.TOTAL_OUTCOME)
    plan = plan_of(design.where(F.col("fold") != 2))
    assert re.search(r"PartitionFilters: \[.*fold", plan)


def test_purchases_meet_one_row_per_identity_and_household(sources, identities):
    reduced = C.household_of_identity(identities)
    assert reduced.count() == reduced.select("lr_id", "addressLink").distinct().count() > 0
    scoped = stage(C.conversions_in_period(sources["conversion"], RETAIL_CAMPAIGN), "scoped")
    whole = C.dedupe_by_household(C.to_households(scoped, identities))
    slim = C.dedupe_by_household(C.to_households(scoped, reduced)).select(whole.columns)
    assert whole.exceptAll(slim).isEmpty() and slim.exceptAll(whole).isEmpty()


def test_quantiles_by_narrowed_counts(spark, monkeypatch):
    values = [(float((k * 7919) % 1009) ** 3 * (-1 if k % 5 == 0 else 1), float(k % 3)) for k in range(3000)]
    values += [(float("inf"), None), (float("-inf"), 1.0)]
    df = spark.createDataFrame(values, "a double, b double")
    monkeypatch.setattr(E, "PARTS", 7)
    strips = {c: [float("-inf"), 0.0, float("inf")] for c in "ab"}
    for share in (0.01, 0.5, 0.99, 1.0):
        got = E._ranked_in_strip(df, strips, share)
        for k, c in enumerate("ab"):
            known = sorted(v[k] for v in values if v[k] is not None)
            assert got[c] == known[-(-round(share * 100) * len(known) // 100) - 1]
