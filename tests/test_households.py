"""Identities, purchases, assignment and features on hand-written rows."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hearthlift import GROCERY_CAMPAIGN as CAMPAIGN
from hearthlift import schemas as S
from hearthlift.functions.calendar import epoch_of
from hearthlift.operators import conversions as C
from hearthlift.operators import exposures as X
from hearthlift.operators import identity as I
from hearthlift.operators.demographics import current_people, household_demographics
from hearthlift.operators.features import household_features
from hearthlift.operators.purchases import household_purchases, prepared_conversions
from hearthlift.plans.campaign import measure_campaign
from hearthlift.plans.retail_sources import RETAIL_CAMPAIGN, retail_sources
from tests.conftest import SMALL, rows

DAY = date(2025, 10, 1)


def demographics(spark, *people):
    """(identity, person, household, installed) plus optional attributes."""
    data = []
    for identity, person, household, installed, *more in people:
        gender, age, state, income, poc = [*more, *[None] * (5 - len(more))]
        data.append((identity, person, f"hh-{household}", household, gender, age, state, None, income, poc, installed))
    return spark.createDataFrame(data, S.DEMOGRAPHICS)


def mapping(spark, *links):
    return spark.createDataFrame([(DAY, *link) for link in links], S.MAPPING)


def exposures(spark, *shown, campaign=CAMPAIGN.campaign_id):
    return spark.createDataFrame(
        [(ts, who, None, 1, 2, campaign, 3, "view", "feed", "ios", "phone") for who, ts in shown], S.EXPOSURE
    )


def purchases(spark, *bought):
    """(identity, order, epoch, amount, quantity, product, text)."""
    return spark.createDataFrame(
        [(who, text, order, text, "b1", "d1", ts, Decimal(str(amount)) if amount is not None else None, quantity, product)
         for who, order, ts, amount, quantity, product, text in bought],
        S.CONVERSION,
    )


def no_campaign(spark):
    return spark.createDataFrame([], S.CAMPAIGN)


def test_newest_demographic_record_wins_and_ties_are_stable(spark):
    people = demographics(
        spark, ("i", "p", "old", date(2020, 1, 1)), ("i", "p", "new2", DAY), ("i", "p", "new1", DAY),
        ("j", "q", "undated", None), (None, "r", "x", DAY),
    )
    for parts in (1, 5):
        got = rows(I.current_demographics(people.repartition(parts)).select("rampid", S.HOUSEHOLD))
        assert got == [("i", "new1"), ("j", "undated")]


def test_households_without_id_are_not_resolved(spark):
    people = demographics(spark, ("a", "p", "h", DAY), ("b", "p", None, DAY), ("c", "p", "", DAY))
    links = mapping(spark, ("a", "ma", "ra"), ("a", "ma", "ra"), ("b", "mb", "rb"), ("c", "mc", "rc"), ("a", "ma", None))
    got = I.identity_households(links, people).select("lr_id", "online_identity_id", S.HOUSEHOLD)
    assert rows(got) == sorted([("ra", "ma", "h"), (None, "ma", "h")], key=repr)


def test_shared_identity_counts_its_exposures_once(spark):
    people = demographics(spark, ("a", "p1", "h", DAY), ("b", "p2", "h", DAY))
    links = mapping(spark, ("a", "shared", "ra"), ("b", "shared", "rb"))
    start = epoch_of(CAMPAIGN.flight_start)
    shown = exposures(spark, ("shared", start), ("shared", start + 5), ("shared", start + 9), ("shared", start + 9))
    identities = I.identity_households(links, people)
    row = X.household_assignment(shown, identities, links, CAMPAIGN).first()
    assert (row.exposure_frequency_deduped, row.person_record_count, row.mapped_online_identity_count) == (3, 2, 1)
    assert (row.treatment, row.min_exposure_ts, row.has_partial_exposure_within_addresslink) == (1, start, 0)


def test_exposure_period_campaign_and_partial_exposure(spark):
    people = demographics(spark, *[(f"i{n}", f"p{n}", f"h{n // 2}", DAY) for n in range(8)])
    links = mapping(spark, *[(f"i{n}", f"m{n}", f"r{n}") for n in range(8)])
    start, end = epoch_of(CAMPAIGN.flight_start), epoch_of(CAMPAIGN.flight_end) + 86400
    shown = exposures(spark, ("m0", start), ("m2", start - 1), ("m4", end), ("m6", end - 1), ("m7", end - 1))
    shown = shown.unionAll(exposures(spark, ("m2", start), campaign=5))
    got = X.household_assignment(shown, I.identity_households(links, people), links, CAMPAIGN)
    assert rows(got.select(S.HOUSEHOLD, "treatment", "is_eligible_control", "has_partial_exposure_within_addresslink")) == [
        ("h0", 1, 0, 1), ("h1", 0, 1, 0), ("h2", 0, 1, 0), ("h3", 1, 0, 0)
    ]


@pytest.fixture
def two_identities(spark):
    """One person with two purchase identities, another household sharing one of them."""
    people = demographics(spark, ("a", "p1", "h", DAY), ("b", "p1", "h", DAY), ("c", "p2", "g", DAY))
    links = mapping(spark, ("a", "ma", "r1"), ("b", "mb", "r2"), ("c", "mc", "r2"))
    return I.identity_households(links, people)


def test_same_purchase_under_two_identities_counts_once(spark, two_identities):
    ts = epoch_of(DAY)
    bought = purchases(
        spark, ("r1", "o1", ts, 5, 1, 7, "x"), ("r2", "o1", ts, 5, 1, 7, "x"), ("r2", "o1", ts, 9, 1, 7, "x"),
        ("unknown", "o2", ts, 1, 1, 7, "x"),
    )
    got = C.household_conversions(bought, two_identities, no_campaign(spark), CAMPAIGN)
    assert rows(got.select(S.HOUSEHOLD, "transaction_amount", "is_campaign_product")) == [("g", 9.0, 0), ("h", 9.0, 0)]


def test_one_dedup_equals_two(spark, two_identities):
    """The fused plan against identity dedup, semi join, and household dedup one after the other."""
    ts = epoch_of(DAY)
    bought = purchases(
        spark,
        *[(f"r{n % 2 + 1}", f"o{n % 4}", ts + n % 3, (n * 7) % 5 if n % 6 else None, n % 4 if n % 5 else None, n % 3, f"t{n % 7}")
          for n in range(300)],
    )
    scoped = C.conversions_in_period(bought, CAMPAIGN)
    stepwise = C.dedupe_by_household(
        C.to_households(C.dedupe_by_identity(C.resolvable_conversions(scoped, two_identities)), two_identities)
    )
    fused = C.dedupe_by_household(C.to_households(scoped, two_identities))
    columns = fused.columns
    assert rows(fused.select(columns)) == rows(stepwise.select(columns))
    assert rows(C.dedupe_by_household(C.to_households(scoped.repartition(9), two_identities)).select(columns)) == rows(fused)


def test_identity_dedup_order(spark):
    ts = epoch_of(DAY)
    bought = purchases(
        spark, ("r", "o", ts, None, 9, 1, "a"), ("r", "o", ts, 2, None, 1, "a"), ("r", "o", ts, 2, 3, 1, "z"),
        ("r", "o", ts, 2, 3, 1, "b"), ("r", "o", ts, 1, 8, 1, "a"),
    )
    best = C.dedupe_by_identity(C.conversions_in_period(bought, CAMPAIGN)).first()
    assert (best.transaction_amount, best.quantity, best.product_brand) == (Decimal(2), 3, "b")


def test_purchase_period_bounds(spark):
    first, after = epoch_of(CAMPAIGN.baseline_start), epoch_of(CAMPAIGN.flight_end) + 86400
    bought = purchases(spark, *[("r", str(ts), ts, 1, 1, 1, "x") for ts in (first - 1, first, after - 1, after)])
    got = C.conversions_in_period(bought, CAMPAIGN)
    assert sorted(r.order_id for r in got.collect()) == sorted([str(first), str(after - 1)])


def test_campaign_products_by_number_or_text(spark):
    number, text = CAMPAIGN.campaign_id, str(CAMPAIGN.campaign_id)
    listed = spark.createDataFrame(
        [(None, "1", number), (text, "2", None), (text, "2", number), ("other", "3", 5)],
        "campaign_id string, product_id string, campaign_id_long bigint",
    )
    assert rows(C.campaign_products(listed, CAMPAIGN)) == [("1", text), ("2", text)]


def test_demographic_counts_and_labels(spark):
    people = current_people(
        demographics(
            spark, ("a", "p", "h", DAY, " M ", 17, 6, 3, True), ("b", "p", "h", DAY, "female", 85, 6, 3, False),
            ("c", "p", "h", DAY, "x", None, None, 0, None), ("d", "p", "g", DAY, None, 40, 1, 99, False),
            ("e", "p", "g", DAY, None, 18, 2, None, None), ("f", "p", " ", DAY),
        )
    )
    got = {r[S.HOUSEHOLD]: r for r in household_demographics(people).collect()}
    h, g = got["h"], got["g"]
    assert set(got) == {"h", "g"}
    assert (h.poc_label, g.poc_label) == ("has_child", "no_child")
    assert (h.state_label, g.state_label) == ("6", "mixed_or_multiple")
    assert h.hh_income_code_profile_label == "zero_or_negative:1|code_3:2"
    assert g.hh_income_code_profile_label == "missing:1|other:1"
    assert (h.age_bucket_profile_label, g.age_bucket_profile_label) == ("lt_18|85_plus", "18_24|35_44")
    assert (h.num_male_in_addresslink, h.num_female_in_addresslink, h.num_unknown_or_other_gender_in_addresslink) == (1, 1, 1)
    assert (h.age_missing_count, h.num_hh_income_code_3_in_addresslink) == (1, 2)


def test_demographics_of_the_household_grain_and_of_texts(spark):
    rich = demographics(spark, ("a", "p", "h", date(2020, 1, 1), "M"), ("b", "p", "h", DAY, "F"))
    assert household_demographics(current_people(rich.drop("rampid"))).first().num_female_in_addresslink == 1
    assert household_demographics(current_people(rich.drop("rampid", "install_date"))).first().num_male_in_addresslink == 1
    bare = household_demographics(current_people(rich.select(F.col(S.HOUSEHOLD).alias("ADDRESSLINK")))).first()
    assert (bare.poc_label, bare.state_label, bare.age_bucket_profile_label) == ("missing",) * 3
    texts = spark.createDataFrame([("h", " ", "abc"), ("h", "7 ", "12")], "addressLink string, state string, hh_income string")
    row = household_demographics(current_people(texts)).first()
    assert (row.state_label, row.hh_income_code_profile_label) == ("7", "missing:1|code_12:1")


def household_rows(spark, *bought):
    """(household, order, day, amount, quantity, product flag, banner)."""
    return spark.createDataFrame(
        list(bought),
        "addressLink string, order_id string, transaction_date date, transaction_amount double, quantity double, "
        "is_campaign_product int, banner string",
    )


BEFORE, RECENT, DURING = date(2025, 1, 6), date(2025, 11, 11), date(2025, 11, 12)


def test_purchase_measures(spark):
    bought = household_rows(
        spark, ("h", "o1", BEFORE, 10.0, 2.0, 1, "b1"), ("h", "o1", BEFORE, -4.0, -1.0, 0, "b2"),
        ("h", None, BEFORE, 1.0, 1.0, 0, None), ("h", "o2", RECENT, 5.0, 1.0, 0, "b1"),
        ("h", "o3", DURING, 7.0, 1.0, 1, "b9"), ("h", "o1", DURING, 2.0, 1.0, None, "b1"),
        ("returns", "o9", RECENT, -3.0, -1.0, 1, "b1"),
    )
    got = {r[S.HOUSEHOLD]: r for r in household_purchases(bought, CAMPAIGN).collect()}
    h, r = got["h"], got["returns"]
    assert (h.baseline_12m_orders, h.baseline_60d_orders, h.baseline_campaign_product_orders) == (2, 1, 1)
    assert (h.baseline_12m_revenue_sum, h.baseline_12m_quantity_sum) == (16.0, 3.0)
    assert (h.outcome_total_campaign_orders, h.outcome_total_campaign_revenue) == (2, 9.0)
    assert (h.outcome_campaign_product_orders, h.outcome_campaign_product_revenue) == (1, 7.0)
    assert (h.baseline_12m_distinct_banners, h.baseline_12m_distinct_divisions) == (2, 0)
    assert (h.baseline_12m_active_purchase_days, h.num_weeks_purchased_in_last_365_days) == (2, 2)
    assert (h.first_baseline_day, h.last_baseline_day, h.baseline_12m_negative_transaction_count) == (BEFORE, RECENT, 1)
    assert (r.baseline_12m_revenue_sum, r.baseline_12m_negative_transaction_count, r.baseline_12m_quantity_sum) == (0.0, 1, -1.0)


def test_very_large_household_equals_plain_distinct_counts(spark):
    """Half of the rows in one household, a third without order id, banners and divisions partly null."""
    bought = spark.range(20_000).selectExpr(
        "IF(id % 2 = 0, 'huge', CAST(id % 97 AS STRING)) AS addressLink",
        "IF(id % 3 = 0, NULL, CAST(id % 1789 AS STRING)) AS order_id",
        "date_add(DATE '2024-11-01', CAST(hash(id, 1) % 220 + 220 AS INT)) AS transaction_date",
        "CAST(hash(id, 2) % 100 AS DOUBLE) AS transaction_amount",
        "CAST(hash(id, 3) % 5 AS DOUBLE) AS quantity",
        "CAST(hash(id, 4) % 3 = 0 AS INT) AS is_campaign_product",
        "IF(id % 7 = 0, NULL, CAST(hash(id, 5) % 6 AS STRING)) AS banner",
        "IF(id % 11 = 0, NULL, CAST(hash(id, 6) % 9 AS STRING)) AS division",
    )
    base = "transaction_date BETWEEN DATE '2024-11-12' AND DATE '2025-11-11'"
    late = "transaction_date BETWEEN DATE '2025-09-13' AND DATE '2025-11-11'"
    during = "transaction_date BETWEEN DATE '2025-11-12' AND DATE '2026-01-06'"
    plain = bought.groupBy(S.HOUSEHOLD).agg(
        *[F.expr(e) for e in (
            f"count(DISTINCT IF({base}, order_id, NULL)) AS baseline_12m_orders",
            f"count(DISTINCT IF({late}, order_id, NULL)) AS baseline_60d_orders",
            f"count(DISTINCT IF({base} AND is_campaign_product = 1, order_id, NULL)) AS baseline_campaign_product_orders",
            f"count(DISTINCT IF({during}, order_id, NULL)) AS outcome_total_campaign_orders",
            f"count(DISTINCT IF({base}, banner, NULL)) AS baseline_12m_distinct_banners",
            f"count(DISTINCT IF({base}, division, NULL)) AS baseline_12m_distinct_divisions",
            f"count(DISTINCT IF({base}, transaction_date, NULL)) AS baseline_12m_active_purchase_days",
            f"count(DISTINCT IF({base}, date_trunc('week', transaction_date), NULL)) AS num_weeks_purchased_in_last_365_days",
            f"sum(IF({base} AND transaction_amount > 0, transaction_amount, 0)) AS baseline_12m_revenue_sum",
            f"sum(IF({base}, quantity, 0)) AS baseline_12m_quantity_sum",
            f"count_if({base} AND transaction_amount < 0) AS baseline_12m_negative_transaction_count",
        )]
    )
    got = household_purchases(bought, CAMPAIGN).select(plain.columns)
    assert plain.where("addressLink = 'huge' AND baseline_12m_orders > 500").count() == 1
    assert rows(got) == rows(plain)


def test_purchase_day_from_epoch_and_missing_columns(spark):
    bought = household_rows(spark, ("h", "o", BEFORE, 1.0, 1.0, 1, "b")).drop("transaction_date")
    with pytest.raises(ValueError):
        prepared_conversions(bought)
    dated = bought.withColumn("TRANSACTION_TIMESTAMP_UNIX", F.lit(epoch_of(BEFORE) + 86399))
    assert prepared_conversions(dated).first().day == BEFORE
    with pytest.raises(ValueError, match="quantity"):
        prepared_conversions(bought.drop("quantity"))


def test_features_do_not_tell_who_bought_during_the_campaign(spark):
    assigned = spark.createDataFrame(
        [("none", 0, 1), ("during", 0, 1), ("before", 1, 0), (None, 0, 1)], "addressLink string, treatment int, is_eligible_control int"
    )
    bought = household_rows(spark, ("during", "o", DURING, 5.0, 1.0, 1, "b"), ("before", "o", RECENT, 20.0, 2.0, 1, "b"))
    people = demographics(spark, ("i", "p", "before", DAY, "M", 30, 1, 2, True))
    got = {r[S.HOUSEHOLD]: r for r in household_features(assigned, bought, people, CAMPAIGN).collect()}
    assert set(got) == {"none", "during", "before"}
    labels = ("baseline_12m_revenue_sum_bin", "baseline_buyer_label", "campaign_product_affinity_label")
    assert [got["none"][c] for c in labels] == [got["during"][c] for c in labels] == [
        "zero", "no_12m_purchase", "no_prior_campaign_product"
    ]
    none, before = got["none"], got["before"]
    assert (none.days_since_last_baseline_purchase, none.has_baseline_purchase, none.state_label) == (366, 0, "missing")
    assert none.outcome_total_campaign_revenue == 0.0 and got["during"].outcome_total_campaign_revenue == 5.0
    assert (before.days_since_last_baseline_purchase, before.baseline_12m_avg_order_value) == (0, 20.0)
    assert before.baseline_12m_revenue_sum_bin == "10_to_49" and before.state_label == "1"
    assert not [c for c in got["none"].asDict() if got["none"][c] is None and c != "min_exposure_ts"]


def test_labels_of_households_without_rows_can_be_missing(spark):
    from dataclasses import replace

    assigned = spark.createDataFrame(
        [("none", 0, 1), ("during", 0, 1)], "addressLink string, treatment int, is_eligible_control int"
    )
    bought = household_rows(spark, ("during", "o", DURING, 5.0, 1.0, 1, "b"))
    features = household_features(assigned, bought, demographics(spark, ("i", "p", "x", DAY)), replace(CAMPAIGN, no_history_labels="missing"))
    got = {r[S.HOUSEHOLD]: r.baseline_buyer_label for r in features.collect()}
    assert got == {"none": "missing", "during": "no_12m_purchase"}


def test_bridge_join_keeps_unmapped_base_rows_only_for_outer_joins(spark):
    links = mapping(spark, ("d1", "m1", "r1"), ("d1", "m1", "r1"), ("d2", "m2", "r2"))
    base = spark.createDataFrame([("m1", 1), ("m2", 2), ("m3", 3)], "tp_id string, n int")
    orders = spark.createDataFrame([("r1", 10)], "lr_id string, orders int")
    people = spark.createDataFrame([("d1", "x"), ("d2", "y")], "rampid string, name string")

    def joined(how):
        tables = [I.BridgedTable(orders, "lr_id", "rampid_rmn", how), I.BridgedTable(people, "rampid", "rampid_dpm", how)]
        return rows(I.bridge_join(base, "tp_id", "rampid_meta", links, tables).select("tp_id", "orders", "name"))

    assert joined("inner") == [("m1", 10, "x")]
    assert joined("left") == [("m1", 10, "x"), ("m2", None, "y"), ("m3", None, None)]


def test_whole_campaign_run(spark):
    tables = measure_campaign(retail_sources(spark, SMALL), RETAIL_CAMPAIGN, trees=False)
    assert tables["AllFeatures"].schema.fieldNames() == S.ALL_FEATURES.fieldNames()
    assert {r.design for r in tables["lift"].collect()} == {"psm_linear", "strata_linear"}
    assert "placebo_passed" in tables["placebo"].columns
    assert tables["match_report"].count() == 1


def test_purchases_are_shuffled_once_with_their_sums(spark, tmp_path):
    """The shuffle by order carries a row a purchase at most; distinct banners and divisions carry no sums."""
    schema = "addressLink string, order_id string, banner string, division string, transaction_date date, transaction_amount double, quantity int, is_campaign_product int"
    day = CAMPAIGN.baseline_start
    rows = [("h1", "o1", "x", "u", day, 2.0, 1, 0), ("h1", "o1", "y", None, day, 3.0, 1, 1), ("h1", None, "x", "u", day, -1.0, 1, 0),
            ("h1", "o2", None, "v", day, 5.0, 2, 0), ("h1", "o3", "z", "w", CAMPAIGN.flight_start, 7.0, 1, 0), ("h2", "o4", "z", "w", CAMPAIGN.flight_start, 7.0, 1, 1)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/bought")
    found = household_purchases(spark.read.parquet(f"{tmp_path}/bought"), CAMPAIGN)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    columns = ["baseline_12m_orders", "baseline_12m_distinct_banners", "baseline_12m_distinct_divisions", "baseline_12m_revenue_sum",
               "baseline_12m_negative_transaction_count", "outcome_total_campaign_orders"]
    got = {r[S.HOUSEHOLD]: tuple(r[c] for c in columns) for r in found.collect()}
    assert got == {"h1": (2, 2, 2, 10.0, 1, 1), "h2": (0, 0, 0, 0.0, 0, 1)}
