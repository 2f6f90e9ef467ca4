"""Registered queries: each operator run over the whole retail tables, with its DuckDB text."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from checks import oracles as O
from hearthlift import schemas as S
from hearthlift.functions.hashing import hash_bucket
from hearthlift.functions.values import caliper_bin, clipped, parse_flag
from hearthlift.operators import boosting as B
from hearthlift.operators import conversions as C
from hearthlift.operators import diagnostics as D
from hearthlift.operators import estimation as E
from hearthlift.operators import exposures as X
from hearthlift.operators import identity as I
from hearthlift.operators import matching as M
from hearthlift.operators import newton as N
from hearthlift.operators import quantiles as K
from hearthlift.operators.conform import conform, filled, typed, with_baseline_flag
from hearthlift.operators.demographics import current_people, household_demographics
from hearthlift.operators.least_squares import cross_products, fitted
from hearthlift.operators.purchases import household_purchases
from hearthlift.operators.skew import hot_keys, spread_join
from hearthlift.plans.campaign import prepare_households
from hearthlift.plans.retail_sources import RETAIL_CAMPAIGN, retail_sources
from hearthlift.sources.staging import stage, staging_root
from hearthlift.sources.tables import TableAccess, load_days, run_sql, save_by_day

CONFIG = RETAIL_CAMPAIGN
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_written: dict[tuple[str, str, str], DataFrame] = {}


def written(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A result table of the preparation, written once per session and folder.

    Matching and estimation start from written tables, as they do in a campaign run.
    """
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _written:
        if name in ("raw_conversion", "raw_exposure", "AllFeatures"):
            for table, df in prepare_households(retail_sources(spark, folder), CONFIG).items():
                _written[key[0], folder, table] = df
        elif name == "StratifiedFeatures":
            _written[key] = stage(M.stratify(written(spark, folder, "AllFeatures"), CONFIG), "stratified")
        elif name == "scores":
            _written[key] = M.propensity_scores(written(spark, folder, "AllFeatures"), CONFIG)
        elif name == "PSMMatchedFeatures":
            scored = written(spark, folder, "scores")
            _written[key] = stage(M.propensity_match(scored, CONFIG), "propensity-matched")
        else:
            raise KeyError(name)
    return _written[key]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Sums of doubles depend on the order of rows in their last bits."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType)) else f.name
            for f in df.schema.fields
        ]
    )


def query(oracle: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


def names_of(schema) -> str:
    return ", ".join(schema.fieldNames())


def rounded_sql(schema) -> str:
    return ", ".join(
        f"ROUND({f.name}, 6) AS {f.name}" if isinstance(f.dataType, DoubleType) else f.name for f in schema.fields
    )


# ---- tables, outputs, parameters -------------------------------------------------------------


@query("""SELECT p_brand AS product_brand, COUNT(*) AS products, MIN(p_partkey) AS first_product
          FROM part GROUP BY p_brand""")
def read_and_publish(spark, folder):
    """Read a table by name, publish a result view and read that."""
    spark.read.parquet(f"{folder}/part.parquet").createOrReplaceTempView("lift_products")
    access = TableAccess(spark)
    products = access.read("lift_products")
    result = products.groupBy(F.col("p_brand").alias("product_brand")).agg(
        F.count("*").alias("products"), F.min("p_partkey").alias("first_product")
    )
    access.publish(result)
    return access.read("result")


_OUTPUT_SQL = """SELECT c_custkey AS customer, c_mktsegment AS segment, c_nationkey AS nation,
                        ROUND(c_acctbal, 2) AS balance FROM customer"""


def _saved_and_read(spark, folder, ending):
    """Save a table as an extra output and read it back."""
    root = f"{staging_root(spark).rstrip('/')}/outputs-{uuid.uuid4().hex}"
    access = TableAccess(spark, output_folders={"customers": root}, save_folder=root, extra_outputs=True)
    customers = spark.read.parquet(f"{folder}/customer.parquet").select(
        F.col("c_custkey").alias("customer"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
        F.round("c_acctbal", 2).alias("balance"),
    )
    access.save_output(customers, f"customers{ending}")
    return access.read_output("customers", f"customers{ending}", customers.schema)


@query(_OUTPUT_SQL)
def output_parquet(spark, folder):
    return _saved_and_read(spark, folder, ".parquet")


@query(_OUTPUT_SQL)
def output_csv(spark, folder):
    return _saved_and_read(spark, folder, ".csv")


@query(_OUTPUT_SQL)
def output_json(spark, folder):
    return _saved_and_read(spark, folder, ".json")


@query("""SELECT o_custkey AS lr_id, COUNT(*) AS orders, MAX(o_orderkey) AS order_id FROM orders GROUP BY o_custkey""")
def column_map(spark, folder):
    """Physical column names replaced by the placeholders of the table's column map."""
    spark.read.parquet(f"{folder}/orders.parquet").createOrReplaceTempView("lift_orders")
    access = TableAccess(spark, columns={"lift_orders": {"lr_id": "o_custkey", "order_id": "o_orderkey"}})
    orders = access.read_mapped("lift_orders")
    return orders.groupBy("lr_id").agg(F.count("*").alias("orders"), F.max("order_id").alias("order_id"))


@query("""SELECT product_brand, COUNT(*) AS products FROM (SELECT p_brand AS product_brand FROM part WHERE p_size >= 25)
          GROUP BY product_brand""")
def sql_with_parameters(spark, folder):
    """SQL text with @table and :parameter placeholders."""
    access = TableAccess(spark, parameters={"MIN_SIZE": (25, "integer")})
    part = spark.read.parquet(f"{folder}/part.parquet")
    text = """SELECT p_brand AS product_brand, COUNT(*) AS products FROM @part
              WHERE p_size >= :min_size GROUP BY p_brand"""
    return run_sql(spark, text, {"part": part}, min_size=access.parameter("MIN_SIZE"))


# ---- conforming ------------------------------------------------------------------------------


@query("""SELECT CAST(c_custkey // 3 AS VARCHAR) AS addressLink, 1 AS treatment, 0 AS is_eligible_control,
                 CAST(c_nationkey AS BIGINT) AS exposure_frequency_deduped,
                 ROUND(c_acctbal, 6) AS baseline_12m_revenue_sum, 'missing' AS poc_label,
                 COALESCE(CASE WHEN c_nationkey > 12 THEN CAST(c_nationkey AS VARCHAR) END, 'missing') AS state_label,
                 CAST(NULL AS BIGINT) AS min_exposure_ts
          FROM customer""")
def conformed_columns(spark, folder):
    """Upper-case and older names, absent columns, nulls and types."""
    raw = spark.read.parquet(f"{folder}/customer.parquet").selectExpr(
        "CAST(c_custkey DIV 3 AS STRING) AS ADDRESSLINK",
        "'1' AS TREATMENT",
        "0L AS IS_ELIGIBLE_CONTROL",
        "c_nationkey AS Exposure_Frequency_Deduped",
        "c_acctbal AS baseline_12m_revenue",
        "CASE WHEN c_nationkey > 12 THEN CAST(c_nationkey AS STRING) END AS state_label",
    )
    df = conform(raw, S.ALL_FEATURES, [S.HOUSEHOLD, "treatment", "baseline_12m_revenue_sum"], "features")
    df = filled(df, {"poc_label": "missing", "state_label": "missing"})
    wanted = [
        S.HOUSEHOLD, "treatment", "is_eligible_control", "exposure_frequency_deduped", "baseline_12m_revenue_sum",
        "poc_label", "state_label", "min_exposure_ts",
    ]
    return rounded(typed(df, S.ALL_FEATURES).select(*wanted))


@query("""WITH texts AS (
            SELECT CASE l_linenumber WHEN 1 THEN ' TRUE ' WHEN 2 THEN 'n' WHEN 3 THEN '2' WHEN 4 THEN l_returnflag
                        WHEN 5 THEN 'Yes' WHEN 6 THEN l_linestatus END AS flag_text FROM lineitem)
          SELECT flag_text, CASE WHEN lower(trim(flag_text)) IN ('1', 'true', 't', 'yes', 'y') THEN 1
                                 WHEN lower(trim(flag_text)) IN ('0', 'false', 'f', 'no', 'n') THEN 0
                                 ELSE COALESCE(TRY_CAST(flag_text AS INT), 0) END AS flag, COUNT(*) AS rows
          FROM texts GROUP BY ALL""")
def flag_texts(spark, folder):
    line = F.col("l_linenumber")
    text = (
        F.when(line == 1, " TRUE ").when(line == 2, "n").when(line == 3, "2").when(line == 4, F.col("l_returnflag"))
        .when(line == 5, "Yes").when(line == 6, F.col("l_linestatus"))
    )
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(text.alias("flag_text"))
    return lines.groupBy("flag_text", parse_flag(F.col("flag_text")).alias("flag")).agg(F.count("*").alias("rows"))


@query(O.chain(("purchases",), """SELECT addressLink, CAST(0 AS BIGINT) AS baseline_12m_distinct_banners,
       baseline_12m_distinct_divisions FROM purchases"""))
def optional_distinct_counts(spark, folder):
    """A distinct count is 0 where its column is not delivered."""
    conversions = written(spark, folder, "raw_conversion").drop("banner")
    return household_purchases(conversions, CONFIG).select(
        S.HOUSEHOLD, "baseline_12m_distinct_banners", "baseline_12m_distinct_divisions"
    )


@query(O.chain(("features",), """SELECT addressLink, days_since_last_baseline_purchase,
       CASE WHEN days_since_last_baseline_purchase < 366 THEN 1 ELSE 0 END AS has_baseline_purchase FROM features"""))
def baseline_flag_from_recency(spark, folder):
    features = written(spark, folder, "AllFeatures").select(S.HOUSEHOLD, "days_since_last_baseline_purchase")
    return with_baseline_flag(features)


@query(O.chain(("features",), """
  SELECT addressLink, ROUND(outcome_total_campaign_revenue, 6) AS total_outcome,
         ROUND(outcome_campaign_product_revenue, 6) AS fallback_outcome,
         ROUND(baseline_60d_revenue, 6) AS placebo_outcome FROM features"""))
def outcome_choice(spark, folder):
    features = written(spark, folder, "AllFeatures")
    without = features.drop(E.TOTAL_OUTCOME)
    return rounded(
        features.select(
            S.HOUSEHOLD,
            F.col(E.outcome_column(features)).alias("total_outcome"),
            F.col(E.outcome_column(without)).alias("fallback_outcome"),
            F.col(E.outcome_column(features, E.PLACEBO_OUTCOME)).alias("placebo_outcome"),
        )
    )


# ---- identities ------------------------------------------------------------------------------


@query(O.chain(("latest_mapping",), "SELECT * FROM latest_mapping"))
def current_mapping(spark, folder):
    return I.current_mapping(retail_sources(spark, folder)["mapping"])


@query(O.chain(("latest_demographics",), "SELECT * FROM latest_demographics"))
def current_demographics(spark, folder):
    return I.current_demographics(retail_sources(spark, folder)["demographics"])


@query(O.chain(("demographics",), """
  SELECT addressLink, gender, age, state FROM (
    SELECT addressLink, gender, age, state,
           ROW_NUMBER() OVER (PARTITION BY addressLink ORDER BY install_date DESC NULLS LAST, gender NULLS LAST,
                              age NULLS LAST) AS rn
    FROM demographics WHERE trim(addressLink) <> '') WHERE rn = 1"""))
def current_people_by_household(spark, folder):
    """The newest record per household, where online identities are not delivered."""
    demographics = retail_sources(spark, folder)["demographics"].drop("rampid")
    return current_people(demographics).select(S.HOUSEHOLD, "gender", "age", "state")


@query(O.chain(("identities",), "SELECT * FROM identities"))
def identity_households(spark, folder):
    sources = retail_sources(spark, folder)
    return I.identity_households(sources["mapping"], sources["demographics"])


@query(O.chain(("mapping", "flight_exposure", "conversion"), """
  SELECT tp_id, exposures, orders FROM (
    SELECT tp_id, COUNT(*) AS exposures FROM flight_exposure GROUP BY tp_id) e
  JOIN (SELECT DISTINCT rampid_meta, rampid_rmn FROM mapping) m ON e.tp_id = m.rampid_meta
  LEFT JOIN (SELECT lr_id, COUNT(DISTINCT order_id) AS orders FROM conversion GROUP BY lr_id) c
    ON m.rampid_rmn = c.lr_id"""))
def bridge_join(spark, folder):
    """Exposures joined to purchases by way of the identity map."""
    sources = retail_sources(spark, folder)
    exposed = X.exposed_identities(X.flight_exposures(sources["exposure"], CONFIG)).select(
        "tp_id", F.col("exposure_frequency_deduped").alias("exposures")
    )
    buyers = sources["conversion"].groupBy("lr_id").agg(F.countDistinct("order_id").alias("orders"))
    tables = [I.BridgedTable(buyers, "lr_id", "rampid_rmn", "left")]
    return I.bridge_join(exposed, "tp_id", "rampid_meta", sources["mapping"], tables).drop("lr_id")


_HOT_JOINS = {"inner": "JOIN", "left": "LEFT JOIN", "right": "RIGHT JOIN", "full": "FULL JOIN", "left_semi": "SEMI JOIN", "left_anti": "ANTI JOIN"}
_MANY_SQL = "SELECT o_orderkey AS row_id, CASE WHEN o_orderkey % 10 <> 0 THEN 0 ELSE o_custkey % 500 END AS many_key FROM orders"
_ONE_SQL = """SELECT c_custkey AS other_id, CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_custkey END AS one_key FROM customer
  WHERE c_custkey % 3 = 0 AND c_custkey <= 1500"""


@query(f"WITH many AS ({_MANY_SQL}), one AS ({_ONE_SQL}) " + " UNION ALL ".join(
    f"""SELECT '{name}' AS join_type, many_key, {"CAST(NULL AS BIGINT)" if "_" in name else "one_key"} AS one_key, COUNT(*) AS rows,
        SUM(row_id) AS row_ids, {"CAST(NULL AS BIGINT)" if "_" in name else "SUM(other_id)"} AS other_ids
        FROM many {join} one ON many_key = one_key GROUP BY ALL""" for name, join in _HOT_JOINS.items()))
def hot_joins(spark, folder):
    """Joins of every type in which one key has nine tenths of the rows."""
    many = run_sql(spark, _MANY_SQL.replace("FROM orders", "FROM @orders"), {"orders": spark.read.parquet(f"{folder}/orders.parquet")})
    one = run_sql(spark, _ONE_SQL.replace("FROM customer", "FROM @customer"), {"customer": spark.read.parquet(f"{folder}/customer.parquet")})
    hot = hot_keys(many, "many_key", share=0.1, min_rows=100)
    results = []
    for name in _HOT_JOINS:
        joined = spread_join(many, one, "many_key", "one_key", name, hot, F.col("row_id"))
        if "_" in name:
            joined = joined.withColumns({"one_key": F.lit(None).cast("long"), "other_id": F.lit(None).cast("long")})
        results.append(
            joined.groupBy(F.lit(name).alias("join_type"), "many_key", "one_key").agg(
                F.count("*").alias("rows"), F.sum("row_id").alias("row_ids"), F.sum("other_id").alias("other_ids")
            )
        )
    return reduce(DataFrame.unionByName, results)


# ---- purchases -------------------------------------------------------------------------------


@query(O.chain(("campaign_products",), "SELECT product_id, campaign_id FROM campaign_products"))
def campaign_products(spark, folder):
    return C.campaign_products(retail_sources(spark, folder)["campaign"], CONFIG)


@query(O.chain(("scoped",), """SELECT transaction_date, COUNT(*) AS rows, MIN(transaction_timestamp_unix) AS first_epoch,
       MAX(transaction_timestamp_unix) AS last_epoch, SUM(quantity)::BIGINT AS quantity FROM scoped GROUP BY ALL"""))
def resolvable_conversions(spark, folder):
    """Purchases within the period whose identity has a household, by day."""
    sources = retail_sources(spark, folder)
    identities = I.identity_households(sources["mapping"], sources["demographics"])
    scoped = C.conversions_in_period(sources["conversion"], CONFIG)
    return C.resolvable_conversions(scoped, identities).groupBy("transaction_date").agg(
        F.count("*").alias("rows"),
        F.min("transaction_timestamp_unix").alias("first_epoch"),
        F.max("transaction_timestamp_unix").alias("last_epoch"),
        F.sum("quantity").alias("quantity"),
    )


@query(O.chain(("scoped",), """SELECT transaction_date, COUNT(*) AS rows, SUM(quantity)::BIGINT AS quantity,
       COUNT(DISTINCT lr_id) AS identities FROM scoped GROUP BY ALL"""))
def resolvable_conversions_by_day(spark, folder):
    """Purchases laid out in a folder per day and sorted by identity; the period's folders alone are read."""
    sources = retail_sources(spark, folder)
    path = f"{staging_root(spark).rstrip('/')}/purchases-{uuid.uuid4().hex}"
    save_by_day(sources["conversion"], path, "transaction_timestamp_unix", ["lr_id"])
    laid = load_days(spark, path, sources["conversion"].schema)
    identities = I.identity_households(sources["mapping"], sources["demographics"])
    scoped = C.resolvable_conversions(C.conversions_in_period(laid, CONFIG), identities)
    return scoped.groupBy("transaction_date").agg(
        F.count("*").alias("rows"), F.sum("quantity").alias("quantity"), F.count_distinct("lr_id").alias("identities")
    )


@query(O.chain(("deduped",), """SELECT lr_id, order_id, product_id, transaction_timestamp_unix, transaction_date,
       transaction_category, product_brand, banner, division, CAST(transaction_amount AS DOUBLE) AS transaction_amount,
       quantity FROM deduped"""))
def conversions_by_identity(spark, folder):
    """Largest row per identity, order, time and product."""
    sources = retail_sources(spark, folder)
    identities = I.identity_households(sources["mapping"], sources["demographics"])
    scoped = C.conversions_in_period(sources["conversion"], CONFIG)
    unique = C.dedupe_by_identity(C.resolvable_conversions(scoped, identities))
    return unique.withColumn("transaction_amount", F.col("transaction_amount").cast("double"))


@query(O.chain(("raw_conversion",), "SELECT * FROM raw_conversion"))
def household_conversions(spark, folder):
    sources = retail_sources(spark, folder)
    identities = I.identity_households(sources["mapping"], sources["demographics"])
    return C.household_conversions(sources["conversion"], identities, sources["campaign"], CONFIG)


# ---- assignment ------------------------------------------------------------------------------


@query(O.chain(("flight_exposure",), "SELECT * FROM flight_exposure"))
def flight_exposures(spark, folder):
    return X.flight_exposures(retail_sources(spark, folder)["exposure"], CONFIG)


@query(O.chain(("flight_exposure",), "SELECT * FROM flight_exposure"))
def flight_exposures_by_day(spark, folder):
    """The same from exposures laid out in a folder per day, of which only the flight's are read."""
    exposure = retail_sources(spark, folder)["exposure"]
    path = f"{staging_root(spark).rstrip('/')}/exposures-{uuid.uuid4().hex}"
    save_by_day(exposure, path, "ts", ["tp_id"])
    return X.flight_exposures(load_days(spark, path, exposure.schema), CONFIG)


@query(O.chain(("exposed",), "SELECT * FROM exposed"))
def exposed_identities(spark, folder):
    return X.exposed_identities(X.flight_exposures(retail_sources(spark, folder)["exposure"], CONFIG))


@query(O.chain(("online",), "SELECT * FROM online"))
def identities_with_exposure(spark, folder):
    sources = retail_sources(spark, folder)
    identities = I.identity_households(sources["mapping"], sources["demographics"])
    exposed = X.exposed_identities(X.flight_exposures(sources["exposure"], CONFIG))
    return X.identities_with_exposure(identities, exposed, []).drop("Grouping_Indicator", "hhpel").distinct()


@query(O.chain(("online",), "SELECT * FROM online"))
def identities_with_exposure_spread(spark, folder):
    """The same with every widely shared identity spread over many tasks."""
    sources = retail_sources(spark, folder)
    identities = I.identity_households(sources["mapping"], sources["demographics"])
    exposed = X.exposed_identities(X.flight_exposures(sources["exposure"], CONFIG))
    hot = hot_keys(sources["mapping"], "rampid_meta", share=0.0001, min_rows=3)
    return X.identities_with_exposure(identities, exposed, hot).drop("Grouping_Indicator", "hhpel").distinct()


@query(O.chain(("raw_exposure",), f"SELECT {names_of(S.RAW_EXPOSURE)} FROM raw_exposure"))
def household_assignment(spark, folder):
    sources = retail_sources(spark, folder)
    identities = I.identity_households(sources["mapping"], sources["demographics"])
    return X.household_assignment(sources["exposure"], identities, sources["mapping"], CONFIG)


# ---- features --------------------------------------------------------------------------------


@query(O.chain(("demographic_features",), "SELECT * FROM demographic_features"))
def household_demographic_features(spark, folder):
    return household_demographics(current_people(retail_sources(spark, folder)["demographics"]))


@query(O.chain(("purchases",), "SELECT * FROM purchases"))
def household_purchase_features(spark, folder):
    return rounded(household_purchases(written(spark, folder, "raw_conversion"), CONFIG))


@query(O.chain(("features",), f"SELECT {rounded_sql(S.ALL_FEATURES)} FROM features"))
def household_features(spark, folder):
    """Sources to the full feature table, with the tables that a campaign run writes on the way."""
    tables = prepare_households(retail_sources(spark, folder), CONFIG)
    return rounded(tables["AllFeatures"])


# ---- matching --------------------------------------------------------------------------------


@query(O.chain(("eligible",), "SELECT addressLink, treatment, has_partial_exposure_within_addresslink FROM eligible"))
def eligible_households(spark, folder):
    return M.eligible_households(written(spark, folder, "AllFeatures")).select(
        S.HOUSEHOLD, "treatment", "has_partial_exposure_within_addresslink"
    )


@query(O.chain(("strata_counts",), "SELECT * FROM strata_counts"))
def stratum_counts(spark, folder):
    return M.stratum_counts(M.eligible_households(written(spark, folder, "AllFeatures")))


@query(O.chain(("stratified",), f"SELECT {rounded_sql(S.STRATIFIED)} FROM stratified"))
def stratified_match(spark, folder):
    return rounded(M.in_report_order(M.stratify(written(spark, folder, "AllFeatures"), CONFIG)))


def _standin_scores(spark, folder):
    raw = F.col("baseline_12m_orders").cast("double") / F.lit(16.0)
    return M.eligible_households(written(spark, folder, "AllFeatures")).withColumn(
        "propensity_score", clipped(raw, CONFIG.score_floor, CONFIG.score_ceiling)
    )


@query(O.chain(("scored",), """SELECT ps_bin, COUNT(*) AS households, COUNT(*) FILTER (treatment = 1) AS treated,
       MIN(propensity_score) AS lowest, MAX(propensity_score) AS highest FROM scored GROUP BY ps_bin"""))
def score_bins(spark, folder):
    """Clipped scores and their caliper bins."""
    binned = _standin_scores(spark, folder).withColumn("ps_bin", caliper_bin(F.col("propensity_score"), CONFIG.caliper))
    return binned.groupBy("ps_bin").agg(
        F.count("*").alias("households"),
        F.count_if(F.col("treatment") == 1).alias("treated"),
        F.min("propensity_score").alias("lowest"),
        F.max("propensity_score").alias("highest"),
    )


@query(O.chain(("caliper",), """
  SELECT addressLink, treatment, propensity_score, CASE WHEN treatment = 0 THEN arm_rank END AS stratum_rank,
         CASE WHEN treatment = 1 THEN 'treatment' ELSE 'matched_control' END AS treatment_group,
         CASE WHEN treatment = 1 THEN addressLink END AS treatment_addresslinks,
         CASE WHEN treatment = 0 THEN addressLink END AS candidate_control_addresslinks,
         CAST(1 AS BIGINT) AS sampled_unit FROM caliper"""))
def caliper_match(spark, folder):
    """One-to-one matching within score bins, on a score that SQL can compute too."""
    matched = M.propensity_match(_standin_scores(spark, folder), CONFIG)
    return M.in_report_order(matched).select(
        S.HOUSEHOLD, "treatment", "propensity_score", "stratum_rank", "treatment_group", "treatment_addresslinks",
        "candidate_control_addresslinks", "sampled_unit",
    )


@query(O.chain(("eligible",), """
  SELECT addressLink, treatment FROM eligible
  WHERE treatment = 1 OR CAST('0x' || substr(md5(addressLink || ':42'), 1, 15) AS BIGINT) <
    (SELECT CAST(FLOOR(CAST(2 * COUNT(*) FILTER (treatment = 1) AS DOUBLE) / COUNT(*) FILTER (treatment = 0)
                       * 1152921504606846976) AS BIGINT)
     FROM eligible)"""))
def rebalanced_sample(spark, folder):
    """All treated households and a hash sample of twice as many controls."""
    return M.rebalanced(M.eligible_households(written(spark, folder, "AllFeatures")), CONFIG).select(
        S.HOUSEHOLD, "treatment"
    )


@query(O.chain(("eligible",), """
  SELECT addressLink, CAST(CAST('0x' || substr(md5(addressLink || ':42'), 1, 8) AS BIGINT) % 5 AS INT) AS fold
  FROM eligible"""))
def folds(spark, folder):
    eligible = M.eligible_households(written(spark, folder, "AllFeatures"))
    fold = hash_bucket(F.col(S.HOUSEHOLD), CONFIG.folds, CONFIG.seed, CONFIG.order_hash)
    return eligible.select(S.HOUSEHOLD, fold.alias("fold"))


@query(O.chain(("eligible",), """
  SELECT addressLink, CAST(i AS DOUBLE) AS state_label_index FROM eligible JOIN (
    SELECT state_label, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, state_label) - 1 AS i
    FROM eligible GROUP BY state_label) USING (state_label)"""))
def label_index(spark, folder):
    """Labels numbered by frequency, ties alphabetical."""
    eligible = M.eligible_households(written(spark, folder, "AllFeatures"))
    indexer = StringIndexer(inputCols=["state_label"], outputCols=["state_label_index"], handleInvalid="keep")
    return indexer.fit(eligible).transform(eligible).select(S.HOUSEHOLD, "state_label_index")


# ---- estimation ------------------------------------------------------------------------------


_SEGMENTED = """
    o_totalprice / 100000 - 1.5 AS y_res, (o_orderkey % 7 - 3) / 10 AS t_res,
    CAST(o_custkey % 2 = 0 AS DOUBLE) AS seg_existing_buyer, CAST(o_orderkey % 3 = 0 AS DOUBLE) AS seg_lapsed,
    CAST(o_custkey % 5 = 0 AS DOUBLE) AS seg_young, CAST(o_orderpriority < '3' AS DOUBLE) AS seg_senior,
    CAST(o_orderstatus = 'F' AS DOUBLE) AS seg_high_income"""


_MODEL_COLUMNS = (
    "post_campaign_total_order_value", "pre_campaign_total_order_value", "baseline_60d_revenue", "gender", "est_age",
    "est_income_code", "revenue_bin_ordinal", "buyer_label_ordinal",
)


def _modelled(spark, folder):
    return E.with_model_columns(written(spark, folder, "StratifiedFeatures"), E.TOTAL_OUTCOME)


@query(O.chain(("modelled",), """
  SELECT addressLink, ROUND(post_campaign_total_order_value, 6) AS post_campaign_total_order_value,
         ROUND(pre_campaign_total_order_value, 6) AS pre_campaign_total_order_value,
         ROUND(baseline_60d_revenue, 6) AS baseline_60d_revenue, gender, ROUND(est_age, 6) AS est_age,
         ROUND(est_income_code, 6) AS est_income_code, revenue_bin_ordinal, buyer_label_ordinal FROM modelled"""))
def model_columns(spark, folder):
    return rounded(_modelled(spark, folder).select(S.HOUSEHOLD, *_MODEL_COLUMNS))


_CAPPED = ("post_campaign_total_order_value", "pre_campaign_total_order_value", "baseline_60d_revenue")
_cap = ", ".join(f"quantile_disc({c}, 0.99) AS cap_{i}" for i, c in enumerate(_CAPPED))
_capped_sql = ", ".join(f"ROUND(CASE WHEN {c} > cap_{i} THEN cap_{i} ELSE {c} END, 6) AS {c}" for i, c in enumerate(_CAPPED))


@query(O.chain(("features",), f"""
  , base AS (SELECT addressLink, outcome_total_campaign_revenue AS post_campaign_total_order_value,
                    baseline_12m_revenue_sum AS pre_campaign_total_order_value, baseline_60d_revenue FROM features),
  caps AS (SELECT {_cap} FROM base)
  SELECT addressLink, {_capped_sql} FROM base JOIN caps ON true"""))
def winsorised_spend(spark, folder):
    """Spend columns capped at their 99th percentile."""
    df = E.with_model_columns(written(spark, folder, "AllFeatures"), E.TOTAL_OUTCOME)
    return rounded(E.winsorised(df, E.upper_limits(df, _CAPPED)).select(S.HOUSEHOLD, *_CAPPED))


_WINDOWS = {
    "year": (CONFIG.baseline_start, CONFIG.baseline_end),
    "recent": (CONFIG.recent_start, CONFIG.baseline_end),
    "flight": (CONFIG.flight_start, CONFIG.flight_end),
}


@query(O.chain(("raw_conversion",), " UNION ALL ".join(f"""
  SELECT '{name}' AS period, CAST({share} AS DOUBLE) AS share, ROUND(quantile_disc(transaction_amount, {share}), 6) AS transaction_amount,
         ROUND(quantile_disc(quantity, {share}), 6) AS quantity
  FROM raw_conversion WHERE transaction_date BETWEEN DATE '{a}' AND DATE '{b}'"""
  for name, (a, b) in _WINDOWS.items() for share in (0.5, 0.99))))
def window_quantiles(spark, folder):
    """Exact quantiles of three periods from one written table of daily sketches."""
    purchases = written(spark, folder, "raw_conversion")
    columns = ["transaction_amount", "quantity"]
    kept = stage(K.sketches(purchases, "transaction_date", columns), "daily-sketches")
    rows = []
    for name, (a, b) in _WINDOWS.items():
        period = F.col("transaction_date").between(F.lit(a), F.lit(b))
        for share in (0.5, 0.99):
            found, _ = K.quantiles(purchases.where(period), kept.where(period), columns, share)
            rows.append((name, share, *[found[c] for c in columns]))
    return rounded(spark.createDataFrame(rows, "period string, share double, transaction_amount double, quantity double"))


def _predicted(spark, folder):
    """Predictions by group means, which SQL can compute too."""
    flags = {f"seg_{name}": value for name, value in E.segment_flags().items()}
    y = F.col("post_campaign_total_order_value")
    return _modelled(spark, folder).withColumns(flags).withColumns(
        {
            "y_hat": F.avg(y).over(Window.partitionBy("baseline_buyer_label")),
            "t_score": F.avg(F.col("treatment").cast("double")).over(Window.partitionBy("poc_label", "gender")),
        }
    )


@query(O.chain(("residual",), """
  SELECT addressLink, ROUND(y_res, 6) AS y_res, ROUND(t_res, 6) AS t_res,
         CAST(has_baseline_purchase AS DOUBLE) AS seg_existing_buyer,
         CASE WHEN days_since_last_baseline_purchase >= 30 THEN 1.0::DOUBLE ELSE 0.0 END AS seg_lapsed,
         CASE WHEN est_age <= 35 THEN 1.0::DOUBLE ELSE 0.0 END AS seg_young,
         CASE WHEN est_age >= 55 THEN 1.0::DOUBLE ELSE 0.0 END AS seg_senior,
         CASE WHEN est_income_code >= 20 THEN 1.0::DOUBLE ELSE 0.0 END AS seg_high_income FROM residual"""))
def residuals_and_segments(spark, folder):
    df = E.residuals(_predicted(spark, folder))
    return rounded(df.select(S.HOUSEHOLD, "y_res", "t_res", *[f"seg_{name}" for name in E.SEGMENTS]))


@query(O.chain(("residual",), """
  SELECT ROUND(slope, 9) AS effect, ROUND(se, 9) AS standard_error FROM (
    SELECT regr_slope(y_res, t_res) AS slope,
           sqrt((regr_syy(y_res, t_res) - regr_sxy(y_res, t_res) ** 2 / regr_sxx(y_res, t_res))
                / (regr_count(y_res, t_res) - 2) / regr_sxx(y_res, t_res)) AS se FROM residual)"""))
def residual_effect(spark, folder):
    """Slope and standard error of outcome residuals on treatment residuals."""
    row = E.effect_row(E.residuals(_predicted(spark, folder)))
    return rounded(row.select(F.col("mean_b")[0].alias("effect"), F.col("mean_e")[0].alias("standard_error")), 9)


@query(O.chain(("residual",), """
  SELECT COUNT(*) AS total_row_count, SUM(CAST(treatment AS DOUBLE)) AS treated_count,
         ROUND(AVG(CASE WHEN treatment = 1 THEN post_campaign_total_order_value END), 9) AS avg_treatment_amount,
         ROUND(1 - SUM(y_res ** 2) / (VAR_POP(post_campaign_total_order_value) * COUNT(*)), 9) AS outcome_r2
  FROM residual"""))
def fit_statistics(spark, folder):
    return rounded(E.fit_statistics(_predicted(spark, folder)), 9)


@query(O.chain(("predicted",), """
  , ranked AS (SELECT treatment, RANK() OVER (ORDER BY t_score) + (COUNT(*) OVER (PARTITION BY t_score) - 1) / 2.0 AS r
               FROM predicted)
  SELECT ROUND((SUM(r) FILTER (treatment = 1) - COUNT(*) FILTER (treatment = 1) * (COUNT(*) FILTER (treatment = 1) + 1) / 2.0)
         / (COUNT(*) FILTER (treatment = 1) * COUNT(*) FILTER (treatment = 0)), 9) AS treatment_auc FROM ranked"""))
def treatment_auc(spark, folder):
    return rounded(E.treatment_auc(_predicted(spark, folder)), 9)


@query(O.chain(("residual",), """
  , fit AS (SELECT regr_slope(y_res, t_res) AS effect,
           sqrt((regr_syy(y_res, t_res) - regr_sxy(y_res, t_res) ** 2 / regr_sxx(y_res, t_res))
                / (regr_count(y_res, t_res) - 2) / regr_sxx(y_res, t_res)) AS se,
           AVG(CASE WHEN treatment = 1 THEN post_campaign_total_order_value END) AS treated FROM residual)
  SELECT ROUND(treated - effect, 9) AS expected_amount, ROUND(effect / (treated - effect) * 100, 9) AS lift_percent,
         ROUND(effect - 1.96 * se, 9) AS lift_ci_lower, ROUND(effect + 1.96 * se, 9) AS lift_ci_upper,
         ROUND((effect - 1.96 * se) / (treated - effect) * 100, 9) AS lift_pct_ci_lower,
         ROUND((effect + 1.96 * se) / (treated - effect) * 100, 9) AS lift_pct_ci_upper FROM fit"""))
def lift_limits(spark, folder):
    """Counterfactual mean, lift percent and confidence limits."""
    row = E.effect_row(E.residuals(_predicted(spark, folder)))
    columns = E.lift_columns(F.col("mean_b")[0], F.col("mean_e")[0], F.col("avg_treatment_amount"))
    return rounded(row.withColumns(columns).select(*columns), 9)


_BALANCE = ", ".join(
    f"""ROUND((AVG({c}) FILTER (treatment = 1) - AVG({c}) FILTER (treatment = 0))
        / NULLIF(sqrt((VAR_SAMP({c}) FILTER (treatment = 1) + VAR_SAMP({c}) FILTER (treatment = 0)) / 2), 0), 6) AS smd_{c}"""
    for c in D.BALANCE_COVARIATES
)


@query(O.chain(("stratified",), f"SELECT {_BALANCE} FROM stratified"))
def covariate_balance(spark, folder):
    return rounded(D.covariate_balance(written(spark, folder, "StratifiedFeatures")))


@query(O.chain(("eligible", "stratified"), f"""
  , b AS (SELECT COUNT(*) FILTER (treatment = 1) AS treated_count,
                 COUNT(*) FILTER (treatment = 0) AS control_count_pre_match FROM eligible),
  a AS (SELECT COUNT(*) FILTER (treatment = 0) AS matched_control_count,
               AVG(outcome_campaign_product_revenue) FILTER (treatment = 1) AS avg_revenue_treated,
               AVG(outcome_campaign_product_revenue) FILTER (treatment = 0) AS avg_revenue_control,
               AVG(outcome_campaign_product_buyer) FILTER (treatment = 1) AS conversion_rate_treated,
               AVG(outcome_campaign_product_buyer) FILTER (treatment = 0) AS conversion_rate_control,
               {_BALANCE} FROM stratified)
  SELECT treated_count, control_count_pre_match, matched_control_count,
         ROUND(matched_control_count / treated_count, 6) AS match_rate, CAST(NULL AS DOUBLE) AS propensity_model_auc,
         ROUND(avg_revenue_treated, 6) AS avg_revenue_treated, ROUND(avg_revenue_control, 6) AS avg_revenue_control,
         ROUND((avg_revenue_treated - avg_revenue_control) * treated_count, 6) AS incremental_revenue,
         ROUND((avg_revenue_treated - avg_revenue_control) / NULLIF(avg_revenue_control, 0) * 100, 6) AS lift_revenue_pct,
         ROUND(conversion_rate_treated, 6) AS conversion_rate_treated,
         ROUND(conversion_rate_control, 6) AS conversion_rate_control,
         ROUND((conversion_rate_treated - conversion_rate_control) / NULLIF(conversion_rate_control, 0) * 100, 6)
           AS lift_conversion_pct,
         {", ".join(f"smd_{c}" for c in D.BALANCE_COVARIATES)}
  FROM a JOIN b ON true"""))
def match_report(spark, folder):
    eligible = M.eligible_households(written(spark, folder, "AllFeatures"))
    return rounded(D.match_report(eligible, written(spark, folder, "StratifiedFeatures")))


# ---- what must hold whatever the fitted models are -------------------------------------------


@query(f"""SELECT ROUND(SUM(y_res), 4) AS moment_one, ROUND(SUM(y_res * t_res), 4) AS moment_base,
         {", ".join(f"ROUND(SUM(y_res * t_res * seg_{n}), 4) AS moment_{n}" for n in E.SEGMENTS)}
  FROM (SELECT {_SEGMENTED} FROM orders)""")
def segment_effects(spark, folder):
    """Normal equations: the fitted values have the same product with every regressor as the outcome residuals.

    Residuals and segments are made from orders, so that no segment follows from the others."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    df = run_sql(spark, f"SELECT {_SEGMENTED} FROM @orders", {"orders": orders})
    terms = [F.col("t_res"), *[F.col("t_res") * F.col(f"seg_{name}") for name in E.SEGMENTS]]
    slopes = sum((F.lit(b) * x for b, x in zip(E.segment_effects(df).coefficients, terms)), F.lit(0.0))
    intercept = df.agg(F.avg(F.col("y_res") - slopes)).first()[0]
    names = ("one", "base", *E.SEGMENTS)
    moments = [F.sum((slopes + F.lit(intercept)) * x) for x in (F.lit(1.0), *terms)]
    # Adding zero makes a negative zero a positive one.
    return df.agg(*[(F.round(m, 4) + F.lit(0.0)).alias(f"moment_{n}") for n, m in zip(names, moments)])


O.cte("orders_segmented", (), f"SELECT {_SEGMENTED} FROM orders")
_SEGMENT_FLAGS = """
  , flagged AS (
    SELECT *, CAST(has_baseline_purchase AS DOUBLE) AS seg_existing_buyer,
           CASE WHEN days_since_last_baseline_purchase >= 30 THEN 1.0::DOUBLE ELSE 0.0 END AS seg_lapsed,
           CASE WHEN est_age <= 35 THEN 1.0::DOUBLE ELSE 0.0 END AS seg_young,
           CASE WHEN est_age >= 55 THEN 1.0::DOUBLE ELSE 0.0 END AS seg_senior,
           CASE WHEN est_income_code >= 20 THEN 1.0::DOUBLE ELSE 0.0 END AS seg_high_income FROM residual)"""
_TERMS = ["t_res", *[f"t_res * seg_{name}" for name in E.SEGMENTS]]


def _result_row_sql(source: str = "flagged") -> str:
    """The 24 columns from residuals: least squares, Student's t, rank sums, limits."""
    parts = ", ".join(
        f"ROUND((SELECT b FROM part_p WHERE j = 0) + (SELECT b FROM part_p WHERE j = {j}), 9) AS cate_{name}, "
        f"ROUND((SELECT p FROM part_p WHERE j = {j}), 9) AS cate_{name}_p_value"
        for j, name in enumerate(E.SEGMENTS, 1)
    )
    return f""",
  {O.least_squares(source, "y_res", _TERMS[:1], "mean")}, {O.p_values("mean_fit", "mean")},
  {O.least_squares(source, "y_res", _TERMS, "part")}, {O.p_values("part_fit", "part")},
  ranked AS (SELECT treatment, RANK() OVER (ORDER BY t_score) + (COUNT(*) OVER (PARTITION BY t_score) - 1) / 2.0 AS r
             FROM {source}),
  auc AS (SELECT (SUM(r) - COUNT(*) * (COUNT(*) + 1) / 2.0) / COUNT(*) / (SELECT COUNT(*) FROM ranked WHERE treatment = 0)
            AS treatment_auc FROM ranked WHERE treatment = 1),
  fit AS (SELECT COUNT(*) AS n, SUM(CAST(treatment AS DOUBLE)) AS treated,
                 AVG(post_campaign_total_order_value) FILTER (treatment = 1) AS amount,
                 1 - SUM(y_res ** 2) / (VAR_POP(post_campaign_total_order_value) * COUNT(*)) AS r2 FROM {source}),
  effect AS (SELECT b AS effect, e AS se, p FROM mean_p)
  SELECT ROUND(effect, 9) AS incremental_lift, ROUND(effect / (amount - effect) * 100, 9) AS lift_percent,
         ROUND(amount, 9) AS avg_treatment_amount, ROUND(amount - effect, 9) AS expected_amount, n AS total_row_count,
         treated AS treated_count, ROUND(r2, 9) AS outcome_r2, ROUND(treatment_auc, 9) AS treatment_auc,
         ROUND((effect - 1.96 * se) / (amount - effect) * 100, 9) AS lift_pct_ci_lower,
         ROUND((effect + 1.96 * se) / (amount - effect) * 100, 9) AS lift_pct_ci_upper,
         ROUND(effect - 1.96 * se, 9) AS lift_ci_lower, ROUND(effect + 1.96 * se, 9) AS lift_ci_upper,
         ROUND(p, 9) AS lift_p_value, ROUND((SELECT b FROM part_p WHERE j = 0), 9) AS ate_base, {parts}
  FROM fit, auc, effect"""


@query(O.chain(("residual",), _SEGMENT_FLAGS + _result_row_sql()))
def result_row(spark, folder):
    """The whole result row from predictions that SQL can compute."""
    return rounded(E.lift_summary(_predicted(spark, folder), CONFIG), 9)


@query(O.chain(("orders_segmented",), f""",
  {O.least_squares("orders_segmented", "y_res", _TERMS, "part")}, {O.p_values("part_fit", "part")}
  SELECT ['base', {", ".join(f"'{n}'" for n in E.SEGMENTS)}][j + 1] AS term, ROUND(b, 9) AS change, ROUND(e, 9) AS standard_error,
         ROUND(p, 9) AS p_value FROM part_p"""))
def segment_p_values(spark, folder):
    """Slopes, errors and p-values of the segments on orders, where none follows from the others."""
    df = run_sql(spark, f"SELECT {_SEGMENTED} FROM @orders", {"orders": spark.read.parquet(f"{folder}/orders.parquet")})
    row = fitted(df.agg(*cross_products(F.col("y_res"), E.segment_terms(), "part")), {"part": len(_TERMS)})
    names = F.array(*[F.lit(n) for n in ("base", *E.SEGMENTS)])
    parts = [c.alias(n) for c, n in zip((names, *[F.col(f"part_{p}") for p in "bep"]), ("term", "change", "standard_error", "p_value"))]
    return rounded(row.select(F.inline(F.arrays_zip(*parts))), 9)


@query(O.chain(("stratified",), """
  SELECT addressLink, treatment, CAST(CAST('0x' || substr(md5(addressLink || ':42'), 1, 8) AS BIGINT) % 5 AS INT) AS fold
  FROM stratified"""))
def cross_fitted_rows(spark, folder):
    """Every matched household is predicted once, by the models of its own fold."""
    design = E.design_matrix(written(spark, folder, "StratifiedFeatures"), E.LINEAR, CONFIG, E.TOTAL_OUTCOME)
    predicted = E.cross_fit(design, E.LINEAR, CONFIG).where("y_hat IS NOT NULL AND t_score BETWEEN 0 AND 1")
    return predicted.select(S.HOUSEHOLD, "treatment", "fold")


@query(O.chain(("eligible",), """
  SELECT COUNT(*) FILTER (treatment = 1) AS treated_households, CAST(0 AS BIGINT) AS repeated_households,
         CAST(0 AS BIGINT) AS ineligible_households, CAST(0 AS BIGINT) AS overfull_bins FROM eligible"""))
def propensity_match_rules(spark, folder):
    """All eligible treated households stay; controls are distinct, eligible and no more than a bin's treated."""
    matched = written(spark, folder, "PSMMatchedFeatures")
    eligible = M.eligible_households(written(spark, folder, "AllFeatures")).select(S.HOUSEHOLD)
    bins = matched.groupBy(caliper_bin(F.col("propensity_score"), CONFIG.caliper).alias("bin")).agg(
        F.sum(F.when(F.col("treatment") == 1, -1).otherwise(1)).alias("surplus")
    )
    households = matched.agg(
        F.count_if(F.col("treatment") == 1).alias("treated_households"),
        (F.count("*") - F.count_distinct(S.HOUSEHOLD)).alias("repeated_households"),
        F.lit(matched.join(eligible, S.HOUSEHOLD, "left_anti").count()).cast("long").alias("ineligible_households"),
    )
    return households.withColumn("overfull_bins", F.lit(bins.where("surplus > 0").count()).cast("long"))


@query(O.chain(("stratified",), """
  SELECT addressLink, ROUND(baseline_60d_revenue, 6) AS post_campaign_total_order_value,
         ROUND(baseline_12m_revenue_sum - baseline_60d_revenue, 6) AS pre_campaign_total_order_value,
         baseline_12m_orders - baseline_60d_orders AS baseline_12m_orders,
         ROUND(COALESCE((baseline_12m_revenue_sum - baseline_60d_revenue)
                        / NULLIF(baseline_12m_orders - baseline_60d_orders, 0), 0), 6) AS baseline_12m_avg_order_value
  FROM stratified"""))
def placebo_features(spark, folder):
    """The placebo's outcome, and earlier spend, orders and order value from before its days."""
    df = E.with_model_columns(written(spark, folder, "StratifiedFeatures"), E.PLACEBO_OUTCOME)
    names = ("post_campaign_total_order_value", "pre_campaign_total_order_value", "baseline_12m_orders")
    return rounded(df.select(S.HOUSEHOLD, *names, "baseline_12m_avg_order_value"))


@query("""SELECT *, lift_p_value > 0.05 AND lift_ci_lower <= 0 AND lift_ci_upper >= 0 AS placebo_passed FROM (
            SELECT c_nationkey AS nation, (c_nationkey % 8) / 40 AS lift_p_value,
                   ROUND(MIN(c_acctbal) + 400, 2) AS lift_ci_lower, ROUND(MAX(c_acctbal) - 9400, 2) AS lift_ci_upper
            FROM customer GROUP BY c_nationkey)""")
def placebo_verdicts(spark, folder):
    """The verdict on rows of which some are significant, or have limits that do not span zero."""
    customers = spark.read.parquet(f"{folder}/customer.parquet")
    rows = customers.groupBy(F.col("c_nationkey").alias("nation")).agg(
        ((F.first("c_nationkey") % 8) / 40).alias("lift_p_value"),
        F.round(F.min("c_acctbal") + 400, 2).alias("lift_ci_lower"),
        F.round(F.max("c_acctbal") - 9400, 2).alias("lift_ci_upper"),
    )
    return D.placebo_verdict(rows)


_STATISTICS_SQL = """SELECT '{name}' AS design, COUNT(*) AS total_row_count,
         SUM(CAST(treatment AS DOUBLE)) AS treated_count,
         ROUND(AVG(post_campaign_total_order_value) FILTER (treatment = 1), 6) AS avg_treatment_amount,
         ROUND(1 - SUM(y_res ** 2) / NULLIF(VAR_POP(post_campaign_total_order_value) * COUNT(*), 0), 6) AS outcome_r2
  FROM residual WHERE {where}"""


@query(O.chain(("residual",), " UNION ALL ".join(
    _STATISTICS_SQL.format(name=name, where=where)
    for name, where in (("everybody", "true"), ("buyers", "has_baseline_purchase = 1")))))
def estimates_compared(spark, folder):
    """Rows of two groups under one another, each with its name."""
    df = _predicted(spark, folder)
    buyers = df.where("has_baseline_purchase = 1")
    return rounded(D.compare_estimates({"everybody": E.fit_statistics(df), "buyers": E.fit_statistics(buyers)}))


# ---- fitted models ---------------------------------------------------------------------------


_SAMPLE = """CAST('0x' || substr(md5(addressLink || ':42'), 1, 15) AS BIGINT) <
    (SELECT CAST(FLOOR(CAST(2 * COUNT(*) FILTER (treatment = 1) AS DOUBLE) / COUNT(*) FILTER (treatment = 0)
                       * 1152921504606846976) AS BIGINT) FROM eligible_exact)"""
O.propensity(S.PROPENSITY_NUMERIC, S.PROPENSITY_CATEGORICAL, M.PROPENSITY_RIDGE, _SAMPLE)
_PROPENSITY_NAMES = [*S.PROPENSITY_NUMERIC, *[f"{c}_index" for c in S.PROPENSITY_CATEGORICAL]]


@query(O.chain(("propensity_weights", "propensity_scales"), f"""
  SELECT 'logistic' AS kind, [{", ".join(f"'{n}'" for n in _PROPENSITY_NAMES)}, '(intercept)'][j] AS feature,
         ROUND(CASE WHEN j > {len(_PROPENSITY_NAMES)} THEN w[j] - list_sum(list_transform(range(1, j), lambda k:
                      CASE WHEN deviation[k] > 0 THEN w[k] * mean[k] / deviation[k] ELSE 0 END))
                    WHEN deviation[j] > 0 THEN w[j] / deviation[j] ELSE 0 END, 6) AS coefficient
  FROM propensity_weights, propensity_scales, (SELECT unnest(range(1, {len(_PROPENSITY_NAMES) + 2})) AS j)"""))
def propensity_coefficients(spark, folder):
    """The fitted propensity model, which SQL fits again by another method."""
    _, fit = M.propensity_fit(written(spark, folder, "AllFeatures"), CONFIG)
    return rounded(N.coefficient_table(spark, [fit], _PROPENSITY_NAMES).drop("fold"))


@query(O.chain(("propensity_rows",), f"""
  SELECT addressLink, CAST(position AS INTEGER) AS position, ROUND(list_extract([{", ".join(f"v{j}" for j in range(len(_PROPENSITY_NAMES)))}], position + 1), 6) AS value
  FROM propensity_rows, (SELECT unnest(range({len(_PROPENSITY_NAMES)})) AS position)"""))
def propensity_vector(spark, folder):
    """The assembled features of every eligible household, number by number."""
    matrix = M.propensity_matrix(M.eligible_households(written(spark, folder, "AllFeatures")))
    return rounded(matrix.select(S.HOUSEHOLD, F.posexplode(vector_to_array("features")).alias("position", "value")))


_SCORED_MATCH = """
  , limited AS (SELECT * EXCLUDE (raw), CASE WHEN raw > 0.95 THEN 0.95 WHEN raw < 0.05 THEN 0.05 ELSE raw END AS propensity_score
                FROM propensity_scored WHERE {where}),
  ranked AS (
    SELECT *, SUM(treatment) OVER (PARTITION BY bin) AS in_bin,
           ROW_NUMBER() OVER (PARTITION BY bin, treatment ORDER BY md5(addressLink), addressLink) AS arm_rank
    FROM (SELECT *, CAST(floor(propensity_score / 0.01) AS INT) AS bin FROM limited)),
  matched AS (
    SELECT *, CASE WHEN treatment = 1 THEN 'treatment' ELSE 'matched_control' END AS treatment_group, CAST(1 AS BIGINT) AS sampled_unit,
           CASE WHEN treatment = 0 THEN arm_rank END AS stratum_rank, CASE WHEN treatment = 1 THEN addressLink END AS treatment_addresslinks,
           CASE WHEN treatment = 0 THEN addressLink END AS candidate_control_addresslinks
    FROM ranked WHERE treatment = 1 OR arm_rank <= in_bin)"""


@query(O.chain(("propensity_scored",), _SCORED_MATCH.format(where="true") + f" SELECT {rounded_sql(S.PROPENSITY_MATCHED)} FROM matched"))
def propensity_match(spark, folder):
    """Fitted propensity scores and the match on them."""
    return rounded(M.propensity_match(M.propensity_scores(written(spark, folder, "AllFeatures"), CONFIG), CONFIG))


@query(O.chain(("propensity_scored",), _SCORED_MATCH.format(where="raw BETWEEN 0.05 AND 0.95")
       + f" SELECT {rounded_sql(S.PROPENSITY_MATCHED)} FROM matched"))
def propensity_match_trimmed(spark, folder):
    """The same without households beyond the score limits."""
    scored = M.propensity_scores(written(spark, folder, "AllFeatures"), CONFIG, trim=True)
    return rounded(M.propensity_match(scored, CONFIG))


@query(O.chain(("modelled",), O.first_trees(
    E.TREES.numeric(E.TOTAL_OUTCOME), list(E.TREES.categorical), E.TREES.capped_columns(E.TOTAL_OUTCOME), E.TREES.tree_rows,
    E.TREES.tree_depth, E.TREES.tree_bins)))
def first_trees(spark, folder):
    """All splits and leaves of the first tree of every fold and target."""
    learner = replace(E.TREES, tree_iterations=1)
    design = E.design_matrix(written(spark, folder, "StratifiedFeatures"), learner, CONFIG, E.TOTAL_OUTCOME)
    binned, settings = B.binned_rows(design, learner, CONFIG)
    nodes = B.tree_table(binned, B.boosted_trees(binned, settings))
    names = F.array(*[F.lit(n) for n in B.feature_names(design)])
    ensemble = F.element_at(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(f).alias("f")) for t, f in settings.ensembles]), F.col("ensemble") + 1)
    nominal = F.col("feature").isin(*settings.nominal)
    return rounded(
        nodes.select(
            ensemble["t"].alias("target"),
            ensemble["f"].alias("fold"),
            "node",
            F.when(F.col("feature") >= 0, F.element_at(names, F.col("feature") + 1)).alias("feature"),
            F.when(
                F.col("feature") >= 0,
                F.when(nominal, F.array_join("left", ",")).otherwise(F.array_max("left").cast("string")),
            ).alias("left_bins"),
            "rows",
            "value",
        )
    )


def _equations(spark, folder, matched: str, kind: str):
    """Estimating equations of the published coefficients, by fold and feature, from the rows themselves."""
    design = E.design_matrix(written(spark, folder, matched), E.LINEAR, CONFIG, E.TOTAL_OUTCOME)
    names = B.feature_names(design)
    fits = E.linear_fits(design, E.LINEAR, CONFIG)
    published = N.coefficient_table(spark, fits, names).where(F.col("kind") == kind)
    models = published.groupBy("fold").agg(
        F.map_from_entries(F.collect_list(F.struct("feature", "coefficient"))).alias("model")
    )
    rows = design.withColumn("x", vector_to_array("features")).withColumnRenamed("fold", "own_fold")
    rows = rows.join(F.broadcast(models), F.col("own_fold") != F.col("fold"))  # a row trains every model but its fold's
    eta = sum((F.col("x")[j] * F.col("model")[n] for j, n in enumerate(names)), F.col("model")["(intercept)"])
    return rows.withColumn("eta", eta), names


def _by_feature(rows, names, residual, more=()):
    """Mean product of a residual with every feature, in units of the feature's largest value, by fold."""
    tops = [F.greatest(F.max(F.abs(F.col("x")[j])), F.lit(1.0)) for j in range(len(names))]
    products = [F.avg(residual * F.col("x")[j]) / tops[j] for j in range(len(names))]
    terms = [F.struct(F.lit(n).alias("feature"), p.alias("value")) for n, p in [*zip(names, products), ("(intercept)", F.avg(residual)), *more]]
    return rows.groupBy("fold").agg(F.array(*terms).alias("terms")).select("fold", F.inline("terms"))


_EQUATION_ROWS = f"""SELECT CAST(fold AS INTEGER) AS fold, feature, 0.0::DOUBLE AS value
  FROM (SELECT unnest(range(5)) AS fold), (SELECT unnest([{", ".join(f"'{n}'" for n in E.LINEAR.numeric(E.TOTAL_OUTCOME))},
    {", ".join(f"'{c}_index'" for c in E.LINEAR.categorical)}, '(intercept)'{{more}}]) AS feature)"""


@query(_EQUATION_ROWS.format(more=", '(scale)'"))
def huber_equations(spark, folder):
    """The outcome models of the strata match: their published slopes and scale solve the estimating equations.

    A scale at its lower bound, where few rows are fitted without residuals, may only not ask to be larger."""
    rows, names = _equations(spark, folder, "StratifiedFeatures", N.HUBER)
    z = (F.col("post_campaign_total_order_value") - F.col("eta")) / F.col("model")["(scale)"]
    limited = F.greatest(F.least(z, F.lit(E.LINEAR.epsilon)), F.lit(-E.LINEAR.epsilon))
    least = 1.000001 * N.SCALE_FLOOR * F.stddev_samp("post_campaign_total_order_value")
    pull = F.avg(limited * limited) - 1
    scale = F.when(F.first(F.col("model")["(scale)"]) <= least, F.greatest(pull, F.lit(0.0))).otherwise(pull)
    found = _by_feature(rows, names, limited, [("(scale)", scale)])
    return found.withColumn("value", F.round("value", 6) + F.lit(0.0))


@query(_EQUATION_ROWS.format(more=""))
def treatment_equations(spark, folder):
    """The treatment models of the strata match: the gradient of the penalised likelihood vanishes."""
    rows, names = _equations(spark, folder, "StratifiedFeatures", N.LOGISTIC)
    residual = 1.0 / (1.0 + F.exp(-F.col("eta"))) - F.col("treatment")
    tops = [F.greatest(F.max(F.abs(F.col("x")[j])), F.lit(1.0)) for j in range(len(names))]
    penalty = [E.LINEAR.ridge * F.var_samp(F.col("x")[j]) * F.first("model")[n] for j, n in enumerate(names)]
    products = [(F.avg(residual * F.col("x")[j]) + penalty[j]) / tops[j] for j in range(len(names))]
    terms = [F.struct(F.lit(n).alias("feature"), p.alias("value")) for n, p in [*zip(names, products), ("(intercept)", F.avg(residual))]]
    found = rows.groupBy("fold").agg(F.array(*terms).alias("terms")).select("fold", F.inline("terms"))
    return found.withColumn("value", F.round("value", 6) + F.lit(0.0))


def _balance(matched: DataFrame) -> DataFrame:
    found = D.balance_table(matched, S.PROPENSITY_NUMERIC)
    return found.withColumns({c: F.round(c, d) for c, d in (("smd", 6), ("variance_ratio", 6), ("ks_distance", 9))})


@query(O.chain(("stratified_exact",), O.balance("stratified_exact", S.PROPENSITY_NUMERIC)))
def balance_of_strata_match(spark, folder):
    """Means, variances and distributions of every numeric propensity covariate in the two arms."""
    return _balance(written(spark, folder, "StratifiedFeatures"))


@query(O.chain(("propensity_scored",), _SCORED_MATCH.format(where="true") + O.balance("matched", S.PROPENSITY_NUMERIC)))
def balance_of_propensity_match(spark, folder):
    return _balance(written(spark, folder, "PSMMatchedFeatures"))


# The order in which the matched tables are reported.
_STRATA_ORDER = f"treatment DESC, {O.STRATA}, treatment_group DESC, stratum_rank, addressLink"


@query(O.chain(("stratified",), f"SELECT addressLink, ROW_NUMBER() OVER (ORDER BY {_STRATA_ORDER}) AS place FROM stratified"))
def strata_report_order(spark, folder):
    """Places of the sorted report rows, as they come out of the sort."""
    return _placed(M.in_report_order(written(spark, folder, "StratifiedFeatures")))


@query(O.chain(("propensity_scored",), _SCORED_MATCH.format(where="true") + """
  SELECT addressLink, ROW_NUMBER() OVER (ORDER BY treatment DESC, treatment_group, propensity_score DESC, addressLink) AS place FROM matched"""))
def propensity_report_order(spark, folder):
    return _placed(M.in_report_order(written(spark, folder, "PSMMatchedFeatures")))


@query(O.chain(("eligible",), "SELECT addressLink, ROW_NUMBER() OVER (ORDER BY treatment DESC, addressLink) AS place FROM eligible"))
def household_report_order(spark, folder):
    """Tables without score and stratum rank are sorted by arm and household."""
    return _placed(M.in_report_order(M.eligible_households(written(spark, folder, "AllFeatures"))))


def _placed(ordered: DataFrame) -> DataFrame:
    """Numbers rows as they come: partitions of a sorted frame follow one another, and so do their rows."""
    rows = stage(ordered.select(S.HOUSEHOLD).withColumn("at", F.monotonically_increasing_id()), "report-order")
    parts = rows.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = F.broadcast(parts.select("part", before.alias("before")))  # a row a partition
    place = F.col("before") + F.col("at") - F.shiftleft(F.col("part"), 33) + 1
    return rows.withColumn("part", F.shiftright("at", 33)).join(parts, "part").select(S.HOUSEHOLD, place.alias("place"))


# ---- whole estimates: no SQL equivalent ------------------------------------------------------


@query()
def lift_psm_linear(spark, folder):
    return E.estimate_lift(written(spark, folder, "PSMMatchedFeatures"), CONFIG)


@query()
def lift_strata_linear(spark, folder):
    return E.estimate_lift(written(spark, folder, "StratifiedFeatures"), CONFIG)


@query()
def placebo_psm_linear(spark, folder):
    matched = written(spark, folder, "PSMMatchedFeatures")
    return D.placebo_verdict(E.estimate_lift(matched, CONFIG, outcome=E.PLACEBO_OUTCOME))


@query()
def placebo_strata_linear(spark, folder):
    matched = written(spark, folder, "StratifiedFeatures")
    return D.placebo_verdict(E.estimate_lift(matched, CONFIG, outcome=E.PLACEBO_OUTCOME))


@query()
def lift_psm_trees(spark, folder):
    return E.estimate_lift(written(spark, folder, "PSMMatchedFeatures"), CONFIG, E.TREES)


@query()
def placebo_psm_trees(spark, folder):
    matched = written(spark, folder, "PSMMatchedFeatures")
    return D.placebo_verdict(E.estimate_lift(matched, CONFIG, E.TREES, E.PLACEBO_OUTCOME))


@query()
def compared_designs(spark, folder):
    """Linear estimates on both matchings under one another."""
    return D.compare_estimates(
        {
            "psm_linear": E.estimate_lift(written(spark, folder, "PSMMatchedFeatures"), CONFIG),
            "strata_linear": E.estimate_lift(written(spark, folder, "StratifiedFeatures"), CONFIG),
        }
    )
