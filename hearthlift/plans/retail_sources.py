"""The five source tables of the workload, derived from a retail star schema.

Customers are persons, three consecutive customers are a household, line items are purchases and
events are ad exposures. Every table is derived from whole input tables.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from hearthlift.config import CampaignConfig

RETAIL_CAMPAIGN = CampaignConfig(
    campaign_id=1, flight_start=date(2001, 6, 6), flight_end=date(2001, 8, 1), order_hash="md5"
)
# Days between the events' month and the flight.
EVENT_SHIFT_DAYS = 8249

_QUERIES = {
    # Everybody has an own identity and shares the household's first one.
    "mapping": """
        SELECT date_add(DATE '2000-01-01', CAST(c_custkey % 365 AS INT)) AS install_date,
               CAST(c_custkey AS STRING) AS rampid_dpm,
               CAST(c_custkey AS STRING) AS rampid_meta,
               CAST(c_custkey AS STRING) AS rampid_rmn
        FROM {customer}
        UNION ALL
        SELECT DATE '1999-01-01',
               CAST(c_custkey AS STRING),
               CAST(c_custkey DIV 3 * 3 AS STRING),
               CAST(c_custkey DIV 3 * 3 AS STRING)
        FROM {customer}
    """,
    # A current and an outdated record per person; a few persons have no usable household.
    "demographics": """
        SELECT CAST(c_custkey AS STRING) AS rampid,
               CAST(c_custkey AS STRING) AS Grouping_Indicator,
               CAST(c_custkey DIV 2 AS STRING) AS hhpel,
               CASE WHEN c_acctbal < -950 THEN NULL WHEN c_acctbal < -900 THEN ''
                    ELSE CAST(c_custkey DIV 3 AS STRING) END AS addressLink,
               CASE c_custkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN ' female' WHEN 2 THEN 'X' END AS gender,
               CAST(10 + c_custkey % 85 AS INT) AS age,
               CASE WHEN c_custkey % 11 <> 0 THEN c_nationkey END AS state,
               CAST(c_custkey % 7 AS INT) AS county,
               CAST(floor((c_acctbal + 1000) / 300) AS INT) AS hh_income,
               CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 2 = 0 END AS poc,
               date_add(DATE '2000-01-01', CAST(c_custkey % 365 AS INT)) AS install_date
        FROM {customer}
        UNION ALL
        SELECT CAST(c_custkey AS STRING),
               CAST(c_custkey AS STRING),
               CAST(c_custkey DIV 2 AS STRING),
               concat('former-', CAST(c_custkey DIV 5 AS STRING)),
               'F', CAST(9 + c_custkey % 85 AS INT), c_nationkey, 0, 1, true, DATE '1998-06-30'
        FROM {customer}
    """,
    # Clicks are delivered twice.
    "exposure": """
        WITH shown AS (
          SELECT timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts) - {shift} * 86400L AS ts,
                 CAST(user_id AS STRING) AS tp_id,
                 CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
                 event_type,
                 value
          FROM {events}
        ), shaped AS (
          SELECT ts, tp_id, CAST(NULL AS STRING) AS experiment_id, k AS ad_id, k DIV 2 AS adset_id,
                 k DIV 5 AS campaign_id, 7L AS account_id, event_type,
                 CASE WHEN value < 20 THEN 'feed' ELSE 'story' END AS placement_type,
                 CASE WHEN k % 2 = 0 THEN 'ios' ELSE 'android' END AS device_platform,
                 'phone' AS impression_device
          FROM shown
        )
        SELECT * FROM shaped UNION ALL SELECT * FROM shaped WHERE event_type = 'click'
    """,
    # Returned items are negative amounts.
    "conversion": """
        SELECT CAST(o_custkey AS STRING) AS lr_id,
               p_type AS transaction_category,
               CAST(o_orderkey AS STRING) AS order_id,
               p_brand AS product_brand,
               o_orderstatus AS banner,
               o_orderpriority AS division,
               CAST(datediff(CAST(o_orderdate AS DATE), DATE '1970-01-01') * 86400 + o_orderkey * 3607 % 86400 AS INT)
                 AS transaction_timestamp_unix,
               CAST(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(l_extendedprice AS DECIMAL(12, 2))
                    * CAST(1 - l_discount AS DECIMAL(4, 2)) * CAST(0.001 AS DECIMAL(4, 3)) AS DECIMAL(18, 2))
                 AS transaction_amount,
               CAST(l_quantity AS INT) AS quantity,
               CAST(l_partkey AS INT) AS product_id
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
    """,
    # Part of the products name their campaign by text only.
    "campaign": """
        SELECT CASE WHEN p_brand IN ('Brand#2', 'Brand#17', 'Brand#4') THEN '1' ELSE '2' END AS campaign_id,
               p_brand AS product_brand,
               p_type AS product_manufacturer,
               CAST(p_partkey AS STRING) AS product_id,
               DATE '2001-06-06' AS flight_start,
               DATE '2001-08-01' AS flight_end,
               CASE WHEN p_brand IN ('Brand#2', 'Brand#17') THEN 1L WHEN p_brand <> 'Brand#4' THEN 2L END
                 AS campaign_id_long,
               'publisher' AS publisher_name
        FROM {part}
    """,
}
_INPUTS = ("customer", "events", "lineitem", "orders", "part")


def retail_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    inputs = {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in _INPUTS}
    frames = {}
    for name, text in _QUERIES.items():
        used = {key: frame for key, frame in inputs.items() if "{" + key + "}" in text}
        frames[name] = spark.sql(text, shift=EVENT_SHIFT_DAYS, **used) if "{shift}" in text else spark.sql(text, **used)
    return frames
