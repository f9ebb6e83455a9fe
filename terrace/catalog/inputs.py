"""Inputs of the registered queries, derived from the given tables.

The given tables hold no NULLs and no dirty values, so bank- and sales-shaped rows are
computed from them by arithmetic on keys. Each text runs unchanged in Spark and in the
SQL engine that checks the results; ``{name}`` stands for a given table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from terrace.sources import scan_path

TABLES = ("region", "nation", "customer", "part", "orders", "events")

CUSTOMERS_RAW = """
SELECT CAST(c_custkey AS INT) AS customer_id,
 CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_name END AS name,
 CASE WHEN c_custkey % 89 = 0 THEN NULL WHEN c_custkey % 83 = 0 THEN DATE '1899-12-31'
      ELSE DATE '1940-01-01' + CAST(c_custkey * 37 % 25000 AS INT) END AS dob,
 CASE c_custkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'X' END AS gender,
 n_name AS city,
 DATE '2010-01-01' + CAST(c_custkey * 13 % 4000 AS INT) AS join_date,
 CASE c_custkey % 5 WHEN 0 THEN 'active' WHEN 1 THEN 'Closed' WHEN 2 THEN '  ' WHEN 3 THEN NULL
      ELSE ' dormant ' END AS status,
 CASE c_custkey % 10 WHEN 7 THEN 'User' || CAST(c_custkey AS STRING) || '@bankcom' WHEN 8 THEN 'no-at-sign'
      ELSE 'User' || CAST(c_custkey AS STRING) || '@Bank.co.uk' END AS email,
 CASE c_custkey % 11 WHEN 0 THEN '07' || lpad(CAST(c_custkey AS STRING), 9, '0')
      WHEN 1 THEN ' +44 ' || lpad(CAST(c_custkey AS STRING), 10, '0') || ' '
      ELSE '+44-' || lpad(CAST(c_custkey AS STRING), 10, '0') END AS phone_number,
 CASE c_custkey % 6 WHEN 0 THEN 'mobile' WHEN 1 THEN 'Online' WHEN 2 THEN 'BRANCH' WHEN 3 THEN 'atm'
      WHEN 4 THEN 'mobile ' ELSE 'Mobile' END AS preferred_channel,
 c_mktsegment AS occupation,
 CASE WHEN c_acctbal < 0 THEN 'low' WHEN c_acctbal < 5000 THEN 'Medium' WHEN c_acctbal < 9000 THEN 'high'
      ELSE 'very high' END AS income_range,
 CASE c_custkey % 7 WHEN 0 THEN 'Low' WHEN 1 THEN 'medium' WHEN 2 THEN 'HIGH' WHEN 3 THEN 'extreme'
      ELSE 'low' END AS risk_segment
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""

ACCOUNTS_RAW = """
SELECT o_custkey * 10 + o_orderkey % 3 AS account_id, o_custkey AS customer_id,
 CASE WHEN o_orderkey % 2 = 0 THEN 'savings' ELSE 'Current' END AS account_type,
 o_totalprice / 10 AS balance,
 CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderkey END AS txn_id,
 CAST(o_orderdate AS DATE) AS txn_date,
 CASE o_orderkey % 5 WHEN 0 THEN 'debitt' WHEN 1 THEN 'Credit' WHEN 2 THEN 'DEBIT' WHEN 3 THEN NULL
      ELSE 'CREDIT' END AS txn_type,
 o_totalprice AS txn_amount,
 CASE o_orderkey % 6 WHEN 0 THEN 'atm' WHEN 1 THEN 'Branch' WHEN 2 THEN 'online' WHEN 3 THEN 'mobile'
      WHEN 4 THEN NULL ELSE 'ONLINE' END AS txn_channel
FROM {orders}
"""

SALES_RAW = """
SELECT CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_orderkey END AS sales_id, o_custkey AS customer_id,
 o_orderkey % (SELECT count(*) FROM {part}) AS product_id, CAST(o_orderkey % 9 + 1 AS INT) AS quantity,
 o_totalprice AS amount, o_orderdate AS sale_timestamp,
 CASE WHEN c_nationkey < 13 THEN 'east' ELSE 'west' END AS feed
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

# Three updates per customer, two per product.
CUSTOMERS_SRC = " UNION ALL ".join(
    f"""
SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_name END AS customer_name,
 CASE WHEN {v} = 1 AND c_custkey % 3 = 0 THEN 'MOVED-' || r_name ELSE r_name END AS region,
 DATE '1995-01-01' + CAST({v} * 1000 + c_custkey % 500 AS INT) AS last_updated
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
"""
    for v in (0, 1, 2)
)

PRODUCTS_SRC = " UNION ALL ".join(
    f"""
SELECT p_partkey AS product_id, p_type AS category,
 p_retailprice + {v} * 0.75 - CASE WHEN p_partkey % 50 = 0 THEN 5000 ELSE 0 END AS price,
 DATE '1995-06-01' + CAST({v} * 900 + p_partkey % 300 AS INT) AS last_updated
FROM {{part}}
"""
    for v in (0, 1)
)

USERS_RAW = f"""
SELECT CAST(customer_id AS BIGINT) AS user_id, email, name, occupation AS user_type, city AS country
FROM ({CUSTOMERS_RAW}) c
"""


class Inputs:
    """The given tables and the frames derived from them, built when first used."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return scan_path(self.spark, self.folder, name)

    def _derived(self, text: str) -> DataFrame:
        used = {n: self.table(n) for n in TABLES if f"{{{n}}}" in text}
        return self.spark.sql(text, **used)

    @cached_property
    def customers_raw(self) -> DataFrame:
        return self._derived(CUSTOMERS_RAW)

    @cached_property
    def accounts_raw(self) -> DataFrame:
        return self._derived(ACCOUNTS_RAW)

    @cached_property
    def sales_raw(self) -> DataFrame:
        return self._derived(SALES_RAW)

    @cached_property
    def customers_src(self) -> DataFrame:
        return self._derived(CUSTOMERS_SRC)

    @cached_property
    def products_src(self) -> DataFrame:
        return self._derived(PRODUCTS_SRC)

    @cached_property
    def users_raw(self) -> DataFrame:
        return self._derived(USERS_RAW)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")


def plain(text: str) -> str:
    """The text over tables of the same name, for another SQL engine."""
    return text.format(**{n: n for n in TABLES})
