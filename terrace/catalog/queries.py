"""The registered queries: one per operator, each with its answer in plain SQL.

Every query reads the given tables, or data Spark derives from them, in full. Answers
that depend on a date use a fixed one; load times are left out of the output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import suppress
from functools import reduce
from unittest import mock

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from terrace import fixed_values as fixed
from terrace import functions as fn
from terrace.catalog import oracle as sql
from terrace.catalog.inputs import Inputs
from terrace.catalog.oracle import AS_OF
from terrace.operators import (
    CENTS,
    DROP,
    WARN,
    Cdc,
    Rule,
    append_flows,
    effective_date_join,
    expect,
    quality,
    quarantine,
    rules,
    scd1,
    scd2,
    with_dimension_key,
    with_surrogate_key,
)
from terrace.operators.datasets import comment_of, named, save_table, save_view
from terrace.plans import bank, runs, sales, users
from terrace.session import new_work_dir
from terrace.sources import (
    read_csv,
    scan_table,
    select_all,
    stream_csv,
    stream_parquet,
    stream_table,
    with_audit_columns,
)
from terrace.streaming import (
    backfill,
    count_rules,
    current_rows,
    declare,
    dedup_within_watermark,
    finish,
    history,
    quarantined,
    read_checked,
    rule_totals,
    stream_checked,
    stream_scd,
    write_checked,
    write_on_time,
    write_stream,
)
from terrace.streaming import change_tables
from terrace.streaming.change_tables import TYPE_1, TYPE_2
from terrace.streaming.kept import KeptTable, Load

Query = Callable[[Inputs], DataFrame]

_queries: dict[str, Query] = {}
_answers: dict[str, str] = {}


def query(answer: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that gives its answer."""

    def add(build: Query) -> Query:
        _queries[build.__name__] = build
        if answer is not None:
            _answers[build.__name__] = answer
        return build

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: build(Inputs(spark, folder))

    return {name: bound(build) for name, build in _queries.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_answers)


# --- bank: bronze -----------------------------------------------------------


def _bronze_customers(i: Inputs) -> DataFrame:
    return bank.bronze_customers_clean(i.customers_raw)


def _bronze_accounts(i: Inputs) -> DataFrame:
    return bank.bronze_accounts_clean(i.accounts_raw)


@query(sql.bank("SELECT * FROM bronze_customers"))
def bronze_customers(i: Inputs) -> DataFrame:
    return _bronze_customers(i)


@query(sql.bank("SELECT * FROM bronze_accounts"))
def bronze_accounts(i: Inputs) -> DataFrame:
    return _bronze_accounts(i)


@query(sql.bank("SELECT * FROM customers_clean"))
def clean_customers(i: Inputs) -> DataFrame:
    return bank.clean_customers(i.customers_raw)


@query(sql.bank("SELECT customer_id, regexp_replace(phone_number, '[^0-9+]+', '', 'g') AS phone FROM customers_raw"))
def clean_phone(i: Inputs) -> DataFrame:
    return i.customers_raw.select("customer_id", fn.clean_phone(F.col("phone_number")).alias("phone"))


@query(
    sql.bank(
        "SELECT customer_id, CASE WHEN gender = 'M' THEN 'MALE' WHEN gender = 'F' THEN 'FEMALE' ELSE 'Unknown' END "
        "AS gender FROM customers_raw"
    )
)
def case_gender(i: Inputs) -> DataFrame:
    gender = fn.map_values(F.col("gender"), fixed.GENDER, fixed.GENDER_DEFAULT)
    return i.customers_raw.select("customer_id", gender.alias("gender"))


@query(
    sql.bank(
        "SELECT customer_id, upper(coalesce(CASE WHEN trim(status) <> '' THEN status END, 'unknown')) AS status "
        "FROM customers_raw"
    )
)
def case_status_blank(i: Inputs) -> DataFrame:
    status = F.upper(fn.blank_to(F.col("status"), fixed.STATUS_DEFAULT))
    return i.customers_raw.select("customer_id", status.alias("status"))


@query(
    sql.bank(
        "SELECT txn_id, account_id, CASE upper(txn_type) WHEN 'DEBITT' THEN 'DEBIT' WHEN 'CREDIT' THEN 'CREDIT' "
        "ELSE 'UNKNOWN' END AS txn_type, CASE WHEN upper(txn_type) IN ('DEBITT', 'DEBIT') THEN 'DEBIT' "
        "WHEN upper(txn_type) = 'CREDIT' THEN 'CREDIT' ELSE 'UNKNOWN' END AS txn_type_repaired FROM accounts_raw"
    )
)
def case_txn_type(i: Inputs) -> DataFrame:
    upper = F.upper("txn_type")
    return i.accounts_raw.select(
        "txn_id",
        "account_id",
        fn.map_values(upper, fixed.TXN_TYPE, fixed.TXN_TYPE_DEFAULT).alias("txn_type"),
        fn.map_values(upper, fixed.TXN_TYPE_REPAIRED, fixed.TXN_TYPE_DEFAULT).alias("txn_type_repaired"),
    )


@query(
    sql.bank(
        "SELECT customer_id, phone_number FROM customers_clean "
        f"WHERE regexp_matches(phone_number, '{fixed.PHONE_UK}')"
    )
)
def filter_phone_regex(i: Inputs) -> DataFrame:
    cleaned = bank.clean_customers(i.customers_raw)
    return cleaned.filter(fn.is_uk_phone(F.col("phone_number"))).select("customer_id", "phone_number")


@query(
    sql.bank(
        "SELECT customer_id, preferred_channel, income_range, risk_segment FROM customers_clean "
        "WHERE preferred_channel IN ('MOBILE', 'ONLINE', 'BRANCH', 'ATM') "
        "AND income_range IN ('LOW', 'MEDIUM', 'HIGH', 'VERY HIGH') AND risk_segment IN ('LOW', 'MEDIUM', 'HIGH')"
    )
)
def filter_in_lists(i: Inputs) -> DataFrame:
    return (
        bank.clean_customers(i.customers_raw)
        .filter(F.col("preferred_channel").isin(fixed.PREFERRED_CHANNELS))
        .filter(F.col("income_range").isin(fixed.INCOME_RANGES))
        .filter(F.col("risk_segment").isin(fixed.RISK_SEGMENTS))
        .select("customer_id", "preferred_channel", "income_range", "risk_segment")
    )


@query(sql.bank(f"SELECT customer_id, email FROM customers_raw WHERE {sql.email_ok(fixed.EMAIL_LOOSE)}"))
def email_rule_loose(i: Inputs) -> DataFrame:
    rule = Rule("valid_email", fn.email_predicate())
    return expect(i.customers_raw, [rule]).select("customer_id", "email")


@query(sql.bank(f"SELECT customer_id, email FROM customers_raw WHERE {sql.email_ok(fixed.EMAIL_STRICT)}"))
def email_rule_strict(i: Inputs) -> DataFrame:
    rule = Rule("valid_email", fn.email_predicate(strict=True))
    return expect(i.customers_raw, [rule]).select("customer_id", "email")


@query(sql.bank(f"SELECT * FROM customers_clean WHERE {sql.passes(sql.CUSTOMER_RULES)}"))
def expect_or_drop_customers(i: Inputs) -> DataFrame:
    return expect(bank.clean_customers(i.customers_raw), bank.customer_rules())


@query(sql.bank(f"SELECT * FROM accounts_clean WHERE {sql.passes(sql.ACCOUNT_RULES)}"))
def expect_or_drop_accounts(i: Inputs) -> DataFrame:
    return expect(bank.clean_accounts(i.accounts_raw), bank.account_rules())


@query(
    sql.sales(
        "SELECT 'rule_1' AS rule, count(*) FILTER (WHERE customer_id IS NULL) AS violations FROM customers_src "
        "UNION ALL SELECT 'rule_2', count(*) FILTER (WHERE customer_name IS NULL) FROM customers_src"
    )
)
def expect_warn_metrics(i: Inputs) -> DataFrame:
    """Counters gathered while the rows are written, one per rule."""
    counters = Observation("customers_stg")
    sales.customers_stg(i.customers_src, counters).write.format("noop").mode("overwrite").save()
    counts = [(name, counters.get[name]) for name in fixed.SALES_CUSTOMER_RULES]
    return i.spark.createDataFrame(counts, "rule string, violations bigint")


@query(sql.bank(sql.report("customers_clean", sql.CUSTOMER_RULES)))
def quality_report(i: Inputs) -> DataFrame:
    return quality.quality_report(bank.clean_customers(i.customers_raw), bank.customer_rules())


@query(sql.bank(sql.report("accounts_clean", sql.ACCOUNT_RULES)))
def quality_report_accounts(i: Inputs) -> DataFrame:
    return quality.quality_report(bank.clean_accounts(i.accounts_raw), bank.account_rules())


# --- bank: silver -----------------------------------------------------------


def _silver_customers(i: Inputs) -> DataFrame:
    return bank.silver_customers_transformed(_bronze_customers(i), AS_OF)


def _silver_transactions(i: Inputs) -> DataFrame:
    return bank.silver_accounts_transactions_transformed(_bronze_accounts(i))


@query(sql.bank("SELECT * FROM silver_customers"))
def silver_customers(i: Inputs) -> DataFrame:
    return _silver_customers(i).drop("transformation_date")


@query(sql.bank("SELECT * FROM silver_transactions"))
def silver_transactions(i: Inputs) -> DataFrame:
    return _silver_transactions(i).drop("acc_transformation_date")


@query(
    sql.bank(
        f"SELECT customer_id, date_sub('year', dob, {sql.AS_OF_SQL}) AS customer_age, "
        f"CAST(date_diff('day', join_date, {sql.AS_OF_SQL}) AS INT) AS tenure_days, "
        f"dob < DATE '1900-01-01' OR dob > {sql.AS_OF_SQL} AS dob_out_of_range_flag FROM customers_raw"
    )
)
def enrich_customers(i: Inputs) -> DataFrame:
    return bank.silver_customers_transformed(i.customers_raw, AS_OF).select(
        "customer_id", "customer_age", "tenure_days", "dob_out_of_range_flag"
    )


@query(sql.bank(f"SELECT customer_id, date_sub('year', dob, {sql.AS_OF_SQL}) AS age FROM customers_raw"))
def age_years(i: Inputs) -> DataFrame:
    return i.customers_raw.select("customer_id", fn.age_years(F.col("dob"), AS_OF).alias("age"))


@query(
    sql.bank(
        f"SELECT customer_id, CAST(date_diff('day', join_date, {sql.AS_OF_SQL}) AS INT) AS tenure FROM customers_raw"
    )
)
def tenure_days(i: Inputs) -> DataFrame:
    return i.customers_raw.select("customer_id", fn.tenure_days(F.col("join_date"), AS_OF).alias("tenure"))


@query(
    sql.bank(
        f"SELECT customer_id, dob, dob < DATE '1900-01-01' OR dob > {sql.AS_OF_SQL} AS flag FROM customers_raw"
    )
)
def dob_out_of_range(i: Inputs) -> DataFrame:
    return i.customers_raw.select("customer_id", "dob", fn.out_of_range(F.col("dob"), AS_OF).alias("flag"))


@query(
    sql.bank(
        "SELECT txn_id, account_id, CAST(year(txn_date) AS INT) AS txn_year, "
        "CAST(month(txn_date) AS INT) AS txn_month, CAST(day(txn_date) AS INT) AS txn_day FROM accounts_raw"
    )
)
def date_parts(i: Inputs) -> DataFrame:
    parts = fn.date_parts(F.col("txn_date"), "txn")
    return i.accounts_raw.withColumns(parts).select("txn_id", "account_id", *parts)


# Customers and transactions delivered twice, the second time with some changes.
_CUSTOMER_DELIVERIES = """SELECT *, 1 AS delivery FROM silver_customers UNION ALL
 SELECT * REPLACE (CASE WHEN customer_id % 3 = 0 THEN 'MOVED' ELSE city END AS city), 2 FROM silver_customers"""
_TRANSACTION_DELIVERIES = """SELECT *, 1 AS delivery FROM silver_transactions UNION ALL
 SELECT * REPLACE (CASE WHEN txn_id % 4 = 0 THEN balance + 1 ELSE balance END AS balance), 2 FROM silver_transactions"""


def _customer_deliveries(i: Inputs) -> DataFrame:
    first = _silver_customers(i)
    moved = F.when(F.col("customer_id") % 3 == 0, F.lit("MOVED")).otherwise(F.col("city"))
    second = first.withColumn("city", moved)
    return append_flows(first.withColumn("delivery", F.lit(1)), second.withColumn("delivery", F.lit(2)))


def _transaction_deliveries(i: Inputs) -> DataFrame:
    first = _silver_transactions(i)
    balance = F.when(F.col("txn_id") % 4 == 0, F.col("balance") + 1).otherwise(F.col("balance"))
    second = first.withColumn("balance", balance)
    return append_flows(first.withColumn("delivery", F.lit(1)), second.withColumn("delivery", F.lit(2)))


@query(
    sql.bank(
        sql.scd1("deliveries", "customer_id", "delivery", "* EXCLUDE (delivery, gone, nr)"),
        deliveries=_CUSTOMER_DELIVERIES,
    )
)
def silver_customers_scd1(i: Inputs) -> DataFrame:
    return bank.silver_customers_transformed_scd1(_customer_deliveries(i), "delivery").drop("delivery")


_TRANSACTION_COLUMNS = [
    "account_id",
    "customer_id",
    "account_type",
    "balance",
    "txn_date",
    "txn_type",
    "txn_amount",
    "txn_channel",
    "channel_type",
    "txn_year",
    "txn_month",
    "txn_day",
    "txn_direction",
]


@query(
    sql.bank(
        sql.scd2("deliveries", ["txn_id"], ["delivery"], _TRANSACTION_COLUMNS), deliveries=_TRANSACTION_DELIVERIES
    )
)
def silver_transactions_scd2(i: Inputs) -> DataFrame:
    """The number of the delivery stands in for its load time, which SQL can't know."""
    feed = _transaction_deliveries(i).withColumn("acc_transformation_date", F.col("delivery")).drop("delivery")
    return bank.silver_accounts_transactions_transformed_scd2(feed)


@query(sql.bank("SELECT * FROM silver_customers"))
def view_passthrough(i: Inputs) -> DataFrame:
    """A view over a stream, read by a stream."""
    silver = _silver_customers(i)
    stream = stream_parquet(i.spark, _parquet_folder(silver, "silver_customers", 2), silver.schema)
    name = f"silver_customers_transformed_view_{uuid.uuid4().hex}"
    view = save_view(bank.silver_customers_transformed_view(stream), name)
    return _append_and_read(view, "view").drop("transformation_date")


@query(sql.bank("SELECT * FROM silver_transactions"))
def materialize_copy(i: Inputs) -> DataFrame:
    """A stored table, recomputed from an older state of itself and then from its source."""
    schema = f"terrace_{uuid.uuid4().hex}"
    i.spark.sql(f"CREATE DATABASE {schema} LOCATION '{new_work_dir(i.spark, 'schema')}/tables'")
    view = bank.silver_accounts_transactions_transformed_view(_silver_transactions(i))
    name = f"{schema}.silver_accounts_transactions_transformed_view"
    half = save_table(view.filter("txn_id % 2 = 0"), name)
    save_table(half.unionByName(half), name)
    return save_table(view, name, comment_of(bank.silver_accounts_transactions_transformed_view)).drop("acc_transformation_date")


@query(sql.bank("SELECT customer_id, true AS same_age, true AS same_tenure, true AS same_flag FROM customers_raw"))
def dates_default_to_today(i: Inputs) -> DataFrame:
    today = F.current_date()
    return i.customers_raw.select(
        "customer_id",
        fn.age_years(F.col("dob")).eqNullSafe(fn.age_years(F.col("dob"), today)).alias("same_age"),
        fn.tenure_days(F.col("join_date")).eqNullSafe(F.datediff(today, F.col("join_date"))).alias("same_tenure"),
        fn.out_of_range(F.col("dob")).eqNullSafe(fn.out_of_range(F.col("dob"), today)).alias("same_flag"),
    )


@query(
    sql.bank(
        "SELECT 'customers' AS dataset, count(*) AS n, 1 AS load_times FROM silver_customers UNION ALL "
        "SELECT 'transactions', count(*), 1 FROM silver_transactions"
    )
)
def audit_timestamps(i: Inputs) -> DataFrame:
    """All rows of a load carry its time, and the same one."""
    both = (("customers", _silver_customers(i), "transformation_date"), ("transactions", _silver_transactions(i), "acc_transformation_date"))
    sizes = [
        df.agg(F.lit(name).alias("dataset"), F.count(time).alias("n"), F.count_distinct(time).alias("load_times"))
        for name, df, time in both
    ]
    return reduce(DataFrame.unionAll, sizes)


# --- bank: gold -------------------------------------------------------------


def _without_load_times(df: DataFrame) -> DataFrame:
    return df.drop("transformation_date", "acc_transformation_date")


@query(sql.bank("SELECT customer_id, txn_id, name, txn_amount FROM joined"))
def join_customer_transactions(i: Inputs) -> DataFrame:
    joined = bank.gold_cust_acc_trns_mv(_silver_customers(i), _silver_transactions(i))
    return joined.select("customer_id", "txn_id", "name", "txn_amount")


@query(sql.bank("SELECT * FROM joined"))
def gold_customer_transactions(i: Inputs) -> DataFrame:
    return _without_load_times(bank.gold_cust_acc_trns_mv(_silver_customers(i), _silver_transactions(i)))


@query(
    sql.bank(
        "SELECT c.* EXCLUDE (customer_id, nr, gone, delivery), t.* FROM latest c "
        "JOIN silver_transactions t ON c.customer_id = t.customer_id",
        deliveries=_CUSTOMER_DELIVERIES,
        latest=sql.scd1("deliveries", "customer_id", "delivery"),
    )
)
def gold_customer_transactions_current(i: Inputs) -> DataFrame:
    """Both deliveries share a load time, so their number settles which is current."""
    joined = bank.gold_cust_acc_trns_mv(
        _customer_deliveries(i), _silver_transactions(i), current_only=True, tiebreak=["delivery"]
    )
    return _without_load_times(joined)


@query(sql.bank(sql.totals("joined", sql.GOLD_KEYS)))
def gold_customer_agg(i: Inputs) -> DataFrame:
    return bank.gold_totals(_silver_customers(i), _silver_transactions(i), CENTS)


@query(sql.bank(sql.totals("joined", sql.GOLD_KEYS)))
def gold_customer_agg_over_join(i: Inputs) -> DataFrame:
    joined = bank.gold_cust_acc_trns_mv(_silver_customers(i), _silver_transactions(i))
    return bank.gold_cust_acc_trans_agg(joined, CENTS)


@query(
    sql.bank(
        sql.totals("twice", sql.GOLD_KEYS),
        deliveries=_CUSTOMER_DELIVERIES,
        twice="SELECT c.* EXCLUDE (customer_id, delivery), t.* FROM deliveries c "
        "JOIN silver_transactions t ON c.customer_id = t.customer_id",
    )
)
def gold_customer_agg_redelivered(i: Inputs) -> DataFrame:
    return bank.gold_totals(_customer_deliveries(i), _silver_transactions(i), CENTS)


@query(
    sql.bank(
        "SELECT customer_id, count(DISTINCT account_id) AS accounts, count(DISTINCT txn_channel) AS channels, "
        "count(*) AS n FROM accounts_raw GROUP BY customer_id"
    )
)
def agg_multi_distinct(i: Inputs) -> DataFrame:
    return i.accounts_raw.groupBy("customer_id").agg(
        F.count_distinct("account_id").alias("accounts"),
        F.count_distinct("txn_channel").alias("channels"),
        F.count("*").alias("n"),
    )


@query(
    sql.bank(
        "SELECT account_type, CAST(sum(CAST(CASE WHEN txn_type = 'CREDIT' THEN txn_amount ELSE 0 END AS "
        "DECIMAL(18,2))) AS DOUBLE) AS credits, CAST(sum(CAST(CASE WHEN txn_type = 'DEBIT' THEN txn_amount ELSE 0 "
        "END AS DECIMAL(18,2))) AS DOUBLE) AS debits, min(txn_date) AS first_date, max(txn_date) AS last_date "
        "FROM bronze_accounts GROUP BY account_type"
    )
)
def agg_conditional_sum(i: Inputs) -> DataFrame:
    def total(kind: str) -> F.Column:
        amount = F.when(F.col("txn_type") == kind, F.col("txn_amount")).otherwise(F.lit(0.0))
        return F.sum(amount.cast(CENTS)).cast("double")

    return (
        _bronze_accounts(i)
        .groupBy("account_type")
        .agg(
            total("CREDIT").alias("credits"),
            total("DEBIT").alias("debits"),
            F.min("txn_date").alias("first_date"),
            F.max("txn_date").alias("last_date"),
        )
    )


@query(
    sql.bank(
        sql.scd1("deliveries", "customer_id", "delivery", "* EXCLUDE (delivery, gone, nr)") + " ORDER BY customer_id",
        deliveries=_CUSTOMER_DELIVERIES,
    )
)
def sort_scd1(i: Inputs) -> DataFrame:
    return silver_customers_scd1(i).orderBy("customer_id")


@query(
    sql.bank(
        "SELECT * FROM ("
        + sql.scd2("deliveries", ["txn_id"], ["delivery"], _TRANSACTION_COLUMNS)
        + ") h WHERE account_id = 1001",
        deliveries=_TRANSACTION_DELIVERIES,
    )
)
def filter_equality(i: Inputs) -> DataFrame:
    return silver_transactions_scd2(i).filter(F.col("account_id") == 1001)


@query("SELECT * FROM orders")
def sql_select_star(i: Inputs) -> DataFrame:
    schema = f"terrace_{uuid.uuid4().hex}"
    folder = new_work_dir(i.spark, "schema")
    i.spark.sql(f"CREATE DATABASE {schema} LOCATION '{folder}'")
    save_table(i.table("orders"), f"{schema}.orders", "orders as given")
    return select_all(i.spark, schema, "orders")


@query("SELECT * FROM events")
def scan_all(i: Inputs) -> DataFrame:
    return i.events


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ("customer", "part", "orders", "events")
    )
)
def row_counts(i: Inputs) -> DataFrame:
    counts = [
        i.table(t).agg(F.count("*").alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t in ("customer", "part", "orders", "events")
    ]
    return reduce(DataFrame.unionAll, counts)


# --- sales ------------------------------------------------------------------


def _feeds(i: Inputs) -> list[DataFrame]:
    return [i.sales_raw.filter(F.col("feed") == side).drop("feed") for side in ("east", "west")]


def _sales_view(i: Inputs) -> DataFrame:
    return sales.sales_enr_view(sales.sales_stg(*_feeds(i)))


def _products_view(i: Inputs) -> DataFrame:
    return sales.products_enr_view(sales.products_stg(i.products_src))


def _customers_view(i: Inputs) -> DataFrame:
    return sales.customers_enr_view(sales.customers_stg(i.customers_src))


def _star(i: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        sales.fact_sales(_sales_view(i)),
        sales.dim_customers(_customers_view(i)),
        sales.dim_products(_products_view(i)),
    )


@query(sql.sales("SELECT * FROM customers_src"))
def stg_customers(i: Inputs) -> DataFrame:
    return sales.customers_stg(i.customers_src)


@query(sql.sales("SELECT * FROM products_src"))
def stg_products(i: Inputs) -> DataFrame:
    return sales.products_stg(i.products_src)


@query(sql.sales("SELECT * FROM sales_stg"))
def stg_sales(i: Inputs) -> DataFrame:
    return sales.sales_stg(*_feeds(i))


@query(sql.sales("SELECT * EXCLUDE (feed) FROM sales_raw"))
def append_flow_union(i: Inputs) -> DataFrame:
    return append_flows(*_feeds(i))


_PRODUCT_RULES = [("rule_1", "warn", "product_id IS NOT NULL"), ("rule_2", "warn", "price >= 0")]


@query(sql.sales(sql.report("products_src", _PRODUCT_RULES)))
def expect_all_products(i: Inputs) -> DataFrame:
    named = rules(fixed.SALES_PRODUCT_RULES, WARN)
    return quality.quality_report(expect(i.products_src, named), named)


@query(sql.sales("SELECT * EXCLUDE (feed) FROM sales_raw WHERE sales_id IS NOT NULL"))
def expect_all_or_drop_sales(i: Inputs) -> DataFrame:
    return expect(append_flows(*_feeds(i)), rules(fixed.SALES_RULES, DROP))


@query(sql.sales("SELECT * FROM customers_view"))
def enr_customers(i: Inputs) -> DataFrame:
    return _customers_view(i)


@query(sql.sales("SELECT * FROM products_view"))
def enr_products(i: Inputs) -> DataFrame:
    return _products_view(i)


@query(sql.sales("SELECT * FROM sales_view"))
def enr_sales(i: Inputs) -> DataFrame:
    return _sales_view(i)


@query(sql.sales("SELECT product_id, last_updated, CAST(trunc(price) AS INT) AS price FROM products_src"))
def price_cast_int(i: Inputs) -> DataFrame:
    return sales.products_enr_view(i.products_src, null_if_malformed=True).select(
        "product_id", "last_updated", "price"
    )


@query(sql.sales("SELECT sales_id, product_id, quantity * amount AS total_amount FROM sales_raw"))
def sales_total_amount(i: Inputs) -> DataFrame:
    return sales.sales_enr_view(i.sales_raw).select("sales_id", "product_id", "total_amount")


@query(sql.sales(sql.scd1("customers_view", "customer_id", "last_updated", "* EXCLUDE (gone, nr)")))
def scd1_customers(i: Inputs) -> DataFrame:
    return sales.customers_enr(_customers_view(i))


@query(sql.sales(sql.scd1("products_view", "product_id", "last_updated", "* EXCLUDE (gone, nr)")))
def scd1_products(i: Inputs) -> DataFrame:
    return sales.products_enr(_products_view(i))


@query(sql.sales(sql.scd1("sales_view", "sales_id", "sale_timestamp", "* EXCLUDE (gone, nr)")))
def scd1_sales(i: Inputs) -> DataFrame:
    return sales.sales_enr(_sales_view(i))


@query(sql.sales("SELECT * FROM fact_sales"))
def fact_sales(i: Inputs) -> DataFrame:
    return sales.fact_sales(_sales_view(i))


@query(sql.sales("SELECT * FROM dim_customers"))
def dim_customers_scd2(i: Inputs) -> DataFrame:
    return sales.dim_customers(_customers_view(i))


@query(sql.sales("SELECT * FROM dim_products"))
def dim_products_scd2(i: Inputs) -> DataFrame:
    return sales.dim_products(_products_view(i))


@query(sql.sales(sql.star("naive", "f.*, region, category")))
def star_join_naive(i: Inputs) -> DataFrame:
    return sales.star_join(*_star(i), sales.NAIVE)


@query(sql.sales(sql.star("current", "f.*, region, category")))
def star_join_current(i: Inputs) -> DataFrame:
    return sales.star_join(*_star(i), sales.CURRENT)


@query(sql.sales(sql.star("as_of", "f.*, region, category")))
def star_join_effective_date(i: Inputs) -> DataFrame:
    return sales.star_join(*_star(i), sales.AS_OF)


@query(sql.sales(sql.star("as_of", "f.*, region, category")))
def star_join_effective_date_range(i: Inputs) -> DataFrame:
    return sales.star_join(*_star(i), sales.AS_OF, method="range")


@query(sql.sales(sql.star("as_of", "f.*, region, category")))
def star_join_effective_date_sweep(i: Inputs) -> DataFrame:
    return sales.star_join(*_star(i), sales.AS_OF, method="sweep")


@query(sql.sales(sql.star("as_of", "f.*, region")))
def effective_date_join_descend(i: Inputs) -> DataFrame:
    """Groups of two versions, so that customers, who have more, are found over two levels."""
    fact, customers, products = _star(i)
    slim = customers.select("customer_id", "region", "valid_from", "valid_to")
    found = effective_date_join(fact, slim, "customer_id", "sale_timestamp", method="descend", max_versions=2)
    known = products.select("product_id", "valid_from", "valid_to")
    return effective_date_join(found, known, "product_id", "sale_timestamp")


@query(sql.sales(sql.business("naive")))
def business_sales_naive(i: Inputs) -> DataFrame:
    return sales.business_sales(*_star(i), sales.NAIVE, CENTS)


@query(sql.sales(sql.business("current")))
def business_sales_current(i: Inputs) -> DataFrame:
    return sales.business_sales(*_star(i), sales.CURRENT, CENTS)


@query(sql.sales(sql.business("as_of")))
def business_sales_effective_date(i: Inputs) -> DataFrame:
    return sales.business_sales(*_star(i), sales.AS_OF, CENTS)


@query(sql.sales(sql.business("as_of")))
def business_sales_effective_date_sweep(i: Inputs) -> DataFrame:
    return sales.business_sales(*_star(i), sales.AS_OF, CENTS, method="sweep")


@query(sql.sales(sql.business("naive") + " ORDER BY total_sales DESC, region, category LIMIT 20"))
def top_business_sales(i: Inputs) -> DataFrame:
    return sales.top_business_sales(business_sales_naive(i))


@query(sql.sales(sql.star("naive", "region, category, total_amount")))
def project_columns(i: Inputs) -> DataFrame:
    return sales.star_join(*_star(i), sales.NAIVE).select("region", "category", "total_amount")


@query(sql.sales("SELECT sales_id, quantity, amount, total_amount FROM fact_sales ORDER BY sales_id LIMIT 10"))
def sql_project_limit(i: Inputs) -> DataFrame:
    return i.spark.sql(
        "SELECT sales_id, quantity, amount, total_amount FROM {sales_enr} ORDER BY sales_id LIMIT 10",
        sales_enr=sales.sales_enr(_sales_view(i)),
    )


# --- change capture ---------------------------------------------------------

_SEQUENCE = ("ts", "event_id")
_EVENT_ORDER = "ts, event_id"
_LATEST = "* EXCLUDE (gone, nr)"
_IS_ERROR = "event_type = 'error'"
_IS_TRUNCATE = "event_type = 'signup' AND event_id % 500 = 0"


@query(sql.scd1("events", "user_id", _EVENT_ORDER, _LATEST))
def scd1_latest(i: Inputs) -> DataFrame:
    return scd1(i.events, Cdc("user_id", _SEQUENCE))


@query(sql.scd1("events", "user_id", _EVENT_ORDER, _LATEST))
def scd1_out_of_order(i: Inputs) -> DataFrame:
    """Loads that come newest first, each in reverse order of time; sequence given as expressions."""
    cdc = Cdc("user_id", (F.col("ts"), F.col("event_id")))
    folder = new_work_dir(i.spark, "reverse")
    reverse = i.events.withColumn("load", F.col("event_id") % 3).repartitionByRange(6, F.desc("ts"), F.desc("event_id"))
    reverse.sortWithinPartitions(F.desc("ts"), F.desc("event_id")).write.partitionBy("load").parquet(folder)
    target = new_work_dir(i.spark, "out-of-order")
    for load in (2, 0, 1):
        feed = i.spark.read.parquet(folder).filter(F.col("load") == load).drop("load")
        backfill(feed, cdc, TYPE_1, target, f"load-{load}")
    return current_rows(i.spark, target, cdc)


@query(sql.scd1("events", "user_id, event_type", _EVENT_ORDER, _LATEST))
def scd1_composite_key(i: Inputs) -> DataFrame:
    return scd1(i.events, Cdc(("user_id", "event_type"), _SEQUENCE))


_WITH_NULLS = "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS event_type) FROM events"


def _events_with_nulls(i: Inputs) -> DataFrame:
    return i.events.withColumn("event_type", F.when(F.col("event_id") % 3 != 0, F.col("event_type")))


@query(
    "SELECT user_id, "
    + ", ".join(
        f"arg_max({c}, nr) FILTER (WHERE {c} IS NOT NULL) AS {c}"
        for c in ("event_id", "ts", "event_type", "value", "props")
    )
    + f" FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {_EVENT_ORDER}) AS nr FROM ({_WITH_NULLS}) e)"
    " r GROUP BY user_id"
)
def scd1_ignore_nulls(i: Inputs) -> DataFrame:
    return scd1(_events_with_nulls(i), Cdc("user_id", _SEQUENCE, ignore_nulls=True))


@query(sql.scd1("events", "user_id", _EVENT_ORDER, _LATEST, _IS_ERROR))
def scd1_deletes(i: Inputs) -> DataFrame:
    return scd1(i.events, Cdc("user_id", _SEQUENCE, deletes=_IS_ERROR))


@query(
    sql.with_tables(
        {
            "cut": f"SELECT ts, event_id FROM events WHERE {_IS_TRUNCATE} ORDER BY ts DESC, event_id DESC LIMIT 1",
            "later": "SELECT * FROM events e WHERE NOT EXISTS (SELECT 1 FROM cut WHERE (e.ts, e.event_id) <= "
            "(cut.ts, cut.event_id))",
        },
        sql.scd1("later", "user_id", _EVENT_ORDER, _LATEST),
    )
)
def scd1_truncate(i: Inputs) -> DataFrame:
    return scd1(i.events, Cdc("user_id", _SEQUENCE, truncates=_IS_TRUNCATE))


@query(sql.scd1("events", "user_id", _EVENT_ORDER, "user_id, event_type, value"))
def cdc_except_columns(i: Inputs) -> DataFrame:
    return scd1(i.events, Cdc("user_id", _SEQUENCE, except_columns=["ts", "event_id", "props"]))


@query(sql.scd1("events", "user_id", _EVENT_ORDER, "user_id, ts, event_type"))
def cdc_column_list(i: Inputs) -> DataFrame:
    return scd1(i.events, Cdc("user_id", _SEQUENCE, columns=["ts", "event_type"]))


@query(sql.scd2("events", ["user_id"], ["ts", "event_id"], ["event_type"]))
def scd2_history(i: Inputs) -> DataFrame:
    return scd2(i.events, Cdc("user_id", _SEQUENCE, columns=["event_type"]))


@query(sql.scd2("events", ["user_id"], ["ts", "event_id"], ["event_type"], deletes=_IS_ERROR))
def scd2_deletes(i: Inputs) -> DataFrame:
    return scd2(i.events, Cdc("user_id", _SEQUENCE, columns=["event_type"], deletes=_IS_ERROR))


_IN_PLACE = ["event_id", "ts", "value", "props"]


@query(sql.scd2("events", ["user_id"], ["ts", "event_id"], ["event_type"], _IN_PLACE))
def scd2_track_subset(i: Inputs) -> DataFrame:
    return scd2(i.events, Cdc("user_id", _SEQUENCE, track=["event_type"]))


@query(sql.scd2("events", ["user_id"], ["ts", "event_id"], ["event_type"], _IN_PLACE))
def scd2_track_except(i: Inputs) -> DataFrame:
    return scd2(i.events, Cdc("user_id", _SEQUENCE, track_except=["value", "props"]))


_FILLED = f"""SELECT * REPLACE (last_value(event_type IGNORE NULLS) OVER
 (PARTITION BY user_id ORDER BY {_EVENT_ORDER} ROWS UNBOUNDED PRECEDING) AS event_type) FROM ({_WITH_NULLS}) e"""


@query(sql.with_tables({"filled": _FILLED}, sql.scd2("filled", ["user_id"], ["ts", "event_id"], ["event_type"])))
def scd2_ignore_nulls(i: Inputs) -> DataFrame:
    feed = _events_with_nulls(i)
    return scd2(feed, Cdc("user_id", _SEQUENCE, columns=["event_type"], ignore_nulls=True))


# The same history with every key above the mean number of events cut into slices, so
# that the way hot keys take is checked on the whole table as well.
@query(sql.scd2("events", ["user_id"], ["ts", "event_id"], ["event_type"], _IN_PLACE))
def scd2_hot_keys(i: Inputs) -> DataFrame:
    mean = i.events.groupBy("user_id").count().agg(F.avg("count")).first()[0]
    return scd2(i.events, Cdc("user_id", _SEQUENCE, track=["event_type"], hot_rows=int(mean)))


# --- users ------------------------------------------------------------------


@query(sql.users("SELECT user_id, email, name, user_type FROM users_raw"))
def sample_users(i: Inputs) -> DataFrame:
    return users.sample_users(i.users_raw)


@query(
    sql.users(
        "SELECT user_type, count(user_id) AS total_count, count(*) FILTER (WHERE regexp_matches(email, "
        f"'{fixed.EMAIL_STRICT}')) AS count_valid_emails FROM users_raw GROUP BY user_type"
    )
)
def users_by_type(i: Inputs) -> DataFrame:
    return users.users_by_type(users.sample_users(i.users_raw))


@query(
    sql.users(
        "SELECT 'sample_users' AS dataset, count(*) AS n FROM users_raw UNION ALL "
        "SELECT 'users_by_type', count(DISTINCT user_type) FROM users_raw"
    )
)
def named_datasets(i: Inputs) -> DataFrame:
    """Datasets under the names of the functions that define them, each over the one before."""
    df, sizes = i.users_raw, []
    for name, dataset in named(users.sample_users, users.users_by_type).items():
        df = dataset(df)
        sizes.append(df.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("n")))
    return reduce(DataFrame.unionAll, sizes)


# --- streaming --------------------------------------------------------------

_QUARANTINE = (
    "SELECT *, concat_ws(',', "
    + ", ".join(f"CASE WHEN NOT coalesce({p}, false) THEN '{n}' END" for n, _, p in sql.ACCOUNT_RULES)
    + f") AS failed FROM accounts_clean WHERE NOT coalesce({sql.passes(sql.ACCOUNT_RULES)}, false)"
)


def _csv_folder(df: DataFrame, label: str) -> str:
    path = new_work_dir(df.sparkSession, label)
    writer = df.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    writer.csv(path)
    return path


def _parquet_folder(df: DataFrame, label: str, files: int) -> str:
    path = new_work_dir(df.sparkSession, label)
    df.repartition(files).write.parquet(path)
    return path


def _event_stream(i: Inputs, max_files: int | None = None) -> DataFrame:
    return stream_parquet(i.spark, i.folder, i.events.schema, glob="events.parquet", max_files=max_files)


def _event_stream_in_batches(i: Inputs) -> DataFrame:
    """The events spread over four files, one per micro-batch, in no order of time."""
    folder = _parquet_folder(i.events, "events", 4)
    return stream_parquet(i.spark, folder, i.events.schema, max_files=1)


def _append_and_read(df: DataFrame, label: str) -> DataFrame:
    spark = df.sparkSession
    root = new_work_dir(spark, label)
    finish(write_stream(df, path=f"{root}/data", checkpoint=f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/data")


@query(sql.bank("SELECT * FROM customers_raw"))
def stream_ingest_customers(i: Inputs) -> DataFrame:
    folder = _csv_folder(i.customers_raw, "customers_csv")
    return _append_and_read(stream_csv(i.spark, folder, fixed.CUSTOMERS_SCHEMA), "landing_customers")


@query(sql.bank("SELECT * FROM accounts_raw"))
def stream_ingest_accounts(i: Inputs) -> DataFrame:
    folder = _csv_folder(i.accounts_raw, "accounts_csv")
    return _append_and_read(stream_csv(i.spark, folder, fixed.ACCOUNTS_SCHEMA), "landing_accounts")


@query(sql.bank("SELECT * FROM customers_raw"))
def csv_schema_on_read(i: Inputs) -> DataFrame:
    return read_csv(i.spark, _csv_folder(i.customers_raw, "customers_csv"), fixed.CUSTOMERS_SCHEMA)


@query(sql.bank("SELECT customer_id, true AS has_file, true AS has_time FROM customers_raw"))
def csv_audit_columns(i: Inputs) -> DataFrame:
    landed = with_audit_columns(
        read_csv(i.spark, _csv_folder(i.customers_raw, "customers_csv"), fixed.CUSTOMERS_SCHEMA)
    )
    return landed.select(
        "customer_id",
        F.col("source_file").endswith(".csv").alias("has_file"),
        F.col("ingested_at").isNotNull().alias("has_time"),
    )


def _event_table(i: Inputs) -> str:
    """A table holding the events, filled by a streaming query."""
    schema = f"terrace_{uuid.uuid4().hex}"
    root = new_work_dir(i.spark, "schema")
    i.spark.sql(f"CREATE DATABASE {schema} LOCATION '{root}/tables'")
    name = f"{schema}.events"
    finish(write_stream(_event_stream(i), table=name, checkpoint=f"{root}/checkpoint", name="events_append"))
    return name


@query("SELECT * FROM events")
def stream_append_table(i: Inputs) -> DataFrame:
    return scan_table(i.spark, _event_table(i))


@query("SELECT * FROM events")
def stream_table_scan(i: Inputs) -> DataFrame:
    return _append_and_read(stream_table(i.spark, _event_table(i)), "events_copy")


@query(sql.sales("SELECT * EXCLUDE (feed) FROM sales_raw"))
def stream_append_flows(i: Inputs) -> DataFrame:
    flows = [
        stream_parquet(i.spark, _parquet_folder(feed, "feed", 2), feed.schema, max_files=1) for feed in _feeds(i)
    ]
    return _append_and_read(append_flows(*flows), "sales_stg")


@query(sql.bank(sql.totals("joined", sql.GOLD_KEYS)))
def stream_bank_chain(i: Inputs) -> DataFrame:
    """Files to gold: every hop a streaming query, gold over the stored silver tables."""
    layers = runs.run_bank(
        i.spark,
        _csv_folder(i.customers_raw, "customers_csv"),
        _csv_folder(i.accounts_raw, "accounts_csv"),
        new_work_dir(i.spark, "bank"),
        as_of=AS_OF,
        money=CENTS,
    )
    return layers.read("gold_cust_acc_trans_agg")


@query(sql.bank(sql.totals("joined", sql.GOLD_KEYS)))
def stream_bank_deliveries(i: Inputs) -> DataFrame:
    """The chain over two deliveries: the second brings gold up to date for the customers it touches."""
    root = new_work_dir(i.spark, "bank")
    customers, accounts = f"{root}/customers", f"{root}/accounts"
    for half in (0, 1):
        for raw, folder, key in ((i.customers_raw, customers, "customer_id"), (i.accounts_raw, accounts, "account_id")):
            writer = raw.filter(F.col(key) % 2 == half).write.mode("append")
            writer.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(folder)
        layers = runs.run_bank(i.spark, customers, accounts, f"{root}/layers", as_of=AS_OF, money=CENTS)
    return layers.read("gold_cust_acc_trans_agg")


@query(sql.bank(sql.report("accounts_clean", sql.ACCOUNT_RULES)))
def stream_quality_report(i: Inputs) -> DataFrame:
    """Rule counts of a stream over all its micro-batches."""
    raw = i.accounts_raw
    cleaned = bank.clean_accounts(
        stream_parquet(i.spark, _parquet_folder(raw, "accounts", 3), raw.schema, max_files=1)
    )
    root = new_work_dir(i.spark, "rules")
    finish(count_rules(cleaned, bank.account_rules(), path=f"{root}/counts", checkpoint=f"{root}/checkpoint"))
    return rule_totals(i.spark, f"{root}/counts")


def _checked_accounts(i: Inputs) -> str:
    """The accounts as a stream of three batches with the account rules, stored."""
    raw = i.accounts_raw
    cleaned = bank.clean_accounts(
        stream_parquet(i.spark, _parquet_folder(raw, "accounts", 3), raw.schema, max_files=1)
    )
    root = new_work_dir(i.spark, "checked")
    finish(write_checked(cleaned, bank.account_rules(), path=f"{root}/table", checkpoint=f"{root}/checkpoint"))
    return f"{root}/table"


@query(sql.bank("SELECT * FROM bronze_accounts"))
def stream_checked_rows(i: Inputs) -> DataFrame:
    """Rows that pass, stored by the same pass that counts and sets aside."""
    return read_checked(i.spark, _checked_accounts(i))


@query(sql.bank(_QUARANTINE))
def stream_quarantine(i: Inputs) -> DataFrame:
    """Rows of a stream that failed, with the rules they failed."""
    failing = quarantined(i.spark, _checked_accounts(i))
    return failing.withColumn("failed", F.concat_ws(",", "failed_rules")).drop("failed_rules")


@query(sql.bank(sql.report("accounts_clean", sql.ACCOUNT_RULES)))
def stream_checked_counts(i: Inputs) -> DataFrame:
    return rule_totals(i.spark, _checked_accounts(i))


_BROKEN = "txn_id % 50 = 7"


@query(
    sql.bank(
        f"SELECT account_id, txn_id, CASE WHEN NOT coalesce({_BROKEN}, false) THEN txn_date END AS txn_date, "
        f"CASE WHEN {_BROKEN} THEN concat_ws(',', account_id, customer_id, account_type, txn_id) END AS line, "
        f"CASE WHEN {_BROKEN} THEN 'well_formed,valid_txn_date' || CASE WHEN txn_channel IS NULL THEN ',valid_txn_channel' ELSE '' END "
        f"ELSE '' END AS failed FROM accounts_raw WHERE {_BROKEN} OR coalesce({sql.passes(sql.ACCOUNT_RULES)}, false)"
    )
)
def csv_malformed_rows(i: Inputs) -> DataFrame:
    """A folder of CSV files in which every 50th date is none: what passes, and what is set aside with its line."""
    broken = F.when(F.expr(_BROKEN), F.lit("30th of June")).otherwise(F.col("txn_date").cast("string"))
    folder = _csv_folder(i.accounts_raw.withColumn("txn_date", broken), "broken_csv")
    landed = stream_csv(i.spark, folder, fixed.ACCOUNTS_SCHEMA, malformed="line")
    root = new_work_dir(i.spark, "broken")
    finish(write_checked(landed, bank.account_rules(), path=f"{root}/table", checkpoint=f"{root}/checkpoint", malformed="line"))
    columns = ["account_id", "txn_id", "txn_date"]
    kept = read_checked(i.spark, f"{root}/table").select(*columns, F.lit(None).cast("string").alias("line"), F.lit("").alias("failed"))
    cells = F.split("line", ",")
    line = F.concat_ws(",", *[cells[k] for k in (0, 1, 2, 4)])
    failing = quarantined(i.spark, f"{root}/table").filter("line IS NOT NULL")
    return kept.unionByName(failing.select(*columns, line.alias("line"), F.concat_ws(",", "failed_rules").alias("failed")))


@query(sql.sales(sql.business("as_of")))
def stream_sales_chain(i: Inputs) -> DataFrame:
    def stream(df: DataFrame, label: str) -> DataFrame:
        return stream_parquet(i.spark, _parquet_folder(df, label, 2), df.schema, max_files=1)

    layers = runs.run_sales(
        i.spark,
        stream(i.customers_src, "customers"),
        stream(i.products_src, "products"),
        [stream(feed, "feed") for feed in _feeds(i)],
        new_work_dir(i.spark, "sales"),
        mode=sales.AS_OF,
        money=CENTS,
    )
    return layers.read("business_sales")


def _captured(i: Inputs, cdc: Cdc, kind: int) -> str:
    root = new_work_dir(i.spark, "capture")
    stream = _event_stream_in_batches(i)
    finish(stream_scd(stream, cdc, kind, f"{root}/table", f"{root}/checkpoint"))
    return f"{root}/table"


@query(sql.scd1("events", "user_id", _EVENT_ORDER, _LATEST, _IS_ERROR))
def stream_scd1(i: Inputs) -> DataFrame:
    cdc = Cdc("user_id", _SEQUENCE, deletes=_IS_ERROR)
    return current_rows(i.spark, _captured(i, cdc, TYPE_1), cdc)


@query(sql.scd2("events", ["user_id"], ["ts", "event_id"], ["event_type"], _IN_PLACE, _IS_ERROR))
def stream_scd2(i: Inputs) -> DataFrame:
    cdc = Cdc("user_id", _SEQUENCE, track=["event_type"], deletes=_IS_ERROR)
    return history(i.spark, _captured(i, cdc, TYPE_2), cdc)


@query(sql.scd1("events", "user_id", _EVENT_ORDER, _LATEST))
def stream_scd1_after_backfill(i: Inputs) -> DataFrame:
    """Errors and sign-ups come as a backfill, all other events from the stream."""
    cdc = Cdc("user_id", _SEQUENCE)
    root = new_work_dir(i.spark, "capture")
    early = F.col("event_type").isin("error", "signup")
    backfill(i.events.filter(early), cdc, TYPE_1, f"{root}/table")
    rest = _event_stream_in_batches(i).filter(~early)
    finish(stream_scd(rest, cdc, TYPE_1, f"{root}/table", f"{root}/checkpoint"))
    return current_rows(i.spark, f"{root}/table", cdc)


@query("SELECT 'users_flow' AS flow, count(DISTINCT user_id) AS n FROM events")
def stream_flow_name(i: Inputs) -> DataFrame:
    """A flow with a name, which its query carries."""
    cdc, root = Cdc("user_id", _SEQUENCE), new_work_dir(i.spark, "named-flow")
    flow = stream_scd(_event_stream(i), cdc, TYPE_1, f"{root}/table", f"{root}/checkpoint", name="users_flow")
    finish(flow)
    return current_rows(i.spark, f"{root}/table", cdc).agg(F.lit(flow.name).alias("flow"), F.count(F.lit(1)).alias("n"))


@query(sql.scd2("events", ["user_id"], ["ts", "event_id"], ["event_type"], _IN_PLACE, _IS_ERROR))
def stream_replay_after_failure(i: Inputs) -> DataFrame:
    """The third of four batches fails when all it writes is there but for its end; the next run repeats it."""
    cdc = Cdc("user_id", _SEQUENCE, track=["event_type"], deletes=_IS_ERROR)
    root = new_work_dir(i.spark, "replay")
    stream = _event_stream_in_batches(i)

    def failing(table: KeptTable, load: Load, commit: Callable = KeptTable.commit) -> None:
        if load.number == 2:
            raise OSError("lost before the end of the batch")
        commit(table, load)

    with mock.patch.object(KeptTable, "commit", failing), suppress(StreamingQueryException):
        finish(stream_scd(stream, cdc, TYPE_2, f"{root}/table", f"{root}/checkpoint"))
    finish(stream_scd(stream, cdc, TYPE_2, f"{root}/table", f"{root}/checkpoint"))
    return history(i.spark, f"{root}/table", cdc)


@query(
    sql.with_tables(
        {"v": sql.scd2("events", ["user_id"], ["ts", "event_id"], ["event_type"])},
        "SELECT 'declared' AS moment, 0 AS n, 0 AS n_open, 'versions of users' AS note UNION ALL "
        "SELECT 'filled', count(*), count(*) FILTER (is_current), 'versions of users' FROM v",
    )
)
def declared_target(i: Inputs) -> DataFrame:
    """A type 2 target is declared with columns and comment, read while it is empty, then filled and read again."""
    cdc = Cdc("user_id", _SEQUENCE, columns=["event_type"])
    target = new_work_dir(i.spark, "declared")
    declare(i.spark, target, i.events.schema, cdc, TYPE_2, "versions of users")

    def now(moment: str) -> DataFrame:
        return history(i.spark, target, cdc).agg(
            F.lit(moment).alias("moment"),
            F.count(F.lit(1)).alias("n"),
            F.count_if("is_current").alias("n_open"),
            F.lit(change_tables.comment_of(i.spark, target)).alias("note"),
        )

    before = now("declared")
    backfill(i.events, cdc, TYPE_2, target)
    return before.unionByName(now("filled"))


@query(
    sql.scd1(
        "(SELECT user_id, ts, event_id, event_type, CASE WHEN event_id % 2 = 1 THEN value END AS value FROM events) e",
        "user_id",
        _EVENT_ORDER,
        _LATEST,
    )
)
def scd1_new_column(i: Inputs) -> DataFrame:
    """Two flows into one table, of which the second brings a new column."""
    cdc = Cdc("user_id", _SEQUENCE)
    target = new_work_dir(i.spark, "new-column")
    columns = ["user_id", "ts", "event_id", "event_type"]
    backfill(i.events.filter("event_id % 2 = 0").select(*columns), cdc, TYPE_1, target, "narrow")
    backfill(i.events.filter("event_id % 2 = 1").select(*columns, "value"), cdc, TYPE_1, target, "wide")
    return current_rows(i.spark, target, cdc)


# --- extensions -------------------------------------------------------------


@query(sql.bank(_QUARANTINE))
def quarantine_rows(i: Inputs) -> DataFrame:
    failing = quarantine(bank.clean_accounts(i.accounts_raw), bank.account_rules())
    return failing.withColumn("failed", F.concat_ws(",", "failed_rules")).drop("failed_rules")


@query(
    sql.sales(
        "SELECT *, sha256(concat(len(customer_id::VARCHAR), ':', customer_id, len(valid_from::VARCHAR), ':', valid_from)) "
        "AS surrogate_key FROM dim_customers"
    )
)
def dim_surrogate_keys(i: Inputs) -> DataFrame:
    return with_surrogate_key(sales.dim_customers(_customers_view(i)), ["customer_id"])


_KEY_SQL = "sha256(concat(len(f.{k}::VARCHAR), ':', f.{k}, coalesce(len({d}.valid_from::VARCHAR) || ':' || {d}.valid_from, '~')))"


@query(
    sql.sales(
        "SELECT f.sales_id, f.total_amount, "
        + ", ".join(
            f"{_KEY_SQL.format(k=k, d=d)} AS {k}_key, {d}.valid_from IS NULL AS {k}_inferred"
            for k, d in (("customer_id", "c"), ("product_id", "p"))
        )
        + " FROM fact_sales f "
        + " ".join(
            f"LEFT JOIN {t} {d} ON f.{k} = {d}.{k} AND f.sale_timestamp >= {d}.valid_from "
            f"AND ({d}.valid_to IS NULL OR f.sale_timestamp < {d}.valid_to)"
            for k, d, t in (("customer_id", "c", "dim_customers"), ("product_id", "p", "dim_products"))
        )
    )
)
def fact_surrogate_keys(i: Inputs) -> DataFrame:
    """Sales with the keys of the versions valid at their time; those before the first version keep an inferred member."""
    fact, customers, products = _star(i)
    for dim, key in ((customers, "customer_id"), (products, "product_id")):
        slim = dim.select(key, "valid_from", "valid_to")
        fact = with_dimension_key(fact, slim, key, "sale_timestamp", f"{key}_key", inferred=f"{key}_inferred")
    return fact.select("sales_id", "total_amount", *[f"{k}_{x}" for k in ("customer_id", "product_id") for x in ("key", "inferred")])


@query(
    "SELECT event_id, sha256(concat(len(user_id::VARCHAR), ':', user_id, len(moment::VARCHAR), ':', moment, "
    "len(event_type), ':', event_type)) AS surrogate_key "
    "FROM (SELECT *, epoch_us(ts) + event_id % 7 AS moment FROM events)"
)
def surrogate_keys_of_microseconds(i: Inputs) -> DataFrame:
    """Versions of one user may be a microsecond apart, or share their start."""
    at = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.col("event_id") % 7)
    return with_surrogate_key(i.events.withColumn("valid_from", at), ["user_id"], further=["event_type"]).select(
        "event_id", "surrogate_key"
    )


def _events_again(i: Inputs) -> DataFrame:
    """Events come in order of time, a quarter of the span in each micro-batch, and again: at
    once, in the next batch if they are within the delay, and, if long past it, in the last."""
    second = F.expr("unix_timestamp(ts)")
    first, last = i.events.agg(F.min(second), F.max(second)).first()
    quarter = F.least(F.floor((second - first) * 4 / (last - first + 1)), F.lit(3))
    events = i.events.withColumn("quarter", quarter.cast("int"))
    newest = {r.quarter: r.newest for r in events.groupBy("quarter").agg(F.max(second).alias("newest")).collect()}
    folder = new_work_dir(i.spark, "events_again")
    for n in sorted(newest):
        own = F.col("quarter") == n
        recent = (F.col("quarter") == n - 1) & (second > newest.get(n - 1, 0) - 50 * 60)
        late = (F.col("quarter") == 0) & F.lit(n == 3)
        copies = F.when(own, 2).when(recent | late, 1).otherwise(0)
        batch = events.filter(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        batch.select(*i.events.columns).coalesce(1).write.mode("append").parquet(folder)
    return stream_parquet(i.spark, folder, i.events.schema, max_files=1)


@query("SELECT event_id, user_id, event_type, value, props, ts FROM events")
def stream_dedup_watermark(i: Inputs) -> DataFrame:
    """Every event once, though some come again."""
    once = dedup_within_watermark(_events_again(i), ["event_id"], "ts", "1 hour")
    return _append_and_read(once, "events_once").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    """
WITH s AS (SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS second FROM events),
q AS (
  SELECT *, least(((second - (SELECT min(second) FROM s)) * 4) // ((SELECT max(second) FROM s) - (SELECT min(second) FROM s) + 1), 3) AS quarter
  FROM s),
n AS (SELECT quarter, max(second) AS newest FROM q GROUP BY quarter)
SELECT event_id, 2 + CASE WHEN quarter < 3 AND second > newest - 3000 THEN 1 ELSE 0 END AS on_time,
  CASE WHEN quarter = 0 THEN 1 ELSE 0 END AS late, 1 AS kept
FROM q JOIN n USING (quarter)
"""
)
def stream_late_rows(i: Inputs) -> DataFrame:
    """How often each event came on time and late, and was kept: late rows are set aside, not lost."""
    root = new_work_dir(i.spark, "late")
    path = f"{root}/table"
    finish(write_on_time(_events_again(i), "ts", "1 hour", path=path, checkpoint=f"{root}/checkpoint"))
    once = dedup_within_watermark(stream_checked(i.spark, path), ["event_id"], "ts", "1 hour")
    counts = [
        (read_checked(i.spark, path), "on_time"),
        (quarantined(i.spark, path), "late"),
        (_append_and_read(once, "events_once"), "kept"),
    ]
    names = [name for _, name in counts]
    ones = [df.select("event_id", *[F.lit(int(n == name)).alias(n) for n in names]) for df, name in counts]
    return reduce(DataFrame.unionAll, ones).groupBy("event_id").agg(*[F.sum(n).alias(n) for n in names])
