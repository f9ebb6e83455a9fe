"""Registered queries against their SQL answers, and known counts of the derived data."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check
from terrace.catalog import inputs, queries
from terrace.operators import CENTS, Cdc, scd1, scd2
from terrace.plans import bank, sales

FOLDER = "/root/testdata/sf0.001"
GOLDEN = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    return check.database(FOLDER)


@pytest.mark.parametrize("name", queries.queries())
def test_query_equals_its_answer(spark, db, name):
    _, differences = check.compare(spark, db, FOLDER, name)
    assert not differences


def test_every_query_has_an_answer():
    assert queries.queries().keys() == queries.oracle_sql().keys()


def test_all_of_the_catalog_is_registered():
    assert queries.queries().keys() <= entry.queries().keys()
    assert queries.oracle_sql().keys() <= entry.oracle_sql().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry_is_the_flagship(spark):
    assert entry.entry(spark).columns[:2] == ["customer_id", "name"]


# --- known counts -----------------------------------------------------------


@pytest.fixture(scope="module")
def golden(spark):
    return inputs.Inputs(spark, GOLDEN)


def test_bank_counts(golden):
    loose = bank.bronze_customers_clean(golden.customers_raw)
    assert loose.count() == 874
    assert bank.bronze_customers_clean(golden.customers_raw, strict_email=True).count() == 760
    accounts = bank.bronze_accounts_clean(golden.accounts_raw)
    kinds = {r.txn_type: r["count"] for r in accounts.groupBy("txn_type").count().collect()}
    assert kinds == {"CREDIT": 4951, "DEBIT": 2475, "UNKNOWN": 4950}
    customers = bank.silver_customers_transformed(loose, "2024-01-01")
    transactions = bank.silver_accounts_transactions_transformed(accounts)
    assert bank.gold_cust_acc_trns_mv(customers, transactions).count() == 7305
    totals = bank.gold_totals(customers, transactions, CENTS)
    assert totals.count() == 873
    sums = totals.agg(F.sum("total_credits"), F.sum("total_debits")).first()
    assert [round(s) for s in sums] == [732559486, 363037764]


def test_sales_counts(golden, spark):
    """The narrow product range these counts were recorded for: product ids below 200."""
    tables = {n: golden.table(n) for n in inputs.TABLES}
    text = inputs.SALES_RAW.replace("(SELECT count(*) FROM {part})", "200")
    raw = spark.sql(text, orders=tables["orders"], customer=tables["customer"])
    feeds = [raw.filter(F.col("feed") == side).drop("feed") for side in ("east", "west")]
    products = golden.products_src.filter("product_id < 200")
    fact = sales.fact_sales(sales.sales_enr_view(sales.sales_stg(*feeds)))
    customers = sales.dim_customers(sales.customers_enr_view(golden.customers_src))
    items = sales.dim_products(sales.products_enr_view(products))
    assert (fact.count(), customers.count(), items.count()) == (14854, 2500, 344)
    rows = {m: sales.star_join(fact, customers, items, m).count() for m in (sales.NAIVE, sales.CURRENT, sales.AS_OF)}
    assert rows == {sales.NAIVE: 42507, sales.CURRENT: 14854, sales.AS_OF: 12936}
    groups = {m: sales.business_sales(fact, customers, items, m, CENTS).count() for m in rows}
    assert groups == {sales.NAIVE: 60, sales.CURRENT: 30, sales.AS_OF: 60}


def test_event_counts(golden):
    events, sequence = golden.events, ("ts", "event_id")
    assert scd1(events, Cdc("user_id", sequence)).count() == 150
    history = scd2(events, Cdc("user_id", sequence, track=["event_type"]))
    assert (history.count(), history.filter("is_current").count()) == (8016, 150)
    assert scd2(events, Cdc("user_id", sequence, columns=["event_type"], deletes="event_type = 'error'")).count() == 6399
