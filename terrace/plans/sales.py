"""Sales datasets: staging with rules, enrichment, type 1 and 2 tables, business sales."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from terrace import fixed_values as fixed
from terrace.operators import cdc
from terrace.operators.append import append_flows
from terrace.operators.cdc import Cdc
from terrace.operators.joins import current_versions, effective_date_join
from terrace.operators.quality import DROP, WARN, Rule, expect, rules
from terrace.operators.totals import money_sum

CUSTOMERS = Cdc("customer_id", "last_updated")
PRODUCTS = Cdc("product_id", "last_updated")
SALES = Cdc("sales_id", "sale_timestamp")

NAIVE = "naive"
CURRENT = "current"
AS_OF = "as_of"


def customer_rules() -> list[Rule]:
    return rules(fixed.SALES_CUSTOMER_RULES, WARN)


def product_rules() -> list[Rule]:
    return rules(fixed.SALES_PRODUCT_RULES, WARN)


def sales_rules() -> list[Rule]:
    return rules(fixed.SALES_RULES, DROP)


def customers_stg(source: DataFrame, observe: Observation | str | None = None) -> DataFrame:
    """Customer changes as delivered; rule violations are counted and kept."""
    return expect(source, customer_rules(), observe)


def products_stg(source: DataFrame, observe: Observation | str | None = None) -> DataFrame:
    """Product changes as delivered; rule violations are counted and kept."""
    return expect(source, product_rules(), observe)


def sales_stg(*feeds: DataFrame, observe: Observation | str | None = None) -> DataFrame:
    """Regional feeds in one frame; the rules hold for every feed."""
    return expect(append_flows(*feeds), sales_rules(), observe)


def customers_enr_view(staged: DataFrame) -> DataFrame:
    """Customer changes with upper-case names."""
    return staged.withColumn("customer_name", F.upper("customer_name"))


def products_enr_view(staged: DataFrame, *, null_if_malformed: bool = False) -> DataFrame:
    """Price as INT, truncated toward zero. Text that is no number fails unless asked to be NULL."""
    price = F.col("price").try_cast("int") if null_if_malformed else F.col("price").cast("int")
    return staged.withColumn("price", price)


def sales_enr_view(staged: DataFrame) -> DataFrame:
    """Sales with their total amount."""
    return staged.withColumn("total_amount", F.col("quantity") * F.col("amount"))


def customers_enr(view: DataFrame) -> DataFrame:
    """Current customers."""
    return cdc.scd1(view, CUSTOMERS)


def products_enr(view: DataFrame) -> DataFrame:
    """Current products."""
    return cdc.scd1(view, PRODUCTS)


def sales_enr(view: DataFrame) -> DataFrame:
    """Current sales."""
    return cdc.scd1(view, SALES)


def dim_customers(view: DataFrame) -> DataFrame:
    """Customer dimension with history."""
    return cdc.scd2(view, CUSTOMERS)


def dim_products(view: DataFrame) -> DataFrame:
    """Product dimension with history."""
    return cdc.scd2(view, PRODUCTS)


def fact_sales(view: DataFrame) -> DataFrame:
    """Sales facts: the latest state of each sale."""
    return cdc.scd1(view, SALES)


def star_join(
    fact: DataFrame, customers: DataFrame, products: DataFrame, mode: str = NAIVE, method: str = "auto"
) -> DataFrame:
    """Fact rows with the region and category of their customer and product.

    ``naive``    on the business key alone: every version matches, so history multiplies rows
    ``current``  open versions only
    ``as_of``    the versions valid at the time of the sale
    """
    region = _dimension(customers, "customer_id", "region", mode)
    category = _dimension(products, "product_id", "category", mode)
    if mode == AS_OF:
        with_category = effective_date_join(fact, category, "product_id", "sale_timestamp", method=method)
        return effective_date_join(with_category, region, "customer_id", "sale_timestamp", method=method)
    return fact.join(category, "product_id", "inner").join(region, "customer_id", "inner").select(
        *fact.columns, "region", "category"
    )


def _dimension(dim: DataFrame, key: str, attribute: str, mode: str) -> DataFrame:
    if mode == AS_OF:
        return dim.select(key, attribute, cdc.VALID_FROM, cdc.VALID_TO)
    if mode == CURRENT:
        return current_versions(dim).select(key, attribute)
    if mode == NAIVE:
        return dim.select(key, attribute)
    raise ValueError(f"mode must be '{NAIVE}', '{CURRENT}' or '{AS_OF}', not '{mode}'")


def business_sales(
    fact: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    mode: str = NAIVE,
    money: str | None = None,
    method: str = "auto",
) -> DataFrame:
    """Total sales per region and category, see ``star_join`` for ``mode``."""
    if mode == AS_OF:
        slim = fact.select("customer_id", "product_id", "sale_timestamp", "total_amount")
        total = money_sum(F.col("total_amount"), money)
        return (
            star_join(slim, customers, products, mode, method)
            .groupBy("region", "category")
            .agg(total.cast("double").alias("total_sales"))
        )

    def copies(dim: DataFrame, key: str, attribute: str, name: str) -> DataFrame:
        # Versions that agree on the attribute count as copies of one row: the join
        # then carries a factor instead of repeating every sale once per version.
        one = _dimension(dim, key, attribute, mode).groupBy(key, attribute)
        return one.agg(F.count(F.lit(1)).cast("decimal(10,0)" if money else "double").alias(name))

    amount = F.col("total_amount") if money is None else F.col("total_amount").cast(money)
    per_customer = (
        fact.select("customer_id", "product_id", amount.alias("amount"))
        .join(copies(products, "product_id", "category", "product_copies"), "product_id", "inner")
        # Summed per customer and category before customers join: a customer with a
        # large share of the sales arrives there as one row per category.
        .groupBy("customer_id", "category")
        .agg(F.sum(F.col("amount") * F.col("product_copies")).alias("amount"))
    )
    return (
        per_customer.join(copies(customers, "customer_id", "region", "customer_copies"), "customer_id", "inner")
        .groupBy("region", "category")
        .agg(F.sum(F.col("amount") * F.col("customer_copies")).cast("double").alias("total_sales"))
    )


def top_business_sales(business: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` best region and category pairs, ties in name order."""
    return business.orderBy(F.desc("total_sales"), "region", "category").limit(n)
