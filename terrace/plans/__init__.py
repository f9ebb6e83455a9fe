"""The datasets of the three case studies, by name and in order of dependency."""

from terrace.operators.datasets import named
from terrace.plans import bank, sales, users

BANK = named(
    bank.bronze_customers_clean,
    bank.bronze_accounts_clean,
    bank.silver_customers_transformed,
    bank.silver_customers_transformed_view,
    bank.silver_customers_transformed_scd1,
    bank.silver_accounts_transactions_transformed,
    bank.silver_accounts_transactions_transformed_view,
    bank.silver_accounts_transactions_transformed_scd2,
    bank.gold_cust_acc_trns_mv,
    bank.gold_cust_acc_trans_agg,
)
SALES = named(
    sales.customers_stg,
    sales.products_stg,
    sales.sales_stg,
    sales.customers_enr_view,
    sales.products_enr_view,
    sales.sales_enr_view,
    sales.customers_enr,
    sales.products_enr,
    sales.sales_enr,
    sales.dim_customers,
    sales.dim_products,
    sales.fact_sales,
    sales.business_sales,
)
USERS = named(users.sample_users, users.users_by_type)
