"""Bank datasets: customers and account transactions, bronze to gold.

Every function takes and returns a DataFrame. Those up to silver are stateless and
shuffle nothing, so they work on a batch frame and on a stream alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from terrace import fixed_values as fixed
from terrace import functions as fn
from terrace.functions.dates import AsOf
from terrace.operators import cdc
from terrace.operators.cdc import Cdc
from terrace.operators.joins import inner_using
from terrace.operators.quality import DROP, WARN, Rule, expect, rules
from terrace.operators.totals import joined_transaction_totals, transaction_totals


def customer_rules(strict_email: bool = False) -> list[Rule]:
    drops = dict(fixed.CUSTOMER_DROP_RULES)
    if strict_email:
        drops["valid_email"] = fn.email_predicate(strict=True)
    return rules(drops, DROP) + rules(fixed.CUSTOMER_WARN_RULES, WARN)


def account_rules() -> list[Rule]:
    return rules(fixed.ACCOUNT_DROP_RULES, DROP)


def clean_customers(raw: DataFrame) -> DataFrame:
    """Normalise customer text; no row is removed."""
    return raw.withColumns(
        {
            **fn.upper_columns(
                ["name", "occupation", "city", "income_range", "risk_segment", "preferred_channel"]
            ),
            "email": F.lower("email"),
            "gender": fn.map_values(F.col("gender"), fixed.GENDER, fixed.GENDER_DEFAULT),
            "status": F.upper(fn.blank_to(F.col("status"), fixed.STATUS_DEFAULT)),
            "phone_number": fn.clean_phone(F.col("phone_number")),
        }
    )


def is_known_customer() -> Column:
    """A UK phone number and known channel, income and risk values."""
    return (
        fn.is_uk_phone(F.col("phone_number"))
        & F.col("preferred_channel").isin(fixed.PREFERRED_CHANNELS)
        & F.col("income_range").isin(fixed.INCOME_RANGES)
        & F.col("risk_segment").isin(fixed.RISK_SEGMENTS)
    )


def known_customers(cleaned: DataFrame) -> DataFrame:
    """Keep customers with a UK phone number and known channel, income and risk values."""
    return cleaned.filter(is_known_customer())


def bronze_customers_clean(
    landing: DataFrame, *, strict_email: bool = False, observe: Observation | str | None = None
) -> DataFrame:
    """Cleaned customers that pass the customer rules."""
    return expect(known_customers(clean_customers(landing)), customer_rules(strict_email), observe)


def clean_accounts(raw: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Normalise transaction text; ``mapping`` maps upper-cased transaction types."""
    mapping = fixed.TXN_TYPE if mapping is None else mapping
    return raw.withColumns(
        {
            **fn.upper_columns(["account_type", "txn_channel"]),
            "txn_type": fn.map_values(F.upper("txn_type"), mapping, fixed.TXN_TYPE_DEFAULT),
        }
    )


def bronze_accounts_clean(
    landing: DataFrame,
    *,
    mapping: dict[str, str] | None = None,
    observe: Observation | str | None = None,
) -> DataFrame:
    """Cleaned transactions that pass the account rules."""
    return expect(clean_accounts(landing, mapping), account_rules(), observe)


def silver_customers_transformed(bronze: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Customers with age, tenure, birth-date flag and load time."""
    return bronze.withColumns(
        {
            "customer_age": fn.age_years(F.col("dob"), as_of),
            "tenure_days": fn.tenure_days(F.col("join_date"), as_of),
            "dob_out_of_range_flag": fn.out_of_range(F.col("dob"), as_of),
            "transformation_date": F.current_timestamp(),
        }
    )


def silver_customers_transformed_view(silver: DataFrame) -> DataFrame:
    """The silver customers under another name; a view stores nothing, over a stream too."""
    return silver


def silver_accounts_transactions_transformed_view(silver: DataFrame) -> DataFrame:
    """A stored copy of the silver transactions, recomputed in full."""
    return silver


def silver_accounts_transactions_transformed(bronze: DataFrame) -> DataFrame:
    """Transactions with channel type, date parts, direction and load time."""
    return bronze.withColumns(
        {
            "channel_type": F.when(
                F.col("txn_channel").isin(fixed.PHYSICAL_CHANNELS), F.lit("PHYSICAL")
            ).otherwise(F.lit("DIGITAL")),
            **fn.date_parts(F.col("txn_date"), "txn"),
            "txn_direction": F.when(F.col("txn_type") == "DEBIT", F.lit("OUT")).otherwise(F.lit("IN")),
            "acc_transformation_date": F.current_timestamp(),
        }
    )


# All rows of a load share its timestamp: give a further column to tell versions of a
# key within one load apart.

def customers_cdc(*tiebreak: str) -> Cdc:
    return Cdc("customer_id", ("transformation_date", *tiebreak), except_columns=["transformation_date"])


def transactions_cdc(*tiebreak: str) -> Cdc:
    return Cdc("txn_id", ("acc_transformation_date", *tiebreak), except_columns=["acc_transformation_date"])


def silver_customers_transformed_scd1(silver: DataFrame, *tiebreak: str) -> DataFrame:
    """Latest row per customer."""
    return cdc.scd1(silver, customers_cdc(*tiebreak))


def silver_accounts_transactions_transformed_scd2(silver: DataFrame, *tiebreak: str) -> DataFrame:
    """Version history per transaction."""
    return cdc.scd2(silver, transactions_cdc(*tiebreak))


def gold_cust_acc_trns_mv(
    customers: DataFrame, transactions: DataFrame, *, current_only: bool = False, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Customers joined with their transactions.

    A customer delivered twice doubles its transactions; ``current_only`` keeps the
    latest row of each customer first. Rows of one load share their load time:
    ``tiebreak`` names columns that put them in order, which are then left out.
    """
    if current_only:
        latest = Cdc("customer_id", ("transformation_date", *tiebreak), except_columns=list(tiebreak))
        customers = cdc.scd1(customers, latest)
    return inner_using(customers, transactions, "customer_id")


def gold_cust_acc_trans_agg(joined: DataFrame, money: str | None = None) -> DataFrame:
    """Transaction totals per customer over the joined table."""
    return transaction_totals(joined, fixed.GOLD_KEYS, money)


def gold_totals(customers: DataFrame, transactions: DataFrame, money: str | None = None) -> DataFrame:
    """``gold_cust_acc_trans_agg`` of the join, computed without storing the join."""
    return joined_transaction_totals(customers, transactions, "customer_id", fixed.GOLD_KEYS, money)
