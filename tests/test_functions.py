import datetime as dt

import pytest
from pyspark.sql import functions as F

from terrace import fixed_values as fixed
from terrace import functions as fn
from terrace.plans import bank, sales, users
from tests.helpers import rows


def column(spark, values, type_="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {type_}")


def apply(df, expr):
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_transaction_type_and_direction(spark):
    raw = spark.createDataFrame(
        [(i, t) for i, t in enumerate(["debit", "DEBITT", "credit", None, "x"])], "txn_id int, txn_type string"
    ).withColumns({"account_type": F.lit("a"), "txn_channel": F.lit("atm"), "txn_date": F.lit(dt.date(2024, 5, 6))})
    silver = bank.silver_accounts_transactions_transformed(bank.clean_accounts(raw))
    assert rows(silver, "txn_id", "txn_type", "txn_direction") == [
        (0, "UNKNOWN", "IN"),
        (1, "DEBIT", "OUT"),
        (2, "CREDIT", "IN"),
        (3, "UNKNOWN", "IN"),
        (4, "UNKNOWN", "IN"),
    ]
    repaired = bank.clean_accounts(raw, fixed.TXN_TYPE_REPAIRED)
    assert rows(repaired, "txn_id", "txn_type")[0] == (0, "DEBIT")
    assert rows(silver.limit(1), "txn_year", "txn_month", "txn_day", "channel_type") == [(2024, 5, 6, "PHYSICAL")]


def test_channel_type_of_missing_channel_is_digital(spark):
    raw = spark.createDataFrame(
        [("BRANCH",), ("ONLINE",), (None,)], "txn_channel string"
    ).withColumns({"txn_type": F.lit("x"), "txn_date": F.current_date()})
    silver = bank.silver_accounts_transactions_transformed(raw)
    assert rows(silver, "txn_channel", "channel_type") == [
        (None, "DIGITAL"),
        ("BRANCH", "PHYSICAL"),
        ("ONLINE", "DIGITAL"),
    ]


EMAILS = ["a@b.com", "a@bxcom", "a@bcom", "a@b", "A@b.c", "a@b.com\n", None]


@pytest.mark.parametrize(
    ("strict", "kept"),
    [(False, {"a@b.com", "a@bxcom", "a@bcom", "a@b.com\n"}), (True, {"a@b.com", "a@b.com\n"})],
)
def test_email_rule(spark, strict, kept):
    df = column(spark, EMAILS).filter(fn.email_predicate("c", strict=strict))
    assert {r.c for r in df.collect()} == kept


def test_is_valid_email_keeps_null(spark):
    assert apply(column(spark, ["a@b.com", "a@bcom", None]), fn.is_valid_email(F.col("c"))) == [True, False, None]


def test_phone(spark):
    df = column(spark, ["+44 7000-000000", "07000000000", " +447000000000 ", None])
    cleaned = fn.clean_phone(F.col("c"))
    assert apply(df, cleaned) == ["+447000000000", "07000000000", "+447000000000", None]
    assert apply(df, fn.is_uk_phone(cleaned)) == [True, False, True, None]


def test_gender_and_status(spark):
    gender = fn.map_values(F.col("c"), fixed.GENDER, fixed.GENDER_DEFAULT)
    assert apply(column(spark, [None, "M", "F", "X", "m"]), gender) == ["Unknown", "MALE", "FEMALE", "Unknown", "Unknown"]
    status = F.upper(fn.blank_to(F.col("c"), fixed.STATUS_DEFAULT))
    assert apply(column(spark, [None, "  ", "", " dormant "]), status) == ["UNKNOWN", "UNKNOWN", "UNKNOWN", " DORMANT "]


def test_preferred_channel_is_not_trimmed(spark):
    df = spark.createDataFrame(
        [("mobile ",), ("mobile",), (None,)], "preferred_channel string"
    ).withColumns(
        {
            **{c: F.lit("x") for c in ("name", "email", "occupation", "city", "gender", "status")},
            "phone_number": F.lit("+447000000000"),
            "income_range": F.lit("very high"),
            "risk_segment": F.lit("low"),
        }
    )
    assert rows(bank.known_customers(bank.clean_customers(df)), "preferred_channel") == [("MOBILE",)]


@pytest.mark.parametrize(("as_of", "age"), [("2026-02-28", 26), ("2026-02-27", 25), ("2000-02-29", 0)])
def test_age_of_a_leap_day_birth(spark, as_of, age):
    df = column(spark, [dt.date(2000, 2, 29)], "date")
    assert apply(df, fn.age_years(F.col("c"), as_of)) == [age]


def test_dates_default_to_today_and_accept_columns(spark):
    df = column(spark, [dt.date(2000, 1, 1), None], "date")
    assert apply(df, fn.tenure_days(F.col("c"), dt.date(2000, 1, 11))) == [10, None]
    assert apply(df, fn.tenure_days(F.col("c"), F.date_add(F.col("c"), 3))) == [3, None]
    assert apply(df, fn.age_years(F.col("c")) >= 25) == [True, None]


def test_birth_date_flag(spark):
    tomorrow = dt.date(2024, 1, 2)
    df = column(spark, [dt.date(1899, 12, 31), None, tomorrow, dt.date(1900, 1, 1)], "date")
    assert apply(df, fn.out_of_range(F.col("c"), "2024-01-01")) == [True, None, True, False]


def test_price_cast(spark):
    df = spark.createDataFrame([(2.9,), (-2.9,)], "price double")
    assert rows(sales.products_enr_view(df)) == [(-2,), (2,)]
    text = spark.createDataFrame([("2.9",), ("abc",)], "price string")
    assert rows(sales.products_enr_view(text, null_if_malformed=True)) == [(None,), (None,)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sales.products_enr_view(text).collect()


def test_users_by_type(spark):
    df = spark.createDataFrame(
        [(1, "a@b.com", "n", "x", 0), (2, "bad", "n", "x", 0), (None, None, "n", "x", 0), (3, None, "n", None, 0)],
        "user_id long, email string, name string, user_type string, other int",
    )
    assert rows(users.users_by_type(users.sample_users(df))) == [(None, 1, 0), ("x", 2, 1)]
