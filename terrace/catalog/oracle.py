"""Reference answers in plain SQL, written independently of the Spark operators."""

from __future__ import annotations

from collections.abc import Sequence

from terrace.catalog import inputs

AS_OF = "2024-01-01"
AS_OF_SQL = f"DATE '{AS_OF}'"


def customers_clean(source: str) -> str:
    return f"""
SELECT customer_id, upper(name) AS name, dob,
 CASE gender WHEN 'M' THEN 'MALE' WHEN 'F' THEN 'FEMALE' ELSE 'Unknown' END AS gender,
 upper(city) AS city, join_date,
 CASE WHEN status IS NULL OR trim(status) = '' THEN 'UNKNOWN' ELSE upper(status) END AS status,
 lower(email) AS email, regexp_replace(phone_number, '[^0-9+]+', '', 'g') AS phone_number,
 upper(preferred_channel) AS preferred_channel, upper(occupation) AS occupation,
 upper(income_range) AS income_range, upper(risk_segment) AS risk_segment
FROM {source}"""


# Spelt out, so that a wrong pattern or list in the library shows.
KNOWN = """regexp_full_match(phone_number, '\\+44\\d{10}')
 AND preferred_channel IN ('ATM', 'BRANCH', 'MOBILE', 'ONLINE')
 AND income_range IN ('HIGH', 'LOW', 'MEDIUM', 'VERY HIGH') AND risk_segment IN ('HIGH', 'LOW', 'MEDIUM')"""
EMAIL_LOOSE = "^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+.[a-zA-Z]{2,}$"


def email_ok(pattern: str) -> str:
    return f"email IS NOT NULL AND regexp_matches(email, '{pattern}')"


CUSTOMER_RULES = [
    ("valid_customer_id", "drop", "customer_id IS NOT NULL"),
    ("valid_customer_name", "drop", "name IS NOT NULL"),
    ("valid_dob", "drop", "dob IS NOT NULL"),
    ("valid_city", "drop", "city IS NOT NULL"),
    ("valid_join_date", "drop", "join_date IS NOT NULL"),
    ("valid_email", "drop", email_ok(EMAIL_LOOSE)),
    ("valid_phone_number", "drop", "phone_number IS NOT NULL"),
    ("valid_preferred_channel", "drop", "preferred_channel IS NOT NULL"),
    ("valid_occupation", "drop", "occupation IS NOT NULL"),
    ("valid_income", "drop", "income_range IS NOT NULL"),
    ("valid_risk_segment", "drop", "risk_segment IS NOT NULL"),
    ("valid_gender", "warn", "gender IS NOT NULL"),
    ("valid_status", "warn", "status IS NOT NULL"),
]
ACCOUNT_RULES = [
    ("valid_account_id", "drop", "account_id IS NOT NULL"),
    ("valid_customer_id", "drop", "customer_id IS NOT NULL"),
    ("valid_txn_id", "drop", "txn_id IS NOT NULL"),
    ("account_type", "drop", "account_type IS NOT NULL"),
    ("valid_balance", "drop", "balance IS NOT NULL"),
    ("valid_txn_date", "drop", "txn_date IS NOT NULL"),
    ("valid_txn_amount", "drop", "txn_amount IS NOT NULL"),
    ("valid_txn_type", "drop", "txn_type IS NOT NULL"),
    ("valid_txn_channel", "drop", "txn_channel IS NOT NULL"),
]


def passes(rules: Sequence[tuple[str, str, str]]) -> str:
    return " AND ".join(f"({p})" for _, action, p in rules if action == "drop")


def report(source: str, rules: Sequence[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS rule, '{a}' AS action, count(*) FILTER (WHERE {p}) AS passed, "
        f"count(*) - count(*) FILTER (WHERE {p}) AS violations FROM {source}"
        for n, a, p in rules
    )


ACCOUNTS_CLEAN = """
SELECT account_id, customer_id, upper(account_type) AS account_type, balance, txn_id, txn_date,
 CASE upper(txn_type) WHEN 'DEBITT' THEN 'DEBIT' WHEN 'CREDIT' THEN 'CREDIT' ELSE 'UNKNOWN' END AS txn_type,
 txn_amount, upper(txn_channel) AS txn_channel
FROM accounts_raw"""

SILVER_CUSTOMERS = f"""
SELECT *, date_sub('year', dob, {AS_OF_SQL}) AS customer_age,
 CAST(date_diff('day', join_date, {AS_OF_SQL}) AS INT) AS tenure_days,
 dob < DATE '1900-01-01' OR dob > {AS_OF_SQL} AS dob_out_of_range_flag
FROM bronze_customers"""

SILVER_TRANSACTIONS = """
SELECT *, CASE WHEN txn_channel IN ('ATM', 'BRANCH') THEN 'PHYSICAL' ELSE 'DIGITAL' END AS channel_type,
 CAST(year(txn_date) AS INT) AS txn_year, CAST(month(txn_date) AS INT) AS txn_month,
 CAST(day(txn_date) AS INT) AS txn_day,
 CASE WHEN txn_type = 'DEBIT' THEN 'OUT' ELSE 'IN' END AS txn_direction
FROM bronze_accounts"""

JOINED = """
SELECT c.* EXCLUDE (customer_id), t.* FROM silver_customers c
JOIN silver_transactions t ON CAST(c.customer_id AS BIGINT) = t.customer_id"""

MONEY = "DECIMAL(18,2)"


def totals(source: str, keys: str) -> str:
    return f"""
SELECT {keys}, count(DISTINCT account_id) AS accounts_count, count(*) AS txn_count,
 CAST(sum(CAST(CASE WHEN txn_type = 'CREDIT' THEN txn_amount ELSE 0 END AS {MONEY})) AS DOUBLE) AS total_credits,
 CAST(sum(CAST(CASE WHEN txn_type = 'DEBIT' THEN txn_amount ELSE 0 END AS {MONEY})) AS DOUBLE) AS total_debits,
 CAST(sum(CAST(txn_amount AS {MONEY})) AS DOUBLE) / count(txn_amount) AS avg_txn_amount,
 min(txn_date) AS first_txn_date, max(txn_date) AS last_txn_date,
 count(DISTINCT txn_channel) AS channels_used
FROM {source} GROUP BY {keys}"""


GOLD_KEYS = "customer_id, name, gender, city, status, income_range, risk_segment, customer_age, tenure_days"


def with_tables(tables: dict[str, str], select: str) -> str:
    named = ",\n".join(f"{name} AS ({text})" for name, text in tables.items())
    return f"WITH {named}\n{select}"


def bank(select: str, **extra: str) -> str:
    """``select`` over the bank datasets."""
    tables = {
        "customers_raw": inputs.plain(inputs.CUSTOMERS_RAW),
        "accounts_raw": inputs.plain(inputs.ACCOUNTS_RAW),
        "customers_clean": customers_clean("customers_raw"),
        "customers_known": f"SELECT * FROM customers_clean WHERE {KNOWN}",
        "bronze_customers": f"SELECT * FROM customers_known WHERE {passes(CUSTOMER_RULES)}",
        "accounts_clean": ACCOUNTS_CLEAN,
        "bronze_accounts": f"SELECT * FROM accounts_clean WHERE {passes(ACCOUNT_RULES)}",
        "silver_customers": SILVER_CUSTOMERS,
        "silver_transactions": SILVER_TRANSACTIONS,
        "joined": JOINED,
    }
    return with_tables({**tables, **extra}, select)


# --- change capture ---------------------------------------------------------


def scd1(source: str, keys: str, order: str, columns: str = "*", deletes: str = "false") -> str:
    """Latest row per key by ``row_number``."""
    descending = ", ".join(f"{c.strip()} DESC" for c in order.split(","))
    return f"""SELECT {columns} FROM (
 SELECT *, ({deletes}) AS gone, row_number() OVER (PARTITION BY {keys} ORDER BY {descending}) AS nr FROM {source}
) r WHERE nr = 1 AND NOT gone"""


def scd2(
    source: str,
    keys: Sequence[str],
    order: Sequence[str],
    tracked: Sequence[str],
    others: Sequence[str] = (),
    deletes: str = "false",
) -> str:
    """Version number by running sum, last row and first sequence per version, then ``lead``."""
    by, seq = ", ".join(keys), ", ".join(order)
    descending = ", ".join(f"{c} DESC" for c in order)
    differs = " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER w" for c in tracked)
    return f"""SELECT {", ".join([*keys, *tracked, *others])}, valid_from, valid_to, valid_to IS NULL AS is_current
FROM (
 SELECT *, lead(valid_from) OVER (PARTITION BY {by} ORDER BY version) AS valid_to FROM (
  SELECT *, min({order[0]}) OVER (PARTITION BY {by}, version) AS valid_from,
   row_number() OVER (PARTITION BY {by}, version ORDER BY {descending}) AS nr
  FROM (
   SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY {by} ORDER BY {seq}) AS version FROM (
    SELECT *, CASE WHEN lag(gone) OVER w IS NULL OR gone <> lag(gone) OVER w THEN true
                   WHEN gone THEN false ELSE {differs} END AS opens
    FROM (SELECT *, ({deletes}) AS gone FROM {source}) a
    WINDOW w AS (PARTITION BY {by} ORDER BY {seq})
   ) b
  ) c
 ) d WHERE nr = 1
) e WHERE NOT gone"""


# --- sales ------------------------------------------------------------------

SALES_ENR = "SELECT *, quantity * amount AS total_amount FROM sales_stg"
PRODUCTS_ENR = "SELECT product_id, category, CAST(trunc(price) AS INT) AS price, last_updated FROM products_src"
CUSTOMERS_ENR = "SELECT customer_id, upper(customer_name) AS customer_name, region, last_updated FROM customers_src"

JOIN_ON = {
    "naive": ("", ""),
    "current": ("AND c.valid_to IS NULL", "AND p.valid_to IS NULL"),
    "as_of": tuple(
        f"AND f.sale_timestamp >= {d}.valid_from AND ({d}.valid_to IS NULL OR f.sale_timestamp < {d}.valid_to)"
        for d in ("c", "p")
    ),
}


def star(mode: str, select: str) -> str:
    on_customer, on_product = JOIN_ON[mode]
    return f"""SELECT {select} FROM fact_sales f
 JOIN dim_customers c ON f.customer_id = c.customer_id {on_customer}
 JOIN dim_products p ON f.product_id = p.product_id {on_product}"""


def business(mode: str) -> str:
    total = f"CAST(sum(CAST(total_amount AS {MONEY})) AS DOUBLE)"
    return star(mode, f"region, category, {total} AS total_sales") + " GROUP BY region, category"


def sales(select: str, **extra: str) -> str:
    """``select`` over the sales datasets."""
    tables = {
        "sales_raw": inputs.plain(inputs.SALES_RAW),
        "customers_src": inputs.plain(inputs.CUSTOMERS_SRC),
        "products_src": inputs.plain(inputs.PRODUCTS_SRC),
        "sales_stg": "SELECT * EXCLUDE (feed) FROM sales_raw WHERE sales_id IS NOT NULL",
        "sales_view": SALES_ENR,
        "products_view": PRODUCTS_ENR,
        "customers_view": CUSTOMERS_ENR,
        "fact_sales": scd1("sales_view", "sales_id", "sale_timestamp", "* EXCLUDE (gone, nr)"),
        "dim_customers": scd2(
            "customers_view", ["customer_id"], ["last_updated"], ["customer_name", "region"], ["last_updated"]
        ),
        "dim_products": scd2(
            "products_view", ["product_id"], ["last_updated"], ["category", "price"], ["last_updated"]
        ),
    }
    return with_tables({**tables, **extra}, select)


def users(select: str) -> str:
    return with_tables({"users_raw": inputs.plain(inputs.USERS_RAW)}, select)
