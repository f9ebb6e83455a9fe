"""Schemas, rule sets, word lists and patterns that results depend on.

They are part of the data contract of the bank, sales and users datasets, so they
are stated here as they are, in one place.
"""

# --- schemas of the files that land -----------------------------------------

CUSTOMERS_SCHEMA = """
    customer_id INT,
    name STRING,
    dob DATE,
    gender STRING,
    city STRING,
    join_date DATE,
    status STRING,
    email STRING,
    phone_number STRING,
    preferred_channel STRING,
    occupation STRING,
    income_range STRING,
    risk_segment STRING
"""

ACCOUNTS_SCHEMA = """
    account_id BIGINT,
    customer_id BIGINT,
    account_type STRING,
    balance DOUBLE,
    txn_id BIGINT,
    txn_date DATE,
    txn_type STRING,
    txn_amount DOUBLE,
    txn_channel STRING
"""

SALES_CUSTOMERS_SCHEMA = "customer_id BIGINT, customer_name STRING, region STRING, last_updated DATE"
SALES_PRODUCTS_SCHEMA = "product_id BIGINT, category STRING, price DOUBLE, last_updated DATE"
SALES_SCHEMA = (
    "sales_id BIGINT, customer_id BIGINT, product_id BIGINT, quantity INT, amount DOUBLE, sale_timestamp TIMESTAMP"
)
USERS_SCHEMA = "user_id BIGINT, email STRING, name STRING, user_type STRING"

# --- patterns ---------------------------------------------------------------
# Character classes instead of backslashes: they read the same in a SQL string,
# in the Column API and in other engines.

# The dot before the top-level domain matches any character, so "a@bxcom" passes.
EMAIL_LOOSE = "^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+.[A-Za-z]{2,}$"
EMAIL_STRICT = "^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}$"

PHONE_NOISE = "[^0-9+]+"
PHONE_UK = "^[+]44[0-9]{10}$"

# --- word lists and mappings ------------------------------------------------

PREFERRED_CHANNELS = ["MOBILE", "ONLINE", "BRANCH", "ATM"]
INCOME_RANGES = ["LOW", "MEDIUM", "HIGH", "VERY HIGH"]
RISK_SEGMENTS = ["LOW", "MEDIUM", "HIGH"]
PHYSICAL_CHANNELS = ["ATM", "BRANCH"]

GENDER = {"M": "MALE", "F": "FEMALE"}
GENDER_DEFAULT = "Unknown"
STATUS_DEFAULT = "UNKNOWN"

# The feed spells debits "DEBITT"; everything else, a correct "DEBIT" included, is UNKNOWN.
TXN_TYPE = {"DEBITT": "DEBIT", "CREDIT": "CREDIT"}
# Same, but a correctly spelt debit is kept.
TXN_TYPE_REPAIRED = {"DEBITT": "DEBIT", "DEBIT": "DEBIT", "CREDIT": "CREDIT"}
TXN_TYPE_DEFAULT = "UNKNOWN"

EARLIEST_DOB = "1900-01-01"

# --- quality rules: name -> predicate ---------------------------------------

CUSTOMER_DROP_RULES = {
    "valid_customer_id": "customer_id IS NOT NULL",
    "valid_customer_name": "name IS NOT NULL",
    "valid_dob": "dob IS NOT NULL",
    "valid_city": "city IS NOT NULL",
    "valid_join_date": "join_date IS NOT NULL",
    "valid_email": f"email IS NOT NULL AND email RLIKE '{EMAIL_LOOSE}'",
    "valid_phone_number": "phone_number IS NOT NULL",
    "valid_preferred_channel": "preferred_channel IS NOT NULL",
    "valid_occupation": "occupation IS NOT NULL",
    "valid_income": "income_range IS NOT NULL",
    "valid_risk_segment": "risk_segment IS NOT NULL",
}
CUSTOMER_WARN_RULES = {
    "valid_gender": "gender IS NOT NULL",
    "valid_status": "status IS NOT NULL",
}
ACCOUNT_DROP_RULES = {
    "valid_account_id": "account_id IS NOT NULL",
    "valid_customer_id": "customer_id IS NOT NULL",
    "valid_txn_id": "txn_id IS NOT NULL",
    "account_type": "account_type IS NOT NULL",
    "valid_balance": "balance IS NOT NULL",
    "valid_txn_date": "txn_date IS NOT NULL",
    "valid_txn_amount": "txn_amount IS NOT NULL",
    "valid_txn_type": "txn_type IS NOT NULL",
    "valid_txn_channel": "txn_channel IS NOT NULL",
}
SALES_CUSTOMER_RULES = {
    "rule_1": "customer_id IS NOT NULL",
    "rule_2": "customer_name IS NOT NULL",
}
SALES_PRODUCT_RULES = {
    "rule_1": "product_id IS NOT NULL",
    "rule_2": "price >= 0",
}
SALES_RULES = {
    "rule_1": "sales_id IS NOT NULL",
}

# Customer columns that transaction totals are grouped by, and columns of users in use.
GOLD_KEYS = (
    "customer_id",
    "name",
    "gender",
    "city",
    "status",
    "income_range",
    "risk_segment",
    "customer_age",
    "tenure_days",
)
USER_COLUMNS = ("user_id", "email", "name", "user_type")
