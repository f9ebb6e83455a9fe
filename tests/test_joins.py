import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from terrace.operators.joins import (
    effective_date_join,
    inferred_members,
    inner_using,
    with_dimension_key,
    with_surrogate_key,
)
from terrace.operators.totals import CENTS
from terrace import fixed_values as fixed
from terrace.plans import bank, sales
from terrace.session import materialize
from tests.helpers import plan, rows, same_rows


def test_int_and_long_keys_meet_and_nulls_do_not(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "id int, x string")
    right = spark.createDataFrame([(1, "c"), (None, "d"), (2**40, "e")], "id long, y string")
    joined = inner_using(left, right, "id")
    assert rows(joined) == [(1, "a", "c")]
    assert dict(joined.dtypes)["id"] == "bigint"


# --- effective date ---------------------------------------------------------

FACT = "id int, k int, at int, amount double"
DIM = "k int, name string, valid_from int, valid_to int"


def random_star(seed):
    r = random.Random(seed)
    dim = []
    for k in range(6):
        cuts = sorted(r.sample(range(100), 12))
        for a, b in zip(cuts, [*cuts[1:], None]):
            if r.random() < 0.8:
                dim.append((k, f"{k}-{a}", a, b))
        # An empty interval never holds.
        dim.append((k, "never", cuts[3], cuts[3]))
    dim.append((None, "null key", 0, None))
    fact = [
        (i, r.choice([0, 0, 0, *range(7), None]), r.choice([50, r.randrange(110), None]), float(i)) for i in range(600)
    ]
    return fact, dim


def brute(fact, dim):
    return sorted(
        (*f, d[1])
        for f in fact
        for d in dim
        if None not in (f[1], f[2]) and f[1] == d[0] and d[2] <= f[2] and (d[3] is None or f[2] < d[3])
    )


WAYS = [("sweep", None, 32), ("sweep", 20, 32), ("range", None, 32), ("auto", None, 32), ("auto", None, 3), ("descend", None, 2), ("descend", None, 5)]


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize(("method", "hot_rows", "max_versions"), WAYS)
def test_effective_date_join_against_brute_force(spark, method, hot_rows, max_versions, how):
    fact, dim = random_star(1)
    joined = effective_date_join(
        spark.createDataFrame(fact, FACT), spark.createDataFrame(dim, DIM), "k", "at",
        method=method, how=how, hot_rows=hot_rows, max_versions=max_versions,
    )
    assert joined.columns == ["id", "k", "at", "amount", "name"]
    found = brute(fact, dim)
    if how == "left":
        alone = {f[0] for f in fact} - {f[0] for f in found}
        found += [(*f, None) for f in fact if f[0] in alone]
    order = lambda t: str(t)
    assert sorted(map(tuple, joined.collect()), key=order) == sorted(found, key=order)


def test_auto_descends_where_a_key_has_many_versions(spark):
    """One join per level, all of them equal in the key, and the facts are read once."""
    fact, dim = random_star(2)
    frames = spark.createDataFrame(fact, FACT), spark.createDataFrame(dim, DIM)
    assert plan(effective_date_join(*frames, "k", "at")).count("Join") == 1
    descended = effective_date_join(*frames, "k", "at", max_versions=3)
    assert plan(descended).count("Join") == 3 and "Window" not in plan(descended) and "NestedLoop" not in plan(descended)
    assert plan(descended).count("Scan ExistingRDD") == 1
    assert rows(descended) == brute(fact, dim)
    with pytest.raises(ValueError, match="two versions"):
        effective_date_join(*frames, "k", "at", method="descend", max_versions=1)
    with pytest.raises(ValueError, match="how must be"):
        effective_date_join(*frames, "k", "at", how="full")


def test_a_hot_key_with_many_versions_splits(spark):
    """Half of the facts are of one key that has all the versions: Spark splits each join of the way down."""
    dim = spark.range(4000).selectExpr("0 k", "concat('v', id) name", "cast(id * 10 as int) valid_from", "cast(id * 10 + 10 as int) valid_to")
    fact = spark.range(60000).selectExpr("cast(id as int) id", "cast(case when id % 2 = 0 then 0 else id end as int) k", "cast(id % 40000 as int) at", "1.0 amount")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        stored = materialize(fact, "facts")
        joined = effective_date_join(stored, dim.filter("true"), "k", "at", max_versions=64)
        joined.collect()
        assert plan(joined).count("skew=true") >= 1
        assert joined.count() == 30000 and joined.filter("name != concat('v', cast(floor(at / 10) as int))").isEmpty()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_facts_get_the_key_valid_at_their_time_or_an_inferred_member(spark):
    dim = spark.createDataFrame([(1, "a", 10, 20), (1, "b", 20, 30), (2, "c", 5, None)], DIM)
    fact = spark.createDataFrame([(1, 1, 5, 1.0), (2, 1, 10, 1.0), (3, 1, 25, 1.0), (4, 1, 30, 1.0), (5, 9, 1, 1.0), (6, None, 1, 1.0), (7, 2, None, 1.0)], FACT)
    keyed = with_dimension_key(fact, dim, "k", "at")
    members = with_surrogate_key(dim, ["k"])
    found = {r.id: (r.surrogate_key, r.is_inferred) for r in keyed.collect()}
    key_of = {r.name: r.surrogate_key for r in members.collect()}
    assert found[2] == (key_of["a"], False) and found[3] == (key_of["b"], False)
    assert found[1] == found[4] and found[1][1] and found[5][1] and found[7][1] and found[6] == (None, False)
    assert len({found[i][0] for i in (1, 5, 7)}) == 3 and not {found[i][0] for i in (1, 5, 7)} & set(key_of.values())
    added = inferred_members(keyed, members, "k")
    assert added.columns == members.columns
    assert rows(added, "k", "name") == [(1, None), (2, None), (9, None)]
    whole = members.unionByName(added)
    assert keyed.join(whole, "surrogate_key").count() == 6


@pytest.mark.parametrize("method", ["sweep", "range", "descend"])
@pytest.mark.parametrize("hot_rows", [None, 2])
@pytest.mark.parametrize("extra", [(1, "open", 0, None), (1, "late", 25, 31), (1, "twin", 40, 45)])
def test_overlapping_versions_are_an_error(spark, method, hot_rows, extra):
    dim = [(1, str(k), k, k + 10) for k in range(0, 60, 10)] + [extra]
    frames = spark.createDataFrame([(1, 1, 5, 1.0)], FACT), spark.createDataFrame(dim, DIM)
    with pytest.raises(ValueError, match="overlap"):
        effective_date_join(*frames, "k", "at", method=method, hot_rows=hot_rows)


def test_timestamp_fact_with_date_versions(spark):
    fact = spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 12))], "k int, at timestamp_ntz")
    dim = spark.createDataFrame(
        [(1, "old", dt.date(2024, 1, 1), dt.date(2024, 1, 3)), (1, "new", dt.date(2024, 1, 3), None)],
        "k int, name string, valid_from date, valid_to date",
    )
    for method in ("sweep", "range", "descend"):
        assert rows(effective_date_join(fact, dim, "k", "at", method=method), "name") == [("old",)]


def test_surrogate_keys_are_unique_and_stable(spark):
    dim = spark.createDataFrame([(k, v) for k in ("a", "", None, '"') for v in (1, 2, None)], "k string, valid_from int")
    keyed = with_surrogate_key(dim, ["k"]).select("surrogate_key")
    assert keyed.distinct().count() == dim.distinct().count()
    assert same_rows(keyed, with_surrogate_key(dim.repartition(3), ["k"]).select("surrogate_key"))


def test_surrogate_keys_tell_microseconds_and_ignore_the_time_zone(spark):
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    data = [("a", at + dt.timedelta(microseconds=m), n) for m in (100, 200) for n in (1, 2)]
    dim = spark.createDataFrame(data, "k string, valid_from timestamp, number int")
    keys = []
    for zone in ("UTC", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            keys.append(rows(with_surrogate_key(dim, ["k"], further=["number"]), "surrogate_key"))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert keys[0] == keys[1] and len(set(keys[0])) == 4


# --- business sales ---------------------------------------------------------


@pytest.fixture()
def star(spark):
    r = random.Random(3)
    day = dt.datetime(2024, 1, 1)
    fact = spark.createDataFrame(
        [
            (i, r.choice([1, 1, 2, 3, None]), r.randrange(4), day + dt.timedelta(days=r.randrange(60)), i / 4)
            for i in range(300)
        ],
        "sales_id int, customer_id int, product_id int, sale_timestamp timestamp_ntz, total_amount double",
    )

    def dim(key, attribute, values):
        data = []
        for k in range(4):
            for n, start in enumerate((0, 10, 20, 40)):
                end = (10, 20, 40, None)[n]
                ends = None if end is None else day + dt.timedelta(days=end)
                data.append((k, r.choice(values), day + dt.timedelta(days=start), ends))
        return spark.createDataFrame(data, f"{key} int, {attribute} string, valid_from timestamp_ntz, valid_to timestamp_ntz")

    return fact, dim("customer_id", "region", ["N", "S"]), dim("product_id", "category", ["p", "q"])


@pytest.mark.parametrize("mode", [sales.NAIVE, sales.CURRENT, sales.AS_OF])
@pytest.mark.parametrize("money", [None, CENTS])
def test_business_sales_equals_the_sum_over_the_join(star, mode, money):
    by_join = (
        sales.star_join(*star, mode).groupBy("region", "category").agg(F.sum("total_amount").alias("total_sales"))
    )
    assert same_rows(sales.business_sales(*star, mode, money), by_join)


def test_history_multiplies_sales_only_in_naive_mode(star):
    matched = star[0].filter("customer_id IS NOT NULL").count()
    assert sales.star_join(*star, sales.NAIVE).count() == matched * 16
    assert sales.star_join(*star, sales.CURRENT).count() == matched
    assert sales.star_join(*star, sales.AS_OF).count() == matched
    with pytest.raises(ValueError, match="mode"):
        sales.star_join(*star, "other")


def test_customer_join_comes_after_the_sum(star):
    tree = sales.business_sales(*star, sales.NAIVE)._jdf.queryExecution().optimizedPlan().toString()
    lines = tree.splitlines()
    joins_at = [n for n, line in enumerate(lines) if "Join Inner" in line]
    sums_at = [n for n, line in enumerate(lines) if "Aggregate [customer_id" in line and "category" in line]
    assert joins_at[0] < sums_at[0] < joins_at[1]


# --- bank totals ------------------------------------------------------------


@pytest.fixture()
def bank_rows(spark):
    r = random.Random(4)
    customers = [(k, f"n{k}", "MALE", "C", "S", "LOW", "HIGH", 30, 5) for k in (1, 2, 3, 3, 3, None, 9)]
    customers.append((2, "n2", "MALE", "OTHER", "S", "LOW", "HIGH", 30, 5))
    transactions = [
        (
            r.choice([1, 1, 1, 2, 3, None, 7]),
            r.randrange(3),
            r.choice(["ATM", "ONLINE", None]),
            r.choice(["CREDIT", "DEBIT", "UNKNOWN"]),
            r.choice([None, r.randrange(10_000) / 100]),
            dt.date(2024, 1, 1 + r.randrange(28)),
        )
        for _ in range(400)
    ]
    return (
        spark.createDataFrame(
            customers,
            "customer_id int, name string, gender string, city string, status string, income_range string, "
            "risk_segment string, customer_age long, tenure_days int",
        ).withColumn("transformation_date", F.current_timestamp()),
        spark.createDataFrame(
            transactions,
            "customer_id long, account_id int, txn_channel string, txn_type string, txn_amount double, txn_date date",
        ),
    )


def plain_totals(joined):
    amount = F.col("txn_amount").cast(CENTS)
    return joined.groupBy(*fixed.GOLD_KEYS).agg(
        F.count_distinct("account_id").alias("accounts_count"),
        F.count("*").alias("txn_count"),
        F.sum(F.when(F.col("txn_type") == "CREDIT", amount).otherwise(0)).cast("double").alias("total_credits"),
        F.sum(F.when(F.col("txn_type") == "DEBIT", amount).otherwise(0)).cast("double").alias("total_debits"),
        (F.sum(amount).cast("double") / F.nullif(F.count(amount), F.lit(0))).alias("avg_txn_amount"),
        F.min("txn_date").alias("first_txn_date"),
        F.max("txn_date").alias("last_txn_date"),
        F.count_distinct("txn_channel").alias("channels_used"),
    )


def test_totals_before_the_join_equal_totals_after_it(bank_rows):
    customers, transactions = bank_rows
    joined = bank.gold_cust_acc_trns_mv(customers, transactions)
    expected = [[round(v, 9) if isinstance(v, float) else v for v in r] for r in rows(plain_totals(joined))]
    for got in (
        bank.gold_totals(customers, transactions, CENTS),
        bank.gold_cust_acc_trans_agg(joined, CENTS),
    ):
        assert got.columns == plain_totals(joined).columns
        assert [[round(v, 9) if isinstance(v, float) else v for v in r] for r in rows(got)] == expected


def test_totals_without_a_money_type_sum_the_column_itself(bank_rows):
    customers, transactions = bank_rows
    got = bank.gold_totals(customers, transactions).agg(F.round(F.sum("total_credits"), 4)).first()[0]
    exact = bank.gold_totals(customers, transactions, CENTS).agg(F.round(F.sum("total_credits"), 4)).first()[0]
    assert got == exact


def test_redelivered_customer_doubles_its_transactions_unless_current(bank_rows):
    customers, transactions = bank_rows
    per_key = transactions.filter("customer_id = 3").count()
    every = bank.gold_cust_acc_trns_mv(customers, transactions)
    current = bank.gold_cust_acc_trns_mv(customers, transactions, current_only=True)
    assert every.filter("customer_id = 3").count() == 3 * per_key
    assert current.filter("customer_id = 3").count() == per_key
