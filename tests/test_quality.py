import pytest
from pyspark.sql import Observation

from terrace.operators.quality import DROP, WARN, Rule, expect, quality_report, quarantine, rules
from terrace.plans import bank
from terrace.streaming import finish, write_stream
from tests.helpers import optimized, rows

DATA = [(1, "a", 5), (2, None, -1), (None, "c", None), (4, "d", 7)]
SCHEMA = "id int, name string, price int"
RULES = [Rule("has_id", "id IS NOT NULL"), Rule("has_name", "name IS NOT NULL", WARN), Rule("price", "price >= 0")]


@pytest.fixture()
def data(spark):
    return spark.createDataFrame(DATA, SCHEMA)


def test_drop_rules_drop_and_warn_rules_keep(data):
    assert rows(expect(data, RULES), "id") == [(1,), (4,)]
    assert expect(data, rules({"n": "name IS NOT NULL"}, WARN)).count() == 4


def test_null_predicate_is_a_violation(data):
    report = {r.rule: r.violations for r in quality_report(data, RULES).collect()}
    assert report == {"has_id": 1, "has_name": 1, "price": 2}
    assert {r.rule: r.passed for r in quality_report(data, RULES).collect()}["price"] == 2


def test_kept_and_quarantined_rows_make_the_input(data):
    bad = quarantine(data, RULES)
    assert rows(bad, "id", "failed_rules") == [(None, ["has_id", "price"]), (2, ["price"])]
    assert expect(data, RULES).unionByName(bad.drop("failed_rules")).exceptAll(data).count() == 0
    assert expect(data, RULES).count() + bad.count() == data.count()


def test_counters_in_one_pass(data):
    counters = Observation("c")
    assert expect(data, RULES, counters).count() == 2
    assert counters.get == {"rows": 4, "has_id": 1, "has_name": 1, "price": 2}


def test_rule_on_a_missing_column_is_named(data):
    with pytest.raises(ValueError, match="rule valid_address"):
        expect(data, [*RULES, Rule("valid_address", "address IS NOT NULL")])


def test_bad_rules(data):
    with pytest.raises(ValueError, match="action"):
        Rule("x", "true", "fail")
    with pytest.raises(ValueError, match="repeat"):
        expect(data, [Rule("x", "true"), Rule("x", "true")])


def test_rules_become_one_filter(data):
    text = optimized(expect(data, rules({"a": "id IS NOT NULL", "b": "price >= 0", "c": "name <> ''"}, DROP)))
    assert text.count("Filter") == 1


def test_defaults_make_their_rules_always_hold(spark):
    raw = spark.createDataFrame(
        [(None, None), ("M", " ")], "gender string, status string"
    ).selectExpr(
        "*",
        "1 AS customer_id",
        *[
            f"'x' AS {c}"
            for c in "name email occupation city income_range risk_segment preferred_channel phone_number".split()
        ],
        "current_date() AS dob",
        "current_date() AS join_date",
    )
    report = {r.rule: r.violations for r in quality_report(bank.clean_customers(raw), bank.customer_rules()).collect()}
    assert (report["valid_gender"], report["valid_status"]) == (0, 0)


def test_counters_on_a_stream(spark, data, tmp_path):
    data.repartition(2).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(data.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = write_stream(expect(stream, RULES, "counters"), path=f"{tmp_path}/out", checkpoint=f"{tmp_path}/cp")
    finish(query)
    seen = [p.observedMetrics["counters"] for p in query.recentProgress if "counters" in p.observedMetrics]
    assert sum(s["rows"] for s in seen) == 4
    assert sum(s["price"] for s in seen) == 2
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
