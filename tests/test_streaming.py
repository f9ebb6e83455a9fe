import collections
import datetime as dt
import os
import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from terrace import fixed_values as fixed
from terrace.operators.append import append_flows
from terrace.operators.cdc import Cdc, scd1, scd2
from terrace.operators.quality import DROP, WARN, expect, quality_report, quarantine, rules
from terrace.operators.totals import CENTS, joined_transaction_totals
from terrace.plans import bank, runs
from terrace.sources import read_csv, stream_csv, stream_parquet, with_audit_columns
from terrace.streaming import (
    Declared,
    backfill,
    comment_of,
    current_rows,
    declare,
    declare_checked,
    declared,
    dedup_within_watermark,
    finish,
    history,
    kept,
    open_versions,
    quarantined,
    read_checked,
    remove_covered,
    rule_totals,
    stream_checked,
    stream_scd,
    write_checked,
    write_on_time,
    write_stream,
)
from terrace.streaming import quality as quality_streams
from terrace.streaming.change_tables import TYPE_1, TYPE_2
from terrace.streaming.kept import KeptTable
from terrace.streaming.kept_totals import CUSTOMERS, TOTALS, KeptTotals
from tests.helpers import plan, rows, same_rows

SCHEMA = "k int, seq int, a string, op string"


def changes(n=600, seed=1):
    r = random.Random(seed)
    data = [
        (r.choice([0, 0, *range(40)]), i, r.choice(["x", "y", None]), "D" if r.random() < 0.1 else "U") for i in range(n)
    ]
    r.shuffle(data)
    return data


def put(spark, folder, name, data):
    """Add one parquet file to a folder that a stream watches."""
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def feed(spark, folder):
    return stream_parquet(spark, f"{folder}/*", SCHEMA, max_files=1)


CASES = {
    "plain": {},
    "deletes": {"deletes": "op = 'D'"},
    "nulls": {"deletes": "op = 'D'", "ignore_nulls": True},
}


def table(spark, target, cdc, kind):
    return current_rows(spark, target, cdc) if kind == TYPE_1 else history(spark, target, cdc)


def expected(spark, data, cdc, kind):
    return (scd1 if kind == TYPE_1 else scd2)(spark.createDataFrame(data, SCHEMA), cdc)


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("kind", [TYPE_1, TYPE_2])
def test_stream_equals_batch_over_runs(spark, tmp_path, case, kind):
    """Changes in no order, over several runs, with buckets that are divided on the way."""
    cdc = Cdc("k", "seq", columns=["a"], **CASES[case])
    data = changes()
    target, checkpoint = f"{tmp_path}/t", f"{tmp_path}/c"
    for n, part in enumerate((data[:200], data[200:], [])):
        for m, chunk in enumerate((part[::2], part[1::2]) if part else ()):
            put(spark, f"{tmp_path}/in", f"{n}-{m}", chunk)
        finish(stream_scd(feed(spark, f"{tmp_path}/in"), cdc, kind, target, checkpoint, bucket_bytes=1000, name=f"{case}{kind}"))
        if part:
            done = data[:200] if n == 0 else data
            assert same_rows(table(spark, target, cdc, kind), expected(spark, done, cdc, kind))
    last = KeptTable(spark, target).last()
    assert last.number == 3 and list(last.flows.values()) == [3] and last.bits > kept.FIRST_BITS
    before = table(spark, target, cdc, kind)
    assert remove_covered(spark, target, kind) > 0 and remove_covered(spark, target, kind) == 0
    assert same_rows(table(spark, target, cdc, kind), expected(spark, data, cdc, kind))
    assert before.columns == table(spark, target, cdc, kind).columns


@pytest.mark.parametrize("kind", [TYPE_1, TYPE_2])
def test_removal_after_every_batch_and_buckets_in_many_pieces(spark, tmp_path, monkeypatch, kind):
    monkeypatch.setattr(kept, "MOST_ADDED", 2)
    cdc = Cdc("k", "seq", columns=["a"], deletes="op = 'D'")
    data = changes(120)
    target = f"{tmp_path}/t"
    for n in range(4):
        backfill(spark.createDataFrame(data[n * 30 : n * 30 + 30], SCHEMA), cdc, kind, target, str(n))
        remove_covered(spark, target, kind)
    assert same_rows(table(spark, target, cdc, kind), expected(spark, data, cdc, kind))
    found = KeptTable(spark, target).folders()
    pieces = collections.Counter((f.part, f.bits, f.bucket) for f in found)
    assert max(pieces.values()) <= 2


@pytest.mark.parametrize("kind", [TYPE_1, TYPE_2])
def test_replayed_and_duplicated_batches_change_nothing(spark, tmp_path, kind):
    cdc = Cdc("k", "seq", columns=["a"], deletes="op = 'D'")
    data = changes()
    put(spark, f"{tmp_path}/in", "1", data)
    target = f"{tmp_path}/t"
    # A lost checkpoint makes a new flow that reads everything again.
    for checkpoint in ("c1", "c1", "c2"):
        finish(stream_scd(feed(spark, f"{tmp_path}/in"), cdc, kind, target, f"{tmp_path}/{checkpoint}"))
    assert len(KeptTable(spark, target).last().flows) == 2
    assert same_rows(table(spark, target, cdc, kind), expected(spark, data, cdc, kind))


def test_a_batch_is_applied_once(spark, tmp_path):
    cdc, target = Cdc("k", "seq"), f"{tmp_path}/t"
    for _ in range(2):
        backfill(spark.createDataFrame(changes(20), SCHEMA), cdc, TYPE_2, target)
        assert KeptTable(spark, target).last().number == 0


@pytest.mark.parametrize("kind", [TYPE_1, TYPE_2])
@pytest.mark.parametrize("same_session", [True, False])
def test_a_batch_that_fails_before_its_end_is_ignored_and_then_redone(spark, tmp_path, monkeypatch, kind, same_session):
    cdc, target = Cdc("k", "seq", columns=["a"], deletes="op = 'D'"), f"{tmp_path}/t"
    data = changes(60)
    backfill(spark.createDataFrame(data[:30], SCHEMA), cdc, kind, target, "first")
    with monkeypatch.context() as m:
        m.setattr(KeptTable, "commit", lambda self, load: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            # Other keys than the second try has, so that their buckets must be cleared.
            backfill(spark.createDataFrame(data[30:] + [(900 + k, 1, "x", "U") for k in range(50)], SCHEMA), cdc, kind, target, "second")
    left = [f for f in KeptTable(spark, target).folders() if f.load == 1]
    assert left
    if not same_session:
        kept._swept.clear()
    assert same_rows(table(spark, target, cdc, kind), expected(spark, data[:30], cdc, kind))
    backfill(spark.createDataFrame(data[30:], SCHEMA), cdc, kind, target, "second")
    assert same_rows(table(spark, target, cdc, kind), expected(spark, data, cdc, kind))


def written(target, load):
    """Bytes and buckets of the files of a load."""
    size, buckets = 0, set()
    for folder, _, names in os.walk(target):
        if f"_load={load:012d}" in folder:
            size += sum(os.path.getsize(f"{folder}/{n}") for n in names if n.endswith(".parquet"))
            buckets.add(folder.split("_bucket=")[1].split("/")[0])
    return size, buckets


@pytest.mark.parametrize("kind", [TYPE_1, TYPE_2])
def test_a_batch_on_one_key_writes_one_bucket_whatever_the_size_of_the_table(spark, tmp_path, kind):
    cdc = Cdc("k", "seq", columns=["a"])
    sizes = []
    for scale in (1, 8):
        target = f"{tmp_path}/{scale}"
        rows = spark.range(2000 * scale).selectExpr("cast(id as int) k", "1 seq", "sha2(cast(id as string), 256) a", "'U' op")
        backfill(rows.limit(10), cdc, kind, target, "declare", bucket_bytes=10_000)
        for n in range(2):  # buckets follow the size that the load before left
            backfill(rows.withColumn("seq", F.lit(2 + n)), cdc, kind, target, f"load {n}", bucket_bytes=10_000)
        # The bucket is not divided on this occasion, which would write its parts.
        backfill(spark.createDataFrame([(7, 9, "late", "U")], SCHEMA), cdc, kind, target, "one", bucket_bytes=1 << 30)
        size, buckets = written(target, KeptTable(spark, target).last().number)
        assert len(buckets) == 1
        sizes.append(size)
    assert sizes[1] < 2 * sizes[0]


def test_changes_in_order_leave_closed_versions_alone(spark, tmp_path):
    """The closed part only grows, until a late change divides one of its versions."""
    cdc, target = Cdc("k", "seq", columns=["a"]), f"{tmp_path}/t"
    kt = KeptTable(spark, target)
    closed = lambda: [f for f in kt.valid(kt.last(), kt.folders(["closed"])) if written_rows(f)]
    written_rows = lambda f: any(n.endswith(".parquet") for n in os.listdir(f"{target}/{f.name}"))
    for n, (seq, a) in enumerate([(10, "x"), (20, "y"), (30, "z"), (40, "w")]):
        backfill(spark.createDataFrame([(1, seq, a, "U")], SCHEMA), cdc, TYPE_2, target, str(n))
    assert [f.load for f in sorted(closed())] == [1, 2, 3]
    backfill(spark.createDataFrame([(1, 15, "late", "U")], SCHEMA), cdc, TYPE_2, target, "late")
    assert [f.load for f in closed()] == [4]
    versions = rows(history(spark, target, cdc), "a", "valid_from", "valid_to")
    assert sorted(versions, key=lambda v: v[1]) == [("x", 10, 15), ("late", 15, 20), ("y", 20, 30), ("z", 30, 40), ("w", 40, None)]


def test_reading_is_a_plain_scan(spark, tmp_path):
    cdc, target = Cdc("k", "seq", columns=["a"], ties="values"), f"{tmp_path}/t"
    for n in range(2):
        backfill(spark.createDataFrame(changes(50, n), SCHEMA), cdc, TYPE_2, target, str(n))
        backfill(spark.createDataFrame(changes(50, n), SCHEMA), cdc, TYPE_1, f"{target}1", str(n))
    for df in (history(spark, target, cdc), current_rows(spark, f"{target}1", cdc)):
        assert not any(x in plan(df) for x in ("Exchange", "Window", "Sort", "Aggregate"))
    assert same_rows(open_versions(spark, target), history(spark, target, cdc).filter("is_current"))


def test_a_declared_table_is_empty_before_its_first_batch(spark, tmp_path):
    cdc = Cdc("k", "seq", columns=["a"])
    schema = spark.createDataFrame([], SCHEMA).schema
    for kind in (TYPE_1, TYPE_2):
        target = f"{tmp_path}/{kind}"
        for _ in range(2):
            declare(spark, target, schema, cdc, kind, "what it holds")
        assert comment_of(spark, target) == "what it holds"
        got = table(spark, target, cdc, kind)
        whole = expected(spark, changes(30), cdc, kind)
        assert got.isEmpty() and got.columns == whole.columns
        backfill(spark.createDataFrame(changes(30), SCHEMA), cdc, kind, target)
        assert same_rows(table(spark, target, cdc, kind), whole) and comment_of(spark, target) == "what it holds"


def test_late_row_after_a_delete_in_another_batch(spark, tmp_path):
    cdc = Cdc("k", "seq", columns=["a"], deletes="op = 'D'")
    for n, row in enumerate([(1, 1, "a", "U"), (1, 3, None, "D"), (1, 2, "b", "U")]):
        put(spark, f"{tmp_path}/in", str(n), [row])
        finish(stream_scd(feed(spark, f"{tmp_path}/in"), cdc, TYPE_1, f"{tmp_path}/t", f"{tmp_path}/c"))
    assert rows(current_rows(spark, f"{tmp_path}/t", cdc)) == []


def test_truncate_in_a_later_batch(spark, tmp_path):
    cdc = Cdc("k", "seq", columns=["a"], truncates="op = 'T'")
    for n, row in enumerate([(1, 1, "a", "U"), (2, 9, "b", "U"), (5, 5, None, "T"), (3, 4, "late", "U")]):
        put(spark, f"{tmp_path}/in", str(n), [row])
        finish(stream_scd(feed(spark, f"{tmp_path}/in"), cdc, TYPE_1, f"{tmp_path}/t", f"{tmp_path}/c"))
    assert rows(current_rows(spark, f"{tmp_path}/t", cdc)) == [(2, "b")]


def test_backfill_then_stream(spark, tmp_path):
    cdc = Cdc("k", "seq", columns=["a"], deletes="op = 'D'")
    data = changes()
    for _ in range(2):
        backfill(spark.createDataFrame(data[:300], SCHEMA), cdc, TYPE_2, f"{tmp_path}/t")
    put(spark, f"{tmp_path}/in", "1", data[300:])
    finish(stream_scd(feed(spark, f"{tmp_path}/in"), cdc, TYPE_2, f"{tmp_path}/t", f"{tmp_path}/c"))
    assert same_rows(history(spark, f"{tmp_path}/t", cdc), scd2(spark.createDataFrame(data, SCHEMA), cdc))


def test_kind_and_target_are_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="kind"):
        stream_scd(feed(spark, f"{tmp_path}"), Cdc("k", "seq"), 3, f"{tmp_path}/t", f"{tmp_path}/c")
    with pytest.raises(ValueError, match="no complete batch"):
        current_rows(spark, f"{tmp_path}/missing", Cdc("k", "seq"))
    with pytest.raises(ValueError, match="path or table"):
        write_stream(feed(spark, f"{tmp_path}"), checkpoint=f"{tmp_path}/c")


def test_fan_in_keeps_every_row(spark, tmp_path):
    data = changes(200)
    put(spark, f"{tmp_path}/east", "1", data[:80])
    put(spark, f"{tmp_path}/west", "1", data[80:])
    both = append_flows(feed(spark, f"{tmp_path}/east"), feed(spark, f"{tmp_path}/west"))
    finish(write_stream(both, path=f"{tmp_path}/t", checkpoint=f"{tmp_path}/c"))
    assert same_rows(spark.read.parquet(f"{tmp_path}/t"), spark.createDataFrame(data, SCHEMA))


def test_dedup_across_batches(spark, tmp_path):
    schema = "id int, ts timestamp_ntz"
    one = spark.sql("SELECT id, TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, id) AS ts FROM range(20)")
    one = one.withColumn("id", F.col("id").cast("int"))
    for name in ("a", "b"):
        one.coalesce(1).write.parquet(f"{tmp_path}/in/{name}")
    stream = stream_parquet(spark, f"{tmp_path}/in/*", schema, max_files=1)
    finish(
        write_stream(
            dedup_within_watermark(stream, ["id"], "ts", "1 hour"), path=f"{tmp_path}/t", checkpoint=f"{tmp_path}/c"
        )
    )
    assert spark.read.parquet(f"{tmp_path}/t").count() == 20


# --- files ------------------------------------------------------------------

HEADER = "account_id,customer_id,account_type,balance,txn_id,txn_date,txn_type,txn_amount,txn_channel\n"


def csv(folder, name, *lines, header=HEADER):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(header + "".join(line + "\n" for line in lines))


def test_ingest_takes_each_file_once(spark, tmp_path):
    folder, out, checkpoint = (f"{tmp_path}/{x}" for x in ("in", "out", "c"))
    csv(folder, "1.csv", "1,2,a,1.5,7,2024-01-02,credit,2.5,atm")
    for expected in (1, 1):
        query = write_stream(stream_csv(spark, folder, fixed.ACCOUNTS_SCHEMA), path=out, checkpoint=checkpoint)
        finish(query)
        assert spark.read.parquet(out).count() == expected
    csv(folder, "2.csv", "x,2,a,1.5,8,2024-13-40,credit,2.5,atm")
    finish(write_stream(stream_csv(spark, folder, fixed.ACCOUNTS_SCHEMA), path=out, checkpoint=checkpoint))
    # Cells that do not parse are NULL, for the rules to catch.
    assert rows(spark.read.parquet(out), "account_id", "txn_id", "txn_date")[0][:2] == (None, 8)
    assert rows(bank.bronze_accounts_clean(spark.read.parquet(out)), "txn_id") == [(7,)]


def test_swapped_header_fails(spark, tmp_path):
    swapped = HEADER.replace("account_id,customer_id", "customer_id,account_id")
    csv(f"{tmp_path}/in", "1.csv", "1,2,a,1.5,7,2024-01-02,credit,2.5,atm", header=swapped)
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, f"{tmp_path}/in", fixed.ACCOUNTS_SCHEMA).collect()
    unchecked = read_csv(spark, f"{tmp_path}/in", fixed.ACCOUNTS_SCHEMA, check_header=False)
    assert rows(unchecked, "account_id", "customer_id") == [(1, 2)]


def test_audit_columns(spark, tmp_path):
    csv(f"{tmp_path}/in", "1.csv", "1,2,a,1.5,7,2024-01-02,credit,2.5,atm")
    row = with_audit_columns(read_csv(spark, f"{tmp_path}/in", fixed.ACCOUNTS_SCHEMA)).first()
    assert row.source_file.endswith("1.csv") and row.ingested_at is not None


CUSTOMER_HEADER = (
    "customer_id,name,dob,gender,city,join_date,status,email,phone_number,preferred_channel,occupation,"
    "income_range,risk_segment\n"
)


def customer_line(key, city):
    return f"{key},n{key},1990-01-01,M,{city},2020-01-01,active,u{key}@b.com,+44 {key:010d},atm,o,low,low"


def test_bank_chain_twice(spark, tmp_path):
    """A second run takes the new files only and brings every layer up to date."""
    customers, accounts = f"{tmp_path}/customers", f"{tmp_path}/accounts"
    csv(customers, "1.csv", customer_line(1, "a"), customer_line(2, "b"), header=CUSTOMER_HEADER)
    csv(accounts, "1.csv", "10,1,s,1.0,100,2024-01-02,credit,2.5,atm", "20,2,s,1.0,101,2024-01-02,debitt,4,online")
    root = f"{tmp_path}/root"
    t = runs.run_bank(spark, customers, accounts, root, as_of="2024-06-01")
    assert rows(t.read("gold_cust_acc_trans_agg"), "customer_id", "txn_count", "total_credits", "total_debits") == [
        (1, 1, 2.5, 0.0),
        (2, 1, 0.0, 4.0),
    ]
    csv(customers, "2.csv", customer_line(1, "moved"), header=CUSTOMER_HEADER)
    csv(accounts, "2.csv", "10,1,s,1.0,102,2024-01-03,credit,1.5,atm")
    t = runs.run_bank(spark, customers, accounts, root, as_of="2024-06-01")
    assert t.read("landing_customers_incremental").count() == 3
    # The transactions of customer 1 now meet both of its deliveries.
    assert rows(t.read("gold_cust_acc_trans_agg"), "customer_id", "city", "txn_count") == [
        (1, "A", 2),
        (1, "MOVED", 2),
        (2, "B", 1),
    ]
    current = current_rows(spark, t.path("silver_customers_transformed_scd1"), bank.customers_cdc())
    assert rows(current, "customer_id", "city") == [(1, "MOVED"), (2, "B")]
    assert "transformation_date" not in current.columns
    versions = history(spark, t.path("silver_accounts_transactions_transformed_scd2"), bank.transactions_cdc())
    assert versions.filter("is_current").count() == 3


@pytest.mark.parametrize("kind", [TYPE_1, TYPE_2])
def test_new_columns_are_kept_and_changed_types_rejected(spark, tmp_path, kind):
    cdc = Cdc("k", "s")
    target = f"{tmp_path}/t"
    backfill(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, s int, a string"), cdc, kind, target, "narrow")
    backfill(spark.createDataFrame([(1, 2, "c", 7)], "k int, s int, a string, b int"), cdc, kind, target, "wide")
    got = current_rows(spark, target, cdc) if kind == TYPE_1 else history(spark, target, cdc).filter("is_current")
    assert rows(got, "k", "s", "a", "b") == [(1, 2, "c", 7), (2, 1, "b", None)]
    whole = (current_rows if kind == TYPE_1 else history)(spark, target, cdc)
    with pytest.raises(ValueError, match="cannot merge"):
        backfill(spark.createDataFrame([(3, 3, True, 1)], "k int, s int, a boolean, b int"), cdc, kind, target, "other")
    assert same_rows((current_rows if kind == TYPE_1 else history)(spark, target, cdc).filter("k < 3"), whole)


def test_key_condition_of_a_history_reaches_the_files(spark, tmp_path):
    cdc, target = Cdc("k", "s"), f"{tmp_path}/t"
    data = spark.createDataFrame([(k % 5, k, str(k)) for k in range(50)], "k int, s int, a string")
    backfill(data, cdc, TYPE_2, target)
    one = history(spark, target, cdc, where="k = 3")
    assert "EqualTo(k,3)" in plan(one)
    assert same_rows(one, history(spark, target, cdc).filter("k = 3"))
    with pytest.raises(Exception, match="(?i)resolve|column"):
        history(spark, target, cdc, where="a = '3'")


# --- rules on streams -------------------------------------------------------

RULES = rules({"has_k": "k IS NOT NULL", "early": "seq < 500"}, DROP) + rules({"has_a": "a IS NOT NULL"}, WARN)


def checked(spark, tmp_path, **options):
    finish(write_checked(feed(spark, f"{tmp_path}/in"), RULES, path=f"{tmp_path}/t", checkpoint=f"{tmp_path}/c", **options))


def test_rows_failing_rows_and_counts_of_one_pass(spark, tmp_path):
    data = [*changes(), (None, 600, None, "U"), (None, 1, "x", "U")]
    for n in range(3):
        put(spark, f"{tmp_path}/in", str(n), data[n::3])
    checked(spark, tmp_path, comment="numbers")
    whole = spark.createDataFrame(data, SCHEMA)
    path = f"{tmp_path}/t"
    assert same_rows(read_checked(spark, path), expect(whole, RULES))
    assert same_rows(quarantined(spark, path), quarantine(whole, RULES))
    assert same_rows(rule_totals(spark, path), quality_report(whole, RULES))
    assert declared(spark, path).comment == "numbers" and declared(spark, path).rules == RULES
    onwards = stream_checked(spark, path)
    finish(write_stream(onwards, path=f"{tmp_path}/next", checkpoint=f"{tmp_path}/c2"))
    assert same_rows(spark.read.parquet(f"{tmp_path}/next"), expect(whole, RULES))


def test_a_batch_stored_in_part_is_stored_again_whole(spark, tmp_path, monkeypatch):
    """The query dies after the failing rows are in place; the replay neither loses nor doubles anything."""
    data = changes(200)
    put(spark, f"{tmp_path}/in", "0", [(None, 1, "x", "U"), *data])
    put_folder = quality_streams._Folders.put
    with monkeypatch.context() as m:
        m.setattr(quality_streams._Folders, "put", lambda self, new, to: 1 / 0 if "/rows/" in to else put_folder(self, new, to))
        with pytest.raises(Exception, match="division"):
            checked(spark, tmp_path)
    assert read_checked(spark, f"{tmp_path}/t").isEmpty()
    checked(spark, tmp_path)
    whole = spark.createDataFrame([(None, 1, "x", "U"), *data], SCHEMA)
    assert same_rows(read_checked(spark, f"{tmp_path}/t"), expect(whole, RULES))
    assert same_rows(quarantined(spark, f"{tmp_path}/t"), quarantine(whole, RULES))
    assert same_rows(rule_totals(spark, f"{tmp_path}/t"), quality_report(whole, RULES))
    # The batch is there: a lost checkpoint replays it to no effect.
    finish(write_checked(feed(spark, f"{tmp_path}/in"), RULES, path=f"{tmp_path}/t", checkpoint=f"{tmp_path}/other"))
    assert read_checked(spark, f"{tmp_path}/t").count() == expect(whole, RULES).count()


def test_a_declared_table_with_rules_reads_as_empty(spark, tmp_path):
    path = f"{tmp_path}/t"
    declare_checked(spark, path, Declared(spark.createDataFrame([], SCHEMA).schema, RULES, "to come"))
    assert read_checked(spark, path).isEmpty() and quarantined(spark, path).isEmpty() and rule_totals(spark, path).isEmpty()
    assert declared(spark, path).comment == "to come"
    # A stream over it starts before there is anything to take.
    finish(write_stream(stream_checked(spark, path), path=f"{tmp_path}/next", checkpoint=f"{tmp_path}/c2"))
    put(spark, f"{tmp_path}/in", "0", changes(20))
    checked(spark, tmp_path)
    finish(write_stream(stream_checked(spark, path), path=f"{tmp_path}/next", checkpoint=f"{tmp_path}/c2"))
    assert spark.read.parquet(f"{tmp_path}/next").count() == 20


def test_one_scan_per_source_in_the_bank_chain(spark, tmp_path, monkeypatch):
    """Malformed lines, failing rows and counts come from the query that stores the rows."""
    customers, accounts = f"{tmp_path}/customers", f"{tmp_path}/accounts"
    csv(customers, "1.csv", customer_line(1, "a"), "x,y", customer_line(2, "b").replace("1990-01-01", "1990-31-31"), header=CUSTOMER_HEADER)
    csv(accounts, "1.csv", "10,1,s,1.0,100,2024-01-02,credit,2.5,atm", "20,1,s,1.0,101,2024-01-02,debitt,much,online", "20,1,s,1.0,,2024-01-02,debitt,1,online")
    started = []
    start = DataStreamWriter.start
    monkeypatch.setattr(DataStreamWriter, "start", lambda self, *a, **k: started.append(1) or start(self, *a, **k))
    t = runs.run_bank(spark, customers, accounts, f"{tmp_path}/root", as_of="2024-06-01")
    # Landing, rules, silver, change tables and gold totals, of customers and of transactions.
    assert len(started) == 10
    assert rows(t.read("bronze_customers_clean"), "customer_id") == [(1,)]
    assert "malformed_line" not in t.read("bronze_customers_clean").columns
    lines = rows(t.quarantine("bronze_customers_clean"), "malformed_line", F.col("failed_rules")[0])
    assert [x[1] for x in lines] == ["well_formed"] * 2 and {x[0][:4] for x in lines} == {"x,y", "2,n2"}
    assert rows(t.read("bronze_accounts_clean"), "txn_id") == [(100,)]
    failed = t.quarantine("bronze_accounts_clean")
    assert rows(failed, F.concat_ws(",", "failed_rules")) == [("valid_txn_id",), ("well_formed,valid_txn_amount",)]
    totals = {r.rule: (r.passed, r.violations) for r in t.quality("bronze_accounts_clean").collect()}
    assert totals["well_formed"] == (2, 1) and totals["valid_txn_id"] == (2, 1) and totals["valid_balance"] == (3, 0)


def test_late_rows_are_set_aside_and_rows_on_time_all_arrive(spark, tmp_path):
    """Rows behind the newest of earlier batches less the delay; a batch without times changes nothing."""
    at = lambda minute: None if minute is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)
    batches = [[0, 100, 50], [40, 39, 200, None], [None], [139, 140, 90], [300]]
    for n, minutes in enumerate(batches):
        rows_ = [(10 * n + k, at(m)) for k, m in enumerate(minutes)]
        spark.createDataFrame(rows_, "id int, ts timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    stream = stream_parquet(spark, f"{tmp_path}/in/*", "id int, ts timestamp_ntz", max_files=1)
    path = f"{tmp_path}/t"
    finish(write_on_time(stream, "ts", "1 hour", path=path, checkpoint=f"{tmp_path}/c"))
    assert rows(read_checked(spark, path), "id") == [(0,), (1,), (2,), (10,), (12,), (31,), (40,)]
    assert rows(quarantined(spark, path), "id") == [(11,), (13,), (20,), (30,), (32,)]
    once = dedup_within_watermark(stream_checked(spark, path), ["id"], "ts", "1 hour")
    finish(write_stream(once, path=f"{tmp_path}/once", checkpoint=f"{tmp_path}/c2"))
    assert spark.read.parquet(f"{tmp_path}/once").count() == 7


def test_storing_a_batch_sorts_no_rows(spark, tmp_path):
    """A task writes rows on time and late ones side by side, so its memory does not grow with its rows."""
    times = spark.range(1000).select("id", F.timestamp_seconds(F.when(F.col("id") % 7 != 0, F.col("id") * 60)).alias("ts"))
    times.coalesce(1).write.parquet(f"{tmp_path}/in")
    path = f"{tmp_path}/t"
    finish(write_on_time(stream_parquet(spark, f"{tmp_path}/in", times.schema), "ts", "1 hour", path=path, checkpoint=f"{tmp_path}/c"))
    assert read_checked(spark, path).count() == 857 and quarantined(spark, path).count() == 143
    ran = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [ran.apply(k).physicalPlanDescription() for k in range(ran.size())]
    written = [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p and f"{path}/new/" in p and "_outcome" in p]
    assert len(written) == 1 and "Sort" not in written[0]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


# --- kept totals ------------------------------------------------------------

PEOPLE = "customer_id int, city string"
MOVES = "customer_id long, account_id long, txn_type string, txn_amount double, txn_channel string, txn_date date"


def moves(spark, r, n, customers):
    data = [
        (r.choice([0, 0, *range(customers), None]), r.randrange(5), r.choice(["CREDIT", "DEBIT", "UNKNOWN"]), r.choice([None, 1.25, 10.5]), r.choice(["ATM", "ONLINE", None]), dt.date(2024, 1, r.randrange(1, 29)))
        for _ in range(n)
    ]
    return spark.createDataFrame(data, MOVES)


def test_kept_totals_equal_those_of_the_whole(spark, tmp_path):
    """Batches of both streams in any order, repeated deliveries, replays, buckets that are divided."""
    r = random.Random(4)
    kept_totals = KeptTotals(spark, f"{tmp_path}/t", "customer_id", ["customer_id", "city"], CENTS, bucket_bytes=500)
    people = [spark.createDataFrame([(k, f"c{k % 3}") for k in range(n, 30, 3)] + [(0, "c0"), (None, "x")], PEOPLE) for n in range(3)]
    batches = [moves(spark, r, 80, 40) for _ in range(3)]
    kept_totals.declare(people[0].schema, batches[0].schema)
    assert kept_totals.read().isEmpty()
    for n in range(3):
        for _ in range(2):
            kept_totals.add(TOTALS, batches[n], "moves", n)
            kept_totals.add(CUSTOMERS, people[n], "people", n)
        whole = [reduce(DataFrame.unionAll, x[: n + 1]) for x in (people, batches)]
        expected_totals = joined_transaction_totals(*whole, "customer_id", ["customer_id", "city"], CENTS)
        assert same_rows(kept_totals.read(), expected_totals)
    last = kept_totals.table.last()
    assert last.flows == {"moves": 2, "people": 2} and last.bits > kept.FIRST_BITS
    assert "Exchange" not in plan(kept_totals.read())


def test_a_batch_of_totals_touches_its_customers_alone(spark, tmp_path):
    r = random.Random(5)
    kept_totals = KeptTotals(spark, f"{tmp_path}/t", "customer_id", ["customer_id", "city"], CENTS)
    people = spark.createDataFrame([(k, "c") for k in range(200)], PEOPLE)
    kept_totals.declare(people.schema, moves(spark, r, 1, 1).schema)
    kept_totals.add(CUSTOMERS, people, "people", 0)
    kept_totals.add(TOTALS, moves(spark, r, 900, 200), "moves", 0)
    kept_totals.add(TOTALS, moves(spark, r, 5, 1).filter("customer_id = 0"), "moves", 1)
    number = kept_totals.table.last().number
    assert len(written(f"{tmp_path}/t", number)[1]) == 1
    assert {f.part for f in kept_totals.table.folders() if f.load == number} == {"totals", "result"}
    with pytest.raises(ValueError, match="declare"):
        KeptTotals(spark, f"{tmp_path}/other", "customer_id", ["customer_id"]).add(CUSTOMERS, people, "people", 0)
