import random

import pytest
from pyspark.sql import functions as F

from terrace.operators.cdc import Cdc, require_unique_sequence, scd1, scd1_merge, scd1_rows, scd1_state, scd2, sequence_ties
from tests.helpers import plan, rows, same_rows

SCHEMA = "k int, seq int, a string, b int, op string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def random_changes(seed, n=400, keys=7):
    r = random.Random(seed)
    data = [
        (
            # One key holds about a third of the changes.
            0 if r.random() < 0.33 else r.randrange(1, keys),
            seq,
            r.choice(["x", "y", None]),
            r.choice([1, 2, None]),
            "D" if r.random() < 0.1 else "U",
        )
        for seq in range(n)
    ]
    r.shuffle(data)
    return data


# --- brute force ------------------------------------------------------------


def by_key(data):
    out = {}
    for row in sorted(data, key=lambda row: row[1]):
        out.setdefault(row[0], []).append(row)
    return out


def filled(changes, ignore_nulls):
    """Changes with the values in force after each: NULLs replaced if they are to be ignored."""
    a = b = None
    for _, seq, na, nb, op in changes:
        if op == "D":
            a = b = None
            yield seq, None, None, True
            continue
        a = a if ignore_nulls and na is None else na
        b = b if ignore_nulls and nb is None else nb
        yield seq, a, b, False


def brute_scd1(data, deletes=False, ignore_nulls=False):
    out = []
    for key, changes in by_key(data).items():
        if not deletes:
            changes = [(*c[:4], "U") for c in changes]
        seq, a, b, gone = list(filled(changes, ignore_nulls))[-1]
        if not gone:
            out.append((key, seq, a, b))
    return sorted(out, key=str)


def brute_scd2(data, deletes=False, ignore_nulls=False, track_b=True):
    out = []
    for key, changes in by_key(data).items():
        if not deletes:
            changes = [(*c[:4], "U") for c in changes]
        versions = []
        for seq, a, b, gone in filled(changes, ignore_nulls):
            mark = (gone, a, b if track_b else None)
            if versions and versions[-1]["mark"] == mark:
                versions[-1]["row"] = (a, b)
                continue
            if versions:
                versions[-1]["to"] = seq
            versions.append({"mark": mark, "row": (a, b), "from": seq, "to": None})
        out += [(key, *v["row"], v["from"], v["to"]) for v in versions if not v["mark"][0]]
    return sorted(out, key=str)


OPTIONS = [(d, i) for d in (False, True) for i in (False, True)]


@pytest.mark.parametrize(("deletes", "ignore_nulls"), OPTIONS)
def test_type_1_against_brute_force(spark, deletes, ignore_nulls):
    data = random_changes(1)
    cdc = Cdc("k", "seq", columns=["seq", "a", "b"], deletes="op = 'D'" if deletes else None, ignore_nulls=ignore_nulls)
    got = sorted(rows(scd1(frame(spark, data), cdc), "k", "seq", "a", "b"), key=str)
    assert got == brute_scd1(data, deletes, ignore_nulls)


@pytest.mark.parametrize("hot_rows", [None, 10, 60, 10_000])
@pytest.mark.parametrize(("deletes", "ignore_nulls"), OPTIONS)
def test_type_2_against_brute_force(spark, deletes, ignore_nulls, hot_rows):
    data = random_changes(2)
    cdc = Cdc(
        "k",
        "seq",
        columns=["a", "b"],
        deletes="op = 'D'" if deletes else None,
        ignore_nulls=ignore_nulls,
        hot_rows=hot_rows,
    )
    got = sorted(rows(scd2(frame(spark, data), cdc), "k", "a", "b", "valid_from", "valid_to"), key=str)
    assert got == brute_scd2(data, deletes, ignore_nulls)


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_untracked_columns_change_in_place(spark, hot_rows):
    data = random_changes(3)
    cdc = Cdc("k", "seq", columns=["a", "b"], track=["a"], deletes="op = 'D'", hot_rows=hot_rows)
    got = sorted(rows(scd2(frame(spark, data), cdc), "k", "a", "b", "valid_from", "valid_to"), key=str)
    assert got == brute_scd2(data, True, track_b=False)
    other = Cdc("k", "seq", columns=["a", "b"], track_except=["b"], deletes="op = 'D'", hot_rows=hot_rows)
    assert same_rows(scd2(frame(spark, data), other), scd2(frame(spark, data), cdc))


def test_null_and_composite_keys_in_slices(spark):
    data = [(None if k == 0 else k, *rest) for k, *rest in random_changes(4)]
    df = frame(spark, data)
    plain = Cdc(("k", "op"), "seq", columns=["a"])
    sliced = Cdc(("k", "op"), "seq", columns=["a"], hot_rows=15)
    assert same_rows(scd2(df, plain), scd2(df, sliced))


def test_ties_are_settled_the_same_way_everywhere_if_asked(spark):
    data = [(k, seq // 3, a, b, op) for k, seq, a, b, op in random_changes(5)]
    df = frame(spark, data)
    settled = {"columns": ["a", "b"], "ties": "values"}
    plain = scd2(df, Cdc("k", "seq", **settled))
    sliced = scd2(df.repartition(7), Cdc("k", "seq", **settled, hot_rows=9))
    assert same_rows(plain, sliced)
    current = scd1(df.repartition(3), Cdc("k", "seq", **settled))
    assert same_rows(plain.filter("is_current").select("k", "a", "b"), current.select("k", "a", "b"))


TIE = [(1, 5, "x", None, "U"), (1, 5, "y", None, "U")]


@pytest.mark.parametrize("hot_rows", [None, 1])
@pytest.mark.parametrize("options", [{}, {"ignore_nulls": True}, {"deletes": "op = 'D'"}])
def test_ties_are_an_error(spark, hot_rows, options):
    cdc = Cdc("k", "seq", columns=["a", "b"], hot_rows=hot_rows, **options)
    for apply in (scd1, scd2):
        with pytest.raises(Exception, match="changes tie on key and sequence.*1"):
            apply(frame(spark, [*TIE, (2, 1, "z", None, "U")]), cdc).collect()
        # Equal changes are one, and a tie in a column that is left out is none.
        assert rows(apply(frame(spark, [TIE[0], TIE[0]]), cdc), "k", "a") == [(1, "x")]
        assert rows(apply(frame(spark, TIE), Cdc("k", "seq", columns=["b"], hot_rows=hot_rows, **options)), "k") == [(1,)]
    with pytest.raises(ValueError, match="ties must be"):
        Cdc("k", "seq", ties="any")


def test_a_tie_among_old_changes_matters_to_type_2_alone(spark):
    data = [*TIE, (1, 9, "z", None, "U")]
    assert rows(scd1(frame(spark, data), Cdc("k", "seq", columns=["a"])), "a") == [("z",)]
    with pytest.raises(Exception, match="changes tie"):
        scd2(frame(spark, data), Cdc("k", "seq", columns=["a"])).collect()


def test_a_tie_between_merged_states_is_an_error(spark):
    cdc = Cdc("k", "seq", columns=["a"])
    one, other = (scd1_state(frame(spark, [t]), cdc) for t in TIE)
    with pytest.raises(Exception, match="changes tie"):
        scd1_rows(scd1_merge(one.unionByName(other), cdc), cdc).collect()


@pytest.mark.parametrize("sequence", ["seq", ("b", "seq"), "expression"])
def test_null_in_a_sequence_is_an_error(spark, sequence):
    sequence = F.col("seq") + 1 if sequence == "expression" else sequence
    data = [(1, 1, "x", 1, "U"), (2, None, "y", None, "U")]
    for apply in (scd1, scd2):
        with pytest.raises(Exception, match="NULL in its sequence.*2"):
            apply(frame(spark, data), Cdc("k", sequence, columns=["a"])).collect()


# --- properties -------------------------------------------------------------


def test_type_1_does_not_depend_on_order_split_or_replay(spark):
    data = random_changes(6)
    cdc = Cdc("k", "seq", columns=["a", "b"], deletes="op = 'D'", ignore_nulls=True)
    whole = scd1(frame(spark, data), cdc)
    parts = [data[:150], data[150:220], data[220:], data[150:220]]
    states = [scd1_state(frame(spark, p), cdc) for p in reversed(parts)]
    union = states[0]
    for s in states[1:]:
        union = union.unionByName(s)
    assert same_rows(scd1_rows(scd1_merge(union, cdc), cdc), whole)


def test_type_2_intervals(spark):
    df = frame(spark, random_changes(7))
    cdc = Cdc("k", "seq", columns=["a", "b"])
    versions = scd2(df, cdc)
    spans = {}
    for k, start, end in rows(versions, "k", "valid_from", "valid_to"):
        spans.setdefault(k, []).append((start, end))
    for of_key in spans.values():
        ordered = sorted(of_key)
        assert all(a[1] == b[0] for a, b in zip(ordered, ordered[1:]))
        assert [e for _, e in ordered].count(None) == 1
    assert same_rows(versions.filter("is_current").select("k", "a", "b"), scd1(df, cdc))


# --- hand-written cases -----------------------------------------------------


def test_late_update_does_not_revive_a_deleted_key(spark):
    df = frame(spark, [(1, 1, "a", 1, "U"), (1, 3, None, None, "D"), (1, 2, "b", 2, "U")])
    cdc = Cdc("k", "seq", columns=["a"], deletes="op = 'D'")
    assert rows(scd1(df, cdc)) == []
    assert rows(scd2(df, cdc), "a", "valid_from", "valid_to") == [("a", 1, 2), ("b", 2, 3)]


def test_same_value_before_and_after_a_delete_makes_two_versions(spark):
    df = frame(spark, [(1, 1, "a", 1, "U"), (1, 2, None, None, "D"), (1, 3, "a", 1, "U")])
    cdc = Cdc("k", "seq", columns=["a"], deletes="op = 'D'")
    assert rows(scd2(df, cdc), "a", "valid_from", "valid_to") == [("a", 1, 2), ("a", 3, None)]


def test_null_update(spark):
    df = frame(spark, [(1, 1, "a", 1, "U"), (1, 2, None, 2, "U")])
    assert rows(scd1(df, Cdc("k", "seq", columns=["a", "b"], ignore_nulls=True)), "a", "b") == [("a", 2)]
    assert rows(scd1(df, Cdc("k", "seq", columns=["a", "b"])), "a", "b") == [(None, 2)]


def test_unchanged_update_is_one_version(spark):
    df = frame(spark, [(1, 1, "a", 1, "U"), (1, 2, "a", 1, "U")])
    cdc = Cdc("k", "seq", columns=["a", "b"])
    assert rows(scd2(df, cdc), "valid_from", "valid_to", "is_current") == [(1, None, True)]


def test_truncate(spark):
    df = frame(
        spark, [(1, 1, "a", 1, "U"), (2, 5, "b", 1, "U"), (9, 3, None, None, "T"), (1, 2, "c", 1, "U"), (3, 3, "d", 1, "U")]
    )
    cdc = Cdc("k", "seq", columns=["a"], truncates="op = 'T'")
    assert rows(scd1(df, cdc)) == [(2, "b")]
    nulls = Cdc("k", "seq", columns=["a"], truncates="op = 'T'", ignore_nulls=True)
    later = df.unionByName(frame(spark, [(1, 6, None, 1, "U")]))
    assert rows(scd1(later, nulls)) == [(1, None), (2, "b")]
    with pytest.raises(ValueError, match="truncates"):
        scd2(df, cdc)


def test_sequence_may_be_excluded_or_an_expression(spark):
    df = frame(spark, random_changes(8))
    by_name = scd1(df, Cdc("k", "seq", except_columns=["seq", "op"]))
    assert by_name.columns == ["k", "a", "b"]
    assert same_rows(by_name, scd1(df, Cdc("k", F.col("seq") * 2, except_columns=["seq", "op"])))


def test_column_order_and_sequence_in_history(spark):
    df = frame(spark, [(1, 1, "a", 1, "U"), (1, 2, "a", 1, "U")])
    assert scd1(df, Cdc("k", "seq")).columns == ["k", "seq", "a", "b", "op"]
    # The sequence is no tracked column: it moves on in the open version.
    assert rows(scd2(df, Cdc("k", "seq")), "seq", "valid_from") == [(2, 1)]


def test_ties_are_reported(spark):
    df = frame(spark, [(1, 1, "a", 1, "U"), (1, 1, "b", 1, "U"), (2, 1, "c", 1, "U")])
    assert rows(sequence_ties(df, Cdc("k", "seq", columns=["a"])), "k", "n") == [(1, 2)]
    with pytest.raises(ValueError, match="tie"):
        require_unique_sequence(df, Cdc("k", "seq"))
    assert require_unique_sequence(df, Cdc("k", ("seq", "a"))) is df
    assert rows(scd1(df, Cdc("k", ("seq", "a"))), "k", "a") == [(1, "b"), (2, "c")]


@pytest.mark.parametrize(
    "bad",
    [
        {"columns": ["a"], "except_columns": ["b"]},
        {"track": ["a"], "track_except": ["b"]},
        {"columns": ["nope"]},
        {"except_columns": ["k"]},
        {"except_columns": ["a"], "track": ["a"]},
    ],
)
def test_contradictory_settings(spark, bad):
    with pytest.raises(ValueError):
        scd2(frame(spark, []), Cdc("k", "seq", **bad))


# --- plans ------------------------------------------------------------------


def test_type_1_combines_before_the_shuffle(spark):
    text = plan(scd1(frame(spark, random_changes(9)), Cdc("k", "seq")))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("Exchange") < text.index("partial_max")


@pytest.mark.parametrize("ignore_nulls", [False, True])
def test_hot_keys_are_searched_for_once(spark, monkeypatch, ignore_nulls):
    from terrace.operators import cdc as module

    calls = []
    find = module.find_hot_keys
    monkeypatch.setattr(module, "find_hot_keys", lambda *a: calls.append(a) or find(*a))
    scd2(frame(spark, random_changes(9)), Cdc("k", "seq", ignore_nulls=ignore_nulls, hot_rows=10)).count()
    assert len(calls) == 1


def test_type_1_result_is_partitioned_by_its_key(spark):
    df = scd1(frame(spark, random_changes(9)), Cdc("k", "seq"))
    assert plan(df.groupBy("k").agg(F.max("a"))).count("Exchange") == 1


def test_type_2_shuffles_and_sorts_once(spark):
    text = plan(scd2(frame(spark, random_changes(9)), Cdc("k", "seq", track=["a"], deletes="op = 'D'")))
    assert text.count("Exchange") == 1
    assert text.count("Sort [") == 1


def test_filter_on_the_key_of_a_history_reaches_the_scan(spark, tmp_path):
    frame(spark, random_changes(9)).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    text = plan(scd2(df, Cdc("k", "seq")).filter("k = 3"))
    assert "EqualTo(k,3)" in text
