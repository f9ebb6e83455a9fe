import pytest

from terrace import session
from terrace.operators.datasets import comment_of, preview, save_table, save_view
from terrace.plans import BANK, SALES, USERS, bank
from terrace.sources import scan_table, select_all, stream_parquet, stream_table
from terrace.streaming import finish, write_stream
from tests.helpers import rows


def test_dataset_names_and_comments():
    assert BANK["gold_cust_acc_trans_agg"] is bank.gold_cust_acc_trans_agg
    assert list(SALES)[-1] == "business_sales"
    assert all(comment_of(f) for group in (BANK, SALES, USERS) for f in group.values())


@pytest.fixture()
def schema(spark, tmp_path):
    name = f"s_{abs(hash(str(tmp_path)))}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_tables_are_replaced_and_commented(spark, schema, capsys):
    save_table(spark.range(3), f"{schema}.t")
    df = save_table(spark.range(5), f"{schema}.t", "five o'clock")
    assert df.count() == 5
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {schema}.t").collect()}
    assert described["Comment"] == "five o'clock"
    preview(spark, [f"{schema}.t"], 2)
    assert "|        5|" in capsys.readouterr().out
    before = spark.catalog.currentDatabase()
    assert select_all(spark, schema, "t").count() == 5
    assert spark.catalog.currentDatabase() == before


def test_a_recomputation_that_fails_leaves_the_table_as_it_was(spark, schema):
    save_table(spark.range(3), f"{schema}.t")
    with pytest.raises(Exception, match="USER_RAISED_EXCEPTION|no good"):
        save_table(spark.range(5).selectExpr("CASE WHEN id = 4 THEN raise_error('no good') ELSE id END id"), f"{schema}.t")
    assert scan_table(spark, f"{schema}.t").count() == 3
    doubled = scan_table(spark, f"{schema}.t")
    assert save_table(doubled.unionByName(doubled), f"{schema}.t").count() == 6


def test_a_folder_that_cannot_be_replaced_stays(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t")
    with pytest.raises(Exception):
        session.swap_in(spark, f"{tmp_path}/missing", f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3
    spark.range(5).write.parquet(f"{tmp_path}/new")
    session.swap_in(spark, f"{tmp_path}/new", f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 5


def test_view_over_a_stream_and_stream_over_a_table(spark, schema, tmp_path):
    spark.range(4).write.parquet(f"{tmp_path}/in")
    view = save_view(stream_parquet(spark, f"{tmp_path}/in", "id long"), "a_view")
    assert view.isStreaming and scan_table(spark, "a_view").isStreaming
    finish(write_stream(view, table=f"{schema}.copy", checkpoint=f"{tmp_path}/c1"))
    finish(write_stream(stream_table(spark, f"{schema}.copy"), table=f"{schema}.again", checkpoint=f"{tmp_path}/c2"))
    assert rows(scan_table(spark, f"{schema}.again")) == [(0,), (1,), (2,), (3,)]


def test_work_folder_setting_comes_first(spark, tmp_path, monkeypatch):
    # The real setting is fixed when the application starts.
    monkeypatch.setattr(session, "WORK_DIR_SETTING", "terrace.test.dir")
    spark.conf.set(session.WORK_DIR_SETTING, f"{tmp_path}/shared/")
    try:
        assert session.new_work_dir(spark, "x").startswith(f"{tmp_path}/shared/x-")
        stored = session.materialize(spark.range(3), "kept")
        assert stored.count() == 3 and list((tmp_path / "shared").glob("kept-*"))
        session.release(spark)
        assert not list((tmp_path / "shared").glob("kept-*"))
    finally:
        spark.conf.unset(session.WORK_DIR_SETTING)
