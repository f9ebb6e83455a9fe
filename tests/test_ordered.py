import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from terrace.operators.ordered import SLICE, fill_forward, find_hot_keys, settle, split_hot_keys
from tests.helpers import plan, same_rows


@pytest.fixture()
def skewed(spark):
    """30,000 rows, a third of them of one key and many of those at the same instant."""
    return spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500 + 1).alias("k"),
        F.when(F.col("id") % 9 == 0, 77).otherwise(F.xxhash64("id") % 1000).alias("at"),
        F.col("id"),
        F.when(F.col("id") % 5 == 0, F.col("id")).alias("v"),
    )


def cut(df, hot_rows):
    hot = find_hot_keys(df, ["k"], hot_rows)
    return split_hot_keys(settle(df, hot), ["at", "id"], hot)


def test_slices_are_bounded_and_lose_nothing(skewed):
    split = cut(skewed, 1000)
    sizes = [r["count"] for r in split.hot.groupBy("k", SLICE).count().collect()]
    assert sum(sizes) == 10_000 and split.cold.count() == 20_000
    assert max(sizes) <= 2000 and len(sizes) >= 8
    assert {r.k for r in split.hot.select("k").distinct().collect()} == {0}


def test_many_slices_need_no_more_tasks_than_the_cluster_shuffles_into(spark, skewed):
    """A sample goes to the driver for every range partition, and a result for every task."""
    split = cut(skewed, 10)
    assert len(split.hot.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = {r["k"]: r for r in split.hot.groupBy("k", SLICE).count().groupBy("k").agg(F.max("count").alias("most"), F.count("*").alias("n")).collect()}
    assert max(r.most for r in sizes.values()) <= 10 and all(r.n > 1 for r in sizes.values()) and sizes[0].n >= 1000
    assert sizes.keys() == {r.k for r in skewed.groupBy("k").count().filter("count > 10").collect()}
    edge = F.struct("at", "id")
    spans = split.hot.filter("k = 0").groupBy(SLICE).agg(F.min(edge).alias("lo"), F.max(edge).alias("hi")).orderBy(SLICE).collect()
    assert all(a.hi < b.lo for a, b in zip(spans, spans[1:]))


def test_equal_rows_share_a_slice_also_where_ranges_are_divided(skewed):
    rows = skewed.select("k", "at").filter("k = 0")
    hot = find_hot_keys(rows, ["k"], 7)
    slices = split_hot_keys(settle(rows, hot), ["at"], hot).hot.groupBy("at").agg(F.count_distinct(SLICE).alias("n"))
    assert slices.agg(F.max("n")).first()[0] == 1


def test_slices_are_contiguous_in_order(skewed):
    split = cut(skewed, 1000)
    edge = F.struct("at", "id")
    spans = split.hot.groupBy(SLICE).agg(F.min(edge).alias("lo"), F.max(edge).alias("hi")).orderBy(SLICE).collect()
    assert all(a.hi < b.lo for a, b in zip(spans, spans[1:]))


def test_filled_values_do_not_depend_on_slices(skewed):
    so_far = Window.partitionBy("k").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0)
    expected = skewed.withColumn("last", F.last("v", ignorenulls=True).over(so_far))
    for hot_rows in (None, 700):
        assert same_rows(fill_forward(skewed, ["k"], ["at", "id"], {"last": F.col("v")}, hot_rows), expected)


def test_a_tiny_file_that_explodes_to_one_hot_key_is_sliced(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    rows = stored.select(F.lit(1).alias("k"), F.explode(F.sequence(F.lit(1), F.lit(50_000))).alias("at"))
    rows = rows.withColumn("id", F.col("at"))
    sizes = [r["count"] for r in cut(rows, 10_000).hot.groupBy(SLICE).count().collect()]
    assert sum(sizes) == 50_000 and max(sizes) <= 20_000


def test_hot_and_cold_keys_share_one_evaluation(skewed):
    split = cut(skewed.withColumn("loaded", F.current_timestamp()), 1000)
    loaded = split.cold.select("loaded").unionByName(split.hot.select("loaded")).distinct()
    assert loaded.count() == 1


def test_no_hint_forces_a_broadcast(spark, skewed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan(fill_forward(skewed, ["k"], ["at", "id"], {"last": F.col("v")}, 700))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
