"""Joins with keys that hold a large part of the rows."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tristrata.operators import heavy_keys, skewed_join
from tristrata.operators.join import grid, grids


def counted(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def sides(spark):
    """A third of either side has key 7; some keys are NULL or on one side only; rows repeat."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 7).when(n % 17 == 0, None).otherwise(n % 400)
    large = spark.range(6000).select(key.cast("long").alias("k"), (n % 50).alias("a"))
    key = F.when(n % 3 == 0, 7).when(n % 13 == 0, None).otherwise(n % 500)
    small = spark.range(300).select(key.cast("long").alias("k"), n.alias("b"))
    return large, small


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("most", [0, 64 << 20])
def test_results_do_not_depend_on_the_way(sides, how, most):
    large, small = sides
    joined = skewed_join(large, small, "k", how=how, max_broadcast_bytes=most)
    assert joined.columns == ["k", "a", "b"]
    left, right = large.toPandas(), small.toPandas()
    side = "JOIN" if how == "inner" else "LEFT JOIN"
    sql = f"SELECT l.k, a, b FROM left_ l {side} right_ r ON l.k = r.k"
    connection = duckdb.connect()
    connection.register("left_", left.astype({"k": "Int64"}))
    connection.register("right_", right.astype({"k": "Int64"}))
    assert counted(joined) == Counter(connection.execute(sql).fetchall())


def test_heavy_keys_are_found_by_their_share(spark, sides):
    found = heavy_keys(sides[0], "k", 1 / 20)
    rows = sides[0].where("k = 7").count()
    assert found == {7: rows} and rows >= 2000
    assert heavy_keys(sides[0].limit(0), "k") == {}
    assert heavy_keys(sides[0].where("k is null"), "k") == {}
    text = sides[0].select(F.col("k").cast("string").alias("k"))
    assert heavy_keys(text, "k", 1 / 20) == {"7": rows}
    assert heavy_keys(spark.range(5000).withColumnRenamed("id", "k"), "k") == {}


def test_no_task_joins_much_more_than_the_others(spark):
    """One key with a third of both sides: rows of the result in each task of the last stage."""
    n = F.col("id")
    key = F.when(n % 3 == 0, -1).otherwise(n)
    large = spark.range(6000).select(key.cast("long").alias("k"), n.alias("a"))
    small = spark.range(900).select(key.cast("long").alias("k"), n.alias("b"))
    joined = skewed_join(large, small, "k", max_broadcast_bytes=0)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = skewed_join(large, small, "k", max_broadcast_bytes=0).where("k = -1")
        sizes = sorted(r["count"] for r in hot.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 2000 * 300 and joined.count() == 2000 * 300 + 600
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_heavy_rows_are_broadcast_to_or_dealt(sides, plan):
    large, small = sides
    assert "BroadcastHashJoin" in plan(skewed_join(large, small, "k"))
    dealt = plan(skewed_join(large, small, "k", max_broadcast_bytes=0))
    assert "RoundRobinPartitioning" in dealt


@pytest.mark.parametrize("how", ["inner", "left"])
def test_copies_of_dealt_rows_are_never_broadcast(spark, how):
    """All keys are heavy, so nothing but the dealt rows is joined; both sides look small."""
    n = F.col("id")
    large = spark.range(6000).select((n % 3).alias("k"), n.alias("a"))
    small = spark.range(300).select((n % 3).alias("k"), n.alias("b"))
    joined = skewed_join(large, small, "k", how=how, max_broadcast_bytes=0)
    copied = joined.where("k = 1")
    assert copied.count() == 2000 * 100
    operators = copied._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = [x for x in operators if "_cell" in x and "Join" in x]
    assert dealt and all("SortMergeJoin" in x for x in dealt)


def test_a_grid_copies_fewer_rows_of_the_larger_side():
    assert grid(1000, 1000, 64) == (8, 8)
    down, across = grid(100_000, 10, 64)
    assert (down, across) == (64, 1)
    assert grid(0, 0, 64)[0] >= 1


def shuffled_mb(spark, df):
    sc = spark.sparkContext._jsc.sc()

    def written():
        sc.listenerBus().waitUntilEmpty()
        return sc.statusStore().executorSummary("driver").totalShuffleWrite() / 1e6

    before = written()
    df.write.format("noop").mode("overwrite").save()
    return written() - before


def test_disk_follows_the_rows_whatever_the_partitions(spark):
    """Copies of 25 heavy keys, one with a third of the rows, at few and many partitions."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 0).otherwise(n % 25).cast("int").alias("k")

    def moved(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            large = spark.range(30_000).select(key, n.alias("a"))
            small = spark.range(3000).select(key, n.alias("b"))
            return shuffled_mb(spark, skewed_join(large, small, "k", max_broadcast_bytes=0))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")

    few, many = moved("8"), moved("160")
    plain = shuffled_mb(spark, spark.range(33_000).select(key, n.alias("a")).repartition(8, "k"))
    assert many <= 2 * few and few <= 8 * plain


def test_cells_are_shared_out_by_pairs():
    of_equals = grids(dict.fromkeys(range(64), 1000), dict.fromkeys(range(64), 1000), 16)
    assert {down * across for down, across in of_equals.values()} == {2}
    one_in_front = grids({"a": 1000, "b": 10}, {"a": 1000, "b": 10}, 8)
    assert one_in_front == {"a": (8, 8)}
    down, across = grids({"a": 1000, "b": 10}, {"a": 1000, "b": 10}, 8, "left")["a"]
    assert (down, across) == (64, 1)
    rows_without_pairs = grids({"a": 10, "b": 1000}, {"a": 100_000}, 8)
    assert rows_without_pairs["b"][0] >= 8


@pytest.mark.parametrize("how", ["inner", "left"])
def test_keys_with_grids_of_several_shapes(spark, how):
    """Heavy keys of unlike size, one without a partner, beside light and NULL ones."""
    n = F.col("id")
    key = F.when(n % 2 == 0, "a").when(n % 5 == 0, "b").when(n % 7 == 0, "c").when(n % 11 == 0, "d")
    large = spark.range(3000).select(key.alias("k"), n.alias("a"))
    key = F.when(n % 3 == 0, "a").when(n % 5 < 3, "b").when(n % 7 == 0, "d").otherwise("e")
    small = spark.range(400).select(key.alias("k"), (n % 40).alias("b"))
    joined = skewed_join(large, small, "k", how=how, max_broadcast_bytes=0)
    assert counted(joined) == counted(large.join(small, "k", how))


def test_other_ways_to_join_raise(sides):
    with pytest.raises(ValueError):
        skewed_join(*sides, "k", how="outer")
