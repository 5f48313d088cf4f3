from pyspark.sql import Window
from pyspark.sql import functions as F

from stellate.operators import ordinal


def test_global_ordinal_matches_row_number(spark):
    df = spark.range(15000).select((F.col("id") * 7919 % 15013).alias("k")).repartition(5)
    got = ordinal.global_ordinal(df, ["k"])
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("k")))
    assert got.count() == 15000
    assert got.join(want, ["k", "rn"], "left_anti").count() == 0


def test_no_window_over_the_rows_themselves(spark):
    """Only the offsets, one row for each partition, meet in one task."""
    df = spark.range(1000).select(F.col("id").alias("k"))
    plan = ordinal.global_ordinal(df, ["k"], num_partitions=6)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange SinglePartition") <= 1
    windowed = text[text.index("Window") :]
    assert "BroadcastExchange" in text and "count" in windowed  # the window stands above the counts


def test_rows_equal_in_all_columns_spread(spark):
    df = spark.range(3000).select(F.lit(0).alias("k")).unionByName(spark.range(1, 6001).select(F.col("id").cast("int").alias("k")))
    got = ordinal.global_ordinal(df, ["k"], num_partitions=8)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 2000
    assert [r.rn for r in got.orderBy("rn").collect()] == list(range(1, 9001))


def test_ordinal_composite_keys_nulls_last(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 0), ("a", 1)], "x string, y int")
    got = [(r.x, r.y, r.rn) for r in ordinal.global_ordinal(df, ["x", "y"], num_partitions=3).orderBy("rn").collect()]
    assert got == [("a", 1, 1), ("a", 2, 2), ("b", 1, 3), (None, 0, 4)]


def test_slices_cover_once(spark):
    df = ordinal.global_ordinal(spark.range(105).select(F.col("id").alias("k")), ["k"])
    bounds = ordinal.batch_bounds(105, 20)
    assert bounds[0] == (1, 20) and bounds[-1] == (101, 105)
    sizes = [ordinal.slice_between(df, lo, hi).count() for lo, hi in bounds]
    assert sizes == [20, 20, 20, 20, 20, 5]
    src = spark.range(105).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert ordinal.batch_of(df, src, ["k"], 21, 40).count() == 20


def test_hot_key_spreads_over_partitions(spark):
    hot = spark.range(3000).select(F.lit(0).alias("k"), F.col("id").alias("v"))
    rest = spark.range(1, 6001).select(F.col("id").alias("k"), F.col("id").alias("v"))
    df = hot.unionByName(rest)
    got = ordinal.global_ordinal(df, ["k"], num_partitions=8)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 3000  # the hot key is not all in one partition
    rows = got.orderBy("rn").select("k", "rn").collect()
    assert [r.rn for r in rows] == list(range(1, 9001))
    ks = [r.k for r in rows]
    assert ks == sorted(ks) and ks[:3000] == [0] * 3000
