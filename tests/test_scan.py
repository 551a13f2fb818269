import random

from pyspark.sql import functions as F

from webglean.operators import scan
from webglean.operators.scan import numbered


def test_numbers_follow_the_order_over_ranges(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, *range(40)]), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    got = numbered(df, [F.col("a").desc_nulls_last(), F.col("b").asc()])
    assert got.columns == ["a", "b", "position"]
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert [(r.a, r.b) for r in got.orderBy("position").collect()] == want
    assert [r.position for r in got.orderBy("position").collect()] == list(range(1, 5001))


def test_no_rows_and_equal_rows(spark):
    empty = spark.createDataFrame([], "a int")
    assert numbered(empty, ["a"], "n").collect() == []
    equal = spark.createDataFrame([(1,)] * 300, "a int")
    assert sorted(r.n for r in numbered(equal, ["a"], "n").collect()) == list(range(1, 301))


def test_blocks_stay_few_where_they_would_be_short(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("key"), F.col("id").alias("seq"))
    few = scan.BLOCKS_PER_CORE * spark.sparkContext.defaultParallelism
    split = scan.split_hot(df, ["key"], 1)
    assert split.blocks == few
    assert scan.split_hot(df, ["key"], 1000).blocks == 3
    blocked = scan.ordered_blocks(split.hot, ["key"], ["seq"], split.blocks)
    assert blocked.count() == 3000
    # Every key is still cut.
    assert all(r["n"] > 1 for r in blocked.groupBy("key").agg(F.count_distinct("_block").alias("n")).collect())
