"""The skewed join against brute force, with slices small enough that heavy keys are really split."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from refsync.operators.skew import hot_keys, skewed_join
from refsync.operators.sync import latest_wins, with_key_count


def rows(count, share, seed):
    r = random.Random(seed)

    def key():
        x = r.random()
        return "hot" if x < share else None if x < share + 0.1 else f"k{r.randint(0, 8)}"

    return [(key(), r.randint(0, 3)) for _ in range(count)]


def expected(left, right, how, null_safe):
    result = Counter()
    for k, a in left:
        matches = [b for j, b in right if k == j and (null_safe or k is not None)]
        if how == "inner":
            result.update((k, a, b) for b in matches)
        elif how == "left":
            result.update([(k, a, b) for b in matches] or [(k, a, None)])
        elif bool(matches) == (how == "left_semi"):
            result[(k, a)] += 1
    return result


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("slices", [4, 1_000_000])
def test_same_rows_as_the_plain_join(spark, how, null_safe, slices):
    left, right = rows(60, 0.4, 3), rows(40, 0.3, 5)
    a = spark.createDataFrame(left, "k string, a int").repartition(3)
    b = spark.createDataFrame(right, "k string, b int").repartition(3)
    got = skewed_join(a, b, ["k"], how, null_safe=null_safe, rows_per_slice=slices)
    assert Counter(map(tuple, got.collect())) == expected(left, right, how, null_safe)


def test_heavy_keys_known_by_a_part_of_the_key(spark):
    left = [("hot", i % 3, i) for i in range(30)] + [("x", 0, 99)]
    right = [("hot", 0, "a"), ("hot", 0, "b"), ("hot", 2, "c"), ("y", 0, "d")]
    a = spark.createDataFrame(left, "k string, p int, a int").repartition(2)
    b = spark.createDataFrame(right, "k2 string, p2 int, b string")
    heavy = hot_keys(a, ["k"], rows_per_slice=5)
    assert [tuple(r) for r in heavy.table.collect()] == [("hot", 6)]
    got = skewed_join(a, b, ["k", "p"], "left", right_keys=["k2", "p2"], hot_left=heavy, rows_per_slice=1)
    want = Counter()
    for k, p, x in left:
        want.update([(k, p, x, t) for j, q, t in right if (j, q) == (k, p)] or [(k, p, x, None)])
    assert Counter(map(tuple, got.collect())) == want


def test_a_heavy_key_is_spread_over_tasks(spark):
    left = spark.range(0, 40_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit("same").alias("v")
    )
    right = left.groupBy("k").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = skewed_join(left, right, ["k"], "left", right_unique=True, rows_per_slice=1_000)
        sizes = joined.filter("k = 0").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in sizes) == 13_334
    assert len(sizes) == 4  # all shuffle partitions take a part, though the rows of the key are exact copies


def test_key_count_of_a_heavy_key(spark):
    data = [("hot", 1)] * 20 + [("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2)]
    df = spark.createDataFrame(data, "k string, v int").repartition(3)
    got = Counter((r["k"], r["n"]) for r in with_key_count(df, ["k"], "n", rows_per_slice=3).collect())
    assert got == {("hot", 20): 20, ("a", 2): 2, ("b", 1): 1, (None, 2): 2}


def test_latest_wins_keeps_one_row_per_key_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = latest_wins(df, ["k"], "v", [])._jdf.queryExecution().executedPlan().toString()
    partial, final = plan.index("Partial"), plan.index("Final")
    assert final < plan.index("Exchange") < partial


def test_unknown_join_type_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="unsupported"):
        skewed_join(df, df, ["k"], "full")
    with pytest.raises(ValueError, match="both sides"):
        skewed_join(df, df, ["k"], "inner")
