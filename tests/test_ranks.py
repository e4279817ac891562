"""Exact percentiles against Spark's own aggregate, bit for bit."""

import pytest
from pyspark.sql import functions as F

from loomtab.operators import ranks


def values(df, column="p"):
    return {tuple(r)[:-1]: r[column] for r in df.collect()}


@pytest.fixture(scope="module")
def mixed(spark):
    """A hot group of distinct doubles, one of few values with many copies, one of very uneven sizes, small ones, a NULL group."""
    g = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 5 == 0, "copies").when(F.col("id") % 7 == 0, "uneven").when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("s"), F.col("id") % 41))
    x = (F.xxhash64("id") / 1e13).cast("double")
    v = F.when(g == "copies", F.floor(x) % 3).when(g == "uneven", F.exp(x % 300)).when(F.col("id") % 997 == 0, F.lit(None)).otherwise(x)
    return spark.range(60_000).select(g.alias("g"), (F.col("id") % 2).alias("h"), v.cast("double").alias("v")).cache()


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.999, 1.0])
def test_same_bits_as_spark(mixed, q):
    want = values(mixed.groupBy("g").agg(F.percentile("v", q).alias("p")))
    assert values(ranks.exact_percentile(mixed, ["g"], "v", q, "p", limit=500)) == want and len(want) > 40


def test_whole_table_and_two_groups(mixed):
    assert values(ranks.exact_percentile(mixed, [], "v", 0.5, "p", limit=300)) == values(mixed.agg(F.percentile("v", 0.5).alias("p")))
    assert values(ranks.exact_percentile(mixed, ["h", "g"], "v", 0.9, "p", limit=300)) == values(mixed.groupBy("h", "g").agg(F.percentile("v", 0.9).alias("p")))


def test_plain_aggregate_where_groups_are_small(mixed):
    plan = ranks.exact_percentile(mixed, ["g"], "v", 0.5, "p")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_odd_values(spark):
    """Defined cases: no rows, NULLs alone, NaN and infinities, one value throughout."""
    none = spark.createDataFrame([], "g string, v double")
    assert ranks.exact_percentile(none, ["g"], "v", 0.5, "p").count() == 0
    assert ranks.exact_percentile(spark.createDataFrame([("a", None)], "g string, v double"), ["g"], "v", 0.5, "p").count() == 0
    odd = spark.range(900).select(F.lit("a").alias("g"), F.when(F.col("id") < 300, F.lit(float("-inf"))).when(F.col("id") < 600, F.col("id").cast("double")).otherwise(F.lit(float("nan"))).alias("v"))
    for q in (0.1, 0.5, 0.6):
        assert values(ranks.exact_percentile(odd, ["g"], "v", q, "p", limit=50)) == values(odd.groupBy("g").agg(F.percentile("v", q).alias("p")))
    same = spark.range(1000).select(F.lit(1).alias("g"), F.lit(2.5).alias("v"))
    assert values(ranks.exact_percentile(same, ["g"], "v", 0.3, "p", limit=10)) == {(1,): 2.5}


def test_millions_of_distinct_values(spark):
    """One group of three million doubles with the limit as it is: the buffers hold a grid, or LIMIT values."""
    df = spark.range(3_000_000).select(F.lit(1).alias("g"), (F.xxhash64("id") / 3.0).alias("v"))
    assert values(ranks.exact_percentile(df, ["g"], "v", 0.5, "p")) == values(df.groupBy("g").agg(F.percentile("v", 0.5).alias("p")))
