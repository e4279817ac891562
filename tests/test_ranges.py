"""Windows over ranges of (group, order) against plain windows, with a group of half of the rows."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomtab.operators import checks, ranges, tables, values


@pytest.fixture(scope="module")
def hot(spark):
    """10,000 rows: group 'hot' has half of them, 'one' a row, NULL is a group too; the order has ties and NULLs."""
    group = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") == 1, "one").when(F.col("id") % 101 == 0, F.lit(None)).otherwise(F.concat(F.lit("g"), F.col("id") % 97))
    at = F.when(F.col("id") % 211 == 0, F.lit(None)).otherwise(F.col("id") * 7919 % 4001)
    return spark.range(10_000).select("id", group.alias("g"), at.alias("at"), (F.col("id") % 13).alias("v")).cache()


@pytest.fixture
def many(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_cuts_are_even_and_ascend(hot, many):
    parted = ranges._ranged(hot, "at", ["g"])
    sizes = {r["_part"]: r for r in parted.groupBy("_part").agg(F.count("*").alias("n"), F.min(F.struct("g", "_null", "at", "_tie")).alias("a"), F.max(F.struct("g", "_null", "at", "_tie")).alias("b"))
             .withColumns({"before": F.lag("b").over(W.orderBy("_part"))}).withColumn("ok", F.col("before").isNull() | (F.col("before") < F.col("a"))).collect()}
    assert len(sizes) == 16 and max(r["n"] for r in sizes.values()) < 3 * 10_000 / 16 and all(r["ok"] for r in sizes.values())
    assert parted.where("g = 'hot'").select("_part").distinct().count() >= 7


@pytest.mark.parametrize("by", [["g"], []])
def test_running_equals_a_plain_window(hot, many, by):
    columns = {"nth": ("count", F.lit(1)), "total": ("sum", F.col("v")), "mixed": ("xor", F.xxhash64("id")), "some": ("sum", F.when(F.col("v") > 9, F.col("v")))}
    got = ranges.running(hot, columns, "at", by)
    w = W.partitionBy(*by).orderBy(F.asc_nulls_last("at"), F.xxhash64("id", "g", "at", "v")).rowsBetween(W.unboundedPreceding, 0)
    want = hot.select("*", F.count(F.lit(1)).over(w).alias("nth"), F.sum("v").over(w).alias("total"), F.bit_xor(F.xxhash64("id")).over(w).alias("mixed"), F.sum(F.when(F.col("v") > 9, F.col("v"))).over(w).alias("some"))
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("ahead", [True, False])
def test_neighbours_equal_a_plain_window(hot, many, ahead):
    got = ranges.neighbour(hot, "v", "at", ["g"], ahead)
    w = W.partitionBy("g").orderBy(F.asc_nulls_last("at"), F.xxhash64("id", "g", "at", "v"))
    near = (F.lead if ahead else F.lag)("v").over(w)
    edge = (F.lead if ahead else F.lag)(F.lit(1)).over(w).isNull()
    want = hot.select("*", near.alias("_near"), edge.alias("_edge"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_checks_of_a_hot_group(spark, many):
    """Two defects in a group of half the rows, found as a plain window finds them; no range holds the group."""
    n = 4000
    df = spark.range(n).select((F.col("id") % 2).alias("g"), F.when(F.col("id").isin(1001, 2002), F.col("id") + 1).otherwise(F.col("id")).alias("a"), (F.col("id") + 2).alias("b"))
    assert sorted(r["a"] for r in checks.sequential_values(df, "a", 2, by=["g"]).collect()) == [1002, 1003, 2003, 2004]
    # 1003 takes the place of 1001's successor's start: the range before it ends at 1003, and 1002 starts after 1001
    plain = df.withColumn("n", F.lead("a").over(W.partitionBy("g").orderBy("a"))).where((F.col("a") >= F.col("b")) | (F.col("b") > F.col("n")))
    assert checks.mutually_exclusive_ranges(df, "a", "b", ["g"]).count() == plain.count()


def test_one_range_empty_and_constant(spark):
    """Defined cases: an empty table, one row, an order that is NULL throughout, copies of one row."""
    none = spark.createDataFrame([], "g string, at long, v long")
    assert ranges.running(none, {"n": ("count", F.lit(1))}, "at", ["g"]).count() == 0 and ranges.neighbour(none, "v", "at").count() == 0
    same = spark.createDataFrame([("a", None, 1)] * 5, "g string, at long, v long")
    assert sorted(r["n"] for r in ranges.running(same, {"n": ("count", F.lit(1))}, "at", ["g"]).collect()) == [1, 2, 3, 4, 5]
    assert [r["_edge"] for r in ranges.neighbour(same.limit(1), "v", "at").collect()] == [True]


@pytest.mark.parametrize("kind", ["string", "double", "date", "timestamp_ntz", "decimal(12,3)", "float"])
def test_orders_of_many_kinds(spark, kind):
    """Cuts go through text once; rows of any kind of order are still numbered densely and in order."""
    base = F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")) if kind in ("date", "timestamp_ntz") else F.col("id") * 7 % 1009
    df = spark.range(1000).select(base.cast(kind).alias("o"))
    rows = [r["o"] for r in tables.add_row_id(df, "o").orderBy("row_id").collect()]
    assert rows == sorted(rows) and tables.add_row_id(df, "o").agg(F.min("row_id"), F.max("row_id"), F.count_distinct("row_id")).first()[:] == (1, 1000, 1000)


def test_rank_costs_halving_not_ranges(spark):
    """2,000 ranges stand in the plan as one constant, and each row takes eleven steps."""
    parted = ranges.cut(spark.range(50_000), ["id"], by=2000)
    assert parted.agg(F.max("_part")).first()[0] == 1999
    filled = values.fill(spark.range(1000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 10 == 0, F.col("id")).alias("x")), {"x": "fill_forward"})
    assert filled.where("x <> row_id - row_id % 10").count() == 0
