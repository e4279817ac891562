"""Exact percentiles of groups of any size.

Spark's exact percentile keeps every distinct value of a group in one buffer. Groups of more than LIMIT values are narrowed first: a grid of
approximate quantiles (a summary of bounded size that partial results share) gives two values around the rank, exact
counts tell on which side of them, between or on which it lies, and the search goes on between them, some fifty times
smaller with each round, until few enough values are left to sort.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomtab.sources import scratch

#: Values of a group that are put in one buffer, and steps of the grid.
LIMIT, GRID = 100_000, 100


def _keyed(df: DataFrame, by: list[str], column: str) -> DataFrame:
    """(group, v): the values that count."""
    group = F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(by)], F.lit(0).alias("all"))
    return df.select(group.alias("group"), F.col(column).cast("double").alias("v")).where("v is not null")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _narrowed(values: DataFrame, todo: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """One round. todo: (t_group, rank, n, low, high, below, inside): the rank-th value (from 0) of a group lies strictly between low and high
    (NULL: open), `below` values do not exceed low, `inside` lie between. Gives the same rows narrowed, and (t_group, rank, value) of those found."""
    spark, open_ = values.sparkSession, (F.col("low").isNull() | (F.col("v") > F.col("low"))) & (F.col("high").isNull() | (F.col("v") < F.col("high")))
    inside = values.join(todo, _same("group", "t_group")).where(open_)
    grids = inside.groupBy("t_group", "rank", "below", "inside").agg(F.percentile_approx("v", [i / GRID for i in range(GRID + 1)], 10 * GRID).alias("grid"))
    at = (F.col("rank") - F.col("below") + 0.5) / F.col("inside") * GRID
    pick = lambda i: F.get("grid", F.greatest(F.lit(0), F.least(F.lit(GRID), i)).cast("int"))
    pivots = grids.select(F.col("t_group").alias("p_group"), F.col("rank").alias("p_rank"), pick(F.floor(at) - 1).alias("a"), pick(F.ceil(at) + 1).alias("b"))
    pivots = scratch.stored(pivots, scratch.new_folder(spark, "pivots"))  # the summaries may differ when made again
    aimed = todo.join(pivots, _same("t_group", "p_group") & (F.col("rank") == F.col("p_rank"))).drop("p_group", "p_rank")
    counts = values.join(aimed, _same("group", "t_group")).where(open_).groupBy("t_group", "rank", "n", "low", "high", "below", "inside", "a", "b").agg(
        F.count_if(F.col("v") < F.col("a")).alias("lt_a"), F.count_if(F.col("v") == F.col("a")).alias("eq_a"), F.count_if((F.col("v") > F.col("a")) & (F.col("v") < F.col("b"))).alias("mid"),
        F.count_if((F.col("v") == F.col("b")) & (F.col("a") < F.col("b"))).alias("eq_b"), F.count_if(F.col("v") > F.col("b")).alias("gt_b"),
    )
    k = F.col("rank") - F.col("below")
    c1, c2, c3, c4 = F.col("lt_a"), F.col("lt_a") + F.col("eq_a"), F.col("lt_a") + F.col("eq_a") + F.col("mid"), F.col("lt_a") + F.col("eq_a") + F.col("mid") + F.col("eq_b")
    side = F.when(k < c1, "under").when(k < c2, "a").when(k < c3, "between").when(k < c4, "b").otherwise("over")
    told = scratch.stored(counts.withColumn("side", side), scratch.new_folder(spark, "sides"))
    by_side = lambda under, between, over: F.when(F.col("side") == "under", under).when(F.col("side") == "between", between).otherwise(over)
    more = told.where("side in ('under', 'between', 'over')").select(
        "t_group", "rank", "n", by_side(F.col("low"), F.col("a"), F.col("b")).alias("low"), by_side(F.col("a"), F.col("b"), F.col("high")).alias("high"),
        (F.col("below") + by_side(F.lit(0), c2, c4)).alias("below"), by_side(c1, F.col("mid"), F.col("gt_b")).alias("inside"),
    )
    return more, told.where("side in ('a', 'b')").select("t_group", "rank", F.when(F.col("side") == "a", F.col("a")).otherwise(F.col("b")).alias("value"))


def _left(values: DataFrame, todo: DataFrame) -> DataFrame:
    """The values, each once, that lie between the bounds of any rank of their group: later rounds read these, some fiftieth of all, in place of the table."""
    open_ = (F.col("low").isNull() | (F.col("v") > F.col("low"))) & (F.col("high").isNull() | (F.col("v") < F.col("high")))
    return scratch.stored(values.join(todo, _same("group", "t_group") & open_, "left_semi"), scratch.new_folder(values.sparkSession, "left"))


def _sorted_out(values: DataFrame, todo: DataFrame) -> DataFrame:
    """(t_group, rank, value) where few values are left between the bounds."""
    open_ = (F.col("low").isNull() | (F.col("v") > F.col("low"))) & (F.col("high").isNull() | (F.col("v") < F.col("high")))
    nth = F.row_number().over(W.partitionBy("t_group", "rank").orderBy("v"))
    left = values.join(todo, _same("group", "t_group")).where(open_).withColumn("nth", nth)
    return left.where(F.col("nth") == F.col("rank") - F.col("below") + 1).select("t_group", "rank", F.col("v").alias("value"))


def exact_percentile(df: DataFrame, by: list[str], column: str, q: float, name: str, limit: int = LIMIT) -> DataFrame:
    """(by.., name): the exact q-th percentile of a column by groups, interpolated as Spark's, bit for bit; groups without values have no row.

    One job counts the groups of more than `limit` values; if there is none, the plan is Spark's own aggregate. NULLs do not count; NaN is the
    largest value.
    """
    spark, values = df.sparkSession, _keyed(df, by, column)
    named = [F.col(f"group.g{i}").alias(c) for i, c in enumerate(by)]
    sizes = values.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    large = scratch.stored(sizes.select(F.col("group").alias("t_group"), "n"), scratch.new_folder(spark, "large"))
    plain = lambda d: d.groupBy("group").agg(F.percentile("v", q).alias(name)).select(*named, name)
    if not large.take(1):
        return plain(values)
    position = (F.col("n") - 1) * F.lit(q)
    ends = large.select("t_group", "n", F.explode(F.array_distinct(F.array(F.floor(position), F.ceil(position)))).alias("rank"))
    none = F.lit(None).cast("double")
    todo = ends.select("t_group", "rank", "n", none.alias("low"), none.alias("high"), F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"))
    of_large, found = values.join(large.select("t_group"), _same("group", "t_group"), "left_semi"), []
    while todo.where(F.col("inside") > limit).take(1):
        if found:  # at first all ranks have more
            found.append(_sorted_out(of_large, todo.where(F.col("inside") <= limit)))
        todo, exact = _narrowed(of_large, todo.where(F.col("inside") > limit), limit)
        found.append(exact)
        of_large = _left(of_large, todo)
    found.append(_sorted_out(of_large, todo))
    ranks = reduce(DataFrame.unionByName, found).groupBy("t_group").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("values"))  # two entries a group
    both = large.join(ranks.withColumnRenamed("t_group", "r_group"), _same("t_group", "r_group")).withColumn("position", position)
    low, high = F.col("values")[F.floor("position")], F.col("values")[F.ceil("position")]
    between = (F.ceil("position") - F.col("position")) * low + (F.col("position") - F.floor("position")) * high
    result = F.when(low == high, low).otherwise(between)
    small = values.join(large.select("t_group"), _same("group", "t_group"), "left_anti")
    return plain(small).unionByName(both.withColumn("group", F.col("t_group")).select(*named, result.alias(name)))
