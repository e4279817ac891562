"""Orders over large tables and large groups: ranges of the order, and what is carried from one range to the next.

A table is cut by (group, order) into ranges of about equal size, so a group that holds half of all rows spreads over half of the
ranges. Windows run inside ranges; a table of one row a range carries what a range's first group takes over from the
ranges before it. Rows of equal group and order are told apart by a hash of the whole row, so only exact copies stay together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomtab.sources import scratch

#: Keys looked at to find the cuts, for each range.
KEYS_A_RANGE = 32


def _cuts(df: DataFrame, keys: list[str], n: int) -> str | None:
    """Up to n - 1 keys that part df's rows about equally, in order, as JSON.

    Keys are taken below a threshold of their hash, which follows from the number of rows: some KEYS_A_RANGE * n
    distinct ones, counted where they lie. The same rows give the same cuts. They need not be exact: any cuts give the same results.
    """
    total = df.count() if n > 1 else 0
    if not total:
        return None
    share = KEYS_A_RANGE * n / total
    key = F.struct(*keys)
    hashed = df.select(key.alias("key"), F.xxhash64(*keys).alias("h"))
    seen = hashed.where(F.col("h") < F.lit(int(share * 2**64) - 2**63)) if share < 1 else hashed
    counts = seen.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(W.orderBy("key"))  # the keys looked at, not the table
    of = F.ceil(upto * n / F.sum("n").over(W.partitionBy(F.lit(0))))
    ends = counts.select("key", of.alias("range")).where(F.col("range") < n).groupBy("range").agg(F.max("key").alias("key"))
    return ends.agg(F.to_json(F.array_sort(F.collect_list("key"))).alias("cuts")).first()["cuts"]


def cut(df: DataFrame, keys: list[str], part: str = "_part", by: int | None = None) -> DataFrame:
    """df with the number of its range of the keys: ranges are about equal and ascend; NULLs come first.

    The cuts are found by two small jobs when the plan is built, and stand in it as one constant; a row finds its range
    by halving, so its cost hardly depends on the number of ranges.
    """
    n = by or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = _cuts(df, keys, n)
    if not found or found == "[]":
        return df.withColumn(part, F.lit(0))
    kinds = ", ".join(f"`{c}`: {df.schema[c].dataType.simpleString()}" for c in keys)
    bounds, key = F.from_json(F.lit(found), f"array<struct<{kinds}>>"), F.struct(*keys)
    strides = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])
    return df.withColumn(part, F.aggregate(strides, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) < key, at + step).otherwise(at)))


def _ranged(df: DataFrame, order: str, by: list[str]) -> DataFrame:
    """df with _null, _tie and _part: ranges of (by, order with NULLs last, hash of the row)."""
    plain = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    marked = df.withColumns({"_null": F.col(order).isNull(), "_tie": F.xxhash64(*plain)})
    return cut(marked, list(dict.fromkeys([*by, "_null", order, "_tie"])))


def _inside(by: list[str]) -> W:
    return W.partitionBy("_part", *by)


def neighbour(df: DataFrame, value: str, order: str, by: list[str] = (), ahead: bool = True) -> DataFrame:
    """df with _near, the value in the next (or previous) row of its group, and _edge, whether there is none."""
    by = list(by)
    parted = _ranged(df, order, by)
    own_value, key = F.struct(F.col(value).alias("v")), F.struct(*by, "_null", order, "_tie")
    group = F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(by)], F.lit(0).alias("all"))
    ends = parted.groupBy("_part").agg((F.min_by if ahead else F.max_by)(F.struct(group.alias("group"), own_value.alias("value")), key).alias("end"))
    across = ends.select("_part", (F.lead if ahead else F.lag)("end").over(W.orderBy("_part")).alias("_across"))  # one row a range
    own = (F.lead if ahead else F.lag)(own_value).over(_inside(by).orderBy("_null", order, "_tie"))
    taken = F.when(F.col("_across.group").eqNullSafe(group), F.col("_across.value"))
    out = parted.join(F.broadcast(across), "_part").withColumn("_n", F.coalesce(own, taken))
    return out.select(*df.columns, F.col("_n.v").alias("_near"), F.col("_n").isNull().alias("_edge"))


#: Running aggregates: the aggregate of rows, and that of its own results.
KINDS = {"count": (F.count, F.sum), "sum": (F.sum, F.sum), "xor": (F.bit_xor, F.bit_xor)}


def running(df: DataFrame, columns: dict[str, tuple[str, Column]], order: str, by: list[str] = ()) -> DataFrame:
    """df with running aggregates by group in the order given, the own row included: {name: (count, sum or xor, column)}.

    ("count", lit(1)) numbers the rows. NULL in the order comes last. No group has to fit one task.
    """
    by = list(by)
    parted = _ranged(df, order, by).withColumns({f"_in_{n}": c for n, (_, c) in columns.items()})
    group = F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(by)], F.lit(0).alias("all"))
    sums = parted.groupBy("_part", group.alias("group")).agg(*[KINDS[k][0](f"_in_{n}").alias(n) for n, (k, _) in columns.items()])
    held = F.struct("group", *columns)
    ends = sums.groupBy("_part").agg(F.max_by(held, "group").alias("last"), F.min("group").alias("first"))  # one row a range from here on
    tails = W.partitionBy("last.group").orderBy("_part").rowsBetween(W.unboundedPreceding, 0)
    so_far = ends.select("_part", "first", F.col("last.group").alias("tail"), *[KINDS[k][1](f"last.{n}").over(tails).alias(n) for n, (k, _) in columns.items()])
    before = W.orderBy("_part")
    carried = so_far.select("_part", F.lag("tail").over(before).alias("_tail"), *[F.lag(n).over(before).alias(f"_over_{n}") for n in columns])
    seen = _inside(by).orderBy("_null", order, "_tie").rowsBetween(W.unboundedPreceding, 0)
    taken = {n: F.when(F.col("_tail").eqNullSafe(group), F.col(f"_over_{n}")) for n in columns}

    def total(n: str, kind: str) -> Column:
        own = KINDS[kind][0](f"_in_{n}").over(seen)
        if kind == "xor":
            return F.coalesce(own.bitwiseXOR(taken[n]), own, taken[n])
        return F.coalesce(own + taken[n], own, taken[n])

    joined = parted.join(F.broadcast(carried), "_part").withColumns({n: total(n, k) for n, (k, _) in columns.items()})
    return joined.select(*[c for c in df.columns if c not in columns], *columns)


#: monotonically_increasing_id: the number of a partition stands above so many bits of the place in it.
PLACE_BITS = 33


def numbered(df: DataFrame, name: str, order: list[str], by: list[str] = ()) -> DataFrame:
    """df with the number of each row in its group, from 1, by the columns of `order` (NULL comes last), as `running` counts them.

    One sort over the cluster writes the rows with their places; a number is a place less the first of its group there, and
    the group's rows in the partitions before. So rows move once, and no window passes over them; of the (partition, group)
    pairs there are as many as groups and partitions together.
    """
    by, spark = list(by), df.sparkSession
    plain = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    keys = [*[F.asc_nulls_first(c) for c in by], *[F.asc_nulls_last(c) for c in order], F.asc("_tie")]
    told = df.withColumn("_tie", F.xxhash64(*plain)).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)
    kept = scratch.stored(told.drop("_tie").withColumn("_place", F.monotonically_increasing_id()), scratch.new_folder(spark, "numbered"))
    group = F.struct(*[F.col(c).alias(f"g{i}") for i, c in enumerate(by)], F.lit(0).alias("all"))
    part = F.shiftright("_place", PLACE_BITS)
    runs = kept.groupBy(part.alias("_part"), group.alias("_group")).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy("_group").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = scratch.stored(runs.select("_part", "_group", (before + 1 - F.col("_first")).alias("_less")), scratch.new_folder(spark, "starts"))
    joined = kept.join(starts, (part == F.col("_part")) & group.eqNullSafe(F.col("_group")))
    return joined.select(*[c for c in df.columns if c != name], (F.col("_place") + F.col("_less")).alias(name))
