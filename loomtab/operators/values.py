"""Value maps, lookups and null fills."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ranges import cut

FILLS = ("fill_zero", "fill_unknown", "fill_forward", "fill_backward")
#: Lookup tables of at most so many bytes are broadcast, or of so many rows where Spark knows no size; larger ones are joined as Spark sees fit.
BROADCAST_BYTES, BROADCAST_ROWS = 10 << 20, 100_000


def mapped(column: str, pairs: dict[str, str | None]) -> Column:
    """Exact, case-sensitive replacement of a column's values; a target of None gives NULL; other values stay."""
    c = F.col(column)
    if not pairs:
        return c
    out = functools.reduce(lambda w, kv: w.when(c == kv[0], F.lit(kv[1]).cast("string")), list(pairs.items())[1:], F.when(c == next(iter(pairs)), F.lit(next(iter(pairs.values()))).cast("string")))
    return out.otherwise(c)


def _known(df: DataFrame, maps: dict) -> dict[str, dict]:
    return {c: m for c, m in maps.items() if c in df.columns and isinstance(m, dict) and m}


def apply_value_maps(df: DataFrame, maps: dict[str, dict[str, str | None]]) -> DataFrame:
    """Columns that df lacks and maps that are no dictionaries are passed over."""
    return df.withColumns({c: mapped(c, m) for c, m in _known(df, maps).items()})


def remap_counts(df: DataFrame, maps: dict[str, dict[str, str | None]]) -> DataFrame:
    """(column_name, changed): rows whose value a map changes, all columns in one pass."""
    known = _known(df, maps)
    changed = F.array(*[F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNotNull() & ~F.col(c).eqNullSafe(mapped(c, m))).alias("changed")) for c, m in known.items()])
    return df.agg(changed.alias("all")).select(F.inline("all"))


def _is_small(lookup: DataFrame) -> bool:
    """By the sizes that the plan's sources state; rows are counted only where one states none."""
    leaves = lookup._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    if sizes and max(sizes) < 1 << 60:
        return sum(sizes) <= BROADCAST_BYTES
    return lookup.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def lookup_normalize(df: DataFrame, column: str, lookup: DataFrame, to: str | None = None) -> DataFrame:
    """The lookup's target_value for the column's value, or the value itself. lookup: (source_value, target_value).

    A source_value that stands there twice is an error when the result is read: it would double the rows of df.
    """
    twice = F.raise_error(F.concat(F.lit("the lookup has several targets for "), F.col("_source"))).cast("string")
    side = lookup.where("source_value is not null").groupBy(F.col("source_value").alias("_source")).agg(F.max("target_value").alias("_target"), F.count(F.lit(1)).alias("_n"))
    side = side.select("_source", F.when(F.col("_n") > 1, twice).otherwise(F.col("_target")).alias("_target"))
    side = F.broadcast(side) if _is_small(lookup) else side
    out = df.join(side, F.col(column) == F.col("_source"), "left")
    return out.withColumn(to or column, F.coalesce("_target", column)).drop("_source", "_target")


def fill(df: DataFrame, fills: dict[str, str], order: str = "row_id") -> DataFrame:
    """fill_zero, fill_unknown, fill_forward and fill_backward by column; anything else leaves a column alone.

    Forward and backward fills need `order` (without it they do nothing) and no task that holds all rows: the rows are
    cut into ranges of the order, each range is filled by a window of its own, and what an earlier (later) range
    carries over comes from a table of one row for each range.
    """
    kinds = dict(df.dtypes)
    for c, how in fills.items():
        if how == "fill_zero" and kinds.get(c) == "string":
            raise ValueError(f"fill_zero needs a number, {c} is text")
    plain = {c: F.coalesce(c, F.lit(0).cast(kinds[c]) if how == "fill_zero" else F.lit("Unknown")) for c, how in fills.items() if c in kinds and how in FILLS[:2]}
    out = df.withColumns(plain) if plain else df
    carried = {c: how for c, how in fills.items() if c in kinds and how in FILLS[2:]}
    return _carry(out, carried, order) if carried and order in df.columns else out


def _carry(df: DataFrame, how: dict[str, str], order: str) -> DataFrame:
    parted = cut(df, [order])
    key = F.col(order)
    ends = parted.groupBy("_part").agg(*[(F.max_by if h == "fill_forward" else F.min_by)(F.col(c), F.when(F.col(c).isNotNull(), key)).alias(f"_end_{c}") for c, h in how.items()])
    before, after = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1), W.orderBy("_part").rowsBetween(1, W.unboundedFollowing)
    over = [(F.last(f"_end_{c}", True).over(before) if h == "fill_forward" else F.first(f"_end_{c}", True).over(after)).alias(f"_over_{c}") for c, h in how.items()]
    carried = ends.select("_part", *over)  # one row for each range
    # both ways look back only, backward fills from the far end: a frame that reaches forward would be read anew for each row
    seen = {h: W.partitionBy("_part").orderBy(F.asc(order) if h == "fill_forward" else F.desc(order)).rowsBetween(W.unboundedPreceding, 0) for h in how.values()}
    fills = {c: F.coalesce(F.last(c, True).over(seen[h]), F.col(f"_over_{c}")) for c, h in how.items()}
    return parted.join(F.broadcast(carried), "_part").withColumns(fills).select(*df.columns)


def null_rates(df: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    """(column_name, null_percent) of the named columns, in one pass."""
    from loomtab.functions.scalars import percent

    n = F.count(F.lit(1))
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), percent(F.count_if(F.col(c).isNull()), n, digits).alias("null_percent")) for c in columns])
    return df.agg(rows.alias("all")).select(F.inline("all"))
