"""Pivots, melts, generators and small results."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Results that are returned to the driver have so many rows at most.
DRIVER_ROWS = 10_000

AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count, "avg": F.avg}
COMPARE = {"=": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}


def slug(text: str) -> str:
    out = re.sub("[^a-z0-9_]+", "", re.sub("[ -]+", "_", text.lower()))
    return f"_{out}" if out[:1].isdigit() else out


def pivot(df: DataFrame, group: list[str], column: str, values: list, agg: str = "sum", cmp: str = "=", prefix: str = "", suffix: str = "", then_value: str | Column | int = 1, else_value: Column | int | None = 0, distinct: bool = False, quote_identifiers: bool = True) -> DataFrame:
    """One column for each value: the aggregate of then_value where the comparison holds and else_value elsewhere."""
    then = F.col(then_value) if isinstance(then_value, str) else F.lit(then_value)

    def cell(v) -> Column:
        picked = F.when(COMPARE[cmp](F.col(column), F.lit(v)), then)
        picked = picked if else_value is None else picked.otherwise(else_value)
        if distinct:
            made = F.count_distinct(picked) if agg == "count" else F.sum_distinct(picked)
        else:
            made = AGGREGATES[agg](picked)
        name = f"{prefix}{v}{suffix}"
        return made.alias(name if quote_identifiers else slug(name))

    return df.groupBy(*group).agg(*[cell(v) for v in values])


def unpivot(df: DataFrame, cast_to: str = "string", exclude: list[str] = (), remove: list[str] = (), field_name: str = "field_name", value_name: str = "value") -> DataFrame:
    """A row for each column that is neither kept nor removed; NULL values stay."""
    low = {c.lower() for c in [*exclude, *remove]}
    melted = [c for c in df.columns if c.lower() not in low]
    keep = [c for c in df.columns if c.lower() in {x.lower() for x in exclude}]
    return df.select(*keep, *[F.col(c).cast(cast_to).alias(c) for c in melted]).unpivot(keep, melted, field_name, value_name)


def generate_series(spark: SparkSession, n: int) -> DataFrame:
    if n < 1:
        raise ValueError("a series has one number at least")
    return spark.range(1, n + 1).withColumnRenamed("id", "generated_number")


def intervals_between(part: str, start: Column, end: Column) -> Column:
    from loomtab.functions.scalars import date_diff

    return date_diff(part, start, end)


def date_spine(spark: SparkSession, part: str, start: str, end: str, column: str | None = None) -> DataFrame:
    """start, start + 1 part, .. before end: as many as boundaries lie between."""
    a, b = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    n = spark.range(1).select(intervals_between(part, a, b).alias("n")).first()["n"]
    name = column or f"date_{part}"
    return spark.range(n).select(F.timestamp_add(part.upper(), F.col("id").cast("int"), a).alias(name)).where(F.col(name) <= b)


def column_values(df: DataFrame, column: str, max_records: int | None = None, where: str | None = None, order: list[Column] | None = None) -> DataFrame:
    """Distinct values with their counts, most frequent first (then by value)."""
    counted = (df.where(where) if where else df).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.orderBy(*(order or [F.desc("n"), F.asc_nulls_last("value")]))
    return ordered.limit(max_records) if max_records is not None else ordered


def single_value(df: DataFrame, default=None):
    """The first cell, or the default where there is no row."""
    row = df.limit(1).collect()
    return row[0][0] if row else default


def results_as_dict(df: DataFrame, limit: int = DRIVER_ROWS) -> dict[str, tuple]:
    """Column to values; a result of more than `limit` rows is refused rather than pulled to the driver."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows; aggregate or limit the result first")
    return {c: tuple(r[c] for r in rows) for c in df.columns}


def group_by_first(df: DataFrame, n: int, *aggregates: Column) -> DataFrame:
    return df.groupBy(*df.columns[:n]).agg(*aggregates)
