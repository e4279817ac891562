"""Data-quality checks. Each returns the rows (or groups) that break its rule; a check passes when that is empty.

Where a rule needs a row's neighbour in an order (of the table or of groups), the rows are cut into ranges of group and order, and
the neighbour across a range's edge comes from a table of one row a range, so no task sees all rows, or all of a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtab.functions.scalars import percent
from loomtab.sources.spec import DatasetSpec

from .tables import column_kind
from .ranges import neighbour


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# one table, row by row


def accepted_range(df: DataFrame, column: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    c, out = F.col(column), F.lit(False)
    if low is not None:
        out = out | ~(c >= low if inclusive else c > low)
    if high is not None:
        out = out | ~(c <= high if inclusive else c < high)
    return df.where(out)


def expression_is_true(df: DataFrame, expression: str, where: str | None = None) -> DataFrame:
    """NULL passes."""
    return (df.where(where) if where else df).where(f"not ({expression})")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def not_empty_string(df: DataFrame, column: str, trim: bool = True) -> DataFrame:
    return df.where((F.trim(column) if trim else F.col(column)) == "")


def not_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isin(values)).select(column).distinct()


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(~F.col(column).isin(values)).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


# one table, by groups


def unique(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs count as equal."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def at_least_one(df: DataFrame, column: str, by: list[str] = ()) -> DataFrame:
    """Groups (or the table) whose column is NULL throughout."""
    return df.groupBy(*by).agg(F.count(column).alias("n_values")).where("n_values = 0")


def not_constant(df: DataFrame, column: str, by: list[str] = ()) -> DataFrame:
    """Groups with exactly one distinct value; two extremes tell that without a distinct count."""
    return df.groupBy(*by).agg(F.min(column).alias("low"), F.max(column).alias("high")).where("low = high").select(*by, F.lit(1).cast("long").alias("n_distinct"))


def not_null_proportion(df: DataFrame, column: str, at_least: float, at_most: float = 1.0, by: list[str] = ()) -> DataFrame:
    share = F.count(column) / F.count(F.lit(1))
    return df.groupBy(*by).agg(share.alias("not_null_proportion")).where((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def recency(df: DataFrame, field: str, part: str, interval: int, as_of: str, by: list[str] = (), ignore_time: bool = False) -> DataFrame:
    """Groups whose newest value is older than as_of less the interval; the clock is an argument."""
    now = F.lit(as_of).cast("timestamp_ntz")
    threshold = F.timestamp_add(part.upper(), F.lit(-interval), now)
    newest = F.max(field)
    if ignore_time:
        newest, threshold = newest.cast("date"), threshold.cast("date")
    return df.groupBy(*by).agg(newest.alias("most_recent"), F.lit(None).alias("_")).drop("_").withColumn("threshold", threshold).where("most_recent < threshold")


# one table, by neighbours


def mutually_exclusive_ranges(df: DataFrame, lower: str, upper: str, by: list[str] = (), gaps: str = "allowed", zero_length: bool = False) -> DataFrame:
    """Rows whose range is upside down (or NULL), or does not end before the next one starts."""
    compare = {"not_allowed": lambda a, b: a == b, "allowed": lambda a, b: a <= b, "required": lambda a, b: a < b}[gaps]
    seen = neighbour(df, lower, lower, by, ahead=True)
    sound = F.col(lower) <= F.col(upper) if zero_length else F.col(lower) < F.col(upper)
    apart = compare(F.col(upper), F.col("_near"))
    ok = F.coalesce(sound, F.lit(False)) & (F.col("_edge") | F.coalesce(apart, F.lit(False)))
    return seen.where(~ok).select(df.columns)


def sequential_values(df: DataFrame, column: str, interval: int = 1, part: str | None = None, by: list[str] = ()) -> DataFrame:
    """Rows that are not `interval` (of a date part, if given) after the row before them."""
    seen = neighbour(df, column, column, by, ahead=False)
    due = F.timestamp_add(part.upper(), F.lit(interval), F.col("_near")) if part else F.col("_near") + interval
    return seen.where(F.col("_near").isNotNull() & (F.col(column) != due)).select(*df.columns, F.col("_near").alias("previous"))


# two tables


def equality(a: DataFrame, b: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct rows that only one side has, labelled by side."""
    names = columns or a.columns
    x, y = a.select(names), b.select(names)
    return x.subtract(y).withColumn("which_diff", F.lit("a_minus_b")).unionByName(y.subtract(x).withColumn("which_diff", F.lit("b_minus_a")))


def cardinality_equality(a: DataFrame, field_a: str, b: DataFrame, field_b: str) -> DataFrame:
    """Values whose number of rows differs: (value, n_a, n_b), from one pass over each side's counts."""
    x = a.groupBy(F.col(field_a).alias("value")).agg(F.count(F.lit(1)).alias("n_a"))
    y = b.groupBy(F.col(field_b).alias("_value")).agg(F.count(F.lit(1)).alias("n_b"))
    both = x.join(y, F.col("value").eqNullSafe(F.col("_value")), "full")
    return both.where(~F.col("n_a").eqNullSafe(F.col("n_b"))).select(F.coalesce("value", "_value").alias("value"), "n_a", "n_b")


def _counts(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    if not by:
        return a.agg(F.count(F.lit(1)).alias("n_a")).crossJoin(b.agg(F.count(F.lit(1)).alias("n_b")))  # one row each
    x, y = a.groupBy(*by).agg(F.count(F.lit(1)).alias("n_a")), b.groupBy(*by).agg(F.count(F.lit(1)).alias("n_b"))
    return x.join(y, list(by), "full")


def equal_rowcount(a: DataFrame, b: DataFrame, by: list[str] = ()) -> DataFrame:
    return _counts(a, b, list(by)).withColumn("diff_count", F.abs(F.col("n_a") - F.col("n_b"))).where(F.coalesce("diff_count", F.lit(0)) != 0)


def fewer_rows_than(a: DataFrame, b: DataFrame, by: list[str] = ()) -> DataFrame:
    """Groups of a with as many rows as b or more; row_count_delta is 1 for equal ones and the surplus otherwise."""
    more = F.col("n_a") - F.col("n_b")
    delta = F.when(more > 0, more).when(more == 0, 1).otherwise(0)
    return _counts(a, b, list(by)).withColumn("row_count_delta", delta.cast("long")).where("row_count_delta > 0")


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str, child_where: str | None = None, parent_where: str | None = None) -> DataFrame:
    """Non-null child values without a parent, under the two conditions."""
    own = (child.where(child_where) if child_where else child).where(F.col(column).isNotNull())
    known = (parent.where(parent_where) if parent_where else parent).select(F.col(field).alias("_parent"))
    return own.join(known, F.col(column) == F.col("_parent"), "left_anti")


def no_row_loss(source: DataFrame, mart: DataFrame) -> DataFrame:
    return equal_rowcount(source, mart)


def valid_duration(df: DataFrame, start: str, end: str, duration: str) -> DataFrame:
    """Rows with a negative duration or an end before the start, with the reason (a row can have both)."""
    reasons = F.array_compact(F.array(F.when(F.col(duration) < 0, "negative_duration"), F.when(F.col(end) < F.col(start), "end_before_start")))
    return df.withColumn("reason", F.explode(reasons))


def compare_null_rates(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    from .values import null_rates

    x, y = (null_rates(df, columns).withColumnRenamed("null_percent", n) for df, n in ((a, "null_percent_a"), (b, "null_percent_b")))
    return x.join(y, "column_name")


def compare_value_counts(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    x, y = (df.groupBy(F.col(column).alias(f"value_{n}")).agg(F.count(F.lit(1)).alias(f"n_{n}")) for df, n in ((a, "a"), (b, "b")))
    both = x.join(y, F.col("value_a").eqNullSafe(F.col("value_b")), "full")
    return both.select(F.coalesce("value_a", "value_b").alias("value"), F.coalesce("n_a", F.lit(0)).alias("n_a"), F.coalesce("n_b", F.lit(0)).alias("n_b"))


# whole datasets


def duplicate_rate(df: DataFrame, key: list[str]) -> DataFrame:
    """All rows in groups of more than one, and their share; NULL keys are equal."""
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows")).withColumn("duplicate_rate", F.round(F.col("duplicate_rows") / F.col("n_rows"), 6))


def excess_duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.agg((F.count(F.lit(1)) - F.count_distinct(key)).alias("excess"))


def null_rate_report(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """(column_name, null_rate, threshold, passed) of the declared columns in one pass."""
    own = [c for c in spec.columns if c.name in df.columns]
    n = F.count(F.lit(1))
    rows = F.array(*[F.struct(F.lit(c.name).alias("column_name"), F.coalesce(F.round(F.try_divide(F.count_if(F.col(c.name).isNull()), n), 6), F.lit(0.0)).alias("null_rate"), F.lit(float(spec.max_null_rate if c.max_null_rate is None else c.max_null_rate)).alias("threshold")) for c in own])
    return df.agg(rows.alias("all")).select(F.inline("all")).withColumn("passed", F.col("null_rate") <= F.col("threshold"))


def dtype_report(df: DataFrame, spec: DatasetSpec, found: DataFrame | None = None) -> DataFrame:
    """(column_name, expected, actual, passed) of the declared columns that are there.

    found: (col, type) as `drift.kinds_in` finds them in the values of a table of texts; without it the types are those that
    df declares, and no data is read.
    """
    spark = df.sparkSession
    if found is None:
        found = spark.createDataFrame([(c, column_kind(k)) for c, k in df.dtypes], "col string, type string")
    declared = spark.createDataFrame([(c.name, c.dtype) for c in spec.columns], "column_name string, expected string")
    met = F.broadcast(declared).join(found.select(F.col("col").alias("column_name"), F.col("type").alias("actual")), "column_name")  # one row a column on both sides
    return met.select("column_name", "expected", "actual", (F.col("expected") == F.col("actual")).alias("passed"))


def validate_dataset(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """(check_name, column_name, value, passed): row count, required columns, duplicates, null rates and kinds."""
    count = df.agg(F.lit("row_count").alias("check_name"), F.lit(None).cast("string").alias("column_name"), F.count(F.lit(1)).cast("double").alias("value")).withColumn("passed", F.col("value") >= spec.min_row_count)
    parts = [count]
    if missing := [c for c in spec.required() if c not in df.columns]:
        parts.append(df.sparkSession.createDataFrame([("required_column", c, 0.0, False) for c in missing], "check_name string, column_name string, value double, passed boolean"))
    if (key := spec.key()) and all(k in df.columns for k in key):
        parts.append(duplicate_rate(df, key).select(F.lit("duplicate_rate").alias("check_name"), F.lit(",".join(key)).alias("column_name"), F.coalesce("duplicate_rate", F.lit(0.0)).alias("value")).withColumn("passed", F.col("value") <= spec.max_duplicate_rate))
    parts.append(null_rate_report(df, spec).select(F.lit("null_rate").alias("check_name"), "column_name", F.col("null_rate").alias("value"), "passed"))
    parts.append(dtype_report(df, spec).select(F.lit("dtype").alias("check_name"), "column_name", F.col("passed").cast("double").alias("value"), "passed"))
    return reduce(DataFrame.unionByName, parts)


def allowed_values(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """(column_name, value, n_records) of values that a column's declaration does not allow."""
    parts = [accepted_values(df, c.name, list(c.allowed_values)).select(F.lit(c.name).alias("column_name"), F.col(c.name).cast("string").alias("value"), "n_records") for c in spec.columns if c.allowed_values and c.name in df.columns]
    return reduce(DataFrame.unionByName, parts) if parts else df.sparkSession.createDataFrame([], "column_name string, value string, n_records long")


def profile_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    from .values import null_rates

    return null_rates(df, columns or df.columns, 1)


def profile_duplicates(df: DataFrame, source: str, key: str) -> DataFrame:
    """Rows, distinct keys and the share of surplus rows for each source."""
    by_key = df.groupBy(source, key).agg(F.count(F.lit(1)).alias("n"))
    return by_key.groupBy(source).agg(F.sum("n").alias("n_rows"), F.count(key).alias("n_keys"), percent(F.sum(F.when(F.col(key).isNotNull(), F.col("n") - 1).otherwise(0)), F.sum("n")).alias("surplus_percent"))
