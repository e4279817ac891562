"""Shaping tables to a schema, stacking them, numbering and thinning their rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomtab.functions.casts import kind_type, null_strings, try_cast
from loomtab.sources.spec import DatasetSpec, to_snake_case

from .ranges import cut


def resolve(headers: list[str], aliases: dict[str, str]) -> dict[str, str]:
    """Header to target: the alias of the header, else of its snake form, else the snake form; the first of a target wins."""
    out: dict[str, str] = {}
    for h in headers:
        snake = to_snake_case(h)
        target = aliases.get(h, aliases.get(snake, snake))
        if target not in out.values():
            out[h] = target
    return out


def rename_by_alias(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    found = resolve(df.columns, aliases)
    places = [f"_{i}" for i in range(len(df.columns))]  # headers may differ in case alone
    return df.toDF(*places).select([F.col(places[df.columns.index(h)]).alias(t) for h, t in found.items()])


def conform_columns(df: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str]]:
    """The declared columns that df has, in declared order, and the names of those left out."""
    return df.select([c for c in columns if c in df.columns]), [c for c in df.columns if c not in columns]


def add_missing(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Declared columns that df lacks, as NULL of their kind; declared order, then the others."""
    if all(c in df.columns for c in kinds):
        return df
    there = [F.col(c) if c in df.columns else F.lit(None).cast(kind_type(k)).alias(c) for c, k in kinds.items()]
    return df.select(*there, *[c for c in df.columns if c not in kinds])


def filtered_columns(df: DataFrame, except_: list[str] = ()) -> list[str]:
    gone = {c.lower() for c in except_}
    return [c for c in df.columns if c.lower() not in gone]


def star(df: DataFrame, except_: list[str] = (), prefix: str = "", suffix: str = "") -> DataFrame:
    return df.select([F.col(c).alias(f"{prefix}{c}{suffix}") for c in filtered_columns(df, except_)])


def nullcheck(df: DataFrame) -> DataFrame:
    """Empty texts as NULL."""
    return df.select([F.nullif(F.col(c), F.lit("")).alias(c) if k == "string" else F.col(c) for c, k in df.dtypes])


# casting with quarantine


def _judged(df: DataFrame, spec: DatasetSpec) -> tuple[DataFrame, list]:
    own = [c for c in spec.columns if c.name in df.columns]
    bad = [F.when(null_strings(F.col(c.name), list(c.null_strings)).isNotNull() & try_cast(F.col(c.name), c.dtype, list(c.null_strings)).isNull(), c.name) for c in own if c.dtype != "string"]
    columns = F.array_compact(F.array(*bad)) if bad else F.array().cast("array<string>")
    return df.withColumn("_bad_cols", columns), own


def split_good_bad(df: DataFrame, spec: DatasetSpec) -> tuple[DataFrame, DataFrame]:
    """Rows whose every declared value can be cast, cast; and the others, as they were. Together they are df."""
    judged, own = _judged(df, spec)
    kinds = {c.name: c for c in own}
    cast = [try_cast(F.col(n), kinds[n].dtype, list(kinds[n].null_strings)).alias(n) if n in kinds else F.col(n) for n in df.columns]
    return judged.where(F.size("_bad_cols") == 0).select(cast), judged.where(F.size("_bad_cols") > 0).drop("_bad_cols")


@dataclass(frozen=True)
class Quarantined:
    """good: rows cast, in df's columns; bad: the others as they came; counts: rows by "good" and "bad", and failures by column name.

    Both read `path`, where one write has parted them; whoever asked for it removes it.
    """

    good: DataFrame
    bad: DataFrame
    counts: dict[str, int]
    path: str


def quarantine(df: DataFrame, spec: DatasetSpec, path: str) -> Quarantined:
    """split_good_bad in one job that reads df once and caches nothing: rows are written by verdict and counted on their way."""
    judged, own = _judged(df, spec)
    kinds, ok = {c.name: c for c in own}, F.size("_bad_cols") == 0
    cast = [(try_cast(F.col(n), kinds[n].dtype, list(kinds[n].null_strings)) if n in kinds else F.col(n)).alias(n) for n in df.columns]
    raw = F.when(~ok, F.struct(*[F.col(c) for c in df.columns]))
    seen = Observation()
    failed = [F.count_if(F.array_contains("_bad_cols", c.name)).alias(f"bad_{i}") for i, c in enumerate(own)]
    watched = judged.observe(seen, F.count_if(ok).alias("good"), F.count_if(~ok).alias("bad"), *failed)
    told = watched.select(*[F.when(ok, c).alias(n) for n, c in zip(df.columns, cast, strict=True)], raw.alias("_raw"), F.when(ok, "good").otherwise("bad").alias("_verdict"))
    told.write.partitionBy("_verdict").parquet(path)
    back = df.sparkSession.read.schema(told.schema).parquet(path)
    found = seen.get
    counts = {"good": found["good"], "bad": found["bad"], **{f"column {c.name}": found[f"bad_{i}"] for i, c in enumerate(own)}}
    return Quarantined(back.where("_verdict = 'good'").select(*df.columns), back.where("_verdict = 'bad'").select("_raw.*"), counts, path)


def cast_errors(df: DataFrame, spec: DatasetSpec, samples: int = 5) -> DataFrame:
    """(column_name, n_bad, samples): failures by column in one pass, with the first few values in their order."""
    judged, own = _judged(df, spec)
    values = F.create_map(*[x for c in own for x in (F.lit(c.name), F.col(c.name).cast("string"))])
    each = judged.select(F.explode("_bad_cols").alias("column_name"), values.alias("v")).select("column_name", F.col("v")[F.col("column_name")].alias("value"))
    by_value = each.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    first = by_value.withColumn("r", F.row_number().over(W.partitionBy("column_name").orderBy("value"))).where(F.col("r") <= samples)
    total = by_value.groupBy("column_name").agg(F.sum("n").alias("n_bad"))
    return total.join(first.groupBy("column_name").agg(F.array_join(F.array_sort(F.collect_list("value")), "|").alias("samples")), "column_name")


# stacking


def combine_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows under the columns of all, NULL where a frame lacks one; frames without rows are passed over. For many files see sources.headers."""
    firsts = [df.limit(1).select(F.lit(i).alias("i")) for i, df in enumerate(frames)]
    there = {r["i"] for r in reduce(DataFrame.unionByName, firsts).collect()} if firsts else set()  # one job and one row a frame
    full = [df for i, df in enumerate(frames) if i in there]
    if not full:
        raise ValueError("every table is empty")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), full)


def union_relations(frames: dict[str, DataFrame], include: list[str] | None = None, exclude: list[str] | None = None, override: dict[str, str] | None = None, source: str | None = None, where: str | None = None) -> DataFrame:
    """Stack named frames under the superset of their columns in the order of first appearance."""
    if include and exclude:
        raise ValueError("include or exclude, not both")
    low = {c.lower() for c in include or exclude or ()}
    kept: dict[str, str] = {}
    for df in frames.values():
        for c, kind in df.dtypes:
            if (c.lower() in low) == bool(include) or not low:
                kept.setdefault(c, kind)
    if not kept:
        raise ValueError("no columns are left")
    kept |= {c: k for c, k in (override or {}).items() if c in kept}

    def aligned(name: str, df: DataFrame) -> DataFrame:
        rows = df.where(where) if where else df
        label = [F.lit(name).alias(source)] if source else []
        return rows.select(*label, *[(F.col(c) if c in df.columns else F.lit(None)).cast(k).alias(c) for c, k in kept.items()])

    return reduce(DataFrame.unionByName, [aligned(*x) for x in frames.items()])


# numbering and thinning


def add_row_id(df: DataFrame, order: str, column: str = "row_id") -> DataFrame:
    """Dense numbers from 1 in the order of `order`, without a task that sees all rows.

    Ranges of the order are numbered each on its own; one row for each range says how many come before it.
    """
    parted = cut(df, [order])
    counts = parted.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    own = F.row_number().over(W.partitionBy("_part").orderBy(order))
    return parted.join(F.broadcast(before), "_part").withColumn(column, (F.col("_before") + own).cast("long")).drop("_part", "_before")


def add_row_id_by_file(df: DataFrame, column: str = "row_id") -> DataFrame:
    """Dense numbers from 1 over the rows of a file scan, in the order of file names and of rows in a file; no shuffle of rows."""
    located = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_nth"))
    counts = located.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_file", F.coalesce(F.sum("_n").over(W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return located.join(F.broadcast(before), "_file").withColumn(column, F.col("_before") + F.col("_nth") + 1).drop("_file", "_nth", "_before")


def latest(df: DataFrame, by: list[str | Column], order: list[Column]) -> DataFrame:
    """The first row of each group in the given order; Spark keeps one row a group before the shuffle."""
    names = df.columns
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where("_rn = 1").select(names)


def deduplicate(df: DataFrame, by: list[str], order: list[Column], strict_natural: bool = False) -> DataFrame:
    """One row a group. strict_natural also drops rows with any NULL, as a join of the row with itself would."""
    out = latest(df, by, order)
    return out.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in df.columns])) if strict_natural else out


def occurrence(df: DataFrame, by: list[str], order: list[Column], column: str = "occurrence") -> DataFrame:
    return df.withColumn(column, F.row_number().over(W.partitionBy(*by).orderBy(*order)))


def column_kind(dtype: str) -> str:
    """The declared kind that a physical type stands for; decimals and all else are text."""
    if dtype in ("tinyint", "smallint", "int", "bigint"):
        return "int64"
    if dtype in ("float", "double"):
        return "float64"
    if dtype.startswith("timestamp") or dtype == "date":
        return "datetime64"
    return "bool" if dtype == "boolean" else "string"

