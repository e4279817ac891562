"""Schema drift: headers and types of files against each other, a baseline or a declaration.

Headers come as a table (file, col), one row for each header of each file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtab.functions.casts import KINDS, try_cast
from loomtab.sources.spec import DatasetSpec

from .tables import resolve


def headers_of(frames: dict[str, DataFrame]) -> DataFrame:
    spark = next(iter(frames.values())).sparkSession
    return spark.createDataFrame([(n, c) for n, df in frames.items() for c in df.columns], "file string, col string")


def filled_headers(frames: dict[str, DataFrame]) -> DataFrame:
    """(file, col) of the headers under which a file has a value at all: all rows are read, each file in one pass."""
    parts = []
    for n, df in frames.items():
        counts = F.array(*[F.struct(F.lit(c).alias("col"), F.count(F.col(f"`{c}`")).alias("n")) for c in df.columns])
        parts.append(df.agg(counts.alias("all")).select(F.inline("all")).where("n > 0").select(F.lit(n).alias("file"), "col"))
    return reduce(DataFrame.unionByName, parts)


def kinds_in(df: DataFrame) -> DataFrame:
    """(col, type): the first kind that every value of a column can be cast to from its text, in one pass; string if there is none, or no value."""
    tried = [k for k in KINDS if k != "string"]
    rows = []
    for c in df.columns:
        text = F.col(f"`{c}`").cast("string")
        kind = F.lit("string")
        for k in reversed(tried):
            value = try_cast(text, k)
            unfit = value.isNull() if k != "int64" else value.isNull() | ~value.cast("double").eqNullSafe(try_cast(text, "float64"))
            fits = (F.count_if(text.isNotNull() & unfit) == 0) & (F.count(text) > 0)
            kind = F.when(fits, k).otherwise(kind)
        rows.append(F.struct(F.lit(c).alias("col"), kind.alias("type")))
    return df.agg(F.array(*rows).alias("all")).select(F.inline("all"))


def schema_drift(headers: DataFrame) -> DataFrame:
    """(col, present_in, missing_from, in_all) of every header."""
    files = headers.select("file").distinct()
    every = files.crossJoin(F.broadcast(headers.select("col").distinct()))  # files times headers: the report itself
    marked = every.join(headers.distinct().withColumn("there", F.lit(True)), ["file", "col"], "left")
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("file")))), ",")
    return marked.groupBy("col").agg(listed(F.col("there")).alias("present_in"), listed(F.col("there").isNull()).alias("missing_from"), (F.count("there") == F.count(F.lit(1))).alias("in_all"))


def name_variants(names: DataFrame, column: str) -> DataFrame:
    """(plain, n_variants, variants): names that are equal once only letters and digits count, whatever the case."""
    plain = F.lower(F.regexp_replace(column, "[^0-9A-Za-z]", ""))
    return names.select(F.col(column).alias("v"), plain.alias("plain")).distinct().groupBy("plain").agg(F.count(F.lit(1)).alias("n_variants"), F.array_join(F.array_sort(F.collect_list("v")), "|").alias("variants")).where("n_variants > 1")


def drift_vs_baseline(headers: DataFrame, baseline: str) -> DataFrame:
    """(file, col, status): extra and missing headers of each other file."""
    base = headers.where(F.col("file") == baseline).select("col").distinct()
    rest = headers.where(F.col("file") != baseline).distinct()
    extra = rest.join(F.broadcast(base), "col", "left_anti").select("file", "col", F.lit("extra").alias("status"))
    due = rest.select("file").distinct().crossJoin(F.broadcast(base))
    missing = due.join(rest, ["file", "col"], "left_anti").select("file", "col", F.lit("missing").alias("status"))
    return extra.unionByName(missing)


def drift_vs_spec(headers: DataFrame, spec: DatasetSpec, strict: bool = False) -> DataFrame:
    """(file, col, status): extra, missing, or aliased headers against a declaration.

    strict takes only exact aliases; otherwise a header also matches by its snake form, as the renaming step has it.
    """
    spark = headers.sparkSession
    names = [r["col"] for r in headers.select("col").distinct().orderBy("col").collect()]  # distinct headers, not rows
    found = {h: spec.aliases.get(h, h) for h in names} if strict else {h: t for n in names for h, t in resolve([n], dict(spec.aliases)).items()}
    targets = spark.createDataFrame([(h, t, t != h) for h, t in found.items()], "col string, target string, aliased boolean")
    declared = spark.createDataFrame([(c,) for c in spec.declared], "target string")
    seen = headers.distinct().join(F.broadcast(targets), "col")
    extra = seen.join(F.broadcast(declared), "target", "left_anti").select("file", "col", F.lit("extra").alias("status"))
    aliased = seen.where("aliased").join(F.broadcast(declared), "target", "left_semi").select("file", "col", F.lit("aliased").alias("status"))
    missing = headers.select("file").distinct().crossJoin(F.broadcast(declared)).join(seen, ["file", "target"], "left_anti").select("file", F.col("target").alias("col"), F.lit("missing").alias("status"))
    return extra.unionByName(aliased).unionByName(missing)


def types_of(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "col string, type string")


def type_drift(first: DataFrame, other: DataFrame) -> DataFrame:
    """(col, status) of (col, type) tables: extra, missing or type_mismatch of the other against the first."""
    a, b = first.select("col", F.col("type").alias("a")), other.select("col", F.col("type").alias("b"))
    status = F.when(F.col("a").isNull(), "extra").when(F.col("b").isNull(), "missing").when(F.col("a") != F.col("b"), "type_mismatch")
    return a.join(b, "col", "full").select("col", status.alias("status")).where("status is not null")


def preflight_report(headers: DataFrame, spec: DatasetSpec) -> DataFrame:
    """(col, status, n_files, blocks): the drift of all files against a declaration; a declared column that every file lacks blocks a run."""
    files = headers.agg(F.count_distinct("file").alias("n_all"))  # one row
    found = drift_vs_spec(headers, spec).groupBy("col", "status").agg(F.count_distinct("file").alias("n_files"))
    return found.crossJoin(F.broadcast(files)).select("col", "status", "n_files", ((F.col("status") == "missing") & (F.col("n_files") == F.col("n_all"))).alias("blocks"))


def preflight(headers: DataFrame, spec: DatasetSpec) -> tuple[bool, list[str], list[str]]:
    """(ok, extra headers, columns missing from every file); no files pass."""
    report = preflight_report(headers, spec).collect()  # distinct headers
    lost = sorted(r["col"] for r in report if r["blocks"])
    return not lost, sorted({r["col"] for r in report if r["status"] == "extra"}), lost
