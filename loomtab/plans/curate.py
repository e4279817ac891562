"""A dataset from raw files to a curated table: each step is a function of DataFrames, an action only where one is due.

read as text -> rename and conform -> add missing columns -> cast with quarantine -> map values -> combine with
provenance and numbers -> fill nulls -> validate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomtab.operators import checks, drift, ranges, tables, values
from loomtab.sources import ingest, scratch
from loomtab.sources.spec import GENERATED, DatasetSpec

STEPS = ("read", "conform", "cast", "map", "combine", "fill", "validate")


@dataclass(frozen=True)
class Curated:
    """clean: the table; rejected: raw rows that could not be cast; report: one row for each check; counts: of the casts; held: where rows lie parted by verdict."""

    clean: DataFrame
    rejected: DataFrame
    report: DataFrame
    counts: dict[str, int]
    held: str

    def release(self) -> None:
        """Remove the parted rows; store what is still needed of the results before."""
        scratch.remove(self.clean.sparkSession, self.held)

    def passed(self) -> bool:
        return not self.report.where("not passed").take(1)


def conform(raw: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Renamed, cut to the declared columns and completed with missing ones, in declared order; still text."""
    named, _ = tables.conform_columns(tables.rename_by_alias(raw, dict(spec.aliases)), spec.declared)
    return tables.add_missing(named, {c: "string" for c in spec.declared})


def plan(spec: DatasetSpec, headers: DataFrame) -> DataFrame:
    """A dry run: how the headers compare with the declaration; no data is read."""
    return drift.drift_vs_spec(headers, spec)


def run_dataset(spark: SparkSession, spec: DatasetSpec, paths: dict[str, str | list[str]], fmt: str = "csv", ingested_at: str = "1970-01-01 00:00:00", preflight: bool = False) -> Curated:
    """Curate the files of one or more named sources into one table.

    paths: source name to its files, which share a header; sources may differ. Rows keep the order of source, file and
    position. With preflight, a declared column that no source brings is an error.
    """
    frames = {n: _source(spark, n, p, fmt) for n, p in sorted(paths.items())}
    if preflight:
        ok, _, lost = drift.preflight(drift.headers_of({n: df.drop("_file", "_at") for n, df in frames.items()}), spec)
        if not ok:
            raise ValueError(f"{spec.name}: no source brings {', '.join(lost)}")
    parts = []
    for n, df in frames.items():
        shaped = conform(df.drop("_file", "_at"), spec).columns
        renamed = tables.rename_by_alias(df, {**spec.aliases, "_file": "_file", "_at": "_at"})
        full = tables.add_missing(renamed, {c: "string" for c in shaped})
        parts.append(full.select(*shaped, F.lit(n).alias("_source"), "_file", "_at"))
    parted = tables.quarantine(tables.combine_by_name(parts), spec, scratch.new_folder(spark, "quarantine"))  # the files are read here, once
    mapped = values.apply_value_maps(parted.good, {c: dict(m) for c, m in spec.value_maps.items()})
    numbered = _numbered(mapped)
    stamped = numbered.withColumn("_source_file", F.col("_file")).withColumn("_ingested_at", F.lit(ingested_at).cast("timestamp_ntz"))
    filled = values.fill(stamped, {c.name: c.fill_strategy for c in spec.columns if c.fill_strategy})
    extra = [c for c in GENERATED if c not in spec.declared]
    clean = filled.select(*spec.declared, *extra)
    return Curated(clean, parted.bad.select(*spec.declared, "_source", "_file"), checks.validate_dataset(clean, spec), parted.counts, parted.path)


def _numbered(df: DataFrame) -> DataFrame:
    """row_id over (_source, _file, _at): places in a file by ranges, so a large file is no task of its own, and one row a file carries the offsets."""
    counts = df.groupBy("_source", "_file").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_source", "_file", F.coalesce(F.sum("_n").over(W.orderBy("_source", "_file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    placed = ranges.running(df, {"_nth": ("count", F.lit(1))}, "_at", ["_source", "_file"])
    return placed.join(F.broadcast(before), ["_source", "_file"]).withColumn("row_id", (F.col("_before") + F.col("_nth")).cast("long")).drop("_before", "_nth")


def _source(spark: SparkSession, name: str, paths: str | list[str], fmt: str) -> DataFrame:
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", False)
    raw = reader.load(paths)
    names = [ingest.clean_header(c, i) for i, c in enumerate(raw.columns)]
    text = [F.col(f"`{c}`").cast("string").alias(n) for c, n in zip(raw.columns, names, strict=True)]
    row = F.col("_metadata.row_index") if fmt == "parquet" else F.monotonically_increasing_id()
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), row.alias("row"))  # the parts of a file may be read in any order
    return raw.select(*text, ingest.file_name().alias("_file"), at.alias("_at"))
