"""Readers: every cell as text, clean headers, file provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def clean_header(name: object, i: int) -> str:
    text = "" if name is None else str(name).strip()
    return text or f"_unnamed_{i}"


def clean_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_header(c, i) for i, c in enumerate(df.columns)])


def all_strings(df: DataFrame) -> DataFrame:
    """Every column as text; NULL stays NULL, and no rows still give the columns."""
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def read_raw(spark: SparkSession, paths: str | list[str], fmt: str = "csv", **options: str) -> DataFrame:
    """Tabular files (csv, json, parquet, orc) as text columns; the types are settled later, by declared casts."""
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", False)
    elif fmt == "json":
        reader = reader.option("primitivesAsString", True)
    return all_strings(clean_headers(reader.load(paths)))


def clean_files(spark: SparkSession, folder: str) -> DataFrame:
    """The Parquet files of a folder that hold clean rows: neither the sidecars of bad rows nor unfinished ones."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)  # one entry a file; their schemas are never merged with the sidecars'
    names = sorted(x.getPath().toString() for x in found if _is_clean(x.getPath().getName()))
    if not names:
        raise FileNotFoundError(f"{folder} holds no clean Parquet file")
    return spark.read.option("mergeSchema", True).parquet(*names)


def _is_clean(name: str) -> bool:
    return name.endswith(".parquet") and not name.endswith("_errors.parquet") and not name.startswith(("tmp", ".", "_"))


def file_name() -> F.Column:
    """The name of each row's file as it is; Spark's metadata have it as part of a URI."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def file_stem() -> F.Column:
    return F.regexp_replace(file_name(), r"\.[^.]+$", "")


def with_source_system(df: DataFrame, declared: list[str] | None = None) -> DataFrame:
    """The stem of each row's file, where the dataset declares such a column."""
    return df.withColumn("source_system", file_stem()) if declared is None or "source_system" in declared else df


def with_provenance(df: DataFrame, ingested_at: str) -> DataFrame:
    """_source_file and _ingested_at; the time is an argument, so that a rerun gives the same rows."""
    return df.withColumn("_source_file", file_name()).withColumn("_ingested_at", F.lit(ingested_at).cast("timestamp_ntz"))


def sources(spark: SparkSession, root: str, env: str) -> dict[str, DataFrame]:
    """The named Parquet tables below root/env, by the catalog of folders there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/{env}")
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [x.getPath().getName() for x in fs.listStatus(hadoop)]
    return {n.removesuffix(".parquet"): spark.read.parquet(f"{root}/{env}/{n}") for n in sorted(names)}


def load_seed(spark: SparkSession, path: str) -> DataFrame:
    """A lookup table (source_value, target_value) from CSV."""
    return spark.read.csv(path, header=True).select("source_value", "target_value")
