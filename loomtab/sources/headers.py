"""Headers of many files without their data, and one scan for all files of a header.

One job reads the first records of text files and the footers of Parquet files, on the executors; the driver gets one row for each
distinct header, and the names of its files.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import digests, ingest

SCHEMA = "path string, file string, pos int, col string, type string, has_rows boolean"


def scan_headers(spark: SparkSession, folder: str, fmt: str = "csv", pattern: str = "*", only: list[str] | None = None) -> DataFrame:
    """(path, file, pos, col, type, has_rows): one row for each header of each file of a folder (csv or parquet).

    only: names of the files to look into, all if None. Headers are cleaned as by ingest; every type in a text file is string. A file without any byte has no header.
    Where executors cannot open the store by themselves, Spark reads the first record of each file, one after another.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"{fmt} files have no header to read alone")
    files = digests.list_files(spark, folder, pattern).select("path", "name")
    files = files if only is None else files.where(F.col("name").isin(only))
    if not digests.python_opens(folder):
        rows = [(r["path"], r["name"], *x) for r in files.collect() for x in _by_spark(spark, r["path"], fmt)]  # names of files, not rows
        return spark.createDataFrame(rows, SCHEMA)
    spread = files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    stream = digests.opener()

    def of_text(path: str) -> list[tuple]:
        import csv
        import io

        with stream(path) as f:
            records = csv.reader(io.TextIOWrapper(f, "utf-8-sig", "replace", newline=""))
            names = next(records, None)
            more = next((r for r in records if r), None) is not None
        return [(i, (n or "").strip() or f"_unnamed_{i}", "string", more) for i, n in enumerate(names or [])]

    def of_parquet(path: str) -> list[tuple]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_type

        with stream(path) as f:
            told = pq.ParquetFile(f)
            return [(i, (x.name or "").strip() or f"_unnamed_{i}", from_arrow_type(x.type).simpleString(), told.metadata.num_rows > 0) for i, x in enumerate(told.schema_arrow)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.bool_()]
        for batch in batches:
            rows = [(path, name, *x) for path, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for x in (of_text if fmt == "csv" else of_parquet)(path)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [()] * 6, kinds, strict=True)], ["path", "file", "pos", "col", "type", "has_rows"])

    return spread.mapInArrow(run, SCHEMA)


def _by_spark(spark: SparkSession, path: str, fmt: str) -> list[tuple]:
    reader = spark.read.format(fmt)
    df = (reader.option("header", True).option("inferSchema", False) if fmt == "csv" else reader).load(path)
    more = bool(df.take(1))
    return [(i, ingest.clean_header(c, i), k, more) for i, (c, k) in enumerate(df.dtypes)]


def by_header(headers: DataFrame) -> list[tuple[list[str], list[str]]]:
    """(columns, paths) of each distinct header in its order, of files that have rows: what the driver needs to plan a scan for each."""
    each = headers.where("has_rows").groupBy("path").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "col"))), lambda x: x["col"]).alias("cols"))
    found = each.groupBy("cols").agg(F.array_sort(F.collect_list("path")).alias("paths")).collect()
    return sorted(((list(r["cols"]), list(r["paths"])) for r in found), key=lambda x: x[1][0])


def read_by_header(spark: SparkSession, headers: DataFrame, fmt: str = "csv") -> list[DataFrame]:
    """One all-text scan for each header, with _file and _at, a row's file and place; files without rows are passed over."""
    return [_scan(spark, columns, paths, fmt) for columns, paths in by_header(headers)]


def _scan(spark: SparkSession, columns: list[str], paths: list[str], fmt: str) -> DataFrame:
    if fmt == "csv":
        schema = ", ".join(f"_c{i} string" for i in range(len(columns)))
        raw = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(paths)
        text, at = [F.col(f"_c{i}") for i in range(len(columns))], F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    else:
        raw = spark.read.parquet(*paths)
        text, at = [F.col(f"`{c}`").cast("string") for c in raw.columns], F.struct(F.lit(0).cast("long").alias("block"), F.col("_metadata.row_index").alias("row"))
    return raw.select(*[x.alias(c) for x, c in zip(text, columns, strict=True)], ingest.file_name().alias("_file"), at.alias("_at"))


def combine_files(spark: SparkSession, folder: str, fmt: str = "csv", pattern: str = "*") -> DataFrame:
    """All rows of a folder's files under the columns of all, NULL where a file lacks one: a plan of one scan for each header, however many files.

    Columns of equal name in one file keep their first. Files without rows are passed over, their columns too; a folder without rows is an error.
    """
    parts = read_by_header(spark, scan_headers(spark, folder, fmt, pattern), fmt)
    if not parts:
        raise ValueError("every table is empty")
    firsts = []
    for df in parts:
        keep = [i for i, c in enumerate(df.columns) if c not in df.columns[:i]]
        places = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
        firsts.append(places.select([F.col(f"_{i}").alias(df.columns[i]) for i in keep]).drop("_at"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), firsts)
