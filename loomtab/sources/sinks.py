"""Writers: whole-table replacement, exports, reports, catalog checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scratch, snapshots


def overwrite_atomic(df: DataFrame, path: str) -> DataFrame:
    """Replace the Parquet table at path, which df may itself read: write beside it, then change names.

    Between the two changes of name there is a moment without the table. If the second fails, the old table gets its name
    back; it is deleted last of all.
    """
    spark = df.sparkSession
    beside, old = f"{path}.new-{uuid.uuid4().hex[:8]}", f"{path}.old-{uuid.uuid4().hex[:8]}"
    df.write.parquet(beside)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path_of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = fs.exists(path_of(path))
    if there and not fs.rename(path_of(path), path_of(old)):
        raise OSError(f"{path} could not be set aside; the new rows are in {beside}")
    if not fs.rename(path_of(beside), path_of(path)):
        if there and not fs.rename(path_of(old), path_of(path)):
            raise OSError(f"neither {beside} nor {old}, the old table, could be named {path}")
        raise OSError(f"{beside} could not be named {path}, which is as it was")
    if there:
        fs.delete(path_of(old), True)
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path)


def export_table(df: DataFrame, name: str, folder: str | None = None) -> None:
    """Create or replace one table of the warehouse, also with no rows; others stay. Rows lie below folder, the warehouse's own if None.

    The rows are written to a new folder. A table of this function's making whose columns stay the same is then set to that folder, which is one
    change in the catalog: readers see the old rows or the new ones, never none. Else the table is made anew in the catalog.
    """
    spark = df.sparkSession
    base = f"{(folder or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/_exports/{name}"
    to = f"{base}/{snapshots.new_version(base)}"
    df.write.parquet(to)
    old = _location(spark, name)
    if old and f"/_exports/{name}/" in old and spark.table(name).schema.simpleString() == df.schema.simpleString():
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{to}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, to, "parquet", df.schema)
    kept = {to, (old or "").rstrip("/")}
    fs, at = scratch.hadoop(spark, base)
    for x in fs.listStatus(at):  # the last rows before these stay, for readers that have begun with them
        if x.getPath().getName() not in {k.rpartition("/")[2] for k in kept}:
            fs.delete(x.getPath(), True)


def _location(spark: SparkSession, name: str) -> str | None:
    """Where the catalog has a table; None if it has none of that name."""
    if not spark.catalog.tableExists(name):
        return None
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}
    return told.get("Location")


def materialize(df: DataFrame, name: str, as_: str = "view") -> DataFrame:
    if as_ == "view":
        df.createOrReplaceTempView(name)
    else:
        export_table(df, name)
    return df.sparkSession.table(name)


def export_projection(df: DataFrame) -> DataFrame:
    """Date-times whose name says date or time as `yyyy-MM-dd HH:mm:ss` text; all else as it is."""
    def shown(name: str, kind: str):
        named = "date" in name.lower() or "time" in name.lower()
        return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name) if named and kind.startswith("timestamp") else F.col(name)

    return df.select([shown(*x) for x in df.dtypes])


def verification_totals(df: DataFrame, key: str | None = None) -> DataFrame:
    keys = [F.count_distinct(key).alias("distinct_keys")] if key in df.columns else []
    return df.agg(F.count(F.lit(1)).alias("total_rows"), *keys)


def verification_breakdown(df: DataFrame, status: str) -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def relations_by_pattern(names: DataFrame, pattern: str, exclude: str = "") -> DataFrame:
    """names (table_name) that are like the pattern and not like the exclusion, whatever the case."""
    found = names.where(F.col("table_name").ilike(pattern))
    return found.where(~F.col("table_name").ilike(exclude)) if exclude else found


def relations_by_prefix(names: DataFrame, prefix: str, exclude: str = "") -> DataFrame:
    return relations_by_pattern(names, f"{prefix}%", exclude)


def catalog_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """(table_name) of the catalog: one row a table, no data is read."""
    return spark.createDataFrame([(t.name,) for t in spark.catalog.listTables(database)], "table_name string")


def verify_warehouse(tables: dict[str, DataFrame], expected: list[str], nonempty: list[str]) -> DataFrame:
    """(table_name, n_rows, ok) of every expected and every extra table; missing ones have no count."""
    from functools import reduce

    spark = next(iter(tables.values())).sparkSession
    parts = [df.agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for n, df in tables.items()]
    counted = reduce(DataFrame.unionByName, parts)
    wanted = spark.createDataFrame([(n, n in nonempty) for n in expected], "table_name string, nonempty boolean")
    ok = F.col("n_rows").isNotNull() & (~F.coalesce("nonempty", F.lit(False)) | (F.col("n_rows") > 0))
    return wanted.join(counted, "table_name", "full").select("table_name", "n_rows", ok.alias("ok"))
