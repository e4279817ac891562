"""A dataset kept up to date: a run works on the files that are new or changed since the last one, and on nothing else.

Every source file has partitions of its own, written by the run that last worked on it. The state, one row a file (digest, times, run,
numbers of rows), is a table that is replaced whole, so a run's new partitions, those it keeps and those it gives up count from
one moment on; a run that fails leaves the last version. Row numbers and the fills that reach across files belong to the whole
table, so they are made when it is read: numbers from one offset a file.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomtab.operators import ranges, tables, values
from loomtab.sources import digests, headers, incremental, scratch, snapshots
from loomtab.sources.spec import GENERATED, DatasetSpec

STATE = f"{incremental.STATE}, run string, n_rows long, n_bad long, spec string"


@dataclass(frozen=True)
class Refreshed:
    """changes: (name, status) of every file; version of the state; skipped: nothing had changed, so nothing was written."""

    changes: DataFrame
    version: int
    skipped: bool


def state(spark: SparkSession, out: str) -> DataFrame:
    """The saved state, without rows before the first run."""
    return snapshots.read(spark, f"{out}/state") if snapshots.latest(spark, f"{out}/state") else spark.createDataFrame([], STATE)


def _present(spark: SparkSession, out: str) -> DataFrame:
    """(name, run) whose partitions of good rows exist: one listing of folders."""
    fs, at = scratch.hadoop(spark, f"{out}/data/_run=*/_verdict=good/_file=*")
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    found = []
    for x in fs.globStatus(at) or []:
        run, _, file = str(x.getPath().toString()).rsplit("/", 3)[1:]
        found.append((unescape(file.removeprefix("_file=")), run.removeprefix("_run=")))
    return spark.createDataFrame(found, "name string, run string")


def refresh(spark: SparkSession, spec: DatasetSpec, raw: str, out: str, at: str, fmt: str = "csv", pattern: str = "*", force: bool = False) -> Refreshed:
    """Bring the table in folder `out` up to date with the files of folder `raw`; `at` is the time of the run.

    A file is worked on if it is new, if its content differs, if its rows are gone from `out`, or if the declaration of the dataset
    has changed; force takes all. Files that are gone leave the table. Two runs at once: the second to commit fails with Conflict.
    """
    kept_at = f"{out}/state"
    last = snapshots.latest(spark, kept_at)
    version, old = (last[0] if last else 0), state(spark, out)
    declared = hashlib.sha256(repr(spec).encode()).hexdigest()
    now = spark.createDataFrame([tuple(r) for r in digests.hash_files(spark, raw, pattern).collect()], "name string, digest string, size long")  # one row a file
    there = old.join(_present(spark, out), ["name", "run"], "left_semi").unionByName(old.where("n_rows = 0")).where(F.col("spec") == declared).select("name")
    changes = spark.createDataFrame([tuple(r) for r in incremental.detect_changes(now, old, there, force).collect()], "name string, status string")
    if incremental.may_skip(changes, bool(last), force, True):
        return Refreshed(changes, version, True)
    todo = [r["name"] for r in changes.where("status in ('new', 'changed')").collect()]
    run = uuid.uuid4().hex[:12]
    try:
        counts = _work(spark, spec, raw, f"{out}/data/_run={run}", fmt, pattern, todo)
        fresh = incremental.next_state(now, old, at).join(spark.createDataFrame([(n,) for n in todo], "name string"), "name", "left_semi").withColumn("last_processed", F.lit(at))
        fresh = fresh.join(counts, "name", "left").select(*[f.split()[0] for f in incremental.STATE.split(", ")], F.lit(run).alias("run"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_rows", "n_bad")], F.lit(declared).alias("spec"))
        same = old.join(changes.where("status = 'unchanged'"), "name", "left_semi")
        snapshots.replace(same.unionByName(fresh).coalesce(1), kept_at, after=version)
    except Exception:
        scratch.remove(spark, f"{out}/data/_run={run}")
        raise
    return Refreshed(changes, version + 1, False)


def _work(spark: SparkSession, spec: DatasetSpec, raw: str, to: str, fmt: str, pattern: str, names: list[str]) -> DataFrame:
    """Write the partitions of these files, and count their rows: (name, n_rows, n_bad)."""
    none = spark.createDataFrame([], "name string, n_rows long, n_bad long")
    frames = headers.read_by_header(spark, headers.scan_headers(spark, raw, fmt, pattern, names), fmt) if names else []
    if not frames:
        return none
    parts = []
    for df in frames:
        renamed = tables.rename_by_alias(df, {**spec.aliases, "_file": "_file", "_at": "_at"})
        parts.append(tables.add_missing(renamed, {c: "string" for c in spec.declared}).select(*spec.declared, "_file", "_at"))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    held = scratch.new_folder(spark, "quarantine")
    parted = tables.quarantine(stacked, spec, held)
    good = values.apply_value_maps(parted.good, {c: dict(m) for c, m in spec.value_maps.items()})
    numbered = ranges.numbered(good, "_nth", ["_at.block", "_at.row"], ["_file"]).drop("_at")
    numbered.write.partitionBy("_file").parquet(f"{to}/_verdict=good")
    parted.bad.drop("_at").write.partitionBy("_file").parquet(f"{to}/_verdict=bad")
    n_good = spark.read.schema("_file string").parquet(f"{to}/_verdict=good").groupBy(F.col("_file").alias("name")).agg(F.count(F.lit(1)).alias("n_rows"))
    n_bad = spark.read.schema("_file string").parquet(f"{to}/_verdict=bad").groupBy(F.col("_file").alias("name")).agg(F.count(F.lit(1)).alias("n_bad"))
    counts = spark.createDataFrame([tuple(r) for r in n_good.join(n_bad, "name", "full").collect()], none.schema)  # one row a file
    scratch.remove(spark, held)
    return counts


def _live(spark: SparkSession, out: str, verdict: str, columns: T.StructType, files: DataFrame) -> DataFrame:
    """The rows of the partitions that the state names: others are never opened."""
    named = [f"{r['run']}/{r['name']}" for r in files.select("run", "name").collect()]  # one text a file
    fs, at = scratch.hadoop(spark, f"{out}/data")
    schema = T.StructType([*columns.fields, *[T.StructField(c, T.StringType()) for c in ("_run", "_verdict", "_file")]])
    if not named or not fs.exists(at):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(f"{out}/data")
    return rows.where((F.col("_verdict") == verdict) & F.concat("_run", F.lit("/"), "_file").isin(named))


def table(spark: SparkSession, spec: DatasetSpec, out: str) -> DataFrame:
    """The curated table as it stands: the declared columns, row_id in the order of file names and places, _source_file and _ingested_at.

    _ingested_at is the time of the run that worked on the row's file.
    """
    files = state(spark, out)
    columns = T.StructType([*[f for f in spec.schema().fields if f.name in spec.declared], T.StructField("_nth", T.LongType())])
    before = F.coalesce(F.sum("n_rows").over(W.orderBy("name").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # one row a file
    offsets = files.select(F.col("name").alias("_file"), before.alias("_before"), F.col("last_processed").cast("timestamp_ntz").alias("_ingested_at"))
    rows = _live(spark, out, "good", columns, files).join(F.broadcast(offsets), "_file")
    numbered = rows.withColumns({"row_id": F.col("_before") + F.col("_nth"), "_source_file": F.col("_file")})
    filled = values.fill(numbered, {c.name: c.fill_strategy for c in spec.columns if c.fill_strategy})
    return filled.select(*spec.declared, *[c for c in GENERATED if c not in spec.declared])


def rejected(spark: SparkSession, spec: DatasetSpec, out: str) -> DataFrame:
    """The raw rows that could not be cast, as text, with their file."""
    text = T.StructType([T.StructField(c, T.StringType()) for c in spec.declared])
    return _live(spark, out, "bad", text, state(spark, out)).select(*spec.declared, "_file")


def vacuum(spark: SparkSession, out: str, keep: int = 2) -> list[str]:
    """Remove partitions and states that the newest `keep` versions do not name; gives the partitions. Run it while no run is at work."""
    snapshots.vacuum(spark, f"{out}/state", keep)
    live = set()
    for n, _ in snapshots.versions(spark, f"{out}/state"):
        live |= {(r["run"], r["name"]) for r in snapshots.read(spark, f"{out}/state", n).select("run", "name").collect()}  # one row a file
    fs, at = scratch.hadoop(spark, f"{out}/data/_run=*/_verdict=*/_file=*")
    unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    gone = []
    for x in fs.globStatus(at) or []:
        run, verdict, file = x.getPath().toString().rsplit("/", 3)[1:]
        if (run.removeprefix("_run="), unescape(file.removeprefix("_file="))) not in live:
            fs.delete(x.getPath(), True)
            gone.append(f"{run}/{verdict}/{file}")
    return sorted(gone)
