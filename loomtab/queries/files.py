"""Queries of what happens among files: each writes raw files or tables from the given ones to the shared folder, and works on those."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtab.operators import drift, tables
from loomtab.plans import build, refresh
from loomtab.sources import headers, ingest, scratch, sinks, snapshots
from loomtab.sources.spec import ColumnSpec, DatasetSpec

from .base import derived, duck, query, table
from . import workflow  # noqa: F401  its SQL is used below
from .shapes import ANY_BAD, AS_BOOL, AS_FLOAT, AS_TIME, DIRTY, IS_BAD, SPEC


def put_files(df: DataFrame, name: str, order: str, folder: str, columns: list[str]) -> None:
    """Write df's text columns as CSV files folder/<name>.csv, one for each value of column `name`, rows by `order`."""
    spark, beside = df.sparkSession, f"{folder}.new-{uuid.uuid4().hex[:8]}"
    df.repartition(name).sortWithinPartitions(name, order).select(name, *columns).write.option("header", True).partitionBy(name).csv(beside)
    fs, at = scratch.hadoop(spark, f"{beside}/{name}=*/part-*.csv")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(folder))
    for x in fs.globStatus(at) or []:
        to = path(f"{folder}/{x.getPath().getParent().getName().removeprefix(f'{name}=')}.csv")
        fs.delete(to, False)
        fs.rename(x.getPath(), to)
    scratch.remove(spark, beside)


ORDERS = DatasetSpec(
    "orders", (ColumnSpec("o_orderkey", "int64", nullable=False, primary_key=True), ColumnSpec("status"), ColumnSpec("price", "float64", fill_strategy="fill_zero"), ColumnSpec("clerk", fill_strategy="fill_forward")),
    aliases={"O_ORDERSTATUS": "status", "Total Price": "price"}, value_maps={"status": {"F": "Finished", "O": "Open"}},
)
RAW_ORDERS = """SELECT o_orderkey AS k, concat('f', cast(o_orderkey % 6 AS {text})) AS file, cast(o_orderkey AS {text}) AS o_orderkey, o_orderstatus AS status,
  CASE WHEN o_orderkey % 50 = 7 THEN 'none' WHEN o_orderkey % 9 = 0 THEN NULL ELSE cast(cast(o_totalprice AS double) AS {text}) END AS price,
  CASE WHEN o_orderkey % 4 = 1 THEN concat('c', cast(o_custkey AS {text})) END AS clerk FROM {orders}"""
RUNS = ("2024-01-01 00:00:00", "2024-01-02 00:00:00")


def _move(s: SparkSession, file: str, to: str) -> None:
    """Give a file, if it is there, another name, in place of the file that has it."""
    (fs, at), (_, new) = scratch.hadoop(s, file), scratch.hadoop(s, to)
    if fs.exists(at):
        fs.mkdirs(new.getParent())
        fs.delete(new, False)
        fs.rename(at, new)


def _two_runs(s: SparkSession, d: str) -> tuple[str, list[refresh.Refreshed]]:
    """Run once on files f0 to f4, with f2 in an older state; then f2 is mended, f4 goes and f5 comes; run again, and once more for nothing."""
    made, raw, out = scratch.new_folder(s, "made"), scratch.new_folder(s, "raw"), scratch.new_folder(s, "refreshed")
    rows = derived(s, d, RAW_ORDERS)
    shown = ["o_orderkey", "`O_ORDERSTATUS`", "`Total Price`", "clerk"]
    named = rows.withColumnsRenamed({"status": "O_ORDERSTATUS", "price": "Total Price"})
    older = named.where("file = 'f2'").withColumns({"Total Price": F.lit("1"), "O_ORDERSTATUS": F.lit("?")})
    later = named.where("file in ('f2', 'f5')").withColumn("file", F.concat(F.lit("later_"), "file"))
    put_files(named.where("file in ('f0', 'f1', 'f3', 'f4')").unionByName(older).unionByName(later), "file", "k", made, shown)  # all states in one job: a file is one task's work
    for n in ("f0", "f1", "f2", "f3", "f4"):
        _move(s, f"{made}/{n}.csv", f"{raw}/{n}.csv")
    runs = [refresh.refresh(s, ORDERS, raw, out, RUNS[0], pattern="*.csv")]
    for n in ("f2", "f5"):
        _move(s, f"{made}/later_{n}.csv", f"{raw}/{n}.csv")
    scratch.remove(s, f"{raw}/f4.csv")
    runs += [refresh.refresh(s, ORDERS, raw, out, RUNS[1], pattern="*.csv") for _ in range(2)]
    scratch.remove(s, raw)
    scratch.remove(s, made)
    return out, runs


GOOD_ORDERS = "SELECT * FROM raw WHERE file <> 'f4' AND NOT (price IS NOT NULL AND TRY_CAST(price AS DOUBLE) IS NULL)"


@query("refreshed_dataset", duck(f"""WITH raw AS ({RAW_ORDERS}), good AS (SELECT *, row_number() OVER (ORDER BY file, k) AS row_id FROM ({GOOD_ORDERS}))
  SELECT k AS o_orderkey, CASE status WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE status END AS status, coalesce(cast(price AS DOUBLE), 0.0) AS price,
    last_value(clerk IGNORE NULLS) OVER (ORDER BY row_id) AS clerk, row_id, concat(file, '.csv') AS _source_file, CASE WHEN file IN ('f2', 'f5') THEN TIMESTAMP '{RUNS[1]}' ELSE TIMESTAMP '{RUNS[0]}' END AS _ingested_at FROM good"""))
def _(s, d):
    return refresh.table(s, ORDERS, _two_runs(s, d)[0])


@query("refreshed_rejects", duck(f"WITH raw AS ({RAW_ORDERS}) SELECT o_orderkey, status, price, clerk, concat(file, '.csv') AS _file FROM raw WHERE file <> 'f4' AND price = 'none'"))
def _(s, d):
    return refresh.rejected(s, ORDERS, _two_runs(s, d)[0])


@query("refreshed_state", duck(f"""WITH raw AS ({RAW_ORDERS}), f AS (SELECT file, count(*) FILTER (price IS NULL OR price <> 'none') AS n_rows, count(*) FILTER (price = 'none') AS n_bad FROM raw GROUP BY 1)
  SELECT concat(file, '.csv') AS name, n_rows, n_bad, CASE WHEN file = 'f5' THEN '{RUNS[1]}' ELSE '{RUNS[0]}' END AS first_seen, CASE WHEN file IN ('f2', 'f5') THEN '{RUNS[1]}' ELSE '{RUNS[0]}' END AS last_processed FROM f WHERE file <> 'f4'"""))
def _(s, d):
    return refresh.state(s, _two_runs(s, d)[0]).select("name", "n_rows", "n_bad", "first_seen", "last_processed")


@query("refreshed_changes", duck(f"""WITH raw AS ({RAW_ORDERS}), f AS (SELECT DISTINCT file FROM raw)
  SELECT 1 AS run, false AS skipped, concat(file, '.csv') AS name, 'new' AS status FROM f WHERE file <> 'f5' UNION ALL
  SELECT 2, false, concat(file, '.csv'), CASE file WHEN 'f2' THEN 'changed' WHEN 'f4' THEN 'gone' WHEN 'f5' THEN 'new' ELSE 'unchanged' END FROM f UNION ALL
  SELECT 3, true, concat(file, '.csv'), 'unchanged' FROM f WHERE file <> 'f4'"""))
def _(s, d):
    first, second, third = (r.changes.select(F.lit(i).alias("run"), F.lit(r.skipped).alias("skipped"), "name", "status") for i, r in enumerate(_two_runs(s, d)[1], 1))
    return first.unionByName(second).unionByName(third)


RAW_EVENTS = "SELECT event_id, cast(event_id AS {text}) AS id, cast(user_id AS {text}) AS who, event_type AS kind, props, event_id % 3 AS style, concat('s', cast(event_id % 3 AS {text}), '-', cast(user_id % 4 AS {text})) AS file FROM {events}"
STYLES = {0: ["id", "who", "kind"], 1: ["kind", "id"], 2: ["id", "props", "who"]}


def _event_files(s: SparkSession, d: str) -> str:
    raw, rows = scratch.new_folder(s, "raw"), derived(s, d, RAW_EVENTS)
    for style, columns in STYLES.items():
        put_files(rows.where(F.col("style") == style), "file", "event_id", raw, columns)
    return raw


@query("combined_files", duck(f"WITH raw AS ({RAW_EVENTS}) SELECT id, CASE WHEN style <> 1 THEN who END AS who, CASE WHEN style <> 2 THEN kind END AS kind, CASE WHEN style = 2 THEN props END AS props, concat(file, '.csv') AS _file FROM raw"))
def _(s, d):
    return headers.combine_files(s, _event_files(s, d)).select("id", "who", "kind", "props", "_file")


@query("scanned_headers", duck(f"""WITH raw AS ({RAW_EVENTS}), f AS (SELECT DISTINCT concat(file, '.csv') AS file, CASE style {' '.join(f"WHEN {k} THEN ['" + "', '".join(v) + "']" for k, v in STYLES.items())} END AS cols FROM raw)
  SELECT file, cast(pos AS INTEGER) AS pos, cols[pos + 1] AS col, 'string' AS type, true AS has_rows FROM f, unnest(range(len(cols))) AS u(pos)"""))
def _(s, d):
    return headers.scan_headers(s, _event_files(s, d)).drop("path")


@query("scanned_header_drift", duck(f"""WITH raw AS ({RAW_EVENTS}), f AS (SELECT DISTINCT concat(file, '.csv') AS file, style FROM raw), c(col, styles) AS (VALUES {', '.join(f"('{c}', {[k for k, v in STYLES.items() if c in v]})" for c in ('id', 'who', 'kind', 'props'))})
  SELECT col, coalesce(string_agg(file, ',' ORDER BY file) FILTER (list_contains(styles, style)), '') AS present_in, coalesce(string_agg(file, ',' ORDER BY file) FILTER (NOT list_contains(styles, style)), '') AS missing_from, bool_and(list_contains(styles, style)) AS in_all FROM f, c GROUP BY col"""))
def _(s, d):
    return drift.schema_drift(headers.scan_headers(s, _event_files(s, d)).select("file", "col"))


def _parted(s: SparkSession, d: str) -> tables.Quarantined:
    return tables.quarantine(derived(s, d, DIRTY), SPEC, scratch.new_folder(s, "quarantine"))


@query("quarantine_good", duck(f"SELECT event_id, {AS_FLOAT} AS v, {AS_TIME} AS w, {AS_BOOL} AS b FROM ({DIRTY}) WHERE NOT ({ANY_BAD})"))
def _(s, d):
    return _parted(s, d).good


@query("quarantine_bad", duck(f"SELECT * FROM ({DIRTY}) WHERE {ANY_BAD}"))
def _(s, d):
    return _parted(s, d).bad


@query("quarantine_counts", duck(f"SELECT 'good' AS what, count(*) FILTER (NOT ({ANY_BAD})) AS n FROM ({DIRTY}) UNION ALL SELECT 'bad', count(*) FILTER ({ANY_BAD}) FROM ({DIRTY})" + "".join(f" UNION ALL SELECT 'column {c}', count(*) FILTER ({b}) FROM ({DIRTY})" for c, b in {"event_id": "false", **IS_BAD}.items())))
def _(s, d):
    return s.createDataFrame(sorted(_parted(s, d).counts.items()), "what string, n long")


# tables that are replaced, exported, loaded


@query("versioned_table", "SELECT o_orderkey, o_orderstatus, 2 AS version FROM orders WHERE o_orderstatus <> 'P'")
def _(s, d):
    path = scratch.new_folder(s, "versions")
    first = snapshots.replace(table(s, d, "orders").select("o_orderkey", "o_orderstatus").withColumn("version", F.lit(1)), path)
    return snapshots.replace(first.where("o_orderstatus <> 'P'").withColumn("version", F.lit(2)), path, after=1)


@query("version_of_before", "SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY 1")
def _(s, d):
    path = scratch.new_folder(s, "versions")
    snapshots.replace(table(s, d, "orders").select("o_orderkey", "o_orderstatus"), path, ["o_orderstatus"])
    snapshots.replace(snapshots.read(s, path).where("o_orderkey < 0"), path)
    return snapshots.read(s, path, 1).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))


@query("replaced_table", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_nationkey % 2 = 0")
def _(s, d):
    path = scratch.new_folder(s, "replaced")
    first = sinks.overwrite_atomic(table(s, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey"), path)
    return sinks.overwrite_atomic(first.where("c_nationkey % 2 = 0").select("c_custkey", "c_mktsegment"), path)


@query("exported_table", "SELECT l_returnflag, count(*) AS n_items, min(l_orderkey) AS first_order FROM lineitem WHERE l_linenumber > 1 GROUP BY 1")
def _(s, d):
    name, folder = f"export_{uuid.uuid4().hex[:8]}", scratch.new_folder(s, "exports")
    sinks.export_table(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), name, folder)
    sinks.export_table(s.table(name).where("l_linenumber > 1"), name, folder)
    found = scratch.stored(s.table(name).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_items"), F.min("l_orderkey").alias("first_order")), scratch.new_folder(s, "answer"))
    s.sql(f"DROP TABLE {name}")
    return found


@query("warehouse_counts", "SELECT 'lineitem' AS table_name, count(*) AS n_rows, true AS ok FROM lineitem UNION ALL SELECT 'nation', count(*), true FROM nation UNION ALL SELECT 'nowhere', NULL, false")
def _(s, d):
    root = scratch.new_folder(s, "warehouse")
    paths = {t: f"{d}/{t}.parquet" for t in ("lineitem", "nation", "nowhere")}
    written = build.warehouse_build(s, paths, ("nowhere",), lambda df, n: df.write.parquet(f"{root}/{n}"))
    return sinks.verify_warehouse({n: s.read.parquet(f"{root}/{n}") for n in written}, list(paths), ["lineitem"])


@query("report_as_json", "SELECT event_type, count(*) AS n_events, max(event_id) AS last_event FROM events GROUP BY 1")
def _(s, d):
    path = scratch.new_folder(s, "report")
    sinks.write_report(table(s, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"), F.max("event_id").alias("last_event")), path)
    return s.read.schema("event_type string, n_events long, last_event long").json(path)


@query("seeded_lookup", "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Building' WHEN 'MACHINERY' THEN 'Machinery' ELSE c_mktsegment END AS segment FROM customer")
def _(s, d):
    from loomtab.operators import values

    path = scratch.new_folder(s, "seed")
    segments = table(s, d, "customer").select("c_mktsegment").distinct().where("c_mktsegment in ('BUILDING', 'MACHINERY')")
    segments.select(F.col("c_mktsegment").alias("source_value"), F.initcap("c_mktsegment").alias("target_value")).coalesce(1).write.option("header", True).csv(path)
    return values.lookup_normalize(table(s, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment")), "segment", ingest.load_seed(s, path))


@query("clean_file_rows", "SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 1 THEN s_nationkey END AS s_nationkey FROM supplier")
def _(s, d):
    folder, path = scratch.new_folder(s, "clean"), s.sparkContext._jvm.org.apache.hadoop.fs.Path
    rows = table(s, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    parts = {"odd": rows.where("s_suppkey % 2 = 1"), "even": rows.where("s_suppkey % 2 = 0").drop("s_nationkey"), "odd_errors": rows.select(F.lit("x").alias("s_suppkey")), "tmp_1": rows.limit(1)}
    for n, df in parts.items():
        df.coalesce(1).write.parquet(f"{folder}/_{n}")
        fs, at = scratch.hadoop(s, f"{folder}/_{n}/part-*.parquet")
        fs.rename(fs.globStatus(at)[0].getPath(), path(f"{folder}/{n}.parquet"))
    return ingest.clean_files(s, folder)


def _stored_mart(name: str, of: str) -> None:
    from .base import AS_OF, ORACLES, master, people, tasks, workers

    @query(name, ORACLES[of])
    def _(s, d):
        made = build.build_marts(tasks(s, d), workers(s, d), master(s, d), people(s, d), AS_OF, scratch.new_folder(s, "marts"))
        return made[of]


for _name, _of in (("stored_join_demand", "mart_team_demand"), ("stored_join_onshore", "mart_onshore_offshore"), ("stored_tasks_turnaround", "mart_turnaround")):
    _stored_mart(_name, _of)
