"""Registering queries with their SQL, and the stand-in tables that both engines derive from the given ones."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The moment that stands for "now".
AS_OF = "2024-02-15 12:00:00"


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def derived(spark: SparkSession, d: str, sql: str, **tables: str) -> DataFrame:
    """SQL over given tables, in the words that both engines know but for a few types."""
    text = spell(sql, True)
    return spark.sql(text, **{t: table(spark, d, t) for t in tables or _named(sql)})


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "benchmark", "conversations")


def _named(sql: str) -> list[str]:
    return [t for t in TABLES if f"{{{t}}}" in sql]


#: Where the two engines spell the same thing differently: (DuckDB, Spark).
SPELLINGS = {
    "{text}": ("varchar", "string"), "{div}": ("//", "div"), "{long}": ("bigint", "bigint"),
    "{k}": ("cast(json_extract_string(props, '$.k') as bigint)", "cast(get_json_object(props, '$.k') as bigint)"),
    "{start}": ("ts + to_minutes(cast(floor(value) as bigint))", "timestampadd(MINUTE, cast(floor(value) as int), ts)"),
    "{end}": ("ts + to_minutes(cast(floor(value) as bigint) + cast(json_extract_string(props, '$.k') as bigint))", "timestampadd(MINUTE, cast(floor(value) + cast(get_json_object(props, '$.k') as bigint) as int), ts)"),
    "{ntz}": ("timestamp", "timestamp_ntz"), "{bs}": ("'\\'", "'\\\\'"),
}


def spell(sql: str, spark: bool) -> str:
    for k, pair in SPELLINGS.items():
        sql = sql.replace(k, pair[spark])
    return sql


def duck(sql: str) -> str:
    out = spell(sql, False)
    for t in TABLES:
        out = out.replace(f"{{{t}}}", t)
    return out


TASKS = """
SELECT event_id AS row_id, event_id {div} 8 AS taskid, event_type AS stepname,
  CASE event_id % 3 WHEN 0 THEN 'uw renewal' WHEN 1 THEN 'UW Renewal' END AS flowname,
  CASE event_type WHEN 'purchase' THEN 'DONE' WHEN 'signup' THEN 'Pending' WHEN 'error' THEN NULL ELSE 'In Progress' END AS taskstatus,
  concat('  U', cast(user_id AS {text}), ' ') AS assignedto, concat('u', cast((user_id * 7) % 150 AS {text})) AS taskfrom,
  concat(' U', cast((user_id * 3) % 150 AS {text}), '  ') AS operationby,
  CASE WHEN event_id % 2 = 0 THEN concat('DR  ', cast(event_id % 4 AS {text})) ELSE concat('DR ', cast(event_id % 4 AS {text})) END AS drawer,
  concat('C', cast(user_id % 7 AS {text})) AS carrier, concat('F', cast(event_id {div} 8 AS {text})) AS filenumber,
  CASE WHEN user_id % 9 = 0 THEN NULL ELSE concat('P', cast(user_id AS {text})) END AS policynumber, concat('A', cast(user_id % 11 AS {text})) AS acctexec,
  ts AS dateavailable, ts AS dateinitiated, {start} AS starttime, CASE WHEN event_id % 10 = 0 THEN NULL ELSE {end} END AS endtime,
  CASE WHEN event_type = 'purchase' THEN {end} END AS dateended
FROM {events}
"""
WORKERS = """
SELECT concat('U', cast(c_custkey AS {text})) AS employee_id, c_name AS teammate, n_name AS cost_center, r_name AS cost_center_hierarchy, c_mktsegment AS management_level,
  c_mktsegment AS job_profile, n_name AS business_title, cast(round(c_acctbal, 0) AS double) AS fte, cast(c_custkey % 40 AS double) AS scheduled_weekly_hours,
  CASE WHEN c_custkey % 7 = 0 THEN 'Leave' ELSE 'Active' END AS current_status, concat(' ', c_name, '@X.Org ') AS work_email, concat('M', cast(c_nationkey AS {text})) AS direct_manager
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
"""
MASTER = """
SELECT s_suppkey AS row_id, concat(' u', cast(s_suppkey {div} 2 AS {text})) AS employee_id, s_name AS name,
  CASE WHEN s_nationkey % 2 = 0 THEN 'onshore' ELSE 'offshore' END AS source_system, cast(s_nationkey AS bigint) AS _ingested_at
FROM {supplier}
"""
PEOPLE = """
SELECT s_suppkey AS row_id, concat('U', cast(s_suppkey {div} 2 AS {text})) AS userid, cast(s_suppkey AS {text}) AS id, concat(' ', s_name, ' ') AS full_name,
  CASE s_suppkey % 6 WHEN 0 THEN '' WHEN 1 THEN ' N/A' WHEN 2 THEN 'null' WHEN 3 THEN NULL ELSE ' Lead ' END AS title,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL WHEN s_suppkey % 3 = 1 THEN concat('corp', {bs}, s_name) ELSE s_name END AS netwarelogin,
  concat(s_name, '@x.org') AS email, cast(s_nationkey % 4 AS {text}) AS divisionid, concat('Div', cast(s_nationkey % 4 AS {text})) AS division, concat('D', cast(s_nationkey % 4 AS {text})) AS division1,
  cast(s_nationkey AS {text}) AS teamid, concat('Team', cast(s_nationkey AS {text})) AS team, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE cast(s_nationkey AS bigint) END AS _ingested_at
FROM {supplier}
"""
STATUS_PAIRS = [("DONE", "Completed"), ("WIP", "In Progress")]
FLOW_PAIRS = [("uw renewal", "UW Renewal"), ("uw new", "UW New")]

#: The staged tables in DuckDB.
_STAGED = """
t AS (SELECT * REPLACE (regexp_replace(drawer, '\\s+', ' ', 'g') AS drawer, lower(trim(assignedto)) AS assignedto, lower(trim(taskfrom)) AS taskfrom, lower(trim(operationby)) AS operationby,
  CASE taskstatus WHEN 'DONE' THEN 'Completed' WHEN 'WIP' THEN 'In Progress' ELSE taskstatus END AS taskstatus, CASE flowname WHEN 'uw renewal' THEN 'UW Renewal' WHEN 'uw new' THEN 'UW New' ELSE flowname END AS flowname) FROM raw),
em AS (SELECT * EXCLUDE (rn) FROM (SELECT * REPLACE (lower(trim(employee_id)) AS employee_id), row_number() OVER (PARTITION BY lower(trim(employee_id)) ORDER BY _ingested_at DESC NULLS LAST, row_id) AS rn FROM raw_master) WHERE rn = 1),
e AS (SELECT * EXCLUDE (rn) FROM (SELECT * REPLACE (trim(full_name) AS full_name, CASE WHEN trim(coalesce(title, '')) IN ('', 'NULL', 'null', 'N/A', 'n/a') THEN NULL ELSE title END AS title,
  CASE WHEN position('\\' IN netwarelogin) > 0 THEN concat(upper(split_part(netwarelogin, '\\', 1)), '\\', split_part(netwarelogin, '\\', 2)) ELSE netwarelogin END AS netwarelogin),
  row_number() OVER (PARTITION BY userid ORDER BY _ingested_at DESC NULLS LAST, row_id) AS rn FROM people) WHERE rn = 1)
"""


def oracle(body: str) -> str:
    """DuckDB SQL over the stand-ins: raw, t (staged tasks), w, em, people, e, and the given tables."""
    return f"WITH raw AS ({duck(TASKS)}), w AS ({duck(WORKERS)}), raw_master AS ({duck(MASTER)}), people AS ({duck(PEOPLE)}), {_STAGED} {duck(body)}"


def raw_tasks(spark: SparkSession, d: str) -> DataFrame:
    return derived(spark, d, TASKS)


def pairs(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, "source_value string, target_value string")


def tasks(spark: SparkSession, d: str) -> DataFrame:
    from loomtab.plans import marts

    return marts.stg_tasks(raw_tasks(spark, d), pairs(spark, STATUS_PAIRS), pairs(spark, FLOW_PAIRS))


def workers(spark: SparkSession, d: str) -> DataFrame:
    return derived(spark, d, WORKERS)


def master(spark: SparkSession, d: str) -> DataFrame:
    from loomtab.plans import marts

    return marts.stg_employees_master(derived(spark, d, MASTER))


def people(spark: SparkSession, d: str) -> DataFrame:
    from loomtab.plans import marts

    return marts.stg_employees(derived(spark, d, PEOPLE))
