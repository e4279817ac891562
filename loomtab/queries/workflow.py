"""Queries of staging, facts, marts and reports."""

from __future__ import annotations

from loomtab.plans import marts

from .base import AS_OF, derived, master, oracle, people, query, raw_tasks, tasks, workers

MIN = "date_diff('minute', starttime, endtime)"
COMPLETED = "count(*) FILTER (WHERE taskstatus = 'Completed')"
N = "count(*)"


def avg(total: str, count: str, digits: int, unit: int = 1) -> str:
    s = f"{float(10**digits)}::DOUBLE"
    return f"floor({total} * {s} / (nullif({count}, 0) * {unit}) + 0.5) / {s}"


AVG_HOURS = avg(f"sum({MIN})", f"count({MIN})", 2, 60)
SPLIT = f"{COMPLETED} AS completed, count(*) FILTER (WHERE taskstatus = 'In Progress') AS in_progress, count(*) FILTER (WHERE taskstatus = 'Pending') AS pending"
DUR = f"{MIN} AS duration_minutes, round({MIN} / 60.0::DOUBLE, 2) AS duration_hours, cast(date_diff('hour', dateinitiated, dateended) AS DOUBLE) AS lifecycle_hours, cast(dateinitiated AS DATE) AS task_date"


@query("stg_tasks", oracle("SELECT * FROM t"))
def _(s, d):
    return tasks(s, d)


@query("stg_employees", oracle("SELECT * FROM e"))
def _(s, d):
    return people(s, d)


@query("stg_employees_master", oracle("SELECT * FROM em"))
def _(s, d):
    return master(s, d)


@query("stg_workers", oracle("SELECT * REPLACE (lower(trim(work_email)) AS work_email) FROM w"))
def _(s, d):
    return marts.stg_workers(workers(s, d))


IR = "SELECT c_custkey AS row_id, concat(' ', c_name, '  ') AS user_network_login, CASE WHEN c_custkey % 2 = 0 THEN 'y' ELSE 'n' END AS acctexecflag, c_mktsegment AS team FROM {customer}"


@query("stg_ir_employees", oracle(f"SELECT * REPLACE (lower(trim(user_network_login)) AS user_network_login, upper(acctexecflag) AS acctexecflag) FROM ({IR})"))
def _(s, d):
    return marts.stg_ir_employees(derived(s, d, IR))


FTC = """SELECT taskid, filenumber, policynumber, flowname, stepname AS final_stepname, carrier, acctexec, cast(dateended AS DATE) AS completed_date, dateinitiated, dateended,
  cast(date_diff('hour', dateinitiated, dateended) AS DOUBLE) AS tat_hours FROM t WHERE taskstatus = 'Completed' AND dateended IS NOT NULL AND dateinitiated IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY taskid ORDER BY dateended DESC, row_id) = 1"""


@query("fact_task_completed", oracle(FTC))
def _(s, d):
    return marts.fact_task_completed(tasks(s, d))


@query("fact_task_current", oracle(f"""SELECT taskid, flowname, stepname AS current_stepname, assignedto, filenumber, policynumber, carrier, acctexec, dateavailable, DATE '{AS_OF[:10]}' AS as_of_date,
  cast(date_diff('hour', dateavailable, TIMESTAMP '{AS_OF}') AS DOUBLE) AS aging_hours FROM t WHERE taskstatus <> 'Completed' AND dateavailable IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY taskid ORDER BY dateavailable DESC, row_id) = 1"""))
def _(s, d):
    return marts.fact_task_current(tasks(s, d), AS_OF)


@query("fact_task_event", oracle(f"""SELECT taskid, flowname, stepname, assignedto, dateavailable, starttime, endtime, cast(dateavailable AS DATE) AS event_date,
  round(date_diff('minute', dateavailable, starttime) / 60.0::DOUBLE, 2) AS queue_wait_hours, round({MIN} / 60.0::DOUBLE, 2) AS work_duration_hours FROM t WHERE dateavailable IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY taskid, stepname, dateavailable, starttime, endtime ORDER BY row_id) = 1"""))
def _(s, d):
    return marts.fact_task_event(tasks(s, d))


@query("fact_task_rework", oracle(f""", c AS (SELECT taskid FROM ({FTC})),
  x AS (SELECT taskid, stepname, date_diff('minute', dateavailable, starttime) AS wait, {MIN} AS work,
    row_number() OVER (PARTITION BY taskid, stepname, dateavailable, starttime, endtime ORDER BY row_id) AS copy,
    row_number() OVER (PARTITION BY taskid, stepname ORDER BY dateavailable NULLS LAST, starttime NULLS LAST, endtime NULLS LAST, row_id) AS visit FROM t WHERE taskid IN (SELECT taskid FROM c) AND dateavailable IS NOT NULL),
  h AS (SELECT taskid, stepname, count(*) AS hits FROM x WHERE copy = 1 GROUP BY ALL), hs AS (SELECT taskid, count(*) FILTER (WHERE hits > 1) AS n FROM h GROUP BY taskid)
  SELECT taskid, count(*) AS total_step_events, count(DISTINCT stepname) AS distinct_steps, count(*) FILTER (WHERE visit > 1) AS rework_step_events, any_value(n) AS rework_steps_count,
    round(count(*) FILTER (WHERE visit > 1) / count(*)::DOUBLE, 4) AS rework_event_rate, round(coalesce(sum(wait) FILTER (WHERE visit > 1), 0) / 60.0::DOUBLE, 2) AS rework_queue_wait_hours,
    round(coalesce(sum(work) FILTER (WHERE visit > 1), 0) / 60.0::DOUBLE, 2) AS rework_work_hours, cast(count(*) FILTER (WHERE visit > 1) > 0 AS INTEGER) AS is_rework_task
  FROM x JOIN hs USING (taskid) WHERE copy = 1 GROUP BY taskid"""))
def _(s, d):
    return marts.fact_task_rework(tasks(s, d))


ENRICHED = f"""SELECT t.*, w.teammate, w.job_profile AS worker_job_profile, w.business_title, w.management_level, w.cost_center, w.cost_center_hierarchy, w.fte, w.direct_manager, em.source_system AS employee_source, {DUR}
  FROM t LEFT JOIN w ON t.assignedto = lower(trim(w.employee_id)) LEFT JOIN em ON t.assignedto = em.employee_id"""


@query("tasks_enriched", oracle(ENRICHED))
def _(s, d):
    return marts.tasks_enriched(tasks(s, d), workers(s, d), master(s, d))


@query("join_left_normalized", oracle("SELECT t.row_id, t.assignedto, w.teammate FROM t LEFT JOIN w ON t.assignedto = lower(trim(w.employee_id))"))
def _(s, d):
    from pyspark.sql import functions as F

    return marts.tasks_enriched(tasks(s, d), workers(s, d), master(s, d)).select("row_id", "assignedto", F.col("teammate"))


@query("mart_team_capacity", oracle("""SELECT cost_center_hierarchy AS department, cost_center, management_level, count(*) AS headcount, round(sum(fte), 4) AS total_fte, round(sum(scheduled_weekly_hours), 4) AS total_weekly_hours
  FROM w WHERE current_status = 'Active' GROUP BY ALL"""))
def _(s, d):
    return marts.mart_team_capacity(marts.stg_workers(workers(s, d)))


@query("mart_team_demand", oracle(f"""SELECT w.cost_center_hierarchy AS department, w.cost_center, cast(dateinitiated AS DATE) AS task_week, count(*) AS task_count, {COMPLETED} AS completed, {AVG_HOURS} AS avg_handle_hours
  FROM t LEFT JOIN w ON t.assignedto = lower(trim(w.employee_id)) WHERE starttime IS NOT NULL AND endtime IS NOT NULL GROUP BY 1, 2, 3"""))
def _(s, d):
    return marts.mart_team_demand(tasks(s, d), workers(s, d))


@query("mart_onshore_offshore", oracle(f"""SELECT em.source_system, flowname, stepname, count(*) AS task_count, {AVG_HOURS} AS avg_handle_hours, {avg(f"{COMPLETED} * 100", N, 1)} AS completion_rate
  FROM t LEFT JOIN em ON t.assignedto = em.employee_id WHERE starttime IS NOT NULL AND endtime IS NOT NULL GROUP BY 1, 2, 3"""))
def _(s, d):
    return marts.mart_onshore_offshore(tasks(s, d), master(s, d))


AGE = f"date_diff('day', dateinitiated, TIMESTAMP '{AS_OF}')"


@query("mart_backlog", oracle(f"SELECT drawer, flowname, stepname, taskstatus, count(*) AS task_count, {avg(f'sum({AGE})', 'count(*)', 1)} AS avg_age_days FROM t WHERE taskstatus <> 'Completed' GROUP BY 1, 2, 3, 4"))
def _(s, d):
    return marts.mart_backlog(tasks(s, d), AS_OF)


LIFE = "date_diff('hour', dateinitiated, dateended)"


@query("mart_turnaround", oracle(f"""SELECT drawer, flowname, stepname, count(*) AS completed_count, {AVG_HOURS} AS avg_handle_hours, {avg(f'sum({LIFE})', f'count({LIFE})', 2)} AS avg_lifecycle_hours
  FROM t WHERE taskstatus = 'Completed' AND starttime IS NOT NULL AND endtime IS NOT NULL GROUP BY 1, 2, 3"""))
def _(s, d):
    return marts.mart_turnaround(tasks(s, d))


@query("mart_daily_trend", oracle(f"SELECT cast(dateinitiated AS DATE) AS task_date, drawer, count(*) AS tasks_opened, {COMPLETED} AS tasks_completed, count(*) - {COMPLETED} AS net_backlog_change FROM t GROUP BY 1, 2"))
def _(s, d):
    return marts.mart_daily_trend(tasks(s, d))


@query("tasks_with_dept", oracle("SELECT t.*, e.userid AS emp_userid, e.id AS emp_id, e.full_name, e.title, e.netwarelogin, e.email, e.divisionid, e.division, e.division1, e.teamid, e.team FROM t LEFT JOIN e ON lower(trim(t.operationby)) = lower(trim(e.userid))"))
def _(s, d):
    return marts.tasks_with_dept(tasks(s, d), people(s, d))


@query("v_task_duration", oracle(f"SELECT *, {DUR} FROM t"))
def _(s, d):
    return marts.with_durations(tasks(s, d))


@query("v_daily_volume", oracle(f"SELECT cast(dateinitiated AS DATE) AS task_date, count(*) AS tasks_initiated, {SPLIT} FROM t WHERE dateinitiated IS NOT NULL GROUP BY 1"))
def _(s, d):
    return marts.daily_volume(tasks(s, d))


@query("v_drawer_summary", oracle(f"SELECT drawer, count(*) AS total_tasks, {COMPLETED} AS completed, {AVG_HOURS} AS avg_duration_hours FROM t GROUP BY 1"))
def _(s, d):
    return marts.drawer_summary(tasks(s, d))


CARRIER = f"SELECT carrier, flowname, count(*) AS task_count, {SPLIT} FROM t GROUP BY 1, 2"


@query("v_carrier_workload", oracle(CARRIER))
def _(s, d):
    return marts.carrier_workload(tasks(s, d))


@query("missing_status", oracle("SELECT * FROM t WHERE taskstatus IS NULL"))
def _(s, d):
    return marts.missing_status(tasks(s, d))


@query("v_tasks_by_department", oracle("SELECT t.*, e.full_name, e.title, e.division, e.team FROM t LEFT JOIN e ON lower(trim(t.assignedto)) = lower(trim(e.userid))"))
def _(s, d):
    return marts.tasks_by_department(tasks(s, d), people(s, d))


@query("team_workload", oracle(f"SELECT e.team, e.division, count(*) AS total_tasks, {COMPLETED} AS completed, {AVG_HOURS} AS avg_hours FROM t JOIN e ON t.assignedto = lower(trim(e.userid)) GROUP BY 1, 2"))
def _(s, d):
    return marts.team_workload(tasks(s, d), people(s, d))


@query("report_carrier_workload", oracle(f"SELECT *, {avg('completed * 100', 'task_count', 1)} AS completion_rate FROM ({CARRIER}) ORDER BY task_count DESC, carrier, flowname"))
def _(s, d):
    return marts.report_carrier_workload(tasks(s, d))


@query("dept_performance", oracle(f"""SELECT e.division, e.team, count(*) AS total_tasks, {COMPLETED} AS completed, {AVG_HOURS} AS avg_hours, round(percentile_cont(0.5) WITHIN GROUP (ORDER BY round({MIN} / 60.0::DOUBLE, 2)), 2) AS median_hours
  FROM t LEFT JOIN e ON t.assignedto = lower(trim(e.userid)) WHERE e.division IS NOT NULL GROUP BY 1, 2"""))
def _(s, d):
    return marts.department_performance(tasks(s, d), people(s, d))


@query("report_tasks_overview", oracle(f"SELECT cast(date_trunc('month', dateinitiated) AS TIMESTAMP) AS month, count(*) AS total_tasks, {COMPLETED} AS completed, {avg(f'{COMPLETED} * 100', N, 1)} AS completion_rate, {AVG_HOURS} AS avg_duration_hours FROM t WHERE dateinitiated IS NOT NULL GROUP BY 1"))
def _(s, d):
    return marts.tasks_overview(tasks(s, d))


@query("report_tasks_by_originator", oracle(f"SELECT t.*, e.full_name AS from_name, e.title AS from_title, e.division AS from_division, e.team AS from_team, {DUR} FROM t LEFT JOIN e ON t.taskfrom = lower(trim(e.userid))"))
def _(s, d):
    return marts.tasks_by_originator(tasks(s, d), people(s, d))


@query("filter_neq_3vl", oracle("SELECT flowname, count(*) AS n FROM t WHERE taskstatus <> 'Completed' GROUP BY 1"))
def _(s, d):
    from pyspark.sql import functions as F

    return tasks(s, d).where(F.col("taskstatus") != "Completed").groupBy("flowname").agg(F.count(F.lit(1)).alias("n"))


@query("join_semi_completed", oracle(f"SELECT row_id, taskid, stepname FROM t WHERE taskid IN (SELECT taskid FROM ({FTC}))"))
def _(s, d):
    t = tasks(s, d)
    return t.join(marts.fact_task_completed(t).select("taskid"), "taskid", "left_semi").select("row_id", "taskid", "stepname")


@query("latest_per_key", oracle("SELECT taskid, row_id, stepname FROM t QUALIFY row_number() OVER (PARTITION BY taskid ORDER BY endtime DESC NULLS LAST, row_id) = 1"))
def _(s, d):
    from pyspark.sql import functions as F

    from loomtab.operators.tables import latest

    return latest(tasks(s, d), ["taskid"], [F.desc_nulls_last("endtime"), F.asc("row_id")]).select("taskid", "row_id", "stepname")


@query("dedup_exact_events", oracle("SELECT row_id, taskid, stepname FROM t WHERE dateavailable IS NOT NULL QUALIFY row_number() OVER (PARTITION BY taskid, stepname, dateavailable, starttime, endtime ORDER BY row_id) = 1"))
def _(s, d):
    from pyspark.sql import functions as F

    from loomtab.operators.tables import latest

    return latest(tasks(s, d).where("dateavailable is not null"), ["taskid", "stepname", "dateavailable", "starttime", "endtime"], [F.asc("row_id")]).select("row_id", "taskid", "stepname")


@query("step_occurrence", oracle("SELECT row_id, row_number() OVER (PARTITION BY taskid, stepname ORDER BY dateavailable NULLS LAST, starttime NULLS LAST, endtime NULLS LAST, row_id) AS occurrence FROM t"))
def _(s, d):
    from pyspark.sql import functions as F

    from loomtab.operators.tables import occurrence

    order = [F.asc_nulls_last(c) for c in ("dateavailable", "starttime", "endtime", "row_id")]
    return occurrence(tasks(s, d), ["taskid", "stepname"], order).select("row_id", F.col("occurrence").cast("long").alias("occurrence"))


@query("assert_no_row_loss", oracle("SELECT n_a, n_b, abs(n_a - n_b) AS diff_count FROM (SELECT count(*) AS n_a FROM raw), (SELECT count(*) AS n_b FROM t WHERE taskstatus IS NOT NULL) WHERE n_a <> n_b"))
def _(s, d):
    from loomtab.operators.checks import no_row_loss

    return no_row_loss(raw_tasks(s, d), tasks(s, d).where("taskstatus is not null"))


BACKWARD = "CASE WHEN row_id % 97 = 0 THEN dateavailable ELSE endtime END AS endtime"


@query("assert_valid_duration", oracle(f"""SELECT row_id, duration, unnest([x FOR x IN [CASE WHEN duration < 0 THEN 'negative_duration' END, CASE WHEN endtime < starttime THEN 'end_before_start' END] IF x IS NOT NULL]) AS reason
  FROM (SELECT row_id, starttime, endtime, date_diff('minute', starttime, endtime) AS duration FROM (SELECT * REPLACE ({BACKWARD}) FROM t))"""))
def _(s, d):
    from pyspark.sql import functions as F

    from loomtab.functions.scalars import date_diff
    from loomtab.operators.checks import valid_duration

    t = tasks(s, d).withColumn("endtime", F.expr(BACKWARD.rpartition(" AS ")[0])).withColumn("duration", date_diff("minute", "starttime", "endtime"))
    return valid_duration(t, "starttime", "endtime", "duration").select("row_id", "duration", "reason")
