"""Staging, facts, marts and reports over task events, workers and employees.

A task table has the columns of `TASK`; dimensions are joined on keys that staging has put in lower case without
blanks. Averages come from sums of whole minutes, hours or days, so no order of addition changes them. Clocks are
arguments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomtab.functions.scalars import avg_hours, collapse_spaces, date_diff, hours_of, mean, missing_to_null, percent, trim_lower, upper_domain
from loomtab.operators.ranks import exact_percentile
from loomtab.operators.tables import latest
from loomtab.operators.values import lookup_normalize

DONE = "Completed"
#: Names of the statuses that the reports count.
STATUSES = {"completed": DONE, "in_progress": "In Progress", "pending": "Pending"}


def _n(status: str):
    return F.count_if(F.coalesce(F.col("taskstatus") == status, F.lit(False)))


def _minutes():
    return date_diff("minute", "starttime", "endtime")


# staging


def stg_tasks(raw: DataFrame, statuses: DataFrame, flows: DataFrame) -> DataFrame:
    """raw: taskstatus, flowname, drawer, assignedto, taskfrom, operationby as they came; lookups: (source_value, target_value)."""
    out = lookup_normalize(lookup_normalize(raw, "taskstatus", statuses), "flowname", flows)
    return out.withColumns({"drawer": collapse_spaces("drawer"), **{c: trim_lower(c) for c in ("assignedto", "taskfrom", "operationby")}})


def stg_employees(raw: DataFrame, tie: str = "row_id") -> DataFrame:
    """The newest row of each userid, with cleaned names, titles and logins."""
    newest = latest(raw, ["userid"], [F.desc_nulls_last("_ingested_at"), F.asc_nulls_last(tie)])
    return newest.withColumns({"full_name": F.trim("full_name"), "title": missing_to_null("title"), "netwarelogin": upper_domain("netwarelogin")})


def stg_employees_master(raw: DataFrame, tie: str = "row_id") -> DataFrame:
    keyed = raw.withColumn("employee_id", trim_lower("employee_id"))
    return latest(keyed, ["employee_id"], [F.desc_nulls_last("_ingested_at"), F.asc_nulls_last(tie)])


def stg_workers(raw: DataFrame) -> DataFrame:
    """Rows as they are, duplicates too; work_email normalised."""
    return raw.withColumn("work_email", trim_lower("work_email")) if "work_email" in raw.columns else raw


def stg_ir_employees(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"user_network_login": trim_lower("user_network_login"), "acctexecflag": F.upper("acctexecflag")})


# facts


def fact_task_completed(tasks: DataFrame) -> DataFrame:
    done = tasks.where((F.col("taskstatus") == DONE) & F.col("dateended").isNotNull() & F.col("dateinitiated").isNotNull())
    last = latest(done, ["taskid"], [F.desc("dateended"), F.asc("row_id")])
    return last.select("taskid", "filenumber", "policynumber", "flowname", F.col("stepname").alias("final_stepname"), "carrier", "acctexec", F.to_date("dateended").alias("completed_date"), "dateinitiated", "dateended", date_diff("hour", "dateinitiated", "dateended").cast("double").alias("tat_hours"))


def fact_task_current(tasks: DataFrame, as_of: str) -> DataFrame:
    now = F.lit(as_of).cast("timestamp_ntz")
    open_ = tasks.where((F.col("taskstatus") != DONE) & F.col("dateavailable").isNotNull())
    last = latest(open_, ["taskid"], [F.desc("dateavailable"), F.asc("row_id")])
    return last.select("taskid", "flowname", F.col("stepname").alias("current_stepname"), "assignedto", "filenumber", "policynumber", "carrier", "acctexec", "dateavailable", F.to_date(now).alias("as_of_date"), date_diff("hour", "dateavailable", now).cast("double").alias("aging_hours"))


_SAME_EVENT = ["taskid", "stepname", "dateavailable", "starttime", "endtime"]


def fact_task_event(tasks: DataFrame) -> DataFrame:
    once = latest(tasks.where(F.col("dateavailable").isNotNull()), _SAME_EVENT, [F.asc("row_id")])
    return once.select("taskid", "flowname", "stepname", "assignedto", "dateavailable", "starttime", "endtime", F.to_date("dateavailable").alias("event_date"), hours_of(date_diff("minute", "dateavailable", "starttime")).alias("queue_wait_hours"), hours_of(_minutes()).alias("work_duration_hours"))


def fact_task_rework(tasks: DataFrame) -> DataFrame:
    """One row a completed task. A visit's number counts exact repeats too, though those are then left out.

    Visits are first summed by task and step, so no distinct count is needed.
    """
    from pyspark.sql import Window as W

    done = tasks.where((F.col("taskstatus") == DONE) & F.col("dateended").isNotNull() & F.col("dateinitiated").isNotNull()).select("taskid").distinct()
    events = tasks.where(F.col("dateavailable").isNotNull()).join(done, "taskid", "left_semi")
    visit = F.row_number().over(W.partitionBy("taskid", "stepname").orderBy(F.asc_nulls_last("dateavailable"), F.asc_nulls_last("starttime"), F.asc_nulls_last("endtime"), F.asc("row_id")))
    copy = F.row_number().over(W.partitionBy("taskid", "stepname", "dateavailable", "starttime", "endtime").orderBy("row_id"))
    again = F.col("visit") > 1
    wait, work = date_diff("minute", "dateavailable", "starttime"), _minutes()
    steps = events.withColumn("visit", visit).withColumn("copy", copy).where("copy = 1").groupBy("taskid", "stepname").agg(
        F.count(F.lit(1)).alias("hits"), F.count_if(again).alias("more"), F.sum(F.when(again, wait)).alias("wait"), F.sum(F.when(again, work)).alias("work")
    )
    rolled = steps.groupBy("taskid").agg(
        F.sum("hits").alias("total_step_events"), F.count(F.col("stepname")).alias("distinct_steps"), F.sum("more").alias("rework_step_events"),
        F.count_if(F.col("hits") > 1).alias("rework_steps_count"), F.sum("wait").alias("wait"), F.sum("work").alias("work")
    )
    return rolled.select(
        "taskid", "total_step_events", "distinct_steps", "rework_step_events", "rework_steps_count", F.round(F.col("rework_step_events") / F.col("total_step_events"), 4).alias("rework_event_rate"),
        hours_of(F.coalesce("wait", F.lit(0))).alias("rework_queue_wait_hours"), hours_of(F.coalesce("work", F.lit(0))).alias("rework_work_hours"), (F.col("rework_step_events") > 0).cast("int").alias("is_rework_task"),
    )


# marts


def _workers(workers: DataFrame, *columns: str) -> DataFrame:
    return workers.select(trim_lower("employee_id").alias("_worker"), *columns)


def tasks_joined(tasks: DataFrame, workers: DataFrame, employees: DataFrame) -> DataFrame:
    """Every task with its worker and its employee, who is one at most; several workers of one id give several rows.

    _nth_worker tells such rows apart, so that what counts each task once takes the first. Marts share this one join.
    """
    nth = F.row_number().over(W.partitionBy("_worker").orderBy("teammate", "cost_center", "management_level"))
    own = _workers(workers, "teammate", F.col("job_profile").alias("worker_job_profile"), "business_title", "management_level", "cost_center", "cost_center_hierarchy", "fte", "direct_manager").withColumn("_nth_worker", nth)
    known = employees.select(F.col("employee_id").alias("_employee"), F.col("source_system").alias("employee_source"))
    return tasks.join(own, F.col("assignedto") == F.col("_worker"), "left").join(known, F.col("assignedto") == F.col("_employee"), "left").drop("_worker", "_employee")


def enriched_of(joined: DataFrame) -> DataFrame:
    return with_durations(joined.drop("_nth_worker"))


def demand_of(joined: DataFrame) -> DataFrame:
    return _demand(_timed(joined).withColumnRenamed("cost_center_hierarchy", "department"))


def onshore_of(joined: DataFrame) -> DataFrame:
    return _onshore(_timed(joined).where("coalesce(_nth_worker, 1) = 1").withColumnRenamed("employee_source", "source_system"))


def tasks_enriched(tasks: DataFrame, workers: DataFrame, employees: DataFrame) -> DataFrame:
    return enriched_of(tasks_joined(tasks, workers, employees))


def with_durations(tasks: DataFrame) -> DataFrame:
    return tasks.withColumns({"duration_minutes": _minutes(), "duration_hours": hours_of(_minutes()), "lifecycle_hours": date_diff("hour", "dateinitiated", "dateended").cast("double"), "task_date": F.to_date("dateinitiated")})


def mart_team_capacity(workers: DataFrame) -> DataFrame:
    active = workers.where(F.col("current_status") == "Active")
    return active.groupBy(F.col("cost_center_hierarchy").alias("department"), "cost_center", "management_level").agg(F.count(F.lit(1)).alias("headcount"), F.round(F.sum("fte"), 4).alias("total_fte"), F.round(F.sum("scheduled_weekly_hours"), 4).alias("total_weekly_hours"))


def _timed(tasks: DataFrame) -> DataFrame:
    return tasks.where(F.col("starttime").isNotNull() & F.col("endtime").isNotNull())


def mart_team_demand(tasks: DataFrame, workers: DataFrame) -> DataFrame:
    own = _workers(workers, F.col("cost_center_hierarchy").alias("department"), "cost_center")
    return _demand(_timed(tasks).join(own, F.col("assignedto") == F.col("_worker"), "left"))


def _demand(joined: DataFrame) -> DataFrame:
    return joined.groupBy("department", "cost_center", F.to_date("dateinitiated").alias("task_week")).agg(F.count(F.lit(1)).alias("task_count"), _n(DONE).alias("completed"), avg_hours(_minutes()).alias("avg_handle_hours"))


def mart_onshore_offshore(tasks: DataFrame, employees: DataFrame) -> DataFrame:
    known = employees.select(F.col("employee_id").alias("_employee"), "source_system")
    return _onshore(_timed(tasks).join(known, F.col("assignedto") == F.col("_employee"), "left"))


def _onshore(joined: DataFrame) -> DataFrame:
    return joined.groupBy("source_system", "flowname", "stepname").agg(F.count(F.lit(1)).alias("task_count"), avg_hours(_minutes()).alias("avg_handle_hours"), percent(_n(DONE), F.count(F.lit(1))).alias("completion_rate"))


def mart_backlog(tasks: DataFrame, as_of: str) -> DataFrame:
    age = date_diff("day", "dateinitiated", F.lit(as_of).cast("timestamp_ntz"))
    return tasks.where(F.col("taskstatus") != DONE).groupBy("drawer", "flowname", "stepname", "taskstatus").agg(F.count(F.lit(1)).alias("task_count"), mean(F.sum(age), F.count(age), 1).alias("avg_age_days"))


def mart_turnaround(tasks: DataFrame) -> DataFrame:
    life = date_diff("hour", "dateinitiated", "dateended")
    return _timed(tasks).where(F.col("taskstatus") == DONE).groupBy("drawer", "flowname", "stepname").agg(F.count(F.lit(1)).alias("completed_count"), avg_hours(_minutes()).alias("avg_handle_hours"), mean(F.sum(life), F.count(life), 2).alias("avg_lifecycle_hours"))


def mart_daily_trend(tasks: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return tasks.groupBy(F.to_date("dateinitiated").alias("task_date"), "drawer").agg(n.alias("tasks_opened"), _n(DONE).alias("tasks_completed"), (n - _n(DONE)).alias("net_backlog_change"))


# reports


def join_people(tasks: DataFrame, employees: DataFrame, on: str, columns: dict[str, str], how: str = "left") -> DataFrame:
    """Tasks with the named columns of the employee whose userid is in `on`."""
    people = employees.select(trim_lower("userid").alias("_user"), *[F.col(c).alias(a) for c, a in columns.items()])
    return tasks.join(people, trim_lower(on) == F.col("_user"), how).drop("_user")


DEPARTMENT = {"userid": "emp_userid", "id": "emp_id", **{c: c for c in ("full_name", "title", "netwarelogin", "email", "divisionid", "division", "division1", "teamid", "team")}}


def tasks_with_dept(tasks: DataFrame, employees: DataFrame) -> DataFrame:
    return join_people(tasks, employees, "operationby", {c: a for c, a in DEPARTMENT.items() if c in employees.columns})


def tasks_by_department(tasks: DataFrame, employees: DataFrame) -> DataFrame:
    return join_people(tasks, employees, "assignedto", {c: c for c in ("full_name", "title", "division", "team")})


def tasks_by_originator(tasks: DataFrame, employees: DataFrame) -> DataFrame:
    return with_durations(join_people(tasks, employees, "taskfrom", {"full_name": "from_name", "title": "from_title", "division": "from_division", "team": "from_team"}))


def _status_counts():
    return [_n(s).alias(n) for n, s in STATUSES.items()]


def daily_volume(tasks: DataFrame) -> DataFrame:
    return tasks.where(F.col("dateinitiated").isNotNull()).groupBy(F.to_date("dateinitiated").alias("task_date")).agg(F.count(F.lit(1)).alias("tasks_initiated"), *_status_counts())


def drawer_summary(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("drawer").agg(F.count(F.lit(1)).alias("total_tasks"), _n(DONE).alias("completed"), avg_hours(_minutes()).alias("avg_duration_hours"))


def carrier_workload(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("carrier", "flowname").agg(F.count(F.lit(1)).alias("task_count"), *_status_counts())


def missing_status(tasks: DataFrame) -> DataFrame:
    return tasks.where(F.col("taskstatus").isNull())


def team_workload(tasks: DataFrame, employees: DataFrame) -> DataFrame:
    joined = join_people(tasks, employees, "assignedto", {"team": "team", "division": "division"}, "inner")
    return joined.groupBy("team", "division").agg(F.count(F.lit(1)).alias("total_tasks"), _n(DONE).alias("completed"), avg_hours(_minutes()).alias("avg_hours"))


def report_carrier_workload(tasks: DataFrame) -> DataFrame:
    return carrier_workload(tasks).withColumn("completion_rate", percent(F.col("completed"), F.col("task_count"))).orderBy(F.desc("task_count"), "carrier", "flowname")


def department_performance(tasks: DataFrame, employees: DataFrame) -> DataFrame:
    """Volume, mean and exact median of durations by division and team."""
    joined = join_people(tasks, employees, "assignedto", {"team": "team", "division": "division"}).where("division is not null")
    m = _minutes()
    volume = joined.groupBy("division", "team").agg(F.count(F.lit(1)).alias("total_tasks"), _n(DONE).alias("completed"), avg_hours(m).alias("avg_hours"))
    medians = exact_percentile(joined.select("division", "team", hours_of(m).alias("_hours")), ["division", "team"], "_hours", 0.5, "_median").select(F.col("division").alias("_division"), F.col("team").alias("_team"), "_median")
    both = volume.join(medians, F.col("division").eqNullSafe(F.col("_division")) & F.col("team").eqNullSafe(F.col("_team")), "left")
    return both.select(*volume.columns, F.round("_median", 2).alias("median_hours")).orderBy(F.desc("total_tasks"), "division", "team")


def tasks_overview(tasks: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    return tasks.where(F.col("dateinitiated").isNotNull()).groupBy(F.date_trunc("month", "dateinitiated").cast("timestamp_ntz").alias("month")).agg(n.alias("total_tasks"), _n(DONE).alias("completed"), percent(_n(DONE), n).alias("completion_rate"), avg_hours(_minutes()).alias("avg_duration_hours")).orderBy("month")
