"""All marts and reports at once, and a warehouse of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from loomtab.sources import scratch
from loomtab.sources.sinks import export_table

from . import marts


class Built(dict[str, DataFrame]):
    """Marts by name, and the tables they share, persisted or stored in a folder."""

    shared: tuple[DataFrame, ...] = ()
    folder: str | None = None

    def release(self) -> None:
        """Give back what the shared tables hold. Where they were persisted the marts still work, but compute it anew; stored ones are removed."""
        for df in self.shared:
            df.unpersist()
        if self.folder:
            scratch.remove(self.shared[0].sparkSession, self.folder)


def build_marts(tasks: DataFrame, workers: DataFrame, employees: DataFrame, people: DataFrame, as_of: str, folder: str | None = None) -> Built:
    """Every fact, mart and report of staged tables, by name.

    All share the staged tasks, and those with workers or employees share the one join of them. With a folder both are
    written there at once as Parquet, so a mart reads only the columns that it uses, and the join
    is made once whatever is lost. Without one nothing runs until a mart is used: both are persisted, and the first mart
    fills the cache.
    """
    if folder:
        shared = scratch.stored(tasks, f"{folder}/tasks")
        joined = scratch.stored(marts.tasks_joined(shared, workers, employees), f"{folder}/joined")
    else:
        shared = tasks.persist(StorageLevel.MEMORY_AND_DISK)
        joined = marts.tasks_joined(shared, workers, employees).persist(StorageLevel.MEMORY_AND_DISK)
    built = Built({
        "fact_task_completed": marts.fact_task_completed(shared), "fact_task_current": marts.fact_task_current(shared, as_of), "fact_task_event": marts.fact_task_event(shared),
        "fact_task_rework": marts.fact_task_rework(shared), "tasks_enriched": marts.enriched_of(joined), "mart_team_capacity": marts.mart_team_capacity(workers),
        "mart_team_demand": marts.demand_of(joined), "mart_onshore_offshore": marts.onshore_of(joined), "mart_backlog": marts.mart_backlog(shared, as_of),
        "mart_turnaround": marts.mart_turnaround(shared), "mart_daily_trend": marts.mart_daily_trend(shared), "report_tasks_full": marts.with_durations(marts.tasks_by_department(shared, people)),
        "report_tasks_by_originator": marts.tasks_by_originator(shared, people), "report_daily_volume": marts.daily_volume(shared), "report_drawer_performance": marts.drawer_summary(shared),
        "report_carrier_workload": marts.report_carrier_workload(shared), "report_team_workload": marts.team_workload(shared, people), "report_department": marts.department_performance(shared, people),
        "report_tasks_overview": marts.tasks_overview(shared),
    })
    built.shared, built.folder = (joined, shared), folder
    return built


def warehouse_build(spark: SparkSession, paths: dict[str, str], optional: tuple[str, ...] = (), write: Callable[[DataFrame, str], None] = export_table) -> list[str]:
    """Load Parquet tables into the warehouse by name; an optional one that is missing is passed over. Returns the names written."""
    done = []
    for name, path in paths.items():
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if name in optional and not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            continue
        write(spark.read.parquet(path), name)
        done.append(name)
    return done
