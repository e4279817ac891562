import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from loomtab.plans import build
from loomtab.queries import base
from loomtab.sources import ingest, sinks

DIR = "/root/testdata/sf0.001"


def test_marts_share_the_staged_tasks(spark):
    tasks = base.tasks(spark, DIR)
    made = build.build_marts(tasks, base.workers(spark, DIR), base.master(spark, DIR), base.people(spark, DIR), base.AS_OF)
    assert len(made) == 19 and all("InMemoryTableScan" in df._jdf.queryExecution().executedPlan().toString() for n, df in made.items() if n != "mart_team_capacity")
    assert made["report_daily_volume"].count() > 0
    from loomtab.plans import marts

    twice = base.workers(spark, DIR).unionByName(base.workers(spark, DIR).withColumn("teammate", F.lit("zz")))  # several workers of one id
    for workers in (base.workers(spark, DIR), twice):
        again = build.build_marts(tasks, workers, base.master(spark, DIR), base.people(spark, DIR), base.AS_OF)
        alone = {"mart_team_demand": marts.mart_team_demand(tasks, workers), "mart_onshore_offshore": marts.mart_onshore_offshore(tasks, base.master(spark, DIR)), "tasks_enriched": marts.tasks_enriched(tasks, workers, base.master(spark, DIR))}
        for n, df in alone.items():
            assert sorted(map(str, again[n].select(df.columns).collect())) == sorted(map(str, df.collect())), n
        again.release()
    made.release()
    assert not any(df.is_cached for df in made.shared)


def test_marts_of_a_stored_join(spark, tmp_path):
    """Every mart is the same, read from the stored tasks or the stored join; no other join of tasks is left in those three."""
    tables = base.tasks(spark, DIR), base.workers(spark, DIR), base.master(spark, DIR), base.people(spark, DIR), base.AS_OF
    kept, plain = build.build_marts(*tables, folder=str(tmp_path / "shared")), build.build_marts(*tables)
    for n, df in plain.items():
        assert sorted(map(str, kept[n].collect())) == sorted(map(str, df.collect())), n
    for n in ("tasks_enriched", "mart_team_demand", "mart_onshore_offshore"):
        assert "Join" not in kept[n]._jdf.queryExecution().optimizedPlan().toString()
    plain.release()
    kept.release()
    assert not (tmp_path / "shared").exists()


def test_warehouse(spark, tmp_path):
    a, b = f"t_{uuid.uuid4().hex[:6]}", f"t_{uuid.uuid4().hex[:6]}"
    spark.range(3).write.parquet(str(tmp_path / "a"))
    paths = {a: str(tmp_path / "a"), b: str(tmp_path / "none")}
    written = {}
    assert build.warehouse_build(spark, paths, (b,), lambda df, n: written.update({n: df})) == [a]
    with pytest.raises(AnalysisException):
        build.warehouse_build(spark, paths, (), lambda df, n: None)
    sinks.materialize(written[a], a)
    assert a in {r["table_name"] for r in sinks.catalog_tables(spark).collect()}
    report = {r["table_name"]: (r["n_rows"], r["ok"]) for r in sinks.verify_warehouse(written, [a, b], [a]).collect()}
    assert report == {a: (3, True), b: (None, False)}
    sinks.write_report(written[a], str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 3


def test_clean_files_and_seeds(spark, tmp_path):
    for name in ("x", "x_errors", "tmpx"):
        spark.range(2).coalesce(1).write.parquet(str(tmp_path / name))
        part = next((tmp_path / name).glob("part-*.parquet"))
        (tmp_path / "all").mkdir(exist_ok=True)
        part.rename(tmp_path / "all" / f"{name}.parquet")
    df = ingest.clean_files(spark, str(tmp_path / "all"))
    assert df.count() == 2
    # a sidecar holds text where the clean file holds a number; a second clean file has a column more
    for name, sql in (("y_errors", "select 'x' as id"), ("z", "select 7L as id, 'more' as extra")):
        spark.sql(sql).coalesce(1).write.parquet(str(tmp_path / name))
        next((tmp_path / name).glob("part-*.parquet")).rename(tmp_path / "all" / f"{name}.parquet")
    df = ingest.clean_files(spark, str(tmp_path / "all"))
    assert dict(df.dtypes) == {"id": "bigint", "extra": "string"} and df.count() == 3
    with pytest.raises(FileNotFoundError):
        ingest.clean_files(spark, str(tmp_path / "tmpx"))
    (tmp_path / "seed.csv").write_text("source_value,target_value\na,A\n")
    assert [tuple(r) for r in ingest.load_seed(spark, str(tmp_path / "seed.csv")).collect()] == [("a", "A")]
    (tmp_path / "d.csv").write_text(" a ,,b\n1,2,\n")
    raw = ingest.read_raw(spark, str(tmp_path / "d.csv"))
    assert raw.columns[0] == "a" and [tuple(r) for r in raw.collect()] == [("1", "2", None)]
    assert set(ingest.sources(spark, str(tmp_path), "all")) == {"x", "x_errors", "tmpx", "y_errors", "z"}
