"""Small cases that pin down the operators' rules."""

import datetime

import pytest
from pyspark.sql import functions as F

from loomtab.functions import casts, scalars
from loomtab.operators import checks, drift, reshape, tables, values
from loomtab.plans import curate
from loomtab.sources import incremental, ingest, sinks
from loomtab.sources.spec import ColumnSpec, DatasetSpec, to_snake_case
from loomtab.streaming import new_files


def one(df, column=0):
    return [r[column] for r in df.collect()]


def test_names():
    assert [to_snake_case(x) for x in ("TaskID", " Task  ID!", "a__b", "")] == ["taskid", "task_id", "a_b", ""]
    assert tables.resolve(["Task ID", "task id", "X"], {"task_id": "taskid"}) == {"Task ID": "taskid", "X": "x"}
    assert reshape.slug("1 Big-One!") == "_1_big_one"


def test_casts(spark):
    texts = ["1", " 2 ", "1.5", "2.5", "-2.5", "1e3", "abc", "", None, "1d", "inf", "2025", "2025/01/02", "2025-02-30", "2025-01-02 10:11"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.orderBy("i").select(*[casts.try_cast(F.col("t"), k).alias(k) for k in ("int64", "float64", "datetime64")]).collect()
    assert [r["int64"] for r in got] == [1, 2, 2, 3, -3, 1000, None, None, None, None, None, 2025, None, None, None]
    assert [r["float64"] for r in got][:11] == [1, 2, 1.5, 2.5, -2.5, 1000, None, None, None, None, float("inf")]
    assert [r["datetime64"] for r in got][-4:] == [None, datetime.datetime(2025, 1, 2), None, datetime.datetime(2025, 1, 2, 10, 11)]


def test_scalars(spark):
    df = spark.range(1)
    pick = lambda c: df.select(c).first()[0]
    lit = F.lit
    assert pick(scalars.safe_add(lit(1), lit(None).cast("int"), lit(3))) == 4
    assert pick(scalars.safe_divide(lit(6.0), lit(0.0))) is None
    assert [pick(scalars.width_bucket(lit(float(x)), 200000, 600000, 4)) for x in (190000, 400000, 610000)] == [0, 3, 5]
    paris = [lit(x) for x in (48.864716, 2.349014, 52.379189, 4.899431)]
    assert round(pick(scalars.haversine(*paris))) == 267 and round(pick(scalars.haversine(*paris, unit="km"))) == 430
    with pytest.raises(ValueError):
        scalars.haversine(*paris, unit="ft")
    a, b = (lit(x).cast("timestamp_ntz") for x in ("2024-01-01 00:59:59", "2024-01-01 01:01:00"))
    assert pick(scalars.date_diff("hour", a, b)) == 1 and pick(scalars.date_diff("minute", a, b)) == 2
    assert pick(scalars.url_host(lit("https://a.b/c?d=1"))) == "a.b"
    assert pick(scalars.url_path(lit("http://a.b/c/d?e=1"))) == "c/d"
    assert pick(scalars.surrogate_key(lit(None).cast("string"), lit("x"))) != pick(scalars.surrogate_key(lit(""), lit("x")))


def test_quarantine_is_a_complement(spark):
    spec = DatasetSpec("x", (ColumnSpec("a", "int64"), ColumnSpec("b", "bool", null_strings=("-",))))
    df = spark.createDataFrame([("1", "yes"), ("x", "no"), (None, "-"), ("3", "perhaps")], "a string, b string")
    good, bad = tables.split_good_bad(df, spec)
    assert sorted(map(tuple, good.collect()), key=str) == [(1, True), (None, None)]
    assert sorted(map(tuple, bad.collect())) == [("3", "perhaps"), ("x", "no")]
    assert {r["column_name"]: (r["n_bad"], r["samples"]) for r in tables.cast_errors(df, spec).collect()} == {"a": (1, "x"), "b": (1, "perhaps")}


def test_fills_and_numbers(spark):
    df = spark.createDataFrame([(i, i if i % 4 == 0 else None) for i in range(1, 30)], "row_id long, v long")
    forward = dict(map(tuple, values.fill(df, {"v": "fill_forward"}).collect()))
    assert [forward[i] for i in (1, 3, 4, 7, 29)] == [None, None, 4, 4, 28]
    backward = dict(map(tuple, values.fill(df, {"v": "fill_backward"}).collect()))
    assert [backward[i] for i in (1, 5, 28, 29)] == [4, 8, 28, None]
    twice = values.fill(values.fill(df, {"v": "fill_forward"}), {"v": "fill_forward"})
    assert dict(map(tuple, twice.collect())) == forward
    assert values.fill(df.drop("row_id"), {"v": "fill_forward"}).where("v is null").count() == 22
    with pytest.raises(ValueError):
        values.fill(spark.createDataFrame([("a",)], "s string"), {"s": "fill_zero"})
    numbered = tables.add_row_id(spark.createDataFrame([(x,) for x in (5, 1, 9, 3)], "k int"), "k")
    assert sorted(map(tuple, numbered.collect())) == [(1, 1), (3, 2), (5, 3), (9, 4)]


def test_backward_fill_of_a_long_range(spark):
    """One range of 300,000 rows with few values: a frame that reached forward would take minutes."""
    import time

    df = spark.range(300_000).selectExpr("id AS row_id", "if(id % 100000 = 99999, id, null) AS v").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        began = time.perf_counter()
        assert values.fill(df, {"v": "fill_backward"}).agg(F.sum("v")).first()[0] == sum(100_000 * x for x in (99_999, 199_999, 299_999))
        assert time.perf_counter() - began < 30
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_lookups_of_repeated_sources(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    once = spark.createDataFrame([("a", "A"), (None, "x"), (None, "y")], "source_value string, target_value string")
    assert sorted(map(str, one(values.lookup_normalize(df, "v", once)))) == ["A", "None", "b"]
    with pytest.raises(Exception, match="several targets"):
        values.lookup_normalize(df, "v", once.unionByName(once)).collect()


def test_row_ids_over_several_files(spark, tmp_path):
    for n in range(3):
        spark.range(n * 10, n * 10 + 4 + n).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    numbered = tables.add_row_id_by_file(df)
    at = df.select("id", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("n")).collect()
    want = {r["id"]: i for i, r in enumerate(sorted(at, key=lambda r: (r["f"], r["n"])), 1)}
    assert {r["id"]: r["row_id"] for r in numbered.collect()} == want and len(want) == 15


def test_provenance(spark, tmp_path):
    spark.range(2).coalesce(1).write.parquet(str(tmp_path / "p"))
    got = ingest.with_provenance(spark.read.parquet(str(tmp_path / "p")), "2024-01-02 03:04:05").collect()
    assert {r["_ingested_at"] for r in got} == {datetime.datetime(2024, 1, 2, 3, 4, 5)} and all(r["_source_file"].endswith(".parquet") for r in got)


def test_a_missing_required_column_fails(spark):
    spec = DatasetSpec("x", (ColumnSpec("k", "int64", primary_key=True), ColumnSpec("gone", nullable=False)))
    report = checks.validate_dataset(spark.createDataFrame([(1,)], "k int"), spec).where("not passed").collect()
    assert any("column" in r["check_name"] for r in report)


def test_fill_has_no_single_partition_of_rows(spark):
    df = spark.range(100).selectExpr("id AS row_id", "if(id % 3 = 0, id, null) AS v")
    plan = tables.add_row_id(values.fill(df, {"v": "fill_forward"}), "row_id", "n")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_part" in plan


def test_stacking(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, name string"), spark.createDataFrame([(2, "red")], "id int, colour string")
    assert sorted(map(tuple, tables.combine_by_name([a, b, a.limit(0)]).collect())) == [(1, "x", None), (2, None, "red")]
    with pytest.raises(ValueError):
        tables.combine_by_name([a.limit(0)])
    with pytest.raises(ValueError):
        tables.union_relations({"a": a, "b": b}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        tables.union_relations({"a": a, "b": b}, include=["none"])


def test_reshape(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("M", "red")], "size string, color string")
    assert sorted(map(tuple, reshape.pivot(df, ["size"], "color", ["red", "blue"]).collect())) == [("M", 1, 0), ("S", 1, 1)]
    melted = reshape.unpivot(spark.createDataFrame([(1, True, None)], "id int, a boolean, b string"), exclude=["id"])
    assert sorted(map(tuple, melted.collect()), key=str) == [(1, "a", "true"), (1, "b", None)]
    assert reshape.date_spine(spark, "day", "2018-01-01 00:00:00", "2018-01-10 00:00:00").count() == 9
    with pytest.raises(ValueError):
        reshape.generate_series(spark, 0)
    assert reshape.single_value(df.limit(0), "none") == "none"
    assert reshape.results_as_dict(df.orderBy("size", "color")) == {"size": ("M", "S", "S"), "color": ("red", "blue", "red")}
    with pytest.raises(ValueError):
        reshape.results_as_dict(df, 2)


@pytest.mark.parametrize("gaps,zero,bad", [("allowed", False, {3, 4}), ("not_allowed", False, {2, 3, 4}), ("required", True, {1, 4})])
def test_ranges(spark, gaps, zero, bad):
    df = spark.createDataFrame([(1, 0, 5), (2, 5, 8), (3, 9, 9), (4, 10, None)], "k int, a int, b int")
    assert set(one(checks.mutually_exclusive_ranges(df, "a", "b", gaps=gaps, zero_length=zero))) == bad


def test_checks_pass_and_fail(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (2, "a", None)], "k int, s string, v double")
    assert checks.unique(df, "k").count() == 1 and checks.unique(df.distinct().limit(1), "k").count() == 0
    assert checks.not_null(df, "s").count() == 1
    assert checks.not_constant(df, "s").count() == 1 and checks.not_constant(df, "k").count() == 0
    assert checks.at_least_one(df.where("s is null"), "s").count() == 1 and checks.at_least_one(df, "s").count() == 0
    assert checks.accepted_range(df, "v", 0, 1).count() == 1
    assert checks.not_null_proportion(df, "v", 0.7).count() == 1 and checks.not_null_proportion(df, "v", 0.6).count() == 0
    assert checks.equal_rowcount(df, df).count() == 0 and checks.equal_rowcount(df, df.limit(1)).count() == 1
    assert checks.fewer_rows_than(df, df).first()["row_count_delta"] == 1
    assert checks.sequential_values(df.where("v is not null"), "v").count() == 0
    assert checks.equality(df, df).count() == 0
    assert checks.recency(spark.sql("select timestamp_ntz'2024-01-01 00:00:00' as ts"), "ts", "day", 3, "2024-01-05 00:00:00").count() == 1
    spec = DatasetSpec("x", (ColumnSpec("k", "int64", primary_key=True), ColumnSpec("s"), ColumnSpec("v", "float64")), max_null_rate=0.4, max_duplicate_rate=0.1, min_row_count=1)
    report = {(r["check_name"], r["column_name"]): r["passed"] for r in checks.validate_dataset(df, spec).collect()}
    assert report["duplicate_rate", "k"] is False and report["null_rate", "s"] is True and report["row_count", None] is True


def test_empty_tables(spark):
    df = spark.createDataFrame([], "row_id long, v long, s string")
    assert values.fill(df, {"v": "fill_forward"}).count() == 0
    assert tables.add_row_id(df, "v", "n").count() == 0
    assert checks.sequential_values(df, "v").count() == 0
    assert checks.mutually_exclusive_ranges(df, "row_id", "v").count() == 0


def test_changes(spark, tmp_path):
    for n, t in (("a.csv", "1"), ("b.csv", "2"), ("c.csv", "3")):
        (tmp_path / n).write_text(t)
    now = incremental.hash_files(spark, str(tmp_path), "*.csv")
    state = spark.createDataFrame([tuple(r) for r in incremental.next_state(now, spark.createDataFrame([], incremental.STATE), "t1").collect()], incremental.STATE)
    assert set(one(incremental.detect_changes(now, state), 1)) == {"unchanged"}
    (tmp_path / "b.csv").write_text("22")
    (tmp_path / "c.csv").unlink()
    (tmp_path / "d.csv").write_text("4")
    now = incremental.hash_files(spark, str(tmp_path), "*.csv")
    assert dict(map(tuple, incremental.detect_changes(now, state).collect())) == {"a.csv": "unchanged", "b.csv": "changed", "c.csv": "gone", "d.csv": "new"}
    outputs = spark.createDataFrame([("b.csv",)], "name string")
    assert dict(map(tuple, incremental.detect_changes(now, state, outputs).collect()))["a.csv"] == "changed"
    assert dict(map(tuple, incremental.detect_changes(now, state, force=True).collect()))["a.csv"] == "changed"
    after = {r["name"]: (r["first_seen"], r["last_processed"]) for r in incremental.next_state(now, state, "t2").collect()}
    assert after == {"a.csv": ("t1", "t1"), "b.csv": ("t1", "t2"), "d.csv": ("t2", "t2")}
    kept = tmp_path / "out"
    kept.mkdir()
    for n in ("a.parquet", "c.parquet"):
        (kept / n).write_text("x")
    made = spark.createDataFrame([("a", "a.parquet"), ("c", "c.parquet"), ("z", "z.parquet")], "stem string, name string")
    inputs = now.select(F.regexp_replace("name", "[.]csv$", "").alias("stem"))
    assert incremental.remove_orphans(spark, str(kept), made, inputs, "stem") == ["c.parquet", "z.parquet"]
    assert [x.name for x in kept.iterdir() if not x.name.startswith(".")] == ["a.parquet"]
    assert not incremental.may_skip(incremental.detect_changes(now, state), True, False, True)


def test_curate(spark, tmp_path):
    (tmp_path / "one.csv").write_text("ID ,Name,Value\n1,a,1.5\nx,b,2\n3,c,\n")
    (tmp_path / "two.csv").write_text("Id,Value,Other\n4,8,zzz\n")
    spec = DatasetSpec("mini", (ColumnSpec("id", "int64", nullable=False), ColumnSpec("name", fill_strategy="fill_unknown"), ColumnSpec("value", "float64", fill_strategy="fill_zero")), value_maps={"name": {"a": "Alpha"}}, max_null_rate=0.5, min_row_count=1)
    out = curate.run_dataset(spark, spec, {"one": str(tmp_path / "one.csv"), "two": str(tmp_path / "two.csv")}, preflight=True)
    got = [tuple(r) for r in out.clean.orderBy("row_id").select("row_id", "id", "name", "value", "_source_file").collect()]
    assert got == [(1, 1, "Alpha", 1.5, "one.csv"), (2, 3, "c", 0.0, "one.csv"), (3, 4, "Unknown", 8.0, "two.csv")]
    assert [r["id"] for r in out.rejected.collect()] == ["x"] and out.passed()
    assert out.counts == {"good": 3, "bad": 1, "column id": 1, "column value": 0} or out.counts == {"good": 3, "bad": 1, "column id": 1, "column name": 0, "column value": 0}
    out.release()
    import os

    assert not os.path.exists(out.held)
    with pytest.raises(ValueError):
        curate.run_dataset(spark, DatasetSpec("m", (ColumnSpec("gone"),)), {"one": str(tmp_path / "one.csv")}, preflight=True)


def test_new_files(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n1,2\n")
    for n in (1, 2):
        new_files.take_new(spark, str(folder), ["x", "y"], new_files.write_by_number(out), str(tmp_path / "state"))
        assert spark.read.parquet(out).count() == n
        (folder / "b.csv").write_text("x,y\n3,4\n")


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert sinks.overwrite_atomic(spark.read.parquet(path).where("id > 0"), path).count() == 2
    assert sorted(x.name for x in tmp_path.iterdir()) == ["t"]
    assert sinks.overwrite_atomic(spark.range(5), str(tmp_path / "fresh")).count() == 5
    names = spark.createDataFrame([("Task_a",), ("task_b",), ("other",)], "table_name string")
    assert sorted(one(sinks.relations_by_prefix(names, "TASK", "%_b"))) == ["Task_a"]
    assert ingest.clean_headers(spark.createDataFrame([(1, 2)], "` a ` int, ` ` int")).columns == ["a", "_unnamed_1"]


def test_drift_of_values(spark):
    df = spark.createDataFrame([("1", "1.5", "2024-01-02", "x", None), ("22", "2", None, "3", None)], "a string, b string, c string, d string, e string")
    assert dict(map(tuple, drift.kinds_in(df).collect())) == {"a": "int64", "b": "float64", "c": "datetime64", "d": "string", "e": "string"}
    assert sorted(map(tuple, drift.filled_headers({"f": df}).collect())) == [("f", x) for x in "abcd"]


def test_drift(spark):
    headers = spark.createDataFrame([("f1", "Task ID"), ("f1", "extra"), ("f2", "task_id")], "file string, col string")
    spec = DatasetSpec("x", (ColumnSpec("task_id"), ColumnSpec("name")))
    assert drift.preflight(headers, spec) == (False, ["extra"], ["name"])
    assert drift.schema_drift(headers).where("in_all").count() == 0
