"""Incremental runs, snapshots, digests and header scans against whole runs and plain Python."""

import hashlib
import os
import threading

import pytest
from pyspark.sql import functions as F

from loomtab.operators import drift, tables
from loomtab.plans import curate, refresh
from loomtab.sources import digests, headers, sinks, snapshots
from loomtab.sources.spec import ColumnSpec, DatasetSpec

SPEC = DatasetSpec(
    "mini", (ColumnSpec("id", "int64", nullable=False), ColumnSpec("name", fill_strategy="fill_forward"), ColumnSpec("value", "float64", fill_strategy="fill_zero"), ColumnSpec("late", fill_strategy="fill_backward")),
    aliases={"ID No": "id"}, value_maps={"name": {"a": "Alpha"}},
)


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def whole(spark, folder):
    """The rows of a run over all files, in order."""
    names = sorted(x.name for x in folder.iterdir() if x.suffix == ".csv" and len(x.read_text().split("\n")) > 2)
    out = curate.run_dataset(spark, SPEC, {n: str(folder / n) for n in names}, ingested_at="2024-01-01 00:00:00")
    kept = ["row_id", "id", "name", "value", "late", "_source_file"]
    return [tuple(r) for r in out.clean.orderBy("row_id").select(kept).collect()], sorted((r["id"], r["_file"]) for r in out.rejected.collect())


def standing(spark, out):
    rows = refresh.table(spark, SPEC, out).orderBy("row_id").select("row_id", "id", "name", "value", "late", "_source_file").collect()
    return [tuple(r) for r in rows], sorted((r["id"], r["_file"]) for r in refresh.rejected(spark, SPEC, out).collect())


def partitions(out):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{out}/data") for f in names if f.endswith(".parquet")}


def test_a_rerun_touches_what_changed_and_equals_a_whole_run(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    put(raw, "a.csv", "ID,Name,Value\n1,a,1.5\nx,b,2\n3,,\n")
    put(raw, "b b.csv", "id,late,name\n4,,\n5,end,z\n")
    put(raw, "c=1.csv", "ID No,VALUE\n6,7\n7,bad\n")
    put(raw, "d.csv", "id,name\n8,last\n")
    put(raw, "none.csv", "id,name,never\n")
    first = refresh.refresh(spark, SPEC, str(raw), out, "2024-01-01 00:00:00")
    assert (first.version, first.skipped) == (1, False) and standing(spark, out) == whole(spark, raw)
    assert standing(spark, out)[1] == [("7", "c=1.csv"), ("x", "a.csv")]
    again = refresh.refresh(spark, SPEC, str(raw), out, "2024-01-02 00:00:00")
    assert again.skipped and again.version == 1 and {r["status"] for r in again.changes.collect()} == {"unchanged"}
    before = partitions(out)
    put(raw, "a.csv", "ID,Name,Value\n1,a,1.5\n2,n,\n9,,\n")  # a row more, so all later numbers move
    (raw / "d.csv").unlink()
    put(raw, "aa.csv", "id,value\n10,1\n")
    second = refresh.refresh(spark, SPEC, str(raw), out, "2024-01-03 00:00:00")
    assert {r["name"]: r["status"] for r in second.changes.collect()} == {"a.csv": "changed", "aa.csv": "new", "b b.csv": "unchanged", "c=1.csv": "unchanged", "d.csv": "gone", "none.csv": "unchanged"}
    assert standing(spark, out) == whole(spark, raw)
    after = partitions(out)
    assert before.items() <= after.items() and {x.split("_file=")[1].split("/")[0] for x in after.keys() - before.keys()} == {"a.csv", "aa.csv"}
    saved = {r["name"]: (r["first_seen"][:10], r["last_processed"][:10], r["n_rows"], r["n_bad"]) for r in refresh.state(spark, out).collect()}
    assert saved == {"a.csv": ("2024-01-01", "2024-01-03", 3, 0), "aa.csv": ("2024-01-03", "2024-01-03", 1, 0), "b b.csv": ("2024-01-01", "2024-01-01", 2, 0), "c=1.csv": ("2024-01-01", "2024-01-01", 1, 1), "none.csv": ("2024-01-01", "2024-01-01", 0, 0)}
    gone = refresh.vacuum(spark, out, keep=1)
    assert len(gone) == 3 and standing(spark, out) == whole(spark, raw)  # a.csv's good and bad rows of the first run, and d.csv


def test_lost_outputs_other_declarations_and_force(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    put(raw, "a.csv", "id,name\n1,a\n")
    put(raw, "b.csv", "id,name\n2,b\n")
    refresh.refresh(spark, SPEC, str(raw), out, "2024-01-01 00:00:00")
    lost = next(x for x in partitions(out) if "_file=b.csv" in x)
    import shutil

    shutil.rmtree(os.path.dirname(lost))
    made = refresh.refresh(spark, SPEC, str(raw), out, "2024-01-02 00:00:00")
    assert {r["name"]: r["status"] for r in made.changes.collect()} == {"a.csv": "unchanged", "b.csv": "changed"} and standing(spark, out) == whole(spark, raw)
    other = DatasetSpec("mini", SPEC.columns, SPEC.aliases, {"name": {"a": "Beta"}})
    made = refresh.refresh(spark, other, str(raw), out, "2024-01-03 00:00:00")
    assert {r["status"] for r in made.changes.collect()} == {"changed"} and standing(spark, out)[0][0][2] == "Beta"
    assert not refresh.refresh(spark, other, str(raw), out, "2024-01-04 00:00:00", force=True).skipped
    for x in raw.iterdir():
        x.unlink()
    put(raw, "empty.csv", "")
    refresh.refresh(spark, other, str(raw), out, "2024-01-05 00:00:00")
    assert standing(spark, out) == ([], [])


def test_a_failed_run_leaves_the_last_version(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    put(raw, "a.csv", "id,name\n1,a\n")
    refresh.refresh(spark, SPEC, str(raw), out, "2024-01-01 00:00:00")
    kept, before = standing(spark, out), partitions(out)
    put(raw, "a.csv", "id,name\n2,b\n")

    def overtaken(*a, **b):
        raise snapshots.Conflict("another run was faster")

    with monkeypatch.context() as m:
        m.setattr(snapshots, "commit", overtaken)
        with pytest.raises(snapshots.Conflict):
            refresh.refresh(spark, SPEC, str(raw), out, "2024-01-02 00:00:00")
    assert standing(spark, out) == kept and partitions(out) == before
    assert refresh.refresh(spark, SPEC, str(raw), out, "2024-01-02 00:00:00").version == 2 and standing(spark, out) == whole(spark, raw)


# snapshots


def test_readers_see_one_whole_version(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, path)
    snapshots.replace(spark.range(10).withColumn("v", F.lit(0)), path)
    seen, stop = [], threading.Event()

    def watch():
        while not stop.is_set():
            seen.append(tuple(snapshots.read(spark, path).agg(F.count("*"), F.min("v"), F.max("v")).first()))

    reader = threading.Thread(target=watch)
    reader.start()
    for v in (1, 2, 3):
        snapshots.replace(snapshots.read(spark, path).withColumn("v", F.lit(v)), path)  # from itself
    stop.set()
    reader.join()
    assert seen and all(n == 10 and a == b for n, a, b in seen)
    assert [n for n, _ in snapshots.versions(spark, path)] == [1, 2, 3, 4] and snapshots.read(spark, path, 2).first()["v"] == 1


def test_writers_that_fail_or_meet(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.replace(spark.range(3), path)
    with pytest.raises(Exception):
        snapshots.replace(spark.range(5).select(F.raise_error(F.lit("no")).alias("id")), path)
    assert snapshots.read(spark, path).count() == 3 and len([x for x in os.listdir(path) if x.startswith("v-")]) == 1
    with pytest.raises(snapshots.Conflict):
        snapshots.replace(spark.range(5), path, after=0)
    (tmp_path / "t" / snapshots.POINTERS / f"{2:09d}").write_text("")  # a writer died before it could name its folder
    (tmp_path / "t" / "v-left").mkdir()
    assert snapshots.read(spark, path).count() == 3
    assert snapshots.replace(spark.range(7), path, after=1).count() == 7 and snapshots.latest(spark, path)[0] == 3
    assert "v-left" in snapshots.vacuum(spark, path, keep=1) and snapshots.read(spark, path).count() == 7
    with pytest.raises(FileNotFoundError):
        snapshots.read(spark, path, 1)


def test_exports_change_places_in_the_catalog(spark):
    import uuid

    name = f"t_{uuid.uuid4().hex[:6]}"
    sinks.export_table(spark.range(3), name)
    before = spark.table(name)
    assert before.count() == 3
    sinks.export_table(spark.table(name).where("id > 0"), name)  # from itself, with the same columns
    assert spark.table(name).count() == 2
    sinks.export_table(spark.range(4).withColumn("more", F.lit("x")), name)
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).count() == 4
    sinks.export_table(spark.table(name).limit(0), name)
    assert spark.table(name).count() == 0 and name in {r["table_name"] for r in sinks.catalog_tables(spark).collect()}
    spark.sql(f"DROP TABLE {name}")


# digests


def tree(data, piece):
    leaves = [hashlib.sha256(data[i : i + piece]).hexdigest() for i in range(0, max(1, len(data)), piece)]
    return hashlib.sha256(f"{len(data)}:{''.join(leaves)}".encode()).hexdigest()


def test_digests_do_not_depend_on_the_way(spark, tmp_path, monkeypatch):
    data = {"a": b"", "b": b"x" * 1000, "c d": bytes(range(256)) * 17, "e%20f": b"y" * 128, "g": b"x" * 1000}
    for n, x in data.items():
        (tmp_path / n).write_bytes(x)
    want = {n: (tree(x, 128), len(x)) for n, x in data.items()}
    assert {r["name"]: (r["digest"], r["size"]) for r in digests.hash_files(spark, str(tmp_path), piece=128).collect()} == want
    monkeypatch.setattr(digests, "python_opens", lambda _: False)
    assert {r["name"]: (r["digest"], r["size"]) for r in digests.hash_files(spark, str(tmp_path), piece=128).collect()} == want


def test_a_file_above_two_gigabytes(spark, tmp_path):
    """A sparse file of 2.2 GB, which no row of Spark could hold, in pieces over all tasks."""
    at = tmp_path / "large.bin"
    with open(at, "wb") as f:
        f.truncate(2_200_000_000)
        f.seek(2_100_000_000)
        f.write(b"here")
    first = digests.hash_files(spark, str(tmp_path)).collect()
    assert [(r["name"], r["size"]) for r in first] == [("large.bin", 2_200_000_000)]
    with open(at, "r+b") as f:
        f.seek(2_100_000_001)
        f.write(b"H")
    assert digests.hash_files(spark, str(tmp_path)).first()["digest"] != first[0]["digest"]


# headers


@pytest.fixture
def thousand(tmp_path):
    """1,000 CSV files of three headers, some without rows, two without bytes, one with a quoted line break and a blank header."""
    styles = ["id,name", "name,id,extra", "ID ,other"]
    for i in range(1000):
        rows = "" if i % 100 == 7 else {0: f"{i},n{i}\n", 1: f"n{i},{i},x\n", 2: f"{i},o\n"}[i % 3]
        (tmp_path / f"f{i:04d}.csv").write_text(styles[i % 3] + "\n" + rows)
    for n in ("z1.csv", "z2.csv"):
        (tmp_path / n).write_text("")
    (tmp_path / "y.csv").write_text('﻿"two\nlines",,c\n1,2,3\n', encoding="utf-8")
    return tmp_path


def test_a_thousand_headers_in_one_job(spark, thousand):
    tracker, group = spark.sparkContext.statusTracker(), "headers of a thousand files"
    spark.sparkContext.setJobGroup(group, group)
    try:
        got = headers.scan_headers(spark, str(thousand)).collect()
        assert len(tracker.getJobIdsForGroup(group)) <= 4  # Spark's listing of many files, and the steps of one query: not one for each file
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    by_file = {}
    for r in sorted(got, key=lambda r: r["pos"]):
        by_file.setdefault(r["file"], []).append(r["col"])
    assert len(by_file) == 1001 and by_file["f0001.csv"] == ["name", "id", "extra"] and by_file["f0002.csv"] == ["ID", "other"] and by_file["y.csv"] == ["two\nlines", "_unnamed_1", "c"]
    assert {r["file"] for r in got if not r["has_rows"]} == {f"f{i:04d}.csv" for i in range(1000) if i % 100 == 7}
    found = drift.schema_drift(headers.scan_headers(spark, str(thousand), pattern="f*.csv").select("file", "col")).collect()
    assert {r["col"]: r["in_all"] for r in found} == {"id": False, "name": False, "extra": False, "ID": False, "other": False}


def test_a_thousand_files_in_three_scans(spark, thousand):
    df = headers.combine_files(spark, str(thousand), pattern="f*.csv")
    assert df._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 3
    rows = df.collect()
    assert len(rows) == 990 and {tuple(r[c] for c in ("name", "extra")) for r in rows if r["_file"] == "f0001.csv"} == {("n1", "x")}
    with pytest.raises(ValueError):
        headers.combine_files(spark, str(thousand), pattern="z*.csv")


def test_headers_of_parquet_and_of_other_stores(spark, tmp_path, monkeypatch):
    spark.range(3).select("id", F.lit("x").alias("s"), F.lit(1.5).alias("d")).coalesce(1).write.parquet(str(tmp_path / "p"))
    spark.range(0).select("id").coalesce(1).write.parquet(str(tmp_path / "q"))
    (tmp_path / "all").mkdir()
    for n in ("p", "q"):
        next((tmp_path / n).glob("part-*.parquet")).rename(tmp_path / "all" / f"{n}.parquet")
    want = {("p.parquet", 0, "id", "bigint", True), ("p.parquet", 1, "s", "string", True), ("p.parquet", 2, "d", "double", True), ("q.parquet", 0, "id", "bigint", False)}
    scan = lambda: {tuple(r)[1:] for r in headers.scan_headers(spark, str(tmp_path / "all"), "parquet").collect()}
    assert scan() == want and [tuple(r)[:3] for r in headers.combine_files(spark, str(tmp_path / "all"), "parquet").orderBy("id").collect()] == [(str(i), "x", "1.5") for i in range(3)]
    monkeypatch.setattr(digests, "python_opens", lambda _: False)
    assert scan() == want
    with pytest.raises(ValueError):
        headers.scan_headers(spark, str(tmp_path / "all"), "json")


# one-pass quarantine


def test_quarantine_reads_its_input_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    raw = spark.createDataFrame([("1", "a", "2"), ("x", "b", "3"), ("5", None, "y"), ("z", "", "w"), (None, "c", " ")], "id string, name string, value string")
    spec = DatasetSpec("q", (ColumnSpec("id", "int64"), ColumnSpec("name"), ColumnSpec("value", "float64")))
    parted = tables.quarantine(raw.mapInArrow(seen, raw.schema), spec, str(tmp_path / "q"))
    assert read.value == 5 and {k: v for k, v in parted.counts.items() if k != "column name"} == {"good": 2, "bad": 3, "column id": 2, "column value": 2}
    good, bad = tables.split_good_bad(raw, spec)
    assert sorted(map(str, parted.good.collect())) == sorted(map(str, good.collect())) and sorted(map(str, parted.bad.collect())) == sorted(map(str, bad.collect()))
    assert parted.good.dtypes == good.dtypes and parted.bad.dtypes == bad.dtypes
    none = tables.quarantine(raw.limit(0), spec, str(tmp_path / "none"))
    assert none.good.count() == none.bad.count() == none.counts["good"] == 0
