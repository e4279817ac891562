"""What keeps the cost of a row from growing: casts that raise nothing inside, and steps that do not repeat a pass."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomtab import registry
from loomtab.functions import casts
from loomtab.operators import ranges, ranks
from loomtab.queries import files

DIR = "/root/testdata/sf0.001"
ODD = [
    "1", "+1", "-1", "+", "-", "", " ", " 7 ", "\t7\n", "7\x7f", "\x7f7", "\x1f-7\x00", "7\u0085", " 7", "٧", "1_0", "1,000", "00012", "9223372036854775807", "9223372036854775808", "-9223372036854775808", "1.", ".5", "-.5", ".", "1.5", "1.5.2", "1e3", "1E+3", "1e-3", "1e",
    "e3", "1d", "1f", "1.5F", "1e400", "-1e400", "NaN", "nan", "-nan", "+NaN", "nand", "inf", "-inf", "+INF", "infinity", "-Infinity", "Infinityd", "infd", "inff", "0x1p3", "0X1.8P-2", "-0x.8p1", "0x10", "0x1p3d", "\t1.5\r\n", "1 5", "- 1", "--1", "1-2", "2024-01-01", "2024-01-01 00:00:11.172425", "purchase", "true", "0", "-0", "0.0", "1L", None,
]


def test_guarded_casts_are_those_of_the_engine(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)], "i int, t string")
    t = F.col("t")
    rounded = F.round(t.try_cast("decimal(38, 10)"), 0).try_cast("bigint")
    whole = F.coalesce(t.try_cast("bigint"), F.when(t.rlike(casts._NUMBER), rounded))
    real = F.when(~t.rlike(casts._SUFFIX) | t.rlike(casts._INFINITE), t.try_cast("double"))
    wrong = df.where(~casts.to_int64(t).eqNullSafe(whole) | ~casts.to_float64(t).eqNullSafe(real))
    assert [r["t"] for r in wrong.collect()] == []


@pytest.mark.parametrize("cast", ["to_int64", "to_float64"])
def test_no_number_is_tried_on_a_text_of_another_form(spark, cast):
    """Every cast from the raw text stands behind a look at its form: the engine raises an exception inside for each text that it cannot read."""
    plan = spark.range(1).select(getattr(casts, cast)(F.col("id").cast("string")).alias("x"))._jdf.queryExecution().analyzed().toString()
    kind = "bigint" if cast == "to_int64" else "double"
    form = casts._WHOLE if cast == "to_int64" else casts._DOUBLE
    assert plan.index(f", {form})") < plan.index(f"as {kind})", plan.index("CASE WHEN"))


def test_kinds_of_declared_columns_alone(spark):
    plan = registry.queries()["dtype_report"](spark, DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "% 3" not in plan and "cast(event_type" not in plan


def test_numbers_of_a_sort_are_those_of_a_window(spark):
    """Large and small groups, NULLs in group and order, equal keys, one column of order that is a field."""
    g = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("s"), F.col("id") % 301))
    k = F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.xxhash64("id") % 1000)
    df = spark.range(20_000).select("id", g.alias("g"), F.struct(k.alias("k"), (-F.col("id")).alias("i")).alias("at")).cache()
    for by in ([], ["g"]):
        want = F.row_number().over(W.partitionBy(*by, F.lit(0)).orderBy(F.asc_nulls_last("at.k"), F.asc("at.i")))
        got = ranges.numbered(df, "n", ["at.k", "at.i"], by)
        assert got.columns == ["id", "g", "at", "n"]
        assert got.select("id", "n").exceptAll(df.select("id", want.cast("long").alias("n"))).count() == 0 and got.count() == 20_000
    ties = ranges.numbered(spark.range(1000).select((F.col("id") % 3).alias("x")), "n", ["x"])
    assert sorted(r["n"] for r in ties.collect()) == list(range(1, 1001))
    assert [r["x"] for r in ties.orderBy("n").collect()] == sorted(i % 3 for i in range(1000))
    assert ranges.numbered(df.where("id < 0"), "n", ["id"], ["g"]).count() == 0


def test_whole_table_is_numbered_without_a_window_over_its_rows(spark):
    plan = registry.queries()["running_whole_table"](spark, DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "lambda" not in plan


def test_states_of_raw_files_are_made_in_one_job(spark, monkeypatch):
    made = []
    put = files.put_files
    monkeypatch.setattr(files, "put_files", lambda *a: made.append(a) or put(*a))
    passes = []
    run = ranges.running
    monkeypatch.setattr(ranges, "running", lambda *a, **b: passes.append(a) or run(*a, **b))
    registry.queries()["refreshed_state"](spark, DIR)
    assert len(made) == 1 and not passes


def test_later_rounds_of_a_percentile_read_what_is_left(spark, monkeypatch):
    read = []
    narrowed = ranks._narrowed
    monkeypatch.setattr(ranks, "_narrowed", lambda values, *a: read.append(values.count()) or narrowed(values, *a))
    df = spark.range(60_000).select((F.xxhash64("id") / 3.0).alias("v"))
    got = ranks.exact_percentile(df, [], "v", 0.5, "p", limit=100).first()["p"]
    assert got == df.agg(F.percentile("v", 0.5).alias("p")).first()["p"]
    assert len(read) > 1 and read[0] == 60_000 and all(n < 6_000 for n in read[1:])
