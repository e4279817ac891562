"""Queries of what works on large groups: running aggregates over ranges, and exact percentiles by narrowing."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtab.operators import ranges, ranks

from .base import query, table


@query("running_by_group", "SELECT event_id, event_type, row_number() OVER w AS nth, sum(user_id) OVER w AS users_so_far FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING)")
def _(s, d):
    rows = table(s, d, "events").select("event_id", "event_type", F.col("user_id").cast("long").alias("user_id"))
    return ranges.running(rows, {"nth": ("count", F.lit(1)), "users_so_far": ("sum", F.col("user_id"))}, "event_id", ["event_type"]).drop("user_id")


@query("running_whole_table", "SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS nth FROM lineitem")
def _(s, d):
    return ranges.numbered(table(s, d, "lineitem").select("l_orderkey", "l_linenumber"), "nth", ["l_orderkey", "l_linenumber"])


#: So small that groups of the tests' tables are narrowed too.
FEW = 500


@query("exact_quartiles", " UNION ALL ".join(f"SELECT l_returnflag, {q}::DOUBLE AS q, quantile_cont(l_partkey::DOUBLE, {q}) AS part FROM lineitem GROUP BY 1" for q in (0.25, 0.5, 0.75)))
def _(s, d):
    rows = table(s, d, "lineitem").select("l_returnflag", "l_partkey")
    a, b, c = (ranks.exact_percentile(rows, ["l_returnflag"], "l_partkey", q, "part", FEW).withColumn("q", F.lit(q)) for q in (0.25, 0.5, 0.75))
    return a.unionByName(b).unionByName(c).select("l_returnflag", "q", "part")


@query("exact_median_of_table", "SELECT quantile_cont(o_custkey::DOUBLE, 0.5) AS customer FROM orders")
def _(s, d):
    return ranks.exact_percentile(table(s, d, "orders"), [], "o_custkey", 0.5, "customer", FEW)
