"""Queries of ingest, schema conformance, casts, value maps, fills, stacking, reshaping and scalars."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtab.functions import casts, scalars
from loomtab.operators import reshape, tables, values
from loomtab.sources import incremental, ingest, sinks
from loomtab.sources.spec import ColumnSpec, DatasetSpec

from .base import FLOW_PAIRS, derived, duck, oracle, pairs, query, raw_tasks, table, tasks
from .workflow import avg

# ingest and sinks


@query("ingest_all_strings", "SELECT cast(o_orderkey AS varchar) AS o_orderkey, cast(o_custkey AS varchar) AS o_custkey, cast(o_orderstatus AS varchar) AS o_orderstatus, cast(o_orderpriority AS varchar) AS o_orderpriority FROM orders")
def _(s, d):
    return ingest.all_strings(table(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))


@query("clean_headers", "SELECT c_custkey AS \"Key\", c_name AS _unnamed_1, c_mktsegment AS Segment FROM customer")
def _(s, d):
    return ingest.clean_headers(table(s, d, "customer").select(F.col("c_custkey").alias(" Key "), F.col("c_name").alias("  "), F.col("c_mktsegment").alias("Segment")))


@query("source_system", "SELECT cast(n_nationkey AS INTEGER) AS k, n_name AS name, 'nation' AS source_system FROM nation UNION ALL SELECT r_regionkey, r_name, 'region' FROM region")
def _(s, d):
    a, b = (ingest.with_source_system(table(s, d, t)) for t in ("nation", "region"))
    return a.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), "source_system").unionByName(b.select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"), "source_system"))


STAMP = "2024-01-02 03:04:05"


@query("provenance", f"SELECT cast(n_nationkey AS INTEGER) AS k, 'nation.parquet' AS _source_file, TIMESTAMP '{STAMP}' AS _ingested_at FROM nation UNION ALL SELECT r_regionkey, 'region.parquet', TIMESTAMP '{STAMP}' FROM region")
def _(s, d):
    a, b = (ingest.with_provenance(table(s, d, t), STAMP) for t in ("nation", "region"))
    return a.select(F.col("n_nationkey").alias("k"), "_source_file", "_ingested_at").unionByName(b.select(F.col("r_regionkey").alias("k"), "_source_file", "_ingested_at"))


@query("materialized_view", "SELECT o_orderstatus, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY 1")
def _(s, d):
    name = f"stg_orders_{uuid.uuid4().hex[:8]}"
    staged = sinks.materialize(table(s, d, "orders").select("o_orderstatus", "o_custkey"), name)
    s.catalog.dropTempView(name)  # what was read from it stays
    return staged.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"), F.count_distinct("o_custkey").alias("n_customers"))


NAMED = ("customer", "documents", "events", "labels", "lineitem", "orders")


@query("named_sources", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in NAMED))
def _(s, d):
    root, _, env = d.rstrip("/").rpartition("/")
    found = ingest.sources(s, root, env)
    return reduce(DataFrame.unionByName, [found[t].agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for t in NAMED])


@query("change_detection", """WITH now AS (SELECT doc_id, md5(text) AS h FROM documents WHERE doc_id % 10 <> 3), old AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN md5('x') ELSE md5(text) END AS h FROM documents WHERE doc_id % 11 <> 5)
  SELECT cast(coalesce(n.doc_id, o.doc_id) AS varchar) AS name, CASE WHEN n.doc_id IS NULL THEN 'gone' WHEN o.doc_id IS NULL THEN 'new' WHEN n.h <> o.h THEN 'changed' ELSE 'unchanged' END AS status FROM now n FULL JOIN old o USING (doc_id)""")
def _(s, d):
    docs = table(s, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("name"), F.md5(F.col("text").cast("binary")).alias("digest"))
    old = docs.where("doc_id % 11 <> 5").withColumn("digest", F.when(F.col("doc_id") % 7 == 0, F.md5(F.lit("x").cast("binary"))).otherwise(F.col("digest")))
    return incremental.detect_changes(docs.where("doc_id % 10 <> 3"), old)


@query("orphan_outputs", "SELECT DISTINCT l_orderkey AS o_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')")
def _(s, d):
    outputs = table(s, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return incremental.orphans(outputs, table(s, d, "orders").where("o_orderstatus <> 'F'"), "o_orderkey")


@query("export_projection", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders")
def _(s, d):
    return sinks.export_projection(table(s, d, "orders").select("o_orderkey", "o_orderdate"))


@query("verify_totals", "SELECT count(*) AS total_rows, count(DISTINCT o_custkey) AS distinct_keys FROM orders")
def _(s, d):
    return sinks.verification_totals(table(s, d, "orders"), "o_custkey")


@query("verify_status_breakdown", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(s, d):
    return sinks.verification_breakdown(table(s, d, "orders"), "o_orderstatus")


@query("relations_by_prefix", "SELECT DISTINCT r_name AS table_name FROM region WHERE r_name ILIKE 'a%' AND NOT r_name ILIKE '%sia'")
def _(s, d):
    return sinks.relations_by_prefix(table(s, d, "region").select(F.col("r_name").alias("table_name")).distinct(), "a", "%sia")


WAREHOUSE = ("region", "nation", "supplier", "part", "orders")


@query("verify_warehouse", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(*) > 0 AS ok FROM {t}" for t in WAREHOUSE) + " UNION ALL SELECT 'invoices', NULL, false")
def _(s, d):
    return sinks.verify_warehouse({t: table(s, d, t) for t in WAREHOUSE}, [*WAREHOUSE, "invoices"], list(WAREHOUSE))


# schema conformance


@query("snake_case_values", r"SELECT p_partkey, lower(trim(regexp_replace(p_name, '[^A-Za-z0-9]+', '_', 'g'), '_')) AS snake FROM part")
def _(s, d):
    return table(s, d, "part").select("p_partkey", scalars.snake_case("p_name").alias("snake"))


@query("alias_rename", "SELECT c_custkey AS customer_id, c_name AS full_name, c_mktsegment FROM customer")
def _(s, d):
    raw = table(s, d, "customer").select(F.col("c_custkey").alias("C Custkey"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("C_MktSegment"), F.col("c_acctbal").alias("name"))
    return tables.rename_by_alias(raw, {"c_custkey": "customer_id", "Name": "full_name", "name": "full_name"})


@query("conform_columns", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def _(s, d):
    return tables.conform_columns(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber", "absent", "l_quantity"])[0]


@query("add_missing_columns", "SELECT s_suppkey, CAST(NULL AS DOUBLE) AS rating, s_name, CAST(NULL AS TIMESTAMP) AS audited, s_nationkey FROM supplier")
def _(s, d):
    return tables.add_missing(table(s, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), {"s_suppkey": "int64", "rating": "float64", "s_name": "string", "audited": "datetime64"})


@query("star_except", "SELECT * EXCLUDE (c_acctbal, c_nationkey) FROM customer")
def _(s, d):
    return tables.star(table(s, d, "customer"), ["C_ACCTBAL", "c_nationkey"])


@query("star_prefix_suffix", "SELECT c_custkey AS x_c_custkey_y, c_name AS x_c_name_y FROM customer")
def _(s, d):
    return tables.star(table(s, d, "customer").select("c_custkey", "c_name"), prefix="x_", suffix="_y")


BLANKS = "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS o_orderpriority FROM {orders}"


@query("nullcheck_table", duck(f"SELECT o_orderkey, nullif(o_orderstatus, '') AS o_orderstatus, nullif(o_orderpriority, '') AS o_orderpriority FROM ({BLANKS})"))
def _(s, d):
    return tables.nullcheck(derived(s, d, BLANKS))


# casts

DIRTY = """SELECT event_id, CASE event_id % 9 WHEN 0 THEN cast(event_id AS {text}) WHEN 1 THEN concat(' ', cast(event_id AS {text}), ' ') WHEN 2 THEN concat(cast(user_id AS {text}), '.5')
  WHEN 3 THEN 'abc' WHEN 4 THEN '' WHEN 5 THEN 'N/A' WHEN 6 THEN '1e3' WHEN 7 THEN concat('-', cast(user_id AS {text})) END AS v,
  CASE event_id % 6 WHEN 0 THEN cast(ts AS {text}) WHEN 1 THEN '2024/03/05' WHEN 2 THEN '2024' WHEN 3 THEN '2024-13-45' WHEN 4 THEN ' 2024-02-29 10:11 ' END AS w,
  CASE event_id % 7 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'no' WHEN 2 THEN '1' WHEN 3 THEN ' yes ' WHEN 4 THEN 'maybe' WHEN 5 THEN '0' END AS b FROM {events}"""
CLEAN = "nullif(nullif(trim({c}), 'N/A'), '')"
AS_INT, AS_FLOAT = f"TRY_CAST({CLEAN.format(c='v')} AS BIGINT)", f"TRY_CAST({CLEAN.format(c='v')} AS DOUBLE)"
AS_TIME = f"TRY_CAST({CLEAN.format(c='w')} AS TIMESTAMP)"
AS_BOOL = f"CASE WHEN lower({CLEAN.format(c='b')}) IN ('true', '1', 'yes') THEN true WHEN lower({CLEAN.format(c='b')}) IN ('false', '0', 'no') THEN false END"
NS = ("N/A",)
SPEC = DatasetSpec("dirty", (ColumnSpec("event_id", "int64", nullable=False, primary_key=True), ColumnSpec("v", "float64", null_strings=NS), ColumnSpec("w", "datetime64", null_strings=NS, max_null_rate=0.1), ColumnSpec("b", "bool", null_strings=NS)), max_null_rate=0.5, max_duplicate_rate=0.0, min_row_count=1)


@query("null_strings", "SELECT o_orderkey, nullif(nullif(trim(o_orderpriority), '1-URGENT'), '') AS p FROM orders")
def _(s, d):
    return table(s, d, "orders").select("o_orderkey", casts.null_strings(F.col("o_orderpriority"), ["1-URGENT"]).alias("p"))


def _cast(name: str, sql: str, column: str, kind: str) -> None:
    @query(name, duck(f"SELECT event_id, {sql} AS x FROM ({DIRTY})"))
    def _(s, d):
        return derived(s, d, DIRTY).select("event_id", casts.try_cast(F.col(column), kind, list(NS)).alias("x"))


for _args in (("cast_int64", AS_INT, "v", "int64"), ("cast_float64", AS_FLOAT, "v", "float64"), ("cast_datetime64", AS_TIME, "w", "datetime64"), ("cast_bool", AS_BOOL, "b", "bool")):
    _cast(*_args)

BAD = {"v": (CLEAN.format(c="v"), AS_FLOAT), "w": (CLEAN.format(c="w"), AS_TIME), "b": (CLEAN.format(c="b"), AS_BOOL)}
IS_BAD = {c: f"({x} IS NOT NULL AND {y} IS NULL)" for c, (x, y) in BAD.items()}
ANY_BAD = " OR ".join(IS_BAD.values())


@query("cast_good_rows", duck(f"SELECT event_id, {AS_FLOAT} AS v, {AS_TIME} AS w, {AS_BOOL} AS b FROM ({DIRTY}) WHERE NOT ({ANY_BAD})"))
def _(s, d):
    return tables.split_good_bad(derived(s, d, DIRTY), SPEC)[0]


@query("cast_bad_rows", duck(f"SELECT * FROM ({DIRTY}) WHERE {ANY_BAD}"))
def _(s, d):
    return tables.split_good_bad(derived(s, d, DIRTY), SPEC)[1]


@query("cast_error_counts", duck(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS n_bad, (SELECT string_agg(x, '|' ORDER BY x) FROM (SELECT DISTINCT {c} AS x FROM ({DIRTY}) WHERE {b} ORDER BY x LIMIT 5)) AS samples FROM ({DIRTY}) WHERE {b}" for c, b in IS_BAD.items())))
def _(s, d):
    return tables.cast_errors(derived(s, d, DIRTY), SPEC)


# value maps and fills

MAP = {"o_orderstatus": {"O": "Open", "F": "Filled", "X": "None"}, "o_orderpriority": {"1-URGENT": "urgent", "5-LOW": None}, "absent": {"a": "b"}}


@query("value_map_case", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled' ELSE o_orderstatus END AS o_orderstatus, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '5-LOW' THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders")
def _(s, d):
    return values.apply_value_maps(table(s, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), MAP)


@query("value_map_counts", "SELECT 'o_orderstatus' AS column_name, count(*) FILTER (WHERE o_orderstatus IN ('O', 'F')) AS changed FROM orders UNION ALL SELECT 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '5-LOW')) FROM orders")
def _(s, d):
    return values.remap_counts(table(s, d, "orders"), MAP)


@query("lookup_normalize", oracle("SELECT row_id, CASE flowname WHEN 'uw renewal' THEN 'UW Renewal' WHEN 'uw new' THEN 'UW New' ELSE flowname END AS flowname FROM raw"))
def _(s, d):
    return values.lookup_normalize(raw_tasks(s, d).select("row_id", "flowname"), "flowname", pairs(s, FLOW_PAIRS))


GAPS = "SELECT event_id AS row_id, CASE WHEN event_id % 5 = 0 THEN user_id END AS n, CASE WHEN event_id % 7 = 3 THEN event_type END AS c FROM {events}"


@query("fill_zero", duck(f"SELECT row_id, coalesce(n, 0) AS n, c FROM ({GAPS})"))
def _(s, d):
    return values.fill(derived(s, d, GAPS), {"n": "fill_zero"})


@query("fill_unknown", duck(f"SELECT row_id, n, coalesce(c, 'Unknown') AS c FROM ({GAPS})"))
def _(s, d):
    return values.fill(derived(s, d, GAPS), {"c": "fill_unknown", "n": "something"})


@query("fill_forward", duck(f"SELECT row_id, last_value(n IGNORE NULLS) OVER (ORDER BY row_id ROWS UNBOUNDED PRECEDING) AS n, last_value(c IGNORE NULLS) OVER (ORDER BY row_id ROWS UNBOUNDED PRECEDING) AS c FROM ({GAPS})"))
def _(s, d):
    return values.fill(derived(s, d, GAPS), {"n": "fill_forward", "c": "fill_forward"})


@query("fill_backward", duck(f"SELECT row_id, first_value(n IGNORE NULLS) OVER (ORDER BY row_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n, c FROM ({GAPS})"))
def _(s, d):
    return values.fill(derived(s, d, GAPS), {"n": "fill_backward"})


@query("null_rates", oracle(" UNION ALL ".join(f"SELECT '{c}' AS column_name, {avg(f'count(*) FILTER (WHERE {c} IS NULL) * 100', 'count(*)', 2)} AS null_percent FROM t" for c in ("flowname", "taskstatus", "policynumber", "endtime"))))
def _(s, d):
    return values.null_rates(tasks(s, d), ["flowname", "taskstatus", "policynumber", "endtime"])


@query("row_id", "SELECT event_id, row_number() OVER (ORDER BY event_id) AS row_id FROM events")
def _(s, d):
    return tables.add_row_id(table(s, d, "events").select("event_id"), "event_id")


@query("row_id_by_file", "SELECT count(*) AS n, count(DISTINCT event_id + 1) AS n_distinct, 1 AS least, count(*) AS most FROM events")
def _(s, d):
    out = tables.add_row_id_by_file(table(s, d, "events"))
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_id").alias("n_distinct"), F.min("row_id").cast("int").alias("least"), F.max("row_id").alias("most"))


@query("key_normalize", oracle("SELECT row_id, lower(trim(assignedto)) AS k FROM raw"))
def _(s, d):
    return raw_tasks(s, d).select("row_id", scalars.trim_lower("assignedto").alias("k"))


@query("collapse_spaces", oracle(r"SELECT row_id, regexp_replace(drawer, '\s+', ' ', 'g') AS drawer FROM raw"))
def _(s, d):
    return raw_tasks(s, d).select("row_id", scalars.collapse_spaces("drawer").alias("drawer"))


@query("null_literals", oracle("SELECT row_id, CASE WHEN trim(title) IN ('', 'NULL', 'null', 'N/A', 'n/a') THEN NULL ELSE title END AS title FROM people"))
def _(s, d):
    from .base import PEOPLE

    return derived(s, d, PEOPLE).select("row_id", scalars.missing_to_null("title").alias("title"))


LOGINS = "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN concat('corp', {bs}, c_name) ELSE concat('ab', {bs}, 'cd', {bs}, c_name) END AS login FROM {customer}"


@query("login_domain", duck(f"SELECT c_custkey, CASE WHEN position('\\' IN login) > 0 THEN concat(upper(split_part(login, '\\', 1)), '\\', split_part(login, '\\', 2)) ELSE login END AS login FROM ({LOGINS})"))
def _(s, d):
    return derived(s, d, LOGINS).select("c_custkey", scalars.upper_domain("login").alias("login"))


# stacking

LEFT = "SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer"
RIGHT = "SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation FROM supplier"


def _sides(s, d):
    a = table(s, d, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance")
    return a, table(s, d, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_nationkey AS nation")


@query("combine_by_name", f"SELECT * FROM ({LEFT}) UNION ALL BY NAME SELECT * FROM ({RIGHT})")
def _(s, d):
    a, b = _sides(s, d)
    return tables.combine_by_name([a, b.where("id < 0"), b])


@query("union_relations", f"SELECT 'customer' AS origin, * FROM ({LEFT}) UNION ALL BY NAME SELECT 'supplier' AS origin, * FROM ({RIGHT})")
def _(s, d):
    return tables.union_relations(dict(zip(("customer", "supplier"), _sides(s, d), strict=True)), source="origin")


@query("union_include", f"SELECT id, name FROM ({LEFT}) UNION ALL SELECT id, name FROM ({RIGHT})")
def _(s, d):
    return tables.union_relations(dict(zip("ab", _sides(s, d), strict=True)), include=["ID", "name"])


@query("union_exclude", f"SELECT id, NULL::INTEGER AS nation FROM ({LEFT}) UNION ALL SELECT id, nation FROM ({RIGHT})")
def _(s, d):
    return tables.union_relations(dict(zip("ab", _sides(s, d), strict=True)), exclude=["name", "balance"])


@query("union_where", f"SELECT id, name FROM ({LEFT}) WHERE id > 50 UNION ALL SELECT id, name FROM ({RIGHT}) WHERE id > 50")
def _(s, d):
    return tables.union_relations(dict(zip("ab", _sides(s, d), strict=True)), include=["id", "name"], where="id > 50")


@query("union_override", f"SELECT cast(id AS varchar) AS id FROM ({LEFT}) UNION ALL SELECT cast(id AS varchar) FROM ({RIGHT})")
def _(s, d):
    return tables.union_relations(dict(zip("ab", _sides(s, d), strict=True)), include=["id"], override={"id": "string"})


# reshaping


@query("pivot_count", "SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'O') AS O, count(*) FILTER (WHERE l_linestatus = 'F') AS F FROM lineitem GROUP BY 1")
def _(s, d):
    return reshape.pivot(table(s, d, "lineitem"), ["l_returnflag"], "l_linestatus", ["O", "F"])


@query("pivot_sum_value", "SELECT l_returnflag, CAST(sum(CASE WHEN l_linestatus = 'O' THEN l_linenumber ELSE 0 END) AS BIGINT) AS s_o_x, CAST(sum(CASE WHEN l_linestatus = 'F' THEN l_linenumber ELSE 0 END) AS BIGINT) AS s_f_x FROM lineitem GROUP BY 1")
def _(s, d):
    return reshape.pivot(table(s, d, "lineitem"), ["l_returnflag"], "l_linestatus", ["O", "F"], prefix="s_", suffix="_x", then_value="l_linenumber", quote_identifiers=False)


@query("pivot_distinct", "SELECT l_returnflag, count(DISTINCT CASE WHEN l_linenumber >= 1 THEN l_suppkey END) AS \"from 1\", count(DISTINCT CASE WHEN l_linenumber >= 4 THEN l_suppkey END) AS \"from 4\" FROM lineitem GROUP BY 1")
def _(s, d):
    return reshape.pivot(table(s, d, "lineitem"), ["l_returnflag"], "l_linenumber", [1, 4], agg="count", cmp=">=", prefix="from ", then_value="l_suppkey", else_value=None, distinct=True)


@query("unpivot_strings", "SELECT c_custkey, field_name, value FROM (SELECT c_custkey, unnest(['c_name', 'c_nationkey', 'rich']) AS field_name, unnest([c_name, CASE WHEN c_nationkey = 3 THEN NULL ELSE cast(c_nationkey AS varchar) END, CASE WHEN c_acctbal > 0 THEN 'true' ELSE 'false' END]) AS value FROM customer)")
def _(s, d):
    df = table(s, d, "customer").selectExpr("c_custkey", "c_name", "CASE WHEN c_nationkey = 3 THEN NULL ELSE c_nationkey END AS c_nationkey", "c_acctbal > 0 AS rich", "c_mktsegment")
    return reshape.unpivot(df, exclude=["c_custkey"], remove=["C_MKTSEGMENT"])


@query("generate_series", "SELECT unnest(generate_series(1, (SELECT count(*) FROM orders))) AS generated_number")
def _(s, d):
    return reshape.generate_series(s, table(s, d, "orders").count())


def _extent(s, d):
    r = table(s, d, "events").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    return str(r["a"]), str(r["b"])


@query("date_spine_day", "SELECT CAST(a + to_days(CAST(i AS INTEGER)) AS TIMESTAMP) AS date_day FROM (SELECT min(ts) AS a, max(ts) AS b FROM events), range(date_diff('day', a, b)) AS r(i) WHERE a + to_days(CAST(i AS INTEGER)) <= b")
def _(s, d):
    return reshape.date_spine(s, "day", *_extent(s, d))


@query("date_spine_month", "SELECT CAST(a + to_months(CAST(i AS INTEGER)) AS TIMESTAMP) AS date_month FROM (SELECT min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders), range(date_diff('month', a, b)) AS r(i) WHERE a + to_months(CAST(i AS INTEGER)) <= b")
def _(s, d):
    r = table(s, d, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")).first()
    return reshape.date_spine(s, "month", str(r["a"]), str(r["b"]))


@query("date_spine_gap_join", """SELECT CAST(day AS DATE) AS day, count(event_id) AS n FROM (SELECT CAST(min(ts) AS DATE) + CAST(i AS INTEGER) AS day FROM events, range((SELECT date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) AS DATE)) + 1 FROM events)) AS r(i) GROUP BY i)
  LEFT JOIN events ON CAST(ts AS DATE) = day AND event_type = 'purchase' GROUP BY 1""")
def _(s, d):
    import datetime

    first, last = table(s, d, "events").agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    spine = reshape.date_spine(s, "day", f"{first} 00:00:00", f"{last + datetime.timedelta(1)} 00:00:00").select(F.to_date("date_day").alias("day"))
    daily = table(s, d, "events").where("event_type = 'purchase'").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(daily, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query("deduplicate", "SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1")
def _(s, d):
    return tables.deduplicate(table(s, d, "events").select("event_id", "user_id", "event_type", "ts"), ["user_id"], [F.desc("ts"), F.asc("event_id")]).drop("ts")


MAYBE = "SELECT event_id, user_id, CASE WHEN user_id % 4 = 0 THEN NULL ELSE event_type END AS event_type FROM {events}"


@query("deduplicate_strict", duck(f"SELECT * FROM (SELECT * FROM ({MAYBE}) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1) WHERE event_type IS NOT NULL"))
def _(s, d):
    return tables.deduplicate(derived(s, d, MAYBE), ["user_id"], [F.asc("event_id")], strict_natural=True)


@query("single_value", "SELECT max(o_orderkey) AS x FROM orders")
def _(s, d):
    top = reshape.single_value(table(s, d, "orders").agg(F.max("o_orderkey")))
    return table(s, d, "orders").where(F.col("o_orderkey") == top).select(F.col("o_orderkey").alias("x")).distinct()


@query("surrogate_key", "SELECT l_orderkey, l_linenumber, md5(concat_ws('-', cast(l_orderkey AS varchar), coalesce(CASE WHEN l_linenumber = 2 THEN NULL ELSE cast(l_linenumber AS varchar) END, '_dbt_utils_surrogate_key_null_'), l_returnflag)) AS k FROM lineitem")
def _(s, d):
    n = F.when(F.col("l_linenumber") != 2, F.col("l_linenumber"))
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", scalars.surrogate_key("l_orderkey", n, "l_returnflag").alias("k"))


@query("surrogate_key_empty_nulls", "SELECT l_orderkey, l_linenumber, md5(concat_ws('-', cast(l_orderkey AS varchar), coalesce(CASE WHEN l_linenumber = 2 THEN NULL ELSE cast(l_linenumber AS varchar) END, ''))) AS k FROM lineitem")
def _(s, d):
    n = F.when(F.col("l_linenumber") != 2, F.col("l_linenumber"))
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", scalars.surrogate_key("l_orderkey", n, nulls_as_empty=True).alias("k"))


@query("column_values_topk", "SELECT l_suppkey AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7")
def _(s, d):
    return reshape.column_values(table(s, d, "lineitem"), "l_suppkey", 7)


@query("column_values_where", "SELECT l_returnflag AS value, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1")
def _(s, d):
    return reshape.column_values(table(s, d, "lineitem"), "l_returnflag", where="l_linestatus = 'F'")


@query("group_by_first_n", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def _(s, d):
    return reshape.group_by_first(table(s, d, "orders").select("o_orderstatus", "o_orderpriority", "o_orderkey"), 2, F.count(F.lit(1)).alias("n"))


# scalars

NUMBERS = "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_linenumber END AS a, CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE l_suppkey END AS b FROM {lineitem}"


@query("safe_add", duck(f"SELECT l_orderkey, l_linenumber, coalesce(a, 0) + coalesce(b, 0) + l_orderkey AS x FROM ({NUMBERS})"))
def _(s, d):
    return derived(s, d, NUMBERS).select("l_orderkey", "l_linenumber", scalars.safe_add("a", "b", "l_orderkey").alias("x"))


@query("safe_subtract", duck(f"SELECT l_orderkey, l_linenumber, coalesce(a, 0) - coalesce(b, 0) AS x FROM ({NUMBERS})"))
def _(s, d):
    return derived(s, d, NUMBERS).select("l_orderkey", "l_linenumber", scalars.safe_subtract("a", "b").alias("x"))


@query("safe_divide", "SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_linenumber - 1, 0) AS x FROM lineitem")
def _(s, d):
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", scalars.safe_divide(F.col("l_extendedprice"), F.col("l_linenumber") - 1).alias("x"))


@query("width_bucket", "SELECT o_orderkey, CAST(CASE WHEN o_totalprice < 20000 THEN 0 WHEN o_totalprice >= 100000 THEN 9 ELSE floor((o_totalprice - 20000) / (80000.0::DOUBLE / 8)) + 1 END AS BIGINT) AS bucket FROM orders")
def _(s, d):
    return table(s, d, "orders").select("o_orderkey", scalars.width_bucket("o_totalprice", 20000, 100000, 8).alias("bucket"))


@query("width_bucket_legacy", "SELECT o_orderkey, CAST(CASE WHEN p % 10000 = 0 THEN 1 ELSE 0 END + least(ceil((p - 20000) / 10000.0::DOUBLE), 9) AS BIGINT) AS bucket FROM (SELECT o_orderkey, floor(o_totalprice / 5000) * 5000 AS p FROM orders)")
def _(s, d):
    return table(s, d, "orders").select("o_orderkey", scalars.width_bucket(F.floor(F.col("o_totalprice") / 5000).cast("double") * 5000, 20000, 100000, 8, legacy=True).alias("bucket"))


PLACES = "SELECT c_custkey, (c_custkey % 170) - 85 AS a, (c_custkey * 7 % 340) - 170 AS b, (c_custkey * 3 % 170) - 85 AS c, (c_custkey * 11 % 340) - 170 AS e FROM {customer}"
HAVERSINE = "2 * 3961 * asin(sqrt(pow(sin((radians(c) - radians(a)) / 2), 2) + cos(radians(a)) * cos(radians(c)) * pow(sin((radians(e) - radians(b)) / 2), 2)))"


@query("haversine_mi", duck(f"SELECT c_custkey, round({HAVERSINE}, 4) AS dist FROM ({PLACES})"))
def _(s, d):
    return derived(s, d, PLACES).select("c_custkey", F.round(scalars.haversine("a", "b", "c", "e"), 4).alias("dist"))


@query("haversine_km", duck(f"SELECT c_custkey, round({HAVERSINE} * 1.60934::DOUBLE, 4) AS dist FROM ({PLACES})"))
def _(s, d):
    return derived(s, d, PLACES).select("c_custkey", F.round(scalars.haversine("a", "b", "c", "e", "km"), 4).alias("dist"))


@query("url_host", "SELECT page_id, split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1) AS x FROM pages")
def _(s, d):
    return table(s, d, "pages").select("page_id", scalars.url_host("url").alias("x"))


@query("url_path", """SELECT page_id, split_part(CASE WHEN length(u) - p = 0 THEN '' ELSE right(u, length(u) - p) END, '?', 1) AS x
  FROM (SELECT page_id, u, coalesce(nullif(position('/' IN u), 0), position('?' IN u) - 1) AS p FROM (SELECT page_id, replace(replace(url, 'http://', ''), 'https://', '') AS u FROM pages))""")
def _(s, d):
    return table(s, d, "pages").select("page_id", scalars.url_path("url").alias("x"))


@query("url_parameter", "SELECT page_id, nullif(split_part(split_part(u, 'utm=', 2), '&', 1), '') AS x FROM (SELECT page_id, concat(url, CASE WHEN page_id % 3 = 0 THEN '?utm=' || page_id || '&z=1' WHEN page_id % 3 = 1 THEN '?utm=&z=2' ELSE '' END) AS u FROM pages)")
def _(s, d):
    p = table(s, d, "pages").selectExpr("page_id", "concat(url, CASE WHEN page_id % 3 = 0 THEN '?utm=' || page_id || '&z=1' WHEN page_id % 3 = 1 THEN '?utm=&z=2' ELSE '' END) AS u")
    return p.select("page_id", scalars.url_parameter("u", "utm").alias("x"))


def _diff(part: str) -> None:
    @query(f"date_diff_{part}", oracle(f"SELECT row_id, date_diff('{part}', dateinitiated, endtime) AS x FROM t"))
    def _(s, d):
        return tasks(s, d).select("row_id", scalars.date_diff(part, "dateinitiated", "endtime").alias("x"))


for _p in ("minute", "hour", "day"):
    _diff(_p)

