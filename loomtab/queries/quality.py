"""Queries of the data-quality checks, profiles and schema drift, each on data with passing and failing rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtab.operators import checks, drift
from loomtab.sources import ingest
from loomtab.sources.spec import ColumnSpec, DatasetSpec

from .base import AS_OF, derived, duck, query, table
from .workflow import avg

HOLES = "SELECT event_id, user_id, event_type, value, ts, CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS kind, CASE WHEN user_id % 10 = 0 THEN NULL ELSE value END AS v, user_id % 3 AS g FROM {events}"


@query("check_accepted_range", "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT o_totalprice >= 20000 OR NOT o_totalprice <= 90000")
def _(s, d):
    return checks.accepted_range(table(s, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 20000, 90000)


@query("check_accepted_range_exclusive", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT l_linenumber > 1")
def _(s, d):
    return checks.accepted_range(table(s, d, "lineitem").select("l_orderkey", "l_linenumber"), "l_linenumber", 1, inclusive=False)


@query("check_at_least_one", duck(f"SELECT user_id, count(v) AS n_values FROM ({HOLES}) GROUP BY 1 HAVING count(v) = 0"))
def _(s, d):
    return checks.at_least_one(derived(s, d, HOLES), "v", ["user_id"])


@query("check_cardinality_equality", """SELECT coalesce(a.value, b.value) AS value, n_a, n_b FROM (SELECT l_orderkey AS value, count(*) AS n_a FROM lineitem GROUP BY 1) a
  FULL JOIN (SELECT o_orderkey AS value, count(*) AS n_b FROM orders GROUP BY 1) b USING (value) WHERE n_a IS DISTINCT FROM n_b""")
def _(s, d):
    return checks.cardinality_equality(table(s, d, "lineitem"), "l_orderkey", table(s, d, "orders"), "o_orderkey")


@query("check_equal_rowcount", "SELECT g, n_a, n_b, abs(n_a - n_b) AS diff_count FROM (SELECT o_custkey % 7 AS g, count(*) AS n_a FROM orders GROUP BY 1) FULL JOIN (SELECT c_custkey % 7 AS g, count(*) AS n_b FROM customer WHERE c_custkey % 7 <> 2 GROUP BY 1) USING (g) WHERE coalesce(abs(n_a - n_b), 0) <> 0")
def _(s, d):
    a = table(s, d, "orders").select((F.col("o_custkey") % 7).alias("g"))
    return checks.equal_rowcount(a, table(s, d, "customer").select((F.col("c_custkey") % 7).alias("g")).where("g <> 2"), ["g"])


@query("check_fewer_rows", "SELECT g, n_a, n_b, CASE WHEN n_a > n_b THEN n_a - n_b ELSE 1 END AS row_count_delta FROM (SELECT s_nationkey AS g, count(*) AS n_a FROM supplier GROUP BY 1) JOIN (SELECT n_nationkey AS g, count(*) AS n_b FROM nation GROUP BY 1) USING (g) WHERE n_a >= n_b")
def _(s, d):
    return checks.fewer_rows_than(table(s, d, "supplier").select(F.col("s_nationkey").alias("g")), table(s, d, "nation").select(F.col("n_nationkey").alias("g")), ["g"])


@query("check_not_accepted_values", "SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '9-NONE')")
def _(s, d):
    return checks.not_accepted_values(table(s, d, "orders"), "o_orderpriority", ["1-URGENT", "9-NONE"])


A, B = "SELECT n_nationkey, n_regionkey FROM nation WHERE n_nationkey <> 3", "SELECT n_nationkey, CASE WHEN n_nationkey = 7 THEN 99 ELSE n_regionkey END AS n_regionkey FROM nation"


@query("check_equality", f"(SELECT *, 'a_minus_b' AS which_diff FROM ({A} EXCEPT {B})) UNION ALL (SELECT *, 'b_minus_a' FROM ({B} EXCEPT {A}))")
def _(s, d):
    n = table(s, d, "nation").select("n_nationkey", "n_regionkey")
    return checks.equality(n.where("n_nationkey <> 3"), n.withColumn("n_regionkey", F.when(F.col("n_nationkey") == 7, 99).otherwise(F.col("n_regionkey"))))


@query("check_expression", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus = 'F' AND NOT (l_discount * 100 <= l_quantity)")
def _(s, d):
    return checks.expression_is_true(table(s, d, "lineitem"), "l_discount * 100 <= l_quantity", "l_linestatus = 'F'").select("l_orderkey", "l_linenumber")


SPANS = "SELECT event_id, user_id, ts AS a, CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 17 = 0 THEN ts ELSE {start} END AS b FROM {events}"


def _ranges(gaps: str, sign: str, zero: bool) -> None:
    sound = "a <= b" if zero else "a < b"

    @query(f"check_ranges_{gaps}", duck(f"SELECT event_id FROM (SELECT *, lead(a) OVER w AS nxt, lead(1) OVER w IS NULL AS edge FROM ({SPANS}) WINDOW w AS (PARTITION BY user_id ORDER BY a NULLS LAST)) WHERE NOT (coalesce({sound}, false) AND (edge OR coalesce(b {sign} nxt, false)))"))
    def _(s, d):
        return checks.mutually_exclusive_ranges(derived(s, d, SPANS), "a", "b", ["user_id"], gaps, zero).select("event_id")


for _args in (("allowed", "<=", False), ("not_allowed", "=", True), ("required", "<", False)):
    _ranges(*_args)

WHOLE = "SELECT event_id, event_id * 10 AS a, event_id * 10 + CASE WHEN event_id % 100 = 7 THEN 12 WHEN event_id % 100 = 9 THEN 0 ELSE 10 END AS b FROM {events}"


@query("check_ranges_whole_table", duck(f"SELECT event_id FROM (SELECT *, lead(a) OVER (ORDER BY a) AS nxt FROM ({WHOLE})) WHERE NOT (a < b AND (nxt IS NULL OR b <= nxt))"))
def _(s, d):
    return checks.mutually_exclusive_ranges(derived(s, d, WHOLE), "a", "b").select("event_id")


@query("check_not_constant", "SELECT s_nationkey, cast(1 AS bigint) AS n_distinct FROM supplier GROUP BY 1 HAVING count(DISTINCT s_name) = 1")
def _(s, d):
    return checks.not_constant(table(s, d, "supplier"), "s_name", ["s_nationkey"])


@query("check_relationships_where", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linenumber < 4 AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')")
def _(s, d):
    return checks.relationships(table(s, d, "lineitem"), "l_orderkey", table(s, d, "orders"), "o_orderkey", "l_linenumber < 4", "o_orderstatus <> 'P'").select("l_orderkey", "l_linenumber")


@query("check_relationships", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(s, d):
    return checks.relationships(table(s, d, "documents").select("doc_id"), "doc_id", table(s, d, "labels"), "doc_id")


@query("check_not_null_proportion", duck(f"SELECT g, not_null_proportion FROM (SELECT g, count(v) / count(*)::DOUBLE AS not_null_proportion FROM ({HOLES}) GROUP BY 1) WHERE not_null_proportion < 0.9"))
def _(s, d):
    return checks.not_null_proportion(derived(s, d, HOLES), "v", 0.9, by=["g"])


@query("check_recency", f"SELECT event_type, user_id, max(ts) AS most_recent, TIMESTAMP '{AS_OF}' - INTERVAL 18 DAY AS threshold FROM events GROUP BY 1, 2 HAVING max(ts) < TIMESTAMP '{AS_OF}' - INTERVAL 18 DAY")
def _(s, d):
    return checks.recency(table(s, d, "events"), "ts", "day", 18, AS_OF, ["event_type", "user_id"])


HOPS = "SELECT event_id, CASE WHEN event_id % 500 = 3 THEN event_id + 1 ELSE event_id END AS n, user_id FROM {events}"


@query("check_sequential_values", duck(f"SELECT event_id, n, user_id, previous FROM (SELECT *, lag(n) OVER (ORDER BY n, event_id) AS previous FROM ({HOPS}) WHERE event_id % 500 <> 4) WHERE n <> previous + 1"))
def _(s, d):
    return checks.sequential_values(derived(s, d, HOPS).where("event_id % 500 <> 4"), "n")




@query("check_sequential_timestamps", duck("SELECT event_type, h, previous FROM (SELECT *, lag(h) OVER (PARTITION BY event_type ORDER BY h) AS previous FROM (SELECT DISTINCT event_type, cast(date_trunc('hour', ts) AS TIMESTAMP) AS h FROM {events})) WHERE h <> previous + INTERVAL 1 HOUR"))
def _(s, d):
    hours = table(s, d, "events").select("event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h")).distinct()
    return checks.sequential_values(hours, "h", 1, "hour", ["event_type"])


@query("check_unique_combination", "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(s, d):
    return checks.unique_combination(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("check_accepted_values", "SELECT o_orderstatus, count(*) AS n_records FROM orders WHERE o_orderstatus NOT IN ('O', 'F') GROUP BY 1")
def _(s, d):
    return checks.accepted_values(table(s, d, "orders"), "o_orderstatus", ["O", "F"])


@query("check_not_null", duck(f"SELECT event_id FROM ({HOLES}) WHERE kind IS NULL"))
def _(s, d):
    return checks.not_null(derived(s, d, HOLES), "kind").select("event_id")


@query("check_unique", "SELECT o_custkey, count(*) AS n_records FROM orders GROUP BY 1 HAVING count(*) > 1")
def _(s, d):
    return checks.unique(table(s, d, "orders"), "o_custkey")


EDGES = "SELECT doc_id, CASE WHEN doc_id % 40 = 0 THEN '  ' WHEN doc_id % 40 = 1 THEN NULL ELSE source END AS source FROM {documents}"


@query("check_not_empty_string", duck(f"SELECT * FROM ({EDGES}) WHERE trim(source) = ''"))
def _(s, d):
    return checks.not_empty_string(derived(s, d, EDGES), "source")


NULL_COLUMNS = ("event_type", "kind", "v")


def _rates(where: str = "true", digits: int = 2, name: str = "null_percent") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, {avg(f'count(*) FILTER (WHERE {c} IS NULL) * 100', 'count(*)', digits)} AS {name} FROM ({HOLES}) WHERE {where}" for c in NULL_COLUMNS)


@query("compare_null_rates", duck(f"SELECT column_name, null_percent_a, null_percent_b FROM ({_rates(name='null_percent_a')}) JOIN ({_rates('g = 1', name='null_percent_b')}) USING (column_name)"))
def _(s, d):
    a = derived(s, d, HOLES)
    return checks.compare_null_rates(a, a.where("g = 1"), list(NULL_COLUMNS))


@query("compare_value_counts", duck(f"SELECT kind AS value, count(*) AS n_a, count(*) FILTER (WHERE g = 1 AND coalesce(kind, 'x') <> 'error') AS n_b FROM ({HOLES}) GROUP BY 1"))
def _(s, d):
    a = derived(s, d, HOLES)
    return checks.compare_value_counts(a, a.where("g = 1 AND coalesce(kind, 'x') <> 'error'"), "kind")


@query("profile_nulls", duck(_rates(digits=1)))
def _(s, d):
    return checks.profile_nulls(derived(s, d, HOLES), list(NULL_COLUMNS))


@query("profile_duplicates", f"SELECT l_returnflag, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_keys, {avg('(count(*) - count(DISTINCT l_orderkey)) * 100', 'count(*)', 1)} AS surplus_percent FROM lineitem GROUP BY 1")
def _(s, d):
    return checks.profile_duplicates(table(s, d, "lineitem"), "l_returnflag", "l_orderkey").withColumn("n_rows", F.col("n_rows").cast("long"))


@query("duplicate_rate", "SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows, round(coalesce(sum(n) FILTER (WHERE n > 1), 0) / sum(n)::DOUBLE, 6) AS duplicate_rate FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def _(s, d):
    return checks.duplicate_rate(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("excess_duplicates", "SELECT count(*) - count(DISTINCT l_orderkey) AS excess FROM lineitem")
def _(s, d):
    return checks.excess_duplicates(table(s, d, "lineitem"), "l_orderkey")


SPEC = DatasetSpec("holes", (ColumnSpec("event_id", "int64", nullable=False, primary_key=True), ColumnSpec("kind", "string", max_null_rate=0.05, allowed_values=("click", "view")), ColumnSpec("v", "float64"), ColumnSpec("ts", "string"), ColumnSpec("absent", "string", nullable=False)), max_null_rate=0.5, max_duplicate_rate=0.0, min_row_count=10)
LIMITS = {"event_id": 0.5, "kind": 0.05, "v": 0.5, "ts": 0.5}


def _null_rate(c: str) -> str:
    return f"round(count(*) FILTER (WHERE {c} IS NULL) / count(*)::DOUBLE, 6)"


@query("null_rate_per_column", duck(" UNION ALL ".join(f"SELECT '{c}' AS column_name, {_null_rate(c)} AS null_rate, {x}::DOUBLE AS threshold, {_null_rate(c)} <= {x} AS passed FROM ({HOLES})" for c, x in LIMITS.items())))
def _(s, d):
    return checks.null_rate_report(derived(s, d, HOLES), SPEC)


@query("validate_report", duck(f"""SELECT 'row_count' AS check_name, NULL::VARCHAR AS column_name, count(*)::DOUBLE AS value, count(*) >= 10 AS passed FROM {{events}}
  UNION ALL SELECT 'required_column', 'absent', 0.0, false
  UNION ALL SELECT 'duplicate_rate', 'event_id', round(coalesce(sum(n) FILTER (WHERE n > 1), 0) / sum(n)::DOUBLE, 6), coalesce(sum(n) FILTER (WHERE n > 1), 0) = 0 FROM (SELECT count(*) AS n FROM {{events}} GROUP BY event_id)
  UNION ALL {" UNION ALL ".join(f"SELECT 'null_rate', '{c}', {_null_rate(c)}, {_null_rate(c)} <= {x} FROM ({HOLES})" for c, x in LIMITS.items())}
  UNION ALL SELECT * FROM (VALUES ('dtype', 'event_id', 1.0::DOUBLE, true), ('dtype', 'kind', 1.0::DOUBLE, true), ('dtype', 'v', 1.0::DOUBLE, true), ('dtype', 'ts', 0.0::DOUBLE, false))"""))
def _(s, d):
    return checks.validate_dataset(derived(s, d, HOLES), SPEC)


@query("allowed_values", duck(f"SELECT 'kind' AS column_name, kind AS value, count(*) AS n_records FROM ({HOLES}) WHERE kind NOT IN ('click', 'view') GROUP BY 2"))
def _(s, d):
    return checks.allowed_values(derived(s, d, HOLES), SPEC)


# drift: headers, kinds and names are those found in the rows of the given tables

#: Headers under which a table has a value, by counts over all its rows.
HEADERS = """SELECT '{n}' AS file, col FROM (UNPIVOT (SELECT count(COLUMNS(*)) AS "\\0" FROM {n}) ON COLUMNS(*) INTO NAME col VALUE n) WHERE n > 0"""
SIX = ("customer", "documents", "events", "labels", "orders", "supplier")


def _headers(names: tuple[str, ...]) -> str:
    return " UNION ALL ".join(HEADERS.replace("{n}", n) for n in names)


def _frames(s, d, names=SIX):
    return {n: table(s, d, n) for n in names}


@query("schema_drift", f"""WITH h AS ({_headers(SIX)}), f AS (SELECT DISTINCT file FROM h) SELECT col, string_agg(file, ',' ORDER BY file) FILTER (WHERE there) AS present_in, coalesce(string_agg(file, ',' ORDER BY file) FILTER (WHERE NOT there), '') AS missing_from, bool_and(there) AS in_all
  FROM (SELECT f.file, c.col, h.col IS NOT NULL AS there FROM f CROSS JOIN (SELECT DISTINCT col FROM h) c LEFT JOIN h ON h.file = f.file AND h.col = c.col) GROUP BY 1""")
def _(s, d):
    return drift.schema_drift(drift.filled_headers(_frames(s, d)))


VARIANTS = "SELECT CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE upper(replace(p_name, ' ', '_')) END AS v FROM {part}"


@query("name_variants", duck(f"SELECT lower(regexp_replace(v, '[^0-9A-Za-z]', '', 'g')) AS plain, count(DISTINCT v) AS n_variants, string_agg(DISTINCT v, '|' ORDER BY v) AS variants FROM ({VARIANTS}) GROUP BY 1 HAVING count(DISTINCT v) > 1"))
def _(s, d):
    return drift.name_variants(derived(s, d, VARIANTS), "v")


@query("drift_vs_baseline", f"""WITH h AS ({_headers(SIX)}), b AS (SELECT col FROM h WHERE file = 'documents'), r AS (SELECT * FROM h WHERE file <> 'documents')
  SELECT file, col, 'extra' AS status FROM r WHERE col NOT IN (SELECT col FROM b) UNION ALL SELECT f.file, b.col, 'missing' FROM (SELECT DISTINCT file FROM r) f CROSS JOIN b WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.file = f.file AND r.col = b.col)""")
def _(s, d):
    return drift.drift_vs_baseline(drift.filled_headers(_frames(s, d)), "documents")


LABEL_SPEC = DatasetSpec("labels", (ColumnSpec("doc_id", "int64"), ColumnSpec("grade", "int64"), ColumnSpec("lang"), ColumnSpec("_ingested_at", "datetime64")), {"quality": "grade"})


@query("drift_vs_spec", f"""WITH h AS ({_headers(('labels', 'documents'))}), m AS (SELECT file, col, CASE col WHEN 'quality' THEN 'grade' ELSE col END AS target FROM h), s AS (SELECT unnest(['doc_id', 'grade', 'lang']) AS target)
  SELECT file, col, 'extra' AS status FROM m WHERE target NOT IN (SELECT target FROM s) UNION ALL SELECT file, col, 'aliased' FROM m WHERE target <> col AND target IN (SELECT target FROM s)
  UNION ALL SELECT f.file, s.target, 'missing' FROM (SELECT DISTINCT file FROM h) f CROSS JOIN s WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.file = f.file AND m.target = s.target)""")
def _(s, d):
    return drift.drift_vs_spec(drift.filled_headers(_frames(s, d, ("labels", "documents"))), LABEL_SPEC)


KEYED_SPEC = DatasetSpec("keyed", (ColumnSpec("doc_id", "int64"), ColumnSpec("text"), ColumnSpec("absent")))
KEYED = ("benchmark", "documents", "embeddings", "labels")


@query("preflight", f"""WITH h AS ({_headers(KEYED)}), s AS (SELECT unnest(['doc_id', 'text', 'absent']) AS col), n AS (SELECT count(DISTINCT file) AS n_all FROM h),
  m AS (SELECT f.file, s.col FROM (SELECT DISTINCT file FROM h) f CROSS JOIN s WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.file = f.file AND h.col = s.col))
  SELECT col, 'extra' AS status, count(DISTINCT file) AS n_files, false AS blocks FROM h WHERE col NOT IN (SELECT col FROM s) GROUP BY 1
  UNION ALL SELECT col, 'missing', count(DISTINCT file), count(DISTINCT file) = any_value(n_all) FROM m CROSS JOIN n GROUP BY 1""")
def _(s, d):
    return drift.preflight_report(drift.filled_headers(_frames(s, d, KEYED)), KEYED_SPEC)


def _kinds(name: str, columns: tuple[str, ...]) -> str:
    """The kinds that DuckDB casts the values of a table's columns to."""
    fits = lambda c, t: f"count_if({c} IS NOT NULL AND try_cast({c}::VARCHAR AS {t}) IS NULL) = 0 AND count({c}) > 0"
    whole = lambda c: f"count_if({c} IS NOT NULL AND try_cast({c}::VARCHAR AS BIGINT) IS DISTINCT FROM try_cast({c}::VARCHAR AS DOUBLE)) = 0"  # noqa: E731  (a cast of 1.5 rounds)
    one = lambda c: f"SELECT '{c}' AS col, CASE WHEN {fits(c, 'BIGINT')} AND {whole(c)} THEN 'int64' WHEN {fits(c, 'DOUBLE')} THEN 'float64' WHEN {fits(c, 'TIMESTAMP')} THEN 'datetime64' WHEN {fits(c, 'BOOLEAN')} THEN 'bool' ELSE 'string' END AS type FROM {name}"
    return " UNION ALL ".join(map(one, columns))


@query("dtype_report", duck(f"""SELECT column_name, expected, type AS actual, expected = type AS passed FROM (VALUES ('event_id', 'int64'), ('kind', 'string'), ('v', 'float64'), ('ts', 'string')) AS x(column_name, expected)
  JOIN ({_kinds(f"({HOLES})", ("event_id", "kind", "v", "ts"))}) ON col = column_name"""))
def _(s, d):
    df = ingest.all_strings(derived(s, d, HOLES))
    return checks.dtype_report(df, SPEC, drift.kinds_in(df.select(*[c for c in SPEC.names if c in df.columns])))


@query("type_drift", f"""SELECT coalesce(a.col, b.col) AS col, CASE WHEN a.col IS NULL THEN 'extra' WHEN b.col IS NULL THEN 'missing' ELSE 'type_mismatch' END AS status
  FROM ({_kinds("labels", ("doc_id", "quality", "toxic"))}) a FULL JOIN ({_kinds("documents", ("doc_id", "text", "lang", "source", "n_chars"))}) b ON a.col = b.col WHERE a.type IS DISTINCT FROM b.type""")
def _(s, d):
    return drift.type_drift(drift.kinds_in(table(s, d, "labels")), drift.kinds_in(table(s, d, "documents")))


