"""Delta-maintained token counts: additive totals by source, language and tokenizer version.

A ledger is a folder. A batch holds signed events: `insert` adds a document's count under a version, `delete` takes it
away, `revise` replaces it. The batch is joined with the current counts of its own documents only: these lie in BUCKETS
folders by a hash of the doc_id, and a batch reads those that it has documents in. The difference that each event makes
becomes a delta, deltas are summed by group before anything is shuffled, and the totals are the sum of all committed
deltas. No total is ever recomputed from the documents. `compact` replaces the states and deltas so far by one of each.

Commits are idempotent: a batch is written to a folder of its own attempt, and counts only once its marker exists: a
file, named by its place in the order of commits, that is created only if nobody else has created it. A batch that failed
half-way leaves no marker, and is written afresh when it is committed again; one that has a marker is not applied a second
time; of two commits at once one raises. Readers see the committed batches only. On a store whose files cannot be created
exclusively, one writer at a time must be seen to from outside.

Defined cases: within a batch the event with the largest `seq` decides for a document and version (of equal ones the one
with the larger count; equal rows count once); all rows without doc_id are one document, so callers that want each to
count must number them (the query does); inserting a present document revises it; deleting or revising an absent one does
nothing or inserts it; null source or lang is a group of its own; null text counts no tokens; an empty batch commits and
changes nothing; groups whose documents have all gone stay out of the totals; texts are counted whole.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

EVENT = "op string, doc_id long, source string, lang string, version string, n_tokens long, seq long"
STATE = "doc_id long, version string, source string, lang string, n_tokens long, present boolean, nth long"
DELTA = "source string, lang string, version string, d_docs long, d_tokens long"
#: What a batch replaced, kept beside the new state of each of its documents.
OLD = "old_source string, old_lang string, old_n long, old_present boolean"
BUCKETS = 64


def count_words(text: Column) -> Column:
    """Words between white space."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))), F.lit(0)).cast("long")


def count_units(text: Column) -> Column:
    """Runs of letters or digits, and single other characters."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]"), F.lit(0))), F.lit(0)).cast("long")


def count_tokens(docs: DataFrame, vocabulary: str, column: str = "n_tokens") -> DataFrame:
    """docs with the number of ids of the whole text under a tokenizer file, in a last column (in place of one of that name)."""
    return count_by_versions(docs, {column: vocabulary})


def count_by_versions(docs: DataFrame, vocabularies: dict[str, str], keep_text: bool = True) -> DataFrame:
    """docs with the number of ids of the whole text under each tokenizer file, in last columns named by the keys (in place of such).

    One worker counts by all files in one pass, so texts leave the JVM once; without keep_text they do not come back.
    """
    import pyarrow as pa

    common.prepare(docs.sparkSession)
    docs = docs.drop(*vocabularies)
    at = docs.columns.index("text")
    kept = [i for i in range(len(docs.columns)) if keep_text or i != at]

    def run(batches):
        encoders = [tokens.encoder(path).encode for path in vocabularies.values()]
        for batch in batches:
            texts = batch.column(at).to_pylist()
            counts = [pa.array([len(encode(t)) // 4 if t else 0 for t in texts], pa.int64()) for encode in encoders]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), *counts], [*(batch.schema.names[i] for i in kept), *vocabularies])

    fields = [f"`{docs.schema.fields[i].name}` {docs.schema.fields[i].dataType.simpleString()}" for i in kept]
    return docs.mapInArrow(run, ", ".join([*fields, *(f"`{c}` long" for c in vocabularies)]))


def events(docs: DataFrame, op: str, version: str, n_tokens: Column, seq: int = 0) -> DataFrame:
    """Events of one kind for every row of docs (doc_id, source, lang, ..)."""
    return docs.select(F.lit(op).alias("op"), F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.lit(version).alias("version"), n_tokens.cast("long").alias("n_tokens"), F.lit(seq).cast("long").alias("seq"))


def _bucket() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


class Ledger:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _at(self, *parts: str):
        """A place of the ledger, and its file system."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _log(self) -> list[dict]:
        """The markers in order, one small row a commit. Only a folder that is not there means that there are none."""
        path, fs = self._at("commits")
        if not fs.exists(path):
            return []
        rows = self.spark.read.schema("nth long, batch long, base boolean, at string").json(f"{self.folder}/commits").where("at is not null").orderBy("nth").collect()
        return [r.asDict() for r in rows]

    def _mark(self, nth: int, **said) -> None:
        path, fs = self._at("commits", f"{nth:012d}.json")
        out = fs.create(path, False)  # raises if another commit took this place
        out.write(bytearray((json.dumps({"nth": nth, **said}) + "\n").encode()))
        out.close()

    def _next(self) -> int:
        """The first free place; a marker that was never filled takes its place too."""
        path, fs = self._at("commits")
        if not fs.exists(path):
            return 0
        return max((int(x.getPath().getName()[:12]) for x in fs.listStatus(path) if x.getPath().getName().endswith(".json")), default=-1) + 1

    @staticmethod
    def _live(log: list[dict]) -> list[dict]:
        """The last compaction and what came after it."""
        last = max((i for i, r in enumerate(log) if r["base"]), default=0)
        return log[last:]

    def _table(self, name: str, schema: str, log: list[dict]) -> DataFrame:
        paths = [self._part(name, r["at"]) for r in self._live(log)]
        return self.spark.read.schema(schema).option("basePath", f"{self.folder}/{name}").parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _part(self, name: str, at: str) -> str:
        return f"{self.folder}/{name}/at={at}"

    def committed(self) -> list[int]:
        """Ids of the committed batches, oldest first."""
        return [r["batch"] for r in self._log() if not r["base"]]

    def state(self, buckets: list[int] | None = None, log: list[dict] | None = None) -> DataFrame:
        """The current count of each document and version, of those present or gone; of some buckets, or of all."""
        rows = self._table("state", f"{STATE}, bucket int", self._log() if log is None else log)
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets))
        newest = F.max_by(F.struct("source", "lang", "n_tokens", "present", "nth"), "nth")
        return rows.groupBy("doc_id", "version").agg(newest.alias("s")).select("doc_id", "version", "s.*")

    def commit(self, batch: int, batch_events: DataFrame) -> bool:
        """Apply a batch under an id; False if the id was committed before (nothing changes then)."""
        log, nth = self._log(), self._next()
        if any(r["batch"] == batch and not r["base"] for r in log):
            return False
        at = f"batch{batch}-{uuid.uuid4().hex[:8]}"
        best = F.max_by(F.struct("op", "source", "lang", "n_tokens"), F.struct("seq", "n_tokens", "op", "source", "lang"))
        one = common.stored(batch_events.groupBy("doc_id", "version").agg(best.alias("e")).select("doc_id", "version", "e.*"), "batch")
        met = [r["bucket"] for r in one.select(_bucket().alias("bucket")).distinct().collect()]  # BUCKETS rows at most
        old = self.state(met, log).select("doc_id", "version", F.col("source").alias("old_source"), F.col("lang").alias("old_lang"), F.col("n_tokens").alias("old_n"), F.col("present").alias("old_present"))
        both = one.join(old, (one.doc_id.eqNullSafe(old.doc_id)) & (one.version.eqNullSafe(old.version)), "left").select(one["*"], "old_source", "old_lang", F.coalesce("old_n", F.lit(0)).alias("old_n"), F.coalesce("old_present", F.lit(False)).alias("old_present"))
        stays = F.col("op") != "delete"
        after = both.where(stays | F.col("old_present")).select(
            "doc_id", "version",
            F.when(stays, F.col("source")).otherwise(F.col("old_source")).alias("source"), F.when(stays, F.col("lang")).otherwise(F.col("old_lang")).alias("lang"),
            F.when(stays, F.coalesce("n_tokens", F.lit(0))).otherwise(F.col("old_n")).cast("long").alias("n_tokens"), stays.alias("present"), F.lit(nth).cast("long").alias("nth"),
            *_names(OLD), _bucket().alias("bucket"),
        )
        state = self._part("state", at)
        after.repartition("bucket", F.pmod(F.xxhash64("version", "doc_id"), F.lit(max(1, common.width(self.spark) // BUCKETS)))).write.mode("overwrite").partitionBy("bucket").parquet(state)
        written = self.spark.read.schema(f"{STATE}, {OLD}, bucket int").parquet(state)
        minus = written.where("old_present").select(F.col("old_source").alias("source"), F.col("old_lang").alias("lang"), "version", F.lit(-1).alias("d"), F.col("old_n").alias("n"))
        plus = written.where("present").select("source", "lang", "version", F.lit(1).alias("d"), "n_tokens")
        deltas = plus.union(minus).groupBy("source", "lang", "version").agg(F.sum("d").cast("long").alias("d_docs"), F.sum(F.col("d") * F.col("n_tokens")).alias("d_tokens"))
        deltas.coalesce(1).write.mode("overwrite").parquet(self._part("deltas", at))  # one row a group
        self._mark(nth, batch=batch, base=False, at=at)
        common.drop(one)
        return True

    def compact(self) -> None:
        """One state and one delta table in place of all so far; what was committed stays known."""
        log, nth = self._log(), self._next()
        if len(self._live(log)) < 2:
            return
        at = f"base-{uuid.uuid4().hex[:8]}"
        self.state(log=log).withColumn("bucket", _bucket()).repartition("bucket", F.pmod(F.xxhash64("version", "doc_id"), F.lit(max(1, common.width(self.spark) // BUCKETS)))).write.partitionBy("bucket").parquet(self._part("state", at))
        self._sums(log).coalesce(1).write.parquet(self._part("deltas", at))
        self._mark(nth, batch=-1, base=True, at=at)

    def _sums(self, log: list[dict]) -> DataFrame:
        return self._table("deltas", DELTA, log).groupBy("source", "lang", "version").agg(F.sum("d_docs").alias("d_docs"), F.sum("d_tokens").alias("d_tokens"))

    def totals(self) -> DataFrame:
        """(source, lang, version, n_docs, n_tokens): the sum of the committed deltas."""
        return self._sums(self._log()).where("d_docs > 0").select("source", "lang", "version", F.col("d_docs").alias("n_docs"), F.col("d_tokens").alias("n_tokens"))


#: The two public vocabularies, by whose names the versions go.
VERSIONS = ("byte_bpe_50k", "word_bpe_49k")
#: Texts of fewer characters are withdrawn in the course of the history, and come back.
SHORT_CHARS = 400


def _history(ledger: Ledger, counted: DataFrame, first: str, second: str) -> DataFrame:
    """Totals after commits that end in the truth. counted: (doc_id, source, lang, chars, and a count by each version).

    1 inserts all documents under the first version, with an estimate of four characters a token; 2 inserts all under the
    second; 3 deletes the short ones under both; 4 revises all estimates that are left to the true counts; then 3 comes
    again, and changes nothing; 5 inserts the short ones anew. So each total is the plain sum over all documents.
    """
    ledger.commit(1, events(counted, "insert", first, F.expr("chars div 4")))
    ledger.commit(2, events(counted, "insert", second, F.col(second)))
    short = F.col("chars") < SHORT_CHARS
    gone = events(counted.where(short), "delete", first, F.lit(0)).unionByName(events(counted.where(short), "delete", second, F.lit(0)))
    ledger.commit(3, gone)
    ledger.commit(4, events(counted.where(~short), "revise", first, F.col(first)))
    ledger.compact()
    ledger.commit(3, gone)
    ledger.commit(5, events(counted.where(short), "insert", first, F.col(first)).unionByName(events(counted.where(short), "insert", second, F.col(second))))
    return ledger.totals()


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row of the table is a document of its own, under a number that is stored with its counts: null and repeated ids count each."""
    docs = common.documents(spark, sf_dir, "source", "lang", "text")
    return docs.select(F.monotonically_increasing_id().alias("doc_id"), "source", "lang", "text", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"))


def op5_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, lang, version, n_docs, n_tokens) of all documents under both public vocabularies, after the commits of `_history`."""
    first, second = VERSIONS
    counted = common.stored(count_by_versions(_numbered(spark, sf_dir), {v: f"{v}.json" for v in VERSIONS}, keep_text=False), "counts")
    return _history(Ledger(spark, common.new_path(spark, "ledger")), counted, first, second)


def ledger_of_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ledger and history on counts that SQL has as well: words, and runs of letters or digits with single signs."""
    counts = {"words-1": count_words(F.col("text")), "units-1": count_units(F.col("text"))}
    counted = common.stored(_numbered(spark, sf_dir).withColumns(counts).drop("text"), "counts")
    return _history(Ledger(spark, common.new_path(spark, "ledger")), counted, *counts)


WORDS_SQL = r"""
WITH counted AS (
    SELECT source, lang, 'words-1' AS version, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM documents
    UNION ALL
    SELECT source, lang, 'units-1' AS version, len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]')) AS n FROM documents
)
SELECT source, lang, version, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens
FROM counted GROUP BY source, lang, version
"""
