"""Hard negatives by an inverted multi-index: exact nearest rows of one label, and near rows of other labels below a share of their score.

Vectors are cut in two halves, each with a codebook; a cell holds the rows of one pair of entries. An entry's radius is the largest
distance of a row's half from it, over all rows. By it, no row of a cell can score more than the sum of two half-scores: the
products of the anchor's halves with the entries, plus their lengths times the radii. A heap takes the cells in the order of
that sum, the multi-sequence way. A search looks into its first cells, which gives a score that the last of its results
reaches at least, then into every further cell whose bound reaches that score, so the result is exact.

Spark deals the work: small cells share a shelf, a large cell spans several, and anchors meet the shelves that they ask for in groups of
bounded size on both sides. Inside a shelf, cells are taken in the same order and left once no better row can follow.

Defined cases: rows without vec_id, label or vector, or with a null or non-finite component, take no part; shorter vectors end in zeros; a
repeated vec_id is a row of its own, and an anchor if divisible; scores beyond 64 bits are an error; further columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Documented bounds of the codebooks: they are fitted on so many rows at most; a cell has about CELL_ROWS rows while entries suffice.
FIT_ROWS, CELL_ROWS, ENTRIES, ROUNDS = 4096, 2048, 512, 10
#: Rows of a shelf and anchors of a group, about.
SHELF_ROWS, GROUP_ANCHORS = 8192, 4096
#: Rows in the cells that a search looks into first.
PROBE_ROWS = 4096
#: No score.
FAR = 1 << 62
FOUND = "anchor long, k int, vec_id long, score long"


@dataclass(frozen=True)
class Codebooks:
    """entries and radii of both halves, rows of each cell, first shelf and number of shelves of each cell; all bounded by ENTRIES."""

    split: int
    entries: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    rows: np.ndarray
    shelf: np.ndarray
    spans: np.ndarray

    def walk(self, q: np.ndarray) -> Iterator[tuple[float, float, int]]:
        """(upper bound, lower bound, cell) of the cells that have rows, by falling upper bound: a heap over two sorted lists."""
        halves = []
        for part, entries, radii in zip((q[: self.split], q[self.split :]), self.entries, self.radii, strict=True):
            middle, reach = entries @ part, np.linalg.norm(part) * radii
            order = np.argsort(-(middle + reach), kind="stable")
            halves.append((order.tolist(), (middle + reach)[order].tolist(), (middle - reach)[order].tolist()))
        (one, up1, low1), (two, up2, low2) = halves
        heap, width = [(-(up1[0] + up2[0]), 0, 0)], len(two)
        while heap:
            bound, i, j = heapq.heappop(heap)
            if self.rows[one[i], two[j]]:
                slack = 1 + 1e-9 * abs(bound)
                yield slack - bound, low1[i] + low2[j] - slack, one[i] * width + two[j]
            if j + 1 < width:
                heapq.heappush(heap, (-(up1[i] + up2[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(one):
                heapq.heappush(heap, (-(up1[i + 1] + up2[0]), i + 1, 0))

    def visits(self, q: np.ndarray, lows: list[int], highs: list[int], raised: list[int] | None) -> list[tuple[float, int]]:
        """(bound, cell) to look into for rows whose score is in one of the windows: the first cells, or with raised windows all others that count."""
        out, seen = [], 0
        for bound, least, cell in self.walk(q):
            if bound < min(lows):
                break
            if not any(bound >= a and least <= b for a, b in zip(lows, highs, strict=True)):
                continue
            first = seen < PROBE_ROWS
            seen += int(self.rows.flat[cell])
            if raised is None:
                if not first:
                    break
                out.append((bound, cell))
            elif bound < min(raised):
                break
            elif not first and any(bound >= a and least <= b for a, b in zip(raised, highs, strict=True)):
                out.append((bound, cell))
        return out


def vectors(embeddings: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, label, vec) of the rows that take part: components are scaled and rounded down."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & ~bad)
    return rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vec"))


def _means(x: np.ndarray, k: int) -> np.ndarray:
    """k means of rows, at most as many as there are distinct rows."""
    x = np.unique(x, axis=0)
    k = min(k, len(x))
    means = x[np.random.default_rng(0).choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        near = nearest(x, means)[0]
        n = np.bincount(near, minlength=k)
        total = np.zeros_like(means)
        np.add.at(total, near, x)
        means = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], means)
    return means


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row, and its distance."""
    near = ((entries * entries).sum(1)[None] - 2 * (x @ entries.T)).argmin(1)
    return near, np.linalg.norm(x - entries[near], axis=1)


def index(rows: DataFrame) -> tuple[DataFrame, Codebooks] | None:
    """Every row (vec_id, label, vec) with its cell and shelf, stored, and the codebooks; None if there are no rows."""
    spark = common.prepare(rows.sparkSession)
    n, dims = rows.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    if not n:
        return None

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column(3).to_pylist():
                x = np.zeros(dims, np.int64)
                x[: len(v)] = v
                out.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary())], ["rid", "vec_id", "label", "vec"])

    packed = common.stored(rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", "vec").mapInArrow(pack, "rid long, vec_id long, label long, vec binary"), "vectors")
    sample = np.array([np.frombuffer(r["vec"], np.int64) for r in common.smallest(packed.select("vec", "rid"), F.xxhash64("rid"), FIT_ROWS).collect()], float).reshape(-1, dims)
    k, split = int(np.clip(np.ceil(np.sqrt(n / CELL_ROWS)), 2, ENTRIES)), dims // 2
    entries = _means(sample[:, :split], k), _means(sample[:, split:], k)
    shared = spark.sparkContext.broadcast(entries)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.int64).reshape(batch.num_rows, dims).astype(float)
            (a, da), (b, db) = (nearest(h, e) for h, e in zip((x[:, :split], x[:, split:]), shared.value, strict=True))
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c) for c in (a.astype(np.int32), b.astype(np.int32), da, db)]], [*batch.schema.names, "one", "two", "d1", "d2"])

    cells = common.stored(packed.mapInArrow(assign, "rid long, vec_id long, label long, vec binary, one int, two int, d1 double, d2 double"), "cells")
    common.drop(packed)
    count, radii = np.zeros((len(entries[0]), len(entries[1])), np.int64), tuple(np.zeros(len(e)) for e in entries)
    for r in cells.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n"), F.max("d1").alias("d1"), F.max("d2").alias("d2")).toLocalIterator():  # ENTRIES squared at most
        count[r["one"], r["two"]] = r["n"]
        radii[0][r["one"]] = max(radii[0][r["one"]], r["d1"])
        radii[1][r["two"]] = max(radii[1][r["two"]], r["d2"])
    spans = np.maximum(1, -(-count // SHELF_ROWS))
    shelf, at, held = np.zeros_like(count), 0, 0
    for cell in np.flatnonzero(count).tolist():
        rows_of, span = int(count.flat[cell]), int(spans.flat[cell])
        if held and (span > 1 or held + rows_of > SHELF_ROWS):
            at, held = at + 1, 0
        shelf.flat[cell] = at
        if span > 1:
            at += span
        else:
            held += rows_of
    book = Codebooks(split, entries, radii, count, shelf, spans)
    where = spark.createDataFrame([(int(i), int(j), int(shelf[i, j]), int(spans[i, j])) for i, j in zip(*np.nonzero(count), strict=True)], "one int, two int, first long, spans long")
    located = cells.join(F.broadcast(where), ["one", "two"])
    cell = (F.col("one") * len(entries[1]) + F.col("two")).cast("long")
    return located.select("rid", "vec_id", "label", "vec", cell.alias("cell"), (F.col("first") + F.pmod(F.xxhash64("rid"), "spans")).alias("shelf")), book


def _scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer products: in floating point while no sum can lose a digit."""
    if float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, len(q)) < 2**53:
        return (x.astype(float) @ q.astype(float)).astype(np.int64)
    return np.array((x.astype(object) @ q.astype(object)).tolist(), np.int64)


def _look(cells: dict[int, tuple], anchor: int, label: int, q: np.ndarray, order: list[int], bounds: list[float], lows: list[int], highs: list[int], same: bool, n: int) -> list[tuple[int, int, int]]:
    """(window, vec_id, score): the n best of each window in the cells given, which are left once no better row can follow."""
    best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(lows)
    for cell, bound in zip(order, bounds, strict=True):
        if all(len(s) == n and s[-1] > bound for _, s in best):
            break
        if cell not in cells:
            continue
        rids, ids, labels, x = cells[cell]
        score = _scores(x, q)
        fit = ((labels == label) == same) & (rids != anchor)
        for k, (low, high) in enumerate(zip(lows, highs, strict=True)):
            inside = np.flatnonzero(fit & (score >= low) & (score <= high))
            if len(inside):
                i, s = np.concatenate((best[k][0], ids[inside])), np.concatenate((best[k][1], score[inside]))
                top = np.lexsort((i, -s))[:n]
                best[k] = i[top], s[top]
    return [(k, *x) for k, (i, s) in enumerate(best) for x in zip(i.tolist(), s.tolist(), strict=True)]


def _visit(indexed: DataFrame, book: Codebooks, requests: DataFrame, same: bool, n: int) -> DataFrame:
    """FOUND: what each group of anchors finds in each shelf. requests: (rid, label, vec, lows, highs, raised), raised NULL on the first look."""
    spark = indexed.sparkSession
    shared = spark.sparkContext.broadcast(book)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = shared.value
        for batch in batches:
            out = []
            for rid, label, vec, lows, highs, raised in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                shelves: dict[int, tuple[list[int], list[float]]] = {}
                for bound, cell in b.visits(np.frombuffer(vec, np.int64).astype(float), lows, highs, raised):
                    for s in range(int(b.shelf.flat[cell]), int(b.shelf.flat[cell] + b.spans.flat[cell])):
                        order, bounds = shelves.setdefault(s, ([], []))
                        order.append(cell)
                        bounds.append(bound)
                out += [(s, rid, label, vec, raised or lows, highs, *x) for s, x in shelves.items()]
            names = ["shelf", "rid", "label", "vec", "lows", "highs", "cells", "bounds"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out, strict=True)) or [()] * len(names), kinds, strict=True)], names)

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            rids, ids, labels, at = (left.column(c).to_numpy() for c in ("rid", "vec_id", "label", "cell"))
            x = np.frombuffer(b"".join(left.column("vec").to_pylist()), np.int64).reshape(len(rids), -1)
            cells = {int(c): (rids[m], ids[m], labels[m], x[m]) for c in np.unique(at) for m in [np.flatnonzero(at == c)]}
            for rid, label, vec, *rest in zip(*[right.column(c).to_pylist() for c in ("rid", "label", "vec", "cells", "bounds", "lows", "highs")], strict=True):
                found += [(rid, *f) for f in _look(cells, rid, label, np.frombuffer(vec, np.int64), *rest, same, n)]
        columns = list(zip(*found, strict=True)) or [()] * 4
        return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["anchor", "k", "vec_id", "score"])

    asked = requests.select("rid", "label", "vec", "lows", "highs", "raised").mapInArrow(route, "shelf long, rid long, label long, vec binary, lows array<long>, highs array<long>, cells array<long>, bounds array<double>")
    groups = asked.groupBy("shelf").agg(F.ceil(F.count(F.lit(1)) / GROUP_ANCHORS).cast("int").alias("groups"))
    left = indexed.join(groups, "shelf").withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")
    right = asked.join(groups, "shelf").withColumn("group", F.pmod(F.xxhash64("rid"), "groups").cast("int")).drop("groups")
    return left.groupBy("shelf", "group").cogroup(right.groupBy("shelf", "group")).applyInArrow(look, FOUND)


def _best(found: DataFrame, n: int) -> DataFrame:
    from pyspark.sql import Window as W

    return found.withColumn("rank", F.row_number().over(W.partitionBy("anchor", "k").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= n)


def search(indexed: DataFrame, book: Codebooks, requests: DataFrame, same: bool, n: int) -> DataFrame:
    """(anchor, k, vec_id, score, rank): of each request (rid, label, vec, lows, highs) the n best rows in each window k, of its label or of others."""
    first = common.stored(_best(_visit(indexed, book, requests.withColumn("raised", F.lit(None).cast("array<long>")), same, n), n), "probe")
    reached = first.where(F.col("rank") == n).groupBy(F.col("anchor").alias("rid")).agg(F.map_from_entries(F.collect_list(F.struct("k", "score"))).alias("reached"))  # one entry a window
    raised = F.transform("lows", lambda low, k: F.greatest(low, F.coalesce(F.col("reached")[k], low)))
    more = requests.join(reached, "rid", "left").withColumn("raised", raised)
    out = common.stored(_best(first.drop("rank").unionByName(_visit(indexed, book, more, same, n)), n), "best")
    common.drop(first)
    return out


def _tenths(c: Column) -> Column:
    """A whole number of tenths, rounded down to a whole number."""
    return ((c - F.pmod(c, F.lit(10))) / 10).cast("long")


def mine(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 3, high: int = 9) -> DataFrame:
    """Hard negatives of the anchors, the rows (vec_id, label, vec) whose vec_id is divisible by `every`.

    Of each anchor's best other rows of its label, and for each of those, the best rows of other labels whose score is from
    low to high tenths of its own. Scores are integer products; ties go to the smaller vec_id.
    """
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    made = index(rows)
    if made is None:
        return spark.createDataFrame([], schema)
    indexed, book = made
    anchors = common.stored(indexed.where(F.pmod("vec_id", F.lit(every)) == 0).select("rid", F.col("vec_id").alias("anchor_id"), "label", "vec"), "anchors")
    whole = anchors.withColumns({"lows": F.array(F.lit(-FAR)), "highs": F.array(F.lit(FAR))})
    good = search(indexed, book, whole, True, positives).select("anchor", (F.col("rank") - 1).alias("k"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    windows = good.groupBy(F.col("anchor").alias("rid")).agg(F.array_sort(F.collect_list(F.struct("k", "positive_score"))).alias("p"))  # `positives` entries
    lows = F.transform("p", lambda x: -_tenths(-(x["positive_score"] * low)))
    highs = F.transform("p", lambda x: _tenths(x["positive_score"] * high))
    bad = search(indexed, book, anchors.join(windows, "rid").withColumns({"lows": lows, "highs": highs}), False, negatives)
    named = good.join(anchors.select(F.col("rid").alias("anchor"), "anchor_id"), "anchor")
    out = bad.join(named, ["anchor", "k"])
    return out.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op13_multi_index_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor of embeddings, over all rows; the cases that the module names hold."""
    rows = vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", shifted))


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other_id, list_dot_product(a.q, b.q)::BIGINT AS score FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
