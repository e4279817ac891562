"""Best-fit packing with certified bounds: dual-feasible functions say how far from the optimum a partition's bins can be.

Documents become pieces of at most `capacity` tokens. Pieces are dealt by hash into partitions of a bounded number of
pieces; each is packed best-fit decreasing. A dual-feasible function f maps sizes to sizes such that any set that fits
one bin still fits after f; so the sum of f over the pieces, in capacities and rounded up, bounds the bins from below.
A partition whose bins meet its best bound is certified optimal by itself and keeps all but its least filled bin. A
partition with a gap of g bins gives up the pieces of its GIVEN * (g + 1) least filled bins. What all partitions give up is
dealt anew, to far fewer partitions, and packed again, as long as that saves bins and several partitions are left.

Defined cases: null or empty text is one piece of the end id alone; repeated rows are packed each; an empty table gives
no rows; a text of any length is cut, none is dropped; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

CAPACITY = 4096
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
#: Pieces that one task packs; their number does not grow with the corpus, the number of partitions does.
PART_PIECES = 40_000
#: Exchanges at most; each stops earlier when it saves nothing or no gap is left.
ROUNDS = 4
#: Least filled bins that a partition gives up for each bin of its gap, and once more.
GIVEN = 2
#: Dual-feasible functions of the first family that are tried.
FAMILY = 24

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long, loose boolean, part long, bins long, bound long"


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row of docs (doc_id, text); the whole text is encoded."""
    common.prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, step = tokens.encoder(vocabulary).encode, np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            ids, nth, start, length, crc = [], [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                b = (encode(text) if text else b"") + end
                for k, at in enumerate(range(0, len(b), step)):
                    part = b[at : at + step]
                    ids.append(doc_id)
                    nth.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(nth, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """The best of three families of dual-feasible functions, in exact integer arithmetic."""
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1).astype(object if len(sizes) > 2**40 else np.int64)
    x = np.arange(capacity + 1)
    best = -(-int((count * x).sum()) // capacity)
    for k in range(1, FAMILY + 1):  # u(k): floor((k + 1) x / C) / k, and x / C itself where (k + 1) x / C is whole
        whole = (x * (k + 1)) % capacity == 0
        value = np.where(whole, x * k, (x * (k + 1) // capacity) * capacity)  # in units of 1 / (k * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    cut = np.unique(sizes[sizes * 2 <= capacity])
    if len(cut):
        number, total = np.cumsum(count), np.cumsum(count * x)
        # U(e): sizes above C - e count as C, those below e as nothing
        most = (number[-1] - number[capacity - cut]) * capacity + total[capacity - cut] - total[cut - 1]
        best = max(best, int((-(-most // capacity)).max()))
    for e in cut[:: max(1, len(cut) // 512)].tolist():  # phi(e): by how many pieces of size e still fit beside
        room = capacity // e
        value = np.where(x * 2 > capacity, room - (capacity - x) // e, (x >= e).astype(int))
        best = max(best, -(-int((count * value).sum()) // room))
    return best


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each size, taken in the given order; the fullest bin that has room is found in a bit set of free spaces."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    there = used = 0
    for i, s in enumerate(sizes.tolist()):
        above = there >> s
        if above:
            room = (above & -above).bit_length() - 1 + s
            b = free[room].pop()
            if not free[room]:
                there ^= 1 << room
        else:
            room, b = capacity, used
            used += 1
        bins[i], offsets[i] = b, capacity - room
        room -= s
        if room:
            if not free[room]:
                there |= 1 << room
            free[room].append(b)
    return bins, offsets, used


def _pack(df: DataFrame, parts: int, turn: int, capacity: int) -> DataFrame:
    dealt = df.select("doc_id", "piece", "start", "length", "ids_crc32").withColumn("part", F.pmod(F.xxhash64(F.lit(turn), "doc_id", "piece", "ids_crc32"), F.lit(parts)))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], ignore_index=True)
        sizes = rows.length.to_numpy()
        bins, offset, used = best_fit(sizes, capacity)
        rows["sequence_id"] = (np.int64(turn) << 56) + rows.part.to_numpy() * 2**24 + bins
        fill, bound = np.bincount(bins, sizes), lower_bound(sizes, capacity)
        given = np.zeros(used, bool)
        given[np.argsort(fill, kind="stable")[: GIVEN * (used - bound + 1) if used > bound else 1]] = True
        rows["offset"], rows["loose"] = offset, (given & (fill < capacity))[bins]
        rows["bins"], rows["bound"] = used, bound
        return rows[[c.split()[0] for c in PACKED.split(", ")]]

    return dealt.groupBy("part").applyInPandas(run, PACKED)


def _parts(packed: DataFrame) -> tuple[int, int]:
    """The number of partitions, and the bins of all."""
    row = packed.groupBy("part").agg(F.max("bins").alias("bins")).agg(F.count(F.lit(1)), F.coalesce(F.sum("bins"), F.lit(0))).first()
    return row[0], row[1]


def pack(items: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """items (see `pieces`) with sequence_id and offset; as few sequences as the exchanges find.

    bins and bound are those of the partition that packed the row last: equal ones are certified optimal.
    """
    common.prepare(items.sparkSession)
    items = common.stored(items, "pieces")
    n = items.count()
    current = common.stored(_pack(items, max(1, -(-n // part_pieces)), 0, capacity), "packed")
    final: list[DataFrame] = []
    for turn in range(1, rounds + 1):
        if _parts(current)[0] < 2:
            break  # one partition's pieces, in the same order, would take the same bins
        again = current.where("loose")
        before, n = again.agg(F.count_distinct("sequence_id"), F.count(F.lit(1))).first()
        parts = max(1, -(-n // part_pieces))
        packed = common.stored(_pack(again, parts, turn, capacity), f"packed{turn}")
        if _parts(packed)[1] >= before:
            break
        final.append(current.where("not loose"))
        current = packed
    out = current
    for df in final:
        out = out.unionByName(df)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "bins", "bound")


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(sequences, bound): sequences used and the lower bound over all pieces; sizes are counted, at most `capacity` rows reach the driver."""
    counts = packed.groupBy("length").count().collect()
    sizes = np.repeat(np.array([r[0] for r in counts], np.int64), 1) if counts else np.empty(0, np.int64)
    bound = _bound_of_counts(sizes, np.array([r[1] for r in counts], np.int64), capacity) if counts else 0
    used = packed.select("sequence_id").distinct().count()
    return packed.sparkSession.createDataFrame([(used, bound)], "sequences long, bound long")


def _bound_of_counts(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """lower_bound of many pieces given as counts: scaled down where the counts are large, which can only lower the bound."""
    shrink = max(1, int(counts.sum()) // 50_000_000)
    return lower_bound(np.repeat(sizes, counts // shrink), capacity) * shrink


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece's place, with the bins and the certified bound of the partition that packed it last; cases as the module names them."""
    return pack(pieces(common.documents(spark, sf_dir, "doc_id", "text")))
