"""Removal of repeated 100-byte strings by suffix sorting with bucket-pointer refinement.

A byte goes when a WINDOW-byte string that covers it also starts earlier: in a smaller doc_id, or earlier in the same
document. All strings are judged on the input.

Spark spreads the suffixes so that equal windows meet. Every window has an anchor, its leftmost q-gram (GRAM bytes) of
least hash, which depends on the window's bytes alone; consecutive windows mostly share it. An anchor is an initial
q-gram bucket: a window can repeat only where its anchor's hash repeats, so

1. exact copies of a text leave first, by hash (all their bytes go where the text has WINDOW bytes or more);
2. the hashes of anchors are counted over all documents, and single ones leave;
3. the stretches of text under repeated anchors are sent by hash, and each task sorts the suffixes of its stretches:
   buckets of the first q bytes are refined by sorting on the bucket numbers of later offsets, q -> 2q -> 4q ..., where
   each pass reads the bucket numbers that the pass before it wrote, until WINDOW bytes are told apart;
4. in each final bucket all windows but the earliest are repeats; their bytes go.

A bucket that is hot (a passage that very many documents share) is dealt to several tasks first, each of which passes
on only the windows that are earliest among its own. These meet by their own bytes (two 64-bit hashes), not by anchor: so
texts that share the passage but differ around it spread over tasks, and one window meets at most once a deal.

Defined cases: null text is empty; a text of fewer than WINDOW bytes loses nothing; rows that share a doc_id are read
in the order of their text, as separate documents; repeated rows are copies of the first; rows without doc_id come after
all others; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, textops

WINDOW = 100
GRAM = 20
#: First bucket width of the suffix sort; doubled by each refinement.
FIRST = 25
#: Values that stand for the bytes in a window's second hash.
SECOND = textops.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(textops.STEP))
#: Windows of a text that are looked at together.
SEGMENT = 4 << 20
#: Places of one gram that are closer than this have one stretch.
TOGETHER = 40
#: Bytes of the stretches of one Arrow batch, about.
BATCH_BYTES = 8 << 20
#: Anchors of one hash beyond which it is dealt to several tasks first, so many to each.
HOT = 5_000
#: Hot hashes, of 12 bytes each, that are sent to all tasks at most.
HOT_ROWS = 500_000


def _anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a text of at least WINDOW bytes: the anchors' hashes, the first and last window start of each, and whether its windows may repeat among themselves.

    A window's anchor depends on its own bytes, so long texts are taken in segments, which bounds what the arrays take.
    """
    windows = len(data) - WINDOW + 1
    parts = []
    for a in range(0, windows, SEGMENT):
        h, first, last, several = _segment(data[a : min(a + SEGMENT, windows) + WINDOW - 1])
        parts.append((h, first + a, last + a, several))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if len(parts) > 1 else parts[0]


def _segment(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The window from o on has as anchor the leftmost least hash among the grams at o .. o + WINDOW - GRAM."""
    h = textops.window_hashes(data, GRAM)
    reach = WINDOW - GRAM + 1
    n = len(h) - reach + 1
    best, span = h, 1
    while span < reach:  # best[o] becomes the least of h[o : o + span]
        step = min(span, reach - span)
        best = np.minimum(best[:-step], best[step:])
        span += step
    first = np.flatnonzero(np.concatenate(([True], best[1:] != best[:-1])))
    at = first + h[first[:, None] + np.arange(reach)].argmin(1)
    last = np.append(first[1:] - 1, n - 1)
    more = at < last  # equal grams: the least stays while its place moves on
    if not more.any():
        return h[at], first, last, more
    starts, ends, several = _with_equals(h, best, first[more], last[more])
    first, last, several = np.concatenate((first[~more], starts)), np.concatenate((last[~more], ends)), np.concatenate((np.zeros(int((~more).sum()), bool), several))
    order = np.argsort(first)
    return best[first[order]], first[order], last[order], several[order]


def _with_equals(h: np.ndarray, best: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where stretches of windows start and end whose least gram occurs more than once: at its places, of which those closer than TOGETHER share one;
    and which of them have several.

    A run of one character has a place at every byte; so it takes a stretch for every TOGETHER windows, not for each.
    """
    starts: list[int] = []
    ends: list[int] = []
    several: list[bool] = []
    reach = WINDOW - GRAM + 1
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        same = a + np.flatnonzero(h[a : b + reach] == best[a])
        o = a
        while o <= b:
            i, j = np.searchsorted(same, (o, o + TOGETHER), ("left"))
            p = int(same[max(i, j - 1)])
            several.append(j - 1 > i)
            starts.append(o)
            ends.append(min(p, b))
            o = ends[-1] + 1
    return np.array(starts, np.int64), np.array(ends, np.int64), np.array(several, bool)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("bytes"))


def _emit_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, counts, hashes, number, weight = batch.column(0), [], [], [], []
        for b in batch.column(1).to_pylist():
            if len(b) < WINDOW:
                counts.append(0)
                continue
            h, _, _, several = _anchors(np.frombuffer(b, np.uint8))
            counts.append(len(h))
            weight.append(1 + several.astype(np.int32))
            hashes.append(h.view(np.int64))
            number.append(np.arange(len(h), dtype=np.int32))
        row = np.repeat(np.arange(batch.num_rows), counts)
        yield pa.RecordBatch.from_arrays([keys.take(pa.array(row)), pa.array(np.concatenate(hashes) if hashes else np.empty(0, np.int64)), *[pa.array(np.concatenate(x) if x else np.empty(0, np.int32), pa.int32()) for x in (number, weight)]], ["rank", "hash", "number", "weight"])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rank, bytes, anchors: number and deal of each) to one row for each anchor: where its windows start, and their bytes.

    The anchors of one document under one hash spread over its deals too.
    """
    for batch in batches:
        lists = batch.column(2)
        numbers, deals_of = (lists.flatten().field(i).to_numpy() for i in (0, 1))
        ends = np.cumsum(lists.value_lengths().to_numpy())
        for rank, b, i, j in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True):
            h, first, last, several = _anchors(np.frombuffer(b, np.uint8))
            which, deals = numbers[i:j], deals_of[i:j]
            spread = (textops.mix(np.uint64(rank % 2**64) + which.astype(np.uint64) * np.uint64(textops.STEP)) >> np.uint64(33)).astype(np.int64)
            deal, size = np.where(deals > 1, spread % deals, -1), np.cumsum(last[which] - first[which] + WINDOW)
            for m in np.split(np.arange(len(which)), np.searchsorted(size, np.arange(BATCH_BYTES, int(size[-1]) if len(size) else 0, BATCH_BYTES))):
                w = which[m]
                cut = [b[x : y + WINDOW] for x, y in zip(first[w].tolist(), last[w].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(h[w].view(np.int64)), pa.array(deal[m].astype(np.int64)), pa.array(np.full(len(w), rank)), pa.array(first[w]), pa.array(cut, pa.binary()), pa.array(several[w])], ["hash", "deal", "rank", "start", "bytes", "several"])


def refine(data: np.ndarray, starts: np.ndarray, window: int = WINDOW, first: int = FIRST) -> np.ndarray:
    """Bucket numbers of the window-byte strings at the given starts: equal numbers for equal strings.

    Bucket-pointer refinement: suffixes are bucketed by their first q bytes; then the pair of a suffix's bucket and the
    bucket q bytes on is sorted within the buckets, which gives the buckets of 2q bytes, and so on. Suffixes alone in
    their bucket are told apart already and are not sorted again.
    """
    grams = textops.window_hashes(data, first)
    need = [window]  # widths from the last back to the first
    while need[-1] > first:
        need.append(max(first, -(-need[-1] // 2)))
    need.reverse()
    # which suffixes each width must bucket: those at the starts, and those that a wider bucket will look up
    wanted = [np.unique(starts)]
    for wide, narrow in zip(need[::-1][:-1], need[::-1][1:], strict=True):
        wanted.append(np.unique(np.concatenate((wanted[-1], wanted[-1] + (wide - narrow)))))
    wanted.reverse()
    bucket = np.zeros(len(data), np.int64)
    _, number = np.unique(grams[wanted[0]], return_inverse=True)
    bucket[wanted[0]] = number
    for narrow, wide, places in zip(need[:-1], need[1:], wanted[1:], strict=True):
        own, later = bucket[places], bucket[places + (wide - narrow)]
        alone = np.bincount(own)[own] == 1
        fresh = np.empty(len(places), np.int64)
        fresh[alone] = np.arange(int(alone.sum()))
        pair = own[~alone] * (int(bucket.max()) + 1) + later[~alone]
        _, number = np.unique(pair, return_inverse=True)
        fresh[~alone] = number + int(alone.sum())
        bucket[places] = fresh
    return bucket[starts]


def _judge(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of rows (hash, rank, start, bytes, several): repeated bytes as (rank, first byte, end byte); rows of which each window is the
    earliest, and the earliest windows of other rows as (row, place in it).

    Of equal stretches only the earliest can hold an earliest window: the others are repeats from end to end. The
    earliest ones of a bucket are told apart window by window, if there are several, or if the windows of one may repeat among themselves.
    """
    rank, start, keys = (table.column(c).to_numpy() for c in ("rank", "start", "hash"))
    pieces = table.column("bytes").to_pylist()
    order = np.lexsort((start, rank))
    seen: dict[bytes, int] = {}
    for i in order.tolist():
        seen.setdefault(pieces[i], i)
    lead = np.sort(np.fromiter(seen.values(), np.int64, len(seen)))
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    copy = np.ones(len(pieces), bool)
    copy[lead] = False
    copy = np.flatnonzero(copy)
    spans = [(rank[copy], start[copy], start[copy] + size[copy])]
    _, bucket, members = np.unique(keys[lead], return_inverse=True, return_counts=True)
    apart = (members[bucket] > 1) | table.column("several").to_numpy()[lead]
    several = lead[apart]
    early = (np.empty(0, np.int64), np.empty(0, np.int64))
    if len(several):
        data = np.frombuffer(b"".join([pieces[i] for i in several.tolist()]), np.uint8)
        count = size[several] - WINDOW + 1
        base = np.cumsum(size[several]) - size[several]
        row = np.repeat(np.arange(len(several)), count)
        within = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        number = refine(data, base[row] + within)
        place, of = start[several][row] + within, rank[several][row]
        order = np.lexsort((place, of, number))
        ordered = number[order]
        repeat = np.ones(len(order), bool)
        repeat[order[np.concatenate(([True], ordered[1:] != ordered[:-1]))]] = False
        spans.append(_runs_of(of[repeat], place[repeat]))
        early = several[row[~repeat]], within[~repeat]
    r, a, b = (np.concatenate(x) for x in zip(*spans, strict=True))
    return r, a, b, lead[~apart], *early


def _windows(table: pa.Table, whole: np.ndarray, row: np.ndarray, within: np.ndarray) -> pa.RecordBatch:
    """(rank, start, w, v) of all windows of whole rows and of the windows at the given places; w and v are hashes of the window."""
    used = np.unique(np.concatenate((whole, row)))
    t = table.take(pa.array(used))
    pieces = t.column("bytes").to_pylist()
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    count = np.where(np.isin(used, whole), size - WINDOW + 1, 0)
    every = np.repeat(np.arange(len(used)), count)
    of = np.concatenate((every, np.searchsorted(used, row)))
    within = np.concatenate((np.arange(len(every)) - np.repeat(np.cumsum(count) - count, count), within))
    data = np.frombuffer(b"".join(pieces), np.uint8)
    at = (np.cumsum(size) - size)[of] + within
    w, v = (textops.window_hashes(x, WINDOW)[at].view(np.int64) for x in (data, SECOND[data]))
    rank, start = (t.column(c).to_numpy()[of] for c in ("rank", "start"))
    return pa.RecordBatch.from_arrays([pa.array(rank), pa.array(start + within), pa.array(w), pa.array(v)], ["rank", "start", "w", "v"])


def _runs_of(of: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repeated windows, as (rank, first byte, end byte) of runs of consecutive starts."""
    if not len(of):
        return of, place, place
    order = np.lexsort((place, of))
    of, place = of[order], place[order]
    new = np.concatenate(([True], (of[1:] != of[:-1]) | (place[1:] != place[:-1] + 1)))
    i = np.flatnonzero(new)
    return of[i], place[i], place[np.append(i[1:] - 1, len(place) - 1)] + WINDOW


#: Stretches are sorted together up to about so many bytes; a bucket is never cut, and a hot one was dealt out before.
SORT_BYTES = 3 << 20


def _chunks(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Rows sorted by the keys, in tables of whole buckets of about SORT_BYTES."""
    held: list[pa.RecordBatch] = []
    size, most = 0, SORT_BYTES
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size > most:
            t = pa.Table.from_batches(held).combine_chunks()
            changed = np.zeros(t.num_rows, bool)
            for k in keys:
                c = t.column(k).to_numpy()
                changed |= c != c[-1]
            cut = int(np.flatnonzero(changed)[-1]) + 1 if changed.any() else 0
            if cut:
                yield t.slice(0, cut)
                held = t.slice(cut).to_batches()
                size, most = sum(b.nbytes for b in held), SORT_BYTES
            else:
                held, most = t.to_batches(), 2 * size  # one bucket so far: it is looked at again when it has doubled
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


SPANS = "rank long, spans array<struct<a: long, b: long>>"


def _listed(rank: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The spans as one list for each rank; those that overlap or touch are one."""
    order = np.lexsort((a, rank))
    rank, a, b = rank[order], a[order], b[order]
    if len(rank):
        fresh = np.concatenate(([True], rank[1:] != rank[:-1]))
        group = np.cumsum(fresh) - 1
        room = int(b.max()) + 1
        upto = np.maximum.accumulate(b + group * room) - group * room  # the farthest end so far in the same text
        new = fresh | np.concatenate(([True], a[1:] > upto[:-1]))
        i = np.flatnonzero(new)
        rank, a, b = rank[i], a[i], upto[np.append(i[1:] - 1, len(new) - 1)]
    first = np.flatnonzero(np.concatenate(([True], rank[1:] != rank[:-1]))) if len(rank) else np.empty(0, np.int64)
    pairs = pa.StructArray.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return pa.array(rank[first], pa.int64()), pa.ListArray.from_arrays(pa.array(np.append(first, len(rank)).astype(np.int32)), pairs)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in _chunks(batches, ("hash",)):
        yield pa.RecordBatch.from_arrays(list(_listed(*_judge(t)[:3])), ["rank", "spans"])


#: Windows of one Arrow batch.
WINDOW_ROWS = 1 << 15


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Deals of hot buckets: the spans that repeat within what a task holds, and the windows that are earliest there."""
    names = ["rank", "start", "w", "v", "spans"]
    for t in _chunks(batches, ("hash", "deal")):
        r, a, b, *early = _judge(t)
        rank, spans = _listed(r, a, b)
        none = pa.nulls(len(rank), pa.int64())
        yield pa.RecordBatch.from_arrays([rank, none, none, none, spans], names)
        windows = _windows(t, *early)
        for i in range(0, windows.num_rows, WINDOW_ROWS):
            part = windows.slice(i, WINDOW_ROWS)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.nulls(part.num_rows, spans.type)], names)


def _across(windows: DataFrame) -> DataFrame:
    """(rank, spans) of the windows (rank, start, w, v) that have an earlier equal."""
    first = F.min(F.struct("rank", "start")).alias("first")
    firsts = windows.groupBy("w", "v").agg(first, F.count("*").alias("n")).where("n > 1").select("w", "v", "first")
    later = windows.join(firsts, ["w", "v"]).where("first.rank <> rank or first.start <> start")
    return later.select("rank", F.array(F.struct(F.col("start").alias("a"), (F.col("start") + WINDOW).alias("b"))).alias("spans"))


def _with_deals(anchors: DataFrame, counted: DataFrame) -> DataFrame:
    """The anchors whose hash repeats, with its number of deals. Hot hashes are looked up where the anchors lie, so none
    of them brings all its anchors to one task; if they are too many to send around, the join's own splitting has to do."""
    counted = common.stored(counted, "counted")
    hot = counted.where("deals > 1")
    if hot.limit(HOT_ROWS + 1).count() > HOT_ROWS:
        return anchors.join(counted, "hash")
    hot = F.broadcast(hot)
    return anchors.join(hot, "hash").unionByName(anchors.join(hot, "hash", "left_anti").join(counted.where("deals = 1"), "hash"))


def _cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """What is left, the bytes removed and the number of maximal removed runs; spans may overlap or touch."""
    out, done, removed, runs, end = [], 0, 0, 0, -1
    for a, b in sorted(spans):
        if a > end:
            out.append(data[done:a])
            runs += 1
            removed += b - a
            done = end = b
        elif b > end:
            removed += b - end
            done = end = b
    out.append(data[done:])
    return b"".join(out), removed, runs


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        rows = []
        lists = batch.column(2)
        pairs, ends = [lists.flatten().field(i).to_numpy() for i in (0, 1)], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())
        for doc_id, b, i, j in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), strict=True):
            rest, removed, runs = _cut(b, list(zip(*(x[i:j].tolist() for x in pairs), strict=True)))
            rows.append((doc_id, len(b), removed, runs, hashlib.sha256(rest).hexdigest()))
        cols = list(zip(*rows, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 4 else pa.int64()) for i, c in enumerate(cols)], names)


def _ranked(docs: DataFrame) -> DataFrame:
    """(rank, doc_id, bytes): ranks ascend with (doc_id, text). Where doc_ids are distinct and not null, they are the ranks."""
    texts = _texts(docs)
    odd = texts.groupBy("doc_id").count().where("count > 1 or doc_id is null or doc_id < 0").limit(1)
    if not odd.take(1):
        return texts.select(F.col("doc_id").alias("rank"), "doc_id", "bytes")
    spark = docs.sparkSession
    ordered = common.stored(texts.repartitionByRange(common.width(spark, docs), F.col("doc_id").asc_nulls_last(), "bytes").sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "bytes").withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id() % F.lit(1 << 33)), "ranked")
    base, bases = 0, []
    for r in ordered.groupBy("part").count().orderBy("part").collect():  # one row a partition
        bases.append((r["part"], base))
        base += r["count"]
    offsets = spark.createDataFrame(bases, "part int, base long")
    return ordered.join(F.broadcast(offsets), "part").select((F.col("base") + F.col("nth")).alias("rank"), "doc_id", "bytes")


def find(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Texts (rank, doc_id, bytes), ranks of exact copies, and lists of spans (rank, spans) to remove from the others."""
    spark = common.prepare(docs.sparkSession)
    width = common.width(spark, docs)
    texts = _ranked(docs)
    long = texts.where(F.length("bytes") >= WINDOW)
    digests = long.select("rank", F.sha2("bytes", 256).alias("digest"))
    firsts = digests.groupBy("digest").agg(F.min("rank").alias("rank"), F.count("*").alias("n")).where("n > 1")
    copies = common.stored(digests.join(firsts.withColumnRenamed("rank", "least"), "digest").where("rank <> least").select("rank"), "copies")
    first_texts = long.join(F.broadcast(copies) if copies.count() * 8 <= 8 << 20 else copies, "rank", "left_anti").select("rank", "bytes")
    anchors = common.stored(first_texts.mapInArrow(_emit_anchors, "rank long, hash long, number int, weight int"), "anchors")
    counted = anchors.groupBy("hash").agg(F.sum("weight").alias("n")).where("n > 1").withColumn("deals", F.ceil(F.col("n") / HOT).cast("int")).select("hash", "deals")
    flagged = _with_deals(anchors, counted).groupBy("rank").agg(F.collect_list(F.struct("number", "deals")).alias("anchors"))  # at most one for every few bytes of the text itself
    flagged = common.stored(flagged, "flagged")
    common.drop(anchors)
    sent = first_texts.join(flagged, "rank").mapInArrow(_stretches, "hash long, deal long, rank long, start long, bytes binary, several boolean")
    sent = common.stored(sent, "stretches")
    common.drop(flagged)
    cold, hot = sent.where("deal < 0").select("hash", "rank", "start", "bytes", "several"), sent.where("deal >= 0")
    order = lambda df, *k: df.repartition(width, *k).sortWithinPartitions(*k)
    if hot.take(1):
        thin = common.stored(order(hot, "hash", "deal").mapInArrow(_thin, f"rank long, start long, w long, v long, {SPANS.partition(', ')[2]}"), "thin")
        early = thin.where("spans is not null").select("rank", "spans").unionByName(_across(thin.where("spans is null").select("rank", "start", "w", "v")))
    else:
        early = None
    spans = order(cold, "hash").mapInArrow(_spans, SPANS)
    return texts, copies, spans if early is None else spans.unionByName(early)


def remove(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of docs (doc_id, text)."""
    texts, copies, spans = find(docs)
    spans = common.stored(spans.groupBy("rank").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")  # of one document each, fewer than its bytes
    whole = texts.join(copies, "rank", "left_semi").select("doc_id", F.length("bytes").cast("long").alias("n_bytes"), F.length("bytes").cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.sha2(F.lit(b""), 256).alias("kept_sha256"))
    cut = texts.join(copies, "rank", "left_anti").join(spans, "rank", "left").select("doc_id", "bytes", "spans").mapInArrow(_finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return cut.unionByName(whole)


def op9_suffix_bucket_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to earlier equal strings; cases as the module names them."""
    return remove(common.documents(spark, sf_dir, "doc_id", "text"))
