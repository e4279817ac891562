"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

An item of m characters occurs in a document with at most e edits only if item and region share at least
m + 1 - Q * (e + 1) q-grams on diagonals (place in the document less place in the item) at most e apart. So the q-grams
of all texts are looked up in the items' q-grams, hits are counted in diagonal bands of width 2 (e + 1) that start every
e + 1 diagonals, and only bands that reach the bound are aligned, within the band, to confirm the distance.

Case and runs of white space do not count. The budget is RATE edits a character, less for items so short that the bound
would be under LEAST shared q-grams.

A text is taken in overlapping segments of about SEGMENT characters, each long enough to hold any region of any item, and
the hits of a segment are counted in blocks of about HITS, so that a gram of many items in a long text fills no task.

Defined cases: null or empty texts match nothing; items of fewer than Q characters have no q-gram: they are found where they
stand word for word, as whole words (`find`; such a word or two is no evidence, so `keep_clean` leaves them out); null or
empty items identify nothing; repeated items give a row each; repeated documents give their rows each; very long texts are
scanned whole; an empty benchmark or table gives no rows; other columns pass through `keep_clean` untouched. The benchmark's
q-grams go to all executors in chunks of CHUNK_CHARS characters at most (an item longer than that is a chunk), one pass over
the documents each; between two passes of `keep_clean` what is left is stored, so a task holds one chunk's table at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, textops

Q = 10
RATE = 0.08
LEAST = 6
CHUNK_CHARS = 2_000_000
SEGMENT, HITS = 1 << 17, 1 << 21
_BITMAP = 22

_WHITE = np.zeros(0x3001, bool)
_WHITE[[0x20, *range(0x09, 0x0E), 0x85, 0xA0, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = True


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with single spaces, and the place of each in the text."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower()[:1] or c for c in text)
    codes = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
    white = _WHITE[np.minimum(codes, 0x3000)] & (codes <= 0x3000)
    keep = ~white
    keep[1:] |= white[1:] & ~white[:-1]
    places = np.flatnonzero(keep)
    return np.where(white, 0x20, codes)[places], places


def budget(m: int) -> int:
    """Edits allowed in an item of m characters."""
    return max(0, min(int(RATE * m), (m + 1 - LEAST) // Q - 1))


@dataclass(frozen=True)
class Items:
    """The benchmark's q-grams, sorted by hash, and its items."""

    ids: list
    codes: list[np.ndarray]
    edits: np.ndarray
    bound: np.ndarray
    gram: np.ndarray
    item: np.ndarray
    place: np.ndarray
    bitmap: np.ndarray
    short: dict[int, dict[bytes, list]]  # of items under Q characters: by length, then by code points, their ids

    @classmethod
    def of(cls, ids: list, texts: list[str]) -> Items:
        codes: list[np.ndarray] = []
        for t in texts:
            c = normal(t)[0]
            a, b = int(len(c) > 0 and c[0] == 0x20), len(c) - int(len(c) > 1 and c[-1] == 0x20)
            codes.append(c[a:b])
        short: dict[int, dict[bytes, list]] = {}
        for i, c in enumerate(codes):
            if 0 < len(c) < Q:
                short.setdefault(len(c), {}).setdefault(c.tobytes(), []).append(ids[i])
        there = [i for i, c in enumerate(codes) if len(c) >= Q]
        ids, codes = [ids[i] for i in there], [codes[i] for i in there]
        sizes = np.array([len(c) for c in codes], np.int64)
        edits = np.array([budget(m) for m in sizes.tolist()], np.int64)
        grams = [textops.window_hashes(c, Q) for c in codes]
        gram = np.concatenate([np.empty(0, np.uint64), *grams])
        item = np.repeat(np.arange(len(codes)), [len(g) for g in grams])
        place = np.concatenate([np.empty(0, np.int64), *(np.arange(len(g)) for g in grams)])
        order = np.argsort(gram, kind="stable")
        bitmap = np.zeros(1 << _BITMAP, bool)
        bitmap[(gram >> np.uint64(64 - _BITMAP)).astype(np.int64)] = True
        return cls(ids, codes, edits, sizes + 1 - Q * (edits + 1), gram[order], item[order], place[order], bitmap, short)


def align(item: np.ndarray, region: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Least edit distance of item to a substring of region on diagonals low..high, and where that starts and ends.

    Row by row over the item, all diagonals of the band at once; a cell's deletions run along the row as a running minimum.
    """
    width, big = high - low + 1, 1 << 30
    diagonal = np.arange(low, high + 1)
    # the region under the whole band, with a value that matches nothing outside of it
    at = np.arange(low, high + len(item) + 1)
    inside = (at >= 0) & (at < len(region))
    under = np.full(len(at), -1, np.int64)
    under[inside] = region[at[inside]]
    gap = np.where((at >= 0) & (at <= len(region)), 0, big)
    cost, begin = gap[:width].copy(), np.where(gap[:width] == 0, diagonal, 0)
    step, up, begin_up = np.arange(width), np.full(width, big), np.zeros(width, np.int64)
    for i in range(len(item)):
        match = cost + (under[i : i + width] != item[i])
        match[~inside[i : i + width]] = big
        up[:-1], begin_up[:-1] = cost[1:] + 1, begin[1:]  # the item's character has no counterpart
        take = up < match
        best = np.where(take, up, match) - step
        run = np.minimum.accumulate(best)
        source = np.maximum.accumulate(np.where(best == run, step, 0))
        begin = np.where(take, begin_up, begin)[source]
        cost = np.minimum(run + step + gap[i + 1 : i + 1 + width], big)
    at = int(cost.argmin())
    return int(cost[at]), int(begin[at]), int(diagonal[at]) + len(item)


def _bands(items: Items, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(item, band) of the diagonal bands of a segment that share enough q-grams with an item."""
    none = np.empty(0, np.int64)
    grams = textops.window_hashes(codes, Q)
    maybe = np.flatnonzero(items.bitmap[(grams >> np.uint64(64 - _BITMAP)).astype(np.int64)])
    a, b = np.searchsorted(items.gram, grams[maybe], "left"), np.searchsorted(items.gram, grams[maybe], "right")
    maybe, a, b = maybe[b > a], a[b > a], b[b > a]
    if not len(maybe):
        return none, none
    ends = np.cumsum(b - a)
    keys, numbers = none, none
    cuts = np.searchsorted(ends, np.arange(0, ends[-1], HITS), "right").tolist()
    for i, j in zip(cuts, [*cuts[1:], len(maybe)], strict=True):
        if i == j:
            continue
        count = b[i:j] - a[i:j]
        last = np.cumsum(count)
        hit = np.repeat(a[i:j] - last + count, count) + np.arange(last[-1])
        item = items.item[hit]
        band = (np.repeat(maybe[i:j], count) - items.place[hit]) // (items.edits[item] + 1)
        found, number = np.unique(np.concatenate((item, item)) * (1 << 40) + (np.concatenate((band, band - 1)) + (1 << 39)), return_counts=True)
        if not len(keys):
            keys, numbers = found, number
            continue
        keys, at = np.unique(np.concatenate((keys, found)), return_inverse=True)
        numbers = np.bincount(at, np.concatenate((numbers, number))).astype(np.int64)
    item, band = keys >> 40, (keys & ((1 << 40) - 1)) - (1 << 39)
    enough = numbers >= items.bound[item]
    return item[enough], band[enough]


def _segments(n: int, longest: int) -> Iterator[tuple[int, int]]:
    """Stretches of a text of n characters; any `longest` characters in a row lie in one of them."""
    size = max(SEGMENT, 2 * longest)
    start = 0
    while start + size < n:
        yield start, start + size
        start += size - longest
    yield start, n


def matches(items: Items, text: str, short: bool = True) -> list[tuple[object, int, int, int]]:
    """(item_id, start, end, distance) of each region of the text within an item's budget, in the text's code points."""
    if not text or not (len(items.gram) or (short and items.short)):
        return []
    codes, places = normal(text)
    out: set[tuple[int, int, int, int]] = set()
    longest = max((len(c) for c in items.codes), default=0) + 3 * (int(items.edits.max(initial=0)) + 1)
    for start, end in _segments(len(codes), longest):
        part = codes[start:end]
        for i, k in zip(*(x.tolist() for x in _bands(items, part)), strict=True):
            own, e = items.codes[i], int(items.edits[i])
            low, high = k * (e + 1), (k + 2) * (e + 1) - 1
            exact = [d for d in range(max(0, low), min(high, len(part) - len(own)) + 1) if part[d] == own[0] and np.array_equal(part[d : d + len(own)], own)]
            out.update((0, i, start + d, start + d + len(own)) for d in exact)
            if exact:
                continue  # whatever else the band holds overlaps the exact passage
            first = max(0, low - e)
            region = part[first : max(first, high + len(own) + e)]
            distance, s, t = align(own, region, low - first - e, high - first + e)
            if distance <= e:
                out.add((distance, i, start + first + s, start + first + t))
    kept: dict[int, list[tuple[int, int, int]]] = {}
    for d, i, s, t in sorted(out):
        mine = kept.setdefault(i, [])
        if all(t <= u or s >= v for u, v, _ in mine):
            mine.append((s, t, d))
    found = [(items.ids[i], s, t, d) for i, s, t, d in sorted(((i, *x) for i, own in kept.items() for x in own), key=lambda x: (x[1], x[0]))]
    found += _short_matches(items, codes) if short else []
    return [(i, int(places[s]), int(places[t - 1]) + 1, d) for i, s, t, d in found]


def _short_matches(items: Items, codes: np.ndarray) -> list[tuple[object, int, int, int]]:
    """Whole-word occurrences of the items that are too short for a q-gram."""
    out = []
    for m, known in items.short.items():
        table = np.sort(np.concatenate([textops.window_hashes(np.frombuffer(k, np.uint32), m) for k in known]))
        for s in np.flatnonzero(np.isin(textops.window_hashes(codes, m), table)).tolist():
            ids = known.get(codes[s : s + m].astype(np.uint32).tobytes(), ())
            around = [chr(c) for c in (*codes[max(0, s - 1) : s].tolist(), *codes[s + m : s + m + 1].tolist())]
            if ids and not any(c.isalnum() for c in around):
                out += [(i, s, s + m, 0) for i in ids]
    return out


def chunks(benchmark: DataFrame, chars: int = CHUNK_CHARS) -> Iterator[Items]:
    """The benchmark (item_id, text) in parts of about `chars` characters; one part is on the driver at a time."""
    rows = benchmark.select("item_id", "text").where("text is not null")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // chars)
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        yield Items.of([r["item_id"] for r in part], [r["text"] for r in part])


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end, distance) of every benchmark passage in docs (doc_id, text)."""
    spark = common.prepare(docs.sparkSession)
    item_type = dict(benchmark.dtypes)["item_id"]
    schema = f"doc_id long, item_id {item_type}, start long, end long, distance int"
    arrow = benchmark.select("item_id").limit(0).toArrow().schema.field(0).type
    out = spark.createDataFrame([], schema)
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("text is not null")
    for items in chunks(benchmark):
        shared = spark.sparkContext.broadcast(items)  # bounded by CHUNK_CHARS

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(d, *m) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for m in matches(shared.value, t)]
                cols = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), arrow, pa.int64(), pa.int64(), pa.int32()), strict=True)], ["doc_id", "item_id", "start", "end", "distance"])

        out = out.unionByName(texts.mapInArrow(run, schema))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no benchmark passage, in the columns of docs. Items under Q characters do not count."""
    spark = common.prepare(docs.sparkSession)
    at = docs.columns.index("text")
    out = docs
    for items in chunks(benchmark):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not t or not matches(shared.value, t, False) for t in batch.column(at).to_pylist()], pa.bool_()))

        out = (docs if out is docs else common.stored(out, "clean")).mapInArrow(run, docs.schema)
    return out


def op7_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage of every document, a row each; null, empty, repeated and long texts as the module says."""
    return find(common.documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
