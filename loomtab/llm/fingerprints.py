"""Document fingerprints: bottom-k sketches of word-shingle hashes, mergeable across parts.

A sketch is the k smallest distinct 64-bit hashes of a text's shingles (five words, see `textops.shingles`), ascending.
The sketch of a union is the k smallest of the sketches' union, so parts may be sketched anywhere and merged in any
order. With n distinct shingles: a sketch of fewer than k hashes is the whole set and every estimate from it is exact;
otherwise n is about (k - 1) / (k-th hash as a fraction of 2**64). Resemblance is the share of the k smallest hashes of
the union that both sketches hold; containment of A in B is resemblance * |A or B| / |A|.

Defined cases: a null or empty text, or one without words, has the empty sketch (fingerprint ''), which resembles
another empty sketch with 1.0 and any other with 0.0; repeated rows and rows of equal doc_id are neighbours of each other
in the order of doc_id (then text); a lone document is its own next; an empty table gives an empty result; a row without
doc_id has no place in the order and is left out of the comparison (not of `fingerprint`).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, textops

#: Hashes of a sketch; the standard error of a resemblance r is about sqrt(r * (1 - r) / K).
K = 128
#: Blocks of consecutive documents for each shuffle partition, so that partitions even out.
BLOCKS = 4


def sketch(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k smallest of sorted distinct hashes."""
    return hashes[:k]


def merge(sketches: list[np.ndarray], k: int = K) -> np.ndarray:
    return np.unique(np.concatenate([np.empty(0, np.uint64), *sketches]))[:k]


def distinct_count(s: np.ndarray, k: int = K) -> float:
    return float(len(s)) if len(s) < k else (k - 1) / ((int(s[k - 1]) + 1) / 2**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = merge([a, b], k)
    return float(np.isin(both, a, assume_unique=True).__and__(np.isin(both, b, assume_unique=True)).mean())


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of A's shingles that B has too."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct_count(merge([a, b], k), k) / distinct_count(a, k))


def to_text(s: np.ndarray) -> str:
    """Fixed-width lowercase hex, 16 digits a hash."""
    return s.astype(">u8").tobytes().hex()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(s or ""), ">u8").astype(np.uint64)


def fingerprint(docs: DataFrame, column: str = "fingerprint") -> DataFrame:
    """(doc_id, fingerprint) of docs (doc_id, text)."""
    common.prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [to_text(sketch(h)) for h in textops.shingles(common.text_bytes(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], ["doc_id", column])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, {column} string")


def merged(prints: DataFrame, *by: str, column: str = "fingerprint", k: int = K) -> DataFrame:
    """One sketch for each group: each task keeps k hashes of a group at most before the shuffle.

    The window over the group's hashes starts with a limit of k in every map task, so a hot group moves k rows a task.
    """
    from pyspark.sql import Window

    width = 16
    pieces = F.transform(F.sequence(F.lit(0), (F.length(column) / width - 1).cast("int")), lambda i: F.substring(F.col(column), i * width + 1, F.lit(width)))
    hashes = prints.where(F.length(column) > 0).select(*by, F.explode(pieces).alias("h")).distinct()
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("h"))
    least = hashes.withColumn("r", rank).where(F.col("r") <= k)
    some = least.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list("h")), "").alias(column))
    return prints.select(*by).distinct().join(some, list(by), "left").withColumn(column, F.coalesce(column, F.lit("")))


def _half(text: str, following: str) -> str:
    n = len(text) // 2
    return text[: len(text) - n] + following[:n]


def _block_starts(docs: DataFrame, blocks: int) -> list[int]:
    """Ascending doc_ids that cut the table into about equal blocks: quantiles of a mergeable summary of all ids, one number a block."""
    cuts = docs.select(F.percentile_approx("doc_id", [i / blocks for i in range(1, blocks)], 10 * blocks).alias("q")).first()["q"]
    return sorted(set(cuts or []))


def compare_with_next(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Fingerprints of each text, of the text with its second half replaced from the next document, both likenesses,
    the estimated number of distinct shingles of the text, and the containment of the edited text in it and of it in the edited.

    The order is descending doc_id. The ids are cut into blocks; a block also receives the first row of the block after
    it, so one shuffle by block gives every document its neighbour, and a task streams through sorted blocks.
    """
    spark = common.prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = np.array(_block_starts(docs.select("doc_id"), blocks or BLOCKS * common.width(spark, docs)), np.int64)

    def block_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.searchsorted(cuts, ids, "right").astype(np.int32))], ["doc_id", "block"])

    # the largest doc_id of each block is the block's first document, and the next one of the block above it
    tops = docs.select("doc_id").where("doc_id is not null").mapInArrow(block_of, "doc_id long, block int").groupBy("block").agg(F.max("doc_id").alias("top")).orderBy("block").collect()
    filled = [r["block"] for r in tops]  # one row a block
    goes_to = {r["top"]: filled[(i + 1) % len(filled)] for i, r in enumerate(tops)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "guest", "doc_id", "text"]
        first = np.array(sorted(goes_to), np.int64)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            block = np.searchsorted(cuts, ids, "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(np.zeros(len(ids), bool)), *batch.columns], names)
            guests = np.flatnonzero(np.isin(ids, first))
            if len(guests):
                part = batch.take(pa.array(guests))
                yield pa.RecordBatch.from_arrays([pa.array([goes_to[i] for i in ids[guests].tolist()], pa.int32()), pa.array(np.ones(len(guests), bool)), *part.columns], names)

    dealt = docs.where("doc_id is not null").mapInArrow(deal, "block int, guest boolean, doc_id long, text string")
    ordered = dealt.repartition(common.width(spark, docs), "block").sortWithinPartitions("block", "guest", F.col("doc_id").desc(), "text")
    return ordered.mapInArrow(_compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_distinct double, edited_in_own double, own_in_edited double")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted: the documents of a block, then its guest (several if the guest's row is repeated: the first counts)."""
    held: tuple | None = None
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_distinct", "edited_in_own", "own_in_edited"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 5]
    for batch in batches:
        blocks, guests, ids = (batch.column(i).to_pylist() for i in range(3))
        texts = batch.column(3).to_pylist()
        prints = [sketch(h) for h in textops.shingles([t.encode() for t in texts])]
        pairs = []
        for row in zip(blocks, guests, ids, texts, prints, strict=True):
            if held is not None and held[0] == row[0] and not held[1]:
                pairs.append((held, row))
            held = row
        edited = [_half(a[3], b[3]) for a, b in pairs]
        rows = []
        for (a, b), e, h in zip(pairs, edited, textops.shingles([e.encode() for e in edited]), strict=True):
            own = sketch(h)
            rows.append((a[2], len(a[3]), hashlib.sha256(e.encode()).hexdigest(), to_text(a[4]), to_text(own), resemblance(a[4], own), resemblance(a[4], b[4]), distinct_count(a[4]), containment(own, a[4]), containment(a[4], own)))
        cols = list(zip(*rows, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)


def op3_bottom_k_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and likenesses of every document that has a doc_id; other cases as the module names them."""
    return compare_with_next(common.documents(spark, sf_dir, "doc_id", "text"))
