"""Toxicity by multiple-instance learning: sentence scores combined by noisy-or, trained from document labels.

A document is a bag of sentences. A sentence's logit is a bias plus the weights of its hashed words and word beginnings
(inflected forms share those); a document is toxic with probability 1 - prod(1 - p_sentence). Only documents carry labels, so the gradient reaches each sentence
through the noisy-or, and after training the sentence scores tell where the offending sentences are.

Defined cases: a null or empty text, or one without words, scores the bag prior of one empty sentence; repeated rows get
equal scores; without any labelled row every score is 0; other columns are neither read nor changed, but `score` replaces a
column that has the name of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, textops

#: Size of the hashed vocabulary: 2**BITS weights of 4 bytes are sent to the executors.
BITS = 18
#: Documented bound: the classifier is fitted on at most so many labelled documents, the first in the order of a hash of doc_id.
FIT_DOCS = 8000
#: Documented bound: they have so many features in all at most (a word is one, and each of its beginnings); the first document always counts.
FIT_WORDS = 40_000_000
#: Parts in which the driver reads the fitted sample.
FIT_PARTS = 8
#: Features of fewer fitted documents than this are left out: they could only be learnt by heart.
MIN_DOCS = 4
EPOCHS, RATE, L1 = 30, 0.4, 1.2e-3
#: Besides the word, its first so many bytes are features.
PREFIXES = (4, 5)

LETTER = np.zeros(256, bool)
LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(0x80, 0x100)]] = True
STOP = np.zeros(256, np.int64)
STOP[[ord(c) for c in ".!?\n\x00"]] = 1


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    bias: float
    labelled: int


def _features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, textops.Words]:
    """Bucket and sentence of each feature, the document of each sentence, and the words; each document has a sentence at least.

    Features come in blocks: of all words, then of all beginnings of each length.
    """
    w = textops.Words([t.lower() for t in texts], ~LETTER, b"\x00")
    stops = np.concatenate(([0], np.cumsum(STOP[w.bytes])))
    sentence = stops[w.start]
    hashes = [w.hash, *(textops.mix(w.beginnings(n) + np.uint64(n)) for n in PREFIXES)]
    buckets = np.concatenate([(h >> np.uint64(64 - BITS)).astype(np.int32) for h in hashes])
    # sentences that have words, plus one empty sentence of each document without words
    ids, first, of = np.unique(sentence, return_index=True, return_inverse=True)
    docs = w.text[first]
    bare = np.setdiff1d(np.arange(len(texts)), docs)
    order = np.argsort(np.concatenate((docs, bare)), kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return buckets, np.tile(place[of], len(hashes)), np.concatenate((docs, bare))[order], w


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def fit(bags: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray) -> ToxicityModel:
    """Adagrad with soft-thresholding over mini-batches; bags: (buckets, sentence of each, document of each sentence) of groups of documents.

    Weights are kept for the buckets that occur; the bags are read as they are, and only one of them is spread out at a time.
    """
    positive = float(labels.mean()) if len(labels) else 0.0
    if not 0 < positive < 1:
        return ToxicityModel(np.zeros(1 << BITS, np.float32), -20.0 if positive == 0 else 20.0, len(labels))
    there = np.zeros(1 << BITS, bool)
    for buckets, _, _ in bags:
        there[buckets] = True
    place = np.cumsum(there, dtype=np.int32) - 1
    n = int(there.sum())
    weights, seen = np.zeros(n), np.full(n, 1e-8)
    bias, bias_seen = -6.0, 1e-8
    for epoch in range(EPOCHS):
        at = 0
        for buckets, sentence, doc in bags:
            docs = int(doc[-1]) + 1
            y = labels[at : at + docs].astype(float)
            at += docs
            feature = place[buckets]
            z = bias + np.bincount(sentence, weights[feature], len(doc))
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            g = slopes(z, p, doc, y)
            gb = g.sum() / docs
            bias_seen += gb * gb
            bias -= RATE / (1 + epoch / 10) * gb / np.sqrt(bias_seen)
            gw = np.bincount(feature, g[sentence], n) / docs
            touched = np.flatnonzero(np.bincount(feature, minlength=n))
            gw = gw[touched]
            seen[touched] += gw * gw
            rate = RATE / np.sqrt(seen[touched])
            moved = weights[touched] - rate * gw
            weights[touched] = np.sign(moved) * np.maximum(np.abs(moved) - rate * L1, 0)
    full = np.zeros(1 << BITS, np.float32)
    full[there] = weights
    return ToxicityModel(full, float(bias), len(labels))


def slopes(z: np.ndarray, p: np.ndarray, doc: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of each sentence, the derivative of its document's negative log-likelihood by the sentence's logit, cut to [-1, 1].

    A document is toxic with probability 1 - none, where none is the product over its sentences of 1 - p.
    """
    none = np.exp(-np.bincount(doc, _softplus(z), len(y)))
    slope = np.where(y > 0, -none / np.maximum(1 - none, 1e-6), 1.0)
    return np.clip(p * slope[doc], -1, 1)


def train(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS, fit_words: int = FIT_WORDS) -> ToxicityModel:
    """Fit on labelled documents: docs (doc_id, text), labels (doc_id, toxic). Rows with a null label are left out.

    The sample stays on the executors, as features; the driver reads it in parts, as 8 bytes for each feature that occurs
    in MIN_DOCS documents, and holds nothing else of it.
    """
    spark = common.prepare(docs.sparkSession)
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = common.smallest(known, F.xxhash64("doc_id"), fit_docs)
    sample = common.stored(
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .select(F.xxhash64("doc_id").alias("h"), "text", "toxic")
        .mapInArrow(_fit_rows, "h long, toxic int, size long, sentences binary, words binary"),
        "sample",
    )
    total, last = 0, None
    for r in sample.groupBy("h").agg(F.sum("size").alias("size")).orderBy("h").collect():  # fit_docs rows at most
        total += r["size"]
        if last is not None and total > fit_words:
            break
        last = r["h"]
    used = sample.where(F.col("h") <= (last or 0)) if last is not None else sample.limit(0)
    often = used.mapInArrow(_distinct, "bucket int").groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_DOCS).select("bucket").collect()  # fewer than 2**BITS
    common_enough = np.zeros(1 << BITS, bool)
    common_enough[[r["bucket"] for r in often]] = True
    del often
    shared = spark.sparkContext.broadcast(common_enough)

    def pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s_out, w_out, sizes = [], [], []
            for s, b in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                s, b = np.frombuffer(s, np.int32), np.frombuffer(b, np.int32)
                sizes.append(int(s.max()) + 1 if len(s) else 1)
                kept = shared.value[b]
                w_out.append(b[kept].tobytes())
                s_out.append(np.tile(s, 1 + len(PREFIXES))[kept].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(s_out, pa.binary()), pa.array(w_out, pa.binary())], batch.schema.names)

    rows = used.mapInArrow(pruned, sample.schema).repartitionByRange(FIT_PARTS, "h").sortWithinPartitions("h", "words")
    bags, y, part = [], [], []
    for r in rows.toLocalIterator():  # one part at a time
        y.append(r["toxic"])
        part.append((r["size"], np.frombuffer(r["sentences"], np.int32), np.frombuffer(r["words"], np.int32)))
        if len(part) == 64:
            bags.append(_bag(part))
            part = []
    if part:
        bags.append(_bag(part))
    model = fit(bags, np.array(y, np.int64))
    shared.unpersist()
    common.drop(sample)
    return model


def _bag(part: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents (number of sentences, sentence of each feature, features) as one bag of `fit`."""
    sizes = [n for n, _, _ in part]
    first = np.cumsum([0, *sizes[:-1]])
    sentence = np.concatenate([s + np.int32(a) for a, (_, s, _) in zip(first.tolist(), part, strict=True)])
    return np.concatenate([b for _, _, b in part]), sentence, np.repeat(np.arange(len(part), dtype=np.int32), sizes)


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct features of each document."""
    for batch in batches:
        found = [np.unique(np.frombuffer(b, np.int32)) for b in batch.column(4).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int32), *found]))], ["bucket"])


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h, texts, toxic = batch.column(0), common.text_bytes(batch.column(1)), batch.column(2)
        s_out, w_out, sizes = [], [], []
        for t in texts:
            buckets, sentence, _, _ = _features([t])
            s_out.append(sentence[: len(sentence) // (1 + len(PREFIXES))].astype(np.int32).tobytes())  # the same for each block
            w_out.append(buckets.tobytes())
            sizes.append(len(buckets))
        yield pa.RecordBatch.from_arrays([h, toxic, pa.array(sizes, pa.int64()), pa.array(s_out, pa.binary()), pa.array(w_out, pa.binary())], ["h", "toxic", "size", "sentences", "words"])


def score_texts(model: ToxicityModel, texts: list[bytes]) -> np.ndarray:
    out = np.zeros(len(texts))
    for a, b in textops.groups(texts):
        buckets, sentence, doc, _ = _features(texts[a:b])
        z = model.bias + np.bincount(sentence, model.weights[buckets], len(doc))
        out[a:b] = -np.expm1(-np.bincount(doc, _softplus(z), b - a))
    return out


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", column: str = "score") -> DataFrame:
    """docs with the probability that the text is toxic in a last column (in place of one of that name); other columns pass through untouched."""
    spark = common.prepare(docs.sparkSession)
    docs = docs.drop(column)
    shared = spark.sparkContext.broadcast(model)  # 4 * 2**BITS bytes, whatever the corpus
    at, fields = docs.columns.index(text), [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = score_texts(shared.value, common.text_bytes(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], [*batch.schema.names, column])

    return docs.mapInArrow(run, ", ".join([*fields, f"`{column}` double"]))


def keep_clean(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that score below the threshold, in the columns of docs (whatever their names)."""
    spark = common.prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(score_texts(shared.value, common.text_bytes(batch.column(at))) < threshold))

    return docs.mapInArrow(run, docs.schema)


def offending_sentences(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """(doc_id, sentence number, byte start, byte end, score) of each sentence that alone reaches the threshold.

    start and end bound the sentence's words in the UTF-8 bytes of the text.
    """
    spark = common.prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, rows = shared.value, []
            for doc_id, t in zip(batch.column(0).to_pylist(), common.text_bytes(batch.column(1)), strict=True):
                buckets, sentence, doc, w = _features([t])
                z = m.bias + np.bincount(sentence, m.weights[buckets], len(doc))
                p = 1 / (1 + np.exp(-z))
                for s in np.flatnonzero(p >= threshold).tolist():
                    words = np.flatnonzero(sentence[: len(w.start)] == s)
                    if len(words):
                        rows.append((doc_id, s, int(w.start[words[0]]), int(w.end[words[-1]]), float(p[s])))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64()), strict=True)], ["doc_id", "sentence", "start", "end", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, sentence int, start long, end long, score double")


def op10_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity; labels are learnt only where crc32(doc_id) mod 5 is not 0.

    A row each of documents, in the cases that the module names too; a null doc_id is held_out null.
    """
    docs = common.documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(common.crc_mod("doc_id", 5) != 0)
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", (common.crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
