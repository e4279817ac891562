"""Quality by nearest neighbours: labelled documents vote, weighted by the cosine of latent-semantic vectors.

A document is a bag of hashed features in three groups: beginnings and ends of its words, shapes of its words (letters, digits and
signs with runs collapsed), and how words repeat. Counts are damped, weighted by how rare a feature is among all documents,
and each group is brought to unit length. The singular vectors of a bounded labelled sample make the latent space. Its labelled
vectors are broadcast; each document's cosines with all of them are computed exactly, block by block, and its nearest
ones vote with their similarity as weight.

Defined cases: a text without words (null and empty too) gets the share of label 1 among the labelled ones without words, or among all if there
are none; a text of no known direction gets the share among all; without labelled rows every score is 0.5; copies of a text count as one
labelled text, with the mean of their labels; other columns are neither read nor changed, but `score` replaces a column of its own name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, textops

#: Hashed features: repetition from 0 on, shapes and word parts after it.
FEATURES, SHAPES_AT, PARTS_AT = 4096, 16, 1024
#: Documented bound: at most so many labelled distinct texts are fitted on and vote, the first in the order of a hash of the text.
FIT_TEXTS = 8000
RANK, PASSES = 48, 6
#: Voters; their votes are the similarity to the power SHARPNESS.
NEIGHBOURS, SHARPNESS = 15, 8
#: Labelled vectors whose cosines are computed together, and documents likewise.
BLOCK, ROWS = 2048, 256
#: Similarities that differ by less are equal, so that rounding does not choose voters.
TIE = 1e-5

CLASS = np.arange(256, dtype=np.uint8)
CLASS[[*range(ord("A"), ord("Z") + 1)]] = ord("A")
CLASS[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = ord("a")
CLASS[[*range(ord("0"), ord("9") + 1)]] = ord("0")
CLASS[[*range(0x09, 0x0E)]] = 0x20


@dataclass(frozen=True)
class QualityModel:
    """rarity: weight of each feature; basis: features to latent space; vectors, labels: the voters; bare, share: scores without words, without direction."""

    rarity: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    bare: float
    share: float


def counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, count) of some texts, sorted by document and feature."""
    found = []
    for a, b in textops.groups(texts):
        w = textops.Words([t.lower() for t in texts[a:b]])
        if not len(w.hash):
            continue
        raw = CLASS[np.frombuffer(b" ".join([*texts[a:b], b""]), np.uint8)]
        starts = np.concatenate(([True], raw[1:] != raw[:-1]))
        shape = textops.Words([raw[starts | (raw == 0x20)].tobytes()]).hash
        last = np.maximum(w.end - 3, w.start)
        tail = textops.mix((w._total[w.end] - w._total[last]) * w._down[last] + np.uint64(1))
        head = textops.mix(w.beginnings(3))
        _, first, again = np.unique(w.hash ^ textops.mix(w.text.astype(np.uint64)), return_index=True, return_inverse=True)
        relation = (first[again] != np.arange(len(again))).astype(np.int64)  # 0 new, 1 seen before in the text
        parts = np.uint64(FEATURES - PARTS_AT)
        columns = [relation, SHAPES_AT + (shape % np.uint64(PARTS_AT - SHAPES_AT)).astype(np.int64), PARTS_AT + (head % parts).astype(np.int64), PARTS_AT + (tail % parts).astype(np.int64)]
        of = [w.text] * 4
        for gap in (1, 2, 3):
            same = np.flatnonzero((w.hash[gap:] == w.hash[:-gap]) & (w.text[gap:] == w.text[:-gap]))
            columns.append(np.full(len(same), 1 + gap))
            of.append(w.text[same])
        key, n = np.unique((np.concatenate(of) + a) * FEATURES + np.concatenate(columns), return_counts=True)
        found.append((key // FEATURES, key % FEATURES, n))
    return tuple(np.concatenate([x[i] for x in found]) if found else np.empty(0, np.int64) for i in range(3))


def weigh(doc: np.ndarray, feature: np.ndarray, n: np.ndarray, docs: int, rarity: np.ndarray) -> np.ndarray:
    """The weights of features: each group of a document has length 1. Repetition goes by its share, the others by damped counts."""
    group = np.searchsorted([SHAPES_AT, PARTS_AT], feature, "right")
    value = np.where(group == 0, n, np.log1p(n)) * rarity[feature]
    length = np.sqrt(np.bincount(doc * 3 + group, value * value, docs * 3))
    return value / length[doc * 3 + group]


def project(texts: list[bytes], rarity: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The latent vectors of texts, of unit length (or zero), and which texts have no words."""
    doc, feature, n = counts(texts)
    value = weigh(doc, feature, n, len(texts), rarity)
    at = np.searchsorted(doc, np.arange(len(texts) + 1))
    out = np.zeros((len(texts), basis.shape[1]), np.float32)
    for a in range(0, len(texts), ROWS):
        b = min(a + ROWS, len(texts))
        s = slice(at[a], at[b])
        dense = np.zeros((b - a, FEATURES), np.float32)
        dense[doc[s] - a, feature[s]] = value[s]
        out[a:b] = dense @ basis
    return _unit(out), at[1:] == at[:-1]


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, length, out=np.zeros_like(x), where=length > 1e-9)


def vote(x: np.ndarray, model: QualityModel) -> np.ndarray:
    """The mean label of the nearest voters of each vector, weighted by similarity: exact over all voters, in blocks.

    All voters as similar as the last one count too.
    """
    k = min(NEIGHBOURS, len(model.labels))
    best, label = np.empty((len(x), 0), np.float32), np.empty((len(x), 0), np.float32)
    for a in range(0, len(model.labels), BLOCK):
        near = np.hstack((best, x @ model.vectors[a : a + BLOCK].T))
        labels = np.hstack((label, np.broadcast_to(model.labels[a : a + BLOCK], (len(x), len(model.labels[a : a + BLOCK])))))
        if near.shape[1] > k:
            least = -np.partition(-near, k - 1, axis=1)[:, k - 1 : k] - TIE
            width = int((near >= least).sum(1).max())
            top = np.argpartition(-near, min(width, near.shape[1] - 1), axis=1)[:, :width]
            near, labels = np.take_along_axis(near, top, 1), np.take_along_axis(labels, top, 1)
            near = np.where(near >= least, near, -np.inf)
        best, label = near, labels
    weight = np.clip(best, 0, None).astype(float) ** SHARPNESS
    total = weight.sum(1)
    return np.divide((weight * label).sum(1), total, out=np.full(len(x), model.share), where=total > 0)


def score_texts(model: QualityModel, texts: list[bytes]) -> np.ndarray:
    x, bare = project(texts, model.rarity, model.basis)
    out = np.concatenate([np.empty(0), *[vote(x[a : a + ROWS], model) for a in range(0, len(x), ROWS)]])
    return np.where(bare, model.bare, out)


def rarity(docs: DataFrame) -> np.ndarray:
    """The weight of each feature: one more than the log of all documents by those that have it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            seen += np.bincount(counts(common.text_bytes(batch.column(0)))[1], minlength=FEATURES)
        yield pa.RecordBatch.from_arrays([pa.array([*range(FEATURES), -1], pa.int32()), pa.array([*seen.tolist(), rows], pa.int64())], ["feature", "n"])

    found = docs.select("text").mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()  # FEATURES rows and one
    n = {r["feature"]: r["n"] for r in found}
    seen = np.array([n.get(i, 0) for i in range(FEATURES)], float)
    return (1 + np.log((1 + n.get(-1, 0)) / (1 + seen))).astype(np.float32)


def latent(rows: list[tuple[np.ndarray, np.ndarray]], rank: int = RANK) -> np.ndarray:
    """The first singular directions of sparse rows (features, weights), by subspace iteration over blocks of rows."""
    rank = min(rank, FEATURES)
    basis = np.linalg.qr(np.random.default_rng(0).standard_normal((FEATURES, rank + 8)))[0].astype(np.float32)
    for _ in range(PASSES):
        again = np.zeros_like(basis)
        for block in _dense(rows):
            again += block.T @ (block @ basis)
        basis = np.linalg.qr(again)[0]
    small = sum((p.T @ p for p in (block @ basis for block in _dense(rows))), np.zeros((rank + 8, rank + 8)))
    size, turn = np.linalg.eigh(small)
    return (basis @ turn[:, np.argsort(-size)[:rank]]).astype(np.float32)


def _dense(rows: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
    for a in range(0, len(rows), ROWS):
        out = np.zeros((len(rows[a : a + ROWS]), FEATURES), np.float32)
        for i, (f, v) in enumerate(rows[a : a + ROWS]):
            out[i, f] = v
        yield out


def train(docs: DataFrame, labels: DataFrame, fit_texts: int = FIT_TEXTS) -> QualityModel:
    """Fit on labelled documents: docs (doc_id, text), labels (doc_id, quality). Rows with a null label are left out.

    How rare features are is counted over all docs; the latent space and the voters come from the bounded sample.
    """
    spark = common.prepare(docs.sparkSession)
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    hashed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).join(known, "doc_id")
    texts = hashed.groupBy("h").agg(F.avg("quality").alias("quality"))
    chosen = common.smallest(texts, F.col("h"), fit_texts)
    weights = spark.sparkContext.broadcast(rarity(docs))
    sample = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text").join(F.broadcast(chosen), "h").groupBy("h").agg(F.first("quality").alias("quality"), F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = common.text_bytes(batch.column(2))
            doc, feature, n = counts(texts)
            value, at = weigh(doc, feature, n, len(texts), weights.value).astype(np.float32), np.searchsorted(doc, np.arange(len(texts) + 1))
            cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), cut(feature.astype(np.int16)), cut(value)], ["h", "quality", "features", "weights"])

    rows = sample.select("h", "quality", "text").mapInArrow(run, "h long, quality double, features binary, weights binary")
    found = sorted(((r["h"], r["quality"], np.frombuffer(r["features"], np.int16).astype(np.int64), np.frombuffer(r["weights"], np.float32)) for r in rows.toLocalIterator()), key=lambda r: r[0])  # fit_texts rows of FEATURES at most
    return fit([r[2:] for r in found], np.array([r[1] for r in found], np.float32), weights.value)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rare: np.ndarray) -> QualityModel:
    share = float(labels.mean()) if len(labels) else 0.5
    worded = np.array([len(f) > 0 for f, _ in rows], bool)
    bare = float(labels[~worded].mean()) if (~worded).any() else share
    kept = [r for r, w in zip(rows, worded, strict=True) if w]
    basis = latent(kept)
    vectors = _unit(np.concatenate([np.zeros((0, basis.shape[1]), np.float32), *[block @ basis for block in _dense(kept)]]))
    return QualityModel(rare, basis, vectors, labels[worded], bare, share)


def score(docs: DataFrame, model: QualityModel, text: str = "text", column: str = "score") -> DataFrame:
    """docs with the vote of each text's neighbours in a last column (in place of one of that name); other columns pass through untouched."""
    spark = common.prepare(docs.sparkSession)
    docs = docs.drop(column)
    shared = spark.sparkContext.broadcast(model)  # FIT_TEXTS and FEATURES vectors of RANK, whatever the corpus
    at, fields = docs.columns.index(text), [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = score_texts(shared.value, common.text_bytes(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.round(s, 6))], [*batch.schema.names, column])

    return docs.mapInArrow(run, ", ".join([*fields, f"`{column}` double"]))


def op12_neighbour_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality; labels are learnt only where crc32(doc_id) mod 3 is not 1.

    A row each of documents, in the cases that the module names too; a null doc_id is held_out null.
    """
    docs = common.documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(common.crc_mod("doc_id", 3) != 1)
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", (common.crc_mod("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
