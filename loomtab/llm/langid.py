"""Language identification by mixture inference: which languages a text mixes, and in what proportions.

Each language has a model of character n-grams, counted over all training documents. The words of a text are the units:
the likelihood of a word under a language is the product over its n-grams (with the word's edges) of smoothed
conditional probabilities. Expectation-maximisation then estimates the text's language proportions, the mixture weights
that maximise the likelihood of its words. More languages always fit a little better, so the set is chosen by penalised
likelihood: the smallest proportion is dropped and the rest refitted as long as the loss is below a penalty of
log(words) / 2 times PENALTY a language.

Defined cases: a null text, or one without a letter, is `und` with score 0; ties go to the first language in
alphabetical order; training rows with null text or lang are left out; without any training row all texts are `und`;
repeated rows get equal results; texts of any length are read whole; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, textops

#: n-grams are hashed to 2**BITS places for each language: 4 bytes a place and language go to the executors, whatever the corpus.
BITS = 16
ORDER = 3
SMOOTH = 0.5
#: A word's log-likelihoods lie within this much of its best one: one odd word (a name, a code) does not decide.
FLOOR = 12.0
EM_STEPS = 12
PENALTY = 3.0
UNKNOWN = "und"

#: Characters are classed into at most 4096 codes before hashing, by a table for the common scripts.
_EDGE = 1


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_p: np.ndarray  # 2**BITS x languages


def _letters(table: np.ndarray) -> np.ndarray:
    """Which code points of an array are letters."""
    distinct, at = np.unique(table, return_inverse=True)
    return np.fromiter((chr(c).isalpha() for c in distinct.tolist()), bool, len(distinct))[at]


_ASCII = np.fromiter((chr(c).isalpha() for c in range(0x3000)), bool, 0x3000)


def _is_letter(codes: np.ndarray) -> np.ndarray:
    low = codes < len(_ASCII)
    out = _ASCII[np.where(low, codes, 0)]
    if not low.all():
        out[~low] = _letters(codes[~low])
    return out


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of the texts' words in order, the first gram of each word, and the text of each word.

    A word's grams are the ORDER-grams of its letters with an edge sign on either side.
    """
    joined = "\n".join([*texts, ""]).lower()
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    # lower-casing can lengthen a text; line ends put in between are found again by their number
    letter = _is_letter(codes)
    inside = np.concatenate(([False], letter, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[0::2], edges[1::2]
    size = end - start
    # words laid out with an edge sign after each; the sign before the first comes from the front
    at = np.concatenate(([0], np.cumsum(size + 1)))[:-1] + 1
    total = int(size.sum() + len(size)) + 1
    line = np.full(total, _EDGE, np.uint64)
    place = np.repeat(at - start, size) + np.flatnonzero(letter)
    line[place] = codes[letter]
    h = np.zeros(max(0, total - ORDER + 1), np.uint64)
    for j in range(ORDER):
        h = h * np.uint64(textops.STEP) + line[j : j + len(h)]
    grams = (textops.mix(h) >> np.uint64(64 - BITS)).astype(np.int64)
    # the grams of a word start at the sign before it, and end with the one that holds the sign after it
    first = at - 1
    count = np.maximum(1, size + 2 - ORDER + 1)
    count[-1:] = np.minimum(count[-1:], len(grams) - first[-1:])
    offsets = np.concatenate(([0], np.cumsum(count)))
    picked = np.repeat(first - offsets[:-1], count) + np.arange(offsets[-1])
    lines = np.concatenate(([0], np.cumsum(codes == 10)))
    return (grams[np.minimum(picked, len(grams) - 1)] if len(grams) else np.empty(0, np.int64)), offsets[:-1], lines[start]


def _flat(text: str | None) -> str:
    return (text or "").replace("\n", " ")


def train(docs: DataFrame) -> LanguageModel:
    """Count the n-grams of each language over all rows of docs (text, lang)."""
    common.prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                own = [_flat(t) for t, x in zip(texts, langs, strict=True) if x == lang]
                for a, b in textops.groups(own):
                    grams, _, _ = _grams(own[a:b])
                    counts[lang] = counts.get(lang, 0) + np.bincount(grams, minlength=1 << BITS)
        for lang, c in counts.items():
            there = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(there), pa.string()), pa.array(there.astype(np.int32)), pa.array(c[there])], ["lang", "gram", "n"])

    known = docs.where("text is not null and lang is not null").select("text", "lang")
    rows = known.mapInArrow(run, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()  # at most 2**BITS rows a language
    languages = tuple(sorted(rows.lang.unique()))
    log_p = np.zeros((1 << BITS, len(languages)))
    for k, lang in enumerate(languages):
        own = rows[rows.lang == lang]
        c = np.full(1 << BITS, SMOOTH)
        c[own.gram.to_numpy()] += own.n.to_numpy()
        log_p[:, k] = np.log(c / c.sum())
    return LanguageModel(languages, log_p.astype(np.float32))


def _em(likelihood: np.ndarray, doc: np.ndarray, allowed: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each document; words are sorted by document, every document has one at least."""
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    n = np.diff(np.append(first, len(doc)))[:, None]
    theta = allowed / allowed.sum(1, keepdims=True)
    for _ in range(steps):
        share = likelihood * np.repeat(theta, n[:, 0], 0)
        share /= share.sum(1, keepdims=True)
        theta = np.add.reduceat(share, first) / n
    fit = np.add.reduceat(np.log((likelihood * np.repeat(theta, n[:, 0], 0)).sum(1)), first)
    return theta, fit


def infer(model: LanguageModel, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Predicted language, its proportion, and all proportions of each text."""
    k = len(model.languages)
    names, scores, shares = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros((len(texts), max(1, k)))
    if not k:
        return names, scores, shares
    grams, first, doc = _grams([_flat(t) for t in texts])
    if not len(first):
        return names, scores, shares
    word = np.add.reduceat(model.log_p[grams], first).astype(np.float64)
    word = np.maximum(word - word.max(1, keepdims=True), -FLOOR)
    there, doc = np.unique(doc, return_inverse=True)
    starts = np.flatnonzero(np.diff(doc, prepend=-1))
    n = np.diff(np.append(starts, len(doc)))
    single = np.add.reduceat(word, starts)
    best = single.argmax(1)
    theta = np.zeros((len(there), k))
    theta[np.arange(len(there)), best] = 1
    likelihood = np.exp(word)
    # one language leaves at most this much likelihood to gain; below the penalty of a second, it is the choice
    penalty = PENALTY * np.log(n + 1) / 2
    open_ = np.flatnonzero(-single.max(1) > penalty) if k > 1 else np.empty(0, int)
    if len(open_):
        mask = np.isin(doc, open_)
        part, at = likelihood[mask], np.unique(doc[mask], return_inverse=True)[1]
        allowed = np.ones((len(open_), k))
        now, fit = _em(part, at, allowed, EM_STEPS)
        going = np.ones(len(open_), bool)
        for _ in range(k - 1):
            tried = allowed.copy()
            tried[np.arange(len(tried)), np.where(allowed > 0, now, 2).argmin(1)] = 0
            words = going[at]
            ids = np.flatnonzero(going)
            t, f = _em(part[words], np.unique(at[words], return_inverse=True)[1], tried[ids], EM_STEPS)
            better = fit[ids] - f < penalty[open_][ids]
            took = ids[better]
            allowed[took], now[took], fit[took] = tried[took], t[better], f[better]
            going[ids[~better]] = False
            if not going.any():
                break
        theta[open_] = now
    pick = theta.argmax(1)
    for i, d in enumerate(there.tolist()):
        names[d] = model.languages[pick[i]]
    scores[there] = theta[np.arange(len(there)), pick]
    shares[there] = theta
    return names, np.clip(scores, 0, 1), shares


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, languages): languages lists the chosen set with proportions, as `de:0.7,en:0.3`."""
    spark = common.prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # 4 * 2**BITS bytes a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            names, scores, sets = [], [], []
            for a, b in textops.groups([t.encode() for t in texts]):
                n, s, shares = infer(m, texts[a:b])
                names += n
                scores += s.tolist()
                sets += [",".join(f"{x}:{p:.3f}" for x, p in zip(m.languages, row, strict=False) if p > 0.005) for row in shares.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.string())], ["doc_id", "lang_pred", "score", "languages"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, languages string")


def op1_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; learnt from the documents whose crc32(doc_id) mod 4 is not 2."""
    docs = common.documents(spark, sf_dir, "doc_id", "text", "lang")
    model = train(docs.where(common.crc_mod("doc_id", 4) != 2))
    found = predict(docs, model)
    return found.select("doc_id", (common.crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "languages")
