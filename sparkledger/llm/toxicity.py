"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is a logistic model over its
hashed words and word beginnings; a document is toxic unless every sentence is harmless
(noisy-or): 1 - (1 - leak) * prod(1 - p_sentence), over the sentences with a telling feature.
The leak is one probability for the whole document, so that sentences without any such
feature add nothing, however many there are. Only document labels train it. The model is
fitted on a bounded sample of labelled rows, then broadcast (its size is fixed) and applied
to every sentence of every document, which also locates the offending sentences.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import id_and_text, staged, table

#: Hashed features; the model is one 32-bit weight for each.
FEATURE_BITS = 20
#: Bytes of a word's beginning that are features of their own, besides the whole word.
PREFIXES = (4, 5, 6)
#: Bound on the labelled rows of each class that train the model.
SAMPLE_ROWS = 5000
THRESHOLD = 0.3
#: Log-odds of the leak, and of a sentence before its features count, before training.
LEAK = -6.0
BIAS = -11.0
ROUNDS = 80
RATE = 0.5
L1 = 0.05
_SEED = 1009
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".!?\n"]] = True


class Bags(NamedTuple):
    """Features of sentence s: features[offsets[s]:offsets[s+1]]; sentence s is of document
    doc[s] and covers bytes start[s]:end[s] of the block."""

    features: np.ndarray
    offsets: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray


def sentence_bags(block: K.Block) -> Bags:
    """Sentences end at . ! ? or a line end; one without words is left out."""
    words = K.find_words(block, K.ALNUM)
    codes = K.byte_codes(_SEED, True)
    parts = [K.hash_words(block.data, words, codes)]
    for n in PREFIXES:
        cut = words._replace(end=np.minimum(words.end, words.start + n))
        parts.append(K.mix(K.hash_words(block.data, cut, codes) + K.U64(n)))
    features = (np.stack(parts, 1) >> K.U64(64 - FEATURE_BITS)).astype(np.int32)
    doc = K.doc_of(words.offsets)
    breaks = np.cumsum(_BREAK[block.data])
    sentence = breaks[words.start] if len(words.start) else np.empty(0, np.int64)
    new = np.ones(len(doc), bool)
    new[1:] = (sentence[1:] != sentence[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1 if len(first) else first
    return Bags(features.ravel(), np.append(first, len(doc)) * (1 + len(PREFIXES)), doc[first],
                words.start[first], words.end[last])


class Model(NamedTuple):
    """Log-odds of the leak, of a sentence before its features, and each feature's weight."""

    leak: float
    bias: float
    weights: np.ndarray


def fit_bags(features: np.ndarray, sentence: np.ndarray, doc: np.ndarray,
             labels: np.ndarray, weight: np.ndarray) -> Model:
    """The noisy-or model by gradient descent on the documents' log loss, with a step size
    for each feature and soft thresholding (L1).

    features[i] is in sentence[i], which is in document doc[sentence[i]]; sentences without
    a telling feature are not among them."""
    used, index = np.unique(features, return_inverse=True)
    w, bias, leak = np.zeros(len(used)), BIAS, LEAK
    size, bias_size, leak_size = np.full(len(used), 1e-8), 1e-8, 1e-8
    scale = 1.0 / max(weight.sum(), 1e-9)
    for _ in range(ROUNDS):
        z = bias + np.bincount(sentence, w[index], minlength=len(doc))
        harm = np.bincount(doc, np.logaddexp(0, z), minlength=len(labels)) \
            + np.logaddexp(0, leak)
        harm = np.maximum(harm, 1e-6)
        pull = np.where(labels == 1, -np.exp(-harm) / -np.expm1(-harm), 1.0) * weight * scale
        g = pull[doc] / (1 + np.exp(-np.clip(z, -50, 50)))
        grad = np.bincount(index, g[sentence], minlength=len(used))
        size += grad * grad
        step = RATE / np.sqrt(size)
        w -= step * grad
        w = np.sign(w) * np.maximum(np.abs(w) - step * L1 * scale, 0)
        bias_grad = g.sum()
        bias_size += bias_grad * bias_grad
        bias -= RATE * 0.2 * bias_grad / np.sqrt(bias_size)
        leak_grad = pull.sum() / (1 + np.exp(-leak))
        leak_size += leak_grad * leak_grad
        leak -= RATE * 0.2 * leak_grad / np.sqrt(leak_size)
    weights = np.zeros(1 << FEATURE_BITS, np.float32)
    weights[used] = w
    return Model(float(leak), float(bias), weights)


def training_rows(doc_id: Column) -> Column:
    """Rows whose labels may be learned from."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) != 2


def _document_counts(batches: Iterator[pa.RecordBatch]):
    """(feature, toxic, documents) of this partition."""
    counts = np.zeros((2, 1 << FEATURE_BITS), np.int32)
    for block in K.text_blocks(batches, "text"):
        bags = sentence_bags(block)
        doc = np.repeat(bags.doc, np.diff(bags.offsets))
        pairs = np.unique(doc << FEATURE_BITS | bags.features)
        toxic = np.asarray(block.batch.column("toxic"))[pairs >> FEATURE_BITS]
        for y in (0, 1):
            counts[y] += np.bincount(pairs[toxic == y] & ((1 << FEATURE_BITS) - 1),
                                     minlength=1 << FEATURE_BITS).astype(np.int32)
    for y in (0, 1):
        used = np.flatnonzero(counts[y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(np.full(len(used), y, np.int32)),
             pa.array(counts[y][used].astype(np.int64))], names=["feature", "toxic", "n"])


def telling_features(sample: DataFrame, toxic_share: float) -> np.ndarray:
    """Features whose documents are toxic more often than chance allows: their
    log-likelihood ratio is above 1.4 ln(number of features)."""
    counts = sample.mapInArrow(_document_counts, "feature int, toxic int, n long")
    a, c = (F.sum(F.when(F.col("toxic") == y, F.col("n")).otherwise(0)) for y in (1, 0))
    per = counts.groupBy("feature").agg(a.alias("a"), c.alias("c"))
    n = F.col("a") + F.col("c")

    def part(x: str, rate: float) -> Column:
        return F.when(F.col(x) > 0, F.col(x) * F.log(F.col(x) / (n * rate))).otherwise(0.0)

    ratio = 2 * (part("a", toxic_share) + part("c", 1 - toxic_share))
    per = staged(per.select("feature", (F.col("a") > n * toxic_share).alias("more"),
                            ratio.alias("ratio")), "toxic-features")
    total = per.count()
    rows = per.filter(F.col("more") & (F.col("ratio") > 1.4 * math.log(max(total, 2)))) \
        .select("feature").collect()  # at most 2**FEATURE_BITS
    return np.sort(np.array([r.feature for r in rows], np.int32))


def _bags(batches: Iterator[pa.RecordBatch], kept: np.ndarray):
    """Of each document: the telling features and their sentences, numbered from 0."""
    wanted = np.zeros(1 << FEATURE_BITS, bool)
    wanted[kept] = True
    for block in K.text_blocks(batches, "text"):
        bags = sentence_bags(block)
        sentence = K.doc_of(bags.offsets)
        told = wanted[bags.features]
        features, sentence = bags.features[told], sentence[told]
        cut = np.searchsorted(bags.doc[sentence], np.arange(len(block) + 1))
        rows = []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            which, local = np.unique(sentence[a:b], return_inverse=True)
            rows.append((features[a:b].tobytes(), local.astype(np.int32).tobytes(), len(which)))
        yield pa.RecordBatch.from_arrays(
            [block.batch.column("toxic"), K.binary_list([r[0] for r in rows]),
             K.binary_list([r[1] for r in rows]), pa.array([r[2] for r in rows], pa.int64())],
            names=["toxic", "features", "sentence", "marked"])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` labelled documents of each class, whole texts of any
    length; rows of each class are weighted up to their number. A doc_id that carries both
    labels counts as toxic.

    Without labels of both classes the model knows nothing and scores all alike."""
    spark = docs.sparkSession
    nothing = Model(LEAK, BIAS, np.zeros(1 << FEATURE_BITS, np.float32))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col("toxic").cast("int").alias("toxic")) \
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)
                & training_rows(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = [F.xxhash64("doc_id", F.lit(_SEED)), F.col("doc_id")]
    rows = [(r.doc_id, r.toxic) for y in (0, 1) for r in
            known.filter(F.col("toxic") == y).orderBy(*order).limit(sample_rows).collect()]
    if len(totals) < 2:
        return nothing
    wanted = spark.createDataFrame(rows, "doc_id long, toxic int")
    sample = staged(id_and_text(docs).join(F.broadcast(wanted), "doc_id")
                    .select("toxic", "text"), "toxic-sample")  # at most 2 * sample_rows ids are broadcast
    sampled = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(sampled) < 2:
        return nothing
    kept = telling_features(sample, sampled[1] / (sampled[0] + sampled[1]))
    got = sample.mapInArrow(lambda b: _bags(b, kept), "toxic int, features binary, "
                            "sentence binary, marked long").collect()
    y = np.array([r.toxic for r in got])
    marked = np.array([r.marked for r in got])
    first = np.cumsum(marked) - marked
    features = np.concatenate([np.frombuffer(r.features, np.int32) for r in got])
    sentence = np.concatenate([np.frombuffer(r.sentence, np.int32) + f
                               for r, f in zip(got, first, strict=True)])
    weight = np.where(y == 1, totals[1] / sampled[1], totals[0] / sampled[0])
    return fit_bags(features, sentence, np.repeat(np.arange(len(y)), marked), y, weight)


_SCORED = ("doc_id long, score double, "
           "sentences array<struct<start:long,end:long,score:double>>")


def document_scores(block: K.Block, model: Model):
    """Scores of a block's documents, its sentences and their scores (0 for sentences
    without a telling feature)."""
    bags, n = sentence_bags(block), len(block)
    own = model.weights[bags.features].astype(np.float64)
    z, marked = np.empty(0), np.empty(0, bool)
    if len(bags.doc):
        z = model.bias + np.add.reduceat(own, bags.offsets[:-1])
        marked = np.add.reduceat(own != 0, bags.offsets[:-1]) > 0
    harm = np.logaddexp(0, model.leak) + np.bincount(
        bags.doc[marked], np.logaddexp(0, z[marked]), minlength=n)
    return -np.expm1(-harm), bags, np.where(marked, 1 / (1 + np.exp(-np.clip(z, -700, 700))), 0.0)


def _score(batches: Iterator[pa.RecordBatch], model: Model, threshold: float):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                               ("score", pa.float64())]))
    for block in K.text_blocks(batches, "text"):
        scores, bags, p = document_scores(block, model)
        n = len(block)
        located: list[list[dict]] = [[] for _ in range(n)]
        for s in np.flatnonzero(p >= threshold).tolist():
            d = int(bags.doc[s])
            base = block.offsets[d]
            start = len(block.data[base:bags.start[s]].tobytes().decode("utf-8", "replace"))
            end = start + len(block.data[bags.start[s]:bags.end[s]].tobytes()
                              .decode("utf-8", "replace"))
            located[d].append({"start": start, "end": end, "score": float(p[s])})
        yield pa.RecordBatch.from_arrays(
            [block.batch.column("doc_id"), pa.array(scores), pa.array(located, kind)],
            names=["doc_id", "score", "sentences"])


def score_toxicity(docs: DataFrame, model: Model,
                   threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, score, predicted, and the offending sentences (code point
    spans and scores of at least ``threshold``).

    A null or empty text, or one without words, scores the leak alone.
    Rows that repeat a doc_id are scored one by one; a null doc_id stays null. Nothing but
    the text is read."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))  # fixed size

    def score(batches):
        return _score(batches, Model(*sent.value), threshold)

    return id_and_text(docs).mapInArrow(score, _SCORED).select(
        "doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
        "sentences")


def without_toxic(docs: DataFrame, model: Model,
                  threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below ``threshold``."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))  # fixed size

    def keep(batches):
        for block in K.text_blocks(batches, "text"):
            scores, _, _ = document_scores(block, Model(*sent.value))
            yield block.batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(keep, docs.schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (~training_rows(F.col("doc_id"))).alias("held_out"),
                         "score", "predicted", "sentences")
