"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes ratios.

A document's features are, for every n-gram of letters (with the ends of words as letters),
the number of its distinct words that have it, over the root of the number of its distinct
words. Each is scaled by the logarithm of how much more often toxic documents have it than
others (naive Bayes), and a logistic regression is fitted on the scaled features. As the score
is linear in the features, it is a sum over a document's distinct words, of which each batch
computes every one once.

The classifier is fitted on at most ``FIT_DOCS`` labelled documents with at most ``FIT_BYTES`` of text
together (or one longer document), chosen by a hash of their ids, in one task; every document is
scored over its whole text, a very long one at about 100 bytes of memory a character.

Rows: a null or empty text, or one without letters, has the score of no words at all; a document
with several labels counts as toxic if one says so; a null ``doc_id`` has no label; repeated
rows are scored alike; no labels of one class, or none at all: every score is the share of
toxic labels, or 0; an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.arrowtext import slices
from rillflow.llm.common import stored
from rillflow.llm.letters import distinct, grams, letter_words

#: Labelled documents that the classifier is fitted on, at most.
FIT_DOCS = 6_000
#: Bytes of their texts, at most.
FIT_BYTES = 64 << 20
ORDERS = (2, 3, 4, 5)
#: Slots per order, as a power of two: the model has 4 times 65,536 weights.
BITS = 16
ROUNDS = 60
RATE = 0.2
THRESHOLD = 0.7


def _word_docs(texts: pa.Array):
    """The distinct words of a batch, and the pairs (text, distinct word), each pair once."""
    w, _ = letter_words(texts)
    d = distinct(w)
    pairs = np.unique(w.of_text() * np.int64(len(d.first)) + d.of_word)
    return d, pairs // len(d.first), pairs % len(d.first)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, slot, value), in the order of the texts, each pair of text and slot once."""
    d, text, word = _word_docs(texts)
    n_words = np.bincount(text, minlength=len(texts))
    keys = []
    for k, n in enumerate(ORDERS):
        of, slot = grams(d, n, BITS)
        first = np.searchsorted(of, np.arange(len(d.first)))
        count = np.diff(first)[word]
        at = np.repeat(first[:-1][word] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        keys.append((np.repeat(text, count) * len(ORDERS) + k << BITS) + slot[at])
    key, times = np.unique(np.concatenate(keys), return_counts=True)
    text = key >> BITS
    slot = key - ((text // len(ORDERS)) * len(ORDERS) << BITS)
    text //= len(ORDERS)
    return text, slot, times / np.sqrt(np.maximum(n_words, 1))[text]


def fit(text: np.ndarray, slot: np.ndarray, value: np.ndarray, toxic: np.ndarray, strength: float = 10.0):
    """(weights by slot, bias) of the regression on scaled features: (text, slot, value) as
    from ``features``, ``toxic`` a 0 or 1 per text."""
    size = len(ORDERS) << BITS
    share = float(toxic.mean()) if len(toxic) else 0.0
    if share in (0.0, 1.0):
        eps = 1e-6
        return np.zeros(size, np.float32), float(np.log(max(share, eps) / max(1 - share, eps)))
    is_toxic = toxic[text] == 1
    here = value > 0
    p = 1 + np.bincount(slot[is_toxic & here], minlength=size)
    q = 1 + np.bincount(slot[~is_toxic & here], minlength=size)
    ratio = np.log((p / (toxic.sum() + 2)) / (q / (len(toxic) - toxic.sum() + 2)))
    x = value * ratio[slot]
    # Adam on the whole sample, with the classes weighing the same
    weight = np.where(toxic == 1, 0.5 / share, 0.5 / (1 - share)) / len(toxic)
    w, b = np.zeros(size), 0.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, ROUNDS + 1):
        z = np.bincount(text, x * w[slot], minlength=len(toxic)) + b
        err = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - toxic)
        g = np.bincount(slot, x * err[text], minlength=size) + strength * 1e-4 * w
        gb = err.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        a, c = 1 - 0.9 ** t, 1 - 0.99 ** t
        w -= RATE * (m / a) / (np.sqrt(v / c) + 1e-8)
        b -= RATE * (mb / a) / (np.sqrt(vb / c) + 1e-8)
    return (w * ratio).astype(np.float32), float(b)


def fit_and_place(text: np.ndarray, slot: np.ndarray, value: np.ndarray, toxic: np.ndarray):
    """``fit``, with the scale set so that ``THRESHOLD`` is where the two classes part best.

    That place is found on a fifth of the documents, by a classifier fitted on the others: the
    middle of the cut with the fewest errors, errors on either class weighing as its documents.
    """
    n = len(toxic)
    held = np.arange(n) % 5 == 4
    w, b = fit(text, slot, value, toxic)
    if min(toxic[held].sum(), toxic[~held].sum(), (1 - toxic[held]).sum(), (1 - toxic[~held]).sum()) < 5:
        return w, b
    rows = ~held[text]
    w1, b1 = fit(np.cumsum(~held)[text[rows]] - 1, slot[rows], value[rows], toxic[~held])
    z = (np.bincount(text, value * w1[slot], minlength=n) + b1)[held]
    order = np.argsort(z)
    z, y = z[order], toxic[held][order]
    missed = np.concatenate([[0], np.cumsum(y)])  # below the cut, toxic
    wrong = (1 - y).sum() - np.concatenate([[0], np.cumsum(1 - y)])  # above it, not toxic
    errors = missed + wrong
    best = np.flatnonzero(errors == errors.min())
    edges = np.concatenate([[z[0] - 1], z, [z[-1] + 1]])
    cut = (edges[best[0]] + edges[best[-1] + 1]) / 2
    steep = 2.0
    return (w * steep).astype(np.float32), float((b - cut) * steep + np.log(THRESHOLD / (1 - THRESHOLD)))


def scores(texts: pa.Array, weights: np.ndarray, bias: float) -> np.ndarray:
    """The chance of being toxic for each text."""
    d, text, word = _word_docs(texts)
    of_word = np.zeros(len(d.first) - 1)
    for k, n in enumerate(ORDERS):
        of, slot = grams(d, n, BITS)
        of_word += np.bincount(of, weights[(k << BITS) + slot], minlength=len(of_word))
    n_words = np.bincount(text, minlength=len(texts))
    z = np.bincount(text, of_word[word], minlength=len(texts)) / np.sqrt(np.maximum(n_words, 1)) + bias
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> tuple[np.ndarray, float]:
    """Weights and bias, from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    The labelled ids are chosen first, the ``fit_docs`` with the smallest hashes, so that the
    texts of no others are moved; their documents meet in one task.
    """
    one = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs)
    texts = docs.select(F.col("doc_id").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id") \
        .groupBy("doc_id", "toxic").agg(F.max("text").alias("text"))
    texts = _within(stored(texts, "toxicity_sample"), FIT_BYTES)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id", ignore_index=True)
        toxic = rows["toxic"].clip(0, 1).to_numpy(np.int64)
        parts, at = [], 0
        for part in slices(pa.RecordBatch.from_pandas(rows[["text"]])):
            text, slot, value = features(part.column("text"))
            parts.append((text + at, slot.astype(np.int32), value.astype(np.float32)))
            at += part.num_rows
        weights, bias = fit_and_place(*(np.concatenate(x) for x in zip(*parts)), toxic)
        return pd.DataFrame({"weights": [weights.tobytes()], "bias": [bias]})

    model = texts.groupBy(F.lit(0).alias("one")).applyInPandas(run, "weights binary, bias double").first()
    if model is None:
        return np.zeros(len(ORDERS) << BITS, np.float32), -13.8
    return np.frombuffer(model.weights, np.float32), model.bias


def _within(texts: DataFrame, most: int) -> DataFrame:
    """The documents of the sample, in the order they were chosen in, as far as their texts have at most
    ``most`` bytes; at least one. What the driver sees is a number for each document of the sample."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sizes = texts.orderBy(*order).select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")).collect()
    upto = np.cumsum([r.n for r in sizes])
    if not len(upto) or upto[-1] <= most:
        return texts
    few = sizes[:max(1, int(np.searchsorted(upto, most, side="right")))]
    return texts.join(F.broadcast(texts.sparkSession.createDataFrame([(r.doc_id,) for r in few], "doc_id bigint")), "doc_id")


def score_documents(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores(part.column("text"), weights, bias))],
                                                 names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, score double")


def held_out(column: str = "doc_id"):
    """Whether a document is kept from the classifier, by the checksum of its id."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 3 == 1, F.lit(False))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").filter(~held_out())
    out = score_documents(docs, *train(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
