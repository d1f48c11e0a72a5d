"""Toxic documents and their sentences by multiple-instance learning.

A document is a bag of sentences (ended by ``. ! ?`` or a line break).  A sentence's
probability is logistic in the words it holds and in how they begin; the document is
toxic if any sentence is: noisy-or, 1 - prod(1 - p).  Only document labels are known,
and the gradient of the document's log loss flows back to its sentences.  The same
weights then say which sentences offend.

Words are runs of letters and digits, A-Z lower-cased.  Features are a word and its
first ``PREFIXES`` bytes, hashed to ``1 << SLOT_BITS`` slots; a slot met in fewer than
``MIN_DOCS`` documents of the labelled sample has no weight.  A text without words has
no sentence and scores 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.llm import labelled
from lacuna.llm import textwork as tw

MIN_DOCS, SLOT_BITS, PREFIXES = 8, 20, (4, 5)
EPOCHS, BATCH, RATE, SHRINK = 20, 128, 0.05, 0.1
SAMPLE_ROWS = 10_000
START = -6.0  # log odds of a sentence without weights
SENTENCE_END = np.zeros(256, bool)
SENTENCE_END[[ord(c) for c in ".!?\n"]] = True
SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())])


@dataclass
class Weights:
    weight: np.ndarray  # one for each slot
    bias: float


@dataclass
class Bags:
    """Sentences of a slice and the slots of their words and prefixes."""

    sentence: np.ndarray  # of each feature
    slot: np.ndarray
    start: np.ndarray  # byte range of each sentence
    end: np.ndarray
    doc: np.ndarray  # document of each sentence
    docs: int


def bags(part: tw.Slice) -> Bags:
    found = tw.words(part, tw.NOT_ALNUM)
    n = len(found.start)
    doc = np.repeat(np.arange(part.rows), np.diff(found.bounds))
    # a sentence begins with a document and after any end mark between two words
    marks = np.concatenate([[0], np.cumsum(SENTENCE_END[part.data])])
    new = np.ones(n, bool)
    if n:
        new[1:] = (doc[1:] != doc[:-1]) | (marks[found.start[1:]] > marks[found.end[:-1]])
    begin = np.flatnonzero(new)
    sentence = np.cumsum(new) - 1
    last = np.append(begin[1:], n) - 1 if len(begin) else begin
    of, hashes = [sentence], [found.hashes]
    for length in PREFIXES:
        own = np.flatnonzero(found.end - found.start > length)
        head = np.full(len(own), length, np.uint64)
        for k in range(length):
            head = head * np.uint64(257) + tw.lower_table()[part.data[found.start[own] + k]]
        of.append(sentence[own])
        hashes.append(tw.mix(head))
    slot = (np.concatenate(hashes) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
    # each once in a sentence
    pair = np.unique((np.concatenate(of) << SLOT_BITS) | slot)
    sentence, slot = pair >> SLOT_BITS, pair & ((1 << SLOT_BITS) - 1)
    return Bags(sentence, slot, found.start[begin], found.end[last], doc[begin], part.rows)


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def log_odds(own: Bags, weights: Weights) -> np.ndarray:
    """Of each sentence."""
    return np.bincount(own.sentence, weights.weight[own.slot], len(own.start)) + weights.bias


def noisy_or(own: Bags, z: np.ndarray) -> np.ndarray:
    """1 - prod(1 - p) by document, from the sentences' log odds."""
    return -np.expm1(-np.bincount(own.doc, _softplus(z), own.docs))


def fit(texts: pa.Array, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> Weights:
    """Weights fitted on texts and their 0/1 labels; without texts nothing is toxic."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(labels))
    batches, seen = [], np.zeros(1 << SLOT_BITS, np.int32)
    for a in range(0, len(order), BATCH):
        chosen = order[a : a + BATCH]
        own = bags(next(tw.slices(texts.take(pa.array(chosen)), 1 << 40)))
        pair = np.unique(own.doc[own.sentence] * np.int64(1 << SLOT_BITS) + own.slot)
        np.add.at(seen, pair & ((1 << SLOT_BITS) - 1), 1)
        batches.append((own, labels[chosen]))
    used = np.flatnonzero(seen >= MIN_DOCS)
    compact = np.full(1 << SLOT_BITS, -1)
    compact[used] = np.arange(len(used))
    for own, _ in batches:
        kept = compact[own.slot] >= 0
        own.sentence, own.slot = own.sentence[kept], compact[own.slot[kept]]
    weights = Weights(np.zeros(len(used)), START)
    mean, square = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    step = 0
    for epoch in range(epochs):
        for k in rng.permutation(len(batches)):
            own, y = batches[k]
            z = log_odds(own, weights)
            total = np.bincount(own.doc, _softplus(z), own.docs)
            p = -np.expm1(-total)
            # d loss / d total: 1 for a clean document, -(1-p)/p for a toxic one
            back = np.where(y == 1, -(1 - p) / np.maximum(p, 1e-9), 1.0) / len(y)
            dz = back[own.doc] / (1 + np.exp(-np.maximum(z, -500)))
            grad = np.append(np.bincount(own.slot, dz[own.sentence], len(used)), dz.sum())
            step += 1
            mean += 0.1 * (grad - mean)
            square += 0.001 * (grad * grad - square)
            rate = RATE * (1 - epoch / epochs)
            move = rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
            # soft threshold: weights that the labels don't ask for go to zero
            moved = weights.weight - move[:-1]
            weights.weight = np.sign(moved) * np.maximum(np.abs(moved) - rate * SHRINK, 0)
            weights.bias -= move[-1]
    if len(labels) == 0:
        weights.bias = -40.0
    table = np.zeros(1 << SLOT_BITS, np.float32)
    table[used] = weights.weight
    return Weights(table, weights.bias)


def train(docs: DataFrame, labels: DataFrame, learnable: Column, label: str = "toxic", rows: int = SAMPLE_ROWS) -> Weights:
    """Weights fitted on a bounded sample of the labelled rows that are ``learnable``."""
    return fit(*labelled.sample(docs, labels, label, learnable, rows))


def score(docs: DataFrame, weights: Weights, text: str = "text", into: str = "score", spans: str = "sentences", least: float = 0.3) -> DataFrame:
    """``docs`` with the document's probability in ``into`` and in ``spans`` the
    sentences of probability ``least`` or more: start and end (exclusive) in code
    points, and the probability.  Columns of these names are replaced.
    """
    tw.prepare(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name not in (into, spans)]
    kind = T.ArrayType(T.StructType.fromDDL("start int, end int, probability double"))
    schema = T.StructType([*kept, T.StructField(into, T.DoubleType(), False), T.StructField(spans, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, found, ends = [np.zeros(0)], [], [np.zeros(1, int)]
            for part in tw.slices(batch.column(text)):
                own = bags(part)
                z = log_odds(own, weights)
                scores.append(noisy_or(own, z))
                hit = np.flatnonzero(z >= np.log(least / (1 - least)))
                ends.append(ends[-1][-1] + np.cumsum(np.bincount(own.doc[hit], minlength=part.rows)))
                if len(hit):
                    points = tw.code_points(part.data)
                    begin = points[part.offsets[own.doc[hit]]]
                    values = (points[own.start[hit]] - begin, points[own.end[hit]] - begin)
                    found.append((*values, 1 / (1 + np.exp(-z[hit]))))
            flat = [np.concatenate(x) if found else np.zeros(0) for x in (zip(*found) if found else ((), (), ()))]
            fields = [pa.array(x).cast(f.type) for x, f in zip(flat, SPAN)]
            table = pa.ListArray.from_arrays(pa.array(np.concatenate(ends), pa.int32()), pa.StructArray.from_arrays(fields, fields=list(SPAN)))
            columns = [*(batch.column(f.name) for f in kept), pa.array(np.concatenate(scores)), table]
            yield pa.RecordBatch.from_arrays(columns, [*(f.name for f in kept), into, spans])

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)
