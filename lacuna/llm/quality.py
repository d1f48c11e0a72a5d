"""Quality of documents by a byte-level convolutional network in numpy.

The whole document is cut into chunks of ``CHUNK`` window starts; windows are
``WIDTH`` bytes, so neighbouring chunks overlap by a window.  A filter has a weight
for every byte value at every window position, and a second input channel that says at
which distance (up to ``LAGS``) the four bytes from here occurred before, which is what
makes stuttering text visible.  Filter responses are rectified and max-pooled over a
chunk; the document is the maximum and the mean over its chunks, and a last layer
combines both into one probability.  Filters and last layer are learned together by
Adam on the log loss; the gradient of a maximum goes to its window alone.

Null and empty texts are one empty chunk and get the probability of the last layer's
bias.  Scoring works on slices of whole documents and never looks at other columns.
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

WIDTH, STRIDE, CHUNK, FILTERS, LAGS = 8, 2, 256, 8, 24
EPOCHS, BATCH, RATE, SHRINK = 6, 48, 0.01, 1e-5
_SLICE = 1 << 18


@dataclass
class Network:
    byte: np.ndarray  # WIDTH x 256 x FILTERS
    lag: np.ndarray  # WIDTH x (LAGS + 1) x FILTERS
    bias: np.ndarray  # FILTERS
    out: np.ndarray  # 2 * FILTERS + 1, the last is the bias


@dataclass
class Laid:
    """A slice laid out so that every document fills whole chunks."""

    data: np.ndarray
    lag: np.ndarray
    starts: np.ndarray  # window starts that lie in a document
    chunk: np.ndarray  # first of ``starts`` in each chunk that has some
    full: np.ndarray  # chunk numbers of ``chunk``
    first: np.ndarray  # first chunk of each document
    count: np.ndarray  # chunks of each document


def lay_out(part: tw.Slice) -> Laid:
    sizes = np.diff(part.offsets)
    count = (sizes + WIDTH) // CHUNK + 1
    first = np.concatenate([[0], np.cumsum(count)])
    data = np.zeros(first[-1] * CHUNK + WIDTH, np.uint8)
    begin = first[:-1] * CHUNK
    where = np.arange(len(part.data)) + np.repeat(begin - part.offsets[:-1], sizes)
    data[where] = part.data
    four = data[:-3].astype(np.uint32)
    for k in range(1, 4):
        four |= data[k : len(data) - 3 + k].astype(np.uint32) << np.uint32(8 * k)
    lag = np.zeros(len(data), np.uint8)
    for k in range(LAGS, 1, -1):
        same = (four[k:] == four[:-k]) & (four[k:] != 0)
        lag[k : len(four)][same] = k
    inside = np.zeros(len(data), bool)
    inside[where] = True
    starts = np.arange(0, first[-1] * CHUNK, STRIDE)
    starts = starts[inside[starts]]
    full, chunk = np.unique(starts // CHUNK, return_index=True)
    return Laid(data, lag, starts, chunk, full, first[:-1], count)


def pool(net: Network, laid: Laid, winners: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Chunk maxima of the rectified responses, and the window starts that reach them."""
    at = laid.starts
    maxima = np.zeros((laid.first[-1] + laid.count[-1], FILTERS), np.float32)
    if not len(at):
        return maxima, np.full(maxima.shape, -1) if winners else None
    found = net.byte[0][laid.data[at]]
    for k in range(1, WIDTH):
        found += net.byte[k].take(laid.data[at + k], axis=0)
    for k in range(0, WIDTH, 2):
        found += net.lag[k].take(laid.lag[at + k], axis=0)
    found += net.bias
    own = np.maximum.reduceat(found, laid.chunk, axis=0)
    maxima[laid.full] = np.maximum(own, 0)
    if not winners:
        return maxima, None
    best = np.full(maxima.shape, -1)
    ends = np.append(laid.chunk[1:], len(at))
    for c, a, b in zip(laid.full, laid.chunk, ends):
        best[c] = at[a + found[a:b].argmax(axis=0)]
    best[maxima <= 0] = -1
    return maxima, best


def _features(maxima: np.ndarray, laid: Laid) -> np.ndarray:
    top = np.maximum.reduceat(maxima, laid.first, axis=0)
    mean = np.add.reduceat(maxima, laid.first, axis=0) / laid.count[:, None]
    return np.concatenate([top, mean, np.ones((len(top), 1), np.float32)], axis=1)


def probabilities(net: Network, part: tw.Slice) -> np.ndarray:
    laid = lay_out(part)
    maxima, _ = pool(net, laid)
    return 1 / (1 + np.exp(-(_features(maxima, laid).astype(np.float64) @ net.out)))


def fit(texts: pa.Array, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Network fitted on texts and their 0/1 labels; without texts all scores are 0.5."""
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32),
        rng.normal(0, 0.1, (WIDTH, LAGS + 1, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        np.zeros(2 * FILTERS + 1),
    )
    if len(texts) == 0:
        return net
    net.out[: 2 * FILTERS] = rng.normal(0, 0.2, 2 * FILTERS)
    share = np.clip(labels.mean(), 0.01, 0.99)
    net.out[-1] = np.log(share / (1 - share))
    params = (net.byte, net.lag, net.bias, net.out)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        rate = RATE * (1 - epoch / epochs)
        for a in range(0, len(order), BATCH):
            own = order[a : a + BATCH]
            part = next(tw.slices(texts.take(pa.array(own)), 1 << 40))
            laid = lay_out(part)
            maxima, best = pool(net, laid, True)
            x = _features(maxima, laid)
            wrong = 1 / (1 + np.exp(-(x @ net.out))) - labels[own]
            back = wrong[:, None] * net.out[None, :-1] / len(own)
            doc = np.repeat(np.arange(len(own)), laid.count)
            to_chunk = back[:, FILTERS:][doc] / laid.count[doc, None]
            to_chunk += np.where(maxima == x[doc, :FILTERS], back[:, :FILTERS][doc], 0)
            chunk, filt = np.nonzero(best >= 0)
            at, g = best[chunk, filt], to_chunk[chunk, filt].astype(np.float32)
            grads = [np.zeros_like(p) for p in params]
            for k in range(WIDTH):
                np.add.at(grads[0], (k, laid.data[at + k], filt), g)
                if k % 2 == 0:
                    np.add.at(grads[1], (k, laid.lag[at + k], filt), g)
            np.add.at(grads[2], filt, g)
            grads[3] = x.T.astype(np.float64) @ wrong / len(own)
            step += 1
            for p, grad, (m, v) in zip(params, grads, moments):
                grad += SHRINK * p
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def train(docs: DataFrame, labels: DataFrame, learnable: Column, label: str = "quality", rows: int = labelled.SAMPLE_ROWS) -> Network:
    """Network fitted on a bounded sample of the labelled rows that are ``learnable``."""
    return fit(*labelled.sample(docs, labels, label, learnable, rows))


def score(docs: DataFrame, net: Network, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in the column ``into``."""
    tw.prepare(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name != into]
    schema = T.StructType([*kept, T.StructField(into, T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [probabilities(net, part) for part in tw.slices(batch.column(text), _SLICE)]
            scores = pa.array(np.concatenate([np.zeros(0), *found]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), scores], [*(f.name for f in kept), into]
            )

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(tw.tidy(run), schema)
