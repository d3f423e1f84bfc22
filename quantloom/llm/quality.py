"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded in ``DIM`` numbers; ``FILTERS`` learned filters of ``WIDTH`` bytes slide over
every position of the document. The document is covered by chunks of ``CHUNK`` bytes that
overlap by half; each filter is max-pooled within each chunk (after a rectifier), and the
chunks' vectors are combined by their maximum and their mean, which a logistic unit turns into
one probability. Embedding times filter is folded into ``WIDTH`` tables of 256 rows, so that
scoring is table look-ups and sums; since pooling passes gradients to the largest positions
only, training touches few positions.

Training uses at most ``TRAIN_DOCS`` rows of labels (a parameter of :func:`learn`), those with
the smallest hash of their id, with the whole texts of their documents, on the driver.

Defined cases: a null text counts as empty; an empty text is one window of padding and gets a
score; very long texts are trained on and scored whole; labels that are null or not 0 or 1 are
not used, a repeated label counts once, two different labels of a document both count; of
several texts under one id the one with the smallest hash is trained on; without labels every
score is 0.5; repeated rows each get their row; an empty table gives none; a column named score
is replaced, others pass through. Ids of any type will do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.llm._common import raw, small

WIDTH, DIM, FILTERS, CHUNK = 5, 6, 16, 256
TRAIN_DOCS = 2400
EPOCHS, BATCH, RATE, SEED = 10, 24, 0.01, 5
THRESHOLD = 0.3
_HALF = CHUNK // 2
#: Bytes whose filter responses are in memory together (4 * FILTERS bytes each).
_SLAB = 256 * _HALF


class Layout:
    """Texts side by side, each padded with zeros to whole half-chunks, WIDTH - 1 at least."""

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(t) for t in texts], np.int64)
        halves = (sizes + WIDTH - 1) // _HALF + 1
        self.halves, self.first = halves, np.cumsum(halves) - halves
        self.bytes = np.zeros(int(halves.sum()) * _HALF + WIDTH, np.uint8)
        self.valid = np.zeros(int(halves.sum()) * _HALF, bool)
        for at, text, n in zip((self.first * _HALF).tolist(), texts, sizes.tolist(), strict=True):
            self.bytes[at : at + n] = np.frombuffer(text, np.uint8)
            self.valid[at : at + max(1, n)] = True


class ByteNet:
    def __init__(self, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.embed = random.normal(0, 1, (256, DIM)).astype(np.float32)
        self.filters = random.normal(0, 1 / np.sqrt(WIDTH * DIM), (WIDTH, DIM, FILTERS)).astype(np.float32)
        self.shift = np.zeros(FILTERS, np.float32)
        self.out = np.zeros(2 * FILTERS, np.float32)
        self.bias = np.zeros(1, np.float32)

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.shift, self.out, self.bias]

    def _tables(self) -> np.ndarray:
        return np.einsum("bd,wdf->wbf", self.embed, self.filters)

    def _halves(self, x: Layout, places: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Largest response of each filter in each half-chunk, and its position."""
        tables, n = self._tables(), len(x.valid)
        most = np.empty((n // _HALF, FILTERS), np.float32)
        where = np.empty((n // _HALF, FILTERS), np.int64) if places else None
        for at in range(0, n, _SLAB):
            end = min(n, at + _SLAB)
            response = tables[0].take(x.bytes[at:end], axis=0)
            for j in range(1, WIDTH):
                response += tables[j].take(x.bytes[at + j : end + j], axis=0)
            response[~x.valid[at:end]] = -np.inf
            response = response.reshape(-1, _HALF, FILTERS)
            own = slice(at // _HALF, end // _HALF)
            most[own] = response.max(axis=1)
            if places:
                where[own] = response.argmax(axis=1) + (np.arange(own.start, own.stop) * _HALF)[:, None]
        return most, where

    def features(self, x: Layout, places: bool = False):
        """(texts, 2 * FILTERS): maximum and mean over chunks. A chunk is two neighbouring halves."""
        most, where = self._halves(x, places)
        last = np.zeros(len(most), bool)
        last[x.first + x.halves - 1] = True
        following = np.vstack([most[1:], np.full((1, FILTERS), -np.inf, np.float32)])
        following[last] = -np.inf
        chunk = np.maximum(most, following)
        # The last half alone makes no chunk of its own, unless the text has only one half.
        counted = ~last
        counted[x.first[x.halves == 1]] = True
        live = np.maximum(chunk + self.shift, 0) * counted[:, None]
        n = np.maximum(1, x.halves - 1)
        top = np.maximum.reduceat(live, x.first, axis=0)
        mean = np.add.reduceat(live, x.first, axis=0) / n[:, None]
        if not places:
            return np.hstack([top, mean])
        picked = np.where(following > most, np.vstack([where[1:], where[-1:]]), where)
        return np.hstack([top, mean]), live, picked, n

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        z = self.features(Layout(texts)) @ self.out + self.bias[0]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -50, 50)))

    def gradients(self, texts: list[bytes], wanted: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        x = Layout(texts)
        both, live, picked, n = self.features(x, places=True)
        p = 1 / (1 + np.exp(-np.clip(both @ self.out + self.bias[0], -50, 50)))
        error = ((p - wanted) * weight / len(texts)).astype(np.float32)
        owner = np.repeat(np.arange(len(texts)), x.halves)
        to_top, to_mean = error[:, None] * self.out[:FILTERS], error[:, None] * self.out[FILTERS:]
        top = both[:, :FILTERS][owner]
        is_top = (live == top) & (live > 0)
        ties = np.maximum(1, np.add.reduceat(is_top.astype(np.float32), x.first, axis=0))[owner]
        back = np.where(live > 0, to_mean[owner] / n[owner][:, None], 0) + np.where(is_top, to_top[owner] / ties, 0)
        rows, cols = np.nonzero(back)
        values, at = back[rows, cols], picked[rows, cols]
        d_embed, d_filters = np.zeros_like(self.embed), np.zeros_like(self.filters)
        for j in range(WIDTH):
            own = np.bincount(x.bytes[at + j].astype(np.int64) * FILTERS + cols, weights=values, minlength=256 * FILTERS).reshape(256, FILTERS).astype(np.float32)
            d_embed += own @ self.filters[j].T
            d_filters[j] = self.embed.T @ own
        return [d_embed, d_filters, back.sum(axis=0).astype(np.float32), both.T.astype(np.float32) @ error, error.sum(keepdims=True)]


def train(texts: list[bytes], wanted: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> ByteNet:
    """Adam on the logistic loss; the rarer label weighs more, by the root of the ratio."""
    net = ByteNet(seed)
    if not len(texts):
        return net
    ones = max(1, int(wanted.sum()))
    zeros = max(1, len(wanted) - ones)
    weight = np.where(wanted == 1, np.sqrt(len(wanted) / 2 / ones), np.sqrt(len(wanted) / 2 / zeros))
    first, second = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights]
    random, step = np.random.default_rng(seed), 0
    net.out += random.normal(0, 0.1, net.out.shape).astype(np.float32)
    for epoch in range(epochs):
        order = random.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            step += 1
            rate = RATE * (0.5 if epoch >= epochs * 0.6 else 1) * (0.4 if epoch >= epochs * 0.85 else 1)
            for w, g, m, v in zip(net.weights, net.gradients([texts[k] for k in own], wanted[own], weight[own]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def learn(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_DOCS) -> ByteNet:
    """Train on at most ``rows`` rows of ``labels`` that ``usable`` (over ``id_col``) allows."""
    own = labels.where(usable & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label")).distinct()
    picked = own.orderBy(F.xxhash64("__id"), "__id", "label").limit(rows)
    texts = docs.select(F.col(id_col).alias("__doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # At most ``rows`` rows are broadcast, and as many texts come back, however often an id is repeated.
    joined = texts.join(F.broadcast(picked), F.col("__doc") == F.col("__id"))
    held = joined.groupBy("__id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).collect()
    held.sort(key=lambda r: (r["__id"], r["label"]))
    return train([r["text"].encode() for r in held], np.array([r["label"] for r in held], np.float32))


def classify(docs: DataFrame, net: ByteNet, text_col: str = "text") -> DataFrame:
    """``docs`` with score, the probability of label 1 (it replaces a column of this name)."""
    rest = [c for c in docs.columns if c != "score"]
    at = rest.index(text_col)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores: list[np.ndarray] = []
            held, size = [], 0
            texts = raw(batch.column(at))
            for k, text in enumerate(texts):
                held.append(text or b"")
                size += len(held[-1])
                if size > 4 << 20 or k == len(texts) - 1:
                    scores.append(net.score(held))
                    held, size = [], 0
            flat = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(flat, pa.float64())], names=[*batch.schema.names, "score"])

    schema = T.StructType([*(docs.schema[c] for c in rest), T.StructField("score", T.DoubleType())])
    return docs.select(*rest).mapInArrow(small(scored), schema)
