"""Quality classifier: a convolutional network over bytes, in numpy.

A text is covered whole by overlapping chunks of 512 bytes. Learned filters slide
over each chunk byte by byte, each filter keeps its largest response, and a small layer turns the
responses of a chunk into features. The mean and the maximum of each feature over all
chunks of the document are combined into one probability.

The network is trained on the driver from a bounded sample: at most `most` labelled
documents of each label and `chunks` evenly spaced chunks of each, picked by a hash
of the id; of rows that repeat a labelled id the smallest text is taken. Scores use the whole text and nothing but the text.

Null texts count as empty; an empty text is scored as a chunk without bytes. Without
labels every score is 0.5, with one label only its smoothed share. Rows that repeat
an id are scored one by one. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from staylens.llm.text_bytes import binaries

CHUNK, STEP = 512, 448
WIDTH, FILTERS, HIDDEN = 8, 64, 16
CHUNKS, MOST = 6, 1500
EPOCHS, BATCH, RATE = 8, 32, 4e-3
GOOD = 0.6  # share of the loss that good documents carry


def byte_codes() -> np.ndarray:
    """A fixed code for each byte, kinds of bytes first; 256 stands for no byte."""
    code = np.random.default_rng(7).normal(0, 0.5, (257, 12)).astype(np.float32)
    byte = np.arange(257)
    kinds = (
        (byte >= 65) & (byte <= 90), (byte >= 97) & (byte <= 122), (byte >= 48) & (byte <= 57),
        (byte == 32) | ((byte >= 9) & (byte <= 13)), (byte >= 128) & (byte < 256),
    )
    for i, kind in enumerate(kinds):
        code[:, i] = kind
    code[256] = 0
    return code


CODE = byte_codes()
DEPTH = CODE.shape[1]


def windows(chunks: np.ndarray) -> np.ndarray:
    """Coded windows of chunks (rows of byte numbers, 256 where there is none)."""
    coded = CODE[chunks].reshape(len(chunks), -1)
    view = np.lib.stride_tricks.sliding_window_view(coded, WIDTH * DEPTH, axis=1)
    return view[:, ::DEPTH]


def chunk_starts(size: int) -> np.ndarray:
    """Starts of overlapping chunks that cover a text of `size` bytes."""
    return np.arange(0, max(1, size - (CHUNK - STEP)), STEP)


def chunk_rows(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    at = starts[:, None] + np.arange(CHUNK)
    rows = np.full(at.shape, 256, np.int16)
    inside = at < len(text)
    rows[inside] = text[at[inside]]
    return rows


@dataclass
class Network:
    filters: np.ndarray
    filter_bias: np.ndarray
    layer: np.ndarray
    layer_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls) -> Network:
        rng = np.random.default_rng(11)
        wide = WIDTH * DEPTH
        return cls(
            rng.normal(0, (2 / wide) ** 0.5, (wide, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32),
            rng.normal(0, (2 / FILTERS) ** 0.5, (FILTERS, HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32),
            np.zeros(2 * HIDDEN, np.float32), np.zeros(1, np.float32),
        )

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.filters, self.filter_bias, self.layer, self.layer_bias, self.out, self.out_bias]

    def responses(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each filter's largest response in each chunk, and where it is."""
        seen = windows(chunks)
        rows, places, wide = seen.shape
        all_ = (np.ascontiguousarray(seen).reshape(-1, wide) @ self.filters).reshape(rows, places, -1)
        at = all_.argmax(axis=1)
        return np.take_along_axis(all_, at[:, None], 1)[:, 0], at

    def features(self, chunks: np.ndarray) -> np.ndarray:
        seen = windows(chunks)
        rows, places, wide = seen.shape
        most = (np.ascontiguousarray(seen).reshape(-1, wide) @ self.filters).reshape(rows, places, -1).max(axis=1)
        return np.tanh(np.maximum(most + self.filter_bias, 0) @ self.layer + self.layer_bias)

    def combined(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Scores of documents whose chunks begin at `first`."""
        count = np.diff(np.append(first, len(features)))[:, None]
        mean = np.add.reduceat(features, first, axis=0) / count
        pooled = np.concatenate([mean, np.maximum.reduceat(features, first, axis=0)], axis=1)
        return 1 / (1 + np.exp(-(pooled @ self.out + self.out_bias).astype(np.float64)))

    def score(self, texts: Iterator[np.ndarray]) -> np.ndarray:
        """Scores of whole texts; chunks of many texts go through together."""
        features, first, rows, held, total = [], [], [], 0, 0
        for text in texts:
            first.append(total)
            starts = chunk_starts(len(text))
            for s in range(0, len(starts), 128):
                rows.append(chunk_rows(text, starts[s : s + 128]))
                held += len(rows[-1])
                if held >= 128:
                    features.append(self.features(np.concatenate(rows)))
                    rows, held = [], 0
            total += len(starts)
        if rows:
            features.append(self.features(np.concatenate(rows)))
        if not first:
            return np.zeros(0)
        return self.combined(np.concatenate(features), np.array(first))


def gradients(net: Network, chunks: np.ndarray, first: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Gradients of the weighted log loss of a batch of documents."""
    raw, at = net.responses(chunks)
    active = np.maximum(raw + net.filter_bias, 0)
    feature = np.tanh(active @ net.layer + net.layer_bias)
    count = np.diff(np.append(first, len(chunks)))
    own = np.repeat(np.arange(len(first)), count)
    mean = np.add.reduceat(feature, first, axis=0) / count[:, None]
    top = np.maximum.reduceat(feature, first, axis=0)
    pooled = np.concatenate([mean, top], axis=1)
    score = 1 / (1 + np.exp(-(pooled @ net.out + net.out_bias)))
    error = ((score - label) * weight / weight.sum()).astype(np.float32)
    d_pooled = error[:, None] * net.out
    is_top = feature == top[own]
    d_feature = d_pooled[own, :HIDDEN] / count[own, None] + d_pooled[own, HIDDEN:] * is_top
    d_sum = d_feature * (1 - feature**2)
    d_active = (d_sum @ net.layer.T) * (active > 0)
    seen = windows(chunks)
    d_filters = np.empty_like(net.filters)
    row = np.arange(len(chunks))
    for f in range(FILTERS):
        d_filters[:, f] = d_active[:, f] @ seen[row, at[:, f]]
    return [d_filters, d_active.sum(0), active.T @ d_sum, d_sum.sum(0), pooled.T @ error, error.sum(keepdims=True)]


def trained(docs: list[tuple[int, list[bytes]]], epochs: int = EPOCHS) -> Network | float:
    """A network from (label, chunks) of documents, or a constant score."""
    label = np.array([q for q, _ in docs], np.float32)
    ones = float(label.sum())
    if not len(docs):
        return 0.5
    if ones in (0.0, float(len(docs))):
        return (ones + 1) / (len(docs) + 2)
    chunks = [
        np.concatenate([chunk_rows(np.frombuffer(c, np.uint8), np.zeros(1, np.int64)) for c in parts])
        for _, parts in docs
    ]
    # a short stretch of a good document is good: texts of any length are seen
    rng = np.random.default_rng(3)
    for good in np.flatnonzero(label == 1)[::2]:
        body = docs[good][1][0]
        start, size = rng.integers(0, max(1, len(body) - 20)), int(rng.integers(5, 200))
        chunks.append(chunk_rows(np.frombuffer(body[start : start + size], np.uint8), np.zeros(1, np.int64)))
    label = np.append(label, np.ones(len(chunks) - len(label), np.float32))
    ones = float(label.sum())
    weight = np.where(label == 1, GOOD / ones, (1 - GOOD) / (len(label) - ones)).astype(np.float32)
    net = Network.fresh()
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights]
    steps = max(epochs * len(label) // BATCH, 300)
    step = 0
    while step < steps:
        order = rng.permutation(len(label))
        for s in range(0, len(order), BATCH):
            batch = order[s : s + BATCH]
            counts = np.array([len(chunks[i]) for i in batch])
            found = gradients(
                net, np.concatenate([chunks[i] for i in batch]), np.cumsum(counts) - counts, label[batch], weight[batch]
            )
            step += 1
            rate = RATE * min(1.0, 2 * (1 - step / (steps + len(order) / BATCH + 1)))
            for w, g, (m, v) in zip(net.weights, found, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def sample_chunks(most: int):
    """At most `most` evenly spaced chunks of each sampled text."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, begin = binaries(batch.column(1))
            parts = []
            for a, b in zip(begin[:-1], begin[1:]):
                starts = chunk_starts(int(b - a))
                picked = starts[np.unique(np.linspace(0, len(starts) - 1, min(most, len(starts))).astype(int))]
                parts.append([data[a + s : min(b, a + s + CHUNK)].tobytes() for s in picked])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(parts, pa.list_(pa.binary()))], names=["label", "chunks"]
            )

    return each


def held_out(id: str) -> Column:
    return F.crc32(F.col(id).cast("string").cast("binary")) % 3 == 1


def fitted(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, most: int = MOST, chunks: int = CHUNKS) -> Network | float:
    """The network for the labelled documents outside the held-out third."""
    docs = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(id)).select(F.col(id).alias("_id"), F.col(label).alias("_label"))
    there = known.join(docs.select(F.col("doc_id").alias("_id")).distinct(), "_id", "left_semi")
    order = F.xxhash64("_id")
    picked = None
    for value in (0, 1):
        part = there.where(F.col("_label") == value).orderBy(order, "_id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    # at most 2 * most rows
    rows = docs.join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select(
        F.col("_label").cast("int").alias("label"), F.coalesce("text", F.lit("")).cast("binary").alias("body"),
        "_id",
    ).groupBy("_id", "label").agg(F.min("body").alias("body")).select("label", "body").mapInArrow(
        sample_chunks(chunks), "label int, chunks array<binary>"
    )
    sample = sorted((r["label"], [bytes(c) for c in r["chunks"]]) for r in rows.collect())
    return trained(sample)


def scores_of(net: Network | float):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = binaries(batch.column(0))
            if isinstance(net, float):
                score = np.full(batch.num_rows, net)
            else:
                score = net.score(data[a:b] for a, b in zip(starts[:-1], starts[1:]))
            yield pa.RecordBatch.from_arrays([pa.array(score), *batch.columns[1:]], names=["_score", *batch.schema.names[1:]])

    return each


def scored(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", most: int = MOST,
    chunks: int = CHUNKS,
) -> DataFrame:
    """id, `held_out`, `score`, `predicted` of every row of `docs`."""
    net = fitted(docs, labels, id, text, label, most, chunks)
    kind = docs.schema[id].dataType.simpleString()
    body = F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body")
    found = docs.select(body, F.col(id).alias("doc_id")).mapInArrow(scores_of(net), f"_score double, doc_id {kind}")
    return found.select(
        F.col("doc_id").alias(id), F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


def accepted(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", most: int = MOST,
    chunks: int = CHUNKS,
) -> DataFrame:
    """The rows of `docs` that the classifier does not reject, with their columns."""
    net = fitted(docs, labels, id, text, label, most, chunks)
    names = [f"c{i}" for i in range(len(docs.columns))]
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields))
    body = F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_body")
    found = docs.select(body, *[F.col(f"`{c}`").alias(n) for n, c in zip(names, docs.columns)]).mapInArrow(
        scores_of(net), f"_score double, {schema}"
    )
    return found.where("_score >= 0.5").select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
