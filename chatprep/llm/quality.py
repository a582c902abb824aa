"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.7
#: Bytes of a chunk, and between the starts of two chunks, which so overlap.
CHUNK = 256
STEP = 224
#: Filters, their width and step in bytes, numbers per byte, hidden units of a chunk.
FILTERS = 64
WIDTH = 8
STRIDE = 4
EMBEDDING = 8
HIDDEN = 16
#: Labelled documents per class and chunks per document that the network is fitted to.
PER_CLASS = 1500
CHUNKS_PER_DOCUMENT = 6
EPOCHS = 6
#: Chunks that are convolved at a time.
BATCH = 256

_POSITIONS = (CHUNK - WIDTH) // STRIDE + 1


def chunks_of(text: str) -> np.ndarray:
    """Overlapping chunks that cover all bytes of a text; the last one is filled with zeros."""
    content = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    number = max(1, -(-max(0, len(content) - CHUNK) // STEP) + 1)
    padded = np.zeros((number - 1) * STEP + CHUNK, dtype=np.uint8)
    padded[: len(content)] = content
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


@dataclass
class ByteNetwork:
    """Filters over embedded bytes, max-pooled per chunk; a hidden layer gives each chunk a logit,
    and the mean over the document's chunks its probability."""

    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def initial(seed: int = 7) -> ByteNetwork:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        return ByteNetwork(
            normal(256, EMBEDDING, scale=1.0),
            normal(WIDTH * EMBEDDING, FILTERS, scale=(WIDTH * EMBEDDING) ** -0.5),
            np.zeros(FILTERS, dtype=np.float32),
            normal(FILTERS, HIDDEN, scale=FILTERS**-0.5),
            np.zeros(HIDDEN, dtype=np.float32),
            normal(HIDDEN, scale=HIDDEN**-0.5),
            np.zeros(1, dtype=np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [
            self.embedding, self.filters, self.bias, self.hidden, self.hidden_bias, self.out,
            self.out_bias,
        ]

    def patches(self, chunks: np.ndarray) -> np.ndarray:
        """What each filter position sees: ``(chunks, positions, width * embedding)``."""
        embedded = self.embedding[chunks].reshape(len(chunks), CHUNK * EMBEDDING)
        views = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH * EMBEDDING, axis=1)
        return views[:, :: STRIDE * EMBEDDING]

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Max-pooled filter outputs of each chunk and the positions they come from."""
        seen = np.ascontiguousarray(self.patches(chunks)).reshape(-1, WIDTH * EMBEDDING)
        values = (seen @ self.filters).reshape(len(chunks), _POSITIONS, FILTERS)
        return values.max(axis=1), values

    def logits(self, chunks: np.ndarray) -> np.ndarray:
        found = []
        for at in range(0, len(chunks), BATCH):
            top = np.maximum(self.pooled(chunks[at : at + BATCH])[0] + self.bias, 0)
            found.append(np.tanh(top @ self.hidden + self.hidden_bias) @ self.out + self.out_bias)
        return np.concatenate(found)

    def score(self, text: str) -> float:
        mean = float(np.mean(self.logits(chunks_of(text)), dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(mean, -30, 30))))

    def gradients(
        self, chunks: np.ndarray, document: np.ndarray, labels: np.ndarray, weights: np.ndarray
    ) -> list[np.ndarray]:
        """Gradients of the weighted log loss; only the pooled positions carry any."""
        top, values = self.pooled(chunks)
        places = values.argmax(axis=1)
        active = np.maximum(top + self.bias, 0)
        hidden = np.tanh(active @ self.hidden + self.hidden_bias)
        size = np.bincount(document, minlength=len(labels)).astype(np.float32)
        logit = np.bincount(document, hidden @ self.out + self.out_bias, len(labels)) / size
        error = (1 / (1 + np.exp(-logit)) - labels) * weights / weights.sum()
        per_chunk = (error / size)[document].astype(np.float32)
        d_hidden = per_chunk[:, None] * self.out * (1 - hidden**2)
        d_active = (d_hidden @ self.hidden.T) * (active > 0)
        starts = places[:, :, None] * STRIDE + np.arange(WIDTH)
        seen = chunks[np.arange(len(chunks))[:, None, None], starts]
        patch = self.embedding[seen].reshape(len(chunks), FILTERS, WIDTH * EMBEDDING)
        d_filters = np.einsum("cf,cfk->kf", d_active, patch, optimize=True)
        d_patch = d_active[:, :, None] * self.filters.T
        d_bytes, flat = d_patch.reshape(-1, EMBEDDING), seen.ravel()
        d_embedding = np.stack(
            [np.bincount(flat, d_bytes[:, i], 256) for i in range(EMBEDDING)], axis=1
        ).astype(np.float32)
        return [
            d_embedding, d_filters, d_active.sum(axis=0), active.T @ d_hidden,
            d_hidden.sum(axis=0), hidden.T @ per_chunk, per_chunk.sum(keepdims=True),
        ]


def shortened(chunks: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """One of the chunks, cut to a random length like a short text."""
    chunk = chunks[rng.integers(len(chunks))].copy()
    chunk[rng.integers(16, CHUNK) :] = 0
    return chunk[None]


def fit(
    documents: list[tuple[np.ndarray, int]], share: float, epochs: int = EPOCHS, seed: int = 7
) -> ByteNetwork:
    """A network fitted by Adam to ``(chunks, label)`` pairs.

    Those of label 1 are also seen as short texts: few bytes are no evidence against a text.

    ``share`` is that of label 1 among all labels; the classes are weighted to it, so that scores
    are probabilities whatever sample was drawn.
    """
    network = ByteNetwork.initial(seed)
    if not documents:
        return network
    draw = np.random.default_rng(seed)
    documents = documents + [(shortened(c, draw), label) for c, label in documents if label == 1]
    labels = np.array([label for _, label in documents], dtype=np.float32)
    drawn = np.clip(np.array([np.mean(labels == 0), np.mean(labels == 1)]), 1e-6, None)
    wanted = np.array([1 - share, share])
    weight = (wanted / drawn)[labels.astype(int)].astype(np.float32)
    rng = np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in network.parameters()]
    second = [np.zeros_like(p) for p in network.parameters()]
    step, per_batch = 0, 32
    total = epochs * -(-len(documents) // per_batch)
    for _ in range(epochs):
        order = rng.permutation(len(documents))
        for at in range(0, len(order), per_batch):
            picked = order[at : at + per_batch]
            chunks = np.concatenate([documents[i][0] for i in picked])
            document = np.repeat(np.arange(len(picked)), [len(documents[i][0]) for i in picked])
            slopes = network.gradients(chunks, document, labels[picked], weight[picked])
            step += 1
            rate = 3e-3 * (1 - (step - 1) / total)
            for p, g, m, v in zip(network.parameters(), slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return network


def _chosen_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            chunks = chunks_of(text.as_py() or "")
            spread = np.unique(np.linspace(0, len(chunks) - 1, CHUNKS_PER_DOCUMENT).astype(int))
            rows.append(chunks[spread].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), pa.array(rows, pa.binary())],
            names=["id", "label", "chunks"],
        )


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    folds: int = 4,
    held_out: int = 2,
    per_class: int = PER_CLASS,
) -> ByteNetwork:
    """A network fitted to about ``per_class`` labelled documents of each class.

    They are chosen by a hash of the identifier among those whose ``crc32(doc_id) % folds`` is not
    ``held_out``; the bound also bounds what is broadcast and what the driver gets, which is
    ``CHUNKS_PER_DOCUMENT`` chunks, spread evenly, of each. Of rows that share an identifier, the one
    with the least chunks in byte order teaches. Rows with a null or other label than 0
    and 1, or without a document, teach nothing. If nothing is left, or one class only, the scores
    are those of an unfitted network or of that class.
    """
    fold = F.crc32(F.col(id_column).cast("string")) % folds
    rows = labels.where(fold != held_out).select(
        F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label")
    ).where(F.col("label").isin(0, 1))
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("label") == 1, per_class / counts.get(1, 1)).otherwise(per_class / counts.get(0, 1))
    picked = F.pmod(F.xxhash64("id"), F.lit(1_000_003)) < share * 1_000_003
    sample = rows.where(picked).distinct()
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()
    found = (
        texts.join(F.broadcast(sample), "id")
        .mapInArrow(_chosen_chunks, f"id {kind}, label int, chunks binary")
        .groupBy("id", "label")
        .agg(F.min("chunks").alias("chunks"))
        .collect()
    )
    found.sort(key=lambda r: (r.id, r.label, bytes(r.chunks)))
    pairs = [(np.frombuffer(bytes(r.chunks), np.uint8).reshape(-1, CHUNK), r.label) for r in found]
    return fit(pairs, counts.get(1, 0) / max(1, sum(counts.values())))


def quality_score(text: Column, network: ByteNetwork) -> Column:
    """The probability that a text is of label 1; a null text counts as empty."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([network.score(t or "") for t in texts], dtype="float64")

    return score(text)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that the classifier does not reject, with all their columns."""
    network = learn(docs, labels)
    return docs.where(quality_score(F.col("text"), network) >= THRESHOLD)


def scored(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    folds: int = 4,
    held_out: int = 2,
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per input row.

    The network sees whole texts in overlapping chunks. An empty or null text is one chunk of zeros.
    A null identifier is neither learned from nor held out; repeated rows give repeated rows; an
    empty table gives none.
    """
    network = learn(docs, labels, id_column, text_column, folds=folds, held_out=held_out)
    fold = F.crc32(F.col(id_column).cast("string")) % folds
    return docs.select(
        F.col(id_column),
        F.coalesce(fold == held_out, F.lit(False)).alias("held_out"),
        quality_score(F.col(text_column), network).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
