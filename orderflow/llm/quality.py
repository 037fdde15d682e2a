"""Quality classifier: a byte-level convolutional network in numpy over whole texts.

Each byte has a learned embedding; learned filters over six neighbouring bytes run over the whole
text. A filter's values are rectified and max-pooled in overlapping chunks of 1,024 bytes (512 apart)
that cover the document; the chunks' maxima, averaged and maximised over the chunks, go through one
logistic unit. Filters over pairs of bytes are kept as tables, so scoring only looks numbers up.

Training takes a bounded sample of labelled texts to the driver: those of TRAIN_ROWS labels, the first
by a hash of their id. Of a text of more than TRAIN_BYTES bytes, one run of that many bytes is taken, from a
place drawn by a hash of the text. Null and empty texts are scored like a text of zero bytes. Labels without a value, and labels of unknown documents, are ignored; a document with several
labels is used once for each, and repeated rows or labels count once. Equal hashes of ids are ordered by the
ids, so there are no ties. With no usable label at all every score is 0.5; an empty table of documents gives an
empty result. A very long text is scored whole, in segments. Other columns pass through.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from orderflow.llm.common import scan_texts

WIDTH = 6
EMBEDDING = 8
FILTERS = 16
BLOCK = 256
CHUNK_BLOCKS = 4
STRIDE_BLOCKS = 2
SEGMENT = 1 << 13  # positions at a time, so that the values stay in the processor's cache
TRAIN_ROWS = 3000
TRAIN_BYTES = 16 << 10
STEPS = 600
BATCH = 32
RATE = 0.01
THRESHOLD = 0.3
FOLDS = 5


def _layout(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First block of each document, blocks of each chunk, first chunk of each document, chunks."""
    blocks = np.maximum(1, -(-sizes // BLOCK))
    chunks = np.maximum(1, -(-(blocks - CHUNK_BLOCKS) // STRIDE_BLOCKS) + 1)
    first_block = np.cumsum(blocks) - blocks
    first_chunk = np.cumsum(chunks) - chunks
    doc = np.repeat(np.arange(len(sizes)), chunks)
    at = first_block[doc] + STRIDE_BLOCKS * (np.arange(len(doc)) - first_chunk[doc])
    last = first_block[doc] + blocks[doc] - 1
    members = np.minimum(at[:, None] + np.arange(CHUNK_BLOCKS)[None, :], last[:, None])
    return blocks, members, first_chunk, chunks


class Network:
    """Embeddings, filters and the logistic unit."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.embedding = rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)
        self.filters = rng.normal(0, 0.3, (WIDTH, EMBEDDING, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, dtype=np.float32)
        self.weights = np.zeros(2 * FILTERS, dtype=np.float32)
        self.offset = np.zeros(1, dtype=np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.weights, self.offset]

    def taps(self) -> np.ndarray:
        return np.einsum("be,kef->kbf", self.embedding, self.filters)

    @cached_property
    def pairs(self) -> list[np.ndarray]:
        """For each two neighbouring taps, their sum for every pair of bytes."""
        taps = self.taps()
        return [
            np.ascontiguousarray(
                (taps[k][:, None, :] + taps[k + 1][None, :, :]).reshape(-1, FILTERS)
            )
            for k in range(0, WIDTH, 2)
        ]

    def block_maxima(self, texts: list[bytes]) -> np.ndarray:
        """The filters' largest values in each block of each text, before bias and rectifier."""
        sizes = np.array([max(1, len(t)) for t in texts], dtype=np.int64)
        pad = bytes(WIDTH)
        data = np.frombuffer(b"".join(t + pad for t in texts), dtype=np.uint8)
        pair = data[:-1].astype(np.uint16) << 8 | data[1:]
        offsets = np.cumsum([0, *(len(t) + WIDTH for t in texts[:-1])])
        blocks = np.maximum(1, -(-sizes // BLOCK))
        doc = np.repeat(np.arange(len(texts)), blocks)
        inner = np.arange(len(doc)) - (np.cumsum(blocks) - blocks)[doc]
        starts = offsets[doc] + inner * BLOCK
        ends = np.minimum(starts + BLOCK, (offsets + sizes)[doc])
        out = np.empty((len(doc), FILTERS), dtype=np.float32)
        at = 0
        while at < len(doc):
            stop = max(at + 1, int(np.searchsorted(starts, starts[at] + SEGMENT, side="right")))
            low, high = int(starts[at]), int(ends[stop - 1])
            values = np.take(self.pairs[0], pair[low:high], axis=0, mode="clip")
            for k, table in enumerate(self.pairs[1:], 1):
                values += np.take(table, pair[low + 2 * k : high + 2 * k], axis=0, mode="clip")
            values = np.concatenate([values, values[:1]])
            bounds = np.stack([starts[at:stop] - low, ends[at:stop] - low], axis=1).ravel()
            out[at:stop] = np.maximum.reduceat(values, bounds, axis=0)[::2]
            at = stop
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        sizes = np.array([max(1, len(t)) for t in texts], dtype=np.int64)
        _, members, first, chunks = _layout(sizes)
        pooled = np.maximum(self.block_maxima(texts)[members].max(axis=1) + self.bias, 0)
        mean = np.add.reduceat(pooled, first, axis=0) / chunks[:, None]
        most = np.maximum.reduceat(pooled, first, axis=0)
        logit = np.concatenate([mean, most], axis=1) @ self.weights + self.offset
        return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -40, 40)))

    def gradients(self, texts: list[bytes], labels: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean log loss; only the positions that won the pooling get any."""
        n = len(texts)
        sizes = np.array([max(1, len(t)) for t in texts], dtype=np.int64)
        blocks, members, first, chunks = _layout(sizes)
        width = BLOCK + WIDTH - 1
        cells = np.zeros((int(blocks.sum()), width), dtype=np.uint8)
        valid = np.zeros((len(cells), BLOCK), dtype=bool)
        row = 0
        for text, count in zip(texts, blocks.tolist(), strict=True):
            padded = np.frombuffer(text + bytes(count * BLOCK + WIDTH - len(text)), dtype=np.uint8)
            view = np.lib.stride_tricks.sliding_window_view(padded, width)[::BLOCK][:count]
            cells[row : row + count] = view
            valid[row : row + count].reshape(-1)[: max(1, len(text))] = True
            row += count
        taps = self.taps()
        values = taps[0][cells[:, :BLOCK]]
        for k in range(1, WIDTH):
            values += taps[k][cells[:, k : k + BLOCK]]
        values[~valid] = -np.inf
        winner = values.argmax(axis=1)  # block, filter -> position
        best = np.take_along_axis(values, winner[:, None, :], axis=1)[:, 0, :]
        chunk_values = best[members]
        slot = chunk_values.argmax(axis=1)
        top = np.take_along_axis(chunk_values, slot[:, None, :], axis=1)[:, 0, :] + self.bias
        pooled = np.maximum(top, 0)
        mean = np.add.reduceat(pooled, first, axis=0) / chunks[:, None]
        most = np.maximum.reduceat(pooled, first, axis=0)
        features = np.concatenate([mean, most], axis=1)
        logit = features @ self.weights + self.offset
        error = ((1 / (1 + np.exp(-np.clip(logit, -30, 30)))) - labels) / n
        d_weights = features.T @ error + 1e-4 * self.weights
        d_features = error[:, None] * self.weights[None, :]
        doc = np.repeat(np.arange(n), chunks)
        is_most = pooled == most[doc]
        ties = np.add.reduceat(is_most.astype(np.float32), first, axis=0)
        d_pooled = (d_features[:, :FILTERS] / chunks[:, None])[doc]
        d_pooled = d_pooled + is_most * (d_features[:, FILTERS:] / ties)[doc]
        d_top = (d_pooled * (top > 0)).astype(np.float32)
        block = np.take_along_axis(members, slot, axis=1)
        filters = np.broadcast_to(np.arange(FILTERS), block.shape)
        position = winner[block, filters]
        d_taps = np.zeros((WIDTH, 256, FILTERS), dtype=np.float32)
        for k in range(WIDTH):
            np.add.at(d_taps[k], (cells[block, position + k], filters), d_top)
        d_embedding = np.einsum("kbf,kef->be", d_taps, self.filters)
        d_filters = np.einsum("kbf,be->kef", d_taps, self.embedding)
        return [d_embedding, d_filters, d_top.sum(axis=0), d_weights, np.array([error.sum()])]


def fit(texts: list[bytes], labels: np.ndarray, steps: int = STEPS, seed: int = 7) -> Network:
    """Train with Adam on shuffled batches."""
    network = Network(seed)
    if not texts:
        return network
    rng = np.random.default_rng(seed)
    # Not all at zero, or no gradient would reach the filters in the first step.
    network.weights[:] = rng.normal(0, 0.1, 2 * FILTERS)
    share = np.clip(labels.mean(), 0.01, 0.99)
    network.offset[:] = np.log(share / (1 - share))
    first = [np.zeros_like(p) for p in network.parameters()]
    second = [np.zeros_like(p) for p in network.parameters()]
    order = np.concatenate([rng.permutation(len(texts)) for _ in range(steps * BATCH // len(texts) + 1)])
    for step in range(1, steps + 1):
        chosen = order[(step - 1) * BATCH : step * BATCH]
        rate = RATE * (1 - 0.9 * step / steps)
        grads = network.gradients([texts[i] for i in chosen], labels[chosen])
        for p, g, m, v in zip(network.parameters(), grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return network


def held_out(id_col: str) -> Column:
    """Whether a document's labels are kept from training (one fold in five by a checksum)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(False))


def excerpt(text: Column, size: int) -> Column:
    """A binary text, or of a longer one the ``size`` bytes at a place drawn by its hash."""
    places = F.octet_length(text) - size + 1
    place = F.pmod(F.xxhash64(text), F.greatest(places, F.lit(1))).cast("int") + 1
    return F.when(places <= 1, text).otherwise(F.substring(text, place, F.lit(size)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = TRAIN_ROWS,
) -> Network:
    """A network fitted to a bounded sample of the labelled documents outside the held-out fold.

    The sample is drawn from the distinct labels alone. It has at most ``rows`` rows, so it is broadcast,
    and the texts are picked while they are scanned. Of the documents that share an id, one text is
    taken (the first by its hash), by partial aggregation, so at most ``rows`` texts reach the driver.
    """
    chosen = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
        .where(F.col("_label").isin(0, 1) & F.col("_id").isNotNull() & ~held_out("_id"))
        .distinct()
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(rows)
    )
    texts = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).cast("string").cast("binary").alias("_text")
    ).where(F.col("_text").isNotNull())
    picked = texts.join(F.broadcast(chosen), "_id").withColumn("_text", excerpt(F.col("_text"), TRAIN_BYTES))
    first = F.min(F.struct(F.xxhash64("_text").alias("hash"), "_text"))
    sample = picked.groupBy("_id", "_label").agg(first.alias("_first")).select(
        "_id", "_first._text", "_label"
    )
    rows_found = [row[1:] for row in sorted(sample.collect())]
    return fit([bytes(r[0]) for r in rows_found], np.array([r[1] for r in rows_found], dtype=np.float32))


def score_documents(
    docs: DataFrame, network: Network, keep: list[str], text_col: str = "text"
) -> tuple[DataFrame, str]:
    """``keep`` and a struct with the document's ``score``; returns the frame and the struct's name."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def scan(texts: list[bytes | None]) -> list:
        return [shared.value.score([text or b"" for text in texts])]

    return scan_texts(docs, text_col, keep, scan, "score double", "quality", 1 << 20)


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, whose score reaches the threshold."""
    network = train(docs, labels, text_col=text_col)
    scored, name = score_documents(docs, network, docs.columns, text_col)
    return scored.where(F.col(f"{name}.score") >= THRESHOLD).select(*docs.columns)
