"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

Every token has a fixed sparse random index vector. A token's word vector is the sum of the index
vectors around it, over all documents of the corpus; it is gathered in a table of hashed tokens of
fixed size. A document is pooled to the mean and the spread of its tokens' normalised word vectors
their number and how often they repeat, and a network of two layers turns that into a probability, whose temperature
is set on labelled documents that were kept apart from training.

Tokens are runs of letters, of digits or of one kind of mark; letters keep their case, as case
says something of quality.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.batches import bound_batches, lean
from tickloom.llm.shingles import _power, mix, raw_bytes, slices

VOCABULARY_BITS = 15
DIMENSIONS = 32
INPUTS = 2 * DIMENSIONS + 2
WINDOW = 2
# Word vectors are summed up in rows of so many vocabulary cells.
CELLS = 1024
GATHERED_BYTES = 1 << 20
# Pooling holds a vector per token of a block.
POOLED_BYTES = 1 << 19
# Labelled documents the network is fitted on at most, drawn by a hash of their id.
TRAINING_ROWS = 20000
HIDDEN = 16
EPOCHS = 400
DECAY = 1e-3

_RANDOM = np.random.default_rng(7)
_TOKEN_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_KIND = np.arange(256, dtype=np.uint8)
_KIND[[32, 9, 10, 11, 12, 13]] = 0
_KIND[48:58] = 1
_KIND[65:91] = 2
_KIND[97:123] = 2
_KIND[128:] = 2
_TOKEN_BYTES[_KIND == 0] = 0


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vocabulary cells of all tokens in order, and where each text's start."""
    data, offsets = raw_bytes(texts)
    kind = _KIND[data]
    begins = kind != 0
    if not begins.any():
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    solid = begins.copy()
    begins[1:] &= kind[1:] != kind[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    begins[firsts] = solid[firsts]
    at = np.flatnonzero(begins)
    sums = np.add.reduceat(_TOKEN_BYTES[data] * _power("up", len(data)), at)
    cells = mix(sums * _power("down", len(data))[at]) >> np.uint64(64 - VOCABULARY_BITS)
    return cells.astype(np.int64), np.searchsorted(at, offsets)


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Two places with a sign for each vocabulary cell."""
    random = np.random.default_rng(11)
    cells = 1 << VOCABULARY_BITS
    return random.integers(0, DIMENSIONS, (2, cells)), random.integers(0, 2, (2, cells)) * 2 - 1


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    places, signs = _index_vectors()
    table = np.zeros((1 << VOCABULARY_BITS) * DIMENSIONS, np.int64)
    for batch in batches:
        for start, stop in slices(batch.column(0), GATHERED_BYTES):
            cells, bounds = tokens(batch.column(0).slice(start, stop - start))
            text = np.repeat(np.arange(stop - start), np.diff(bounds))
            for step in range(1, WINDOW + 1):
                same = text[step:] == text[:-step]
                left, right = cells[:-step][same], cells[step:][same]
                for word, near in ((left, right), (right, left)):
                    for place, sign in zip(places, signs):
                        at = word * DIMENSIONS + place[near]
                        positive = sign[near] > 0
                        table += np.bincount(at[positive], minlength=len(table))
                        table -= np.bincount(at[~positive], minlength=len(table))
    size = CELLS * DIMENSIONS
    for block in range(len(table) // size):
        part = table[block * size : (block + 1) * size]
        if part.any():
            packed = zlib.compress(part.astype(np.int64).tobytes(), 1)
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "sums": pa.array([packed], pa.binary())})


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of rows that come sorted by block, holding one block at a time."""
    block, total = None, None

    def done() -> pa.RecordBatch:
        packed = zlib.compress(total.tobytes(), 1)
        return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "sums": pa.array([packed], pa.binary())})

    for batch in batches:
        for number, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(zlib.decompress(packed), np.int64)
            if number != block:
                if block is not None:
                    yield done()
                block, total = number, part.copy()
            else:
                total += part
    if block is not None:
        yield done()


def word_vectors(texts: DataFrame) -> np.ndarray:
    """The word vector of every vocabulary cell over all texts, of length one (zero if unseen).

    Its size is that of the vocabulary table, 4 MB, whatever the corpus.
    """
    sums = texts.mapInArrow(lean(_contexts), "block int, sums binary")
    merged = sums.repartition(32, "block").sortWithinPartitions("block").mapInArrow(_add, "block int, sums binary")
    table = np.zeros((1 << VOCABULARY_BITS, DIMENSIONS), np.float32)
    for row in merged.collect():
        part = np.frombuffer(zlib.decompress(row.sums), np.int64).reshape(CELLS, DIMENSIONS)
        table[row.block * CELLS : (row.block + 1) * CELLS] = part
    length = np.linalg.norm(table, axis=1, keepdims=True)
    return table / np.where(length > 0, length, 1)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """One row per text: mean and spread of its word vectors, share of repeats, log of number; zeros without tokens."""
    out = np.zeros((len(texts), INPUTS), np.float64)
    for start, stop in slices(texts, POOLED_BYTES):
        cells, bounds = tokens(texts.slice(start, stop - start))
        counts = np.diff(bounds)
        full = np.flatnonzero(counts)
        if len(full):
            found = vectors[cells].astype(np.float64)
            mean = np.add.reduceat(found, bounds[:-1][full]) / counts[full, None]
            square = np.add.reduceat(found * found, bounds[:-1][full]) / counts[full, None]
            out[start + full, :DIMENSIONS] = mean
            again = np.zeros(len(cells) + 1, np.int64)
            again[2:-1] = (cells[2:] == cells[1:-1]) | (cells[2:] == cells[:-2])
            out[start + full, -2] = np.diff(np.cumsum(again)[bounds])[full] / counts[full]
            out[start + full, DIMENSIONS:-2] = np.sqrt(np.maximum(square - mean**2, 0))
            out[start + full, -1] = np.log1p(counts[full])
    return out


class Network:
    """Two layers over standardised inputs, with a temperature on the result."""

    def __init__(self, inputs: np.ndarray, labels: np.ndarray) -> None:
        random = np.random.default_rng(3)
        # Without labels nothing speaks against a document; the share of ones is smoothed alike.
        self.constant = (float(labels.sum()) + 1) / (len(labels) + 1)
        self.fitted = len(np.unique(labels)) > 1
        if not self.fitted:
            return
        apart = np.arange(len(labels)) % 5 == 4
        if len(np.unique(labels[~apart])) < 2 or not apart.any():
            apart = np.zeros(len(labels), dtype=bool)
        self.mean, self.spread = inputs.mean(axis=0), inputs.std(axis=0) + 1e-9
        scaled = (inputs - self.mean) / self.spread
        x, y = scaled[~apart], labels[~apart].astype(np.float64)
        self.weights = [
            random.normal(0, 1 / np.sqrt(INPUTS), (INPUTS, HIDDEN)),
            np.zeros(HIDDEN),
            random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
            np.zeros(1),
        ]
        first, second = [[np.zeros_like(w) for w in self.weights] for _ in range(2)]
        for step in range(1, EPOCHS + 1):
            hidden = np.tanh(x @ self.weights[0] + self.weights[1])
            error = (1 / (1 + np.exp(-(hidden @ self.weights[2] + self.weights[3]))) - y) / len(y)
            back = error[:, None] * self.weights[2] * (1 - hidden**2)
            slopes = [x.T @ back, back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
            for i, slope in enumerate(slopes):
                slope = slope + DECAY * self.weights[i] * (i % 2 == 0)
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                rate = 0.03 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                self.weights[i] = self.weights[i] - rate * first[i] / (np.sqrt(second[i]) + 1e-8)
        self.temperature = 1.0
        held = apart if apart.any() else ~apart
        logits, truth = self._logits(scaled[held]), labels[held]
        losses = {t: np.mean(np.logaddexp(0, logits / t) - truth * logits / t) for t in np.geomspace(0.25, 8, 61)}
        self.temperature = min(losses, key=losses.get)

    def _logits(self, scaled: np.ndarray) -> np.ndarray:
        return (np.tanh(scaled @ self.weights[0] + self.weights[1]) @ self.weights[2] + self.weights[3]) / self.temperature

    def state(self) -> dict:
        return dict(self.__dict__)

    @classmethod
    def of(cls, state: dict) -> Network:
        network = cls.__new__(cls)
        network.__dict__.update(state)
        return network

    def scores(self, inputs: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(inputs), self.constant)
        return 1 / (1 + np.exp(-np.clip(self._logits((inputs - self.mean) / self.spread), -700, 700)))


def _pool(vectors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pooled(batch.column(0), vectors.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array([x.tobytes() for x in found], pa.binary())], names=["draw", "label", "inputs"]
            )

    return run


def _score(vectors, state, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network.of(state.value)
        for batch in batches:
            scores = network.scores(pooled(batch.column(text_at), vectors.value))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "score"])

    return run


def held_out(ids: str) -> F.Column:
    """Whether a document is kept from all training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(ids).cast("string")) % 4 == 2, F.lit(False))


def score_documents(
    documents: DataFrame,
    labels: DataFrame,
    ids: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """Documents with ``score``, the calibrated probability of label 1.

    Word vectors come from all texts. The network learns from at most ``training_rows``
    labelled documents that are not ``held_out``, taken by a hash of their id. Only texts enter a
    score: a null or empty text has the score of a zero vector. Labels that are null, not 0 or 1, or
    without a document are ignored, repeated ones count again. Without labels every score is 1,
    with labels of one value it is their smoothed share of ones. All input columns return; one
    named ``score`` is replaced. An empty table gives an empty table.
    """
    spark = documents.sparkSession
    bound_batches(spark)
    documents = documents.drop(*[c for c in ("score",) if c not in (ids, text)])
    vectors = spark.sparkContext.broadcast(word_vectors(documents.select(text)))
    draw = F.xxhash64(F.col(ids).cast("string"))
    known = labels.where(F.col(label).isin(0, 1) & F.col(ids).isNotNull() & ~held_out(ids))
    known = known.select(F.col(ids).alias("known_id"), F.col(label).cast("int").alias("label"))
    # The bound holds before the texts are joined: at most this many rows are ever gathered.
    known = known.orderBy(F.xxhash64(F.col("known_id").cast("string")), "label").limit(training_rows)
    chosen = documents.join(F.broadcast(known), F.col(ids) == F.col("known_id")).select(F.col(text), draw.alias("draw"), "label")
    rows = chosen.mapInArrow(_pool(vectors), "draw long, label int, inputs binary").orderBy("draw", "label", "inputs").limit(training_rows).collect()
    inputs = np.array([np.frombuffer(r.inputs, np.float64) for r in rows]).reshape(-1, INPUTS)
    network = Network(inputs, np.array([r.label for r in rows], np.int64))
    state = spark.sparkContext.broadcast(network.state())
    schema = documents.withColumn("score", F.lit(0.0)).schema
    return documents.mapInArrow(lean(_score(vectors, state, documents.columns.index(text))), schema)
