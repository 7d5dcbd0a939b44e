"""Quality scores of whole texts by random-indexing word vectors and a two-layer network.

Each text of one part of the training sample has a sparse random ternary index vector; the vector of
a word is the sum of those of the texts it stands in. A document is the mean of the vectors of its
words, beside the mean of those of its signs (shapes of words, pairs of shapes, repeats). A numpy
network with one hidden layer learns the labels on a second part of the sample, so that no document
meets its own index vector, and a temperature found on a third part calibrates its probabilities.

The sample is at most SAMPLE labelled rows, those with the smallest hashes of doc_id; rows that are
held out are never among them. Word vectors are summed and documents pooled on the executors: the
driver gets the vectors of the words (BUCKETS) and 2 * DIM numbers for each row of the sample. Scoring is one pass
over the documents with the model (about 8 MB) broadcast. Only the text is an input of the score.

Defined results: a null or empty text has the zero vector and is scored like any other. A null
doc_id is not held out. Rows that repeat are each scored. Labels that are null are not used; of
several for one doc_id the smallest counts. Without labels of both kinds every score is the share
of label 1 (0.5 without any). Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitymill.llm.common import materialize

SAMPLE, BUCKETS, DIM, HIDDEN, NONZERO = 8000, 1 << 15, 64, 32, 8
EPOCHS, RATE, BATCH, DECAY, THRESHOLD, FOLDS = 60, 3e-3, 64, 1e-4, 0.3, 5
SLICE = 1 << 20
#: Tasks that sum word vectors, and buckets whose sums travel together: few enough that no row, nor
#: what the driver's heap holds of one, is large.
PARTS, STRIPE = 16, 256

_SHAPE = bytes(ord("A") if 65 <= i <= 90 else ord("9") if 48 <= i <= 57 else ord("a") if 97 <= i <= 122 else i for i in range(256))
_BEYOND = bytes(range(128, 256))
_GAP = re.compile(rb"[\x20\x09-\x0d]")


def held_out(doc_id: Column) -> Column:
    """Whether labels of this row are kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _hashed(words: list[bytes]) -> np.ndarray:
    return (pd.util.hash_array(np.array(words, dtype=object), categorize=False) % np.uint64(BUCKETS)).astype(np.int32)


def _repeats(hashes: np.ndarray) -> list[bytes]:
    """A sign for each word after the first: the same as the one before, or as the one before that."""
    once = hashes[1:] == hashes[:-1]
    twice = np.concatenate(([False], hashes[2:] == hashes[:-2])) if len(hashes) > 1 else once
    return [b"\x01same" if a else b"\x01alternate" if b else b"\x01new" for a, b in zip(once, twice)]


def tokens(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words of the whole text, and of its signs: the shapes of words (runs of
    capitals, small letters and digits, ASCII only), pairs of neighbouring shapes, repeats."""
    data, words_out, signs_out, start = (text or "").encode(), [], [], 0
    while start < len(data):
        gap = _GAP.search(data, start + SLICE) if len(data) - start > SLICE else None
        stop = gap.start() if gap else len(data)
        part, start = data[start:stop], stop
        if not (words := part.split()):
            continue
        found = _hashed(words)
        words_out.append(found)
        signs = np.frombuffer(part.translate(_SHAPE, _BEYOND), np.uint8)
        runs = signs[np.concatenate(([True], signs[1:] != signs[:-1]))].tobytes().split() if len(signs) else []
        every = [*runs, *map(b" ".join, zip(runs, runs[1:])), *_repeats(found)]
        kinds = {k: i for i, k in enumerate(dict.fromkeys(every))}
        if kinds:
            signs_out.append(_hashed([b"\x00" + k for k in kinds])[np.fromiter(map(kinds.__getitem__, every), np.int32, len(every))])
    none = np.empty(0, np.int32)
    return np.concatenate(words_out) if words_out else none, np.concatenate(signs_out) if signs_out else none


@dataclass
class Model:
    words: np.ndarray  # BUCKETS x DIM
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def pooled(self, found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        return np.concatenate([pool(self.words, *np.unique(x, return_counts=True)) for x in found])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.round(1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40))), 6)


def pool(words: np.ndarray, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The mean vector of words that stand in a document so many times."""
    return words[buckets].astype(np.float64).T @ counts / max(1, counts.sum())


def _constant(share: float) -> Model:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Model(np.zeros((BUCKETS, DIM), np.float32), np.zeros(2 * DIM), np.ones(2 * DIM), np.zeros((2 * DIM, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))), 1.0)


def index_vector(key: int) -> np.ndarray:
    """The sparse ternary vector of the text with this hash."""
    rng, out = np.random.default_rng(key % (1 << 64)), np.zeros(DIM, np.int64)
    out[rng.choice(DIM, NONZERO, replace=False)] = rng.choice([-1, 1], NONZERO)
    return out


def _sparse(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(found, return_counts=True)


def _partial_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of index vectors by bucket, in whole numbers so that their order does not matter."""
    total = np.zeros((BUCKETS, DIM), np.int64)
    for batch in batches:
        for key, text in zip(batch.column("h"), batch.column("text")):
            index = index_vector(key.as_py())
            for found in tokens(text.as_py()):
                buckets, counts = _sparse(found)
                total[buckets] += np.round(np.log1p(counts) * 65536).astype(np.int64)[:, None] * index
    for i in range(0, BUCKETS, STRIPE):
        part = total[i : i + STRIPE]
        if len(some := np.flatnonzero(part.any(axis=1)).astype(np.int32)):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([some.tobytes()], pa.binary()), pa.array([part[some].tobytes()], pa.binary())], names=["first", "buckets", "sums"])


def _add_vectors(table: pa.Table) -> pa.Table:
    total = np.zeros((STRIPE, DIM), np.int64)
    for some, sums in zip(table["buckets"], table["sums"]):
        total[np.frombuffer(some.as_py(), np.int32)] += np.frombuffer(sums.as_py(), np.int64).reshape(-1, DIM)
    words = total.astype(np.float64)
    words = (words / np.maximum(np.linalg.norm(words, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    return pa.table({"first": table["first"][:1], "words": pa.array([words.tobytes()], pa.binary())})


def vector_stripes(texts: DataFrame) -> DataFrame:
    """first, words: the float32 vectors of STRIPE buckets from the first one on, of length 1 (0 for words
    not seen), from texts (h, text). Stripes without any word are left out."""
    return texts.repartition(PARTS, "h").mapInArrow(_partial_vectors, "first int, buckets binary, sums binary").groupBy("first").applyInArrow(_add_vectors, "first int, words binary")


def word_vectors(texts: DataFrame) -> np.ndarray:
    """BUCKETS x DIM vectors of length 1 (0 for words not seen) from texts (h, text)."""
    words = np.zeros((BUCKETS, DIM), np.float32)
    table = vector_stripes(texts).toArrow()  # BUCKETS / STRIPE rows
    for first, part in zip(table["first"].to_pylist(), table["words"]):
        words[first : first + STRIPE] = np.frombuffer(part.as_buffer(), np.float32).reshape(-1, DIM)
    return words


def fit(words: np.ndarray, x: np.ndarray, labels: np.ndarray, calibrate: np.ndarray, seed: int = 7) -> Model:
    """x: pooled vectors of the rows that teach the network, or (calibrate) its temperature."""
    net = ~calibrate
    if net.sum() < 5 or labels[net].min() == labels[net].max():
        return _constant(labels.mean() if len(labels) else 0.5)
    rng, model = np.random.default_rng(seed), _constant(0.5)
    model.words = words
    model.mean, model.scale = x[net].mean(axis=0), x[net].std(axis=0) + 1e-6
    xs, ys = (x[net] - model.mean) / model.scale, labels[net]
    p = [rng.normal(0, (2 * DIM) ** -0.5, (2 * DIM, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(xs))
        for at in range(0, len(xs), BATCH):
            rows = order[at : at + BATCH]
            h = np.tanh(xs[rows] @ p[0] + p[1])
            d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -40, 40))) - ys[rows]) / len(rows)
            back = np.outer(d, p[2]) * (1 - h * h)
            grads = [xs[rows].T @ back + DECAY * p[0], back.sum(axis=0), h.T @ d + DECAY * p[2], np.array([d.sum()])]
            step += 1
            for i, g in enumerate(grads):
                m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                p[i] -= RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    model.w1, model.b1, model.w2, model.b2 = p[0], p[1], p[2], float(p[3][0])
    if calibrate.any():
        z, y = model.logits(x[calibrate]), labels[calibrate]
        loss = lambda t: np.mean(np.logaddexp(0, z / t) - y * z / t)
        model.temperature = float(min(np.geomspace(0.25, 8, 41), key=loss))
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, h, text, quality and part (0 to 9) of at most `sample` labelled rows that aren't held out."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")  # at most `sample` rows
    # where a doc_id has several texts, one is chosen by their hashes, the same in every run
    least = texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "quality")).alias("x"))
    part = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(10)).cast("int").alias("part")
    return materialize(least.select("doc_id", "x.h", "x.text", "x.quality", part), "sample")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of labels.quality from at most `sample` labelled rows of docs that aren't held out."""
    rows = labelled_sample(docs, labels, sample)
    # parts 0-4: word vectors, 5-8: network, 9: temperature
    words = word_vectors(rows.where("part < 5"))
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def pooled(batches):
        for batch in batches:
            x = [None if p < 5 else np.concatenate([pool(shared.value, *_sparse(f)) for f in tokens(t.as_py())]) for p, t in zip(batch.column("part").to_pylist(), batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "quality", "part")), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "quality", "part", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    table = rows.mapInArrow(pooled, f"doc_id {kind}, quality int, part int, x array<double>").toArrow().sort_by("doc_id")
    shared.destroy()
    quality, part = table["quality"].to_numpy().astype(float), table["part"].to_numpy()
    if len(quality) < 10 or quality.min() == quality.max():
        return _constant(quality.mean() if len(quality) else 0.5)
    x = np.concatenate([v.flatten().to_numpy() for v in table["x"].chunks]).reshape(-1, 2 * DIM)
    return fit(words, x, quality[part >= 5], part[part >= 5] == 9)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """docs, all columns, and score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches):
        m = shared.value
        for batch in batches:
            texts = batch.column(text)
            x = np.stack([m.pooled(tokens(t.as_py())) for t in texts]) if len(texts) else np.zeros((0, 2 * DIM))
            s = m.scores(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32), pa.int32())], names=[*batch.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, f"{kinds}, score double, predicted int")


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of docs."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels, sample), threshold)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """docs, all columns, without the rows that score below the threshold."""
    # numbered, so that no name can clash
    names = [f"c{i}" for i in range(len(docs.columns))]
    scored = score(docs.toDF(*names), train(docs, labels, sample), threshold, names[docs.columns.index("text")])
    return scored.where("predicted = 1").select(*names).toDF(*docs.columns)
