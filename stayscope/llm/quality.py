"""Quality classifier: random-indexing word vectors, pooled per document, and a small calibrated network.

Words are letter runs, signs and marks of shape, hashed to a fixed number of rows. Every row has a
sparse index vector of +1 and -1; a word's vector sums the index vectors of the words around all its
occurrences in all documents. A document is the mean and spread of its words' vectors. A two-layer
network learns from a bounded sample of labelled documents, and a temperature fitted on rows it has
not learnt from makes its scores probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.llm.common import first_by_hash, map_texts, small_batches, table
from stayscope.sources.checkpoints import cut_lineage

ROWS, WIDTH, NONZERO, REACH = 1 << 14, 32, 4, 2
BREAK, SAME, FIRST = 0, 1, 2
CACHE_WORDS = 400_000
SAMPLE_ROWS = 20_000
HIDDEN = 32
THRESHOLD = 0.3
CHUNK_TOKENS = 1 << 19
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def row_of(token: str) -> int:
    """The row of a token."""
    return FIRST + zlib.crc32(token.encode()) % (ROWS - FIRST)


def marks(word: str) -> list[str]:
    """Tokens of a word: letter runs in lower case, digits as one sign, other signs, and shapes."""
    out = []
    for t in TOKEN.findall(word):
        if t.isalpha():
            out.append(t.lower())
            if t.isupper() and len(t) > 1:
                out.append("<upper>")
        else:
            out.append("<digits>" if t[0].isdigit() else t)
    return out


class Rows:
    """Row numbers of texts; words met before come from a cache."""

    def __init__(self):
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        found = self.words[word] = np.array([row_of(t) for t in marks(word)], dtype=np.int32).tobytes()
        return found

    def of(self, text: str) -> np.ndarray:
        words = text.split()
        found = list(map(self.words.get, words))
        if None in found:
            found = [self._word(w) if i is None else i for w, i in zip(words, found, strict=True)]
        rows = np.frombuffer(b"".join(found), dtype=np.int32)
        if len(rows) > 1:
            rows = rows.copy()
            rows[1:][rows[1:] == rows[:-1]] = SAME
        return rows


_ROWS = Rows()


def index_vectors(seed: int = 11) -> np.ndarray:
    """Sparse vectors of +1 and -1, one a row; none for the break between documents."""
    pick = np.random.default_rng(seed)
    out = np.zeros((ROWS, WIDTH), dtype=np.int8)
    for _ in range(NONZERO):
        out[np.arange(ROWS), pick.integers(0, WIDTH, ROWS)] = pick.choice([-1, 1], ROWS)
    out[BREAK] = 0
    return out


def context_sums(rows: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Per row, the sum of the index vectors up to two places around its occurrences (whole numbers)."""
    out = np.empty((ROWS, WIDTH))
    for j in range(WIDTH):
        own = index[:, j][rows]
        around = np.zeros(len(rows), dtype=np.int8)
        for step in range(1, REACH + 1):
            around[step:] += own[:-step]
            around[:-step] += own[step:]
        out[:, j] = np.bincount(rows, weights=around, minlength=ROWS)
    return out


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Vectors of all rows from all documents, of one length and squashed so that no coordinate rules.

    Each task adds up its own documents; the sums per row, a table of bounded size, come to the driver.
    """
    small_batches(docs.sparkSession)
    schema = "row int, n long, v array<double>"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, gap = index_vectors(), np.zeros(REACH, dtype=np.int32)
        total, count, waiting, size = np.zeros((ROWS, WIDTH)), np.zeros(ROWS, dtype=np.int64), [], 0

        def flush():
            nonlocal total, count, waiting, size
            if waiting:
                rows = np.concatenate(waiting)
                total += context_sums(rows, index)
                count += np.bincount(rows, minlength=ROWS)
                waiting, size = [], 0

        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    waiting += [_ROWS.of(t), gap]
                    size += len(waiting[-2])
                    if size >= CHUNK_TOKENS:
                        flush()
        flush()
        count[BREAK] = 0
        used = np.flatnonzero(count)
        for part in np.array_split(used, max(1, len(used) // 4096)):
            flat = pa.array(total[part].ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, flat.__len__() + 1, WIDTH, dtype=np.int32)), flat)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(count[part]), lists], ["row", "n", "v"]
            )

    sums = docs.select(text).mapInArrow(add, schema).groupBy("row")
    sums = sums.agg(F.sum("n").alias("n"), *[F.sum(F.col("v")[j]).alias(f"v{j}") for j in range(WIDTH)])
    found = sums.toPandas()
    vectors = np.zeros((ROWS, WIDTH))
    vectors[found["row"]] = found[[f"v{j}" for j in range(WIDTH)]].to_numpy()
    return np.tanh(vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9) * 2).astype(np.float32)


def pooled(rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A document: mean and spread of its words' vectors, and its length on a log scale."""
    if not len(rows):
        return np.zeros(2 * WIDTH + 1, dtype=np.float32)
    v = vectors[rows]
    return np.concatenate([v.mean(0), v.std(0), [np.log1p(len(rows)) / 10]]).astype(np.float32)


@dataclass
class Network:
    """Two layers with ReLU, and a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Uncalibrated scores."""
        return np.maximum(0, (x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of label 1."""
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = 60, seed: int = 5) -> Network:
    """Train by Adam on four fifths of the rows, and set the temperature on the last fifth."""
    pick = np.random.default_rng(seed)
    order = pick.permutation(len(x))
    held, used = order[: len(x) // 5], order[len(x) // 5 :]
    scale = x.std(0) + 1e-3 if len(x) else np.ones(x.shape[1])
    net = Network(
        x.mean(0) if len(x) else np.zeros(x.shape[1]),
        scale,
        pick.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)),
        np.zeros(hidden),
        pick.normal(0, np.sqrt(1 / hidden), hidden),
        0.0,
    )
    z = (x - net.mean) / net.scale
    state = {n: [0.0, 0.0] for n in ("w1", "b1", "w2", "b2")}
    step = 0
    for epoch in range(epochs):
        rate = 0.003 * (1 - epoch / epochs) + 1e-4
        used = pick.permutation(used)
        for lo in range(0, len(used), 128):
            some = used[lo : lo + 128]
            h = np.maximum(0, z[some] @ net.w1 + net.b1)
            p = 1 / (1 + np.exp(-np.clip(h @ net.w2 + net.b2, -30, 30)))
            d = (p - y[some]) / len(some)
            dh = np.outer(d, net.w2) * (h > 0)
            grads = {"w1": z[some].T @ dh + 1e-4 * net.w1, "b1": dh.sum(0), "w2": h.T @ d + 1e-4 * net.w2, "b2": d.sum()}
            step += 1
            for n, g in grads.items():
                m = state[n]
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.999 * m[1] + 0.001 * g**2
                move = rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
                setattr(net, n, getattr(net, n) - move)
    if len(held):
        logit = net.logits(x[held])
        tries = np.geomspace(0.25, 8, 60)
        signed = np.where(y[held] == 1, -logit, logit)
        net.temperature = float(tries[np.argmin([np.logaddexp(0, signed / t).mean() for t in tries])])
    return net


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int, seed: str) -> DataFrame:
    """doc_id, text and label (0 or 1) of at most `rows` labelled documents, the first by a hash of doc_id.

    Only those labels are broadcast. Labels other than 0 and 1 and NULL ids are left out; a
    doc_id with several labels counts with its smallest.
    """
    known = labels.where(learn & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    known = cut_lineage(known.withColumn("_seed", F.lit(seed)))
    known = cut_lineage(first_by_hash(known, ["_seed", "doc_id"], rows).drop("_seed"))
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", rows: int = SAMPLE_ROWS):
    """Word vectors of all of `docs`, and the network fitted on labels for which `learn` holds."""
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(texts: list[str]) -> list:
        return [[pooled(_ROWS.of(t), shared.value).tolist() for t in texts]]

    known = labelled_sample(docs, labels, label, learn, rows, "quality")
    found = map_texts(known, "text", ["doc_id", "label"], features, [("x", pa.list_(pa.float32()))])
    found = found.toPandas().sort_values(["doc_id", "label"], kind="stable")
    x = np.array(found["x"].tolist(), dtype=float).reshape(-1, 2 * WIDTH + 1)
    order = np.lexsort((*x.T[:3], found["doc_id"].to_numpy()))
    return shared, fit(x[order], found["label"].to_numpy(dtype=float)[order])


def scored(docs: DataFrame, shared, net: Network, keep: list[str], threshold: float) -> DataFrame:
    """Columns `keep` with score and predicted; every text is read whole, NULL as an empty one."""

    def score(texts: list[str]) -> list:
        x = np.array([pooled(_ROWS.of(t), shared.value) for t in texts], dtype=float).reshape(-1, 2 * WIDTH + 1)
        p = net.probability(x)
        return [p, (p >= threshold).astype(np.int32)]

    return map_texts(docs, "text", keep, score, [("score", pa.float64()), ("predicted", pa.int32())])


def held_out(folds: int, fold: int, inside: bool = True) -> Column:
    """Whether the CRC-32 of doc_id as text leaves `fold`."""
    same = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold
    return same if inside else ~same


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that the classifier does not reject, with all their columns."""
    shared, net = train(docs, labels, held_out(5, 0, inside=False))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    found = scored(rows, shared, net, ["_row"], threshold)
    return found.where(F.col("predicted") == 1).select("_row.*")


def op5_quality(spark, sf_dir) -> DataFrame:
    """Quality of all documents."""
    docs = table(spark, sf_dir, "documents")
    shared, net = train(docs, table(spark, sf_dir, "labels"), held_out(5, 0, inside=False))
    found = scored(docs, shared, net, ["doc_id"], THRESHOLD)
    return found.select("doc_id", F.coalesce(held_out(5, 0), F.lit(False)).alias("held_out"), "score", "predicted")
