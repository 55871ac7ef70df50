"""Toxicity: a linear classifier held to give swapped identity terms the same score.

A document is the set of its words, each with its leading letters; its logit is the sum of their
weights. The fit minimises the logistic loss on labelled documents plus a penalty on the change of
the logit when identity terms are swapped for others of their kind, so that naming a group does not
make a text toxic. Which features count is decided over all sampled documents by grouping.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.llm.common import map_texts, table
from stayscope.llm.quality import held_out, labelled_sample
from stayscope.sources.checkpoints import cut_lineage

SAMPLE_ROWS = 20_000
FEATURES = 3_000
SPACE = 1 << 31
STEMS = (4, 5, 6, 7)
SWAP_PENALTY = 4.0
SHRINK = 2e-3
STEEPEST = 10.0
ROUNDS, RATE = 200, 0.1
LEAST_DOCUMENTS = 5
THRESHOLD = 0.7
CACHE_WORDS = 600_000
LETTERS = re.compile(r"[^\W\d_]+")

# Terms of one kind are swapped for one another.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "catholics", "protestants"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "heterosexual"),
    ("immigrant", "native", "refugee", "foreigner"), ("disabled", "deaf", "blind"),
    ("frau", "mann"), ("frauen", "männer"), ("christen", "muslime", "juden"),
    ("femme", "homme"), ("femmes", "hommes"), ("chrétien", "musulman", "juif"),
    ("mujer", "hombre"), ("mujeres", "hombres"), ("cristiano", "musulmán", "judío"),
)


def feature(kind: str, word: str) -> int:
    """Number of a feature."""
    return zlib.crc32(f"{kind}:{word}".encode()) % SPACE


def word_features(word: str) -> list[int]:
    """The word and its leading letters."""
    return [feature("w", word), *[feature("s", word[:n]) for n in STEMS if len(word) >= n]]


def words_of(text: str) -> set[str]:
    """Distinct letter runs in lower case."""
    return set(LETTERS.findall(text.lower()))


def swaps(terms: Sequence[Sequence[str]]) -> dict[str, str]:
    """Each term and the next of its kind."""
    return {a: b for kind in terms for a, b in zip(kind, [*kind[1:], kind[0]], strict=True)}


def swapped(words: set[str], other: Mapping[str, str]) -> set[str]:
    """The words with every identity term swapped."""
    return {other.get(w, w) for w in words}


@dataclass
class Model:
    """Weights by feature; words met before come from a cache."""

    weights: dict[int, float]
    bias: float
    words: dict[str, float] = field(default_factory=dict)

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "words": {}}

    def _word(self, word: str) -> float:
        if len(self.words) >= CACHE_WORDS:
            self.words.clear()
        found = self.words[word] = sum(self.weights.get(f, 0.0) for f in word_features(word))
        return found

    def logit(self, text: str) -> float:
        """Score of a text before the logistic function; words are added in a fixed order."""
        words = sorted(words_of(text))
        found = list(map(self.words.get, words))
        if None in found:
            found = [self._word(w) if v is None else v for w, v in zip(words, found, strict=True)]
        return self.bias + sum(found)

    def probability(self, text: str) -> float:
        """Probability of label 1."""
        return float(1 / (1 + np.exp(-np.clip(self.logit(text), -500, 500))))


def fit(
    rows: list[list[int]],
    y: np.ndarray,
    changes: list[tuple[list[int], list[int]]],
    known: Sequence[int],
    penalty: float = SWAP_PENALTY,
    shrink: float = SHRINK,
    rounds: int = ROUNDS,
) -> tuple[np.ndarray, float]:
    """Weights of the features `known` and a bias, by Adam over all rows at once.

    `rows` are places in `known` with repeats as counts; `changes` are the places a swap takes
    away and those it adds. Minimised: mean logistic loss, both labels with equal weight, plus
    `penalty` times the mean squared change by swaps, plus half of `shrink` times the sum
    of squared weights.
    """
    n, m = len(rows), len(known)
    at = np.concatenate([np.array(r, dtype=np.int64) for r in rows]) if n else np.zeros(0, dtype=np.int64)
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    gone = [np.array(x, dtype=np.int64) for pair in changes for x in pair]
    delta_at = np.concatenate(gone) if gone else np.zeros(0, dtype=np.int64)
    sign = np.concatenate([np.full(len(x), 1.0 if i % 2 else -1.0) for i, x in enumerate(gone)]) if gone else np.zeros(0)
    delta_row = np.repeat(np.arange(len(gone)) // 2, [len(x) for x in gone])
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    w, bias = np.zeros(m + 1), 0.0
    first, second = np.zeros(m + 1), np.zeros(m + 1)
    for i in range(1, rounds + 1):
        bias = w[m]
        z = np.bincount(row, weights=w[at], minlength=n) + bias
        d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * share
        grad = np.append(np.bincount(at, weights=d[row], minlength=m) + shrink * w[:m], d.sum())
        if len(delta_at):
            change = np.bincount(delta_row, weights=sign * w[delta_at], minlength=len(changes)) / len(changes)
            grad[:m] += 2 * penalty * np.bincount(delta_at, weights=sign * change[delta_row], minlength=m)
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        rate = RATE * (1 - i / (rounds + 1))
        w = w - rate * (first / (1 - 0.9**i)) / (np.sqrt(second / (1 - 0.999**i)) + 1e-8)
    return w[:m], float(w[m])


def calibrated(z: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope (1 to STEEPEST) and shift that make logits of rows not learnt from probabilities.

    Newton steps on the logistic loss with both labels of equal weight; 1 and 0 where a label is missing.
    """
    if not 0 < y.sum() < len(y):
        return 1.0, 0.0
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    x, w = np.column_stack([z, np.ones(len(z))]), np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ ((p - y) * share) + 1e-4 * w
        curve = (x * (p * (1 - p) * share)[:, None]).T @ x + 1e-4 * np.eye(2)
        w = w - np.clip(np.linalg.solve(curve, grad), -1, 1)
        w[0] = np.clip(w[0], 1.0, STEEPEST)
    return float(w[0]), float(w[1])


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    label: str = "toxic",
    terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
    rows: int = SAMPLE_ROWS,
    features: int = FEATURES,
    penalty: float = SWAP_PENALTY,
) -> Model:
    """Fit on at most `rows` labels for which `learn` holds, with the `features` most telling features."""
    other = swaps(terms)

    def read(texts: list[str]) -> list:
        sets = [words_of(t) for t in texts]
        one = [[f for w in sorted(s) for f in word_features(w)] for s in sets]
        gone = [[f for w in sorted(s - swapped(s, other)) for f in word_features(w)] for s in sets]
        come = [[f for w in sorted(swapped(s, other) - s) for f in word_features(w)] for s in sets]
        return [one, gone, come]

    longs = pa.list_(pa.int64())
    known = labelled_sample(docs, labels, label, learn, rows, "toxicity")
    known = cut_lineage(map_texts(known, "text", ["doc_id", "label"], read, [("f", longs), ("gone", longs), ("come", longs)]))
    sums = known.groupBy("label").count().toPandas().set_index("label")["count"]
    n1, n0 = int(sums.get(1, 0)), int(sums.get(0, 0))
    seen = known.select("label", F.explode(F.array_distinct("f")).alias("f")).groupBy("f")
    seen = seen.agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")).where(
        F.col("a") + F.col("b") >= LEAST_DOCUMENTS
    )
    gap = F.abs(F.col("a") / max(n1, 1) - F.col("b") / max(n0, 1))
    spread = F.sqrt((F.col("a") + F.col("b")) / max(n0 + n1, 1))
    best = seen.orderBy((gap / spread).desc(), "f").limit(features).select("f").toPandas()["f"].tolist()
    best = sorted({*best, *[f for w in other for f in word_features(w)]})
    place = {f: i for i, f in enumerate(best)}

    def chosen(batches):
        for b in batches:
            lists = [[[place[f] for f in x if f in place] for x in b.column(c).to_pylist()] for c in ("f", "gone", "come")]
            columns = [pa.array(x, type=longs) for x in lists]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), *columns], ["doc_id", "label", "f", "gone", "come"])

    found = known.mapInArrow(chosen, known.schema).toPandas()
    found = found.assign(_n=found["f"].map(len)).sort_values(["doc_id", "_n"], kind="stable")
    lists, y = [list(f) for f in found["f"]], found["label"].to_numpy(dtype=float)
    changes = [(list(g), list(c)) for g, c in zip(found["gone"], found["come"], strict=True)]
    used, held = np.flatnonzero(np.arange(len(y)) % 5 > 0), np.flatnonzero(np.arange(len(y)) % 5 == 0)
    w, bias = fit([lists[i] for i in used], y[used], [changes[i] for i in used if any(changes[i])], best, penalty)
    logits = np.array([w[np.array(lists[i], dtype=np.int64)].sum() + bias for i in held])
    slope, shift = calibrated(logits, y[held])
    return Model({f: float(x * slope) for f, x in zip(best, w, strict=True) if x}, bias * slope + shift)


def scored(docs: DataFrame, model: Model, keep: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """Columns `keep` with score and predicted; every text is read whole, NULL as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: list[str]) -> list:
        p = [shared.value.probability(t) for t in texts]
        return [p, [int(x >= threshold) for x in p]]

    return map_texts(docs, "text", keep, score, [("score", pa.float64()), ("predicted", pa.int32())])


def op4_toxicity(spark, sf_dir) -> DataFrame:
    """Toxicity of all documents."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"), held_out(3, 1, inside=False))
    found = scored(docs, model, ["doc_id"])
    return found.select("doc_id", F.coalesce(held_out(3, 1), F.lit(False)).alias("held_out"), "score", "predicted")
