"""Quality classifier: Bradley-Terry ranking of documents.

A document's strength is a linear function of text statistics. Pairs of one preferred and
one rejected document teach it by logistic loss on the difference of their features. The
cut between kept and rejected is a quantile of the training strengths: the share of
rejected labels. ``score`` is the logistic of the distance from that cut.

Training uses at most ``max_labelled`` labelled documents, those with the smallest hash of
their id, and at most ``max_pairs`` pairs; scoring covers every row.

Defined cases: null text is empty and scored like one; with no labels, or labels of one
class only, every score is 0.5. Labels that are null or whose document is missing are left
out; of several labels of one id the lower counts. Rows with null ids are scored and teach
nothing; repeated ids get their own rows. Documents of equal statistics have equal scores.
Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_bytes

MAX_LABELLED = 20_000
MAX_PAIRS = 60_000

CLASSES = ("lower", "upper", "digit", "blank", "newline", "wide", "stop", "comma", "bang", "marks", "pipe", "other")


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("other"), np.int64)
    for name, chars in (("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("blank", b" \t\r\x0b\x0c"), ("newline", b"\n"), ("wide", range(128, 256)), ("stop", b".?;:"), ("comma", b","), ("bang", b"!"), ("marks", b"#*$%&<>"), ("pipe", b"|")):
        table[list(chars)] = CLASSES.index(name)
    return table


CLASS_OF = _class_table()
N_FEATURES = len(CLASSES) + 9


def features(text: bytes) -> np.ndarray:
    """Statistics of one whole text, all of them bounded."""
    counts = np.zeros(len(CLASSES))
    np.add.at(counts, CLASS_OF, np.bincount(np.frombuffer(text, np.uint8), minlength=256))
    n = max(1, len(text))
    words = text.split()
    m = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    pairs = max(1, len(words) - 1)
    letters = max(1.0, counts[0] + counts[1] + counts[5])
    extra = (
        np.log1p(len(words)) / 10,
        min(1.0, 10 / (1 + len(words))),
        min(40, len(text) / m) / 40,
        len(set(words)) / m,
        len(set(zip(words, words[1:]))) / pairs,
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        min(1.0, counts[1] / letters),
        float(counts[8] + counts[9] + counts[10]) / (m + float(counts[8] + counts[9] + counts[10])),
        min(1.0, (counts[6] + counts[7]) / m),
    )
    return np.concatenate([np.sqrt(counts / n), extra])


@dataclass
class Ranker:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        strength = np.clip((x - self.mean) / self.spread, -6, 6) @ self.weights
        return 1 / (1 + np.exp(-np.clip(strength - self.cut, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, max_pairs: int = MAX_PAIRS, steps: int = 400, decay: float = 1e-3, seed: int = 7) -> Ranker:
    """Learn strengths from pairs of a row with y 1 and a row with y 0."""
    if not len(y) or y.min() == y.max():
        return Ranker(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES), 0.0)
    mean, spread = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = np.clip((x - mean) / spread, -6, 6)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    rng = np.random.default_rng(seed)
    n = min(max_pairs, 4 * len(y))
    # every document takes part, in turn
    diff = z[rng.permutation(np.resize(good, n))] - z[rng.permutation(np.resize(bad, n))]
    w, m, v = np.zeros(z.shape[1]), 0.0, 0.0
    for t in range(1, steps + 1):
        grad = -(diff / (1 + np.exp(np.clip(diff @ w, -30, 30)))[:, None]).mean(0) + decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    strength = z @ w
    # Halfway between the two documents that the quantile falls between.
    order = np.sort(strength)
    k = min(len(order) - 1, max(1, len(bad)))
    return Ranker(mean, spread, w, float((order[k - 1] + order[k]) / 2))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Ranker:
    """``labels(doc_id, quality)`` holds the rows that may be learned from."""
    chosen = labels.select("doc_id", "quality").filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    rows = docs.select("doc_id", text_bytes().alias("text")).join(F.broadcast(chosen), "doc_id")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t).tolist() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("quality"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    table = rows.select("doc_id", F.col("quality").cast("int").alias("quality"), "text").mapInArrow(featured, "doc_id long, quality int, x array<double>").collect()
    table.sort(key=lambda r: (r["doc_id"], r["x"]))
    return fit(np.array([r["x"] for r in table]).reshape(len(table), N_FEATURES), np.array([r["quality"] for r in table]))


def classify(docs: DataFrame, ranker: Ranker) -> DataFrame:
    """doc_id and score of every row of ``docs(doc_id, text)``."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = np.array([features(t) for t in b.column("text").to_pylist()]).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ranker.scores(x), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(scored, "doc_id long, score double")


def kept_documents(docs: DataFrame, ranker: Ranker) -> DataFrame:
    """The rows of ``docs`` that score 0.5 or more, with all their columns."""

    def sifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = np.array([features((t or "").encode()) for t in b.column("text").to_pylist()]).reshape(-1, N_FEATURES)
            yield b.filter(pa.array(ranker.scores(x) >= 0.5, pa.bool_()))

    return docs.mapInArrow(sifted, docs.schema)
