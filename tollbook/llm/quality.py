"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

Trees are grown level by level from histograms of binned statistics, and kept as
flat arrays of complete binary trees, so a batch of documents walks all of them in
a few numpy steps per level.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, training_rows
from .rows import column_of, map_slices, slices, texts_of

#: At most so many labelled rows are learned from.
TRAINING_ROWS = 20_000
TREES, DEPTH, BINS = 80, 4, 64
RATE, SMOOTH, LEAST_WEIGHT = 0.2, 1.0, 2.0
THRESHOLD = 0.3

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" \t",
    "line": b"\n",
    "stop": b".,;:",
    "mark": b"!?",
    "bar": b"|",
    "quote": b"'\"",
    "odd": b"#$%&*+<=>@^_`{}~\\/[]()",
}
#: Counts of bytes, times this, are counts of each class.
_CLASS_OF = np.zeros((256, len(_CLASSES) + 1))
for _k, _chars in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_chars), _k] = 1
_CLASS_OF[128:, len(_CLASSES)] = 1


def statistics(text: str) -> list[float]:
    """Statistics of a whole text; all zero for the empty one."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(raw):
        return [0.0] * N_STATISTICS
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    counts = Counter(words)
    shares = np.bincount(raw, minlength=256) @ _CLASS_OF / len(raw)
    repeats = sum(map(eq, words, words[1:]))
    return [
        *shares.tolist(),
        float(np.log1p(len(raw))),
        float(np.log1p(len(words))),
        len(text) / n,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        repeats / n,
        sum(map(str.isupper, words)) / n,
        len(set(lines)) / len(lines),
        n / len(lines),
        max(map(len, words), default=0) / len(text),
        sum(1 for word in words if word[-1] in "!$%&#*|") / n,
    ]


N_STATISTICS = len(_CLASSES) + 1 + 11


@dataclass(frozen=True)
class Forest:
    """Complete binary trees as arrays: node k has children 2k+1 and 2k+2."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # go right above it
    leaf: np.ndarray  # trees x leaves

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.intp)
            for _ in range(self.leaf.shape[1].bit_length() - 1):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Boosts trees on the logistic loss; one class or no rows give a constant."""
    inner, n_features = (1 << depth) - 1, x.shape[1]
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Forest(base, np.zeros((0, inner), np.intp), np.zeros((0, inner)), np.zeros((0, 1 << depth)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(n_features)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(n_features)])
    score, forest = np.full(len(y), base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.intp), np.full(inner, np.inf)
        node = np.zeros(len(y), np.intp)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            best = np.zeros(width)
            at = (node - first) * BINS
            for f in range(n_features):
                cell = at + binned[f]
                g = np.bincount(cell, gradient, width * BINS).reshape(width, BINS).cumsum(1)
                h = np.bincount(cell, weight, width * BINS).reshape(width, BINS).cumsum(1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + SMOOTH) + (g_all - g) ** 2 / (h_all - h + SMOOTH) - g_all**2 / (h_all + SMOOTH)
                gain[(h < LEAST_WEIGHT) | (h_all - h < LEAST_WEIGHT)] = 0
                gain[:, len(edges[f]) :] = 0
                cut = gain.argmax(1)
                found = gain[np.arange(width), cut]
                for k in np.flatnonzero(found > best + 1e-9):
                    best[k], feature[first + k], threshold[first + k] = found[k], f, edges[f][cut[k]]
            go_right = x[np.arange(len(y)), feature[node]] > threshold[node]
            node = 2 * node + 1 + go_right
        leaf_of = node - inner
        g = np.bincount(leaf_of, gradient, inner + 1)
        h = np.bincount(leaf_of, weight, inner + 1)
        leaf = -RATE * g / (h + SMOOTH)
        score += leaf[leaf_of]
        forest.append((feature, threshold, leaf))
    return Forest(base, *(np.stack(parts) for parts in zip(*forest, strict=True)))


def _matrix(texts: list[str]) -> np.ndarray:
    return np.array([statistics(text) for text in texts]).reshape(len(texts), N_STATISTICS)


def train(documents: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> Forest:
    """Fits the forest to at most ``most`` labelled rows outside the held-out fold.

    Their statistics are computed where the texts are; only those reach the driver.
    """
    sample = training_rows(documents, labels, "quality", most)

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        flat = _matrix(texts_of(batch))
        return {"label": column_of(batch, "label"), "x": pa.array(list(flat), pa.list_(pa.float64()))}

    rows = map_slices(sample, "label int, x array<double>", work).toPandas()
    # Rows arrive in any order; the fit sums them, so a fixed order gives fixed trees.
    rows = rows.assign(key=[tuple(x) for x in rows["x"]]).sort_values(["label", "key"])
    x = np.array(rows["x"].tolist()).reshape(len(rows), N_STATISTICS)
    return fit(x, rows["label"].to_numpy(float))


def score_documents(documents: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every text.

    A null text is the empty one, whose statistics are zero. One row out per row in.
    """

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        score = forest.scores(_matrix(texts_of(batch)))
        return {
            "doc_id": column_of(batch, "doc_id"),
            "held_out": column_of(batch, "held_out"),
            "score": pa.array(score),
            "predicted": pa.array((score >= threshold).astype(np.int32)),
        }

    rows = documents.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return map_slices(rows, "doc_id long, held_out boolean, score double, predicted int", work)


def keep_good(documents: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score ``threshold`` or more, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                yield rows.filter(pa.array(forest.scores(_matrix(texts_of(rows))) >= threshold))

    return documents.mapInArrow(run, documents.schema)

