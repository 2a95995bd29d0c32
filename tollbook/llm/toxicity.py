"""Toxic spans by a linear-chain conditional random field, and document scores from it.

Tokens are labelled from document labels: words and word beginnings that stand in
many contexts of toxic documents and (nearly) never in others mark tokens of the
toxic ones; all other tokens are clean. The field (two states, weights of words and
beginnings, transitions) is fitted to those tokens. Forward-backward marginals give
the offending spans; the expected number of toxic tokens gives the document's score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, training_rows
from .rows import column_of, map_slices, slices, texts_of

#: At most so many labelled rows are learned from, none longer than this many characters.
TRAINING_ROWS, TRAINING_CHARS = 6_000, 20_000
BEGINNINGS = (4, 5, 6, 7)
#: A feature marks toxic tokens if it has so many contexts in toxic documents and so small a share elsewhere.
LEAST_SUPPORT, CLEAN_SHARE = 4, 0.05
STEPS, L2 = 40, 1e-4
THRESHOLD = 0.5
NEGLIGIBLE = 0.05
BLOCK = 256
#: Tokens that are fitted at a time, about.
STRETCH = 300_000
MEMO = 400_000
WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return [word, *(f"{word[:n]}-" for n in BEGINNINGS if len(word) >= n)]


def marginals(
    emission: np.ndarray, first: np.ndarray, transition: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over many documents laid end to end.

    ``emission`` is each token's weight for the toxic state, ``first`` marks the
    first token of each document. Returns each token's probability of the toxic
    state, the expected transitions (2 x 2, none into first tokens) and the log of
    the partition functions. The chain is cut in blocks that step together; a first
    pass multiplies each block's 2 x 2 matrices, so the values at all block edges
    follow from one short walk, and a second pass fills the blocks.
    """
    n = len(emission)
    if not n:
        return np.zeros(0), np.zeros((2, 2)), 0.0
    length = min(BLOCK, n)
    blocks = -(-n // length)
    size = length * blocks

    def laid(values: np.ndarray, fill: float) -> np.ndarray:
        return np.concatenate([values, np.full(size - n, fill)]).reshape(blocks, length).T.copy()

    # Tokens after the last are clean for sure and start documents of their own.
    toxic = laid(np.exp(np.clip(emission, -40, 40)), 0.0)
    begins = laid(first.astype(float), 1.0) > 0
    t, s = np.exp(transition), np.exp(start)
    m = [[np.where(begins, s[j], t[i, j]) * (toxic if j else 1.0) for j in (0, 1)] for i in (0, 1)]
    p = [[np.ones(blocks), np.zeros(blocks)], [np.zeros(blocks), np.ones(blocks)]]
    logs = np.zeros(blocks)
    for k in range(length):
        a, b, c, d = m[0][0][k], m[0][1][k], m[1][0][k], m[1][1][k]
        p = [[row[0] * a + row[1] * c, row[0] * b + row[1] * d] for row in p]
        total = p[0][0] + p[0][1] + p[1][0] + p[1][1]
        p = [[x / total for x in row] for row in p]
        logs += np.log(total)
    ahead, behind = np.empty((blocks, 2)), np.empty((blocks, 2))
    (p00, p01), (p10, p11) = ([x.tolist() for x in row] for row in p)
    x, y, log_z = 1.0, 0.0, 0.0
    for k in range(blocks):
        ahead[k] = x, y
        x, y = x * p00[k] + y * p10[k], x * p01[k] + y * p11[k]
        total = x + y
        log_z += np.log(total)
        x, y = x / total, y / total
    x = y = 0.5
    for k in range(blocks - 1, -1, -1):
        behind[k] = x, y
        x, y = p00[k] * x + p01[k] * y, p10[k] * x + p11[k] * y
        x, y = x / (x + y), y / (x + y)
    forward = np.empty((length, 2, blocks))
    x, y = ahead[:, 0].copy(), ahead[:, 1].copy()
    for k in range(length):
        x, y = x * m[0][0][k] + y * m[1][0][k], x * m[0][1][k] + y * m[1][1][k]
        total = x + y
        x, y = x / total, y / total
        forward[k, 0], forward[k, 1] = x, y
    out = np.empty((length, blocks))
    expected = np.zeros((2, 2))
    x, y = behind[:, 0].copy(), behind[:, 1].copy()
    for k in range(length - 1, -1, -1):
        on, off = forward[k, 1] * y, forward[k, 0] * x
        out[k] = on / (on + off)
        before = forward[k - 1] if k else ahead.T
        into = [[before[i] * m[i][j][k] * (y if j else x) for j in (0, 1)] for i in (0, 1)]
        total = into[0][0] + into[0][1] + into[1][0] + into[1][1]
        inner = ~begins[k]
        for i in (0, 1):
            for j in (0, 1):
                expected[i, j] += (into[i][j] / total)[inner].sum()
        x, y = m[0][0][k] * x + m[0][1][k] * y, m[1][0][k] * x + m[1][1][k] * y
        total = x + y
        x, y = x / total, y / total
    # Padding tokens are documents that are clean for sure: each adds the weight of a clean start.
    log_z += float(logs.sum()) - (size - n) * float(start[0])
    return out.T.reshape(-1)[:n], expected, log_z


@dataclass
class Field:
    """A fitted field. ``slope`` and ``shift`` turn expected toxic tokens into a score."""

    weights: dict[str, float]
    bias: float
    transition: np.ndarray
    start: np.ndarray
    slope: float
    shift: float
    _words: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_words": {}}

    def word_weight(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))

    def token_marginals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Probability of the toxic state of every token, and each text's number of tokens."""
        known = self._words
        if len(known) > MEMO:
            known.clear()
        weights, sizes = [], []
        for text in texts:
            words = WORD.findall(text.lower())
            for word in set(words):
                if word not in known:
                    known[word] = self.word_weight(word)
            weights.append(np.fromiter(map(known.__getitem__, words), float, len(words)))
            sizes.append(len(words))
        sizes = np.array(sizes, np.int64)
        emission = np.concatenate(weights) if weights else np.zeros(0)
        first = np.zeros(len(emission), bool)
        first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
        return marginals(emission, first, self.transition, self.start)[0], sizes

    def expected(self, texts: list[str]) -> np.ndarray:
        """Expected number of toxic tokens of each text; none in the empty one.

        Marginals below ``NEGLIGIBLE`` count as none: they would add up in long texts.
        """
        return self._counted(*self.token_marginals(texts))

    def _counted(self, p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        p = np.where(p < NEGLIGIBLE, 0.0, p)
        sums = np.concatenate([[0.0], np.cumsum(p)])
        ends = np.cumsum(sizes)
        return np.maximum(sums[ends] - sums[ends - sizes], 0.0)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1 of each text."""
        return self._scored(self.expected(texts))

    def _scored(self, expected: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * _log_count(expected) + self.shift)))

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Runs of tokens that are toxic with probability one half or more, as code-point offsets."""
        return self.scores_and_spans([text])[1][0]

    def scores_and_spans(self, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        """``scores`` and ``spans`` of each text, from the same marginals."""
        p, sizes = self.token_marginals(texts)
        ends, toxic = np.cumsum(sizes), p >= 0.5
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        for k in np.unique(np.searchsorted(ends, np.flatnonzero(toxic), side="right")).tolist():
            spans[k] = _runs(texts[k], toxic[ends[k] - sizes[k] : ends[k]])
        return self._scored(self._counted(p, sizes)), spans


def _runs(text: str, toxic: np.ndarray) -> list[tuple[int, int]]:
    lowered = text.lower()
    out: list[tuple[int, int]] = []
    before = False
    for match, on in zip(WORD.finditer(lowered), toxic.tolist(), strict=True):
        if on:
            out.append((out.pop()[0] if before else match.start(), match.end()))
        before = on
    if len(lowered) != len(text):  # some code points are several in lower case
        at = [k for k, c in enumerate(text) for _ in c.lower()]
        out = [(at[a], at[b - 1] + 1) for a, b in out]
    return out


def _log_count(expected: np.ndarray) -> np.ndarray:
    return np.log(expected + 1e-3)


def telling_features(documents: list[np.ndarray], words: list[str], toxic: np.ndarray) -> set[str]:
    """The features of toxic documents that (nearly) no clean one has.

    Documents are arrays of indices into ``words``. A feature's support is the number
    of different neighbours (word before, word after) it has in toxic documents.
    Copies repeat a word with its neighbours, so the other words of a toxic document
    gain nothing by its being copied.
    """
    clean, places = np.zeros(len(words), np.int64), []
    for ids, label in zip(documents, toxic, strict=True):
        if label:
            padded = np.concatenate([[-1], ids, [-1]])
            places.append(np.stack([padded[1:-1], padded[:-2], padded[2:]], 1))
        else:
            clean[np.unique(ids)] += 1
    around = np.unique(np.concatenate(places), axis=0)
    contexts = np.bincount(around[:, 0], minlength=len(words))
    support: Counter[str] = Counter()
    against: Counter[str] = Counter()
    for k in np.flatnonzero(contexts).tolist():
        for f in features(words[k]):
            support[f] += int(contexts[k])
    for k in np.flatnonzero(clean).tolist():
        for f in features(words[k]):
            if f in support:
                against[f] += int(clean[k])
    return {f for f, n in support.items() if n >= LEAST_SUPPORT and against[f] <= CLEAN_SHARE * n}


def _stretches(documents: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Documents laid end to end in stretches of about ``STRETCH`` tokens, with the first tokens marked."""
    out, held, size = [], [], 0
    for k, ids in enumerate(documents):
        held += [ids] if len(ids) else []
        size += len(ids)
        if held and (size >= STRETCH or k == len(documents) - 1):
            first = np.zeros(size, bool)
            first[np.cumsum([0, *map(len, held[:-1])])] = True
            out.append((np.concatenate(held), first))
            held, size = [], 0
    return out


def fit(texts: list[str], labels: np.ndarray, steps: int = STEPS) -> Field:
    """Fits the field and the score to labelled texts; one class gives a constant score."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    constant = Field({}, -20.0, np.zeros((2, 2)), np.zeros(2), 0.0, float(np.log(share / (1 - share))))
    if not len(labels) or labels.min() == labels.max():
        return constant
    index: dict[str, int] = {}
    documents = [
        np.array([index.setdefault(word, len(index)) for word in WORD.findall(text.lower())], np.int32) for text in texts
    ]
    vocabulary = list(index)
    marks = telling_features(documents, vocabulary, labels)
    if not marks:
        return constant
    marked = np.array([any(f in marks for f in features(word)) for word in vocabulary])
    # Tokens of toxic documents follow those of clean ones, where no token is toxic.
    toxic_tokens = _stretches([ids for ids, label in zip(documents, labels, strict=True) if label])
    clean_tokens = _stretches([ids for ids, label in zip(documents, labels, strict=True) if not label])
    parts = [(ids, first, (marked[ids] * 1)) for ids, first in toxic_tokens]
    parts += [(ids, first, np.zeros(len(ids), np.int64)) for ids, first in clean_tokens]
    # Only features of tokens that are toxic somewhere get weights; the rest is the bias.
    toxic_words = [word for word, is_marked in zip(vocabulary, marked.tolist(), strict=True) if is_marked]
    names = {f: k for k, f in enumerate(dict.fromkeys(f for word in toxic_words for f in features(word)))}
    pairs = [(k, names[f]) for k, word in enumerate(vocabulary) for f in features(word) if f in names]
    word_of, name_of = (np.array(column, np.int64) for column in zip(*pairs, strict=True))
    n_tokens = sum(len(ids) for ids, _, _ in parts)
    weights, bias = np.zeros(len(names)), -8.0
    transition, start = np.zeros((2, 2)), np.zeros(2)
    sums = [np.full(len(names), 1e-8), 1e-8, np.full((2, 2), 1e-8), np.full(2, 1e-8)]
    for _ in range(steps):  # AdaGrad on the log-likelihood
        of_word = bias + np.bincount(word_of, weights[name_of], len(vocabulary))
        by_word = np.zeros(len(vocabulary))
        slopes = [-L2 * n_tokens * weights / 1000, 0.0, np.zeros((2, 2)), np.zeros(2)]
        for ids, first, state in parts:
            p, expected, _ = marginals(of_word[ids], first, transition, start)
            by_word += np.bincount(ids, state - p, len(vocabulary))
            inner = ~first[1:]
            seen = np.bincount((2 * state[:-1] + state[1:])[inner], minlength=4).reshape(2, 2)
            slopes[2] += seen - expected
            gap = float((state - p)[first].sum())
            slopes[3] += np.array([-gap, gap])
        slopes[0] = slopes[0] + np.bincount(name_of, by_word[word_of], len(names))
        slopes[1] = float(by_word.sum())
        for k, slope in enumerate(slopes):
            sums[k] = sums[k] + slope**2
        move = [slope / np.sqrt(total) for slope, total in zip(slopes, sums, strict=True)]
        weights, bias = weights + move[0], bias + 0.1 * float(move[1])
        transition, start = transition + 0.2 * move[2], start + 0.2 * move[3]
    fitted = Field(dict(zip(names, weights.tolist(), strict=True)), bias, transition, start, 1.0, 0.0)
    counts = _log_count(np.concatenate([fitted.expected(texts[k : k + 500]) for k in range(0, len(texts), 500)]))
    fitted.slope, fitted.shift = _logistic(counts, labels)
    return fitted


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with a weak penalty on the slope."""
    slope = shift = 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-(slope * x + shift)))
        w = p * (1 - p) + 1e-9
        gradient = np.array([((y - p) * x).sum() - 0.1 * slope, (y - p).sum()])
        curve = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum()]])
        step = np.linalg.solve(curve, gradient)
        step *= min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        slope, shift = slope + step[0], shift + step[1]
    return float(slope), float(shift)


def train(documents: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS, chars: int = TRAINING_CHARS) -> Field:
    """Fits the field to at most ``most`` labelled texts of at most ``chars`` characters outside the held-out fold."""
    sample = training_rows(documents, labels, "toxic", most).filter(F.char_length("text") <= chars)
    rows = sample.toPandas().sort_values(["label", "text"])
    return fit(rows["text"].tolist(), rows["label"].to_numpy(float))


def score_documents(documents: DataFrame, model: Field, threshold: float = THRESHOLD, spans: bool = False) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every text, and on request ``spans``.

    ``spans`` are the offending runs as ``array<struct<begin, end>>`` in code points.
    A null text is the empty one and has no tokens. One row out per row in.
    """

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        texts = texts_of(batch)
        score, found = model.scores_and_spans(texts) if spans else (model.scores(texts), [])
        out = {
            "doc_id": column_of(batch, "doc_id"),
            "held_out": column_of(batch, "held_out"),
            "score": pa.array(score),
            "predicted": pa.array((score >= threshold).astype(np.int32)),
        }
        if spans:
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            out["spans"] = pa.array([[{"begin": a, "end": b} for a, b in runs] for runs in found], kind)
        return out

    rows = documents.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    schema = "doc_id long, held_out boolean, score double, predicted int"
    return map_slices(rows, schema + ", spans array<struct<begin: long, end: long>>" * spans, work)


def keep_clean(documents: DataFrame, model: Field, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                yield rows.filter(pa.array(model.scores(texts_of(rows)) < threshold))

    return documents.mapInArrow(run, documents.schema)
