"""BagMinHash signatures of bags of word shingles.

A bag is a set of shingles with counts. Each shingle has a Poisson process of
points over (time, weight level): a point counts for a bag if its level lies within
the shingle's count there, and each point falls on one component of the signature,
which keeps the earliest. Two bags agree in a component with the probability of
their weighted Jaccard similarity. Levels are discretised to counts and the
processes split over blocks (0,1], (1,2], (2,4], (4,8] ...: a count needs the whole
blocks below it and a thinned one, so a shingle that occurs a thousand times costs
eleven processes and not a thousand. Only points before the latest component can
matter, which is about one draw per shingle and not one per component.
"""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
ROWS, BANDS = 4, 25
COMPONENTS = ROWS * BANDS
MEMO = 300_000

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P = np.uint64(0xD6E8FEB86659FD93)
_words: dict[str, int] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of each number (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + _A
        x = (x ^ (x >> np.uint64(30))) * _B
        x = (x ^ (x >> np.uint64(27))) * _C
        return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from the high bits of each hash."""
    return ((x >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53


def word_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word; repeated words come from a bounded memo."""
    if len(_words) > MEMO:
        _words.clear()
    for word in set(words):
        if word not in _words:
            _words[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def bag(text: str, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the runs of ``size`` words (lower case, split at white space).

    A text of fewer words is one shingle; one without words has none.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = word_hashes(words)
    width = min(size, len(words))
    n = len(words) - width + 1
    with np.errstate(over="ignore"):
        out = hashes[:n].copy()
        for k in range(1, width):
            out = out * _P + hashes[k : k + n]
    return np.unique(mixed(out), return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags; two bags without shingles are alike."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 1.0
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][left], b[1][right]).sum())
    return common / (total - common)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], components: int = COMPONENTS) -> np.ndarray:
    """The BagMinHash signatures of bags that are not empty: a row of 64-bit values per bag."""
    out = np.zeros((len(bags), components), np.uint64)
    if not bags:
        return out
    sizes = np.array([len(hashes) for hashes, _ in bags])
    hashes, counts = (np.concatenate(parts) for parts in zip(*bags, strict=True))
    of_bag = np.repeat(np.arange(len(bags)), sizes)
    # One process per shingle and block of levels: its rate is the block's width.
    n_blocks = np.ceil(np.log2(counts)).astype(np.int64) + 1
    of = np.repeat(np.arange(len(counts)), n_blocks)
    block = np.arange(len(of)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
    rate = 2.0 ** np.maximum(block - 1, 0)
    low = np.where(block > 0, rate, 0.0)
    top, home = counts[of].astype(float), of_bag[of]
    seed = mixed(hashes[of] ^ mixed(block.astype(np.uint64)))
    first = -np.log(unit(mixed(seed))) / rate
    # Time by which, most likely, every component of a bag has had a point.
    weight = np.bincount(of_bag, counts, len(bags))
    limit = components * (np.log(components) + 3.0) / weight
    todo = np.ones(len(bags), bool)
    while todo.any():
        best = np.full(len(bags) * components, np.inf)
        mark = np.zeros(len(bags) * components, np.uint64)
        alive = np.flatnonzero(todo[home] & (first <= limit[home]))
        time, state, step = first[alive], seed[alive], 1
        while len(alive):
            state = mixed(state + np.uint64(step))
            where = (mixed(state ^ _B) % np.uint64(components)).astype(np.intp) + home[alive] * components
            inside = low[alive] + rate[alive] * unit(mixed(state ^ _C)) <= top[alive]
            sooner = np.flatnonzero(inside & (time < best[where]))
            w, t, s = where[sooner], time[sooner], state[sooner]
            order = np.argsort(-t, kind="stable")  # the earliest is written last
            best[w[order]], mark[w[order]] = t[order], s[order]
            time = time - np.log(unit(mixed(state))) / rate[alive]
            keep = time <= limit[home[alive]]
            alive, time, state, step = alive[keep], time[keep], state[keep], step + 1
        full = np.isfinite(best).reshape(len(bags), components).all(1) & todo
        out[full] = mark.reshape(len(bags), components)[full]
        todo &= ~full
        limit *= 2.0
    return out


def bands(marks: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band of ``rows`` components of each signature, different between bands."""
    with np.errstate(over="ignore"):
        key = np.arange(1, marks.shape[1] // rows + 1, dtype=np.uint64) * _A
        for k in range(rows):
            key = mixed(key ^ marks[:, k::rows][:, : key.shape[-1]])
    return key
