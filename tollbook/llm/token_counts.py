"""Exact token counts of every prefix of a text, by dynamic programming.

For a piece vocabulary with merges, the tokens of a prefix are those of a shorter
prefix and one more token, and just one token fits there: the one compatible with
the last token of the shorter prefix. So the count at every prefix follows from
counts before it, and truncation and budget questions need no encoding at all.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .merges import MEMO, MergeTable
from .rows import column_of, map_slices, texts_of

SPACE = "▁"
LONGEST_KEPT = 64


class PrefixCounter:
    """Prefix counts under a sentencepiece BPE model with byte fallback and a plain normaliser."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        kept = [
            i
            for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in kept}
        order = {score: rank for rank, score in enumerate(sorted(set(pieces.values()), reverse=True))}
        if model.normalize(" a  b ") != f"{SPACE}{SPACE}a{SPACE}{SPACE}b{SPACE}":
            raise ValueError("the model rewrites texts before it splits them")
        if any(SPACE in piece.lstrip(SPACE) for piece in pieces):
            raise ValueError("a piece of the model holds a space after other characters")
        self.table = MergeTable({piece: order[score] for piece, score in pieces.items()})
        #: Tokens of a single character: one if it is a piece, else its bytes.
        self.single = {piece: 1 for piece in pieces if len(piece) == 1}
        self.automaton = self.table.automaton(set(self.single))
        alone = "".join(c for c in "\n\t\r" if not any(c in piece and len(piece) > 1 for piece in pieces))
        self.segment = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+|[{alone}]+" if alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self._segments: dict[str, bytes] = {}

    def _steps(self, segment: str) -> bytes:
        """Change of the count at each character of a segment, one signed byte each."""
        fits, single = self.table.fits, self.single
        last, counts, steps = [""], [0], bytearray()
        done, total = 0, 0
        for end, token in chain(self.automaton.iter(segment), [(len(segment), "")]):
            while done < end:  # characters that are no piece: a token for each byte
                total += len(segment[done].encode())
                steps.append(len(segment[done].encode()))
                last.append(segment[done])
                counts.append(total)
                done += 1
            if done > end or not token:
                continue  # the one token that fits here is found
            start = end + 1 - len(token)
            if not start or fits[last[start], token]:
                now = counts[start] + (1 if len(token) > 1 else single[token])
                steps.append((now - total) & 255)
                last.append(token)
                counts.append(now)
                done, total = end + 1, now
        return bytes(steps)

    def steps(self, text: str) -> np.ndarray:
        """Change of the token count at each code point of ``text``, as ``int8``.

        No piece crosses the edge before a space, so the counts of a text are those
        of its segments added up. Repeated segments come from a bounded memo.
        """
        if not text:
            return np.zeros(0, np.int8)
        known = self._segments
        if len(known) > MEMO:
            known.clear()
        parts = self.segment.findall(SPACE + text.replace(" ", SPACE))
        long = {}
        for part in set(parts):
            if part not in known:
                (known if len(part) <= LONGEST_KEPT else long)[part] = self._steps(part)
        joined = b"".join([known.get(p) or long[p] for p in parts] if long else map(known.__getitem__, parts))
        steps = np.frombuffer(joined, np.int8)
        # The space put before the text belongs to the first code point.
        first = np.array([steps[0] + steps[1]], np.int8)
        return np.concatenate([first, steps[2:]])

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of ``text[:i]`` for each i from 0 to its length."""
        return np.concatenate([[0], np.cumsum(self.steps(text), dtype=np.int64)])


@lru_cache(maxsize=4)
def load(path: str) -> PrefixCounter:
    """One counter per worker process and model."""
    return PrefixCounter(path)


def counts_of(steps: bytes) -> np.ndarray:
    """The stored steps of a text as its prefix counts, from the empty prefix on."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)])


def longest_within(counts: np.ndarray, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens (counts may also fall)."""
    return int(np.flatnonzero(counts <= budget)[-1])


def prefix_tables(documents: DataFrame, model: str, budget: int, keep_steps: bool = True) -> DataFrame:
    """Token counts of every text with the table of its prefixes.

    ``doc_id, n_bytes, n_tokens, over_limit, kept_chars, steps``: ``steps`` holds one
    signed byte per code point, whose running sum is the exact count of each prefix
    (``counts_of``); ``kept_chars`` is the longest prefix within ``budget`` tokens.
    ``keep_steps=False`` leaves the stored table out. A null text is the empty one:
    no bytes, no tokens, not over. One row out per row in, whatever repeats.
    """

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        counter = load(model)
        n_bytes, n_tokens, kept, tables = [], [], [], []
        for text in texts_of(batch):
            steps = counter.steps(text)
            counts = np.cumsum(steps, dtype=np.int64)
            total = int(counts[-1]) if len(counts) else 0
            n_bytes.append(len(text.encode()))
            n_tokens.append(total)
            kept.append(len(text) if total <= budget else longest_within(np.concatenate([[0], counts]), budget))
            if keep_steps:
                tables.append(steps.tobytes())
        out = {
            "doc_id": column_of(batch, "doc_id"),
            "n_bytes": pa.array(n_bytes, pa.int64()),
            "n_tokens": pa.array(n_tokens, pa.int64()),
            "over_limit": pa.array([n > budget for n in n_tokens], pa.bool_()),
            "kept_chars": pa.array(kept, pa.int64()),
        }
        return out | ({"steps": pa.array(tables, pa.binary())} if keep_steps else {})

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, kept_chars long"
    return map_slices(documents.select("doc_id", "text"), schema + ", steps binary" * keep_steps, work)


def truncated(documents_with_steps: DataFrame, budget: int) -> DataFrame:
    """``doc_id, kept_chars`` under another budget, from stored steps alone."""

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        kept = [longest_within(counts_of(s or b""), budget) for s in column_of(batch, "steps").to_pylist()]
        return {"doc_id": column_of(batch, "doc_id"), "kept_chars": pa.array(kept, pa.int64())}

    return map_slices(documents_with_steps.select("doc_id", "steps"), "doc_id long, kept_chars long", work, "steps")
