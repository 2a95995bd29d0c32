"""Merge order of a byte-pair vocabulary, and which tokens can stand side by side.

Tokens are strings over base symbols of one character each (bytes as Latin-1, or
Unicode characters). A token sequence is what the merges make of its text exactly
if every two neighbours are: so one memoised test of two tokens replaces the merges.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick

NEVER = 1 << 60
#: Entries of a memo before it is emptied; bounds a worker's memory.
MEMO = 300_000


class PairMemo(dict):
    """``memo[left, right]``: whether the two tokens can be neighbours; emptied when full."""

    def __init__(self, table: MergeTable) -> None:
        self.table = table

    def __missing__(self, pair: tuple[str, str]) -> bool:
        if len(self) >= MEMO:
            self.clear()
        self[pair] = fits = self.table.compatible(*pair)
        return fits


class MergeTable:
    """Ranks of the merged tokens (lower merges first). A token ranks above its parts."""

    def __init__(self, ranks: dict[str, int]) -> None:
        self.ranks = {token: rank for token, rank in ranks.items() if len(token) > 1}
        self.longest = max(map(len, ranks), default=1)
        self.fits = PairMemo(self)
        self._right: dict[str, tuple[list[str], list[int]]] = {}
        self._left: dict[str, tuple[list[str], list[int]]] = {}

    def merge(self, text: str) -> list[str]:
        """Plain merging, lowest rank and then leftmost first; quadratic, for short texts."""
        parts = list(text)
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[k] + parts[k + 1], NEVER), k) for k in range(len(parts) - 1))
            if rank == NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def halves(self, token: str) -> tuple[str, str] | None:
        """The two parts whose merge makes the token; None if no merges make it."""
        parts, rank = list(token), self.ranks[token]
        while len(parts) > 2:
            lowest, at = min((self.ranks.get(parts[k] + parts[k + 1], NEVER), k) for k in range(len(parts) - 1))
            if lowest > rank:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    @lru_cache(maxsize=None)  # noqa: B019  one entry per vocabulary entry, for the worker's life
    def made(self, token: str) -> bool:
        """Whether the merges can make this token at all."""
        return len(token) == 1 or (token in self.ranks and self.halves(token) is not None)

    def automaton(self, symbols: set[str]) -> ahocorasick.Automaton:
        """Finds all tokens in a text: those that merges make, and the given single symbols."""
        found = ahocorasick.Automaton()
        for token in symbols | {token for token in self.ranks if self.made(token)}:
            found.add_word(token, token)
        found.make_automaton()
        return found

    def _edge(self, token: str, side: int) -> tuple[list[str], list[int]]:
        """The pieces that hold the token's outer symbol, smallest first, and the rank that makes each."""
        pieces, made_at = [token], []
        while len(token) > 1:
            made_at.append(self.ranks[token])
            token = self.halves(token)[side]
            pieces.append(token)
        return pieces[::-1], [*made_at[::-1], NEVER]

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the text of both tokens gives just these two.

        Follows the merges at the seam in rank order: the last piece of ``left`` and
        the first of ``right`` grow as their own tokens are made; if the two can join
        before either is used up by its own token, they would have. Equal ranks go
        leftmost first.
        """
        if left not in self._right:
            self._right[left] = self._edge(left, 1)
        if right not in self._left:
            self._left[right] = self._edge(right, 0)
        (xs, x_at), (ys, y_at) = self._right[left], self._left[right]
        ranks, i, j = self.ranks, 0, 0
        while True:
            joined = ranks.get(xs[i] + ys[j], NEVER)
            if joined < x_at[i] and joined <= y_at[j] and joined < NEVER:
                return False
            if x_at[i] == NEVER and y_at[j] == NEVER:
                return True
            if x_at[i] <= y_at[j]:
                i += 1
            else:
                j += 1
