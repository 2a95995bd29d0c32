"""Byte-level BPE by longest matches and backtracking, and decoding.

The bytes of a text are mapped to Latin-1 characters, so that an Aho-Corasick
automaton over the vocabulary finds, in one pass, every token that starts at each
position. Encoding takes the longest token that is compatible with the one before;
at a dead end it steps back and marks the position as closed, so no position fails
twice and the time is linear in the text.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .merges import MEMO, MergeTable
from .rows import column_of, map_slices, texts_of

#: A run of text up to the next white space after it. The pattern that splits text never matches across such an edge.
CHUNK = re.compile(r"\s*\S+|\s+")
#: Characters that Python takes for white space and the Unicode property does not.
ODD_SPACE = re.compile("[\x1c-\x1f]")
LONGEST_KEPT = 64


class ByteBpe:
    """Encoder and decoder of a rank file (one ``base64 rank`` line per token)."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.ids = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.decimal = [str(i) for i in range(len(self.tokens))]
        self.table = MergeTable(self.ids)
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.automaton = self.table.automaton({token for token in self.ids if len(token) == 1})
        self._chunks: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}

    def tokens_of(self, text: str) -> list[str]:
        """Tokens of one match of the pattern, given as Latin-1.

        The run of longest matches is the answer if its neighbours are compatible;
        else the search steps back from it.
        """
        longest = [token for _, token in self.automaton.iter_long(text)]
        fits = self.table.fits
        if all(map(fits.__getitem__, pairwise(longest))) and sum(map(len, longest)) == len(text):
            return longest
        starting: list[list[str]] = [[] for _ in text]
        for end, token in self.automaton.iter(text):
            starting[end + 1 - len(token)].append(token)  # shortest first
        open_at = [True] * (len(text) + 1)
        taken: list[str] = []
        left = [len(starting[0])]  # tokens not yet tried after each token taken
        at = 0
        while at < len(text):
            tried, k = starting[at], left[-1]
            while k:
                k -= 1
                token = tried[k]
                if open_at[at + len(token)] and (not taken or fits[taken[-1], token]):
                    left[-1] = k
                    taken.append(token)
                    at += len(token)
                    left.append(len(starting[at]) if at < len(text) else 0)
                    break
            else:
                open_at[at] = False
                left.pop()
                at -= len(taken.pop())
        return taken

    def _encode_piece(self, piece: str) -> bytes:
        text = piece.encode().decode("latin-1")
        ids = [self.ids[token] for token in self.tokens_of(text)]
        return array("I", ids).tobytes()

    def _encode_chunk(self, chunk: str) -> bytes:
        if chunk.isalpha() or (chunk[0] == " " and chunk[1:].isalpha()):
            return self._encode_piece(chunk)  # one match, a run of letters
        known, out = self._pieces, []
        if len(known) > MEMO:
            known.clear()
        for piece in self.split.findall(chunk):
            ids = known.get(piece)
            if ids is None:
                ids = self._encode_piece(piece)
                if len(piece) <= LONGEST_KEPT:
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text as ``uint32``; special strings are plain text. Repeated chunks come from a bounded memo."""
        if ODD_SPACE.search(text):
            return np.frombuffer(self._encode_chunk(text), np.uint32)
        known, parts = self._chunks, CHUNK.findall(text)
        if len(known) > MEMO:
            known.clear()
        long = {}
        for chunk in set(parts):
            if chunk not in known:
                (known if len(chunk) <= LONGEST_KEPT else long)[chunk] = self._encode_chunk(chunk)
        if long:
            return np.frombuffer(b"".join([known.get(c) or long[c] for c in parts]), np.uint32)
        return np.frombuffer(b"".join(map(known.__getitem__, parts)), np.uint32)

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of a list of ids."""
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> ByteBpe:
    """One encoder per worker process and file."""
    return ByteBpe(path, pattern)


def encode_documents(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, token_ids array<int>`` of every text.

    A null text is the empty one and has no tokens; rows that repeat, null ids and
    other columns are no matter: one row out per row in. An empty table gives none.
    """

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        ids = [load(path, pattern).encode(text) for text in texts_of(batch)]
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
        return {"doc_id": column_of(batch, "doc_id"), "token_ids": pa.ListArray.from_arrays(ends, flat)}

    return map_slices(documents.select("doc_id", "text"), "doc_id long, token_ids array<int>", work)


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, decoded binary`` of rows of ``doc_id, token_ids``; null is no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path, pattern)
        for batch in batches:
            decoded = [coder.decode(ids or []) for ids in column_of(batch, "token_ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": column_of(batch, "doc_id"), "decoded": pa.array(decoded, pa.binary())})

    return encoded.select("doc_id", "token_ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Digests of every text's ids and of what they decode to, from one pass.

    ``doc_id, n_tokens, ids_sha256, decoded_sha256``. Null and empty texts have no
    ids: both digests are those of no bytes.
    """

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        coder = load(path, pattern)
        sizes, id_digests, text_digests = [], [], []
        for text in texts_of(batch):
            ids = coder.encode(text).tolist()
            sizes.append(len(ids))
            id_digests.append(hashlib.sha256(",".join(map(coder.decimal.__getitem__, ids)).encode()).hexdigest())
            text_digests.append(hashlib.sha256(coder.decode(ids)).hexdigest())
        return {
            "doc_id": column_of(batch, "doc_id"),
            "n_tokens": pa.array(sizes, pa.int64()),
            "ids_sha256": pa.array(id_digests, pa.string()),
            "decoded_sha256": pa.array(text_digests, pa.string()),
        }

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_slices(documents.select("doc_id", "text"), schema, work)
