"""Encoders of ``tokenizers`` files, several times faster than the library and equal to it.

The merges run in ``tiktoken``, with the file's vocabulary as ranks. Texts that
need more than merges (added token strings, characters whose normal or lower-case
form is not plain) go to the library itself. Both file kinds are checked on load.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

MEMO = 300_000
LONGEST_KEPT = 64

# How byte-level vocabularies write bytes, and the pattern of byte-level files.
PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Code points whose normal form is themselves and whose lower case is one rule for all.
NOT_PLAIN = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ‐-‧€]")
#: End of a word, as one byte that no plain text holds.
END = "\x01"


def _bytes_of() -> dict[str, int]:
    spare = (b for b in range(256) if b not in set(PRINTED))
    return {chr(b): b for b in PRINTED} | {chr(256 + k): b for k, b in enumerate(spare)}


class JsonEncoder:
    """Encodes texts as the file's tokenizer does, without tokens added around them."""

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        with open(path) as f:
            spec = json.load(f)
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.added = [token["content"] for token in spec["added_tokens"]]
        model, kind = spec["model"], (spec["pre_tokenizer"] or {}).get("type")
        plain = model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
        suffix = model.get("end_of_word_suffix") or ""
        self.by_word = self.whole = None
        if plain and not suffix and kind == "ByteLevel" and spec["normalizer"] is None:
            if spec["pre_tokenizer"]["use_regex"] and not spec["pre_tokenizer"]["add_prefix_space"]:
                self.whole = self._core(model, "", BYTE_PATTERN)
        elif plain and suffix and kind == "Sequence" and spec["normalizer"]:
            steps = [step["type"] for step in spec["normalizer"]["normalizers"]]
            split, level = spec["pre_tokenizer"]["pretokenizers"]
            if steps == ["NFC", "Replace", "Lowercase"] and split["invert"] and not level["use_regex"]:
                words = split["pattern"]["Regex"]
                self.words = regex.compile(words.replace(r"\s", r"\p{White_Space}"))
                self.by_word = self._core(model, suffix, f"[^{END}]+{END}")
                self._memo: dict[str, bytes] = {}

    def _core(self, model: dict, suffix: str, pattern: str) -> tiktoken.Encoding | None:
        """The vocabulary in tiktoken; None where its ids do not follow its merges."""
        bytes_of = _bytes_of()

        def raw(token: str) -> bytes:
            ends_word = suffix and token.endswith(suffix)
            stem = token.removesuffix(suffix) if ends_word else token
            return bytes(map(bytes_of.__getitem__, stem)) + (END.encode() if ends_word else b"")

        ids = model["vocab"]
        merged = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if [ids[a + b] for a, b in merged] != sorted(ids[a + b] for a, b in merged):
            return None
        # Ranks are shifted so that the joining of a word's last byte with its end comes first.
        ends = 256 if suffix else 0
        ranks: dict[bytes, int] = {}
        id_of: dict[int, int] = {}
        for k, c in enumerate(sorted(bytes_of)):
            ranks[bytes([bytes_of[c]])] = rank = (1 << 20) + k if suffix else ids[c]
            id_of[rank] = ids[c]
            if suffix:
                ranks[bytes([bytes_of[c]]) + END.encode()] = k
                id_of[k] = ids[c + suffix]
        for order, (a, b) in enumerate(merged):
            rank = ends + order if suffix else ids[a + b]
            ranks[raw(a + b)] = rank
            id_of[rank] = ids[a + b]
        self.id_of = np.zeros(max(id_of) + 1, np.uint32)
        self.id_of[list(id_of)] = list(id_of.values())
        return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def _by_library(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _chunk(self, chunk: str) -> bytes:
        words = [chunk] if chunk.isalpha() else self.words.findall(chunk)
        if not words:
            return b""
        ranks = self.by_word.encode_ordinary(END.join(words) + END)
        return self.id_of[ranks].tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text as ``uint32``."""
        if any(token in text for token in self.added):
            return self._by_library(text)
        if self.whole:
            return np.array(array("I", self.whole.encode_ordinary(text)), np.uint32)
        if not self.by_word or NOT_PLAIN.search(text):
            return self._by_library(text)
        known, parts = self._memo, text.lower().split()
        if len(known) > MEMO:
            known.clear()
        long = {}
        for chunk in set(parts):
            if chunk not in known:
                (known if len(chunk) <= LONGEST_KEPT else long)[chunk] = self._chunk(chunk)
        joined = [known[c] if c in known else long[c] for c in parts] if long else map(known.__getitem__, parts)
        return np.frombuffer(b"".join(joined), np.uint32)


@lru_cache(maxsize=4)
def load(path: str) -> JsonEncoder:
    """One encoder per worker process and file."""
    return JsonEncoder(path)


def id_type(vocabulary: int) -> type:
    """The smallest type that holds the ids."""
    return np.uint16 if vocabulary <= 1 << 16 else np.uint32
