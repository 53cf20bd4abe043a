"""Token ids of texts with a public byte-level BPE tokenizer.

The ids are those that ``tokenizers`` gives for the whole text.  Two properties
of such a tokenizer make this cheap, and both are checked when it is loaded:

* its pre-tokenizer never lets a token reach across a single blank or line
  break between two words, so ids are remembered per word in each Python
  worker;
* its merges are listed in the order of their ids, so ``tiktoken`` merges the
  same way when the vocabulary is given to it as ranks.

A text with any other white space between its words is encoded as a whole; a
tokenizer without these properties, or a text that spells one of its special
tokens, goes through ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import re
import struct
from functools import lru_cache

import numpy as np

# Any white space other than one blank or line break between two words.
_ODD_SPACE = re.compile(r"\s\s|[^\S \n]|\A\s|\s\Z")
CACHED_WORDS = 600_000
# Fixed value: the pattern of byte-level pre-tokenizers.
BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class _Words(dict):
    """word -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, encode, prefix):
        super().__init__()
        self.encode, self.prefix = encode, prefix

    def __missing__(self, word):
        if len(self) >= CACHED_WORDS:
            self.clear()
        ids = self[word] = self.encode(self.prefix + word)
        return ids


def _byte_of() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for their own
    byte, the other bytes for the characters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Encodes texts to packed little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.ranked = self._as_ranks(spec)
        self.first, self.later = _Words(self._encode, ""), _Words(self._encode, " ")
        self.newline = self._encode("\n")

    def _as_ranks(self, spec: dict):
        """The vocabulary as a ``tiktoken`` encoding, or None if that could differ."""
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        if (spec.get("normalizer") or spec.get("post_processor") or pre.get("type") != "ByteLevel"
                or pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("type") != "BPE"
                or model.get("dropout") or model.get("ignore_merges") or model.get("byte_fallback")):
            return None
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:])):
            return None
        import tiktoken
        byte_of = _byte_of()
        special = set(self.special)
        ranks = {bytes(byte_of[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        return tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _plain(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode(self, text: str) -> bytes:
        if self.ranked is None:
            return self._plain(text)
        ids = self.ranked.encode_ordinary(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def packed(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.ranked is None or any(s in text for s in self.special):
            return self._plain(text)
        if _ODD_SPACE.search(text):
            return self._encode(text)
        parts, later = [], self.later.__getitem__
        for line in text.split("\n"):
            words = line.split(" ")
            parts.append(self.newline)
            parts.append(self.first[words[0]])
            if len(words) > 1:
                parts.extend(map(later, words[1:]))
        return b"".join(parts[1:])

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(self.packed(text), "<u4")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each tokenizer file and Python worker."""
    return Encoder(path)
