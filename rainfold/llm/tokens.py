"""Token ids of a byte-level BPE vocabulary file, as the ``tokenizers`` library gives them.

``tokenizers`` is exact for every text and slow. Nearly all texts take a faster way to the same ids:
the same merges in ``tiktoken``, whose split pattern needs no look-ahead where no two white-space
characters meet. It is taken where all characters are in Latin-1, on which both libraries' character
classes agree, and where the text holds none of the vocabulary's special strings.
"""

from __future__ import annotations

import json
from functools import cache

import tiktoken

# The split pattern of byte-level BPE, with and without look-ahead.
_HEAD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|"
_PATTERN = _HEAD + r"\s+(?!\S)|\s+"
_PATTERN_SINGLE_SPACES = _HEAD + r"\s+"
_WHITE = bytes.maketrans(bytes([*range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0]), b" " * 11)


def _byte_characters() -> dict[str, int]:
    """The vocabulary's printable stand-ins for bytes: printable Latin-1 is itself, the rest follow."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(rest)}


class Ids:
    """ids of a text, without special tokens added."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            self._json = file.read()
        described = json.loads(self._json)
        self._specials = [token["content"] for token in described.get("added_tokens", [])]
        stand_in = _byte_characters()
        special = set(self._specials)
        self._ranks = {
            bytes(stand_in[c] for c in piece): number
            for piece, number in described["model"]["vocab"].items()
            if piece not in special
        }
        self._built: dict[str, tiktoken.Encoding] = {}
        self._exact = None

    def _encoding(self, pattern: str) -> tiktoken.Encoding:
        """Built on demand: most workers need one of the two."""
        if pattern not in self._built:
            self._built[pattern] = tiktoken.Encoding(
                pattern, pat_str=pattern, mergeable_ranks=self._ranks, special_tokens={}
            )
        return self._built[pattern]

    def exact(self, text: str) -> list[int]:
        if self._exact is None:
            from tokenizers import Tokenizer

            self._exact = Tokenizer.from_str(self._json)
        return self._exact.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> list[int]:
        try:
            plain = text.encode("latin-1")
        except UnicodeEncodeError:
            return self.exact(text)
        if any(special in text for special in self._specials):
            return self.exact(text)
        if b"  " in plain.translate(_WHITE):
            return self._encoding(_PATTERN).encode_ordinary(text)
        return self._encoding(_PATTERN_SINGLE_SPACES).encode_ordinary(text)


@cache
def ids_of(path: str) -> Ids:
    """One for each worker process."""
    return Ids(path)
