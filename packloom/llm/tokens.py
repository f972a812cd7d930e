"""Byte-level BPE ids, encoded a blank-separated word at a time through a bounded cache."""

from __future__ import annotations

import base64
import os
import re
from array import array

#: A blank here joins other white space or ends the text: such texts are encoded whole.
_ODD = re.compile(r" (?:\s|\Z)")
_ENCODERS: dict[tuple, Encoder] = {}


def vocabulary_path(name: str) -> str:
    """A path is taken as it is; a bare file name is looked up among the installed public vocabularies."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class _Words(dict):
    """Word -> ids of " word" as little-endian 32-bit bytes; emptied when it holds `most` words."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.encode(f" {word}")).tobytes()
        if len(word) <= 48:
            if len(self) >= self.most:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Ids of the vocabulary's ranks file, the same as those of its `tokenizers` JSON (tests compare them).

    In that pre-tokenizer a single blank always starts a new piece when what follows is not white space,
    so the text is cut before each blank and each word's ids are looked up.
    """

    def __init__(self, vocabulary: str, cache_words: int = 100_000):
        import public_tokenizers
        import tiktoken

        with open(vocabulary_path(vocabulary), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._whole = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._words = _Words(self._whole, cache_words)

    def ids(self, text: str) -> bytes:
        """The text's ids as unsigned little-endian 32-bit bytes."""
        if _ODD.search(text):
            return array("I", self._whole(text)).tobytes()
        first, *rest = text.split(" ")
        return array("I", self._whole(first)).tobytes() + b"".join(map(self._words.__getitem__, rest))


def encoder(vocabulary: str) -> Encoder:
    """One encoder for each Python worker and vocabulary."""
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]
