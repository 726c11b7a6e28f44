"""Token ids of whole texts with a public byte-pair vocabulary, cached by word."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

#: White space beside a space, or a space at an end: there a space need not begin a token.
_UNSAFE = re.compile(r"\s |  |\A | \s| \Z")


class WordCachedEncoder:
    """``encode(text)`` gives the little-endian uint32 ids of ``tokenizers`` with a vocabulary file.

    The vocabulary's pattern starts a new token at each single space between
    non-space characters and joins that space to the word after it. So such a text's
    ids are those of its space-led words one after another, and these are looked up.
    A text with other spacing is encoded whole. Words missing from the cache are
    encoded by the rank form of the same vocabulary; texts that hold a special token's
    string go through the tokenizer file itself. The cache is emptied at ``most`` words.
    """

    def __init__(self, file: str, most: int = 400_000) -> None:
        self._tokenizer = Tokenizer.from_file(file)
        added = self._tokenizer.get_added_tokens_decoder()
        self._special = [t.content for t in added.values()]
        vocab = self._tokenizer.get_vocab(with_added_tokens=False)
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in piece): i for piece, i in vocab.items() if piece not in self._special}
        self._ranks = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._most = most
        self._cache = _Words(self._ranks)

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self._special):
            return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if _UNSAFE.search(text):
            return np.array(self._ranks.encode_ordinary(text), "<u4").tobytes()
        if len(self._cache) > self._most:
            self._cache.clear()
        first, *rest = text.split(" ")
        return np.array(self._ranks.encode_ordinary(first), "<u4").tobytes() + b"".join(map(self._cache.__getitem__, rest))


class _Words(dict):
    """Ids of a word with a space before it, made when first asked for."""

    def __init__(self, ranks: tiktoken.Encoding) -> None:
        super().__init__()
        self._encode = ranks.encode_ordinary

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = np.array(self._encode(" " + word), "<u4").tobytes()
        return ids


def _byte_letters() -> dict[str, int]:
    """The usual printable stand-ins of bytes in byte-level vocabularies, and the bytes they mean."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def encoder(file: str) -> WordCachedEncoder:
    return WordCachedEncoder(file)
