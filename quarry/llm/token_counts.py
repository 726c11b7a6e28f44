"""Token counts of a unigram model, by dynamic programming over a trie of pre-tokens.

A text's pre-tokens are its ASCII-separated words, each led by the vocabulary's space
mark. Of all ways to spell a pre-token with pieces, the count is that of the most
probable one (on ties the shortest). Pieces have the probabilities of Zipf's law over
their rank in the vocabulary file, a rule, so nothing is trained.

Distinct pre-tokens of a batch stand in a trie. The forward score of a trie node is
worked out once for all pre-tokens below it, all nodes of a depth together, and
terminal nodes store the count.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE_MARK = "▁"
#: Scores are integers, millionths of a nat, so that equal sums are equal.
SCALE = 1_000_000
#: A combined value is score * TIES - tokens: the greater score first, then fewer tokens. One character
#: changes the tokens by far fewer than half of it.
TIES = 1 << 20


class UnigramTrie:
    """The pieces of a vocabulary as a trie of code points, and scoring against it."""

    def __init__(self, pieces: list[str]) -> None:
        total = float(np.sum(1.0 / np.arange(1, len(pieces) + 1))) if pieces else 1.0
        self.scores = {p: round(-SCALE * float(np.log((k + 1) * total))) for k, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        #: A byte of a character without a piece costs more than any piece.
        self.byte_value = (min(self.scores.values(), default=0) - SCALE) * TIES - 1
        edges: dict[int, int] = {}
        value = [0]
        for piece, score in self.scores.items():
            at = 0
            for c in piece:
                at = edges.setdefault(at << 21 | ord(c), len(value))
                if at == len(value):
                    value.append(0)
            value[at] = score * TIES - 1
        keys = np.array(sorted(edges), np.int64)
        self._keys, self._next = keys, np.array([edges[k] for k in keys.tolist()], np.int64)
        self._value = np.array(value, np.int64)  # 0: no piece ends here

    def _step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """States after one more character; -1 where no piece goes on."""
        if not len(self._keys):
            return np.full(len(states), -1, np.int64)
        wanted = states << 21 | codes
        at = np.minimum(np.searchsorted(self._keys, wanted), len(self._keys) - 1)
        return np.where(self._keys[at] == wanted, self._next[at], -1)

    def count_all(self, words: list[str]) -> list[int]:
        """Tokens of sorted, distinct, non-empty pre-tokens of any length.

        Of a node's prefixes only the last ``longest`` matter. Their values are kept relative
        to the node's own, and the number of tokens apart, so neither grows with the depth.
        """
        n = len(words)
        lengths = np.array([len(w) for w in words])
        offsets = np.cumsum(lengths) - lengths
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        counts = np.zeros(n, np.int64)
        # of each node of the current depth: its words' first row, open piece states, forward values of its last prefixes
        rows = np.arange(n)
        node_of = np.zeros(n, np.int64)
        states = np.zeros((1, 0), np.int64)
        values, tokens = np.zeros((1, 1), np.int64), np.zeros(1, np.int64)
        for depth in range(int(lengths.max())):
            inside = lengths[rows] > depth
            rows, node_of = rows[inside], node_of[inside]
            codes = flat[offsets[rows] + depth].astype(np.int64)
            new = np.append(True, (node_of[1:] != node_of[:-1]) | (codes[1:] != codes[:-1]))
            parent, code = node_of[new], codes[new]
            node_of = np.cumsum(new) - 1
            before = states[parent][:, : self.longest - 1]
            before = np.concatenate([np.zeros((len(parent), 1), np.int64), before], axis=1)
            open_ = before >= 0
            states = np.full(before.shape, -1, np.int64)
            states[open_] = self._step(before[open_], np.broadcast_to(code[:, None], before.shape)[open_])
            ended = np.where(states >= 0, self._value[np.maximum(states, 0)], 0)
            earlier = values[parent][:, : before.shape[1]]
            options = np.where(ended != 0, earlier + ended, np.iinfo(np.int64).min)
            width = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
            fallback = np.where(ended[:, 0] == 0, earlier[:, 0] + self.byte_value * width, np.iinfo(np.int64).min)
            gain = np.maximum(options.max(axis=1), fallback)
            values = np.concatenate([np.zeros((len(gain), 1), np.int64), values[parent][:, : self.longest - 1] - gain[:, None]], axis=1)
            # gain = TIES * score - tokens, and the tokens are few
            tokens = tokens[parent] + (gain + TIES // 2) // TIES * TIES - gain
            ends = lengths[rows] == depth + 1
            counts[rows[ends]] = tokens[node_of[ends]]
        return counts.tolist()


@lru_cache(maxsize=2)
def unigram_trie(model_file: str) -> UnigramTrie:
    """The ordinary pieces of a vocabulary file, in rank order."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    special = lambda i: model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
    return UnigramTrie([model.id_to_piece(i) for i in range(model.get_piece_size()) if not special(i)])


class Counter:
    """Counts of pre-tokens, kept between batches up to ``most`` of them."""

    def __init__(self, trie: UnigramTrie, most: int = 500_000) -> None:
        self._trie, self._most, self._counts = trie, most, {}

    def count(self, texts: list[list[str]]) -> list[int]:
        """Tokens of each list of words."""
        if len(self._counts) > self._most:
            self._counts.clear()
        new = set().union(*texts).difference(self._counts)
        ordered = sorted(new)
        for at in range(0, len(ordered), 65536):
            part = [SPACE_MARK + w for w in ordered[at : at + 65536]]
            self._counts.update(zip(ordered[at : at + 65536], self._trie.count_all(part)))
        get = self._counts.__getitem__
        return [sum(map(get, words)) for words in texts]


@lru_cache(maxsize=2)
def _counter(model_file: str) -> Counter:
    return Counter(unigram_trie(model_file))


def words_of(text: str | None) -> list[str]:
    return [w.decode("utf-8", "surrogatepass") for w in (text or "").encode("utf-8", "surrogatepass").split()]


def token_counts(docs: DataFrame, model_file: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words (pre-tokens) and n_tokens of every whole text.

    Null and empty texts have 0 of both. Null ids and repeated rows are counted like
    any other. Characters that no piece has count as their UTF-8 bytes. Very long texts
    and words are counted whole, a word in time in proportion to its length. Columns
    besides key and text are not read; an empty table gives an empty result. Nothing
    is shuffled: each task keeps the counts of the pre-tokens that it has met.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_file)
        for batch in batches:
            for part in _parts(batch):
                texts = [words_of(t) for t in part.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(counter.count(texts), pa.int64())],
                    names=["doc_id", "n_words", "n_tokens"],
                )

    return rows.mapInArrow(count, f"doc_id {kind}, n_words long, n_tokens long")


def _parts(batch: pa.RecordBatch, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))
