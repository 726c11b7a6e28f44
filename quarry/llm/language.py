"""Language identification with hyperdimensional n-gram profiles.

Every letter has a fixed random vector of +1 and -1. A trigram's vector binds its
letters: the first one permuted twice, the second once, the third not, multiplied
element by element. A text is the sum (bundle) of its trigram vectors, a language the
sum over its training texts, and a text is given the language of greatest cosine.

Each code point that is a letter has a vector, made from a seed of its own, so workers
agree without a table. Since a bundle is a sum, training bundles texts where they are and
adds up the bundles of a language as a Spark aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bit_filter import maybe_in
from .storage import settle

DIMENSIONS = 1024
#: The code that stands for all between two words; no letter has it.
GAP = 0
#: A trigram is one number: three code points of 21 bits.
_BITS = 21
_LOW = (1 << _BITS) - 1
#: Most characters of a text that are bundled at a time, and most trigram vectors that a worker keeps.
_BLOCK = 1 << 20
_SLOTS = 1 << 16

_letters: np.ndarray | None = None


def letter_codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text's letters, a run of others as one gap, gaps at both ends."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.concatenate([[GAP], np.where(_letters[codes], codes, GAP), [GAP]]).astype(np.uint32)
    return codes[np.r_[True, (codes[1:] != GAP) | (codes[:-1] != GAP)]]


def trigram_counts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the trigrams of a run of codes, and how often each occurs."""
    c = codes.astype(np.int64)
    if len(c) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.unique((c[:-2] << _BITS | c[1:-1]) << _BITS | c[2:], return_counts=True)


class TrigramVectors:
    """Vectors of letters, each from its own seed, and of trigrams; the last ones made are kept in a fixed number of slots."""

    def __init__(self, seed: int = 20, dimensions: int = DIMENSIONS) -> None:
        self._seed, self._dimensions = seed, dimensions
        self._known: dict[int, np.ndarray] = {}
        self._owner = np.full(_SLOTS, -1, np.int64)
        self._rows = np.zeros((_SLOTS, dimensions), np.int8)

    def letter(self, code: int) -> np.ndarray:
        if code not in self._known:
            self._known[code] = np.random.default_rng([self._seed, code]).integers(0, 2, self._dimensions, np.int8) * 2 - 1
        return self._known[code]

    def _letters(self, codes: np.ndarray) -> np.ndarray:
        different, place = np.unique(codes, return_inverse=True)
        return np.stack([self.letter(int(c)) for c in different])[place]

    def bound(self, trigrams: np.ndarray) -> np.ndarray:
        """The product of the first letter's vector permuted twice, the second's once and the third's."""
        first, second = self._letters(trigrams >> 2 * _BITS), self._letters(trigrams >> _BITS & _LOW)
        return np.roll(first, 2, axis=1) * np.roll(second, 1, axis=1) * self._letters(trigrams & _LOW)

    def of(self, trigrams: np.ndarray) -> np.ndarray:
        slot = (trigrams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.int64)
        out = self._rows[slot]
        new = np.flatnonzero(self._owner[slot] != trigrams)
        if len(new):
            out[new] = made = self.bound(trigrams[new])
            slots, at = np.unique(slot[new], return_index=True)
            self._rows[slots], self._owner[slots] = made[at], trigrams[new][at]
        return out

    def bundle(self, text: str) -> np.ndarray:
        """The sum of the vectors of all trigrams of the text; whole numbers, so exact in any order."""
        codes, out = letter_codes(text), np.zeros(self._dimensions)
        for start in range(0, len(codes) - 2, _BLOCK):
            trigrams, counts = trigram_counts(codes[start : start + _BLOCK + 2])
            for at in range(0, len(trigrams), 4096):
                out += counts[at : at + 4096].astype(np.float32) @ self.of(trigrams[at : at + 4096]).astype(np.float32)
        return out


@dataclass(frozen=True)
class Profiles:
    """Unit vectors of the languages, in the order of ``names``."""

    names: tuple[str, ...]
    vectors: np.ndarray


_vectors: TrigramVectors | None = None


def _shared_vectors() -> TrigramVectors:
    global _vectors
    if _vectors is None:
        _vectors = TrigramVectors()
    return _vectors


def held_out(key: Column) -> Column:
    """True for a third of the ids; a null id counts as the empty text and trains."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learn(docs: DataFrame, *, max_rows_per_lang: int = 4000, max_langs: int = 10_000) -> Profiles:
    """Profiles of all languages in rows with a text, a lang and a doc_id that trains.

    About ``max_rows_per_lang`` rows of each language are used, chosen by a hash of
    doc_id. Bundles are summed on the executors, so the driver gets DIMENSIONS numbers
    for each language; over ``max_langs`` languages are an error.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "lang")
    share = usable.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(max_rows_per_lang)) / F.count(F.lit(1))).alias("share"))
    share = settle(share, "language-shares")  # one row per language, so that the planner knows how small it is
    if (n := share.count()) > max_langs:
        raise ValueError(f"{n} languages, more than max_langs={max_langs}")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = usable.join(share, "lang").where(place < F.col("share"))
    chosen = settle(chosen.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).distinct(), "language-sample")
    # the filter leaves only the texts of chosen rows (and a few more) to the join
    near = maybe_in(docs.select("doc_id", "lang", "text"), "doc_id", chosen.select("_id"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("lang") == F.col("_lang"))
    sample = near.where("text IS NOT NULL").join(chosen, same, "left_semi").select("lang", "text")

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                sums[lang] = sums.get(lang, 0) + _shared_vectors().bundle(text)
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(total), pa.string()), pa.array(range(len(total)), pa.int32()), pa.array(total.astype(np.int64))],
                names=["lang", "place", "n"],
            )

    table = sample.mapInArrow(bundled, "lang string, place int, n long").groupBy("lang", "place").agg(F.sum("n").alias("n")).toPandas()
    names = tuple(sorted(table["lang"].unique()))
    vectors = np.zeros((len(names), DIMENSIONS))
    for k, name in enumerate(names):
        own = table[table["lang"] == name]
        vectors[k, own["place"].to_numpy()] = own["n"].to_numpy()
        vectors[k] /= max(float(np.linalg.norm(vectors[k])), 1e-9)
    return Profiles(names, vectors)


def predict_text(text: str | None, profiles: Profiles) -> tuple[str, float]:
    """The language of greatest cosine, first by name on ties; ``und`` without a letter or profile."""
    if not text or not profiles.names:
        return "und", 0.0
    if not any(c.isalpha() for c in text):
        return "und", 0.0
    bundle = _shared_vectors().bundle(text)
    cosines = profiles.vectors @ bundle / max(float(np.linalg.norm(bundle)), 1e-9)
    k = int(np.argmax(cosines))
    return profiles.names[k], float(np.clip(cosines[k], 0.0, 1.0))


def identify(docs: DataFrame, profiles: Profiles, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score (the cosine, 0 to 1) for every whole text.

    Only the text decides. Null texts, empty texts and texts without a letter get
    ``und`` and score 0, as does everything where no language was learnt. Repeated
    rows get equal results; a null id is allowed. Very long texts are bundled in blocks,
    with the same result. Other columns are not read.
    """

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [predict_text(t, profiles) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"),
                    pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col(key).alias("doc_id"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
