"""Statistics of one whole text, counted over ASCII-separated words."""

from __future__ import annotations

import numpy as np

SYMBOLS = "#*$%&|<>"
WINDOW = 5
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHAPE = ("n_lines", "n_distinct", "n_upper", "n_digits", "n_exclaims")


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """How many words stand in a window of five words that occurs twice or more."""
    n = len(ids) - WINDOW + 1
    if n < 2:
        return 0
    if distinct ** WINDOW < 2**62:
        key = np.zeros(n, np.int64)
        for k in range(WINDOW):
            key = key * distinct + ids[k : k + n]
    else:  # too many words for one integer: rank pairs, then pairs of pairs, then the fifth
        pair = np.unique(ids[:-1] * distinct + ids[1:], return_inverse=True)[1]
        four = np.unique(pair[:-2] * len(ids) + pair[2:], return_inverse=True)[1]
        key = four[:n] * distinct + ids[WINDOW - 1 :]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    found = np.zeros(n, bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    edges = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(found)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def text_stats(text: str | None) -> tuple[int, ...]:
    """The values of COUNTS and SHAPE; all 0 for a null or empty text."""
    if not text:
        return (0,) * (len(COUNTS) + len(SHAPE))
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    spaces = len(raw) - sum(map(len, words))
    lines, earlier, dup = text.split("\n"), set(), 0
    for line in lines:
        if line in earlier:
            dup += 1
        elif line.encode("utf-8", "surrogatepass").split():
            earlier.add(line)
    return (
        len(words),
        len(text) - spaces,
        sum(map(text.count, SYMBOLS)),
        dup,
        repeated_words(ids, len(seen)),
        len(lines),
        len(seen),
        len(raw) - len(raw.translate(None, _UPPER)),
        len(raw) - len(raw.translate(None, _DIGITS)),
        raw.count(b"!"),
    )
