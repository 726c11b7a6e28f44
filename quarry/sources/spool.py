"""A sequence that is longer than what a task should hold."""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Iterator

#: Items in a batch.
HELD = 8192


class Spool:
    """Items in the order added: full batches of ``held`` go to a temporary file, and the last one read is kept."""

    def __init__(self, held: int = HELD) -> None:
        self._held, self._tail, self._starts, self._file, self._read = held, [], [], None, (-1, [])

    def append(self, item: object) -> None:
        self._tail.append(item)
        if len(self._tail) == self._held:
            self._file = self._file or tempfile.TemporaryFile()
            self._starts.append(self._file.seek(0, 2))
            pickle.dump(self._tail, self._file, pickle.HIGHEST_PROTOCOL)
            self._tail = []

    def __len__(self) -> int:
        return len(self._starts) * self._held + len(self._tail)

    def n_batches(self) -> int:
        return len(self._starts) + bool(self._tail)

    def batch(self, k: int) -> list:
        if k == len(self._starts):
            return self._tail
        if self._read[0] != k:
            self._file.seek(self._starts[k])
            self._read = k, pickle.load(self._file)
        return self._read[1]

    def __iter__(self) -> Iterator:
        for k in range(self.n_batches()):
            yield from self.batch(k)
