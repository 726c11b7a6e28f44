"""External induced sorting of byte strings, with common-prefix values.

The strings are put together, each closed by a symbol of its own that is smaller than
every byte. A suffix is of type S if it is smaller than the suffix after it, else of
type L; an S suffix after an L suffix is a seed. Then:

1. Substrings from one seed to the next are numbered in order, by symbols and types. The
   numbers make a string of at most half the length, whose suffixes are sorted by
   recursion, which puts the seeds in order. A string of numbers that fits in memory ends
   the recursion: its suffixes are ranked there by prefixes of 1, 2, 4 ... numbers.
2. A scan in ascending order takes tuples from a queue: each suffix whose predecessor is
   of type L pushes that predecessor. Seeds start it, and all L suffixes come out sorted.
3. A scan in descending order, over the L suffixes, pushes the predecessors of type S.

Tuples carry the number of symbols that a suffix shares with its neighbour. Two suffixes
pushed one after the other into a bucket share one symbol and what the suffixes that
pushed them share: the least value that the scan has met between those two.

The queues are laid out in files once they pass ``memory_rows``, as are all other arrays
of the input's length; a scan holds one block of tuples in memory. The scratch folder
lives as long as the call: a task that is lost is done anew.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np

TUPLE = np.dtype([("key", np.uint64), ("at", np.int64)])
_BLOCK = 1 << 18
_FREE = -1
_MOST = np.iinfo(np.int16).max


class Scratch:
    """Arrays in memory up to ``memory_rows`` elements, in files beyond."""

    def __init__(self, folder: Path, memory_rows: int) -> None:
        self.folder, self.memory_rows = folder, max(memory_rows, 1024)
        self.block = min(self.memory_rows, _BLOCK)
        self._made = 0

    def array(self, n: int, kind: type, fill: int = 0) -> np.ndarray:
        if n <= self.memory_rows:
            return np.full(n, fill, kind)
        self._made += 1
        out = np.memmap(self.folder / f"array-{self._made}", kind, "w+", shape=(n,))
        if fill:
            out[:] = fill
        return out

    def blocks(self, n: int) -> Iterator[tuple[int, int]]:
        return ((a, min(a + self.block, n)) for a in range(0, n, self.block))


class DiskQueue:
    """A priority queue of (key, at) tuples: push any number of times, then take all in order."""

    def __init__(self, scratch: Scratch) -> None:
        self._scratch = scratch
        self._held: list[np.ndarray] = []
        self._count = 0
        self._runs: list[Path] = []

    def push(self, key: np.ndarray, at: np.ndarray) -> None:
        rows = np.empty(len(key), TUPLE)
        rows["key"], rows["at"] = key, at
        self._held.append(rows)
        self._count += len(rows)
        if self._count > self._scratch.memory_rows:
            path = self._scratch.folder / f"run-{id(self)}-{len(self._runs)}"
            self._sorted().tofile(path)
            self._runs.append(path)

    def _sorted(self) -> np.ndarray:
        rows = np.concatenate(self._held) if self._held else np.empty(0, TUPLE)
        self._held, self._count = [], 0
        return rows[np.argsort(rows["key"])]

    def take(self) -> Iterator[np.ndarray]:
        """Sorted blocks; tuples of one key may be split between blocks, in no set order."""
        rest = self._sorted()
        if not self._runs:
            if len(rest):
                yield rest
            return
        sources = [np.memmap(p, TUPLE, "r") for p in self._runs] + ([rest] if len(rest) else [])
        size = max(1, self._scratch.memory_rows // len(sources))
        at = [0] * len(sources)
        while True:
            open_ = [k for k, s in enumerate(sources) if at[k] < len(s)]
            if not open_:
                break
            # up to the least of the block ends no run can bring a smaller key any more
            bound = min(sources[k]["key"][min(at[k] + size, len(sources[k])) - 1] for k in open_)
            parts = []
            for k in open_:
                window = np.asarray(sources[k][at[k] : at[k] + size])
                upto = int(np.searchsorted(window["key"], bound, side="right"))
                parts.append(window[:upto])
                at[k] += upto
            block = np.concatenate(parts)
            yield block[np.argsort(block["key"])]
        for path in self._runs:
            path.unlink()


class InductionQueue:
    """A priority queue of suffix tuples (position, shared symbols) for one scan.

    There is a bucket for each symbol, of known size, and a bucket's tuples are pushed in
    the order of their keys. So a tuple's place is known when it is pushed, and the scan
    goes along the places, ascending or descending, as far as they are filled.
    """

    def __init__(self, n: int, symbols: int, scratch: Scratch, cap: int, *, down: bool) -> None:
        self.at, self.shared = scratch.array(n, np.int32, _FREE), scratch.array(n, np.int16)
        self.next = scratch.array(symbols, np.int64)
        self._n, self._cap, self._down, self._scratch = n, cap, down, scratch
        # per symbol: the scan block of the last push, and the least value after it in that block
        self._block = scratch.array(symbols, np.int32, -1)
        self._after = scratch.array(symbols, np.int16)
        self._least = np.empty(1024, np.int16)  # of each scan block
        self._blocks = 0

    def filled(self) -> Iterator[tuple[int, int]]:
        """Ranges of places that are filled, in the scan's direction; pushes go on meanwhile."""
        done, window = 0, 1024
        while done < self._n:
            w = min(window, self._n - done)
            part = self.at[self._n - done - w : self._n - done][::-1] if self._down else self.at[done : done + w]
            free = part == _FREE
            k = int(free.argmax()) if free.any() else w
            if not k:
                raise AssertionError("a suffix was not induced")
            window = min(2 * window, self._scratch.block) if k == w else max(64, 2 * k)
            yield (self._n - done - k, self._n - done) if self._down else (done, done + k)
            done += k

    def push(self, shared: np.ndarray, source: np.ndarray, symbol: np.ndarray, at: np.ndarray) -> None:
        """Push suffixes ``at`` into the buckets ``symbol``. ``shared`` are the values of the
        block just scanned, in its order; ``source`` is where in the block each one's successor stood."""
        b = self._blocks
        if b == len(self._least):
            self._least = np.concatenate([self._least, np.empty_like(self._least)])
        self._least[b] = shared.min()
        self._blocks += 1
        if not len(at):
            return
        order = np.argsort(symbol.astype(np.uint16) if self.next.size <= 1 << 16 else symbol, kind="stable")
        source, symbol, at = source[order], symbol[order], at[order]
        new = np.empty(len(at), np.bool_)
        new[0] = True
        np.not_equal(symbol[1:], symbol[:-1], out=new[1:])
        first, again = new.nonzero()[0], (~new).nonzero()[0]
        last = np.empty_like(first)
        last[:-1], last[-1] = first[1:] - 1, len(at) - 1
        value = np.empty(len(at), np.int16)
        if len(again):
            value[again] = 1 + _range_least(shared, source[again - 1] + 1, source[again])
        bucket = symbol[first]
        block, after = self._block[bucket], self._after[bucket]
        before = np.minimum.accumulate(shared)[source[first]]
        value[first] = 0
        old = (block >= 0).nonzero()[0]
        if len(old):
            block = block[old]
            from_ = int(block.min())
            # the least value of the whole blocks after block x, for x from ``from_`` on
            whole = np.full(b - from_, _MOST - 1, np.int16)
            np.minimum.accumulate(self._least[from_ + 1 : b][::-1], out=whole[:-1][::-1])
            value[first[old]] = 1 + np.minimum(np.minimum(after[old], whole[block - from_]), before[old])
        # least values from each place of the block to its end, without the place itself
        rest = np.empty(len(shared), np.int16)
        rest[-1] = _MOST - 1
        np.minimum.accumulate(shared[:0:-1], out=rest[:-1][::-1])
        self._block[bucket], self._after[bucket] = b, rest[source[last]]
        many = last - first + 1
        step = -1 if self._down else 1
        place = np.repeat(self.next[bucket] - step * first, many) + step * np.arange(len(at))
        self.next[bucket] += step * many
        self.at[place], self.shared[place] = at, np.minimum(value, self._cap)


def _range_least(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min(x[a..b]) for each pair, both ends included, from minima over powers of two."""
    k = np.frexp(b - a + 1)[1] - 1
    out = np.empty(len(a), x.dtype)
    table, size = x, 1
    for level in range(int(k.max()) + 1):
        now = np.flatnonzero(k == level)
        if len(now):
            out[now] = np.minimum(table[a[now]], table[b[now] - size + 1])
        if len(table) > size:
            table = np.minimum(table[:-size], table[size:])
        size *= 2
    return out


def _types(text: np.ndarray, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is of type S, and how often its first symbol is repeated, from the end to the start."""
    n = len(text)
    small, run = scratch.array(n, np.bool_), scratch.array(n, np.int16)
    small[n - 1], run[n - 1] = True, 1
    for a, b in reversed([*scratch.blocks(n - 1)]):
        here, after = np.asarray(text[a:b]), np.asarray(text[a + 1 : b + 1])
        places = np.arange(b - a)
        turn = np.minimum.accumulate(np.where(here != after, places, b - a)[::-1])[::-1]
        ends = turn < b - a
        inside = np.minimum(turn, b - a - 1)
        small[a:b] = np.where(ends, here[inside] < after[inside], small[b])
        run[a:b] = np.minimum(np.where(ends, turn - places + 1, b - a - places + int(run[b])), _MOST - 1)
    return small, run


def _seeds(small: np.ndarray, scratch: Scratch) -> np.ndarray:
    found = [np.empty(0, np.int64)]
    for a, b in scratch.blocks(len(small)):
        before = np.r_[a == 0 or small[a - 1], small[a : b - 1]]
        found.append(np.flatnonzero(small[a:b] & ~before) + a)
    out = scratch.array(sum(map(len, found)), np.int32)
    at = 0
    for part in found:
        out[at : at + len(part)] = part
        at += len(part)
    return out


def _numbers(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, closing: int, scratch: Scratch) -> tuple[np.ndarray, bool]:
    """For each seed how many seeds' substrings are smaller, and whether all these numbers differ.

    Symbols below ``closing`` close a string; a substring that starts there ends there.
    """
    n = len(seeds)
    number, size = scratch.array(n, np.int32), scratch.array(n, np.int32)
    for a, b in scratch.blocks(n):
        here = seeds[a:b]
        following = np.r_[seeds[a + 1 : b + 1], here[-1:]][: b - a]
        size[a:b] = np.where(text[here] < closing, 0, following - here)
    active, k = np.arange(n, dtype=np.int32), 0
    while len(active):
        queue = DiskQueue(scratch)
        for a, b in scratch.blocks(len(active)):
            at = seeds[active[a:b]].astype(np.int64) + k
            key = number[active[a:b]].astype(np.uint64) << np.uint64(33) | text[at].astype(np.uint64) << np.uint64(1)
            queue.push(key | small[at].astype(np.uint64), active[a:b])
        left, seen, group, last = [], 0, 0, None
        held = np.empty(0, np.int64)  # of the last key, which the next block may go on with
        for block in queue.take():
            key, at = block["key"], block["at"]
            old = key >> np.uint64(33)
            places = np.arange(seen, seen + len(key))
            new = np.r_[last is None or key[0] != last, key[1:] != key[:-1]]
            opens = np.r_[last is None or old[0] != last >> np.uint64(33), old[1:] != old[:-1]]
            start = np.maximum.accumulate(np.where(new, places, 0))
            opened = np.maximum.accumulate(np.where(opens, places, 0))
            if not new[0]:
                start[start == 0] = seen - len(held)
            if not opens[0]:
                opened[opened == 0] = group
            number[at] = old.astype(np.int64) + start - opened
            cut = np.flatnonzero(new)
            if not new[0]:
                held = np.concatenate([held, at[: cut[0]] if len(cut) else at])
            if len(cut):
                if len(held) > 1:
                    left.append(held)
                ends = np.append(cut[1:], len(at))
                several = np.repeat(ends - cut > 1, ends - cut)
                several[cut[-1] - cut[0] :] = False
                left.append(at[cut[0] :][several])
                held = at[cut[-1] :]
            last, group, seen = key[-1], int(opened[-1]), seen + len(key)
        if len(held) > 1:
            left.append(held)
        k += 1
        tied = np.concatenate([np.empty(0, np.int64), *left])
        active = tied[size[tied] >= k].astype(np.int32)
        if not len(active):
            return number, not len(tied) and k == 1 or _differ(number, scratch)
    return number, True


def _differ(number: np.ndarray, scratch: Scratch) -> bool:
    met = scratch.array(len(number), np.bool_)
    for a, b in scratch.blocks(len(number)):
        met[number[a:b]] = True
    return all(met[a:b].all() for a, b in scratch.blocks(len(met)))


def _seed_shares(text: np.ndarray, seeds: np.ndarray, order: np.ndarray, upper: np.ndarray, cap: int, scratch: Scratch) -> np.ndarray:
    """For each seed in order the symbols it shares with the one before, from the ``upper`` shares of the numbers."""
    out = scratch.array(len(order), np.int16)
    for a, b in scratch.blocks(len(order) - 1):
        one, two, common = order[a:b].astype(np.int64), order[a + 1 : b + 1].astype(np.int64), upper[a:b].astype(np.int64)
        # equal numbers are equal substrings; what follows them differs within a few symbols
        x, y = seeds[one + common].astype(np.int64), seeds[two + common].astype(np.int64)
        value = x - seeds[one]
        going = np.flatnonzero(value < cap)
        while len(going):
            more = text[x[going]] == text[y[going]]
            going = going[more]
            x[going] += 1
            y[going] += 1
            value[going] += 1
            going = going[value[going] < cap]
        out[a + 1 : b + 1] = np.minimum(value, cap)
    return out


def _sorted_in_memory(text: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """The end of the recursion: a string that fits in memory, by ranks of 1, 2, 4 ... symbols.

    Ranks of equal prefixes are equal, so the ranks of all lengths also tell what two suffixes share.
    """
    n, size = len(text), 1
    rank = text.astype(np.int64)
    ranks = [rank.astype(np.int32)]
    many = np.bincount(rank, minlength=n)
    active = (many[rank] > 1).nonzero()[0]
    while len(active) and size < cap:
        after = active + size
        key = rank[active] << 32 | np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key)
        active, key = active[order], key[order]
        new, opens = (np.append(True, x[1:] != x[:-1]) for x in (key, key >> 32))
        places = np.arange(len(key))
        group = np.maximum.accumulate(np.where(new, places, 0))
        rank = rank.copy()
        rank[active] = (key >> 32) + group - np.maximum.accumulate(np.where(opens, places, 0))
        ranks.append(rank.astype(np.int32))
        size *= 2
        several = np.append(new[1:], True) & new
        active = active[~several]
    order = np.argsort(rank, kind="stable").astype(np.int32)
    x, y = order[:-1].astype(np.int64), order[1:].astype(np.int64)
    shared = np.zeros(n, np.int64)
    for own in reversed(ranks):
        size = 1 << len(ranks) - 1
        same = ((x < n) & (y < n)).nonzero()[0]
        same = same[own[x[same]] == own[y[same]]]
        x[same] += size
        y[same] += size
        shared[same] += size
        ranks.pop()
    return order, np.minimum(shared, cap).astype(np.int16)


def _sorted_suffixes(text: np.ndarray, symbols: int, closing: int, cap: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the symbols (up to ``cap``) that each shares with the next one."""
    n = len(text)
    small, run = _types(text, scratch)
    seeds = _seeds(small, scratch)
    large_sizes, small_sizes, seed_sizes = (np.zeros(symbols, np.int64) for _ in range(3))
    for a, b in scratch.blocks(n):
        part, s = text[a:b], small[a:b]
        small_sizes += np.bincount(part[s], minlength=symbols)
        large_sizes += np.bincount(part[~s], minlength=symbols)
    for a, b in scratch.blocks(len(seeds)):
        seed_sizes += np.bincount(text[seeds[a:b]], minlength=symbols)

    number, different = _numbers(text, small, seeds, closing, scratch)
    if different:
        order, upper = scratch.array(len(seeds), np.int32), scratch.array(len(seeds), np.int16)
        for a, b in scratch.blocks(len(seeds)):
            order[number[a:b]] = np.arange(a, b)
    else:
        ends = sum(int((text[seeds[a:b]] < closing).sum()) for a, b in scratch.blocks(len(seeds)))
        if len(seeds) <= scratch.memory_rows // 2:
            order, upper = _sorted_in_memory(number, cap)
        else:
            order, upper = _sorted_suffixes(number, len(seeds), ends, cap, scratch)

    # ascending: all L suffixes, a bucket's L suffixes before its seeds
    queue = InductionQueue(int(large_sizes.sum()) + len(seeds), symbols, scratch, cap, down=False)
    starts = np.cumsum(large_sizes + seed_sizes) - (large_sizes + seed_sizes)
    queue.next[:] = starts
    shares = _seed_shares(text, seeds, order, upper, cap, scratch)
    upto = np.cumsum(large_sizes)
    is_seed = scratch.array(len(queue.at), np.bool_)
    for a, b in scratch.blocks(len(seeds)):
        at = seeds[order[a:b]]
        place = np.arange(a, b) + upto[text[at]]
        queue.at[place], queue.shared[place], is_seed[place] = at, shares[a:b], True
    del shares, order, upper, number
    # the first seed after a bucket's L suffixes, and the first in a bucket: known without induction
    seams = (starts + large_sizes)[(seed_sizes > 0) & (large_sizes > 0)]
    alone = starts[(seed_sizes > 0) & (large_sizes == 0)]
    for a, b in scratch.blocks(len(alone)):
        queue.shared[alone[a:b]] = 0
    for a, b in queue.filled():
        own = seams[slice(*seams.searchsorted((a, b)))]
        if len(own):
            queue.shared[own] = np.minimum(np.minimum(run[queue.at[own]], run[queue.at[own - 1]]), cap)
        before = queue.at[a:b] - 1  # of suffix 0 that is the last one, which is small
        source = (~small[before]).nonzero()[0]
        before = before[source]
        queue.push(queue.shared[a:b], source, text[before], before)

    # descending: all S suffixes, a bucket's L suffixes before its S suffixes
    last = InductionQueue(n, symbols, scratch, cap, down=True)
    starts = np.cumsum(large_sizes + small_sizes) - (large_sizes + small_sizes)
    last.next[:] = starts + large_sizes + small_sizes - 1
    smaller = np.cumsum(small_sizes) - small_sizes
    done, before = 0, None
    for a, b in scratch.blocks(len(queue.at)):
        own = np.flatnonzero(~is_seed[a:b]) + a
        if not len(own):
            continue
        at = queue.at[own]
        place = np.arange(done, done + len(own)) + smaller[text[at]]
        last.at[place] = at
        # what a suffix shares with the next is what that one shares with it
        ahead = np.r_[before, place[:-1]] if before is not None else place[:-1]
        values = queue.shared[own]
        last.shared[ahead] = values if before is not None else values[1:]
        done, before = done + len(own), place[-1]
    del queue, is_seed
    last.at[last.next[text[n - 1]]] = n - 1
    last.next[text[n - 1]] -= 1
    seams = (starts + large_sizes - 1)[(small_sizes > 0) & (large_sizes > 0)]
    for a, b in last.filled():
        own = seams[slice(*seams.searchsorted((a, b)))]
        if len(own):
            last.shared[own] = np.minimum(np.minimum(run[last.at[own]], run[last.at[own + 1]]), cap)
        before = last.at[a:b][::-1] - 1
        source = (small[before] & (before >= 0)).nonzero()[0]
        before = before[source]
        last.push(last.shared[a:b][::-1], source, text[before], before)
    return last.at, last.shared


def common_prefixes(strings: Iterable[bytes], length: int, *, memory_rows: int = 1 << 20) -> Iterator[np.ndarray]:
    """For each string the longest prefix, up to ``length``, that each of its starts shares with another start.

    Prefixes end inside their strings; an empty string gives an empty array. The strings
    are read once and kept in a file if they have more than ``memory_rows`` bytes.
    """
    with tempfile.TemporaryDirectory(prefix="quarry-sort-") as folder:
        scratch = Scratch(Path(folder), memory_rows)
        with tempfile.SpooledTemporaryFile(max_size=scratch.memory_rows, dir=folder) as spool:
            sizes = np.fromiter((spool.write(s) for s in strings), np.int64)
            spool.seek(0)
            closing = int((sizes > 0).sum())
            n = int(sizes.sum()) + closing
            most = scratch.array(n, np.int16)
            if n:
                text, at = scratch.array(n, np.int32), 0
                for k, size in enumerate(sizes[sizes > 0].tolist()):
                    text[at : at + size] = np.frombuffer(spool.read(size), np.uint8).astype(np.int32) + closing
                    text[at + size] = k
                    at += size + 1
        if n:
            order, shared = _sorted_suffixes(text, closing + 256, closing, min(length, _MOST - 2), scratch)
            before = 0
            for a, b in scratch.blocks(n):
                here = np.asarray(shared[a:b])
                most[order[a:b]] = np.maximum(here, np.append(before, here[:-1]))
                before = here[-1]
        at = 0
        for size in sizes.tolist():
            yield np.array(most[at : at + size])
            at += size + bool(size)


def repeated_starts(strings: Iterable[bytes], length: int, *, memory_rows: int = 1 << 20) -> Iterator[np.ndarray]:
    """For each string True at each start whose ``length`` bytes, inside the string, also start elsewhere."""
    return (shared >= length for shared in common_prefixes(strings, length, memory_rows=memory_rows))
