"""Complete reads of a capped, paged time-series service, as a Spark data source.

A service answers a request for [start, end] with the points of the latest times
first or last but never more than a cap, so a full page may hide points. Partitions
read groups of device and key pairs, and report how complete each answer is.

Read as a batch, the source asks for one window. Read as a stream, its offset is the time up
to which all pairs are pulled: the end of a run's window is in the offset log before
anything is asked for, so a run that stopped half-way asks for the same frozen window
again, and a later run goes on from where that ends.
"""

from __future__ import annotations

import heapq
import importlib
import itertools
import json
import math
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .spool import Spool

SERVER_CAP = 5000
Page = Callable[[int, int, int], list[dict]]


class RetryableError(Exception):
    """Worth another try: a timeout, 429 or a server error. A second argument is the wait that the service asks for."""


class AuthError(Exception):
    """The token is no longer good: worth one try with a new one."""


class PermanentError(Exception):
    """No other try will help: the request itself is refused."""


@dataclass
class Outcome:
    """Points in order of time, how complete they are, and what it took."""

    points: Spool | list[dict] = field(default_factory=list)
    completeness: str = "complete"
    pages: int = 0
    error: str | None = None


def _identity(p: dict) -> tuple[int, str]:
    return int(p["ts"]), json.dumps(p.get("value"), sort_keys=True)


def read_pages(page: Page, start: int, end: int, limit: int = SERVER_CAP, most_pages: int = 1000) -> Outcome:
    """Follow pages of rising time from ``start`` to ``end``.

    The next page begins at the last time seen, not after it, since points of one time
    may be split between pages; repeats are dropped. A full page of a single time is
    asked for once more at the server's cap. A full page at the cap, or a page with
    points from before its start, can bring nothing new: the read is partial.
    Points from before the next page's start are spooled, so a page is held and not the window.
    """
    limit, seen, out, cursor = min(limit, SERVER_CAP), {}, Outcome(Spool()), start

    def settle(before: float) -> None:
        for k in sorted(k for k in seen if k[0] < before):
            out.points.append(seen.pop(k))

    while True:
        if out.pages == most_pages:
            out.completeness, out.error = "partial", "page_limit"
            break
        got = page(cursor, end, limit)
        out.pages += 1
        if any(int(p["ts"]) < cursor for p in got):
            out.completeness, out.error = "partial", "stalled"
            break
        seen.update((_identity(p), p) for p in got)
        if len(got) < limit:
            break
        last = max(int(p["ts"]) for p in got)
        if last > cursor:
            cursor = last
            settle(cursor)
        elif limit < SERVER_CAP:
            limit = SERVER_CAP
        else:
            out.completeness, out.error = "partial", "stalled"
            break
    settle(math.inf)
    return out


def _merged(parts: list) -> Spool:
    """The points of parts in order, each once."""
    out, keyed = Spool(), [((_identity(p), p) for p in part) for part in parts]
    for _, same in itertools.groupby(heapq.merge(*keyed, key=lambda x: x[0]), key=lambda x: x[0]):
        *_, (_, point) = same
        out.append(point)
    return out


def resolve(page: Page, start: int, end: int, limit: int = SERVER_CAP, least_window: int = 60_000, most_pages: int = 1000) -> Outcome:
    """Read [start, end]; halve the window where a read stays partial, down to ``least_window``."""
    try:
        whole = read_pages(page, start, end, limit, most_pages)
    except (RetryableError, AuthError, PermanentError) as e:
        return Outcome([], "failed", 0, f"{type(e).__name__}: {e.args[0] if e.args else ''}")
    if whole.completeness == "partial" and end - start > least_window:
        whole.points = []  # the halves are read anew
        middle = (start + end) // 2
        parts = [resolve(page, a, b, limit, least_window, most_pages) for a, b in ((start, middle), (middle + 1, end))]
        kinds = {p.completeness for p in parts}
        worst = "failed" if kinds == {"failed"} else "partial" if kinds & {"failed", "partial"} else "complete"
        whole = Outcome(_merged([p.points for p in parts]), worst, whole.pages + sum(p.pages for p in parts), next((p.error for p in parts if p.error), None))
    if whole.completeness == "complete" and not whole.points:
        whole.completeness = "empty_verified"
    return whole


def with_retries(
    call: Callable[[], list[dict]], *, attempts: int = 4, sleep: Callable[[float], None], base_s: float = 1.0, most_s: float = 120.0,
    jitter: float = 0.0, renew: Callable[[], None] | None = None,
) -> list[dict]:
    """Try again after retryable errors, waiting twice as long each time, or as long as the error asks.

    Own waits vary by the share ``jitter`` either way, so that tasks that failed together do not come
    back together. An ``AuthError`` is worth one ``renew`` and one more try at once; a
    ``PermanentError`` none.
    """
    for attempt in range(attempts):
        try:
            return call()
        except AuthError:
            if renew is None:
                raise
            renew()
            renew = None
        except RetryableError as e:
            if attempt == attempts - 1:
                raise
            asked = e.args[1] if len(e.args) > 1 else None
            own = min(most_s, base_s * 2**attempt) * (1 + random.uniform(-jitter, jitter))
            sleep(min(most_s, float(asked)) if asked is not None else own)
    return call()


class Pacer:
    """At most ``per_second`` calls a second over all tasks: each of ``tasks`` at once takes its part."""

    def __init__(self, per_second: float, tasks: int, *, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self._gap, self._clock, self._sleep, self._next = tasks / per_second, clock, sleep, None

    def wait(self) -> None:
        now = self._clock()
        if self._next is not None and self._next > now:
            self._sleep(self._next - now)
            now = self._next
        self._next = now + self._gap


@dataclass
class SeriesPartition(InputPartition):
    """A group of pairs and the window (after ``start`` at a stream's, from it at a batch's) to ask for."""

    group: object
    start: int
    end: int

    def __init__(self, group: object, start: int, end: int) -> None:
        super().__init__(0)
        self.group, self.start, self.end = group, start, end


class SeriesSource(DataSource):
    """``spark.read.format("paged_series")``, or ``readStream``.

    Options: ``start`` and ``end`` of the window; ``client``, ``module:name`` of a class made from the
    options, with ``groups()`` on the driver, ``pairs(group)`` and ``page(device_id, key)``, a ``Page``,
    in tasks, and perhaps ``renew()``. Or, for a few pairs, ``work`` (JSON pairs) and a client
    that is a function of a pair. ``limit`` is the page size asked for. ``calls_per_second`` paces the
    whole read when ``tasks`` (the slots that the cluster gives it) is stated with it.

    Rows carry the request's completeness. In a batch gaps are data and never end the read. In a
    stream an incomplete answer ends the batch, which the next run repeats with the same window.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_series"

    def schema(self) -> str:
        return "device_id string, key string, ts bigint, value string, completeness string, error string"

    def reader(self, schema: object) -> DataSourceReader:
        return SeriesReader(self.options)

    def streamReader(self, schema: object) -> DataSourceStreamReader:
        return SeriesStreamReader(self.options)


class _Listed:
    """A client over the pairs that ``work`` names; each is a group of its own."""

    def __init__(self, options: dict, page_of: Callable[[str, str], Page]) -> None:
        self._work, self.page = json.loads(options["work"]), page_of

    def groups(self) -> list:
        return self._work

    def pairs(self, group: list) -> list:
        return [tuple(group)]


class _Asking:
    def __init__(self, options: dict) -> None:
        # a plain dict, since the data source's own options cannot go to workers in a closure
        self._options = {k: options[k] for k in options}
        self._limit = int(self._options.get("limit", SERVER_CAP))

    def _client(self) -> object:
        module, name = self._options["client"].split(":")
        found = getattr(importlib.import_module(module), name)
        return _Listed(self._options, found) if "work" in self._options else found(self._options)

    def _pairs(self, partition: SeriesPartition) -> Iterator[tuple[str, str, Outcome]]:
        client = self._client()
        rate = float(self._options.get("calls_per_second", 0))
        pacer = Pacer(rate, int(self._options.get("tasks", 1))) if rate else None
        for device_id, key in client.pairs(partition.group):
            page = client.page(device_id, key)

            def ask(*window: int, page: Page = page) -> list[dict]:
                if pacer:
                    pacer.wait()
                return page(*window)

            def patient(*window: int, ask: Page = ask) -> list[dict]:
                return with_retries(lambda: ask(*window), sleep=time.sleep, base_s=float(self._options.get("base_s", 1.0)), jitter=0.2, renew=getattr(client, "renew", None))

            yield device_id, key, resolve(patient, partition.start, partition.end, self._limit)

    def _rows(self, device_id: str, key: str, found: Outcome) -> Iterator[tuple]:
        for p in found.points:
            yield device_id, key, int(p["ts"]), json.dumps(p.get("value")), found.completeness, found.error


class SeriesReader(_Asking, DataSourceReader):
    def partitions(self) -> list[SeriesPartition]:
        start, end = int(self._options["start"]), int(self._options["end"])
        return [SeriesPartition(g, start, end) for g in self._client().groups()]

    def read(self, partition: SeriesPartition) -> Iterator[tuple]:
        for device_id, key, found in self._pairs(partition):
            yield from self._rows(device_id, key, found)
            if not found.points:
                yield device_id, key, None, None, found.completeness, found.error


class IncompletePull(Exception):
    """A pair's window could not be read whole."""


class SeriesStreamReader(_Asking, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"through": int(self._options["start"]) - 1}

    def latestOffset(self) -> dict:
        return {"through": int(self._options["end"])}

    def partitions(self, start: dict, end: dict) -> list[SeriesPartition]:
        after, through = start["through"], end["through"]
        return [SeriesPartition(g, after + 1, through) for g in self._client().groups()] if through > after else []

    def read(self, partition: SeriesPartition) -> Iterator[tuple]:
        for device_id, key, found in self._pairs(partition):
            if found.completeness in ("partial", "failed"):
                raise IncompletePull(f"{device_id} {key}: {found.error}")
            yield from self._rows(device_id, key, found)
