"""Listings of a service (devices, assets, customers) as a Spark data source.

A listing has pages with a total and a flag that more follow. The first page is asked for
when the read is planned, for its total; the others are partitions of some pages each. A
partition goes on to the page that says no more follow, so a listing that grows meanwhile
is read to its end. Conditions of equality on columns that the service can search by go
to it. Calls are paced over all tasks together.
"""

from __future__ import annotations

import bisect
import importlib
import itertools
import json
import time
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition

from .paged import Pacer, with_retries


@dataclass
class PageRange(InputPartition):
    """Pages from ``first``; ``last`` is None in the partition that reads to the end."""

    first: int
    last: int | None

    def __init__(self, first: int, last: int | None) -> None:
        super().__init__(0)
        self.first, self.last = first, last


class RegistrySource(DataSource):
    """``spark.read.format("paged_registry").schema(...)`` with options client, kind, page_size, partitions, calls_per_second.

    ``client`` is ``module:name`` of a class made from the options, with ``page(kind, number, size, wanted)``
    that returns {"data": [rows as dicts], "hasNext": bool, "total": int}, where ``wanted`` are the
    conditions it applies, and ``searchable``, the columns that these may name. ``renew()`` is
    optional. Columns of the schema that a row lacks are null; values are read as the schema's types.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_registry"

    def schema(self) -> str:
        return "id string, name string, type string"

    def reader(self, schema: object) -> DataSourceReader:
        return RegistryReader(self.options, [f.name for f in schema.fields])


class RegistryReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]) -> None:
        self._options, self._columns, self._wanted = {k: options[k] for k in options}, columns, {}
        self._size, self._parts = int(self._options.get("page_size", 100)), int(self._options.get("partitions", 8))

    def _client(self) -> object:
        module, name = self._options["client"].split(":")
        return getattr(importlib.import_module(module), name)(self._options)

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        searchable = self._client().searchable
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in searchable and f.attribute[0] not in self._wanted:
                self._wanted[f.attribute[0]] = f.value
            else:
                yield f

    def _pages(self, first: int, last: int | None, tasks: int) -> Iterator[dict]:
        client, rate = self._client(), float(self._options.get("calls_per_second", 0))
        pacer, number = Pacer(rate, tasks) if rate else None, first

        def ask() -> dict:
            if pacer:
                pacer.wait()
            return client.page(self._options["kind"], number, self._size, self._wanted)

        while last is None or number <= last:
            page = with_retries(ask, sleep=time.sleep, base_s=float(self._options.get("base_s", 1.0)), jitter=0.2, renew=getattr(client, "renew", None))
            yield page
            if not page["hasNext"]:
                return
            number += 1

    def partitions(self) -> list[PageRange]:
        total = next(self._pages(0, 0, 1))["total"]
        pages = max(1, -(-total // self._size))
        each = max(1, -(-pages // self._parts))
        ranges = [PageRange(k, k + each - 1) for k in range(0, pages, each)]
        ranges[-1] = PageRange(ranges[-1].first, None)
        return ranges

    def read(self, partition: PageRange) -> Iterator[tuple]:
        for page in self._pages(partition.first, partition.last, self._parts):
            for row in page["data"]:
                yield tuple(row.get(c) for c in self._columns)


#: Rows in a slice of a staged listing: what a task holds of it at a time.
SLICE = 50_000


def stage(rows: DataFrame, folder: str, kind: str, slice_rows: int = SLICE) -> None:
    """Write a listing in slices of its names' order, and for ``SlicedRegistry`` how many rows of each search value a slice has."""
    store, by = f"{folder}/kind={kind}", [c for c in SlicedRegistry.searchable if c in rows.columns]
    dealt = rows.repartitionByRange("name", "id").sortWithinPartitions("name", "id")
    dealt.write.option("maxRecordsPerFile", slice_rows).parquet(store)
    slices = rows.sparkSession.read.schema(rows.schema).parquet(store).groupBy(F.col("_metadata.file_name").alias("slice"), *by)
    slices.agg(F.count(F.lit(1)).alias("n")).coalesce(1).write.parquet(f"{folder}/index={kind}")  # a few rows a slice


def _opened(store: str) -> tuple:
    """The file system of a path or URI, and the path there."""
    import pyarrow.fs as fs

    return fs.FileSystem.from_uri(store) if "://" in store or store.startswith("file:") else (fs.LocalFileSystem(), store)


class StagedRegistry:
    """A listing from JSON lines, held whole and in its names' order: for small ones.

    Options: ``store``, a folder that all nodes reach, with ``kind=<kind>`` folders. ``faults``: ``busy`` turns
    the first call for each page away. ``log``, a local folder in tests, gets a line a call with its time.
    """

    searchable = ("type", "customer_id")

    def __init__(self, options: dict) -> None:
        self._options, self._asked, self._held = options, None, {}

    def _all(self, kind: str) -> list[dict]:
        import pyarrow.fs as fs

        files, root = _opened(self._options["store"])
        rows = []
        for info in files.get_file_info(fs.FileSelector(f"{root}/kind={kind}", allow_not_found=True)):
            if info.is_file and info.base_name.startswith("part-") and info.base_name.endswith(".json"):
                with files.open_input_stream(info.path) as stream:
                    rows += [json.loads(line) for line in stream.read().decode().splitlines()]
        return sorted(rows, key=lambda r: (r.get("name") or "", r["id"]))

    def _found(self, kind: str, wanted: dict, first: int, size: int) -> tuple[list[dict], int]:
        """``size`` of the wanted rows from place ``first`` on, and how many there are in all."""
        asked = (kind, *sorted(wanted.items()))
        if asked not in self._held:
            self._held = {asked: [r for r in self._all(kind) if all(r.get(c) == v for c, v in wanted.items())]}
        return self._held[asked][first : first + size], len(self._held[asked])

    def page(self, kind: str, number: int, size: int, wanted: dict) -> dict:
        from .paged import RetryableError

        if self._options.get("log"):
            with open(f"{self._options['log']}/{time.time_ns()}-{kind}-{number}", "w") as f:
                f.write(json.dumps(wanted))
        if "busy" in self._options.get("faults", "") and (kind, number) != self._asked:
            self._asked = (kind, number)
            raise RetryableError("429", 0.001)
        own, total = self._found(kind, wanted, number * size, size)
        return {"data": own, "hasNext": (number + 1) * size < total, "total": total}


class SlicedRegistry(StagedRegistry):
    """A listing that ``stage`` wrote. A page is found by the counts of its slices, and one slice is held at a time."""

    def _places(self, kind: str, wanted: dict) -> tuple[list[str], list[int]]:
        """The slices with wanted rows, and how many of these there are up to the end of each."""
        import pyarrow.dataset as pads

        files, root = _opened(self._options["store"])
        index = pads.dataset(f"{root}/index={kind}", filesystem=files, format="parquet")
        if not set(wanted) <= set(index.schema.names):
            return [], []
        counts: dict[str, int] = {}
        for batch in index.to_batches(columns=["slice", "n"], filter=self._test(wanted)):
            for name, n in zip(batch.column("slice").to_pylist(), batch.column("n").to_pylist()):
                counts[name] = counts.get(name, 0) + n
        names = sorted(counts)
        return names, list(itertools.accumulate(counts[s] for s in names))

    @staticmethod
    def _test(wanted: dict) -> object:
        import pyarrow.compute as pc

        test = pc.scalar(True)
        for column, value in wanted.items():
            test = test & (pc.field(column) == value)
        return test

    def _slice(self, kind: str, wanted: dict, name: str) -> object:
        import pyarrow.dataset as pads

        if self._held.get("slice") != name:
            files, root = _opened(self._options["store"])
            self._held |= {"slice": name, "rows": pads.dataset(f"{root}/kind={kind}/{name}", filesystem=files, format="parquet").to_table(filter=self._test(wanted))}
        return self._held["rows"]

    def _found(self, kind: str, wanted: dict, first: int, size: int) -> tuple[list[dict], int]:
        asked = (kind, *sorted(wanted.items()))
        if self._held.get("asked") != asked:
            self._held = {"asked": asked, "places": self._places(kind, wanted)}
        names, ends = self._held["places"]
        total, own = ends[-1] if ends else 0, []
        last = min(first + size, total)
        while first < last:
            k = bisect.bisect_right(ends, first)
            inside = first - (ends[k - 1] if k else 0)
            own += self._slice(kind, wanted, names[k]).slice(inside, last - first).to_pylist()
            first = min(last, ends[k])
        return own, total
