"""A Python data source for paged time-series endpoints: the time range is cut into partitions that page on their own.

``fetch(symbol, start_ms, end_ms, limit)`` is any importable function ``module:name`` that returns a page of dicts in time order; the network side lives there. A page that is empty or does not
advance ends its range; failing pages are tried again with growing pauses.
"""

from __future__ import annotations

import importlib
import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Range(InputPartition):
    def __init__(self, symbol: str, start: int, end: int):
        super().__init__((symbol, start, end))
        self.symbol, self.start, self.end = symbol, start, end


class PagedReader(DataSourceReader):
    def __init__(self, options: dict, names: list[str]):
        self.o, self.names = options, names

    def partitions(self) -> list[Range]:
        start, end, size = int(self.o["start"]), int(self.o["end"]), int(self.o.get("rangeMs", 86_400_000))
        return [Range(s, lo, min(end, lo + size - 1)) for s in self.o["symbols"].split(",") for lo in range(start, end + 1, size)]

    def _page(self, fetch, symbol: str, lo: int, hi: int, limit: int) -> list[dict]:
        pause, tries = float(self.o.get("sleepMs", 250)) / 1000, int(self.o.get("attempts", 5))
        for n in range(tries):
            try:
                return fetch(symbol, lo, hi, limit)
            except Exception:
                if n == tries - 1:
                    if self.o.get("tolerateFailure", "false") == "true":
                        return []
                    raise
                time.sleep(pause * (n + 2))
        return []

    def read(self, partition: Range) -> Iterator[tuple]:
        module, _, name = self.o["fetch"].partition(":")
        fetch, limit, key = getattr(importlib.import_module(module), name), int(self.o.get("limit", 1000)), self.o.get("timeField", "time")
        at = partition.start
        while at <= partition.end:
            page = self._page(fetch, partition.symbol, at, partition.end, limit)
            if not page:
                return
            for row in page:
                yield tuple(partition.symbol if n == "symbol" else row.get(n) for n in self.names)
            last = int(page[-1][key])
            if last < at or len(page) < limit:
                return
            at = last + 1


class PagedSource(DataSource):
    """``spark.dataSource.register(PagedSource)``, then ``spark.read.format("paged_series").schema(...).options(fetch=..., symbols=..., start=..., end=...)``."""

    @classmethod
    def name(cls) -> str:
        return "paged_series"

    def schema(self) -> str:
        return "symbol string, time bigint, value double"

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options, schema.fieldNames())
