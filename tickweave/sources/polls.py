"""Polled endpoints as a stream: every period, each endpoint is asked once for each symbol.

``ask(endpoint, symbol)`` is any importable function ``module:name`` that returns the answer's JSON text (or None); the network lives there. Offsets are poll numbers (time / period), so a batch that is run again asks for the same
polls and its rows carry the same ``polledAt``: with a sink that keeps a batch once, no poll is lost or doubled. Polls that passed while nothing ran cannot be made up for: of several due polls the last is asked.
A partition has a share of the symbols and asks them through a pool, with growing pauses after failures; an answer that keeps failing gives no row.
"""

from __future__ import annotations

import importlib
import time
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SYMBOLS_A_PARTITION = 100
POOL = 6


class Poll(InputPartition):
    def __init__(self, symbols: list[str], number: int):
        super().__init__((symbols, number))
        self.symbols, self.number = symbols, number


class PollReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.o = options
        self.period = int(options.get("periodMs", 30_000))

    def _now(self) -> int:
        module, _, name = self.o.get("clock", "").partition(":")
        return int(getattr(importlib.import_module(module), name)()) if name else int(time.time() * 1000)

    def initialOffset(self) -> dict:
        return {"poll": self._now() // self.period - 1}

    def latestOffset(self) -> dict:
        return {"poll": self._now() // self.period}

    def partitions(self, start: dict, end: dict) -> list[Poll]:
        if end["poll"] <= start["poll"]:
            return []
        names, size = self.o["symbols"].split(","), int(self.o.get("perPartition", SYMBOLS_A_PARTITION))
        return [Poll(names[k : k + size], end["poll"]) for k in range(0, len(names), size)]

    def read(self, partition: Poll) -> Iterator[tuple]:
        module, _, name = self.o["ask"].partition(":")
        ask, tries, pause = getattr(importlib.import_module(module), name), int(self.o.get("attempts", 3)), float(self.o.get("sleepMs", 250)) / 1000

        def one(what: tuple[str, str]) -> str | None:
            for n in range(tries):
                try:
                    return ask(*what)
                except Exception:
                    time.sleep(pause * (n + 1))
            return None

        wanted = [(e, s) for e in self.o["endpoints"].split(",") for s in partition.symbols]
        with ThreadPoolExecutor(int(self.o.get("pool", POOL))) as threads:
            for (endpoint, symbol), body in zip(wanted, threads.map(one, wanted)):
                if body is not None:
                    yield (endpoint, symbol, partition.number * self.period, body)

    def commit(self, end: dict) -> None:
        pass


class PollSource(DataSource):
    """``spark.dataSource.register(PollSource)``, then ``spark.readStream.format("polled_endpoints").options(endpoints=..., symbols=..., ask="module:name", periodMs=...)``: endpoint, symbol, polledAt, body.

    ``readers.polled(rows.filter("endpoint = 'openInterest'"), "openInterest")`` types the answers.
    """

    @classmethod
    def name(cls) -> str:
        return "polled_endpoints"

    def schema(self) -> str:
        return "endpoint string, symbol string, polledAt bigint, body string"

    def streamReader(self, schema) -> PollReader:
        return PollReader(self.options)
