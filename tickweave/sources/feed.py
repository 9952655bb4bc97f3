"""The live feed: channel names from flags, their split over connections, and a streaming data source of raw messages.

``poll(channels, after, limit)`` is any importable function ``module:name`` that returns messages (JSON text) after a sequence number; the sockets live there. Each connection's channels
are a partition of every micro-batch.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

CHANNELS_A_CONNECTION = 120


def channel_names(symbols: list[str], trades: bool = True, books: bool = True, marks: bool = True, klines: tuple[str, ...] = ("1m", "5m"), liquidations: bool = True, tickers: bool = False, depth: str | None = "diff", level: int = 5, speed: str = "1000ms", all_market: bool = True) -> list[str]:
    """Names of the channels that a set of symbols needs; books, liquidations and tickers can come as one all-market channel each."""
    low = [s.lower() for s in symbols]
    out = []
    if trades:
        out += [f"{s}@aggTrade" for s in low]
    if books:
        out += ["!bookTicker"] if all_market else [f"{s}@bookTicker" for s in low]
    if marks:
        out += [f"{s}@markPrice@1s" for s in low]
    out += [f"{s}@kline_{k}" for k in klines for s in low]
    if liquidations:
        out += ["!forceOrder@arr"] if all_market else [f"{s}@forceOrder" for s in low]
    if tickers:
        out += ["!ticker@arr"] if all_market else [f"{s}@ticker" for s in low]
    if depth:
        tail = f"depth{level}" if depth == "partial" else "depth"
        out += [f"{s}@{tail}@{speed}" for s in low]
    return out


def split(names: list[str], size: int = CHANNELS_A_CONNECTION) -> list[list[str]]:
    return [names[k : k + size] for k in range(0, len(names), size)]


class Connection(InputPartition):
    def __init__(self, channels: list[str], after: int, upto: int):
        super().__init__((channels, after, upto))
        self.channels, self.after, self.upto = channels, after, upto


class FeedReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.o, self.at = options, int(options.get("startAt", 0))

    def initialOffset(self) -> dict:
        return {"seq": int(self.o.get("startAt", 0))}

    def latestOffset(self) -> dict:
        module, _, name = self.o["head"].partition(":")
        return {"seq": max(self.at, int(getattr(importlib.import_module(module), name)()))}

    def partitions(self, start: dict, end: dict) -> list[Connection]:
        return [Connection(c, start["seq"], end["seq"]) for c in split(self.o["channels"].split(","), int(self.o.get("perConnection", CHANNELS_A_CONNECTION)))]

    def read(self, partition: Connection) -> Iterator[tuple]:
        module, _, name = self.o["poll"].partition(":")
        poll = getattr(importlib.import_module(module), name)
        for seq, text in poll(partition.channels, partition.after, partition.upto):
            yield (int(seq), text)

    def commit(self, end: dict) -> None:
        self.at = end["seq"]


class FeedSource(DataSource):
    """``spark.readStream.format("market_feed").options(channels=..., head="module:name", poll="module:name")``: columns seq, value."""

    @classmethod
    def name(cls) -> str:
        return "market_feed"

    def schema(self) -> str:
        return "seq bigint, value string"

    def streamReader(self, schema) -> FeedReader:
        return FeedReader(self.options)
