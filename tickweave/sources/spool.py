"""A spool between sockets, which cannot be read again, and Spark, which reads a batch again after a failure.

A connection serves a share of the channels. Its messages are appended to a hidden segment; a full or old segment gets its final name, and only then does a stream see it, so each message is in one file for ever and the file source's own
offsets do the rest. A dropped connection is opened again after a pause. A spool that died leaves its hidden segment; the next one in its place ends it after its last whole line and goes on.

``connect(channels)`` is any importable function ``module:name`` that returns an iterator of messages; the socket lives there. ``start`` runs the connections as tasks of one long job, so a lost executor's connections are started anew
elsewhere; ``folder`` must be a file system that all of them mount.
"""

from __future__ import annotations

import importlib
import json
import os
import time
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from .feed import CHANNELS_A_CONNECTION, split

MESSAGE = "connection int, seq bigint, recvTime bigint, value string"
DELAY_S = 2.0


class Spool:
    """Segments of one connection. A line: connection, seq (goes on over restarts), recvTime, value."""

    def __init__(self, folder: str, connection: int, lines: int = 1000, seconds: float = 1.0):
        self.folder, self.connection, self.most, self.oldest = folder, connection, lines, seconds
        os.makedirs(folder, exist_ok=True)
        self.hidden = f"{folder}/.open-{connection}"
        done = [int(f.split("-")[2].split(".")[0]) for f in os.listdir(folder) if f.startswith(f"part-{connection}-")]
        self.seq = max(done, default=-1) + 1
        self.file, self.count, self.since = None, 0, time.time()
        self._recover()

    def _recover(self) -> None:
        """Ends what a spool before this one left open: its last line counts if it is whole."""
        if not os.path.exists(self.hidden):
            return
        with open(self.hidden, "rb") as f:
            whole = f.read().rpartition(b"\n")[0].splitlines()
        self.count = len(whole)
        with open(self.hidden, "wb") as f:
            f.write(b"".join(line + b"\n" for line in whole))
        self.seq += self.count
        self.roll()

    def put(self, message: str) -> None:
        if self.file is None:
            self.file, self.since = open(self.hidden, "a"), time.time()
        self.file.write(json.dumps({"connection": self.connection, "seq": self.seq, "recvTime": int(time.time() * 1000), "value": message}) + "\n")
        self.seq, self.count = self.seq + 1, self.count + 1
        if self.count >= self.most or time.time() - self.since >= self.oldest:
            self.roll()

    def roll(self) -> None:
        """Gives the open segment its name, which holds its last sequence number."""
        if self.file is not None:
            self.file.flush()
            os.fsync(self.file.fileno())
            self.file.close()
            self.file = None
        if self.count:
            os.replace(self.hidden, f"{self.folder}/part-{self.connection}-{self.seq - 1:015d}.json")
        elif os.path.exists(self.hidden):
            os.remove(self.hidden)
        self.count = 0


def keep_spooling(connect: Callable[[list[str]], Iterable[str]], channels: list[str], spool: Spool, delay_s: float = DELAY_S, going: Callable[[], bool] = lambda: True, wait: Callable[[float], None] = time.sleep) -> int:
    """Spools a connection's messages until ``going`` says no; a connection that ends or fails is opened again after a pause. Returns how often it was opened."""
    opened = 0
    while going():
        opened += 1
        try:
            for message in connect(channels):
                spool.put(message)
                if not going():
                    break
        except (OSError, EOFError):
            pass  # as a connection that ended
        spool.roll()
        if going():
            wait(delay_s)
    return opened


def start(spark: SparkSession, channels: list[str], folder: str, connect: str, per_connection: int = CHANNELS_A_CONNECTION, seconds: float | None = None, delay_s: float = DELAY_S) -> DataFrame:
    """Connection and times opened, once all have ended (``seconds`` from their start; else never): an action on it runs the job, a task a connection."""
    parts = split(channels, per_connection)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        module, _, name = connect.partition(":")
        opens = getattr(importlib.import_module(module), name)
        for rows in batches:
            for n in rows["id"].tolist():
                end = None if seconds is None else time.time() + seconds
                opened = keep_spooling(opens, parts[n], Spool(folder, n), delay_s, lambda end=end: end is None or time.time() < end)
                yield pd.DataFrame({"connection": [n], "opened": [opened]})

    return spark.range(0, len(parts), 1, len(parts)).mapInPandas(run, "connection int, opened int")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """The stream of spooled messages. Broken messages are dropped where they are typed (``projections.route``)."""
    return spark.readStream.schema(MESSAGE).option("pathGlobFilter", "part-*.json").json(folder)
