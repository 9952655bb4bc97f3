"""Books that ask for snapshots and get them: a stream's resync requests drive a fetch, whose snapshots come back as a second input of the same stream.

A book's state has its book and its pace: when it last asked, when it may ask again, what it still wants. A wish is passed on if no request is under way and the pause is over; else a timer fires at the end of the pause and asks then,
if the book is still out of step. A request without an answer counts as lost at that time too. Answers are files of the inbox, a folder a micro-batch: a batch that is run again writes its own folder anew.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.book import COOLDOWN_MS, EVENTS, STATES, Book, state_frame, step

POOL = 4


class Books(StatefulProcessor):
    """Emits a state (``STATES``) for each event and snapshot, and one of kind ``timer`` for each request that a timer makes."""

    def __init__(self, level: int, partial: bool, cooldown_ms: int):
        self.level, self.partial, self.cooldown = level, partial, cooldown_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.book = handle.getValueState("book", "json string")
        self.pace = handle.getValueState("pace", "json string")

    def _load(self) -> tuple[Book, dict]:
        book = Book.load(self.book.get()[0]) if self.book.exists() else Book()
        return book, json.loads(self.pace.get()[0]) if self.pace.exists() else {"asked": False, "next": 0, "wish": None}

    def _store(self, book: Book, pace: dict) -> None:
        self.book.update((book.dump(),))
        self.pace.update((json.dumps(pace),))

    def _request(self, pace: dict, now: int) -> str | None:
        """The wish, if it may be passed on now; a timer looks after what may not, and after what is passed on."""
        if pace["wish"] is None or pace["asked"]:
            return None
        if now < pace["next"]:
            self.handle.registerTimer(pace["next"])
            return None
        reason = pace["wish"]
        pace |= {"asked": True, "next": now + self.cooldown, "wish": None}
        self.handle.registerTimer(pace["next"])
        return reason

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        book, pace = self._load()
        now = timerValues.getCurrentProcessingTimeInMs()
        out = []
        for row in pd.concat(list(rows)).sort_values(["t", "seq"], kind="stable").to_dict("records"):
            *state, wish = step(book, row, self.level, self.partial, 0)
            if row["kind"] == "snapshot":
                pace["asked"] = False
            pace["wish"] = wish or (pace["wish"] if book.stale or not book.ready else None)
            out.append((*state, self._request(pace, now)))
        self._store(book, pace)
        yield state_frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        book, pace = self._load()
        now = timerValues.getCurrentProcessingTimeInMs()
        if now < pace["next"]:
            return
        pace["asked"] = False  # unanswered by now: lost
        if book.stale or not book.ready:
            pace["wish"] = pace["wish"] or "unanswered"
        why = self._request(pace, now)
        self._store(book, pace)
        if why:
            yield state_frame([(key[0], book.last_event or 0, -1, "timer", book.ready, book.stale, book.last_id, *book.stats(self.level), why)])

    def close(self) -> None:
        pass


def book_stream(events: DataFrame, snapshots: DataFrame, level: int = 5, partial: bool = False, cooldown_ms: int = COOLDOWN_MS) -> DataFrame:
    """States of books from a stream of events and one of snapshots (both ``EVENTS``)."""
    return events.unionByName(snapshots).groupBy("symbol").transformWithStateInPandas(Books(level, partial, cooldown_ms), STATES, "Append", "ProcessingTime")


def fetch_snapshots(requests: DataFrame, fetch: Callable[[str], dict | None], pool: int = POOL) -> DataFrame:
    """Snapshot rows (``EVENTS``) for the symbols of some requests, each asked once: ``fetch(symbol)`` gives lastUpdateId, bids and asks. What fails or has no id gives no row."""

    def one(symbol: str) -> tuple | None:
        try:
            got = fetch(symbol)
            levels = [[[str(x) for x in level[:2]] for level in got[side] or ()] for side in ("bids", "asks")]
            return (symbol, int(time.time() * 1000), 2**40, "snapshot", None, None, None, int(got["lastUpdateId"]), *levels)
        except (OSError, ValueError, TypeError, KeyError):
            return None  # the book's timer asks again

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(pool) as threads:
            for rows in batches:
                found = [r for r in threads.map(one, rows["symbol"].tolist()) if r]
                if found:
                    yield pd.DataFrame(found, columns=[c.split()[0] for c in EVENTS.split(", ")]).astype({c: "Int64" for c in ("firstId", "finalId", "prevId")})

    return requests.filter("resync IS NOT NULL").select("symbol").distinct().mapInPandas(run, EVENTS)


def run_books(spark: SparkSession, events: DataFrame, inbox: str, fetch: Callable[[str], dict | None], sink: Callable[[DataFrame, int], None], checkpoint: str, level: int = 5, partial: bool = False, cooldown_ms: int = COOLDOWN_MS, every: str = "1 second") -> StreamingQuery:
    """Starts the loop: each micro-batch of states goes to ``sink(states, batch)``, its requests are fetched, and the answers are written to ``inbox``, which the same query reads."""
    spark.createDataFrame([], EVENTS).write.mode("append").parquet(f"{inbox}/batch=-1")
    answers = spark.readStream.schema(EVENTS).option("recursiveFileLookup", True).parquet(inbox)

    def batch(states: DataFrame, number: int) -> None:
        states = states.persist()
        try:
            sink(states, number)
            fetch_snapshots(states, fetch).write.mode("overwrite").parquet(f"{inbox}/batch={number}")
        finally:
            states.unpersist()

    states = book_stream(events, answers, level, partial, cooldown_ms)
    return states.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
