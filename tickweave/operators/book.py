"""Order books from diff or partial depth events: sequence checks, buffering, resync requests, depth sums.

``Book`` is the state of one symbol. A book starts anew at a snapshot that covers every event before it (``borders``): what was held is void then, so the stretches between such snapshots are replayed apart, each by a task. What
crosses them is the pause between resync requests alone, which is a greedy selection in time (``greedy``). The streaming form keeps the same object as state.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .framing import carried
from .greedy import greedy

BUFFER_LIMIT = 2000
SNAPSHOT_LIMIT = 100
COOLDOWN_MS = 10_000
DAY_MS = 86_400_000


def _levels(rows) -> list[tuple[float, float]]:
    out = []
    for row in rows if rows is not None else ():
        try:
            p, q = (0.0 if v is None or v == "" else float(v) for v in row[:2])
        except (TypeError, ValueError):
            continue
        if abs(p) < float("inf") and abs(q) < float("inf"):
            out.append((p, q))
    return out


@dataclass
class Book:
    bids: dict = field(default_factory=dict)
    asks: dict = field(default_factory=dict)
    last_id: int | None = None
    last_event: int | None = None
    ready: bool = False
    stale: bool = False
    buffer: list = field(default_factory=list)
    next_sync: int = 0

    def standing(self, e: dict, held: bool = False) -> str:
        """How an event stands to the chain of update ids: the name of its fault, "old", or "" for the next link."""
        tests = HELD_CHAIN if held else CHAIN
        return next((name for name, holds in tests if holds(self, e)), "")

    def event(self, e: dict, partial: bool = False, keep: int = SNAPSHOT_LIMIT, limit: int = BUFFER_LIMIT, cooldown: int = COOLDOWN_MS) -> str | None:
        """Takes an event (firstId, finalId, prevId, lastUpdateId, b, a, t); returns the reason of a resync request, if one is due."""
        self.last_event = e["t"]
        if partial:
            last = e.get("lastUpdateId")
            self._begin(self.last_id if last is None else last, e["b"], e["a"])
            self.ready, self.stale = True, False
            return None
        fault = self.standing(e)
        if not fault:
            self._link(e, keep)
            self.stale = False
        if fault in ("", "old"):
            return None
        self.buffer = [*self.buffer, e][-limit:]
        self.stale = True
        return self._ask(fault, e["t"], cooldown)

    def sync(self, last_id: int | None, bids, asks, now: int, keep: int = SNAPSHOT_LIMIT, limit: int = BUFFER_LIMIT, cooldown: int = COOLDOWN_MS) -> str | None:
        """Takes a full snapshot and replays what was held since: from the first event that spans the snapshot's end on."""
        if last_id is None:
            return None
        self._begin(last_id, bids, asks)
        newer = [e for e in self.buffer if e.get("finalId") is not None and e["finalId"] > last_id]
        spanning = [n for n, e in enumerate(newer) if (e.get("firstId") or 0) <= last_id + 1]
        self.ready, self.buffer = False, newer[-limit:]
        if newer and not spanning:
            return None
        left = newer[spanning[0] :] if spanning else []
        while left:
            fault = self.standing(left[0], held=True)
            if fault:
                self.buffer = left
                return self._ask(fault, now, cooldown)
            self._link(left.pop(0), keep)
        self.ready, self.stale, self.buffer = True, False, []
        return None

    def _begin(self, last_id: int | None, bids, asks) -> None:
        self.last_id, self.bids, self.asks = last_id, {}, {}
        self._put(self.bids, bids)
        self._put(self.asks, asks)

    def _link(self, e: dict, keep: int) -> None:
        """Adds an event to the chain; a side three times too long is cut to its best levels."""
        for name, rows, sign in (("bids", e["b"], -1), ("asks", e["a"], 1)):
            side = getattr(self, name)
            self._put(side, rows)
            if len(side) > 3 * keep:
                setattr(self, name, dict(sorted(side.items(), key=lambda x: sign * x[0])[:keep]))
        self.last_id, self.last_event = e["finalId"], e["t"]

    @staticmethod
    def _put(side: dict, rows) -> None:
        for p, q in _levels(rows):
            side[p] = q
            if q == 0:
                del side[p]

    def _ask(self, reason: str, now: int, cooldown: int) -> str | None:
        due = now >= self.next_sync
        self.next_sync = now + cooldown if due else self.next_sync
        return reason if due else None

    def stats(self, level: int) -> tuple[float | None, float | None, float | None]:
        """Summed quantities of the best levels and their imbalance; nulls until ready. Served on while stale (see the column)."""
        if not self.ready:
            return None, None, None
        b = float(sum(q for _, q in sorted(self.bids.items(), reverse=True)[:level]))
        a = float(sum(q for _, q in sorted(self.asks.items())[:level]))
        return b, a, (b - a) / (b + a) if b + a > 0 else None

    def dump(self) -> str:
        d = asdict(self)
        return json.dumps(d | {"bids": list(self.bids.items()), "asks": list(self.asks.items())})

    @classmethod
    def load(cls, text: str) -> "Book":
        d = json.loads(text)
        return cls(**d | {"bids": {p: q for p, q in d["bids"]}, "asks": {p: q for p, q in d["asks"]}})


def _breaks(book: Book, e: dict) -> bool:
    return e.get("prevId") is not None and e["prevId"] != book.last_id


def _leaps(book: Book, e: dict) -> bool:
    return (e.get("firstId") or 0) > book.last_id + 1


Test = tuple[str, Callable[[Book, dict], bool]]
#: The faults of an event, in the order in which they are looked for; of one that was held, only whether it continues the chain.
CHAIN: tuple[Test, ...] = (
    ("missing_update_ids", lambda book, e: e.get("firstId") is None or e.get("finalId") is None), ("not_ready", lambda book, e: not book.ready or book.last_id is None), ("pu_mismatch", _breaks),
    ("old", lambda book, e: e["finalId"] <= book.last_id), ("gap_detected", _leaps),
)
HELD_CHAIN: tuple[Test, ...] = (("buffer_pu_mismatch", _breaks), ("buffer_gap_detected", _leaps))

EVENTS = "symbol string, t bigint, seq bigint, kind string, firstId bigint, finalId bigint, prevId bigint, lastUpdateId bigint, b array<array<string>>, a array<array<string>>"
STATES = "symbol string, t bigint, seq bigint, kind string, ready boolean, stale boolean, lastUpdateId bigint, depthBidQty double, depthAskQty double, depthImbalance double, resync string"


def _int(v) -> int | None:
    return None if v is None or v != v else int(v)


def step(book: Book, row: dict, level: int, partial: bool, cooldown: int = COOLDOWN_MS) -> tuple:
    """One row in, one state row out."""
    if row["kind"] == "snapshot":
        why = book.sync(_int(row["lastUpdateId"]), row["b"], row["a"], int(row["t"]), cooldown=cooldown)
    else:
        rows = lambda x: [] if x is None else [list(v) for v in x]
        why = book.event({"t": int(row["t"]), "firstId": _int(row["firstId"]), "finalId": _int(row["finalId"]), "prevId": _int(row["prevId"]), "lastUpdateId": _int(row["lastUpdateId"]), "b": rows(row["b"]), "a": rows(row["a"])}, partial, cooldown=cooldown)
    return (row["symbol"], int(row["t"]), int(row["seq"]), row["kind"], book.ready, book.stale, book.last_id, *book.stats(level), why)


def state_frame(out: list[tuple]) -> pd.DataFrame:
    df = pd.DataFrame(out, columns=[c.split()[0] for c in STATES.split(", ")])
    return df.astype({"lastUpdateId": "Int64", "depthBidQty": "float64", "depthAskQty": "float64", "depthImbalance": "float64"})


def borders(events: DataFrame, partial: bool = False, bucket_ms: int = DAY_MS) -> DataFrame:
    """Adds ``_start`` (t, seq): the last row at or before this one where the book starts anew, whatever came before.

    A snapshot does so if no earlier event of its symbol ends behind it, as then no held event counts. In partial mode nothing is ever held, so every row that names its update id does.
    The largest id before a row is found within (symbol, bucket), and across buckets from one number each.
    """
    here = F.struct("t", "seq")
    if partial:
        return carried(events.withColumns({"_start": F.when(F.col("lastUpdateId").isNotNull(), here), "_bucket": F.floor(F.col("t") / bucket_ms)}), ["_start"], ["symbol"], ["t", "seq"]).drop("_bucket")
    rows = events.withColumn("_bucket", F.floor(F.col("t") / bucket_ms)).repartition("symbol", "_bucket")
    ends = F.when(F.col("kind") != "snapshot", F.col("finalId"))
    inside = W.Window.partitionBy("symbol", "_bucket").orderBy("t", "seq").rowsBetween(W.Window.unboundedPreceding, -1)
    before = W.Window.partitionBy("symbol").orderBy("_bucket").rowsBetween(W.Window.unboundedPreceding, -1)  # a row a bucket
    tops = rows.groupBy("symbol", "_bucket").agg(F.max(ends).alias("_top")).select("symbol", "_bucket", F.max("_top").over(before).alias("_top"))
    rows = rows.withColumn("_most", F.max(ends).over(inside)).join(tops, ["symbol", "_bucket"])
    most = F.greatest("_most", "_top")
    sure = (F.col("kind") == "snapshot") & F.col("lastUpdateId").isNotNull() & (most.isNull() | (most <= F.col("lastUpdateId")))
    return carried(rows.withColumn("_start", F.when(sure, here)), ["_start"], ["symbol"], ["t", "seq"]).drop("_bucket", "_most", "_top")


def replay(events: DataFrame, level: int = 5, partial: bool = False, cooldown_ms: int = COOLDOWN_MS) -> DataFrame:
    """States after every event and snapshot (schema ``EVENTS``), in (symbol, t, seq) order: stretches between sure borders are replayed apart, one book in memory at a time.

    Rows without a symbol or a time are left out. A symbol whose snapshots are all behind its events has one stretch.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, book = None, Book()
        for rows in batches:
            out = []
            for row in rows.to_dict("records"):
                stretch = (row["symbol"], row["_t0"], row["_seq0"])
                if stretch != at:
                    at, book = stretch, Book()
                out.append(step(book, row, level, partial, 0))
            yield state_frame(out)

    rows = borders(events.filter("symbol IS NOT NULL AND t IS NOT NULL"), partial)
    rows = rows.select("*", F.coalesce("_start.t", F.lit(-1)).alias("_t0"), F.coalesce("_start.seq", F.lit(-1)).alias("_seq0")).drop("_start")
    wanted = rows.repartition("symbol", "_t0", "_seq0").sortWithinPartitions("symbol", "_t0", "_seq0", "t", "seq").mapInPandas(run, STATES)
    return spaced_requests(wanted, cooldown_ms)


def spaced_requests(states: DataFrame, cooldown_ms: int) -> DataFrame:
    """States whose every wish for a resync is in ``resync``, with those only that come ``cooldown_ms`` or more after the last one of the symbol."""
    rows = states.withColumn("_until", F.col("t") + cooldown_ms)
    rows = greedy(rows, "t", "_until", ["seq"], cooldown_ms, asks=F.col("resync").isNotNull(), name="_due")
    return rows.withColumn("resync", F.when(F.col("_due"), F.col("resync"))).drop("_until", "_due")


def depth_sums(bids: Column, asks: Column, level: int) -> dict[str, Column]:
    """Depth sums of ready books whose levels are arrays of struct(p, q)."""
    best = lambda side, asc: F.slice(F.sort_array(side, asc), 1, level)
    total = lambda side: F.aggregate(side, F.lit(0.0), lambda s, x: s + F.coalesce(x["q"], F.lit(0.0)))
    b, a = total(best(bids, False)), total(best(asks, True))
    return {"depthBidQty": b, "depthAskQty": a, "depthImbalance": F.when(b + a > 0, (b - a) / (b + a))}


def best_levels(levels: DataFrame, n: int, by: tuple[str, ...] = ("symbol", "side"), price: str = "price") -> DataFrame:
    """The ``n`` best levels a side: highest bids, lowest asks, with ``rank``."""
    key = F.when(F.col("side") == "bid", -F.col(price)).otherwise(F.col(price))
    return levels.withColumn("rank", F.row_number().over(W.Window.partitionBy(*by).orderBy(key))).filter(F.col("rank") <= n)
