"""Streaming snapshot ticks: every step of time, a row per symbol from the symbol's state, equal to the batch snapshots at the same ticks.

State per symbol (``transformWithState``): the latest value of each table (a map), the trailing moves by minute (a map of lists), events that wait for their tick (a map by tick), and the clock with the last snapshot (a value).

Event time: an event waits under the first tick at or after it; timers fire at the watermark, tick by tick in order, so events may arrive in any order within the lateness of the watermark. Rows later than
that never reach the state (Spark counts them as ``numRowsDroppedByWatermark``); rows behind a tick that was already given are counted in ``lateRows`` and left out.

Processing time: timers fire by the wall clock, and a tick takes what has arrived; events keep their own time for ages and frames.

A symbol without events for ``idle_ms`` gives no more rows and leaves the state; it begins anew with its next event.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.ticks import FLOWS, LATEST, PRICE, TICK, Trailing
from ..plans.snapshots import PRICES, SIDES, delta_names, derived

MINUTE = 60_000
#: Providers that keep timers and several states a key.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT = "symbol string, t bigint, seq bigint, tbl string, v array<double>"
#: Columns of the tables of moves, in the order of their values.
MOVES = {"trades": ("price", "qty"), "liquidations": ("price", "qty"), "prices": ("price",)}


def columns_of(table: str) -> tuple[str, ...]:
    return MOVES[table] if table in MOVES else tuple(SIDES[table][0])


def mixed(tables: dict[str, DataFrame]) -> DataFrame:
    """Streams (or tables) of a snapshot, by the names and columns of ``SIDES``, as one: symbol, t, seq, tbl, v. Values of flow tables end with the side (1 buy, 0 sell, -1 neither)."""
    out = None
    for name, rows in tables.items():
        if name in FLOWS:
            rows = rows.filter("qty > 0")
        elif name == "prices":
            rows = rows.filter("price IS NOT NULL")
        side = [F.when(F.col("side") == "BUY", 1.0).when(F.col("side") == "SELL", 0.0).otherwise(-1.0)] if name in FLOWS else []
        seq = F.col("seq").cast("bigint") if "seq" in rows.columns else F.lit(0).cast("bigint")
        one = rows.filter("symbol IS NOT NULL AND t IS NOT NULL").select("symbol", F.col("t").cast("bigint").alias("t"), seq.alias("seq"), F.lit(name).alias("tbl"), F.array(*[F.col(c).cast("double") for c in columns_of(name)], *side).alias("v"))
        out = one if out is None else out.unionByName(one)
    return out


class Symbol:
    """What is known of one symbol, in plain values: loaded from state, moved on, stored again."""

    def __init__(self, what: Trailing, tables: tuple[str, ...]):
        self.what, self.tables = what, tables
        self.latest: dict[str, list] = {}  # table: [t, values]
        self.moves: list[list] = []  # [t, seq, price, kind, qty, buy]
        self.last_price: int | None = None
        self.oldest: float | None = None

    def take(self, events: list[list]) -> None:
        """Events [t, seq, table, values], in any order: of equal times the larger sequence number is the later one."""
        for t, seq, table, v in sorted(events, key=lambda e: (e[0], e[1])):
            if table in SIDES:
                self.latest[table] = [t, v]
            if table in FLOWS:
                self.moves.append([t, seq, v[0], FLOWS[table][0], v[1], int(v[2])])
            elif table == "prices":
                self.moves.append([t, seq, v[0], PRICE, 0.0, -1])
                self.last_price = t

    def retained(self, now: int) -> None:
        """Forgets moves that no frame can reach: those older than the widest frame, but for prices retained with the last price."""
        own = now - self.what.width
        price = own if self.last_price is None else min(own, self.last_price - self.what.retention_ms)
        self.moves = [m for m in self.moves if m[0] >= (price if m[3] == PRICE else own)]

    def raw(self, now: int) -> dict[str, float | None]:
        """The raw columns of the snapshot at ``now``."""
        out: dict[str, float | None] = {}
        for table, (columns, age) in SIDES.items():
            t, v = self.latest.get(table, (None, None))
            out |= {new: None if v is None else v[k] for k, new in enumerate(columns.values())} | {age: None if t is None else now - t}
        rows = sorted([*self.moves, [now, LATEST, None, TICK, 0.0, -1]], key=lambda m: (m[0], m[1]))
        t, _, price, kind, qty, buy = (np.array(c, float if k in (2, 4) else np.int64) for k, c in enumerate(zip(*rows)))
        got = {n: v[-1] for n, v in self.what({"t": t, "price": price, "kind": kind, "qty": qty, "buy": buy}).items()}
        prices = kind == PRICE
        last = price[prices][-1] if prices.any() else np.nan
        held = prices & (t >= (self.last_price or 0) - self.what.retention_ms)
        for name in self.what.trends_ms:
            start = got.pop(f"first{name}")
            start = price[held][0] if np.isnan(start) and held.any() else start
            got[f"trend{name}"] = (last - start) / start * 100 if start > 0 else np.nan
        flows = {n: (v if self.has(n) else None) for n, v in got.items()}
        return out | {n: None if v is None or v != v else float(v) for n, v in flows.items()}

    def has(self, name: str) -> bool:
        return next((f in self.tables for f, (_, prefix) in FLOWS.items() if name.startswith(prefix)), "prices" in self.tables)


def raw_columns(what: Trailing) -> dict[str, str]:
    sides = {c: "double" for columns, _ in SIDES.values() for c in columns.values()} | {age: "bigint" for _, age in SIDES.values()}
    return sides | {n: kind for n, kind in what.columns.items() if not n.startswith("first")} | {f"trend{n}": "double" for n in what.trends_ms}


class Ticks(StatefulProcessor):
    """Emits (symbol, t, lateRows, raw columns, raw columns of the previous snapshot after ``_p_``)."""

    def __init__(self, what: Trailing, tables: tuple[str, ...], step_ms: int, idle_ms: int, event_time: bool):
        self.what, self.tables, self.step, self.idle, self.event_time = what, tables, step_ms, idle_ms, event_time
        self.names = list(raw_columns(what))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.latest = handle.getMapState("latest", "tbl string", "row string")
        self.moves = handle.getMapState("moves", "minute bigint", "rows string")
        self.waiting = handle.getMapState("waiting", "tick bigint", "rows string")
        self.clock = handle.getValueState("clock", "json string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        clock = self._clock()
        now = timerValues.getCurrentProcessingTimeInMs()
        new: dict[int, list] = {}
        for part in rows:
            for t, seq, table, v in zip(part["t"].tolist(), part["seq"].tolist(), part["tbl"].tolist(), part["v"].tolist()):
                tick = -(-(t if self.event_time else now) // self.step) * self.step
                if clock["done"] is not None and tick <= clock["done"]:
                    clock["late"] += 1
                else:
                    new.setdefault(tick, []).append([t, seq, table, [None if x is None or x != x else x for x in v]])
        for tick, events in new.items():
            held = json.loads(self.waiting.getValue((tick,))[0]) if self.waiting.containsKey((tick,)) else []
            self.waiting.updateValue((tick,), (json.dumps(held + events),))
        if new and (clock["next"] is None or min(new) < clock["next"]):
            clock["next"] = min(new)
            self.handle.registerTimer(clock["next"])
        self.clock.update((json.dumps(clock),))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        clock = self._clock()
        fired = expiredTimerInfo.getExpiryTimeInMs()
        if clock["next"] is None or fired < clock["next"]:
            return
        upto = timerValues.getCurrentWatermarkInMs() if self.event_time else timerValues.getCurrentProcessingTimeInMs()
        waiting = {k[0]: v[0] for k, v in self.waiting.iterator()}
        symbol = self._symbol(clock)
        out = []
        while clock["next"] is not None and clock["next"] <= upto:
            tick = clock["next"]
            events = json.loads(waiting.pop(tick, "[]"))
            if events:
                self.waiting.removeKey((tick,))
            if events:
                symbol.take(events)
                clock["seen"] = max(clock["seen"] or 0, max(e[0] for e in events) if self.event_time else tick)
            clock["done"] = tick
            if clock["seen"] is not None and tick - clock["seen"] > self.idle:
                symbol, clock = Symbol(self.what, self.tables), {"next": min(waiting, default=None), "done": tick, "seen": None, "late": clock["late"], "last": None, "price": None}
                continue
            symbol.retained(tick)
            raw = symbol.raw(tick)
            if any(raw[p] is not None for p in PRICES):
                out.append((key[0], tick, clock["late"], *[raw[n] for n in self.names], *[clock["last"] and clock["last"][n] for n in self.names]))
                clock["last"], clock["late"] = raw, 0
            clock["next"] = tick + self.step
        self._store(symbol, clock)
        if out:
            yield self._frame(out)

    def close(self) -> None:
        pass


    def _clock(self) -> dict:
        return json.loads(self.clock.get()[0]) if self.clock.exists() else {"next": None, "done": None, "seen": None, "late": 0, "last": None, "price": None}

    def _symbol(self, clock: dict) -> Symbol:
        s = Symbol(self.what, self.tables)
        s.latest = {k[0]: json.loads(v[0]) for k, v in self.latest.iterator()}
        s.moves = [m for _, rows in sorted((k[0], json.loads(v[0])) for k, v in self.moves.iterator()) for m in rows]
        s.last_price = clock["price"]
        return s

    def _store(self, s: Symbol, clock: dict) -> None:
        """Minutes and tables that did not change are not written again."""
        minutes: dict[int, list] = {}
        for m in s.moves:
            minutes.setdefault(m[0] // MINUTE, []).append(m)
        for state, now in ((self.moves, {k: json.dumps(v) for k, v in minutes.items()}), (self.latest, {k: json.dumps(v) for k, v in s.latest.items()})):
            before = {k[0]: v[0] for k, v in state.iterator()}
            for k in before.keys() - now.keys():
                state.removeKey((k,))
            for k, v in now.items():
                if before.get(k) != v:
                    state.updateValue((k,), (v,))
        if clock["next"] is None and not s.moves and not s.latest:
            self.clock.clear()
            return
        clock["price"] = s.last_price
        self.clock.update((json.dumps(clock),))
        if clock["next"] is not None:
            self.handle.registerTimer(clock["next"])

    def _frame(self, out: list[tuple]) -> pd.DataFrame:
        kinds = raw_columns(self.what)
        df = pd.DataFrame(out, columns=["symbol", "t", "lateRows", *self.names, *[f"_p_{n}" for n in self.names]])
        return df.astype({p + n: "Int64" if kinds[n] == "bigint" else "float64" for n in self.names for p in ("", "_p_")})


def snapshot_stream(events: DataFrame, tables: tuple[str, ...], windows_ms: list[int], trends_ms: dict[str, int], step_ms: int = 1000, late: str = "5 seconds", idle_ms: int = 3_600_000, event_time: bool = True, default_window_ms: int | None = None, retention_ms: int | None = None) -> DataFrame:
    """A stream of ``mixed`` events -> a stream of snapshots at every ``step_ms`` of each symbol, with the columns of ``build_snapshots`` (context apart) and ``lateRows``.

    ``tables`` says which tables the events hold. The session's state store must be ``STATE_STORE``.
    """
    what = Trailing(tuple(windows_ms), trends_ms, **({} if retention_ms is None else {"retention_ms": retention_ms}))
    raw = raw_columns(what)
    schema = "symbol string, t bigint, lateRows bigint, " + ", ".join(f"`{p}{n}` {kind}" for p in ("", "_p_") for n, kind in raw.items())
    rows = events.withColumn("_ts", F.timestamp_millis("t")).withWatermark("_ts", late) if event_time else events
    out = rows.groupBy("symbol").transformWithStateInPandas(Ticks(what, tables, step_ms, idle_ms, event_time), schema, "Append", "EventTime" if event_time else "ProcessingTime")
    out = derived(derived(out, windows_ms, default_window_ms), windows_ms, default_window_ms, "_p_")
    names = [n for n in delta_names(out) if not n.startswith("_p_") and n != "lateRows"]
    dropped = lambda n: n.endswith("AgeMs") or n.endswith("Completeness")
    out = out.withColumns({f"{n}Delta": F.lit(None).cast("double") if dropped(n) else F.col(n).cast("double") - F.col(f"_p_{n}") for n in names})
    return out.drop(*[c for c in out.columns if c.startswith("_p_")])
