"""Streaming snapshots: last values and trailing flow per symbol, as Structured Streaming with state per symbol."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.streams import frame_starts
from ..operators.windows import flow_arrays, suffix

OUT = "symbol string, t bigint, seq bigint, price double, buyQty double, sellQty double, netQty double, vwap double, trendPct double"
STATE = "t array<bigint>, price array<double>, qty array<double>, buy array<int>"


def trailing(window_ms: int, idle_ms: int | None):
    """State function: the trades of the last ``window_ms`` of one symbol as arrays; emits a row a trade. A batch's trades are worked out at once, with what is held; one that comes late finds its place among what is held."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values(["t", "seq"], kind="stable")
        side = rows["side"].to_numpy()
        new = [rows["t"].to_numpy(np.int64), rows["price"].to_numpy(float), rows["qty"].to_numpy(float), np.where(side == "BUY", 1, np.where(side == "SELL", 0, -1))]
        held = [np.array(x, y.dtype) for x, y in zip(state.get, new)] if state.exists else [y[:0] for y in new]
        fresh = np.concatenate([np.zeros(len(held[0]), bool), np.ones(len(rows), bool)])
        order = np.argsort(np.concatenate([held[0], new[0]]), kind="stable")
        t, price, qty, buy = (np.concatenate([x, y])[order] for x, y in zip(held, new))
        got = flow_arrays(t, price, qty, buy == 1, buy == 0, [window_ms], "")
        first = price[frame_starts(t, window_ms)]
        with np.errstate(divide="ignore", invalid="ignore"):
            trend = np.where(first > 0, (price - first) / first * 100, np.nan)
        at, tail = np.flatnonzero(fresh[order]), suffix(window_ms)
        keep = t >= t[-1] - window_ms
        state.update(tuple(x[keep].tolist() for x in (t, price, qty, buy)))
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)
        yield pd.DataFrame({"symbol": key[0], "t": t[at], "seq": rows["seq"].to_numpy(), "price": price[at], **{n: got[f"{m}_{tail}"][at] for n, m in (("buyQty", "BuyQty"), ("sellQty", "SellQty"), ("netQty", "NetQty"), ("vwap", "VWAP"))}, "trendPct": trend[at]})

    return step


def trailing_flow(trades: DataFrame, window_ms: int, idle_ms: int | None = None) -> DataFrame:
    """A stream of trades (symbol, t, seq, price, qty, side) -> trailing metrics at each trade. With ``idle_ms``, a symbol without trades for so long (processing time) leaves the state; the query then runs batches without data too.

    Trades of one time that come in one batch count for each other. For results that do not depend on the order of arrival see ``ticks``.
    """
    return trades.filter("qty > 0").groupBy("symbol").applyInPandasWithState(trailing(window_ms, idle_ms), OUT, STATE, "append", GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout)


def windowed_flow(trades: DataFrame, window: str = "1 minute", slide: str | None = None, late: str = "30 seconds") -> DataFrame:
    """Event-time windows with a watermark: the built-in form where a trailing value at each trade is not needed."""
    from ..operators.windows import flow_columns

    timed = trades.filter("qty > 0").withColumn("ts", F.timestamp_millis("t")).withWatermark("ts", late)
    return timed.groupBy("symbol", F.window("ts", window, slide)).agg(*[c.alias(n) for n, c in flow_columns(None, "flow").items()])


def snapshot_ticks(ticks: DataFrame, latest: DataFrame, columns: list[str]) -> DataFrame:
    """Stream of ticks joined with the current table of latest values (stream-static)."""
    return ticks.join(latest.select("symbol", *columns), "symbol", "left")


def start_json_sink(rows: DataFrame, path: str, checkpoint: str, t: str = "time", once: bool = False):
    """Hour-partitioned JSON sink of a stream; exactly once by the file sink's log."""
    from ..functions.coerce import date_key, hour_key

    keyed = rows.withColumns({"date": date_key(F.col(t)), "hour": hour_key(F.col(t))})
    w = keyed.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).partitionBy("date", "hour").outputMode("append")
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime="1 second")).start()
