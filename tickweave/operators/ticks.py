"""Trailing features at ticks, from one stream of moves: trades, liquidations, prices and the ticks themselves, in time order.

The same arrays give the features of a batch (sorted partitions) and of a running stream (moves held in state).
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .framing import bucketed
from .streams import frame_ends, frame_starts, framed, sums
from .windows import FLOW, RETENTION_MS, _deviation, flow_arrays, suffix

TRADE, LIQUIDATION, PRICE, TICK = range(4)
#: Table of moves: its kind and the prefix of its flow metrics.
FLOWS = {"trades": (TRADE, "flow"), "liquidations": (LIQUIDATION, "liq")}
LATEST = 2**62  # ticks stand behind the moves of their time


@dataclass(frozen=True)
class Trailing:
    """What is computed at a tick: flow windows of the flow tables, trends and volatilities by name."""

    windows_ms: tuple[int, ...] = ()
    trends_ms: dict[str, int] = field(default_factory=dict)
    flows: tuple[str, ...] = tuple(FLOWS)
    retention_ms: int = RETENTION_MS

    def __post_init__(self) -> None:
        if len({suffix(w) for w in self.windows_ms}) < len(set(self.windows_ms)):
            raise ValueError("two windows share a column suffix")

    @property
    def width(self) -> int:
        return max([1, *(self.windows_ms if self.flows else ()), *self.trends_ms.values()])

    @property
    def columns(self) -> dict[str, str]:
        """Name and type of each feature; ``first{name}`` is the first price inside a trend's window."""
        flows = {f"{FLOWS[f][1]}{m}_{suffix(w)}": "bigint" if m.endswith("Count") else "double" for f in self.flows for w in sorted(set(self.windows_ms)) for m in FLOW}
        return flows | {f"{k}{n}": "double" for n in self.trends_ms for k in ("first", "vol")}

    def __call__(self, c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """The features at every row of one key (t, kind, price, qty, buy), sorted by time and sequence."""
        t, kind, price = c["t"], c["kind"], c["price"].astype(float)
        hi, out = frame_ends(t), {}
        for f in self.flows:
            code, prefix = FLOWS[f]
            own = kind == code
            qty = np.where(own, c["qty"].astype(float), 0.0)
            out |= flow_arrays(t, price, qty, own & (c["buy"] == 1), own & (c["buy"] == 0), sorted(set(self.windows_ms)), prefix)
        point = kind == PRICE
        places = np.append(np.flatnonzero(point), len(t))
        for name, w in self.trends_ms.items():
            lo = frame_starts(t, w)
            first = places[np.searchsorted(places, lo)]
            out[f"first{name}"] = np.where(first < hi, np.append(price, np.nan)[first], np.nan)
            out[f"vol{name}"] = _deviation({"price": price}, lo, point, 3)
        return out


def moves(tables: dict[str, DataFrame], flows: tuple[str, ...]) -> DataFrame:
    """Flow tables (symbol, t, seq, price, qty, side; rows of a positive quantity) and prices (symbol, t, seq, price) as one table."""
    side = F.when(F.col("side") == "BUY", 1).when(F.col("side") == "SELL", 0)
    parts = [tables[f].filter("qty > 0").select("symbol", "t", "seq", F.lit(FLOWS[f][0]).alias("kind"), F.col("price").cast("double").alias("price"), F.col("qty").cast("double").alias("qty"), F.coalesce(side, F.lit(-1)).alias("buy")) for f in flows]
    if "prices" in tables:
        parts.append(tables["prices"].filter("price IS NOT NULL").select("symbol", "t", "seq", F.lit(PRICE).alias("kind"), F.col("price").cast("double").alias("price"), F.lit(0.0).alias("qty"), F.lit(-1).alias("buy")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def trailing_at(ticks: DataFrame, tables: dict[str, DataFrame], what: Trailing) -> DataFrame:
    """symbol, t and all trailing features of each distinct tick: one exchange, one sort, one pass."""
    none = F.lit(None).cast("double")
    asked = ticks.select("symbol", "t").distinct().select("symbol", "t", F.lit(LATEST).cast("bigint").alias("seq"), F.lit(TICK).alias("kind"), none.alias("price"), F.lit(0.0).alias("qty"), F.lit(-1).alias("buy"))
    rows = bucketed(moves(tables, what.flows).unionByName(asked), what.width)
    adds = ", ".join(f"{n} {kind}" for n, kind in what.columns.items())
    got = framed(rows, what.width, what, ["t", "kind", "price", "qty", "buy"], adds, ["t", "seq", "price"])
    return got.filter(F.col("kind") == TICK).select("symbol", "t", *what.columns)
