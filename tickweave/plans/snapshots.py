"""Wide feature snapshots on a time grid, from typed event tables (batch form of the live assembly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.market import basis_pct, completeness, imbalance, spread_pct
from ..operators.asof import Side, asof_many
from ..operators.ticks import FLOWS, Trailing, trailing_at
from ..operators.windows import FLOW, deltas, rolling_flow, suffix, with_oldest

#: The keys that make up the two completeness ratios.
COMPLETENESS_KEYS = (
    "markPrice", "indexPrice", "fundingRate", "openInterest", "bestBid", "bestAsk", "spreadPct", "imbalance", "depthBidQty",
    "depthAskQty", "depthImbalance", "basisPct", "changePct24h", "volume24h", "quoteVolume24h", "kline1mClose", "kline1mVol", "kline5mClose",
    "kline5mVol", "trend5m", "trend15m", "vol5m", "vol15m", "aggBuyQty", "aggSellQty", "liqBuyQty", "liqSellQty",
)
MICRO_KEYS = (
    "bestBid", "bestAsk", "spreadPct", "imbalance", "depthBidQty", "depthAskQty", "depthImbalance", "aggBuyQty", "aggSellQty",
    "aggBuyCount", "aggSellCount", "liqBuyQty", "liqSellQty", "liqBuyCount", "liqSellCount",
)


def tick_grid(universe: DataFrame, start_ms: int, end_ms: int, step_ms: int) -> DataFrame:
    """symbol, t: a row per symbol and tick."""
    return universe.select("symbol").distinct().withColumn("t", F.explode(F.sequence(F.lit(start_ms).cast("bigint"), F.lit(end_ms).cast("bigint"), F.lit(step_ms).cast("bigint"))))


def latest_value(ticks: DataFrame, side: DataFrame, columns: dict[str, str], age: str | None = None) -> DataFrame:
    """Ticks with the latest value of some columns of a side table (old name: new name), without a limit of age; null where the side has none."""
    return asof_many(ticks, [Side(side, columns, age=age)])


def flow_at(ticks: DataFrame, trades: DataFrame, windows_ms: list[int], prefix: str = "flow") -> DataFrame:
    """symbol, t and the flow metrics of the windows that end at each tick: the tick enters the trade stream as a row without quantity."""
    marked = trades.filter("qty > 0").select("symbol", "t", "seq", "price", "qty", "side", F.lit(False).alias("_tick"))
    asked = ticks.select("symbol", "t").distinct().select("symbol", "t", F.lit(2**62).cast("bigint").alias("seq"), F.lit(None).cast("double").alias("price"), F.lit(1e-300).alias("qty"), F.lit("TICK").alias("side"), F.lit(True).alias("_tick"))
    got = rolling_flow(marked.unionByName(asked), windows_ms, prefix).filter("_tick")
    names = [c for c in got.columns if c.startswith(prefix) and any(c.endswith("_" + suffix(w)) for w in windows_ms)]
    return got.select("symbol", "t", *names)


#: The tables of a snapshot: their columns (own name: name in the snapshot) and the name of their age.
SIDES = {
    "mark": ({c: c for c in ("markPrice", "indexPrice", "fundingRate", "nextFundingTime")}, "markAgeMs"), "book": ({c: c for c in ("bestBid", "bestAsk", "bidQty", "askQty")}, "bookAgeMs"),
    "openInterest": ({"openInterest": "openInterest"}, "openInterestAgeMs"), "stats24h": ({c: c for c in ("last", "changePct24h", "high24h", "low24h", "volume24h", "quoteVolume24h")}, "stats24hAgeMs"),
    "kline1m": ({"close": "kline1mClose", "volume": "kline1mVol"}, "kline1mAgeMs"), "kline5m": ({"close": "kline5mClose", "volume": "kline5mVol"}, "kline5mAgeMs"),
    "depth": ({c: c for c in ("depthBidQty", "depthAskQty", "depthImbalance")}, "depthAgeMs"), "trades": ({}, "flowAgeMs"), "liquidations": ({}, "liqAgeMs"),
}


PRICES = ("markPrice", "bestBid", "bestAsk", "last", "kline1mClose", "kline5mClose")
SHORT = {"trades": "agg", "liquidations": "liq"}


def derived(rows: DataFrame, windows_ms: list[int], default_window_ms: int | None = None, prefix: str = "") -> DataFrame:
    """Raw columns of snapshots (each name after ``prefix``) with all that follows from them: price, spread, imbalance, basis, default flows, completeness."""
    c = lambda n: F.col(prefix + n)
    out = rows.withColumns({
        prefix + "price": F.coalesce(*[c(n) for n in PRICES]).cast("double"), prefix + "spreadPct": spread_pct(c("bestBid"), c("bestAsk")), prefix + "imbalance": imbalance(c("bidQty"), c("askQty")),
        prefix + "basisPct": basis_pct(c("markPrice"), c("indexPrice")),
    })
    tail = "_" + suffix(default_window_ms or windows_ms[0])
    out = out.withColumns({f"{prefix}{SHORT[f]}{m}": c(f"{FLOWS[f][1]}{m}{tail}") for f in FLOWS for m in FLOW})
    have = {n.removeprefix(prefix) for n in out.columns if n.startswith(prefix)}
    out = out.withColumns({prefix + n: completeness([c(k) if k in have else F.lit(None) for k in keys]) for n, keys in (("featureCompleteness", COMPLETENESS_KEYS), ("microCompleteness", MICRO_KEYS))})
    return out.drop(*[prefix + n for n in ("last", "bidQty", "askQty")])


def trend(name: str, last: Column, old: Column) -> Column:
    """Percent change to the last price from the first one inside the window, or else from the oldest that was retained with the last one."""
    start = F.coalesce(F.col(f"first{name}"), old)
    return F.when(start > 0, (last - start) / start * 100)


def build_snapshots(ticks: DataFrame, tables: dict[str, DataFrame], windows_ms: list[int], trends_ms: dict[str, int], default_window_ms: int | None = None, context: list[str] | None = None, context_ms: dict[str, int] | None = None) -> DataFrame:
    """Snapshots at the ticks from the tables given: book, mark, openInterest, stats24h, kline1m, kline5m, depth, trades, liquidations, prices.

    ``context``: symbols whose latest price, trend and volatility (windows ``context_ms``) every snapshot gets, from ``prices``. Columns of tables that are not given are null.

    Latest values come from one as-of pass over all tables, trailing features from one pass over all moves, context from the same two over its symbols; then one join for each, and the deltas.
    """
    known = {n: v for n, v in SIDES.items() if n in tables}
    looked = [Side(tables[n].filter("qty > 0") if n in FLOWS else tables[n], columns, age=age) for n, (columns, age) in known.items()]
    if "prices" in tables:
        looked.append(Side(with_oldest(tables["prices"].filter("price IS NOT NULL")), {"price": "_last", "_old": "_old"}))
    out = asof_many(ticks, looked)
    what = Trailing(tuple(windows_ms), trends_ms if "prices" in tables else {}, tuple(f for f in FLOWS if f in tables))
    if what.columns:
        out = out.join(trailing_at(ticks, tables, what), ["symbol", "t"])
    for name in what.trends_ms:
        out = out.withColumn(f"trend{name}", trend(name, F.col("_last"), F.col("_old"))).drop(f"first{name}")
    if "prices" in tables and context:
        out = out.join(_context(ticks, tables["prices"], context, context_ms or {}), "t", "left")
    whole = Trailing(tuple(windows_ms), trends_ms)
    missing = {c: "double" for columns, _ in SIDES.values() for c in columns.values()} | {age: "bigint" for _, age in SIDES.values()} | {c: kind for c, kind in whole.columns.items() if not c.startswith("first")} | {f"trend{n}": "double" for n in trends_ms}
    out = out.drop("_last", "_old").withColumns({c: F.lit(None).cast(kind) for c, kind in missing.items() if c not in out.columns})
    out = derived(out, windows_ms, default_window_ms).filter("price IS NOT NULL")
    return deltas(out, delta_names(out))


def delta_names(rows: DataFrame) -> list[str]:
    return [c for c, kind in rows.dtypes if kind in ("double", "bigint", "int") and c != "t"]


def _context(ticks: DataFrame, prices: DataFrame, symbols: list[str], windows_ms: dict[str, int]) -> DataFrame:
    """t, and the latest price, trends and volatilities of the context symbols at each distinct time."""
    own = prices.filter(F.col("symbol").isin(symbols) & F.col("price").isNotNull())
    at = ticks.select("t").distinct().withColumn("symbol", F.explode(F.array(*[F.lit(s) for s in symbols])))
    rows = asof_many(at, [Side(with_oldest(own), {"price": "price", "_old": "_old"})])
    if windows_ms:
        rows = rows.join(trailing_at(at, {"prices": own}, Trailing((), windows_ms, ())), ["symbol", "t"])
    shown = {"price": F.col("price")} | {f"{k}_{n}": v for n in windows_ms for k, v in (("trend", trend(n, F.col("price"), F.col("_old"))), ("vol", F.col(f"vol{n}")))}
    return rows.groupBy("t").agg(*[F.max(F.when(F.col("symbol") == s, v)).alias(f"ctx_{s}_{n}") for s in symbols for n, v in shown.items()])


def nested(snapshots: DataFrame, source: str | None = None) -> DataFrame:
    """The nested row form: type, [source,] symbol, time, price, features."""
    names = [c for c in snapshots.columns if c not in ("symbol", "t", "price")]
    cols = [F.lit("snapshot").alias("type")] + ([F.lit(source).alias("source")] if source else [])
    return snapshots.select(*cols, "symbol", F.col("t").alias("time"), "price", F.struct(*names).alias("features"))


