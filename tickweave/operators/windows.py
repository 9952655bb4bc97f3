"""Trailing-window features: order flow, trend, volatility, 24-hour statistics, deltas. All frames are in event time and include both ends."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .framing import bucketed
from .streams import extremes, frame_ends, frame_starts, framed, sums

RETENTION_MS = 1_800_000
DAY_MS = 86_400_000
#: Frames whose deviation is worked out about one number.
STRETCH = 1024


def suffix(ms: int) -> str:
    return f"{int(ms / 1000 + 0.5)}s"


def flow_columns(w: W.WindowSpec | None, prefix: str, tail: str = "") -> dict[str, Column]:
    """The eight flow metrics, as window or (``w`` None) group aggregates over columns side, price, qty."""
    total = (lambda c: F.sum(c).over(w)) if w is not None else F.sum
    buy, sell = F.col("side") == "BUY", F.col("side") == "SELL"
    notional = F.col("price") * F.col("qty")
    some = lambda c: F.coalesce(total(c), F.lit(0.0))
    count = lambda c: F.coalesce(total(c.cast("int")), F.lit(0)).cast("bigint")
    bq, sq = some(F.when(buy, F.col("qty"))), some(F.when(sell, F.col("qty")))
    priced = some(F.when(notional.isNotNull(), F.col("qty")))
    return {
        f"{prefix}BuyQty{tail}": bq, f"{prefix}SellQty{tail}": sq, f"{prefix}BuyCount{tail}": count(buy), f"{prefix}SellCount{tail}": count(sell),
        f"{prefix}VWAP{tail}": F.when(priced > 0, some(notional) / priced), f"{prefix}BuySellRatio{tail}": F.when(sq > 0, bq / sq),
        f"{prefix}NetQty{tail}": bq - sq, f"{prefix}NetNotional{tail}": some(F.when(buy, notional)) - some(F.when(sell, notional)),
    }


FLOW = ("BuyQty", "SellQty", "BuyCount", "SellCount", "VWAP", "BuySellRatio", "NetQty", "NetNotional")


def flow_arrays(t: np.ndarray, price: np.ndarray, qty: np.ndarray, buy: np.ndarray, sell: np.ndarray, windows: list[int], prefix: str) -> dict[str, np.ndarray]:
    """The eight flow metrics of trailing windows at every row of one key in time order; rows of no quantity add nothing."""
    notional = price * qty
    parts = [np.where(buy, qty, 0), np.where(sell, qty, 0), buy.astype(float), sell.astype(float), notional, np.where(np.isnan(notional), 0, qty), np.where(buy, notional, 0), np.where(sell, notional, 0)]
    hi, out = frame_ends(t), {}
    for w in windows:
        lo = frame_starts(t, w)
        nb, ns = (np.rint(sums(x, lo, hi)).astype(np.int64) for x in parts[2:4])
        bq, sq = (np.where(n > 0, sums(x, lo, hi), 0.0) for n, x in ((nb, parts[0]), (ns, parts[1])))
        total, priced, bn, sn = (sums(x, lo, hi) for x in parts[4:])
        with np.errstate(divide="ignore", invalid="ignore"):
            values = (bq, sq, nb, ns, np.where(priced > 0, total / priced, np.nan), np.where(sq > 0, bq / sq, np.nan), bq - sq, bn - sn)
        out |= {f"{prefix}{m}_{suffix(w)}": v for m, v in zip(FLOW, values)}
    return out


def _flows(windows: list[int], prefix: str):
    return lambda c: flow_arrays(c["t"], c["price"].astype(float), c["qty"].astype(float), c["side"] == "BUY", c["side"] == "SELL", windows, prefix)


def rolling_flow(trades: DataFrame, windows_ms: list[int], prefix: str = "flow", bucket_ms: int | None = None) -> DataFrame:
    """Adds the flow metrics of every window to each trade (symbol, t, seq, price, qty, side; qty > 0). Windows that would share a suffix are refused."""
    windows = sorted(set(windows_ms))
    if len({suffix(w) for w in windows}) < len(windows):
        raise ValueError("two windows share a column suffix")
    rows = bucketed(trades.filter("qty > 0"), windows[-1], bucket_ms=bucket_ms)
    adds = ", ".join(f"{prefix}{m}_{suffix(w)} {'bigint' if m.endswith('Count') else 'double'}" for w in windows for m in FLOW)
    return framed(rows, windows[-1], _flows(windows, prefix), ["t", "price", "qty", "side"], adds, ["t"])


def _near_zero(change: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Sample variances of ``change[lo:hi]`` (two numbers or more, NaN left out) where they are small against the squares: 0 where all are equal, else from sums about a number of each stretch of frames."""
    known = np.flatnonzero(~np.isnan(change))
    x = change[known]
    lo, hi = np.searchsorted(known, lo), np.searchsorted(known, hi)
    turns = np.concatenate([[0], np.cumsum(x[1:] != x[:-1])])
    out = np.zeros(len(lo))
    rest = np.flatnonzero(turns[hi - 1] != turns[lo])
    for k in range(0, len(rest), STRETCH):
        part = rest[k : k + STRETCH]
        a, b = lo[part].min(), hi[part].max()
        y = x[a:b] - np.median(x[a:b])
        n = hi[part] - lo[part]
        total, square = (sums(v, lo[part] - a, hi[part] - a) for v in (y, y * y))
        var = (square - total * total / n) / (n - 1)
        for j in np.flatnonzero(var < 1e-6 * square / n):  # still far from its stretch
            var[j] = np.var(x[lo[part[j]] : hi[part[j]]], ddof=1)
        out[part] = var
    return out


def _deviation(c: dict[str, np.ndarray], lo: np.ndarray, point: np.ndarray, least_prices: int, hi: np.ndarray | None = None) -> np.ndarray:
    """Sample deviation of percent changes between neighbouring points, for each row over the points from place ``lo`` up to the row itself, or to the place before ``hi``."""
    price = c["price"][point].astype(float)
    upto = np.cumsum(point)  # points up to each row
    first = np.concatenate([[0], upto])[lo]
    upto = upto if hi is None else upto[hi - 1]
    with np.errstate(divide="ignore", invalid="ignore"):
        change = np.where((price[1:] > 0) & (price[:-1] > 0), (price[1:] - price[:-1]) / price[:-1] * 100, np.nan)
    change = np.concatenate([[np.nan], change]) if len(price) else np.zeros(0)
    known = ~np.isnan(change)
    shift = float(change[known].mean()) if known.any() else 0.0
    start = np.minimum(first + 1, upto)  # a change belongs to its later point
    inside = lambda x: sums(x, start, upto)
    n = np.rint(inside(known.astype(float))).astype(int)
    total, square = inside(change - shift), inside((change - shift) ** 2)
    with np.errstate(divide="ignore", invalid="ignore"):
        var = (square - total * total / n) / (n - 1)
        near = np.flatnonzero((n > 1) & (var < 1e-6 * np.maximum(square / n, 1e-6)))  # too small against the sums to trust the difference
    var[near] = _near_zero(change, start[near], upto[near])
    return np.where((n >= 3) & (upto - first >= least_prices), np.sqrt(np.maximum(var, 0)), np.nan)


def trend_vol(prices: DataFrame, windows_ms: dict[str, int], least_prices: int = 3, retention_ms: int = RETENTION_MS, peers: bool = False) -> DataFrame:
    """Adds ``trend{name}`` and ``vol{name}`` to each price (symbol, t, seq, price).

    Trend: percent change from the first price of the window (start not positive: null). Volatility: sample deviation of percent changes between neighbouring prices inside the window, pairs with
    a price that is not positive left out; null below three changes or ``least_prices`` prices.
    A row's window ends with the row itself in (t, seq) order; with ``peers`` all prices of its time are inside.
    """
    width = max([retention_ms, *windows_ms.values()])

    def compute(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        t, price, out = c["t"], c["price"].astype(float), {}
        for name, w in windows_ms.items():
            lo = frame_starts(t, w)
            start = price[lo]
            with np.errstate(divide="ignore", invalid="ignore"):
                trend = np.where(start > 0, (price - start) / start * 100, np.nan)
            out |= {f"vol{name}": _deviation(c, lo, np.ones(len(t), bool), least_prices, frame_ends(t) if peers else None), f"trend{name}": trend}
        return out

    return framed(bucketed(prices, width), width, compute, ["t", "price"], ", ".join(f"vol{n} double, trend{n} double" for n in windows_ms), ["t", "seq", "price"])


def vol_at(ticks: DataFrame, prices: DataFrame, name: str, window_ms: int, least_prices: int = 3) -> DataFrame:
    """``vol{name}`` at arbitrary times (symbol, t): ticks enter the price stream as rows without a price."""
    marked = prices.filter("price IS NOT NULL").select("symbol", "t", "seq", "price", F.lit(False).alias("_tick"))
    asked = ticks.select("symbol", "t").distinct().select("symbol", "t", F.lit(2**62).cast("bigint").alias("seq"), F.lit(None).cast("double").alias("price"), F.lit(True).alias("_tick"))

    def compute(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        return {f"vol{name}": _deviation(c, frame_starts(c["t"], window_ms), ~c["_tick"].astype(bool), least_prices)}

    rows = framed(bucketed(marked.unionByName(asked), window_ms), window_ms, compute, ["t", "price", "_tick"], f"vol{name} double", ["t", "seq", "price"])
    return rows.filter("_tick").select("symbol", "t", f"vol{name}")


def with_oldest(prices: DataFrame, retention_ms: int = RETENTION_MS) -> DataFrame:
    """Prices (symbol, t, seq, price) with the oldest price retained at each, ``_old``."""
    rows = bucketed(prices.select("symbol", "t", "seq", F.col("price").cast("double").alias("price")), retention_ms)
    return framed(rows, retention_ms, lambda c: {"_old": c["price"].astype(float)[frame_starts(c["t"], retention_ms)]}, ["t", "price"], "_old double", ["t", "seq", "price"])


def trend_at(ticks: DataFrame, prices: DataFrame, name: str, window_ms: int, retention_ms: int = RETENTION_MS, fallback: bool = True) -> DataFrame:
    """Trend at arbitrary times (symbol, t): current price against the first one in the window; when all are older, against the oldest retained by the last event, or (``fallback`` false) null."""
    from .asof import asof_backward

    got = asof_backward(ticks, with_oldest(prices, retention_ms), ["price", "_old", "t"], prefix="_c_")
    marks = prices.select("symbol", F.col("t").alias("_pt"), "seq", F.col("price").alias("_pp"))
    got = got.withColumn("_from", F.col("t") - window_ms)
    neg = marks.withColumns({"_nt": -F.col("_pt"), "_ns": -F.col("seq")})
    with_first = asof_backward(got.withColumn("_nf", -F.col("_from")), neg, ["_pp", "_pt"], t="_nf", right_t="_nt", seq="_ns", prefix="_f")
    inside = F.col("_f_pt") <= F.col("t")
    start = F.when(inside, F.col("_f_pp")).otherwise(F.col("_c__old") if fallback else F.lit(None))
    return with_first.withColumn(f"trend{name}", F.when(start > 0, (F.col("_c_price") - start) / start * 100)).drop("_c_price", "_c__old", "_c_t", "_from", "_nf", "_f_pp", "_f_pt")


def day_stats(bars: DataFrame, t: str = "t", day_ms: int = DAY_MS) -> DataFrame:
    """Adds changePct24h, high24h, low24h, volume24h, quoteVolume24h to bars (symbol, t, high, low, close, volume, quoteVolume); a sum of zero is null. Bars of one time stand in the order of their ``seq``, where they have one."""

    def compute(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        at, close, volume = c[t], c["close"].astype(float), c["volume"].astype(float)
        lo, hi = frame_starts(at, day_ms), frame_ends(at)
        first = close[lo]
        quote = np.where(np.isnan(c["quoteVolume"].astype(float)), close * volume, c["quoteVolume"].astype(float))
        totals = [np.where(np.abs(v) > 1e-9, v, np.nan) for v in (sums(volume, lo, hi), sums(quote, lo, hi))]
        with np.errstate(divide="ignore", invalid="ignore"):
            change = np.where(first != 0, (close - first) / first * 100, np.nan)
        return {"changePct24h": change, "high24h": extremes(c["high"].astype(float), lo, hi, np.fmax), "low24h": extremes(c["low"].astype(float), lo, hi, np.fmin), "volume24h": totals[0], "quoteVolume24h": totals[1]}

    adds = ", ".join(f"{n} double" for n in ("changePct24h", "high24h", "low24h", "volume24h", "quoteVolume24h"))
    return framed(bucketed(bars, day_ms, t), day_ms, compute, [t, "high", "low", "close", "volume", "quoteVolume"], adds, [t, *(["seq"] if "seq" in bars.columns else []), "close"], t=t)


def deltas(snapshots: DataFrame, names: list[str], by: list[str] = ["symbol"], t: str = "t", seq: str = "seq", exclude_age: bool = True, bucket_ms: int = DAY_MS) -> DataFrame:  # noqa: B006
    """Adds ``{name}Delta``: difference from the previous snapshot of the key where both are finite. With ``exclude_age`` the deltas of ages and completeness are null."""
    order = [t, seq] if seq in snapshots.columns else [t]
    rows = snapshots.withColumn("_bucket", F.floor(F.col(t) / F.lit(bucket_ms)).cast("bigint")).repartition(*by, "_bucket")
    inside = W.Window.partitionBy(*by, "_bucket").orderBy(*order)
    here = F.struct(*[F.col(n).cast("double").alias(n) for n in names])
    rows = rows.withColumn("_prev", F.lag(here).over(inside))
    ends = rows.groupBy(*by, "_bucket").agg(F.max(F.struct(*order, here.alias("v"))).alias("_end"))
    ends = ends.select(*by, "_bucket", F.lag("_end.v").over(W.Window.partitionBy(*by).orderBy("_bucket")).alias("_before"))
    rows = rows.join(ends, [*by, "_bucket"]).withColumn("_prev", F.coalesce("_prev", "_before"))
    dropped = [n for n in names if exclude_age and (n.endswith("AgeMs") or n.endswith("Completeness"))]
    return rows.withColumns({f"{n}Delta": F.lit(None).cast("double") if n in dropped else F.col(n).cast("double") - F.col(f"_prev.{n}") for n in names}).drop("_bucket", "_prev", "_before")
