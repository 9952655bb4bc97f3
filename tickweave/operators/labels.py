"""Forward-return and triple-barrier labels."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import snapshot_id
from ..functions.market import execution_returns, funding_adjust_pct, pick_price
from .asof import asof_forward


#: What labels hold besides their keys and what a snapshot holds too (``fundingRate``): known only after entry, or settings.
RETURN_LABEL_COLUMNS = (
    "entryPrice", "targetTime", "actualTargetTime", "lagMs", "maxLagMs", "entryBid", "entryAsk", "targetBid", "targetAsk", "targetPrice", "horizonMs", "horizonMin", "feeBps", "slippageBps", "costBpsPerSide",
    "fundingAdjPct", "midReturnPct", "longReturnPct", "shortReturnPct", "returnPct",
)
BARRIER_LABEL_COLUMNS = ("entryPrice", "horizonMs", "tpBps", "slBps", "labelLong", "exitTimeLong", "exitPriceLong", "labelShort", "exitTimeShort", "exitPriceShort")


def return_labels(snapshots: DataFrame, horizons_ms: list[int], max_lag_pct: float = 0.10, fee_bps: float = 4.0, slippage_bps: float = 2.0, require_bbo: bool = False, use_funding: bool = True) -> DataFrame:
    """For every snapshot (symbol, t, seq, price, bestBid, bestAsk, fundingRate) and horizon: the first snapshot at or after t + horizon, unless it lags by more
    than ``int(horizon * max_lag_pct)``, and the returns between the two. Prices must be positive at both ends; ``require_bbo`` asks for both quotes at both ends."""
    cost = max(0.0, fee_bps + slippage_bps) / 1e4
    share = max(0.0, max_lag_pct)
    need = [F.col(c) if c in snapshots.columns else F.lit(None).cast("double").alias(c) for c in ("bestBid", "bestAsk", "fundingRate")]
    s = snapshots.select("symbol", "t", "seq", "price", *need).filter("symbol IS NOT NULL AND t IS NOT NULL AND price IS NOT NULL")
    plan = F.explode(F.array(*[F.struct(F.lit(h).cast("bigint").alias("h"), F.lit(int(h * share)).cast("bigint").alias("lag")) for h in sorted(set(horizons_ms))]))
    left = s.withColumn("_h", plan).select("*", F.col("_h.h").alias("horizonMs"), F.col("_h.lag").alias("maxLagMs"), (F.col("t") + F.col("_h.h")).alias("targetTime")).drop("_h")
    got = asof_forward(left, s, ["price", "bestBid", "bestAsk"], t="targetTime", max_lag="maxLagMs", prefix="x_")
    got = got.filter("price > 0 AND x_price > 0")
    if require_bbo:
        got = got.filter("bestBid IS NOT NULL AND bestAsk IS NOT NULL AND x_bestBid IS NOT NULL AND x_bestAsk IS NOT NULL")
    c = F.col
    returns = execution_returns(c("bestBid"), c("bestAsk"), c("x_bestBid"), c("x_bestAsk"), c("price"), c("x_price"), cost)
    fund = funding_adjust_pct(c("fundingRate"), c("horizonMs")) if use_funding else F.lit(0.0)
    used = lambda q, p: pick_price(c(q), c(p))
    return got.select(
        F.lit("return").alias("type"), "symbol", c("t").alias("entryTime"), "seq", c("price").alias("entryPrice"), "targetTime", c("x_t_found").alias("actualTargetTime"), "lagMs", "maxLagMs",
        used("bestBid", "price").alias("entryBid"), used("bestAsk", "price").alias("entryAsk"), used("x_bestBid", "x_price").alias("targetBid"), used("x_bestAsk", "x_price").alias("targetAsk"), c("x_price").alias("targetPrice"),
        "horizonMs", (c("horizonMs") / 60_000).alias("horizonMin"), F.lit(float(fee_bps)).alias("feeBps"), F.lit(float(slippage_bps)).alias("slippageBps"), F.lit(max(0.0, float(fee_bps + slippage_bps))).alias("costBpsPerSide"),
        "fundingRate", fund.alias("fundingAdjPct"), returns["midReturnPct"].alias("midReturnPct"), (returns["longReturnPct"] - fund).alias("longReturnPct"), (returns["shortReturnPct"] + fund).alias("shortReturnPct"),
        returns["midReturnPct"].alias("returnPct"), snapshot_id(c("symbol"), c("t")).alias("snapshotId"),
    )


def first_at_least(x: np.ndarray, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Place of the first ``x`` from ``start`` on that reaches ``bound``; the length of ``x`` if none does."""
    levels, k = [x], 1
    while 2 * k <= len(x):
        levels.append(np.maximum(levels[-1][:-k], levels[-1][k:]))
        k *= 2
    at = start.copy()
    for n in range(len(levels) - 1, -1, -1):  # step over runs that stay below, the longest first
        row = levels[n]
        for _ in range(2 if n == len(levels) - 1 else 1):
            inside = np.flatnonzero(at < len(row))
            below = inside[row[at[inside]] < bound[inside]]
            at[below] += 1 << n
    return np.minimum(at, len(x))


def _first_touches(horizon_ms: int, tp_bps: float, sl_bps: float, sides: tuple[str, ...]):
    def run(entries: pa.Table, ticks: pa.Table) -> pa.Table:
        out = entries.drop_columns(["_b"])
        ticks = ticks.sort_by([("_t", "ascending"), ("_s", "ascending"), ("_p", "ascending")])
        t, p = ticks.column("_t").to_numpy(), ticks.column("_p").to_numpy()
        entry, price = entries.column("entryTime").to_numpy(), entries.column("entryPrice").to_numpy()
        start, end = np.searchsorted(t, entry, "left"), np.searchsorted(t, entry + horizon_ms, "right")
        for side in sides:
            up, down = (tp_bps, sl_bps) if side == "long" else (sl_bps, tp_bps)
            high, low = price * (1 + up / 1e4), price * (1 - down / 1e4)
            at = np.minimum(first_at_least(p, start, high), first_at_least(-p, start, -low))
            hit = at < end
            safe = np.minimum(at, max(0, len(t) - 1))
            found_t, found_p = (t[safe], p[safe]) if len(t) else (np.zeros(len(entry), np.int64), np.zeros(len(entry)))
            won = found_p >= high if side == "long" else found_p <= low
            out = out.append_column(f"hit{side}", pa.array(np.where(won, "TP", "SL").astype(object), pa.string(), mask=~hit))
            out = out.append_column(f"t{side}", pa.array(found_t, pa.int64(), mask=~hit)).append_column(f"p{side}", pa.array(found_p, pa.float64(), mask=~hit))
        return out

    return run


def barrier_labels(entries: DataFrame, ticks: DataFrame, horizon_ms: int = 30_000, tp_bps: float = 12.0, sl_bps: float = 8.0, sides: tuple[str, ...] = ("long", "short")) -> DataFrame:
    """For every entry (symbol, t, seq, price): whether the take-profit or the stop-loss price is touched first by a tick with t <= time <= t + horizon, else TIME.

    Entries and ticks are dealt by (symbol, time bucket of eight horizons), ticks of the first horizon of a bucket also to the bucket before. In a bucket the first crossing of every entry is found at once
    by descending a table of extremes over runs of powers of two, so work does not grow with the ticks in a horizon. A tick that crosses both
    counts as take-profit. The exit price of TIME is the entry price. Entries of symbols without ticks get TIME as well.
    """
    e = entries.filter("symbol IS NOT NULL AND t IS NOT NULL AND price > 0").select("symbol", F.col("t").alias("entryTime"), F.col("seq").alias("entrySeq"), F.col("price").cast("double").alias("entryPrice"))
    size = 8 * max(1, horizon_ms)
    bucket = lambda c: F.floor(c / F.lit(size)).cast("bigint")
    x = ticks.filter("t IS NOT NULL AND price IS NOT NULL").select("symbol", F.col("t").alias("_t"), F.col("seq").cast("bigint").alias("_s"), F.col("price").cast("double").alias("_p"))
    x = x.withColumn("_b", F.explode(F.array_distinct(F.array(bucket(F.col("_t")), bucket(F.col("_t") - F.lit(horizon_ms))))))
    left = e.withColumn("_b", bucket(F.col("entryTime")))
    touched = "".join(f", hit{s} string, t{s} bigint, p{s} double" for s in sides)
    out = left.groupBy("symbol", "_b").cogroup(x.groupBy("symbol", "_b")).applyInArrow(_first_touches(horizon_ms, tp_bps, sl_bps, sides), "symbol string, entryTime bigint, entrySeq bigint, entryPrice double" + touched)
    named = []
    for side in sides:
        s = side.capitalize()
        named += [F.coalesce(f"hit{side}", F.lit("TIME")).alias(f"label{s}"), F.coalesce(F.col(f"t{side}"), F.col("entryTime") + F.lit(horizon_ms)).alias(f"exitTime{s}"), F.coalesce(f"p{side}", "entryPrice").alias(f"exitPrice{s}")]
    return out.select(F.lit("barrier").alias("type"), "symbol", "entryTime", "entrySeq", F.lit(horizon_ms).cast("bigint").alias("horizonMs"), "entryPrice", F.lit(float(tp_bps)).alias("tpBps"), F.lit(float(sl_bps)).alias("slBps"), snapshot_id(F.col("symbol"), F.col("entryTime")).alias("snapshotId"), *named)


def latest_labels(labels: DataFrame, horizon_ms: int | None = None, keys: tuple[str, ...] = ("symbol", "entryTime"), order: str = "seq") -> DataFrame:
    """One label a key: the last one written (largest ``order``)."""
    rows = labels if horizon_ms is None else labels.filter(F.col("horizonMs") == F.lit(horizon_ms))
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max(F.struct(order, *[c for c in rest if c != order])).alias("_l")).select(*keys, "_l.*")
