"""Market arithmetic on columns; every division is guarded, so a zero denominator gives null."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

FUNDING_PERIOD_MS = 8 * 3_600_000


def over(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def age_ms(now: Column, then: Column) -> Column:
    return F.when(then.isNotNull(), F.greatest(F.lit(0).cast("bigint"), now - then))


def spread_pct(bid: Column, ask: Column) -> Column:
    return over(ask - bid, (ask + bid) / 2) * 100


def imbalance(bid_qty: Column, ask_qty: Column) -> Column:
    return over(bid_qty - ask_qty, bid_qty + ask_qty)


def basis_pct(mark: Column, index: Column) -> Column:
    return over(mark - index, index) * 100


def mid_price(bid: Column, ask: Column) -> Column:
    return F.coalesce((bid + ask) / 2, bid)


def pick_price(value: Column, fallback: Column) -> Column:
    return F.when(value > 0, value).otherwise(fallback)


def first_finite(columns: Iterable[Column]) -> Column:
    from .coerce import finite

    return F.coalesce(*[finite(c) for c in columns])


def completeness(columns: Iterable[Column]) -> Column:
    """Share of the columns that hold a boolean or a finite number (columns are cleaned: null means absent)."""
    cols = list(columns)
    return sum((c.isNotNull().cast("int") for c in cols), F.lit(0)) / F.lit(float(len(cols))) if cols else F.lit(0.0)


def execution_returns(entry_bid: Column, entry_ask: Column, exit_bid: Column, exit_ask: Column, entry: Column, exit_: Column, cost: float) -> dict[str, Column]:
    """Returns in percent: mid to mid, and long and short with prices crossed and ``cost`` a side; a missing or non-positive quote falls back to the price."""
    up, down = F.lit(1 + cost), F.lit(1 - cost)
    buy, sell = pick_price(entry_ask, entry) * up, pick_price(exit_bid, exit_) * down
    short_in, short_out = pick_price(entry_bid, entry) * down, pick_price(exit_ask, exit_) * up
    return {"midReturnPct": over(exit_ - entry, entry) * 100, "longReturnPct": over(sell - buy, buy) * 100, "shortReturnPct": over(short_in - short_out, short_in) * 100}


def funding_adjust_pct(rate: Column, horizon_ms: Column, period_ms: int = FUNDING_PERIOD_MS) -> Column:
    return F.coalesce(rate, F.lit(0.0)) * horizon_ms / F.lit(float(period_ms)) * 100


def barriers(entry: Column, tp_bps: float, sl_bps: float, side: str) -> tuple[Column, Column]:
    """(take-profit, stop-loss) prices."""
    s = 1 if side == "long" else -1
    return entry * (1 + s * tp_bps / 1e4), entry * (1 - s * sl_bps / 1e4)


def select_return(action: Column, long_return: Column, short_return: Column, plain: Column) -> Column:
    return F.when(action == "long", F.coalesce(long_return, plain)).otherwise(F.coalesce(short_return, -plain))
