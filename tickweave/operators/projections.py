"""Typed projections of raw feed events, one function an event type, and the price series they make together. Payloads are maps of strings, as the event reader gives them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import safe_int, safe_num_js
from ..functions.market import first_finite, mid_price


def event_time(*candidates: Column, now: Column) -> Column:
    """First candidate that is neither null nor zero, else ``now``."""
    return F.coalesce(*[F.nullif(safe_int(c), F.lit(0).cast("bigint")) for c in candidates], now)


def _num(path: str) -> Column:
    return safe_num_js(F.col(path))


def tracked(events: DataFrame, universe: DataFrame | None, symbol: str = "symbol") -> DataFrame:
    return events if universe is None else events.join(universe.select(F.col("symbol").alias(symbol)).distinct(), symbol, "left_semi")


def ticker(events: DataFrame, now: Column, universe: DataFrame | None = None) -> DataFrame:
    """24-hour ticker: symbol, t, last, changePct24h, high24h, low24h, volume24h, quoteVolume24h."""
    d = events.filter("type = '24hrTicker'")
    out = d.select(F.col("data.s").alias("symbol"), event_time(F.col("data.E"), now=now).alias("t"), _num("data.c").alias("last"), _num("data.P").alias("changePct24h"), _num("data.h").alias("high24h"), _num("data.l").alias("low24h"), _num("data.v").alias("volume24h"), _num("data.q").alias("quoteVolume24h"))
    return tracked(out, universe)


def book_ticker(events: DataFrame, now: Column, universe: DataFrame | None = None) -> DataFrame:
    d = events.filter("type = 'bookTicker'")
    out = d.select(F.col("data.s").alias("symbol"), event_time(F.col("data.E"), F.col("data.T"), now=now).alias("t"), _num("data.b").alias("bestBid"), _num("data.B").alias("bidQty"), _num("data.a").alias("bestAsk"), _num("data.A").alias("askQty"))
    return tracked(out.withColumn("price", mid_price(F.col("bestBid"), F.col("bestAsk"))), universe)


def agg_trade(events: DataFrame, now: Column, universe: DataFrame | None = None) -> DataFrame:
    """Trades with a positive quantity; the buyer being the maker makes it a sell."""
    d = events.filter("type = 'aggTrade'")
    out = d.select(F.col("data.s").alias("symbol"), event_time(F.col("data.T"), F.col("data.E"), now=now).alias("t"), _num("data.p").alias("price"), _num("data.q").alias("qty"), F.when(F.col("data.m") == "true", "SELL").otherwise("BUY").alias("side"))
    return tracked(out.filter("qty > 0"), universe)


def force_order(events: DataFrame, now: Column, universe: DataFrame | None = None) -> DataFrame:
    """Liquidations: the first non-empty of several quantity and price fields (a "0" string counts as given); anything but BUY is a sell."""
    d = events.filter("type = 'forceOrder'")
    d = d.select("data.E", F.from_json("data.o", "map<string,string>").alias("o"))
    given = lambda *names: safe_num_js(F.coalesce(*[F.nullif(F.col(f"o.{n}"), F.lit("")) for n in names]))
    out = d.select(F.col("o.s").alias("symbol"), event_time(F.col("o.T"), F.col("E"), now=now).alias("t"), given("p", "ap", "P").alias("price"), given("q", "l", "Q").alias("qty"), F.when(F.col("o.S") == "BUY", "BUY").otherwise("SELL").alias("side"))
    return tracked(out.filter("qty > 0"), universe)


def mark_price(events: DataFrame, now: Column, universe: DataFrame | None = None) -> DataFrame:
    d = events.filter("type = 'markPriceUpdate'")
    out = d.select(F.col("data.s").alias("symbol"), event_time(F.col("data.E"), now=now).alias("t"), _num("data.p").alias("markPrice"), _num("data.i").alias("indexPrice"), _num("data.r").alias("fundingRate"), safe_int(F.col("data.T")).alias("nextFundingTime"))
    return tracked(out, universe)


def kline(events: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """Bars of the live feed; the time is the bar's close, in the future while it is open."""
    d, k = events.filter("type = 'kline'").select(F.from_json("data.k", "map<string,string>").alias("k")), lambda c: F.col(f"k.{c}")
    out = d.select(k("s").alias("symbol"), k("i").alias("interval"), safe_int(k("T")).alias("t"), *[_num(f"k.{c}").alias(n) for c, n in zip("ohlcv", ("open", "high", "low", "close", "volume"))], safe_int(k("n")).alias("trades"), (k("x") == "true").alias("isFinal"))
    return tracked(out, universe)


def price_series(parts: dict[str, DataFrame]) -> DataFrame:
    """symbol, t, price, source from the projections given: ticker, book, trade, mark, kline (final bars only)."""
    column = {"ticker": "last", "book": "price", "trade": "price", "mark": "markPrice", "kline": "close"}
    out = None
    for name, df in parts.items():
        df = df.filter("isFinal") if name == "kline" else df
        p = df.select("symbol", "t", F.col(column[name]).alias("price"), F.lit(name).alias("source")).filter("price IS NOT NULL")
        out = p if out is None else out.unionByName(p)
    return out


def snapshot_price(df: DataFrame, names: tuple[str, ...] = ("markPrice", "bestBid", "bestAsk", "last", "kline1mClose", "kline5mClose")) -> DataFrame:
    """Adds ``price``, the first finite of the columns; rows without one are dropped."""
    return df.withColumn("price", first_finite([F.col(n) for n in names if n in df.columns])).filter("price IS NOT NULL")


def route(lines: DataFrame, line: str = "value") -> DataFrame:
    """Dispatch of raw feed messages (JSON text): arrays become one row an element, a stream envelope is opened, and ``type`` is the field ``e``; broken lines are dropped. Columns type, data."""
    text = F.trim(line)
    parts = F.when(text.startswith("["), F.from_json(text, "array<map<string,string>>")).otherwise(F.array(F.from_json(text, "map<string,string>")))
    rows = lines.select(F.explode(parts).alias("m")).filter("m IS NOT NULL")
    opened = rows.select(F.coalesce(F.from_json("m.data", "map<string,string>"), "m").alias("data"))
    return opened.select(F.col("data.e").alias("type"), "data").filter("type IS NOT NULL")


def dedup_events(events: DataFrame) -> DataFrame:
    """Drops the second copy of events that older logs hold twice (same type, time and payload)."""
    return events.withColumn("_j", F.to_json("data")).dropDuplicates(["type", "time", "_j"]).drop("_j")
