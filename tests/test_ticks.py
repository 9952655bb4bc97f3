"""Snapshot ticks of a stream against the batch snapshots at the same ticks: shuffled arrival, a restart, late rows, idle symbols."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from tickweave.plans import snapshots
from tickweave.streaming import ticks

STEP, WINDOWS, TRENDS = 1000, [2000, 5000], {"5m": 4000, "15m": 9000}
FLOW = "symbol string, t bigint, seq bigint, price double, qty double, side string"
SCHEMAS = {
    "trades": FLOW, "liquidations": FLOW, "prices": "symbol string, t bigint, seq bigint, price double", "mark": "symbol string, t bigint, seq bigint, markPrice double, indexPrice double, fundingRate double, nextFundingTime double",
    "book": "symbol string, t bigint, seq bigint, bestBid double, bestAsk double, bidQty double, askQty double", "stats24h": "symbol string, t bigint, seq bigint, last double, changePct24h double, high24h double, low24h double, volume24h double, quoteVolume24h double",
}


@pytest.fixture(scope="module")
def store(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ticks.STATE_STORE)
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def events(seed, span_ms=40_000):
    rng = random.Random(seed)
    rows = {n: [] for n in SCHEMAS}
    for symbol in "AB":
        seq = 0
        for t in sorted(rng.sample(range(10, span_ms), 160)):
            seq += 1
            table = rng.choice([*SCHEMAS, "trades", "prices"])
            x = lambda: round(rng.uniform(90, 110), 2)
            if symbol == "B" and 12_000 < t < 30_000 and table in ("trades", "prices"):
                continue  # nothing inside the windows: the oldest retained price serves
            row = {"trades": (x(), rng.choice([0.0, 1.5, 2.0]), rng.choice(["BUY", "SELL", None])), "liquidations": (x(), 1.0, "SELL"), "prices": (rng.choice([100.0, x()]),), "mark": (x(), x(), 0.01, 5.0), "book": (x(), x() + 20, rng.choice([None, 1.0]), 2.0), "stats24h": (x(),) * 6}[table]
            rows[table].append((symbol, t, seq, *row))
    return rows


def run_stream(spark, tmp, batches, retention=6000, **how):
    """Each batch is one file of mixed events; the query is stopped and started anew between files."""
    src, out, check = f"{tmp}/in", f"{tmp}/out", f"{tmp}/check"
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, ticks.EVENT).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(ticks.EVENT).parquet(src)
        got = ticks.snapshot_stream(stream, tuple(SCHEMAS), WINDOWS, TRENDS, STEP, retention_ms=retention, **how)
        q = got.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        last = [p for p in q.recentProgress if p["stateOperators"]]
    return spark.read.parquet(out), last


def mixed_rows(spark, rows):
    tables = {n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in rows.items()}
    return tables, [tuple(r) for r in ticks.mixed(tables).collect()]


def same(a, b):
    return a is None and b is None or a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-7)


@pytest.mark.parametrize("seed", [1])
def test_stream_equals_batch_in_any_arrival_order(store, tmp_path, monkeypatch, seed):
    from tickweave.operators import windows

    monkeypatch.setattr(snapshots, "with_oldest", lambda p: windows.with_oldest(p, 6000))
    tables, rows = mixed_rows(store, events(seed))
    rng = random.Random(seed)
    arrival = sorted(rows, key=lambda r: r[1] + rng.uniform(0, 3900))  # out of order by less than the lateness of 4 s
    third = len(arrival) // 3
    end = [(s, 60_000, 0, "mark", [1.0, 1.0, 1.0, 1.0]) for s in "AB"]
    got, _ = run_stream(store, tmp_path, [arrival[:third], arrival[third : 2 * third], [*arrival[2 * third :], *end]], late="4 seconds")
    found = {(r["symbol"], r["t"]): r.asDict() for r in got.collect()}
    assert len(found) == got.count() and {s for s, _ in found} == {"A", "B"}
    for s in "AB":  # no tick is left out
        mine = sorted(t for x, t in found if x == s)
        assert mine == list(range(mine[0], mine[-1] + STEP, STEP)) and mine[-1] >= 50_000
    at = store.createDataFrame(list(found), "symbol string, t bigint")
    want = {(r["symbol"], r["t"]): r.asDict() for r in snapshots.build_snapshots(at, tables, WINDOWS, TRENDS).collect()}
    assert set(want) == set(found)
    some = next(iter(want.values()))
    assert set(some) | {"lateRows"} == set(next(iter(found.values())))
    for key, w in want.items():
        bad = [(n, v, found[key][n]) for n, v in w.items() if n not in ("symbol", "t") and not same(v, found[key][n])]
        assert not bad, (key, bad[:5])
    assert all(r["lateRows"] == 0 for r in found.values())


def test_late_rows_are_counted_and_left_out(store, tmp_path):
    mark = lambda t, p: ("A", t, t, "mark", [p, 1.0, 0.0, 0.0])
    first = [mark(500, 1.0), mark(9500, 2.0)]
    second = [mark(700, 99.0), mark(12_500, 3.0)]  # the first is behind the watermark of 7.5 s
    third = [mark(30_000, 4.0)]
    got, progress = run_stream(store, tmp_path, [first, second, third], late="2 seconds")
    prices = {r["t"]: r["price"] for r in got.collect()}
    assert prices[1000] == 1.0 and prices[9000] == 1.0 and prices[10_000] == 2.0 and prices[13_000] == 3.0 and 99.0 not in prices.values()


def test_idle_symbols_leave_and_come_back(store, tmp_path):
    mark = lambda s, t, p: (s, t, t, "mark", [p, 1.0, 0.0, 0.0])
    got, progress = run_stream(store, tmp_path, [[mark("A", 500, 1.0), mark("B", 400, 1.0)], [mark("B", 20_500, 2.0)], [mark("A", 40_500, 3.0), mark("B", 60_000, 1.0)]], late="0 seconds", idle_ms=3000)
    rows = {(r["symbol"], r["t"]): r for r in got.collect()}
    a = sorted(t for s, t in rows if s == "A")
    assert a[:3] == [1000, 2000, 3000] and 4000 not in a and 41_000 in a and 20_000 not in a
    assert rows["A", 41_000]["priceDelta"] is None and rows["A", 2000]["priceDelta"] == 0.0 and rows["A", 2000]["markAgeMs"] == 1500


def test_wall_clock_ticks(store, tmp_path):
    """Processing time: timers fire without new events, and take what has arrived."""
    store.createDataFrame([("A", 500, 1, "mark", [7.0, 1.0, 0.0, 0.0])], ticks.EVENT).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = store.readStream.schema(ticks.EVENT).parquet(f"{tmp_path}/in")
    got = ticks.snapshot_stream(stream, ("mark",), WINDOWS, TRENDS, 500, event_time=False)
    q = got.writeStream.format("memory").queryName("wall").option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="200 milliseconds").start()
    try:
        for _ in range(120):
            time.sleep(0.5)
            if store.table("wall").count() >= 3:
                break
    finally:
        q.stop()
    rows = store.table("wall").orderBy("t").collect()
    assert len(rows) >= 3 and all(r["price"] == 7.0 for r in rows) and all(b["t"] - a["t"] == 500 for a, b in zip(rows, rows[1:])) and rows[0]["flowBuyQty_2s"] is None
