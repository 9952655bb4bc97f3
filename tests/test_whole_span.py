"""The two snapshot queries without SQL, against brute force on a small log that runs past the fixed grid."""

import datetime as dt

import pytest

from tickweave.plans import queries as q

STEP = 6 * 3_600_000


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """(folder, rows of symbol, t, price, qty): an event every 7 hours and 13 minutes for 33 days, two symbols in turn."""
    first = dt.datetime(2024, 1, 1, 0, 10)
    at = [first + dt.timedelta(minutes=433 * k) for k in range(110)]
    rows = [(k + 1, t, k, ("view", "click")[k % 2], 10.0 + k % 17, f'{{"k": {k % 9 + 1}}}') for k, t in enumerate(at)]
    path = str(tmp_path_factory.mktemp("log"))
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{path}/events.parquet")
    ms = lambda t: (t - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1)
    return path, [(s, ms(t), v + 100, float(k % 9 + 1)) for k, (_, t, _, s, v, _) in enumerate(rows)]


def latest(events, symbol, t):
    return max((e for e in events if e[0] == symbol and e[1] <= t), key=lambda e: e[1], default=None)


def test_snapshots_take_in_every_event(spark, log):
    path, events = log
    got = {(r["symbol"], r["t"]): r["kline1mClose"] for r in q.QUERIES["t2_snapshots"](spark, path).collect()}
    last = max(e[1] for e in events)
    ticks = range(-(-events[0][1] // STEP) * STEP, last + STEP, STEP)
    want = {(s, t): e[2] for s in ("view", "click") for t in ticks if (e := latest(events, s, t))}
    assert got == want and max(t for _, t in got) >= last


def test_backfill_uses_every_funding_row(spark, log):
    path, events = log
    got = {(r["symbol"], r["t"]): r["fundingRate"] for r in q.QUERIES["backfill_snapshots"](spark, path).collect()}
    assert got == {(s, t + 59_999): pytest.approx(latest(events, s, t)[3] / 1e4) for s, t, _, _ in events}


def test_ages_and_context(spark, log):
    path, events = log
    for r in q.QUERIES["t2_snapshots"](spark, path).collect():
        own, view = latest(events, r["symbol"], r["t"]), latest(events, "view", r["t"])
        assert r["flowAgeMs"] == r["bookAgeMs"] == r["t"] - own[1] and r["liqAgeMs"] is None and r["markAgeMs"] is None
        assert r["ctx_view_price"] == (view[2] if view else None)
    for r in q.QUERIES["backfill_snapshots"](spark, path).collect():
        assert r["markAgeMs"] == r["kline1mAgeMs"] == r["stats24hAgeMs"] == 0 and r["fundingAgeMs"] == 59_999
        assert r["openInterestAgeMs"] is None and r["kline5mAgeMs"] is None and r["microCompleteness"] == 0 and r["bestBid"] is None


def test_dataset_rows_say_their_target(spark):
    from tickweave.operators import datasets

    snaps = spark.createDataFrame([("A", 1, 2.0), ("A", 2, 3.0)], "symbol string, t bigint, x double")
    labels = spark.createDataFrame([("A", 1, -0.5, None, 0.25), ("A", 2, None, None, 0.1)], "symbol string, entryTime bigint, returnPct double, midReturnPct double, longReturnPct double")
    got = datasets.build_dataset(snaps, labels, ["x"], target_mode="abs_return").collect()
    assert [(r["target"], r["absReturnPct"], r["targetMode"], r["targetField"]) for r in got] == [(0.5, 0.5, "abs_return", "longReturnPct")]
    assert datasets.build_dataset(snaps, labels, ["x"], mode="regime").first()["target"] == 0.25
