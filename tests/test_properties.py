"""Random inputs against brute force."""

import bisect

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickweave.operators import asof, backtest, labels, windows

few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
times = st.lists(st.integers(0, 200), min_size=1, max_size=25)


@few
@given(left=times, right=times)
def test_asof_backward(spark, left, right):
    r = sorted(right)
    got = asof.asof_backward(spark.createDataFrame([("A", t, n) for n, t in enumerate(left)], "symbol string, t bigint, n bigint"), spark.createDataFrame([("A", t, s, float(s)) for s, t in enumerate(r)], "symbol string, t bigint, seq bigint, v double"), ["v"], bucket_ms=7)
    for row in got.collect():
        k = bisect.bisect_right(r, row["t"]) - 1
        assert row["v"] == (None if k < 0 else float(k))
    assert got.count() == len(left)


@few
@given(ticks=st.lists(st.tuples(st.integers(0, 60), st.integers(90, 110)), min_size=1, max_size=25), entry=st.integers(0, 60))
def test_first_touch(spark, ticks, entry):
    rows = sorted((t, n, float(p)) for n, (t, p) in enumerate(ticks))
    e = spark.createDataFrame([("A", entry, 0, 100.0)], "symbol string, t bigint, seq bigint, price double")
    x = spark.createDataFrame([("A", t, n, p) for t, n, p in rows], "symbol string, t bigint, seq bigint, price double")
    want = next(((("TP" if p >= 105 else "SL"), t) for t, n, p in rows if entry <= t <= entry + 20 and (p >= 105 or p <= 96)), ("TIME", entry + 20))
    got = labels.barrier_labels(e, x, 20, 500.0, 400.0, ("long",)).first()
    assert (got["labelLong"], got["exitTimeLong"]) == want


@few
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 100), st.integers(1, 30)), min_size=1, max_size=25))
def test_greedy_positions(spark, rows):
    data = [(s, t, n, h, 1.0, 1.0, 1.0, 1.0) for n, (s, t, h) in enumerate(rows)]
    df = spark.createDataFrame(data, "symbol string, entryTime bigint, seq bigint, horizonMs bigint, prediction double, returnPct double, longReturnPct double, shortReturnPct double")
    free, want = {}, []
    for s, t, n, h, *_ in sorted(data, key=lambda r: (r[1], r[2])):
        if s not in free or t >= free[s]:
            free[s] = t + h
            want.append(n)
    assert sorted(r["seq"] for r in backtest.run_backtest(df, 0.5).collect()) == sorted(want)


@few
@given(st.lists(st.tuples(st.integers(0, 100), st.integers(1, 9)), min_size=1, max_size=20))
def test_trend_volatility(spark, ticks):
    rows = sorted((t, n, float(p)) for n, (t, p) in enumerate(ticks))
    got = windows.trend_vol(spark.createDataFrame([("A", t, n, p) for t, n, p in rows], "symbol string, t bigint, seq bigint, price double"), {"w": 20}, retention_ms=20)
    for r in got.collect():
        ps = [p for t, n, p in rows if r["t"] - 20 <= t and (t, n) <= (r["t"], r["seq"])]
        ch = [(b - a) / a * 100 for a, b in zip(ps, ps[1:])]
        if len(ch) >= 3:
            m = sum(ch) / len(ch)
            assert abs(r["volw"] - (sum((c - m) ** 2 for c in ch) / (len(ch) - 1)) ** 0.5) < 1e-9
        else:
            assert r["volw"] is None
        assert abs(r["trendw"] - (ps[-1] - ps[0]) / ps[0] * 100) < 1e-9
