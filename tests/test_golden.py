"""Hand-worked cases of the edge rules."""

import math

import pytest
from pyspark.sql import functions as F

from tickweave.functions import coerce, market
from tickweave.operators import asof, backtest, book, datasets, labels, projections, quality, universe, windows
from tickweave.plans import snapshots

P = "symbol string, t bigint, seq bigint, price double"


def prices(spark, *tp, symbol="A"):
    return spark.createDataFrame([(symbol, t, n, float(p)) for n, (t, p) in enumerate(tp)], P)


def column(df, name, order="seq"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_rolling_window_includes_its_lower_end(spark):
    rows = [("A", t, n, 10.0, 1.0, "BUY") for n, t in enumerate((0, 1000, 1001, 2000))]
    got = windows.rolling_flow(spark.createDataFrame(rows, P + ", qty double, side string"), [1000])
    assert column(got, "flowBuyCount_1s") == [1, 2, 2, 3]  # 2000: 1000 still counts


def test_rolling_empty_sides_and_bucket_edges(spark):
    rows = [("A", t, n, 2.0, float(n + 1), "SELL" if n % 2 else "BUY") for n, t in enumerate(range(0, 20_000, 700))]
    df = spark.createDataFrame(rows, P + ", qty double, side string")
    small, large = windows.rolling_flow(df, [1000], bucket_ms=1000), windows.rolling_flow(df, [1000], bucket_ms=10**9)
    key = [c for c in small.columns]
    assert sorted(map(tuple, small.select(key).collect())) == sorted(map(tuple, large.select(key).collect()))
    first = small.filter("seq = 0").first()
    assert first["flowSellQty_1s"] == 0 and first["flowBuySellRatio_1s"] is None and first["flowVWAP_1s"] == 2.0


def test_window_suffix_clash_is_refused(spark):
    with pytest.raises(ValueError):
        windows.rolling_flow(spark.createDataFrame([], P + ", qty double, side string"), [1000, 1200])


def test_trend_falls_back_to_the_oldest_retained(spark):
    ticks = spark.createDataFrame([("A", 10_000_000, 0)], "symbol string, t bigint, seq bigint")
    got = windows.trend_at(ticks, prices(spark, (0, 50), (9_000_000, 100), (9_100_000, 110)), "x", 60_000).first()
    assert math.isclose(got["trendx"], 10.0)  # all are older than the window: the oldest within 30 minutes of the last event


def test_volatility_needs_three_changes(spark):
    got = windows.trend_vol(prices(spark, (0, 100), (1, 101), (2, 102), (3, 103)), {"w": 100})
    v = column(got, "volw")
    assert v[:3] == [None] * 3 and v[3] > 0


def test_volatility_skips_pairs_that_are_not_positive(spark):
    got = windows.trend_vol(prices(spark, (0, 100), (1, 0), (2, 100), (3, 110), (4, 121), (5, 133.1)), {"w": 100})
    assert math.isclose(column(got, "volw")[5], 0.0, abs_tol=1e-9)


def test_zero_denominators(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "a double, b double")
    c = F.col
    r = df.select(market.spread_pct(c("a"), c("b")).alias("s"), market.imbalance(c("a"), c("b")).alias("i"), market.basis_pct(c("a"), c("b")).alias("x"), market.age_ms(F.lit(5), F.lit(None).cast("bigint")).alias("n"), market.age_ms(F.lit(5), F.lit(9)).alias("z")).first()
    assert tuple(r) == (None, None, None, None, 0)


def test_label_lag_at_the_limit_and_price_rules(spark):
    s = prices(spark, (0, 100), (110, 120), (221, 0)).withColumns({"bestBid": F.lit(None).cast("double"), "bestAsk": F.lit(-1.0)})
    got = labels.return_labels(s, [100], 0.10, 0.0, 0.0).collect()
    assert [(r["entryTime"], r["lagMs"], round(r["returnPct"], 6)) for r in got] == [(0, 10, 20.0)]  # lag 10 = limit is kept, lag 11 and the zero price are not
    assert got[0]["entryAsk"] == 100.0 and got[0]["entryBid"] == 100.0


def test_label_costs_and_funding(spark):
    s = prices(spark, (0, 100), (28_800_000, 100)).withColumns({"fundingRate": F.lit(0.001)})
    r = labels.return_labels(s, [28_800_000], 0.1, 4.0, 2.0).first()
    assert math.isclose(r["fundingAdjPct"], 0.1)
    assert math.isclose(r["longReturnPct"], (100 * 0.9994 - 100 * 1.0006) / (100 * 1.0006) * 100 - 0.1)
    assert math.isclose(r["shortReturnPct"], (100 * 0.9994 - 100 * 1.0006) / (100 * 0.9994) * 100 + 0.1)


def test_barriers(spark):
    e = prices(spark, (0, 100))
    up = labels.barrier_labels(e, prices(spark, (5, 100.12), (6, 99.0)), 10).first()
    assert (up["labelLong"], up["exitTimeLong"], up["labelShort"], up["exitPriceShort"]) == ("TP", 5, "SL", 100.12)
    none = labels.barrier_labels(e, prices(spark, (11, 200.0)), 10).first()
    assert (none["labelLong"], none["exitTimeLong"], none["exitPriceLong"]) == ("TIME", 10, 100.0)
    edge = labels.barrier_labels(e, prices(spark, (10, 200.0)), 10).first()
    assert edge["labelLong"] == "TP"
    absent = labels.barrier_labels(e, prices(spark, (5, 200.0), symbol="B"), 10).first()
    assert absent["labelLong"] == "TIME"


def trades(spark, *rows):
    return spark.createDataFrame([("A", t, n, h, float(p), float(r), float(r), -float(r)) for n, (t, h, p, r) in enumerate(rows)], "symbol string, entryTime bigint, seq bigint, horizonMs bigint, prediction double, returnPct double, longReturnPct double, shortReturnPct double")


def test_positions_do_not_overlap_but_may_touch(spark):
    got = backtest.run_backtest(trades(spark, (0, 10, 1, 1), (9, 10, 1, 1), (10, 10, 1, 1), (15, 10, -1, 1), (20, 0, 1, 1), (20, 5, 1, 1)), 0.5, 0.5)
    assert column(got, "entryTime") == [0, 10, 20]


def test_long_wins_ties_and_cost_follows_selection(spark):
    got = backtest.run_backtest(trades(spark, (0, 1, 0, 2)), 0.0, 0.0, 10.0).first()
    assert got["action"] == "long" and math.isclose(got["realizedPct"], 1.9)


def test_drawdown_ignores_an_initial_loss(spark):
    s = backtest.summary(backtest.run_backtest(trades(spark, (0, 1, 1, -5), (86_400_000, 1, 1, 2), (86_400_001, 1, 1, -1)), 0.5)).first()
    assert math.isclose(s["maxDrawdownPct"], -1.0) and math.isclose(s["cumPct"], -4.0) and s["trades"] == 3


def test_summary_without_trades(spark):
    s = backtest.summary(backtest.run_backtest(trades(spark), 0.5)).first()
    assert s["trades"] == 0 and s["sharpeLike"] == 0.0 and s["maxDrawdownPct"] == 0.0


def test_features_never_include_targets(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, "x")], "absReturnPct double, target double, depthBidQty double, symbol string")
    assert datasets.feature_columns(df) == ["depthBidQty"]


def test_deltas_of_ages_are_dropped_on_request(spark):
    df = prices(spark, (0, 1), (90_000_000, 3)).withColumn("bookAgeMs", F.col("t"))
    live, back = windows.deltas(df, ["price", "bookAgeMs"]), windows.deltas(df, ["price", "bookAgeMs"], exclude_age=False)
    assert column(live, "priceDelta") == [None, 2.0] and column(live, "bookAgeMsDelta") == [None, None]
    assert column(back, "bookAgeMsDelta") == [None, 90_000_000.0]


def test_context_age_is_given_when_stale(spark):
    snap = spark.createDataFrame([("A", 1_000_000, 0)], "symbol string, t bigint, seq bigint")
    got = datasets.context_features(snap, prices(spark, (0, 10), symbol="B"), ["B"], {"1m": 60_000}, 300_000).first()
    assert got["ctx_B_ageMs"] == 1_000_000 and got["ctx_B_price"] is None


def feed(spark, *messages):
    return projections.route(spark.createDataFrame([(m,) for m in messages], "value string"))


def test_feed_names_that_differ_in_case(spark):
    ev = feed(spark, '{"e":"bookTicker","s":"A","b":"1","B":"2","a":"3","A":"4","E":7}', "broken", '[{"e":"24hrTicker","s":"A","c":"5","E":1},{"e":"24hrTicker","s":"B","c":"6","E":0}]')
    b = projections.book_ticker(ev, F.lit(99)).first()
    assert (b["bestBid"], b["bidQty"], b["bestAsk"], b["askQty"], b["price"], b["t"]) == (1, 2, 3, 4, 2, 7)
    assert {(r["symbol"], r["t"], r["last"]) for r in projections.ticker(ev, F.lit(99)).collect()} == {("A", 1, 5.0), ("B", 99, 6.0)}


def test_liquidations_take_the_first_given_field(spark):
    ev = feed(spark, '{"e":"forceOrder","E":5,"o":{"s":"A","S":"X","q":"","l":"3","p":"0","ap":"9","T":4}}')
    r = projections.force_order(ev, F.lit(99)).first()
    assert (r["qty"], r["price"], r["side"], r["t"]) == (3.0, 0.0, "SELL", 4)


def test_only_final_bars_make_prices(spark):
    k = '{"e":"kline","k":{"s":"A","i":"1m","t":0,"T":59,"o":"1","h":"1","l":"1","c":"2","v":"3","n":1,"x":%s}}'
    got = projections.price_series({"kline": projections.kline(feed(spark, k % "true", k % "false"))})
    assert got.count() == 1


def test_ordered_union_keeps_first_place(spark):
    mk = lambda *s: spark.createDataFrame([(x, n) for n, x in enumerate(s)], "symbol string, pos bigint")
    got = universe.ordered_union([mk("btcusdt"), mk("XUSDT", "BTCUSDT", "bad!")]).collect()
    assert {(r["symbol"], r["rank"]) for r in got} == {("BTCUSDT", 0), ("XUSDT", 1)}


def test_unseen_symbols_get_minus_one(spark):
    rows = spark.createDataFrame([("A",), ("C",)], "symbol string")
    assert column(universe.encode(rows, universe.codes(rows.filter("symbol = 'A'"))), "symbolCode", "symbol") == [0, -1]


def test_quality_on_nothing(spark):
    empty = spark.createDataFrame([], P)
    assert quality.time_span(empty, 10).first()["rows"] == 0
    assert quality.coverage(empty, ["price"]).first()["present"] == 0


def test_window_lists():
    assert coerce.parse_number_list("5, x,1,-2,1,1.5") == [1, 1.5, 5] and coerce.parse_number_list("", [3]) == [3]
    assert coerce.ensure_default_window([5, 1], 3) == [1, 3, 5]


def test_tick_grid(spark):
    got = snapshots.tick_grid(spark.createDataFrame([("A",), ("A",)], "symbol string"), 0, 10, 5)
    assert sorted(r["t"] for r in got.collect()) == [0, 5, 10]


def test_forward_asof_takes_the_first_of_ties(spark):
    left = spark.createDataFrame([("A", 5)], "symbol string, t bigint")
    got = asof.asof_forward(left, prices(spark, (4, 1), (6, 2), (6, 3)), ["price"]).first()
    assert (got["price"], got["lagMs"]) == (2.0, 1)
    back = asof.asof_backward(left.withColumn("t", F.lit(6).cast("bigint")), prices(spark, (4, 1), (6, 2), (6, 3)), ["price"]).first()
    assert back["price"] == 3.0


def ev(U=None, u=None, pu=None, b=(), a=(), t=0, last=None):
    return {"firstId": U, "finalId": u, "prevId": pu, "lastUpdateId": last, "b": [list(x) for x in b], "a": [list(x) for x in a], "t": t}


class TestBook:
    def ready(self):
        k = book.Book()
        k.sync(10, [["1", "1"]], [["2", "1"]], 0)
        return k

    def test_not_ready_buffers_and_asks_once_in_ten_seconds(self):
        k = book.Book()
        assert k.event(ev(1, 2)) == "not_ready" and k.event(ev(3, 4, t=9_999)) is None and k.event(ev(5, 6, t=10_000)) == "not_ready" and len(k.buffer) == 3

    def test_missing_ids(self):
        assert self.ready().event(ev(None, 3, t=10**6)) == "missing_update_ids"

    def test_previous_id_is_tested_before_staleness(self):
        assert self.ready().event(ev(1, 5, 3, t=10**6)) == "pu_mismatch"
        assert self.ready().event(ev(1, 5, t=10**6)) is None

    def test_gap_keeps_serving_stale_sums(self):
        k = self.ready()
        assert k.event(ev(15, 16, t=10**6)) == "gap_detected" and k.ready and k.stale and k.stats(5) == (1.0, 1.0, 0.0)

    def test_apply_and_delete(self):
        k = self.ready()
        k.event(ev(11, 12, 10, b=[("1", "0"), ("0.5", "4")]))
        assert k.last_id == 12 and k.bids == {0.5: 4.0}
        k.event(ev(13, 13, 12, b=[("0.5", None)]))
        assert k.bids == {}

    def test_replay_of_the_buffer(self):
        k = book.Book()
        for e in (ev(5, 9), ev(10, 12, b=[("3", "3")]), ev(13, 14)):
            k.event(e)
        assert k.sync(10, [], [], 0) is None and k.ready and k.last_id == 14 and k.bids == {3.0: 3.0}

    def test_replay_without_a_start_waits(self):
        k = book.Book()
        k.event(ev(20, 21))
        assert k.sync(10, [], [], 0) is None and not k.ready and len(k.buffer) == 1

    def test_replay_gap_asks_again(self):
        k = book.Book()
        k.event(ev(10, 12))
        k.event(ev(15, 16))
        assert k.sync(10, [], [], 10**6) == "buffer_gap_detected" and len(k.buffer) == 1

    def test_partial_replaces(self):
        k = self.ready()
        k.event(ev(b=[("7", "1")], last=5), partial=True)
        assert k.bids == {7.0: 1.0} and k.last_id == 5 and k.asks == {}

    def test_prune_keeps_the_best(self):
        k = self.ready()
        k.event(ev(11, 11, b=[(str(p), "1") for p in range(2, 400)]))
        assert len(k.bids) == 100 and max(k.bids) == 399

    def test_round_trip(self):
        k = self.ready()
        assert book.Book.load(k.dump()) == k
