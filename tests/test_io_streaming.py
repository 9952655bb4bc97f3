"""Readers, sinks, the paged source, models, and streams that must equal their batch form."""

import json

from pyspark.sql import functions as F

from tickweave.operators import book, evaluate, models, windows
from tickweave.sources import adaptor, readers, sinks
from tickweave.sources.paged import PagedSource
from tickweave.streaming import books, flow


def lines(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


def test_snapshot_reader(spark, tmp_path):
    lines(tmp_path / "20240101/snapshots_00.jsonl", [{"type": "snapshot", "symbol": "A", "time": 1, "price": "2.5", "features": {"x": 1, "flag": True}}, "", "{broken", {"type": "other"}, {"type": "snapshot", "symbol": "A", "time": 2}])
    got = readers.snapshots(spark, str(tmp_path), ["x", "flag"], with_map=True)
    assert [(r["t"], r["price"], r["x"], r["flag"]) for r in got.collect()] == [(1, 2.5, 1.0, 1.0)]
    assert readers.feature_names(got) == ["flag", "x"]


def test_event_reader_and_prices(spark, tmp_path):
    rows = [{"type": "aggTrade", "time": 5, "recvTime": 6, "data": {"s": "A", "p": "1.5", "q": "2", "m": True}}, {"type": "aggTrade", "data": {"s": "A", "p": "x", "T": 7}}, "nonsense"]
    lines(tmp_path / "d/events_aggTrade_00.jsonl", rows)
    got = readers.event_prices(readers.events(spark, str(tmp_path), "aggTrade"))
    assert [tuple(r) for r in got.collect()] == [("A", 5, 1.5)]


def test_depth_reader_feeds_the_book(spark, tmp_path):
    lines(tmp_path / "events_depthUpdate_00.jsonl", [{"type": "depthUpdate", "time": 5, "data": {"s": "A", "E": 5, "U": 1, "u": 2, "b": [["1", "2"]], "a": []}}])
    got = book.replay(readers.depth_events(spark, str(tmp_path))).first()
    assert got["resync"] == "not_ready" and not got["ready"]


def test_tail_symbols_env(spark, tmp_path):
    lines(tmp_path / "log_1.jsonl", [str(n) for n in range(10)])
    lines(tmp_path / "log_2.jsonl", [str(n) for n in range(10, 20)])
    got = readers.tail(spark, str(tmp_path), "log_*.jsonl", 1, 3)
    assert sorted(r["line"] for r in got.collect()) == ["17", "18", "19"]
    lines(tmp_path / "symbols.txt", ["BTCUSDT x", "", "ethusdt", "AUSDT"])
    assert sorted(r["symbol"] for r in readers.symbols(spark, str(tmp_path / "symbols.txt")).collect()) == ["AUSDT", "BTCUSDT"]
    lines(tmp_path / "env", ["# c", "A=1", "B = x=y"])
    assert {tuple(r) for r in readers.env_config(spark, str(tmp_path / "env")).collect()} == {("A", "1"), ("B", "x=y")}


def test_sinks_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", 0, 1.0), ("b", 3_600_000, None)], "type string, time bigint, v double")
    sinks.write_events(rows, f"{tmp_path}/ev", ["a", "b"])
    assert (tmp_path / "ev/date=19700101/hour=01").is_dir()
    assert spark.read.json(f"{tmp_path}/ev").count() == 2
    data = rows.select(F.col("type").alias("symbol"), F.col("time").alias("entryTime"), "v")
    for kind in ("parquet", "csv", "jsonl"):
        sinks.write_dataset(data, f"{tmp_path}/d.{kind}", kind, sort=True)
        assert readers.dataset(spark, f"{tmp_path}/d.{kind}").count() == 2


def page(symbol, lo, hi, limit):
    return [{"time": t, "value": float(t)} for t in range(lo, hi + 1) if t % 10 == 0][:limit]


def test_paged_source(spark):
    spark.dataSource.register(PagedSource)
    options = dict(fetch="tests.test_io_streaming:page", symbols="A,B", start="0", end="95", rangeMs="50", limit="3")
    got = spark.read.format("paged_series").options(**options).load()
    assert sorted(r["time"] for r in got.filter("symbol = 'A'").collect()) == list(range(0, 100, 10))


def test_model_round_trip(spark, tmp_path):
    rows = spark.range(200).select(F.col("id").alias("entryTime"), F.lit("A").alias("symbol"), F.col("id").alias("seq"), (F.col("id") % 7).cast("double").alias("x"), F.when(F.col("id") % 5 > 0, F.col("id").cast("double")).alias("y"))
    rows = rows.withColumn("target", F.col("x") * 2)
    model, meta = models.train_regressor(rows, depth=3, rounds=8, rate=0.3)
    assert meta["featureColumns"] == ["x", "y"]
    models.save(model, meta, f"{tmp_path}/m")
    again, meta = models.load(spark, f"{tmp_path}/m")
    got = models.predict(again, meta, rows.drop("y"))
    assert evaluate.regression_metrics(got).first()["r2"] > 0.8
    three, meta = models.train_classifier(rows.withColumn("target", F.col("id" if "id" in rows.columns else "seq") % 3), depth=2, rounds=2)
    assert {r["prediction"] for r in models.predict(three, meta, rows).select("prediction").distinct().collect()} <= {0.0, 1.0, 2.0}


def test_splits(spark):
    rows = spark.range(200).select(F.col("id").alias("entryTime"), F.lit("A").alias("symbol"), F.col("id").alias("seq"))
    train, test = evaluate.time_split(rows, 0.25, embargo_ms=10)
    assert (train.count(), test.count()) == (140, 50)
    folds = evaluate.walk_forward(rows)
    assert [(a.count(), b.count()) for a, b in folds] == [(100, 25), (125, 25), (150, 25), (175, 25)]


def test_streamed_flow_equals_batch(spark, sf, tmp_path):
    rows = adaptor.trades(spark, sf).filter("qty > 0").select("symbol", "t", "seq", "price", "qty", "side")
    for n in range(3):
        rows.filter((F.col("seq") / 400).cast("int") == n).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    run = flow.trailing_flow(stream, 6 * 3_600_000).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    run.awaitTermination(180)
    assert run.exception() is None
    got = {r["seq"]: (r["buyQty"], r["sellQty"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    used = spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    want = {r["seq"]: (r["flowBuyQty_21600s"], r["flowSellQty_21600s"]) for r in windows.rolling_flow(used, [6 * 3_600_000]).collect()}
    assert got == want


def test_streamed_book_equals_replay(spark, tmp_path):
    rows = [("A", t, t, "snapshot" if t % 7 == 3 else "event", t, t, None, t, [[str(t % 5), str(t % 4)]], [[str(t % 5 + 6), "1"]]) for t in range(30)]
    df = spark.createDataFrame(rows, book.EVENTS)
    for n in range(3):
        df.filter((F.col("seq") / 10).cast("int") == n).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
    stream = spark.readStream.schema(df.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    run = books.book_states(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    run.awaitTermination(180)
    assert run.exception() is None
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()), key=str) == sorted(map(tuple, book.replay(df).collect()), key=str)


def test_watermarked_windows(spark):
    rows = spark.createDataFrame([("A", 0, 1.0, 2.0, "BUY"), ("A", 59_000, 1.0, 3.0, "SELL"), ("A", 60_000, 1.0, 1.0, "BUY")], "symbol string, t bigint, price double, qty double, side string")
    got = flow.windowed_flow(rows).orderBy("window.start").collect()
    assert [(r["flowBuyQty"], r["flowSellQty"]) for r in got] == [(2.0, 3.0), (1.0, 0.0)]


def head():
    return 6


def poll(channels, after, upto):
    return [(n, json.dumps({"stream": c, "data": {"e": "aggTrade", "s": c.split("@")[0].upper(), "T": n, "p": str(n), "q": "1", "m": False}})) for n in range(after + 1, upto + 1) for c in channels]


def test_feed_source(spark, tmp_path):
    from tickweave.operators import projections
    from tickweave.sources.feed import FeedSource, channel_names, split

    names = channel_names(["AUSDT", "BUSDT"], books=False, marks=False, klines=(), liquidations=False, depth=None)
    assert names == ["ausdt@aggTrade", "busdt@aggTrade"] and split(list(range(5)), 2) == [[0, 1], [2, 3], [4]]
    assert "!bookTicker" in channel_names(["A"]) and "a@depth5@100ms" in channel_names(["A"], depth="partial", speed="100ms")
    spark.dataSource.register(FeedSource)
    raw = spark.readStream.format("market_feed").options(channels=",".join(names), perConnection="1", head="tests.test_io_streaming:head", poll="tests.test_io_streaming:poll").load()
    trades = projections.agg_trade(projections.route(raw), F.lit(0))
    run = trades.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(processingTime="0 seconds").start()
    try:
        run.processAllAvailable()
    finally:
        run.stop()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r["t"] for r in got.filter("symbol = 'AUSDT'").collect()) == [1, 2, 3, 4, 5, 6] and got.count() == 12


def test_tail_of_large_files_in_several_splits(spark, tmp_path):
    for k in (1, 2, 3):
        (tmp_path / f"log_{k}.jsonl").write_text("\n".join(f"{k}-{n}" for n in range(220_000)) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("128m", "400k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = {(r["file"][-7:], r["line"]) for r in readers.tail(spark, str(tmp_path), "log_*.jsonl", 2, 5).collect()}
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert got == {(f"{k}.jsonl", f"{k}-{n}") for k in (2, 3) for n in range(219_995, 220_000)}


def test_settings_choose_event_types(spark):
    rows = lambda **kv: spark.createDataFrame(list(kv.items()) or [("X", "")], "key string, value string")
    assert readers.event_types(rows()) == ["aggTrade", "bookTicker", "depthUpdate", "markPriceUpdate"]
    assert readers.event_types(rows(LOG_RAW_EVENTS="false")) == []
    assert readers.event_types(rows(LOG_RAW_EVENTS_TYPES="aggTrade, depthUpdate,none", ENABLE_DEPTH="False")) == ["aggTrade"]


def test_polled_endpoints(spark):
    rows = spark.createDataFrame([("A", 5, '{"openInterest":"7.5","time":1}'), ("B", 6, "broken"), ("C", 7, '{"openInterest":"x"}')], "symbol string, polledAt bigint, body string")
    assert [tuple(r) for r in readers.polled(rows, "openInterest").collect()] == [("A", 5, 5, 7.5), ("C", 7, 7, None)]
    mark = readers.polled(spark.createDataFrame([("A", 5, '{"markPrice":"1","indexPrice":"2","lastFundingRate":"0.1","nextFundingTime":9}')], rows.schema), "premiumIndex").first()
    assert (mark["markPrice"], mark["indexPrice"], mark["fundingRate"], mark["nextFundingTime"]) == (1.0, 2.0, 0.1, 9.0)
    assert readers.polled(spark.createDataFrame([("A", 5, '{"priceChangePercent":"1","lastPrice":"3"}')], rows.schema), "stats24h").first()["last"] == 3.0


def test_history_universe_and_feature_maps(spark):
    oi = spark.createDataFrame([("A", "10", "5", "4"), ("A", "11", None, "4"), ("A", None, "1", "1"), ("A", "12", "x", None)], "symbol string, timestamp string, sumOpenInterest string, openInterest string")
    assert [tuple(r) for r in readers.open_interest(oi).collect()] == [("A", 10, 5.0), ("A", 11, 4.0), ("A", 12, None)]
    info = spark.createDataFrame([([("BUSDT", "x"), ("AEUR", "y"), ("CUSDT", "z")],)], "symbols array<struct<symbol: string, status: string>>")
    assert [tuple(r) for r in readers.exchange_universe(info).collect()] == [("BUSDT", 0), ("CUSDT", 2)]
    rows = spark.createDataFrame([({"a": "1", "b": "bad", "c": "2"}, {"b": "9", "d": "4", "a": "7"})], "features map<string,string>, ctx map<string,string>")
    assert readers.pick_features(rows, extra="ctx").first()["features"] == {"a": "1", "b": "9", "c": "2", "d": "4"}
    assert readers.pick_features(rows, ["c", "d"], "ctx").first()["features"] == {"c": "2", "d": "4"}


def test_symbol_refresh_restarts_on_change(spark):
    from tickweave.streaming import refresh

    lists, started, stopped = [["A"], ["A"], [], ["B", "A"]], [], []

    class Query:
        def processAllAvailable(self):
            pass

        def stop(self):
            stopped.append(1)

    def start(symbols):
        started.append(symbols)
        return Query()

    table = lambda names: spark.createDataFrame([(s, n) for n, s in enumerate(names)], "symbol string, pos bigint")
    left = list(lists)
    assert refresh.keep_fresh(start, lambda: table(left.pop(0)), going=lambda: bool(left), wait=lambda s: None) == ["B", "A"]
    assert started == [["A"], ["B", "A"]] and len(stopped) == 2


def test_sample_is_the_smallest_hashes_and_cuts_meet_sorting(spark):
    rows = spark.range(5000).select(F.col("id").alias("seq"), (F.col("id") * 7919 % 613 - 300).alias("entryTime"), F.concat(F.lit("s"), F.col("id") % 3).alias("symbol"))
    want = rows.select("seq", F.xxhash64(F.lit(42), "seq").alias("h")).orderBy("h").limit(1250).collect()
    assert {r["seq"] for r in evaluate.exact_sample(rows, 0.25, ["seq"]).collect()} == {r["seq"] for r in want}
    twice = rows.unionByName(rows)
    assert evaluate.exact_sample(twice, 0.3001, ["seq"]).count() == round(0.3001 * 10_000) and evaluate.exact_sample(rows, 0.0, ["seq"]).count() == 0
    order = sorted((r["entryTime"], r["symbol"], r["seq"]) for r in rows.collect())
    train, test = evaluate.time_split(rows, 0.2)
    assert sorted((r["entryTime"], r["symbol"], r["seq"]) for r in train.collect()) == order[:4000] and test.count() == 1000
