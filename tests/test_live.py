"""The live side against fakes: books that fetch their snapshots, polled endpoints, hourly files of batches that are run again, tails, progress."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tickweave.operators import book
from tickweave.sources import polls, readers, sinks
from tickweave.streaming import progress, resync, ticks


@pytest.fixture(scope="module")
def store(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ticks.STATE_STORE)
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def wait(ready, seconds=60):
    end = time.time() + seconds
    while not ready() and time.time() < end:
        time.sleep(0.5)
    return ready()


def test_a_gap_fetches_one_snapshot_and_the_book_rejoins(store, tmp_path):
    calls, fail = f"{tmp_path}/calls", f"{tmp_path}/fail"

    def endpoint(symbol):
        with open(calls, "a") as f:
            f.write(f"{symbol}\n")
        if os.path.exists(fail):
            raise OSError("down")
        return {"lastUpdateId": 20, "bids": [["5", "1"], ["4", "2"]], "asks": [["6", "3"]]}

    asked = lambda: open(calls).read().split() if os.path.exists(calls) else []
    event = lambda t, u: ("A", t, t, "event", u, u, None, None, [["5", str(u)]], [])
    states = lambda: [r for r in store.read.schema(book.STATES).parquet(f"{tmp_path}/states").orderBy("t").collect()] if os.path.exists(f"{tmp_path}/states") else []
    feed = lambda name, rows: store.createDataFrame(rows, book.EVENTS).coalesce(1).write.parquet(f"{tmp_path}/events/{name}")
    feed("1", [event(1, 19), event(2, 20), event(3, 21)])  # not ready: three wishes, one request
    stream = store.readStream.schema(book.EVENTS).option("recursiveFileLookup", True).parquet(f"{tmp_path}/events")
    q = resync.run_books(store, stream, f"{tmp_path}/inbox", endpoint, lambda df, n: df.write.mode("append").parquet(f"{tmp_path}/states"), f"{tmp_path}/check", cooldown_ms=4000, every="200 milliseconds")
    try:
        assert wait(lambda: any(r["kind"] == "snapshot" and r["ready"] for r in states()))
        assert asked() == ["A"]
        last = states()[-1]
        assert last["lastUpdateId"] == 21 and not last["stale"] and last["depthBidQty"] == 23.0  # the held event was replayed
        feed("2", [event(2**41, 22)])
        assert wait(lambda: any(r["lastUpdateId"] == 22 for r in states()))
        open(fail, "w").close()
        feed("3", [event(2**41 + 1, 30), event(2**41 + 2, 31)])  # a gap while the endpoint is down
        assert wait(lambda: len(asked()) >= 3)  # the timer asks again after each pause
        os.remove(fail)
        assert wait(lambda: sum(r["kind"] == "snapshot" for r in states()) >= 2)
        reasons = [r["resync"] for r in states() if r["resync"]]
        assert reasons[:1] == ["not_ready"] and "gap_detected" in reasons and any(r["kind"] == "timer" for r in states())
    finally:
        q.stop()


def clock():
    return int(open("/tmp/tickweave-clock").read())


def ask(endpoint, symbol):
    if symbol == "DOWN":
        raise OSError("no answer")
    return json.dumps({"openInterest": "5", "lastFundingRate": "0.1", "lastPrice": clock()})


def test_polls_are_neither_lost_nor_doubled(spark, tmp_path):
    spark.dataSource.register(polls.PollSource)
    options = {"endpoints": "openInterest,premiumIndex,stats24h", "symbols": "A,B,DOWN,C", "ask": "tests.test_live:ask", "clock": "tests.test_live:clock", "periodMs": "1000", "perPartition": "2", "sleepMs": "1", "attempts": "2"}
    for now in (5_000, 5_999, 6_100, 9_000, 9_001):
        with open("/tmp/tickweave-clock", "w") as f:
            f.write(str(now))
        rows = spark.readStream.format("polled_endpoints").options(**options).load()
        q = rows.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").start()
        q.processAllAvailable()
        q.stop()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert {(r["polledAt"], r["n"]) for r in got.groupBy("polledAt").agg(F.count("*").alias("n")).collect()} == {(5000, 9), (6000, 9), (9000, 9)}
    assert got.select("endpoint", "symbol", "polledAt").distinct().count() == 27
    oi = readers.polled(got.filter("endpoint = 'openInterest'"), "openInterest").orderBy("t", "symbol").collect()
    assert [r["symbol"] for r in oi] == ["A", "B", "C"] * 3 and all(r["openInterest"] == 5.0 for r in oi)


def test_a_batch_that_dies_and_is_run_again_is_there_once(spark, tmp_path):
    out, hour = f"{tmp_path}/out", 3_600_000
    rows = spark.range(400).select(F.col("id").alias("n"), (F.col("id") * hour / 40).cast("bigint").alias("time")).repartition(8)
    sinks.write_hourly(rows.filter("n < 100"), out, batch=0)
    broken = rows.filter("n >= 100").withColumn("n", F.when(F.col("n") == 333, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("n")))
    with pytest.raises(Exception, match="lost"):
        sinks.write_hourly(broken, out, batch=1)
    assert spark.read.json(out).count() == 100
    for _ in range(2):
        sinks.write_hourly(rows.filter("n >= 100"), out, batch=1)
        got = spark.read.json(out)
        assert got.count() == 400 == got.select("n").distinct().count()
    assert got.filter(F.col("hour") != F.floor(F.col("n") / 40) % 24).isEmpty() and os.path.isdir(f"{out}/date=19700101/hour=02")
    sinks.write_hourly(rows.filter("n >= 360"), out, batch=1)  # the batch is replaced, its other hours emptied
    assert spark.read.json(out).count() == 140
    src = f"{tmp_path}/src"
    for n in range(3):
        rows.filter(F.col("n") % 3 == n).coalesce(1).write.mode("append").parquet(src)
        sinks.start_hourly(spark.readStream.schema(rows.schema).parquet(src), f"{tmp_path}/stream", f"{tmp_path}/cs", every=None).awaitTermination()
    assert spark.read.json(f"{tmp_path}/stream").count() == 400


def test_tail_reads_only_ends(spark, tmp_path, monkeypatch):
    for name, n in (("log_1.jsonl", 3), ("log_2.jsonl", 200_000), ("log_3.jsonl", 50)):
        with open(f"{tmp_path}/{name}", "w") as f:
            f.write("".join(f"{name} line {k} é\n" for k in range(n)))
    with open(f"{tmp_path}/log_4.jsonl", "w") as f:
        f.write("one\r\n\r\nlast without an end")
    read = []
    plain = readers._last_lines
    monkeypatch.setattr(readers, "_last_lines", lambda *a: read.append(a[1]) or plain(*a))
    got = readers.tail(spark, str(tmp_path), "log_*.jsonl", 3, 20, 512).collect()
    assert len(read) == 3
    want = [f"log_2.jsonl line {k} é" for k in range(199_980, 200_000)] + [f"log_3.jsonl line {k} é" for k in range(30, 50)] + ["one", "", "last without an end"]
    assert sorted(r["line"] for r in got) == sorted(want)
    assert readers.tail(spark, str(tmp_path), "none_*.jsonl").count() == 0


def test_progress_of_a_query_is_a_table(spark, tmp_path):
    listener = progress.ProgressTable(spark, f"{tmp_path}/progress", every=1)
    spark.streams.addListener(listener)
    try:
        for n in range(3):
            spark.range(100 * n, 100 * n + 100).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        rows = spark.readStream.schema("id bigint").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        q = rows.writeStream.format("noop").queryName("counted").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        q.awaitTermination()
        assert wait(lambda: os.path.isdir(f"{tmp_path}/progress") and progress.read_progress(spark, f"{tmp_path}/progress").agg(F.sum("inputRows")).first()[0] == 300, 30)
    finally:
        spark.streams.removeListener(listener)
    got = progress.throughput(progress.read_progress(spark, f"{tmp_path}/progress"), 60).collect()
    assert sum(r["rows"] for r in got) == 300 and all(r["query"] == "counted" and r["rowsASecond"] > 0 for r in got)


def flaky(channels):
    """A socket that drops twice: five messages, a failure; five more, an end; then silence. What it has sent is gone."""
    mark = f"/tmp/tickweave-socket-{os.getppid()}-{channels[0]}"
    n = int(open(mark).read()) if os.path.exists(mark) else 0
    with open(mark, "w") as f:
        f.write(str(n + 5))
    for k in range(n, min(n + 5, 12)):
        yield json.dumps({"stream": channels[0], "data": {"e": "aggTrade", "s": channels[0].split("@")[0].upper(), "T": k, "p": str(k), "q": "1", "m": False}}) if k != 7 else '{"broken'
    if n == 0:
        raise ConnectionError("dropped")
    while n >= 10:
        time.sleep(0.05)
        return


def test_socket_messages_are_spooled_once(spark, tmp_path):
    from tickweave.operators import projections
    from tickweave.sources import spool

    for f in os.listdir("/tmp"):
        if f.startswith("tickweave-socket-"):
            os.remove(f"/tmp/{f}")
    folder = f"{tmp_path}/spool"
    opened = spool.start(spark, ["a@aggTrade", "b@aggTrade", "c@aggTrade"], folder, "tests.test_live:flaky", per_connection=1, seconds=3, delay_s=0.2).collect()
    assert len(opened) == 3 and all(r["opened"] >= 3 for r in opened)
    left = spool.Spool(folder, 9)
    left.put("one")
    left.put("two")
    left.file.write('{"connection": 9, "seq": 2, "va')
    left.file.flush()  # dies here
    again = spool.Spool(folder, 9)
    assert again.seq == 2
    again.put("three")
    again.roll()
    for _ in range(2):  # over a restart
        q = spool.messages(spark, folder).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        q.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.count() == 39 == got.select("connection", "seq").distinct().count()
    assert [r["value"] for r in got.filter("connection = 9").orderBy("seq").collect()] == ["one", "two", "three"]
    trades = projections.agg_trade(projections.route(got.filter("connection < 9")), F.lit(0))
    assert sorted((r["symbol"], r["price"]) for r in trades.collect()) == [(s, float(k)) for s in "ABC" for k in range(12) if k != 7]
