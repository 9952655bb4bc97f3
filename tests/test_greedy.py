"""Greedy selection split in time, and books replayed in segments, against one pass in order."""

import random

import numpy as np
from pyspark.sql import functions as F

from tickweave.operators import book
from tickweave.operators.greedy import chain_ends, greedy


def one_pass(rows):
    free, out = {}, []
    for key, begin, end, seq, asks in sorted(rows, key=lambda r: (str(r[0]), r[1], r[3])):
        ok = asks and begin >= free.get(key, -(10**18))
        out.append((key, begin, end, seq, ok))
        if ok:
            free[key] = end
    return sorted(out, key=str)


def test_greedy_equals_one_pass(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["A", "A", "A", "B", None]), rng.choice([rng.randint(0, 5000), rng.randint(0, 200) * 10]), rng.randint(1, 40), n, rng.random() < 0.8) for n in range(6000)]
    rows = [(k, b, b + d, n, a) for k, b, d, n, a in rows]
    df = spark.createDataFrame(rows, "symbol string, begin bigint, until bigint, seq bigint, asks boolean")
    for size in (40, 130, 2560):
        got = greedy(df, "begin", "until", ["seq"], 40, asks=F.col("asks"), bucket_ms=size)
        assert sorted(((r["symbol"], r["begin"], r["until"], r["seq"], r["picked"]) for r in got.collect()), key=str) == one_pass(rows)
    assert greedy(df.limit(0), "begin", "until", ["seq"], 40).count() == 0
    odd = spark.createDataFrame([("A", None, 5, 1, True), ("A", 1, None, 2, True), ("A", 1, 3, 3, None), ("A", 2, 4, 4, True)], df.schema)
    assert [r["seq"] for r in greedy(odd, "begin", "until", ["seq"], 40, asks=F.col("asks")).filter("picked").collect()] == [4]


def test_sparse_buckets(spark):
    rows = [("A", t, t + 10, t, True) for t in (0, 3, 9, 10, 5000, 5004, 5009, 5010, 90_000)]
    df = spark.createDataFrame(rows, "symbol string, begin bigint, until bigint, seq bigint, asks boolean")
    got = greedy(df, "begin", "until", ["seq"], 10, bucket_ms=12)
    assert sorted(r["begin"] for r in got.filter("picked").collect()) == [0, 10, 5000, 5010, 90_000]


def test_chains():
    begin, end = np.array([0, 1, 5, 6, 12]), np.array([5, 9, 8, 20, 13])
    assert chain_ends(begin, end).tolist() == [13, 13, 13, 20, 13]


def test_one_symbol_is_spread_over_tasks(spark):
    df = spark.range(20_000).selectExpr("'A' AS symbol", "id * 7 AS begin", "id * 7 + 30 AS until", "id AS seq")
    n = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = greedy(df, "begin", "until", ["seq"], 30)
        tasks = got.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
        assert len(tasks) >= 8 and max(r["count"] for r in tasks) < 6000
        assert got.filter("picked").count() == 4000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def in_order(rows, partial):
    out, at, k = [], None, None
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if r[0] != at:
            at, k = r[0], book.Book()
        out.append(book.step(k, dict(zip(("symbol", "t", "seq", "kind", "firstId", "finalId", "prevId", "lastUpdateId", "b", "a"), r)), 3, partial))
    return out


def depth_rows(seed):
    """Chains with gaps, wrong links, missing ids, snapshots ahead and behind; times in bursts, over several days."""
    rng, rows = random.Random(seed), []
    for symbol in "AB":
        last, t = 0, 0
        for seq in range(900):
            t += rng.choice([0, 1, 500, 6000, 40_000, 500_000])
            level = lambda: [[str(rng.randint(1, 9)), rng.choice(["0", "1", "2.5", "x"])] for _ in range(rng.randint(0, 3))]
            if rng.random() < 0.08:
                rows.append((symbol, t, seq, "snapshot", None, None, None, rng.choice([last + 5, last, max(0, last - 3), None]), level(), level()))
                continue
            first = last + rng.choice([1, 1, 1, 1, 1, 1, 0, 3])
            final = first + rng.randint(0, 2)
            rows.append((symbol, t, seq, "event", *rng.choice([(first, final, rng.choice([None, last, last, last, last - 1]))] * 12 + [(None, final, None)]), rng.choice([None, final]), level(), level()))
            last = max(last, final)
    return rows


def test_segments_equal_one_pass(spark):
    for partial, seed in ((False, 2), (False, 3), (True, 4)):
        rows = depth_rows(seed)
        df = spark.createDataFrame(rows, book.EVENTS)
        got = sorted((tuple(r) for r in book.replay(df, 3, partial).collect()), key=lambda r: r[:3])
        want = in_order(rows, partial)
        assert len({r[-1] for r in want}) >= (1 if partial else 5)
        assert [str(r) for r in got] == [str(tuple(w)) for w in want]
        n = book.borders(df, partial).groupBy("symbol", "_start").count().collect()
        assert len(n) > 10 and max(r["count"] for r in n) < 700
    assert book.replay(df.limit(0)).count() == 0
