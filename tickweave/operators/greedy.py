"""Greedy selection in time order, split in time: a row is picked unless it begins before the last picked row of its key has ended.

What a stretch of time does to a key is a small map: the end of the last pick before it -> the end of the last pick after it. Such maps are worked out bucket by bucket in parallel, composed over runs of buckets (also in
parallel), and followed once along the runs and once inside each; then every bucket is picked on its own, knowing where it starts. A busy key is spread over as many tasks as it has buckets.

A pick ends within ``longest`` of its begin, so what enters a bucket ends within ``longest`` of the bucket's start: only rows up to there (and the next one) are points of the map.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of so many longest spans, runs of so many buckets.
SPANS_A_BUCKET = 64
BUCKETS_A_RUN = 64
TABLE = "key string, bucket bigint, at array<bigint>, to array<bigint>"


def chain_ends(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each row (sorted by begin): the end of the last pick, if it is the first one picked."""
    n = len(begin)
    after = np.searchsorted(begin, end, "left")
    # A row whose end is its own begin would follow itself; it is followed by the next row.
    last = np.minimum(np.maximum(after, np.arange(n) + 1), n)
    last = np.where(last == n, np.arange(n), last)
    while True:
        further = last[last]
        if (further == last).all():
            return end[last]
        last = further


def follow(free: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Ends of the last pick after a stretch, given those before it."""
    place = np.searchsorted(at, free, "left")
    return np.where(place < len(at), np.append(to, 0)[place], free)


NEVER = -(2**63)


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """Rows of each key in turn (sorted input), the first ``keys`` columns being the key."""
    at, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for c in batch.columns[:keys]:
            v = np.array(c.to_pylist(), object)
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            key = tuple(c[0].as_py() for c in part.columns[:keys])
            if key != at and held:
                yield at, held
                held = []
            at = key
            held.append(part)
    if held:
        yield at, held


def _map_of(begin: np.ndarray, end: np.ndarray, upto: int) -> tuple[np.ndarray, np.ndarray]:
    """The points of a bucket's map: the first row of each begin up to ``upto``, and the next."""
    ends = chain_ends(begin, end)
    first = np.ones(len(begin), bool)
    first[1:] = begin[1:] != begin[:-1]
    places = np.flatnonzero(first)
    places = places[: int(np.searchsorted(begin[places], upto, "right")) + 1]
    return begin[places], ends[places]


def _maps(size: int, longest: int):
    """Sorted rows (key, bucket, begin, end, asks) -> the map of each bucket that has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (key, bucket), parts in _groups(batches, 2):
            begin, end, asks = (np.concatenate([p.column(k).to_numpy(zero_copy_only=False) for p in parts]) for k in (2, 3, 4))
            asks = asks.astype(bool)
            if asks.any():
                at, to = _map_of(begin[asks], end[asks], bucket * size + longest)
                yield _table([(key, bucket, at, to)])

    return run


def _table(rows: list[tuple]) -> pa.RecordBatch:
    key, bucket, at, to = zip(*rows)
    lists = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(bucket, pa.int64()), pa.array(at, lists), pa.array(to, lists)], names=["key", "bucket", "at", "to"])


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Maps (key, run, bucket, at, to), sorted -> the map of each run."""
    for (key, run), parts in _groups(batches, 2):
        maps = [(np.array(a, np.int64), np.array(t, np.int64)) for p in parts for a, t in zip(p.column(3).to_pylist(), p.column(4).to_pylist())]
        # What begins after all of the first map begins with the second.
        free = at = np.append(maps[0][0], maps[1][0][:1]) if len(maps) > 1 else maps[0][0]
        for m in maps:
            free = follow(free, *m)
        yield _table([(key, run, at, free)])


def _entering(keys: int):
    """Maps sorted by their key columns -> the end of the last pick before each (``free``), from ``start`` at the first of a key (column after the two lists)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, free = None, NEVER
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                key, (bucket, a, t, start) = row[:keys], row[keys:]
                if key != at:
                    at, free = key, start
                out.append((key[0], bucket, free))
                free = int(follow(np.array([free]), np.array(a, np.int64), np.array(t, np.int64))[0])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), (pa.string(), pa.int64(), pa.int64()))], names=["key", "bucket", "free"])

    return run


def _picks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (key, bucket, free, begin, end, asks, row) with what was picked; one number of state."""
    at, free = None, NEVER
    for batch in batches:
        picked = []
        for key, bucket, start, begin, end, asks in zip(*(batch.column(k).to_pylist() for k in range(6))):
            if (key, bucket) != at:
                at, free = (key, bucket), start
            ok = bool(asks) and begin >= free
            picked.append(ok)
            free = end if ok else free
        yield pa.RecordBatch.from_arrays([batch.column(6), pa.array(picked, pa.bool_())], names=["row", "picked"])


def greedy(rows: DataFrame, begin: str, end: str, order: list[str], longest: int, key: str = "symbol", asks: Column | None = None, name: str = "picked", bucket_ms: int | None = None) -> DataFrame:
    """Adds ``name``: whether the row is picked. Rows of a key are taken by (``begin``, ``order``); of those that ask, one is picked when it begins at or after the end of the last pick.

    ``longest`` bounds end - begin. Null keys are one key; rows without a begin or an end are not picked.
    """
    size = bucket_ms or SPANS_A_BUCKET * max(1, longest)
    if size < longest:
        raise ValueError("a bucket must not be shorter than the longest span")
    at, until = (F.coalesce(F.col(c).cast("bigint"), F.lit(0)) for c in (begin, end))
    asks = F.coalesce(F.lit(True) if asks is None else asks, F.lit(False)) & F.col(begin).isNotNull() & F.col(end).isNotNull()
    x = rows.select(
        F.col(key).cast("string").alias("key"), F.floor(at / F.lit(size)).cast("bigint").alias("bucket"), at.alias("_begin"), until.alias("_end"), asks.alias("_asks"), F.struct(*order).alias("_order"), F.struct(*rows.columns).alias("row"),
    ).repartition("key", "bucket")
    maps = x.sortWithinPartitions("key", "bucket", "_begin", "_order").select("key", "bucket", "_begin", "_end", "_asks").mapInArrow(_maps(size, longest), TABLE)
    maps = maps.withColumn("run", F.floor(F.col("bucket") / BUCKETS_A_RUN).cast("bigint")).repartition("key", "run")
    runs = maps.select("key", "run", "bucket", "at", "to").sortWithinPartitions("key", "run", "bucket").mapInArrow(_composed, TABLE)
    never = F.lit(NEVER).cast("bigint")
    top = runs.repartition("key").sortWithinPartitions("key", "bucket").withColumn("start", never).mapInArrow(_entering(1), "key string, bucket bigint, free bigint")
    top = top.select(F.col("key").alias("k"), F.col("bucket").alias("r"), "free")
    inner = maps.join(top, maps["key"].eqNullSafe(top["k"]) & (maps["run"] == top["r"])).select("key", "run", "bucket", "at", "to", "free")
    frees = inner.repartition("key", "run").sortWithinPartitions("key", "run", "bucket").mapInArrow(_entering(2), "key string, bucket bigint, free bigint")
    frees = frees.select(F.col("key").alias("k"), F.col("bucket").alias("b"), "free")
    ready = x.join(frees, x["key"].eqNullSafe(frees["k"]) & (x["bucket"] == frees["b"]), "left").withColumn("free", F.coalesce("free", never))
    ready = ready.repartition("key", "bucket").sortWithinPartitions("key", "bucket", "_begin", "_order").select("key", "bucket", "free", "_begin", "_end", "_asks", "row")
    picked = ready.mapInArrow(_picks, f"row {rows.schema.simpleString()}, picked boolean")
    return picked.select("row.*", F.col("picked").alias(name))
