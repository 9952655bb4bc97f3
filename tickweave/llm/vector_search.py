"""Exact top-k search: tiled matrix products of query blocks and shards, partial selection per tile, tree merging of the lists of a query.

Every component x becomes floor(scale x), and the score is the integer inner product. Vectors are dealt round robin into shards of ``SHARD`` rows, packed in the narrowest of four number types and stored once;
the queries are read from those shards, so each knows its own row, and dealt into blocks of ``BLOCK``. A group of ``RUN`` shards and a block of queries meet by their two numbers (cogroup): every group is as large as any other, whatever
the ids or values, and each side is sent once for each block or group of the other, which is ``BLOCK`` or ``RUN x SHARD`` products for each vector sent. Inside, a tile is one matrix product: in single
precision where no sum can pass 2^24, in double up to 2^53, else in whole numbers of Python. Rows of a shard are sorted by id, so that a score with the place behind it is a key without ties; each query
keeps the k + 1 highest keys of a tile (its own row may be one) and merges them with its list so far.
Lists of a query are then merged in a tree of fan ``FAN``, so no group holds more than ``FAN x k`` entries. Nothing is collected; the driver sees two counts.

The work is queries x rows, as exact search over all rows asks.

Edge cases: vectors that are null, empty or hold null or non-finite components take no part; of vectors of unequal length the shorter is filled with zeros; rows with equal ids are rows of their own (as queries they give a list each, and find each other);
a null id is never a query and comes last among ties; scores beyond 64 bits are held at the largest or smallest; equal vectors are ties, all of them considered; an empty table, or one without queries, gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

SHARD = 4096
BLOCK = 1024
RUN = 4
FAN = 64
NULL_ID = 2**63 - 1  # stands for a null id inside: last among ties
PACKED = "place long, ids binary, rows long, kind string, vectors binary"
LISTS = "query long, query_id long, part long, found array<struct<below:long,vec_id:long>>"


def quantised(raw: list, scale: float) -> np.ndarray | None:
    """floor(scale x) of a vector's components as doubles; None if it takes no part."""
    if not raw or None in raw:
        return None
    v = np.floor(np.asarray(raw, np.float64) * scale)
    return v if np.isfinite(v).all() else None


def matrix(vectors: list[np.ndarray]) -> np.ndarray:
    """Vectors as rows, filled with zeros, in the narrowest type that holds them."""
    width = max(map(len, vectors))
    out = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    top = float(np.abs(out).max(initial=0))
    kind = next((t for t, most in (("i1", 2**7), ("i2", 2**15), ("i4", 2**31)) if top < most), "f8")
    return out.astype(f"<{kind}")


def unpacked(rows: int, kind: str, vectors: bytes) -> np.ndarray:
    return np.frombuffer(vectors, kind).reshape(rows, -1)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered rows: float32, float64 or, where doubles are too short, int64 held at its ends."""
    width = min(q.shape[1], c.shape[1])
    q, c = q[:, :width], c[:, :width]
    most = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(c.astype(np.float64)).max(initial=0)) * width
    if most < 2**53:
        t = np.float32 if most < 2**24 else np.float64
        return q.astype(t) @ c.astype(t).T
    whole = lambda m: np.array([[int(x) for x in r] for r in m], object).reshape(len(m), width)
    return np.clip(whole(q) @ whole(c).T, -(2**63) + 1, 2**63 - 1).astype(np.int64)


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k highest scores, ties to the smaller column; where scores are too large for that, with all ties of the k-th."""
    n, wide = scores.shape
    if wide <= k:
        return tuple(x.ravel() for x in np.indices(scores.shape))
    if float(np.abs(scores).max(initial=0)) * wide < 2**52:
        at = np.argpartition(scores.astype(np.float64) * wide - np.arange(wide), wide - k, axis=1)[:, wide - k :]
        return np.repeat(np.arange(n), k), at.ravel()
    least = np.partition(scores, wide - k, axis=1)[:, wide - k]
    return np.nonzero(scores >= least[:, None])


def merged(row: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (row, score, id) entries each row's first k, by score from the highest, ties by id."""
    order = np.lexsort((ids, -score, row))
    row, score, ids = row[order], score[order], ids[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row, "left")
    keep = nth < k
    return row[keep], score[keep], ids[keep]


def _pack(scale: float):
    """Rows (place, id, vector) of one task to one packed shard, sorted by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, vectors = None, [], []
        for batch in batches:
            for place, vec_id, raw in zip(*(c.to_pylist() for c in batch.columns)):
                v = quantised(raw, scale)
                if v is not None:
                    part = place
                    ids.append(NULL_ID if vec_id is None else vec_id)
                    vectors.append(v)
        if ids:
            order = np.argsort(np.array(ids), kind="stable")
            m, sorted_ids = matrix(vectors)[order], np.array(ids, "<i8")[order]
            columns = [pa.array([part], pa.int64()), pa.array([sorted_ids.tobytes()], pa.binary()), pa.array([len(ids)], pa.int64()), pa.array([m.dtype.str]), pa.array([m.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["place", "ids", "rows", "kind", "vectors"])

    return run


def _queries(every: int):
    """The queries of packed shards, one row each: the number of their row, their id, and their vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, ids, rows, kind, vectors in zip(*(c.to_pylist() for c in batch.columns)):
                m, ids = unpacked(rows, kind, vectors), np.frombuffer(ids, "<i8")
                at = np.flatnonzero((ids % every == 0) & (ids != NULL_ID))
                one = pa.array([m[k].tobytes() for k in at], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array((place << 32) + at, pa.int64()), pa.array(ids[at], pa.int64()), pa.array([kind] * len(at), pa.string()), one], names=["query", "query_id", "kind", "vector"])

    return run


def _tiles(k: int):
    """Queries (block, query, query_id, kind, vector) and shards of a group -> each query's list over the group."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        part = key[1].as_py()
        own, ids = left.column("query").to_numpy(), left.column("query_id").to_pylist()
        q = matrix([np.frombuffer(v, kind).astype(np.float64) for v, kind in zip(left.column("vector").to_pylist(), left.column("kind").to_pylist())]) if len(ids) else None
        row, score, found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        if q is not None:
            for place, packed, rows, kind, vectors in zip(*(right.column(c).to_pylist() for c in ("place", "ids", "rows", "kind", "vectors"))):
                c, cand = unpacked(rows, kind, vectors), np.frombuffer(packed, "<i8")
                s = products(q, c)
                mine = np.where(own >> 32 == place, own & 0xFFFFFFFF, -1)
                r, at = best(s, k + 1)  # the query's own row may be among them
                other = at != mine[r]
                r, at = r[other], at[other]
                new = s[r, at].astype(np.int64)
                row, score, found = merged(np.concatenate([row, r]), np.concatenate([score, new]), np.concatenate([found, cand[at]]), k)
        starts = np.searchsorted(row, np.arange(len(own) + 1))
        entries = pa.StructArray.from_arrays([pa.array(-score, pa.int64()), pa.array(found, pa.int64())], names=["below", "vec_id"])
        lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), entries)
        return pa.table({"query": pa.array(own, pa.int64()), "query_id": pa.array(ids, pa.int64()), "part": pa.array([part] * len(own), pa.int64()), "found": lists})

    return run


def _first(found: Column, k: int) -> Column:
    return F.slice(F.array_sort(F.flatten(found)), 1, k)


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per query (rows whose id is divisible by ``every``) its ``k`` rows of highest score: query_id, rank from 1, vec_id, score."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shards = -(-n // SHARD)
    dealt = rows.repartition(shards).select(F.spark_partition_id().cast("long").alias("place"), "id", "v")
    packed = stored(dealt.mapInArrow(_pack(scale), PACKED), "shards")
    asked = packed.mapInArrow(_queries(every), "query long, query_id long, kind string, vector binary")
    blocks = max(1, -(-asked.count() // BLOCK))
    groups = -(-shards // RUN)
    numbers = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
    left = asked.repartition(blocks).withColumn("block", F.spark_partition_id().cast("long")).withColumn("part", numbers(groups))
    right = packed.withColumn("part", F.floor(F.col("place") / RUN).cast("long")).withColumn("block", numbers(blocks))
    lists = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(_tiles(k), LISTS)
    while groups > 1:
        groups = -(-groups // FAN)
        lists = lists.groupBy("query", "query_id", F.floor(F.col("part") / FAN).cast("long").alias("part")).agg(_first(F.collect_list("found"), k).alias("found"))
    entries = lists.select("query_id", F.posexplode("found").alias("at", "e"))
    known = F.when(F.col("e.vec_id") != NULL_ID, F.col("e.vec_id"))
    return entries.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), known.alias("vec_id"), (-F.col("e.below")).alias("score"))
