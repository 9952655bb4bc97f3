"""Mixture-controlled packing of tokenised documents into fixed windows, by deficit round-robin over source queues.

Every source is a queue of ids, its documents one after the other. In each round, which is a window, a source's deficit grows by its quantum, ``window * weight``; it sends what the deficit
covers and carries the rest over, so every window holds each source's target share to an id. A source whose quantum is under ``least`` ids saves up for several rounds and sends at least so many at
a time. As all queues are full from the start, the round that sends an id is its place in the queue over the quantum: the whole service order follows from running sums, which are taken in two
levels (by task and source, then by block of rounds). The ids in service order form one stream that is cut every ``window`` ids, so only the last sequence of all can be short. Weights default to
the sources' shares of ids: then every window follows the corpus mix to its end. With other weights a source may run out early; the others go on in turn.

Edge cases: a null or empty text is the end id alone; null source is a source of its own; null doc_id passes through; repeated rows are packed
each; a source without a positive weight gets the smallest weight given (all is packed); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as W

from .common import exclusive_prefix, parts_for, stored

WINDOW = 2048
END_ID = 1
ROUNDS_A_BLOCK = 256
LEAST = 32
CACHE = 400_000


TAIL = ".,!?;:#$%&*|()[]{}\"-+=/\\~^@"  # marks that the pre-tokenizer parts from the letters before them


class WordEncoder:
    """Ids of a text by a ``tokenizers`` file whose pre-tokenizer never joins words across white space.

    Words between ASCII white space are encoded once and kept; plain letters go to the BPE model directly, anything else through the whole tokenizer.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        self.letters = str.maketrans({chr(b): chr(b) for b in printable} | {chr(b): chr(256 + n) for n, b in enumerate(others)})
        self.known: dict[str, bytes] = {}

    def _pack(self, ids: list[int]) -> bytes:
        return array("I", ids).tobytes()

    def _word(self, w: str) -> bytes:
        if w.isalpha() and "İ" not in w and "Σ" not in w and "ς" not in w:
            small = w.lower()
            if small != w and small in self.known:
                return self.known[small]
            if small.isascii():
                return self._pack([t.id for t in self.model.tokenize(small)])
            small = unicodedata.normalize("NFC", small)
            if small.isalpha():
                return self._pack([t.id for t in self.model.tokenize(small.encode().decode("latin1").translate(self.letters))])
        base = w.rstrip(TAIL)
        if base and base != w and base.isalpha() and "İ" not in base:  # its lower case ends in a mark that joins what follows
            return self.word(base) + self.word(w[len(base) :])
        return self._pack(self.whole.encode(w, add_special_tokens=False).ids)

    def word(self, w: str) -> bytes:
        got = self.known.get(w)
        if got is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            got = self._word(w)
            if len(w) <= 64:
                self.known[w] = got
        return got

    def __call__(self, text: str) -> np.ndarray:
        words = text.split()  # splits where the pre-tokenizer does, but for four control characters
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            words = [w.decode() for w in text.encode().split()]
        known = self.known
        return np.frombuffer(b"".join([known.get(w) or self.word(w) for w in words]), np.uint32)


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder a worker process and file, so that its known words serve all tasks of the worker."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _tokenise(path: str, window: int, end_id: int):
    schema = pa.schema([("part", pa.int32()), ("source", pa.string()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("doc_tokens", pa.int64()), ("upto", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, sent = encoder(path), TaskContext.get().partitionId(), {}
        for batch in batches:
            out, size = [], 0
            for doc_id, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id))
                small = ids.astype(np.uint16) if ids.max() < 65_536 else ids
                for at in range(0, len(ids), window):
                    piece = small[at : at + window]
                    sent[source] = sent.get(source, 0) + len(piece)
                    out.append((part, source, doc_id, at, len(piece), len(ids), sent[source], piece.tobytes()))
                size += small.nbytes
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


SEGMENTS = "part int, source string, doc_id long, start long, n long, doc_tokens long, upto long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string, ids binary"


def _pieces(rows: list[tuple], base: int, window: int, with_ids: bool) -> list[tuple]:
    """The pieces of one block of rounds in service order, cut at rounds and windows; ``rows`` come in the order of their queues."""
    ids, lows, sizes, rounds, of = [], [], [], [], []
    for n, (source, doc_id, start, total, at, size, step, every, raw) in enumerate(rows):
        ids.append(np.frombuffer(raw, np.uint16).astype("<u4").tobytes() if len(raw) == 2 * size else raw)
        j = np.arange(max(0, int(at / step) - 1), int((at + size) / step) + 3)
        cuts = np.ceil(j * step).astype(np.int64)
        inner = cuts[(cuts > at) & (cuts < at + size)]
        edge = np.concatenate([[at], inner, [at + size]])
        lows.append(edge[:-1] - at)
        sizes.append(np.diff(edge))
        rounds.append((j[np.searchsorted(cuts, edge[:-1], "right") - 1] + 1) * every)
        of.append(np.full(len(edge) - 1, n))
    low, size, of = np.concatenate(lows), np.concatenate(sizes), np.concatenate(of)
    order = np.argsort(np.concatenate(rounds), kind="stable")
    out, at = [], base
    for low, size, n in zip(low[order].tolist(), size[order].tolist(), of[order].tolist()):
        source, doc_id, start, total = rows[n][:4]
        done = 0
        while done < size:
            room = min(size - done, window - at % window)
            piece = ids[n][4 * (low + done) : 4 * (low + done + room)]
            out.append((doc_id, start + low + done, room, zlib.crc32(piece), total, at // window, at % window, source, piece if with_ids else None))
            done, at = done + room, at + room
    return out


def _cut(window: int, with_ids: bool):
    names = [f.split()[0] for f in PIECES.split(", ")]
    types = [pa.int64()] * 7 + [pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, base, held = None, 0, []

        def close():
            if held:
                out = _pieces(held, base, window, with_ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        for batch in batches:
            for b, start, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if b != block:
                    yield from close()
                    block, base, held = b, start, []
                held.append(tuple(row))
        yield from close()

    return run


def pack(docs: DataFrame, tokenizer: str, weights: dict[str | None, float] | None = None, window: int = WINDOW, end_id: int = END_ID, least: int = LEAST, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source, ids (little-endian uint32)."""
    spark = docs.sparkSession
    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    segments = stored(cols.mapInArrow(_tokenise(tokenizer, window, end_id), SEGMENTS), "segments")
    queue = F.coalesce("source", F.lit("")).alias("queue"), F.col("source").isNull().alias("unnamed")
    by_task = segments.groupBy(*queue, "part").agg(F.max("upto").alias("sent"))
    before = W.Window.partitionBy("queue", "unnamed").orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)
    whole = W.Window.partitionBy("queue", "unnamed")
    base = by_task.select("queue", "unnamed", "part", F.coalesce(F.sum("sent").over(before), F.lit(0)).alias("queued"), F.sum("sent").over(whole).alias("of_source"))
    if weights is None:
        share = F.col("of_source").cast("double")
    else:
        least = min(w for w in weights.values() if w and w > 0)
        share = F.lit(float(least))
        for name, w in weights.items():
            if w and w > 0:
                share = F.when(F.col("unnamed") if name is None else (F.col("queue") == name) & ~F.col("unnamed"), F.lit(float(w))).otherwise(share)
    base = stored(base.withColumn("share", share), "queues")
    total = base.groupBy("queue", "unnamed").agg(F.first("share").alias("share"), F.first("of_source").alias("tokens")).agg(F.sum("share"), F.sum("tokens")).first()
    if total[0] is None:
        return spark.createDataFrame([], PIECES)
    placed = segments.withColumns({"queue": queue[0], "unnamed": queue[1]}).join(base, ["queue", "unnamed", "part"])
    quantum = F.col("share") * F.lit(window / float(total[0]))
    # A source sends ``step`` ids in every ``every``-th round; ``at`` is the segment's place in its queue.
    placed = placed.withColumn("every", F.ceil(F.lit(float(least)) / quantum).cast("long")).withColumns({"every": F.greatest(F.lit(1).cast("long"), "every"), "at": F.col("queued") + F.col("upto") - F.col("n")})
    placed = placed.withColumn("step", quantum * F.col("every"))
    block_of = lambda p: F.floor((F.floor(p / F.col("step")) + 1) * F.col("every") / F.lit(ROUNDS_A_BLOCK)).cast("long")
    first_of = lambda b: F.ceil((F.ceil(b * F.lit(ROUNDS_A_BLOCK) / F.col("every")) - 1) * F.col("step")).cast("long")  # noqa: E731  the first place in the queue that a block sends
    end = F.col("at") + F.col("n")
    placed = placed.withColumn("block", F.explode(F.sequence(F.greatest(F.lit(0).cast("long"), block_of(F.col("at")) - 1), block_of(end) + 1)))
    placed = placed.withColumns({"lo": F.greatest(F.col("at"), F.when(F.col("block") > 0, first_of(F.col("block"))).otherwise(F.col("at"))), "hi": F.least(end, first_of(F.col("block") + 1))}).filter("lo < hi")
    blocks = stored(exclusive_prefix(stored(placed.groupBy("block").agg(F.sum(F.col("hi") - F.col("lo")).alias("ids_in")), "blocks"), "block", "ids_in", "base").select("block", "base"), "bases")
    n = parts_for(spark, int(total[1]), 16_000_000)
    part = F.expr("substring(ids, cast((lo - at) * (octet_length(ids) div n) as int) + 1, cast((hi - lo) * (octet_length(ids) div n) as int))")
    rows = placed.select(
        "block", "queue", "unnamed", "part", "upto", "source", "doc_id", (F.col("start") + F.col("lo") - F.col("at")).alias("start"), "doc_tokens", F.col("lo"), (F.col("hi") - F.col("lo")).alias("n"), "step", "every", part.alias("ids")
    ).repartition(n, "block").join(blocks, "block")
    ordered = rows.sortWithinPartitions("block", "queue", "unnamed", "part", "upto", "lo")
    return ordered.select("block", "base", "source", "doc_id", "start", "doc_tokens", "lo", "n", "step", "every", "ids").mapInArrow(_cut(window, with_ids), PIECES)
