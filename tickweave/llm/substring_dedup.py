"""Passages that repeat within or across documents: paragraph MinHash banding, exact verification, removal by components.

Units of a text are its lines (paragraphs) of ``least_line`` words or more and winnowed runs of ``RUN`` words.
A unit is named by a hash of its words and its kind. Equal units are found by that name; lines that are merely alike are found by MinHash: ``bands`` of ``rows`` minima of their 5-word shingles,
tuned so that a pair at the threshold collides with a probability of ``recall`` or more. In each bucket the lines are first paired with two anchors, whose choice differs from band to band; buckets
whose lines are not all linked by that are joined in full, by pairs of blocks. So every pair that collides is verified by the exact Jaccard similarity of the shingle sets, or linked already;
components of verified pairs become one passage. The first occurrence of a passage (smallest doc_id, then row and place) is kept. Occurrences that touch are merged into spans.

Runs find passages pasted into the middle of other paragraphs: they are the ``RUN`` words from every place whose word triple has
the smallest hash of ``WINDOW`` neighbouring places (winnowing), so two copies of ``RUN + WINDOW - 1`` = 21 words or more share one, and the shared ones touch and cover all of a copied
passage but at most ``WINDOW - 1`` words at either end. A span is reported if it may have ``least_span`` words: its own, and ``WINDOW - 1`` at each end that is not the end of a whole repeated line.
So every copied passage of ``least_span`` words or more is reported (its torn ends to within 9 words), as is no repeated line of fewer. A chance equality of two 64-bit names makes no span:
it would take several that touch.

Edge cases: null or empty text has no units; null doc_id sorts first among occurrences; every row keeps its spans to itself, also rows of one id and rows without; repeated rows repeat each other's
passages; long texts are read whole; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from .common import BROADCAST_ROWS, connected_components, few, stored
from .hashing import chunks, mix, shingle_hashes, texts_of, word_hashes

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.995
MINIMA = 24
LEAST_LINE = 20
LEAST_SPAN = 51
BLOCK, BLOCK_SHINGLES = 500, 1_000_000  # lines and shingles of a bucket that are joined at a time
RUN = 12
WINDOW = 10
ONE_IN = 64  # texts of which one is read to find names so frequent that their rows are spread
OFTEN = 64  # occurrences there that make a name one of these
SALTS = 64
BUSY = 2_000  # occurrences of a passage from which on its figures are sent to the occurrences


def tune(threshold: float = THRESHOLD, recall: float = RECALL, minima: int = MINIMA) -> tuple[int, int]:
    """(bands, rows): the longest bands with which a pair at the threshold still collides often enough."""
    for rows in range(minima, 0, -1):
        bands = minima // rows
        if 1 - (1 - threshold**rows) ** bands >= recall:
            return bands, rows
    return minima, 1


def lines_of(raw: np.ndarray, offsets: np.ndarray, least_line: int):
    """Lines of enough words of consecutive texts: (first word, last word + 1), and of the words: hash, start, end, row."""
    h, start, end, row = word_hashes(raw, offsets)
    n = len(h)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, h, start, end, row
    line = np.concatenate([[0], np.cumsum(raw == 10)])[start]
    lo = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (line[1:] != line[:-1])]))
    hi = np.append(lo[1:], n)
    long = hi - lo >= least_line
    return lo[long], hi[long], h, start, end, row


def runs_of(h: np.ndarray, row: np.ndarray, run: int = RUN, window: int = WINDOW) -> np.ndarray:
    """First words of the winnowed runs of consecutive texts: in every ``window`` places of a text the leftmost with the smallest hash of three words."""
    n = len(h) - (run + window - 2)
    if n <= 0:
        return np.zeros(0, np.int64)
    m = n + window - 1
    order = mix(mix(h[:m], 6) + mix(h[1 : m + 1], 7) + mix(h[2 : m + 2], 8))
    inside = np.flatnonzero(row[:n] == row[run + window - 2 :])
    return np.unique(inside + np.lib.stride_tricks.sliding_window_view(order, window)[inside].argmin(1))


def names_of(h: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of each run of words."""
    if not len(first):
        return np.zeros(0, np.uint64)
    # Order matters within a run: every word is mixed with its distance from the run's start.
    size = last - first
    at = np.repeat(first, size) + (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
    inner = (at - np.repeat(first, size)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    terms = mix(h[at] ^ mix(inner, 4), 9)
    sums = np.add.reduceat(terms, np.cumsum(size) - size)
    return mix(sums + size.astype(np.uint64), 10)


def _points(raw: np.ndarray) -> np.ndarray:
    """Code points before each byte."""
    return np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])


UNITS = "name long, doc_id long, row long, place long, words long"  # place: start and end in code points; words: first and last, each pair in one number


def _units(least_line: int, runs: bool = True):
    """The units of texts; the lines alone where ``runs`` is false."""
    names = [f.split()[0] for f in UNITS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = TaskContext.get().partitionId() << 40  # numbers of the texts, unique over all tasks
        for batch in batches:
            raw, offsets = texts_of(batch.column(1))
            for lo, hi in chunks(offsets):
                part, at = raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                first, last, h, start, end, of = lines_of(part, at, least_line)
                more = runs_of(h, of) if runs else np.zeros(0, np.int64)
                kind = np.concatenate([np.zeros(len(first), np.int32), np.ones(len(more), np.int32)])
                first, last = np.concatenate([first, more]), np.concatenate([last, more + RUN])
                if not len(first):
                    continue
                row = of[first]
                points = _points(part)
                base, word = points[at[row]], np.searchsorted(of, row)
                pair = lambda lo, hi: pa.array(lo.astype(np.int64) << 32 | hi.astype(np.int64))
                name = (names_of(h, first, last) + kind.astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(name), batch.column(0).take(pa.array(row + lo)), pa.array(rows + lo + row), pair(points[start[first]] - base, points[end[last - 1]] - base), pair(first - word, last - word)], names=names)
            rows += len(batch)

    return run


def _new_lines(least_line: int, words: int):
    """Chunks of a batch of texts: names of the lines, their shingles and where each line's begin and end, and the places of those whose name has not come before in this task (while few)."""
    seen: set[int] = set()

    def lines(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]]:
        raw, offsets = texts_of(column)
        for lo, hi in chunks(offsets):
            part, at = raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            first, last, h, *_ = lines_of(part, at, least_line)
            if not len(first):
                continue
            name = names_of(h, first, last).view(np.int64)
            s, cut = shingle_hashes(h, np.repeat(np.arange(len(first)), last - first), len(first), words) if (last - first).sum() == len(h) else _of_runs(h, first, last, words)
            if len(seen) > 1_000_000:
                seen.clear()
            new = []
            for k, n in enumerate(name.tolist()):
                if n not in seen:
                    seen.add(n)
                    new.append(k)
            if new:
                yield name, s, cut, new

    return lines


def _line_bands(least_line: int, words: int, bands: int, rows: int):
    """(name, band keys) of every line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = _new_lines(least_line, words)
        for batch in batches:
            for name, s, cut, new in lines(batch.column(0)):
                keys = bands_of_lines(s, cut, bands, rows)[new].view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(new) + 1, dtype=np.int32) * bands), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(name[new]), lists], names=["name", "keys"])

    return run


def _line_sets(least_line: int, words: int):
    """(name, packed shingle set) of every line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = _new_lines(least_line, words)
        for batch in batches:
            for name, s, cut, new in lines(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(name[new]), pa.array([np.unique(s[cut[k] : cut[k + 1]]).tobytes() for k in new], pa.binary())], names=["name", "set"])

    return run


def shared(rows: DataFrame, key: str, spread: DataFrame | None = None) -> DataFrame:
    """The rows whose key another row has too: one exchange, and a pass over sorted rows that holds one row. Rows of the keys ``spread``, which are known to have company, are dealt over ``SALTS`` places."""
    salted = rows.withColumn("salt", F.lit(0))
    if spread is not None:
        marked = F.broadcast(spread.select(key, F.lit(True).alias("often")))
        salted = rows.join(marked, key, "left").withColumn("salt", F.when(F.col("often"), F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int") + 1).otherwise(0)).select(*rows.columns, "salt")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, open_ = None, None  # a last row that may have followers; the key of a last row that has some before it
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            k = table.column(key).to_numpy()
            same = np.concatenate([[False], k[1:] == k[:-1], [False]])
            keep = same[:-1] | same[1:] | (table.column("salt").to_numpy() > 0)
            if open_ is not None:
                keep |= k == open_
            held, open_ = (None, k[-1]) if keep[-1] else (table.slice(table.num_rows - 1), None)
            yield from table.filter(pa.array(keep)).drop_columns("salt").combine_chunks().to_batches()

    return salted.repartition(key, "salt").sortWithinPartitions(key).mapInArrow(run, rows.schema)


def often(units: DataFrame) -> DataFrame:
    """Names of units that occur ``OFTEN`` times or more, or the most frequent of them that can be broadcast. Only where rows go depends on these."""
    counted = stored(units.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= OFTEN), "often")
    least = OFTEN
    while (found := counted.filter(F.col("n") >= least)).count() > BROADCAST_ROWS:
        least *= 2
    return found.select("name")


def _of_runs(h: np.ndarray, first: np.ndarray, last: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    size = last - first
    at = np.repeat(first, size) + (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
    return shingle_hashes(h[at], np.repeat(np.arange(len(first)), size), len(first), words)


def bands_of_lines(s: np.ndarray, cut: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """For each line, ``s[cut[k] : cut[k + 1]]`` (none empty), a 64-bit key a band, from the minima of ``bands * rows`` permutations: one pass over all shingles for each permutation."""
    low = np.empty((bands * rows, len(cut) - 1), np.uint64)
    x, y = np.empty_like(s), np.empty_like(s)
    for k in range(bands * rows):
        np.multiply(np.bitwise_xor(s, _XOR[k], out=x), _ODD[k], out=x)
        np.bitwise_xor(x, np.right_shift(x, np.uint64(29), out=y), out=x)
        low[k] = np.minimum.reduceat(x, cut[:-1])
    mixed = mix(low.reshape(bands, rows, -1) * _ODD[:rows, None]).sum(1, dtype=np.uint64)
    return np.ascontiguousarray(mix(mixed + np.arange(bands, dtype=np.uint64)[:, None], 21).T)


_XOR, _ODD = mix(np.arange(256, dtype=np.uint64), 31), mix(np.arange(256, dtype=np.uint64), 32) | np.uint64(1)


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(same >= threshold * (len(x) + len(y) - same))
            pairs = [(p, q) for p, q, k in zip(a, b, keep) if k]
            if pairs:
                p, q = zip(*pairs)
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(q, pa.int64())], names=["a", "b"])

    return run


def link_block(own: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], threshold: float, crossing: bool) -> list[tuple[int, int]]:
    """Pairs (places) at the threshold that link the lines of a block, or of two blocks to each other (``crossing``); pairs that are linked already are left out."""
    m = len(sets)
    size = np.array([len(s) for s in sets])
    _, term = np.unique(np.concatenate(sets), return_inverse=True)
    of = np.repeat(np.arange(m), size)[np.argsort(term, kind="stable")]
    count = np.bincount(term)
    begin = np.cumsum(count) - count
    cut = np.concatenate([[0], np.cumsum(size)])
    comp = np.unique(roots, return_inverse=True)[1]
    out = []
    for i in range(m):
        t = term[cut[i] : cut[i + 1]]
        n = count[t]
        at = np.repeat(begin[t], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        same = np.bincount(of[at], minlength=m)
        alike = same >= threshold * (size[i] + size - same)
        alike[: i + 1] = False
        if crossing:
            alike &= own != own[i]
        for j in np.flatnonzero(alike & (comp != comp[i])).tolist():
            if comp[i] != comp[j]:
                out.append((i, j))
                comp[comp == comp[j]] = comp[i]
    return out


def _join_blocks(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        name, sets = table.column("name").to_pylist(), [np.frombuffer(x.as_py(), np.uint64) for x in table.column("set")]
        crossing = table.column("p")[0].as_py() != table.column("q")[0].as_py()
        pairs = link_block(table.column("own").to_numpy(), table.column("root").to_numpy(), sets, threshold, crossing)
        a, b = [name[i] for i, _ in pairs], [name[j] for _, j in pairs]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def alike_lines(texts: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, least_line: int = LEAST_LINE, words: int = WORDS, block: int = BLOCK) -> DataFrame:
    """Components of lines (by name) that are alike: node, root."""
    bands, rows = tune(threshold, recall)
    keyed = texts.mapInArrow(_line_bands(least_line, words, bands, rows), "name long, keys array<long>")
    entries = stored(shared(keyed.select("name", F.explode("keys").alias("key")), "key"), "bands")  # lines alone in a bucket are left out
    order = F.col("name").bitwiseXOR(F.col("key"))  # another order of the lines in each bucket
    anchors = entries.groupBy("key").agg(F.min(order).alias("lo"), F.max(order).alias("hi")).filter("lo <> hi").select("key", F.col("lo").bitwiseXOR(F.col("key")).alias("a1"), F.col("hi").bitwiseXOR(F.col("key")).alias("a2"))
    pairs = entries.join(anchors, "key").select("name", F.explode(F.array("a1", "a2")).alias("anchor")).filter("name <> anchor")
    pairs = stored(pairs.select(F.least("name", "anchor").alias("a"), F.greatest("name", "anchor").alias("b")).distinct(), "pairs")
    wanted = pairs.select(F.col("a").alias("name")).union(pairs.select("b")).distinct()
    sets = texts.mapInArrow(_line_sets(least_line, words), "name long, set binary")
    sets = stored(sets.join(wanted, "name", "left_semi").dropDuplicates(["name"]), "lines")
    both = pairs.join(sets.select(F.col("name").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("name").alias("b"), F.col("set").alias("y")), "b")
    linked = stored(both.select("a", "b", "x", "y").mapInArrow(_verify(threshold), "a long, b long"), "linked")
    roots = connected_components(linked)
    placed = entries.join(roots, entries["name"] == roots["node"], "left").select("key", "name", F.coalesce("root", "name").alias("root"))
    # Buckets of two lines were joined by their anchors, those of one component need no further pair.
    open_ = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("n > 2 AND lo <> hi").select("key")
    lines = placed.join(open_, "key").join(sets, "name").select("key", "name", "root", "set")
    lines = stored(lines, "open")
    if lines.isEmpty():
        return roots
    need = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("size") / BLOCK_SHINGLES)).cast("int")
    blocks = lines.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("set") / 8).alias("size")).select("key", need.alias("blocks"))
    dealt = lines.join(blocks, "key").withColumn("own", F.pmod(F.xxhash64("name"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "name", "root", "set")
    more = dealt.groupBy("key", "p", "q").applyInArrow(_join_blocks(threshold), "a long, b long")
    return connected_components(linked.unionByName(more))


def repeated_passages(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, least_line: int = LEAST_LINE, least_span: int = LEAST_SPAN, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a span: doc_id, start, end (code points), n_words (found to repeat), component_id, n_occurrences (of its most frequent unit), removed (``least_span`` less torn ends of its words are copies of an earlier occurrence)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    units = rows.mapInArrow(_units(least_line), UNITS)
    alike = stored(alike_lines(rows.select("text"), threshold, recall, least_line, words), "alike")
    copies = stored(shared(units, "name", often(rows.sample(1 / ONE_IN, seed=1).mapInArrow(_units(least_line), UNITS))), "copies")
    # Lines that have no copy but are like another one.
    line = F.shiftright("words", 32) + RUN != F.col("words").bitwiseAND(2**32 - 1)
    names = copies.select("name").distinct()
    single = rows.mapInArrow(_units(least_line, runs=False), UNITS).join(alike.select(F.col("node").alias("name")), "name", "left_semi").join(names, "name", "left_anti")
    every = copies.unionByName(single).join(alike, F.col("name") == F.col("node"), "left").withColumn("passage", F.coalesce("root", "name"))
    low, high = lambda c: F.shiftright(c, 32).cast("int"), lambda c: F.col(c).bitwiseAND(2**32 - 1).cast("int")
    kind = F.when(line, 0).otherwise(1)
    every = every.select("doc_id", "row", "passage", kind.alias("kind"), low("place").alias("start"), high("place").alias("end"), low("words").alias("first"), high("words").alias("last"))
    found = stored(every, "found")
    place = F.struct("doc_id", "row", "first")
    each = stored(found.groupBy("passage").agg(F.count(F.lit(1)).alias("n_occurrences"), F.min(place).alias("_least")), "passages")
    busy = few(each.filter(F.col("n_occurrences") > BUSY))
    found = found.join(busy.select("passage"), "passage", "left_anti").join(each.filter(F.col("n_occurrences") <= BUSY), "passage").unionByName(found.join(busy, "passage"))
    found = found.withColumn("later", ~place.eqNullSafe(F.col("_least"))).drop("_least")
    w = W.Window.partitionBy("row").orderBy("first", F.desc("last"))
    reach = F.max("last").over(w.rowsBetween(W.Window.unboundedPreceding, -1))
    runs = found.withColumn("reach", reach).withColumn("fresh", (F.col("reach").isNull() | (F.col("first") > F.col("reach"))).cast("int")).withColumn("run", F.sum("fresh").over(w))
    covered = F.greatest(F.lit(0), F.col("last") - F.greatest("first", F.coalesce("reach", F.lit(0))))
    line = F.col("kind") == 0
    spans = runs.withColumn("covered", covered).groupBy("doc_id", "row", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("covered").alias("n_words"), F.min("passage").alias("component_id"), F.max("n_occurrences").alias("n_occurrences"),
        F.sum(F.when(F.col("later"), F.col("covered")).otherwise(0)).alias("again"), F.min(F.when(line, F.col("start"))).alias("line_start"), F.max(F.when(line, F.col("end"))).alias("line_end"),
    )
    torn = lambda a, b: F.when(F.col(a) == F.col(b), 0).otherwise(WINDOW - 1)
    spans = spans.withColumn("torn", torn("start", "line_start") + torn("end", "line_end")).filter(F.col("n_words") + F.col("torn") >= least_span)
    return spans.select("doc_id", "start", "end", "n_words", "component_id", "n_occurrences", (F.col("again") + F.col("torn") >= least_span).alias("removed"))
