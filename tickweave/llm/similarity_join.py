"""N-gram Jaccard join of documents: a prefix-tree join over globally ordered shingle sets, and its link components.

Two documents link when their sets of word shingles have a Jaccard similarity of ``percent`` % or more. Sets of shingle hashes stand for the shingles (48 bits and the range of 40 more that they
were sent to).

1. Documents with equal sets form a class; only classes go on (map tasks send a class once).
2. A class more than a fifth of whose shingles are its own cannot link. Three eighths of the shingles (by hash) are enough to show that for nearly all such classes: every (shingle, class)
   of that part goes once to the owner of the shingle's range, as packed bytes; owners report how many of a class's shingles others have too.
   For the classes left, all shingles are sent and counted among themselves, and come back by class in the global order: (frequency, shingle), rarest first.
3. Linking sets share a shingle of their prefixes (the first n - ceil(0.8 n) + 1 in the global order): stars over prefix shingles give candidate groups, whose
   components are found by contraction. No pair is listed.
4. A task gets the sets of a candidate group and joins them in a trie of globally ordered sets, from which each set is looked up: overlaps are summed along shared paths, and a
   subtree is left when what remains on either side cannot reach the bound, or when all its sets are in the component already.
5. A group of more than ``block`` classes is joined in two steps. First it is cut into blocks by hash, with ``ANCHORS`` of its classes in every block; that links all of a family of near copies but stragglers,
   with work in proportion to the group. Then blocks are cut anew by what is linked: a large component has blocks of its own, the small ones share blocks, and a pair of blocks gets a task unless both
   are of one component. So every pair of classes that is not linked yet meets; work grows with the square only of what does not link.
6. Links found make the final components.

Edge cases: null or empty text, or white space alone, has an empty set and links with nothing; fewer words than a shingle count as one shingle; null doc_id joins in but is never a component's
id unless alone (its component id is then null); repeated rows share a class; long texts are read whole; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import connected_components, few, parts_for, stored
from .hashing import mix, shingle_sets

WORDS = 5
PERCENT = 80
BLOCK = 500
ANCHORS = 4
ENTRIES_A_PART = 500_000
LOOK = 3  # eighths of the shingles that the first look takes
BROADCAST_IDS = 2_000_000


def least_overlap(a: int, b: int, percent: int = PERCENT) -> int:
    """The smallest i with 100 i >= percent (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


def own_allowed(n: int, percent: int = PERCENT) -> int:
    """How many shingles of a set of n can be missing from a set that it links with."""
    return n - -(-percent * n // 100)


def class_of(s: np.ndarray) -> int:
    """A 64-bit name of a shingle set, as a signed integer."""
    with np.errstate(over="ignore"):
        x = mix(s, 11).sum(dtype=np.uint64) + mix(np.array([np.bitwise_xor.reduce(mix(s, 12)) if len(s) else 0, len(s)], np.uint64), 13).sum(dtype=np.uint64)
    return int(mix(np.array([x], np.uint64))[0].view(np.int64))


def _part(s: np.ndarray) -> np.ndarray:
    """The shingles that the first look takes."""
    return s[(s >> np.uint64(8)) % np.uint64(8) < np.uint64(LOOK)]


def _sizes(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list((len(s), class_of(s), len(_part(s))) for s in shingle_sets(batch.column(1), words))
            if sets:
                n, c, k = zip(*sets)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(c, pa.int64()), pa.array(k, pa.int64())], names=["doc_id", "n_shingles", "cls", "looked"])

    return run


def _sliced(owner: np.ndarray, ranges: int, make: Callable[[int, int], tuple]) -> Iterator[tuple]:
    """``make(lo, hi)`` for each run of equal owners (sorted)."""
    cut = np.searchsorted(owner, np.arange(ranges + 1))
    for r in range(ranges):
        if cut[r] < cut[r + 1]:
            yield (r, *make(int(cut[r]), int(cut[r + 1])))


PACKED = pa.schema([("part", pa.int32()), ("classes", pa.binary()), ("sizes", pa.binary()), ("which", pa.binary()), ("tokens", pa.binary())])


def _send(classes: list[int], sizes: list[int], sets: list[np.ndarray], ranges: int) -> Iterator[pa.RecordBatch]:
    """The entries of some sets, packed by range: 6 bytes of a shingle and the place of its class in a short list."""
    token = np.concatenate(sets)
    which = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
    owner = ((token >> np.uint64(40)) % np.uint64(ranges)).astype(np.int64)
    order = np.lexsort((token & np.uint64(2**48 - 1), owner))
    token, which, owner = token[order], which[order], owner[order]
    six = np.ascontiguousarray(token.view(np.uint8).reshape(-1, 8)[:, :6])
    c, n = np.array(classes, np.int64), np.array(sizes, np.int32)

    def make(lo: int, hi: int) -> tuple:
        used, place = np.unique(which[lo:hi], return_inverse=True)
        return c[used].tobytes(), n[used].tobytes(), place.astype(np.uint16).tobytes(), six[lo:hi].tobytes()

    rows = list(_sliced(owner, ranges, make))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), PACKED)], schema=PACKED)


def _emit(words: int, ranges: int, look: bool, at_once: int = 500_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()  # bounded: cleared when large
        classes, sizes, sets, held = [], [], [], 0
        for batch in batches:
            for s in shingle_sets(batch.column(0), words):
                if not len(s):
                    continue
                c = class_of(s)
                if c in done:
                    continue
                if len(done) >= 1_000_000:
                    done.clear()
                done.add(c)
                classes.append(c)
                sizes.append(len(s))
                sets.append(_part(s) if look else s)
                held += len(sets[-1])
                if held >= at_once or len(sets) >= 65_000:
                    yield from _send(classes, sizes, sets, ranges)
                    classes, sizes, sets, held = [], [], [], 0
        if sets:
            yield from _send(classes, sizes, sets, ranges)

    return run


SHARED = pa.schema([("part", pa.int32()), ("cls", pa.binary()), ("n", pa.binary()), ("tokens", pa.binary()), ("df", pa.binary())])


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of each range in turn (input sorted by range)."""
    at, held = None, []
    for batch in batches:
        for part, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if part != at and held:
                yield at, held
                held = []
            at = part
            held.append(row)
    if held:
        yield at, held


def _received(part: int, rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, class, size) of all entries of a range; a token is its low 48 bits under its range."""
    token, cls, size = [], [], []
    for c, n, which, six in rows:
        w = np.frombuffer(which, np.uint16)
        t = np.zeros((len(w), 8), np.uint8)
        t[:, :6] = np.frombuffer(six, np.uint8).reshape(-1, 6)
        token.append(t.view(np.uint64).ravel() ^ (mix(np.array([part], np.uint64), 3) << np.uint64(48))[0])
        cls.append(np.frombuffer(c, np.int64)[w])
        size.append(np.frombuffer(n, np.int32)[w])
    return np.concatenate(token), np.concatenate(cls), np.concatenate(size)


def _shared(token: np.ndarray, cls: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(token, class, size, frequency) of the distinct entries whose shingle has two classes or more."""
    order = np.lexsort((cls, token))
    token, cls, size = token[order], cls[order], size[order]
    fresh = np.ones(len(token), bool)
    fresh[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
    token, cls, size = token[fresh], cls[fresh], size[fresh]
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    runs = np.diff(np.append(first, len(token)))
    df = np.repeat(runs, runs)
    many = df >= 2
    return token[many], cls[many], size[many], df[many]


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of a range -> how many of each class's shingles others have too."""
    for part, rows in _by_range(batches):
        cls, shared = np.unique(_shared(*_received(part, rows))[1], return_counts=True)
        if len(cls):
            yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(shared.astype(np.int64))], names=["cls", "shared"])


def _count(ranges: int):
    """Entries of a range -> by class bucket, those whose shingle has two classes or more, with that number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _by_range(batches):
            yield from count(*_received(part, rows))

    def count(*entries: np.ndarray) -> Iterator[pa.RecordBatch]:
        token, cls, size, df = _shared(*entries)
        owner = (cls.view(np.uint64) >> np.uint64(20)) % np.uint64(ranges)
        order = np.lexsort((cls, owner))
        token, cls, size, df, owner = token[order], cls[order], size[order], df[order].astype(np.int32), owner[order]
        rows = list(_sliced(owner, ranges, lambda lo, hi: (cls[lo:hi].tobytes(), size[lo:hi].tobytes(), token[lo:hi].tobytes(), df[lo:hi].tobytes())))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), SHARED)], schema=SHARED)

    return run


SETS = "cls long, n int, own int, tokens binary"


def _gather(percent: int):
    """Class buckets -> the classes that may still link: size, shingles of its own, shared shingles in global order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_range(batches):
            yield from gather(*(np.concatenate([np.frombuffer(x, kind) for x in col]) for col, kind in zip(zip(*rows), (np.int64, np.int32, np.uint64, np.int32))))

    def gather(cls: np.ndarray, n: np.ndarray, token: np.ndarray, df: np.ndarray) -> Iterator[pa.RecordBatch]:
        # A first look by class drops most before anything is sorted.
        _, at, count = np.unique(cls, return_inverse=True, return_counts=True)
        keep = (n - count[at]) <= n - -(-percent * n.astype(np.int64) // 100)
        cls, n, token, df = cls[keep], n[keep], token[keep], df[keep]
        order = np.lexsort((token, df, cls))
        cls, n, token = cls[order], n[order], token[order]
        first = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]])) if len(cls) else np.zeros(0, int)
        rows = [(int(cls[a]), int(n[a]), int(n[a]) - (b - a), token[a:b].tobytes()) for a, b in zip(first, np.append(first[1:], len(cls)))]
        for lo in range(0, len(rows), 1000):
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[lo : lo + 1000]), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=["cls", "n", "own", "tokens"])

    return run


def _prefixes(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            token, cls = [], []
            for c, n, own, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
                t = np.frombuffer(raw, np.int64)[: max(0, own_allowed(n, percent) + 1 - own)]
                token.append(t)
                cls.append(np.full(len(t), c))
            if token:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(token)), pa.array(np.concatenate(cls))], names=["token", "cls"])

    return run


class _Node:
    __slots__ = ("run", "down", "ends", "low", "high", "label")

    def __init__(self, run: np.ndarray):
        self.run, self.down, self.ends = run, {}, []
        self.low, self.high = 1 << 60, 0  # sizes of the sets below
        self.label = None  # a set below, if all below are in one component (by the last look)


class Trie:
    """Path-compressed trie of globally ordered sets (as ranks)."""

    def __init__(self):
        self.root = _Node(np.zeros(0, np.int64))

    def add(self, key: int, ranks: np.ndarray, size: int) -> None:
        node = self.root
        while True:
            node.low, node.high = min(node.low, size), max(node.high, size)
            if not len(ranks):
                node.ends.append((key, size))
                return
            nxt = node.down.get(int(ranks[0]))
            if nxt is None:
                leaf = node.down[int(ranks[0])] = _Node(ranks)
                leaf.low = leaf.high = size
                leaf.ends.append((key, size))
                return
            m = min(len(nxt.run), len(ranks))
            differ = np.flatnonzero(nxt.run[:m] != ranks[:m])
            same = int(differ[0]) if len(differ) else m
            if same < len(nxt.run):  # split the path
                top = _Node(nxt.run[:same])
                top.low, top.high = nxt.low, nxt.high
                nxt.run = nxt.run[same:]
                top.down[int(nxt.run[0])] = nxt
                node.down[int(ranks[0])] = top
                nxt = top
            node, ranks = nxt, ranks[same:]

    def linked(self, has: np.ndarray, size: int, percent: int, mine: Callable[[int], bool]) -> Iterator[int]:
        """Keys of sets that link with a set of ``size`` marked in ``has`` (by rank), but for those ``mine`` says need no look."""
        todo = [(self.root, 0, 0)]  # node, overlap so far, shingles of the path that the set lacks
        while todo:
            node, overlap, lacking = todo.pop()
            if len(node.run):
                got = int(np.count_nonzero(has[node.run]))
                overlap, lacking = overlap + got, lacking + len(node.run) - got
            # the largest overlap still possible with the smallest set below, and what the bound asks of it
            if lacking > own_allowed(node.high, percent) or least_overlap(size, node.low, percent) > min(size, node.high):
                continue
            for key, n in node.ends:
                if not mine(key) and overlap >= least_overlap(size, n, percent):
                    yield key
            for nxt in node.down.values():
                if nxt.ends and not nxt.down and all(mine(k) for k, _ in nxt.ends):
                    continue
                todo.append((nxt, overlap, lacking))


def join_group(keys: list[int], sizes: list[int], sets: list[np.ndarray], percent: int, comps: list[int] | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among some sets; sets of equal ``comps`` are linked already."""
    alphabet, ranks = np.unique(np.concatenate(sets), return_inverse=True)
    # Any one order serves the trie; sets arrive in the global one, rarest first, which is kept as ranks by first position.
    first = np.full(len(alphabet), 1 << 60)
    lengths = [len(s) for s in sets]
    np.minimum.at(first, ranks, np.concatenate([np.arange(n) for n in lengths]))
    order = np.argsort(np.argsort(first * np.int64(len(alphabet) + 1) + np.arange(len(alphabet))))
    ranks = order[ranks]
    cut = np.concatenate([[0], np.cumsum(lengths)])
    first_of: dict[int, int] = {}
    parent = [first_of.setdefault(c, i) for i, c in enumerate(comps if comps is not None else range(len(keys)))]

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    trie, links, has = Trie(), [], np.zeros(len(alphabet), bool)
    for i in sorted(range(len(keys)), key=lambda i: sizes[i]):
        mine = np.sort(ranks[cut[i] : cut[i + 1]])
        has[mine] = True
        for j in trie.linked(has, sizes[i], percent, lambda k, i=i: find(k) == find(i)):
            a, b = find(i), find(j)
            if a != b:
                parent[b] = a
                links.append((keys[i], keys[j]))
        has[mine] = False
        trie.add(i, mine, sizes[i])
    return links


def _join(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def close():
            if len(held) > 1:
                keys, sizes, sets, comps = zip(*held)
                links = join_group(list(keys), list(sizes), list(sets), percent, list(comps))
                if links:
                    a, b = zip(*links)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for root, i, j, cls, n, raw, comp in zip(*(batch.column(k).to_pylist() for k in range(7))):
                if (root, i, j) != at:
                    yield from close()
                    at, held = (root, i, j), []
                held.append((cls, n, np.frombuffer(raw, np.uint64), comp))
        yield from close()

    return run


def _few(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id is among ``ids``, and those without one; the ids are broadcast only while they are few."""
    n = ids.count()
    ids = ids.select(F.col("doc_id").alias("_wanted"))
    ids = F.broadcast(ids) if n <= BROADCAST_IDS else ids
    return rows.join(ids, rows["doc_id"] == ids["_wanted"], "left_semi").unionByName(rows.filter("doc_id IS NULL"))


def _links(sets: DataFrame, tasks: DataFrame, percent: int, parts: int) -> DataFrame:
    """The links that the tasks (root, i, j, cls, comp) find."""
    work = sets.join(tasks, "cls").repartition(parts, "root", "i", "j").sortWithinPartitions("root", "i", "j")
    return stored(work.select("root", "i", "j", "cls", "n", "tokens", "comp").mapInArrow(_join(percent), "a long, b long"), "links")


def _again(large: DataFrame, links: DataFrame, block: int) -> DataFrame:
    """The second step's tasks for classes (cls, root) of large groups, given the links of the first."""
    comps = connected_components(links)
    rows = large.join(comps, large["cls"] == comps["node"], "left").select("cls", large["root"], F.coalesce(comps["root"], "cls").alias("comp"))
    sizes = rows.groupBy("root", "comp").agg(F.count(F.lit(1)).alias("k"))
    own = F.when(F.col("k") * 2 >= block, F.col("comp"))  # a component with blocks of its own
    shared = sizes.filter(own.isNull()).groupBy("root").agg(F.sum("k").alias("rest"))
    rows = stored(rows.join(sizes.withColumn("own", own), ["root", "comp"]).join(shared, "root", "left"), "blocks")
    # Blocks of a root: (own component or null, number); rows of small components of one component id stay together.
    many = F.ceil(F.when(F.col("own").isNotNull(), F.col("k")).otherwise(F.col("rest")) / F.lit(block)).cast("int")
    number = F.pmod(F.xxhash64(F.when(F.col("own").isNotNull(), F.col("cls")).otherwise(F.col("comp"))), many).cast("int")
    rows = rows.withColumn("mine", F.struct(F.coalesce("own", F.lit(None).cast("long")).alias("own"), number.alias("n")))
    blocks = rows.groupBy("root").agg(F.collect_set("mine").alias("all"), F.countDistinct("comp").alias("comps")).filter("comps > 1").select("root", F.sort_array("all").alias("all"))
    rows = rows.join(blocks, "root").withColumn("i", F.array_position("all", F.col("mine")).cast("int"))
    others = F.filter(F.transform("all", lambda x, k: F.struct((k + 1).alias("j"), x["own"].alias("own"))), lambda x: x["own"].isNull() | F.col("own").isNull() | (x["own"] != F.col("own")))
    pairs = rows.select("cls", "root", "comp", "i", F.explode(others["j"]).alias("j"))
    return pairs.select("cls", "root", "comp", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"))


def _components(docs: DataFrame, words: int, percent: int, block: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, cls of every row), and (cls, root, component_id of every class)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sized = stored(rows.mapInArrow(_sizes(words), "doc_id long, n_shingles long, cls long, looked long"), "sizes")
    packed = "part int, classes binary, sizes binary, which binary, tokens binary"
    entries = sized.agg(F.sum("looked")).first()[0] or 0
    n = parts_for(spark, entries, ENTRIES_A_PART)
    tally = rows.select("text").mapInArrow(_emit(words, n, True), packed).repartition(n, "part").sortWithinPartitions("part").mapInArrow(_tally, "cls long, shared long")
    tally = tally.groupBy("cls").agg(F.sum("shared").alias("shared"))
    classes = sized.filter("n_shingles > 0").groupBy("cls", "n_shingles", "looked").agg(F.min("doc_id").alias("doc_id"))
    own = F.col("looked") - F.coalesce("shared", F.lit(0))
    allowed = F.col("n_shingles") - F.ceil(F.col("n_shingles") * F.lit(percent) / F.lit(100)).cast("long")
    open_ = stored(classes.join(tally, "cls", "left").filter(own <= allowed).select("cls", "doc_id", "n_shingles"), "open")
    left = open_.agg(F.sum("n_shingles")).first()[0] or 0
    m = parts_for(spark, left, ENTRIES_A_PART)
    sent = _few(rows, open_.filter("doc_id IS NOT NULL")).select("text").mapInArrow(_emit(words, m, False), packed)
    counted = sent.repartition(m, "part").sortWithinPartitions("part").mapInArrow(_count(m), "part int, cls binary, n binary, tokens binary, df binary")
    sets = stored(counted.repartition(m, "part").sortWithinPartitions("part").mapInArrow(_gather(percent), SETS), "sets")
    prefixes = stored(sets.mapInArrow(_prefixes(percent), "token long, cls long"), "prefixes")
    anchors = prefixes.groupBy("token").agg(F.min("cls").alias("anchor"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    stars = prefixes.join(anchors, "token").filter("cls <> anchor").select(F.col("cls").alias("a"), F.col("anchor").alias("b")).distinct()
    groups = stored(connected_components(stars), "groups")
    size = groups.groupBy("root").agg(F.count(F.lit(1)).alias("k")).withColumn("blocks", F.ceil(F.col("k") / F.lit(block)).cast("int"))
    placed = stored(groups.join(size, "root").select(F.col("node").alias("cls"), "root", "blocks", F.xxhash64("node").alias("h")), "placed")
    zero = F.lit(0)
    tasks = placed.select("cls", "root", F.pmod("h", F.col("blocks")).cast("int").alias("i"), zero.alias("j"), F.col("cls").alias("comp"))
    large = placed.filter("blocks > 1")
    some = not large.isEmpty()
    if some:
        least = large.groupBy("root").agg(*[F.min(F.when(F.pmod("h", F.lit(ANCHORS)) == k, F.col("cls"))).alias(f"_a{k}") for k in range(ANCHORS)], F.first("blocks").alias("blocks"))
        anchors = least.select("root", "blocks", F.explode(F.array(*[f"_a{k}" for k in range(ANCHORS)])).alias("cls")).filter("cls IS NOT NULL")
        anchors = anchors.select("cls", "root", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("i"), zero.alias("j"), F.col("cls").alias("comp"))
        tasks = tasks.unionByName(anchors).distinct()
    links = _links(sets, tasks, percent, m)
    if some:
        links = links.unionByName(_links(sets, _again(large.select("cls", "root"), links, block), percent, m))
    joined = connected_components(links)
    classes = sized.filter("n_shingles > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    named = stored(classes.join(joined, classes["cls"] == joined["node"], "left").select("cls", F.coalesce("root", "cls").alias("root"), "least"), "classes")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return sized, stored(named.join(least, "root").select("cls", "root", "component_id"), "components")


def jaccard_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable over links, itself included)."""
    sized, ids = _components(docs, words, percent, block, id_col, text_col)
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return sized.join(ids.drop("root"), "cls", "left").select("doc_id", "n_shingles", alone.alias("component_id"))


def _named(words: int):
    """(row, text) with the size and the class of the text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(len(s), class_of(s)) for s in shingle_sets(batch.column(1), words)]
            n, c = zip(*sets) if sets else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64()), pa.array(c, pa.int64())], names=["row", "text", "n", "cls"])

    return run


def keep_one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does (its smallest doc_id), all columns; rows without words all stay.

    Rows that share an id, or have none, are told apart by their texts: of those that carry a component's smallest id the one with the first text stays.
    """
    sized, ids = _components(docs, words, percent, block, id_col, text_col)
    twice = stored(sized.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("_twice")), "twice")
    vague = not twice.isEmpty() or not sized.filter("doc_id IS NULL").isEmpty()
    found = sized.join(ids, "cls", "left").filter((F.col("n_shingles") == 0) | (F.col("doc_id") == F.col("component_id")))
    stay = found.select(F.col("doc_id").alias("_stays"))
    if vague:
        twice = few(twice)
        stay = stay.join(twice, stay["_stays"] == twice["_twice"], "left_anti")
    clear = docs.join(stay, docs[id_col] == stay["_stays"], "left_semi")
    if not vague:
        return clear
    own = F.col(f"row.{id_col}").cast("long")
    rows = docs.join(twice, docs[id_col] == twice["_twice"], "left_semi").unionByName(docs.filter(F.col(id_col).isNull()))
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("text", T.StringType()), T.StructField("n", T.LongType()), T.StructField("cls", T.LongType())])
    rows = rows.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text")).mapInArrow(_named(words), schema)
    first = rows.filter("n > 0").join(ids, "cls").filter(own.eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min_by("row", "text").alias("row"))
    return clear.unionByName(rows.filter("n = 0").select("row.*")).unionByName(first.select("row.*"))
