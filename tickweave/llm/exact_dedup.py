"""Exact de-duplication by an extendible-hash index on shared files (built-in DataFrame operations only).

1. An index entry is (key, doc_id, text), the key being 64 bits of a hash of the text's bytes.
2. The directory starts with one slot. While a bucket holds more than ``capacity`` keys, it is split by the next key bit, and the directory doubles where the bucket already used all its bits,
   as deep as the keys ask for. It is a table: (slot, bucket), a bucket being named by its first slot.
3. Owner tasks get whole buckets, which are ranges of keys. Within a bucket, entries of one key form a chain; the owner compares their texts byte by byte, so that a chain has one link for each
   distinct text: the copies' largest doc_id and their number. Keys of more than ``hot`` rows are first combined in
   ``SALTS`` parts, text by text, so that a text with a third of all rows reaches its owner as a few rows. The list of hot keys is always
   broadcast: where it would be too long, only the hottest of them are on it, as many as can be.
4. Documents probe the chain of their key; within it, a link is addressed by the SHA-256 of its text. Links of many rows are broadcast.
   ``drop_copies`` needs no probe: it sends the entries with their rows, and owners pass on one row a link.

Edge cases: null text counts as empty; null doc_id sorts below any other; of repeated rows (same doc_id and text) exactly one
is kept; an empty table gives an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from . import common
from .common import few, stored

CAPACITY = 4_096
HOT = 256  # rows of one key that are combined before they are sent
SALTS = 64
BYTES_A_TASK = 128 << 20


def slot_of(key: Column, bits: int) -> Column:
    """The first ``bits`` bits of a key."""
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int) -> tuple[int, DataFrame]:
    """(global depth, rows slot, bucket) for distinct keys (column ``key``)."""
    n, bits = keys.count(), 0
    while n > capacity << bits:
        bits += 1
    bits = min(64, bits + 2) if bits else 0
    while True:  # double until no slot alone is overfull
        slots = stored(keys.groupBy(slot_of(F.col("key"), bits).alias("slot")).agg(F.count(F.lit(1)).alias("n")), "slots")
        if bits >= 64 or (slots.agg(F.max("n")).first()[0] or 0) <= capacity:
            break
        bits = min(64, bits + 2)
    # A slot's local depth is one more than the deepest of its prefixes that is overfull.
    prefix = F.explode(F.sequence(F.lit(0), F.lit(bits)))
    each = slots.select("slot", "n", prefix.alias("d")).withColumn("p", F.when(F.col("d") == 0, F.lit(0).cast("long")).otherwise(F.expr(f"shiftrightunsigned(slot, {bits} - d)")))
    full = each.groupBy("d", "p").agg(F.sum("n").alias("n")).filter(F.col("n") > capacity).select("d", "p")
    local = each.join(full, ["d", "p"]).groupBy("slot").agg((F.max("d") + 1).alias("local"))
    found = slots.select("slot").join(local, "slot", "left").withColumn("local", F.least(F.lit(bits), F.coalesce("local", F.lit(0))))
    bucket = F.when(F.col("local") == 0, F.lit(0).cast("long")).otherwise(F.expr(f"shiftleft(shiftrightunsigned(slot, {bits} - local), {bits} - local)"))
    return bits, stored(found.select("slot", bucket.alias("bucket")), "directory")


def key_of(text: Column, key_bits: int) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit(-1 << (64 - key_bits)))


def busiest(counted: DataFrame, n: str, hot: int) -> DataFrame:
    """Rows whose ``n`` is over ``hot``, to be broadcast. Where they are more than can be, over twice, four times as much and so on: what is then left out has at most 2 / BROADCAST_ROWS of all rows."""
    found = stored(counted.filter(F.col(n) > hot), "hot")
    while (top := found.filter(F.col(n) > hot)).count() > common.BROADCAST_ROWS:
        hot *= 2
    return F.broadcast(top)


def salt() -> Column:
    """By the task that read the row: whatever its id is, and no more rows are sent than a task has texts."""
    return F.pmod(F.spark_partition_id(), F.lit(SALTS))


def to_owners(entries: DataFrame, bits: int, slots: DataFrame, size: int) -> DataFrame:
    """Entries dealt by bucket, adding ``bucket``: about ``BYTES_A_TASK`` of ``size`` bytes a task."""
    tasks = max(int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BYTES_A_TASK))
    return entries.withColumn("slot", slot_of(F.col("key"), bits)).join(few(slots), "slot").drop("slot").repartition(tasks, "bucket")


def build_index(docs: DataFrame, digests: DataFrame, id_col: str, text_col: str, capacity: int, hot: int, key_bits: int) -> DataFrame:
    """bucket, key, chain, text_sha256, keep_id, group_size; ``digests`` has key and bytes of every row."""
    keys = stored(digests.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")), "keys")
    bits, slots = directory(keys.select("key"), capacity)
    busy = busiest(keys.select("key", "n"), "n", hot).select("key")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(key_of(text, key_bits).alias("key"), text.alias("text"), F.col(id_col).alias("keep_id"))
    cold = rows.join(F.broadcast(busy), "key", "left_anti").withColumn("n", F.lit(1).cast("long"))
    salted = rows.join(F.broadcast(busy), "key", "left_semi").withColumn("salt", salt())
    combined = salted.groupBy("key", "text", "salt").agg(F.max("keep_id").alias("keep_id"), F.count(F.lit(1)).alias("n")).drop("salt")
    owned = to_owners(cold.unionByName(combined), bits, slots, keys.agg(F.sum("bytes")).first()[0] or 0)
    links = owned.groupBy("bucket", "key", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    chain = F.row_number().over(W.Window.partitionBy("bucket", "key").orderBy("text")).alias("chain")
    return stored(links.select("bucket", "key", chain, F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"), "index")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, hot: int = HOT, key_bits: int = 64) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain. ``key_bits`` shortens the keys (tests of long chains)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    cols = F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), key_of(text, key_bits).alias("key"), F.sha2(text, 256).alias("text_sha256"), F.octet_length(text).cast("long").alias("bytes")
    digests = stored(docs.select(*cols), "digests")
    index = build_index(docs, digests, id_col, text_col, capacity, hot, key_bits)
    # Of repeated rows (same id and text) one is kept: of a link's rows with its keep_id, any one.
    at = ["key", "text_sha256"]
    tops = digests.groupBy(*at).agg(F.max_by("row", "doc_id").alias("top"), F.max("row").alias("last")).select(*at, F.coalesce("top", "last").alias("keep_row"))
    link = stored(index.join(tops, at), "links")
    rows = digests.drop("bytes")
    crowd = busiest(link, "group_size", hot)
    out = rows.join(crowd, at).unionByName(rows.join(F.broadcast(crowd.select(*at)), at, "left_anti").join(link, at))
    return out.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256", "bucket", "chain")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, hot: int = HOT, key_bits: int = 64) -> DataFrame:
    """The rows of ``docs`` that stay, all columns."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keys = docs.select(key_of(text, key_bits).alias("key"), F.octet_length(text).cast("long").alias("bytes"))
    keys = stored(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")), "keys")
    bits, slots = directory(keys.select("key"), capacity)
    busy = busiest(keys.select("key", "n"), "n", hot).select("key")
    rows = docs.select(key_of(text, key_bits).alias("key"), F.struct(*docs.columns).alias("doc"))
    own, id_ = F.coalesce(F.col(f"doc.`{text_col}`"), F.lit("")), F.col(f"doc.`{id_col}`")
    first = lambda df, *by: df.withColumn("_n", F.row_number().over(W.Window.partitionBy(*by).orderBy(id_.desc_nulls_last()))).filter("_n = 1").drop("_n")  # noqa: E731  the group limit works before the exchange too
    crowd = first(rows.join(F.broadcast(busy), "key", "left_semi").withColumn("salt", salt()), "key", own, "salt").drop("salt")
    owned = to_owners(rows.join(F.broadcast(busy), "key", "left_anti").unionByName(crowd), bits, slots, keys.agg(F.sum("bytes")).first()[0] or 0)
    return first(owned, "bucket", "key", own).select("doc.*")
