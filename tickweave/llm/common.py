"""Helpers shared by the corpus operators: shared-folder tables, prefix sums, connected components."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

BROADCAST_ROWS = 1_000_000
EDGES_A_TASK = 200_000
_LOCAL: dict[str, str] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; where that is unset a temporary one in local mode (tests), and an error on a cluster."""
    set_ = spark.conf.get("spark.checkpoint.dir", None)
    if set_:
        return set_
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    key = spark.sparkContext.applicationId
    if key not in _LOCAL:
        _LOCAL[key] = "file://" + tempfile.mkdtemp(prefix="tickweave-")
    return _LOCAL[key]


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: cuts the lineage, survives lost executors, makes sizes known."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def few(rows: DataFrame) -> DataFrame:
    """``rows``, to be broadcast if they are few."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def parts_for(spark: SparkSession, rows: int, per_part: int) -> int:
    """Shuffle partitions so that none holds much more than ``per_part`` rows; at least the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_part))


def exclusive_prefix(df: DataFrame, key: str, value: str, out: str, fan: int = 4096) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all rows of a smaller ``key`` (unique, long, 0 or more).

    Keys are summed in runs of ``fan``; the sums are summed in turn until one run is left, so that no task sorts more than ``fan`` rows of a run.
    """
    top = df.agg(F.max(key)).first()[0]
    run = f"_run_{key}"
    w = W.Window.partitionBy(run).orderBy(key).rowsBetween(W.Window.unboundedPreceding, -1)
    small = top is None or top < fan
    runs = df.withColumn(run, F.lit(0).cast("long") if small else F.floor(F.col(key) / F.lit(fan)).cast("long"))
    inner = F.coalesce(F.sum(value).over(w), F.lit(0).cast("long"))
    if small:
        return runs.withColumn(out, inner).drop(run)
    sums = stored(runs.groupBy(run).agg(F.sum(value).alias("_sum")), "prefix")
    base = exclusive_prefix(sums, run, "_sum", f"{run}_base", fan).select(run, f"{run}_base")
    return runs.withColumn(f"{run}_in", inner).join(base, run).withColumn(out, F.col(f"{run}_base") + F.col(f"{run}_in")).drop(run, f"{run}_in", f"{run}_base")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph of long ids: rows ``node, root`` with ``root`` the smallest id reachable.

    Alternating large-star and small-star contraction (Kiveris et al., 2014): each round replaces the edges by
    as many or fewer, every one towards a smaller id, and ends when nothing changes. Edges stay in tables of the shared folder.
    A round's tasks are as many as its edges need (one for each core at least): the many near-empty partitions of late rounds are read by few tasks.
    """
    cores = edges.sparkSession.sparkContext.defaultParallelism
    e = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or tuple(state) == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = tuple(state)
        tasks = max(cores, -(-2 * state[0] // EDGES_A_TASK))
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        star = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(star.coalesce(tasks).distinct().coalesce(tasks), "large")  # large-star
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        star = e.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("s")).select("s.*")
        e = stored(star.filter("u <> v").coalesce(tasks).distinct().coalesce(tasks), "small")  # small-star
    warnings.warn("components had not settled", stacklevel=2)
    raise RuntimeError("connected_components: no fixed point within max_rounds")


def hash_cut(n: int, k: int) -> int:
    """The hash under which about ``k`` of ``n`` rows lie (all, if there are no more)."""
    return 2**63 - 1 if n <= k else -(2**63) + 2**64 * k // n


def smallest(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` rows with the smallest hash of the keys, with the hash as ``_h``. Rows far from the smallest are dropped before any task reports its own ``k``."""
    hashed = df.withColumn("_h", F.xxhash64(*keys))
    return hashed.filter(F.col("_h") <= F.lit(hash_cut(df.count(), 2 * k))).orderBy("_h", *keys).limit(k)
