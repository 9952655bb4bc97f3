"""Data-quality reports over snapshots and events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STALE_MS = 120_000
SKEW_MS = 5_000


def time_span(rows: DataFrame, now_ms: int, t: str = "t", stale_ms: int = STALE_MS, skew_ms: int = SKEW_MS) -> DataFrame:
    """One row: rows, oldest, newest, ageMs, and the warnings ``stale`` and ``future``."""
    got = rows.agg(F.count(F.lit(1)).alias("rows"), F.min(t).alias("oldest"), F.max(t).alias("newest"))
    age = F.lit(now_ms) - F.col("newest")
    return got.withColumns({"ageMs": age, "stale": F.coalesce(age > stale_ms, F.lit(False)), "future": F.coalesce(-age > skew_ms, F.lit(False))})


def count_by_symbol(rows: DataFrame, now_ms: int, t: str = "t", by: str = "symbol") -> DataFrame:
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.min(t).alias("oldest"), F.max(t).alias("newest")).withColumn("ageMs", F.lit(now_ms) - F.col("newest"))


def coverage(rows: DataFrame, features: list[str]) -> DataFrame:
    """feature, present, missing: shares of rows (0 and 1 without rows)."""
    got = rows.agg(F.count(F.lit(1)).alias("_n"), *[F.count(f).alias(f) for f in features])
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), (F.col(f) / F.greatest(F.col("_n"), F.lit(1))).alias("present")) for f in features])
    return got.select(F.explode(pairs).alias("p")).select("p.feature", "p.present", (F.lit(1.0) - F.col("p.present")).alias("missing"))


def expected_vs_seen(expected: DataFrame, seen: DataFrame, by: str = "symbol") -> DataFrame:
    """Symbols on one side only, with ``status`` missing or extra."""
    e, s = expected.select(by).distinct(), seen.select(by).distinct()
    return e.join(s, by, "left_anti").withColumn("status", F.lit("missing")).unionByName(s.join(e, by, "left_anti").withColumn("status", F.lit("extra")))


def alignment(snapshots: DataFrame, events: DataFrame, now_ms: int, stale_ms: int = STALE_MS, symbols: int | None = None) -> DataFrame:
    """Latest snapshot against the latest event of each type (its receipt time where known): lag in ms, or stale."""
    snap = snapshots.groupBy("symbol").agg(F.max("t").alias("latestSnapshot"))
    if symbols is not None:
        snap = snap.orderBy("symbol").limit(symbols)
    seen = events.withColumn("_t", F.coalesce("recvTime", "time") if "recvTime" in events.columns else F.col("time"))
    last = seen.groupBy("symbol", "type").agg(F.max("_t").alias("latestEvent"))
    stale = F.lit(now_ms) - F.col("latestEvent") > stale_ms
    return snap.join(last, "symbol", "left").select("symbol", "type", "latestSnapshot", "latestEvent", F.coalesce(stale, F.lit(False)).alias("stale"), F.when(~stale, F.col("latestSnapshot") - F.col("latestEvent")).alias("lagMs"))


def stale_count(universe: DataFrame, latest: DataFrame, now_ms: int, threshold_ms: int = 15_000, t: str = "t") -> DataFrame:
    """One row: symbols of the universe whose latest value is missing or older than the threshold."""
    last = latest.groupBy("symbol").agg(F.max(t).alias("_t"))
    got = universe.select("symbol").distinct().join(last, "symbol", "left")
    return got.agg(F.count(F.lit(1)).alias("symbols"), F.coalesce(F.sum((F.col("_t").isNull() | (F.lit(now_ms) - F.col("_t") > threshold_ms)).cast("bigint")), F.lit(0)).alias("stale"))


def throughput(rows: DataFrame, period_ms: int, t: str = "t", by: list[str] | None = None) -> DataFrame:
    """Rows a second in each period."""
    period = (F.floor(F.col(t) / F.lit(period_ms)) * period_ms).alias("periodStart")
    return rows.groupBy(*(by or []), period).agg((F.count(F.lit(1)) * 1000.0 / period_ms).alias("perSecond"))
