"""Non-overlapping positions per symbol, and the summary of their returns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions.coerce import finite
from ..functions.market import select_return
from .evaluate import exact_median
from .greedy import greedy
from .tables import Tables


def signals(rows: DataFrame, long_threshold: float = 0.0, short_threshold: float = 0.0, short_enabled: bool = True, extra_cost_bps: float = 0.0) -> DataFrame:
    """Rows (symbol, entryTime, seq, horizonMs, prediction, returns) that would trade: action and realizedPct. Long wins where both thresholds are met."""
    action = F.when(F.col("prediction") >= F.lit(long_threshold), "long")
    if short_enabled:
        action = action.when(F.col("prediction") <= F.lit(-short_threshold), "short")
    got = rows.filter((F.col("symbol") != "") & F.col("entryTime").isNotNull() & (F.col("horizonMs") > 0) & finite(F.col("prediction")).isNotNull()).withColumn("action", action).filter("action IS NOT NULL")
    realized = select_return(F.col("action"), F.col("longReturnPct"), F.col("shortReturnPct"), F.col("returnPct")) - F.lit(extra_cost_bps / 100)
    return got.withColumn("realizedPct", finite(realized)).filter("realizedPct IS NOT NULL").withColumn("exitTime", F.col("entryTime") + F.col("horizonMs"))


def non_overlapping(candidates: DataFrame, longest_ms: int | None = None, bucket_ms: int | None = None) -> DataFrame:
    """Greedy selection in time order: a position blocks its symbol until its exit (an entry at the exit is allowed). ``longest_ms`` bounds the horizons; where it is not given it is looked up.

    The candidates are stored once, as they are read for the longest horizon, for the maps and for the picks: their labels would be worked out anew each time.
    """
    names = ["symbol", "action", "entryTime", "exitTime", "prediction", "realizedPct", "seq"]
    rows = Tables(candidates.sparkSession, "candidates").keep().write(candidates.select(*names), "rows")
    if longest_ms is None:
        longest_ms = rows.agg(F.max(F.col("exitTime") - F.col("entryTime"))).first()[0] or 1
    return greedy(rows, "entryTime", "exitTime", ["seq"], longest_ms, bucket_ms=bucket_ms).filter("picked").drop("picked")


def summary(trades: DataFrame) -> DataFrame:
    """One row: trades, hitRate, meanPct, medianPct, stdPct (population), sharpeLike, cumPct, maxDrawdownPct; zeros without trades.

    The equity curve runs over (entryTime, symbol, seq); its peak starts at its first value. Equity is summed in two levels, by day and within the day.
    The trades are stored once, for the passes that count out the median.
    """
    trades = Tables(trades.sparkSession, "trades").keep().write(trades.select("entryTime", "symbol", "seq", "realizedPct"), "rows")
    median = exact_median(trades, "realizedPct")
    r = F.col("realizedPct")
    day = F.floor(F.col("entryTime") / F.lit(86_400_000)).cast("bigint")
    rows = trades.withColumn("_d", day)
    order = ["entryTime", "symbol", "seq"]
    inside = W.Window.partitionBy("_d").orderBy(*order).rowsBetween(W.Window.unboundedPreceding, 0)
    local = rows.withColumn("_eq", F.sum("realizedPct").over(inside))
    local = local.withColumn("_peak", F.max("_eq").over(inside)).withColumn("_dd", F.col("_eq") - F.col("_peak"))
    days = local.groupBy("_d").agg(F.sum("realizedPct").alias("total"), F.max("_eq").alias("top"), F.min("_dd").alias("dd"))
    so_far = W.Window.orderBy("_d").rowsBetween(W.Window.unboundedPreceding, -1)  # one row a day
    days = days.withColumn("base", F.coalesce(F.sum("total").over(so_far), F.lit(0.0))).withColumn("peak0", F.max(F.col("base") + F.col("top")).over(so_far))
    lowest = local.groupBy("_d").agg(F.min("_eq").alias("low"), F.min_by("_eq", F.struct(*order)).alias("first"))
    # Against an earlier peak the worst point of a day is its lowest; against its own peaks it is its own drawdown.
    worst = days.join(lowest, "_d").agg(F.min(F.least("dd", F.coalesce(F.col("base") + F.col("low") - F.col("peak0"), F.col("dd")))).alias("maxDrawdownPct"))
    stats = trades.agg(
        F.count(F.lit(1)).alias("trades"), F.avg((r > 0).cast("double")).alias("hitRate"), F.avg(r).alias("meanPct"), F.lit(median).cast("double").alias("medianPct"), F.stddev_pop(r).alias("stdPct"), F.sum(r).alias("cumPct")
    )
    sharpe = F.when(F.col("stdPct") > 0, F.col("meanPct") / F.col("stdPct") * F.sqrt(F.col("trades").cast("double")))
    out = stats.withColumn("sharpeLike", sharpe).join(worst)
    return out.select("trades", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("hitRate", "meanPct", "medianPct", "stdPct", "sharpeLike", "cumPct", "maxDrawdownPct")])


def run_backtest(rows: DataFrame, long_threshold: float = 0.0, short_threshold: float = 0.0, extra_cost_bps: float = 0.0, short_enabled: bool = True) -> DataFrame:
    return non_overlapping(signals(rows, long_threshold, short_threshold, short_enabled, extra_cost_bps))
