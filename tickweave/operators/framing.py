"""Event-time frames that scale with a symbol's rows: every symbol is cut into time buckets, with the rows a frame needs from earlier buckets copied in.

A window over ``partitionBy(symbol)`` puts a busy symbol into one task. Here the window is over (symbol, bucket); copies are marked and dropped afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

#: Buckets of this many frame widths: on average one copied row for so many others.
WIDTHS_A_BUCKET = 8


def bucketed(df: DataFrame, width_ms: int, t: str = "t", bucket_ms: int | None = None) -> DataFrame:
    """Adds ``_bucket`` and ``_copy``; a row within ``width_ms`` of its bucket's end is also copied to the next bucket."""
    size = bucket_ms or WIDTHS_A_BUCKET * max(1, width_ms)
    if size < width_ms:
        raise ValueError("a bucket must not be shorter than the frame")
    b = F.floor(F.col(t) / F.lit(size)).cast("bigint")
    own = F.struct(b.alias("bucket"), F.lit(False).alias("copy"))
    near = F.floor((F.col(t) + F.lit(width_ms)) / F.lit(size)).cast("bigint") > b
    places = F.when(near, F.array(own, F.struct((b + 1).alias("bucket"), F.lit(True).alias("copy")))).otherwise(F.array(own))
    return df.withColumn("_p", F.explode(places)).withColumns({"_bucket": F.col("_p.bucket"), "_copy": F.col("_p.copy")}).drop("_p")


def own_rows(df: DataFrame) -> DataFrame:
    return df.filter("NOT _copy").drop("_bucket", "_copy")


def frame(width_ms: int, by: list[str] | None = None, t: str = "t") -> W.WindowSpec:
    """Rows of the last ``width_ms``, both ends included; peers of the current time too."""
    return W.Window.partitionBy(*(by or ["symbol"]), "_bucket").orderBy(t).rangeBetween(-width_ms, 0)


def arrival(width_ms: int | None = None, by: list[str] | None = None, t: str = "t", seq: str = "seq") -> W.WindowSpec:
    """Rows up to the current one in (time, sequence) order."""
    return W.Window.partitionBy(*(by or ["symbol"]), "_bucket").orderBy(t, seq).rowsBetween(W.Window.unboundedPreceding, 0)


def carried(df: DataFrame, names: list[str], by: list[str], order: list[str], bucket: str = "_bucket") -> DataFrame:
    """Fills each named column with its last non-null value at or before the row, over all time of its key: within the bucket, else from the nearest earlier bucket that has one.

    Only one value a bucket crosses buckets. Rows are dealt by bucket once, for their own values and for the ends of the buckets.
    """
    df = df.repartition(*by, bucket)
    inside = W.Window.partitionBy(*by, bucket).orderBy(*order).rowsBetween(W.Window.unboundedPreceding, 0)
    ends = df.groupBy(*by, bucket).agg(*[F.max_by(n, F.when(F.col(n).isNotNull(), F.struct(*order))).alias(n) for n in names])
    before = W.Window.partitionBy(*by).orderBy(bucket).rowsBetween(W.Window.unboundedPreceding, -1)
    ends = ends.select(*by, bucket, *[F.last(n, ignorenulls=True).over(before).alias(f"_before{n}") for n in names])
    got = df.withColumns({n: F.last(n, ignorenulls=True).over(inside) for n in names}).join(ends, [*by, bucket])
    return got.withColumns({n: F.coalesce(n, f"_before{n}") for n in names}).drop(*[f"_before{n}" for n in names])
