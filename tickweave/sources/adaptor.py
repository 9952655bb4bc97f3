"""The time-series form of the driver's ``events`` table, for queries that are checked against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, t, seq, price, qty, side."""
    e = table(spark, sf_dir, "events")
    t = F.unix_millis(F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp"))  # the stored wall clock is UTC, whatever the session's zone
    return e.select(F.col("event_type").alias("symbol"), t.alias("t"), F.col("event_id").alias("seq"), (F.col("value") + 100).alias("price"), F.get_json_object("props", "$.k").cast("double").alias("qty"), F.when(F.col("user_id") % 2 == 0, "BUY").otherwise("SELL").alias("side"))
