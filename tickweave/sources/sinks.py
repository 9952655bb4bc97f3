"""Sinks: hour-partitioned JSON, labels, trades, datasets, symbol lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.coerce import date_key, hour_key


def write_hourly(rows: DataFrame, path: str, t: str = "time", mode: str = "append", batch: str | int | None = None) -> None:
    """JSON lines under ``date=YYYYMMDD/hour=HH`` by UTC event time; each hour is written by few tasks.

    With ``batch``, a name of this write, hours have a folder for it, and a write of the same name replaces what it wrote before: a job that died half-way (its files are still in a staging folder, or some hours have
    been moved) is run again, and each row is there once. Hours that a changed batch no longer has are emptied.
    """
    keyed = rows.withColumns({"date": date_key(F.col(t)), "hour": hour_key(F.col(t))})
    parts = ["date", "hour"]
    if batch is not None:
        spark = rows.sparkSession
        old = _hours_of(spark, path, str(batch))
        keyed, parts, mode = keyed.withColumn("batch", F.lit(str(batch))), ["date", "hour", "batch"], "overwrite"
    writer = keyed.repartition("date", "hour").write.mode(mode).option("ignoreNullFields", False).partitionBy(*parts)
    if batch is None:
        writer.json(path)
        return
    writer.option("partitionOverwriteMode", "dynamic").json(path)
    if old:
        found = rows.select(date_key(F.col(t)), hour_key(F.col(t))).distinct().collect()  # a row an hour
        now = {f"date={d}/hour={h}" for d, h in found}
        for where in old:
            if not any(f"/{hour}/" in str(where) for hour in now):
                where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _hours_of(spark: SparkSession, path: str, batch: str) -> list:
    """Folders that a batch has under the hours."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/date=*/hour=*/batch={batch}")
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(root)
    return [f.getPath() for f in found or []]


def start_hourly(rows: DataFrame, path: str, checkpoint: str, t: str = "time", every: str | None = "1 second") -> StreamingQuery:
    """A stream written by hours, a micro-batch that is run again in place of itself; all that is there is written and the query ends where ``every`` is None."""
    w = rows.writeStream.foreachBatch(lambda df, number: write_hourly(df, path, t, batch=number)).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if every is None else w.trigger(processingTime=every)).start()


def write_events(rows: DataFrame, path: str, types: list[str] | None = None, mode: str = "append") -> None:
    """Raw events, each once, only the listed types."""
    kept = rows if types is None else rows.filter(F.col("type").isin(types))
    write_hourly(kept, path, mode=mode)


def write_dataset(rows: DataFrame, path: str, kind: str = "parquet", sort: bool = False, mode: str = "error") -> None:
    """A dataset as parquet, csv or jsonl; ``sort`` orders it by entry time across files."""
    out = rows.orderBy("entryTime", "symbol") if sort else rows
    w = out.write.mode(mode)
    if kind == "parquet":
        w.parquet(path)
    elif kind == "csv":
        w.option("header", True).csv(path)
    elif kind == "jsonl":
        w.option("ignoreNullFields", False).json(path)
    else:
        raise ValueError(f"unknown format {kind}")


def write_json(rows: DataFrame, path: str, mode: str = "error") -> None:
    """Labels or trades, nulls kept."""
    rows.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_symbols(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One symbol a line in (rank, pos) order; a list, so one file."""
    rows.orderBy("rank", "pos").select(F.col("symbol").alias("value")).coalesce(1).write.mode(mode).text(path)
