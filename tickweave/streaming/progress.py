"""Progress of running queries as a table: a listener appends a row for every finished micro-batch."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = "query string, runId string, batchId bigint, at string, inputRows bigint, durationMs bigint, stateRows bigint, lateRows bigint, watermark string"


class ProgressTable(StreamingQueryListener):
    """``spark.streams.addListener(ProgressTable(spark, path))``: rows are kept until there are ``every``, or a query ends, and then appended as JSON lines."""

    def __init__(self, spark: SparkSession, path: str, every: int = 20):
        self.spark, self.path, self.every, self.rows = spark, path, every, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        state = p.get("stateOperators", [])
        total = lambda k: sum(s.get(k, 0) for s in state)
        self.rows.append((p.get("name"), p["runId"], p["batchId"], p["timestamp"], p["numInputRows"], p.get("durationMs", {}).get("triggerExecution", 0), total("numRowsTotal"), total("numRowsDroppedByWatermark"), p.get("eventTime", {}).get("watermark")))
        if len(self.rows) >= self.every:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").option("ignoreNullFields", False).json(self.path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS).json(path).withColumn("at", F.to_timestamp("at"))


def throughput(progress: DataFrame, minutes: int = 1) -> DataFrame:
    """Rows, rows a second of work, and rows that came too late, by query and window of time."""
    rows = progress.groupBy("query", F.window("at", f"{minutes} minutes").alias("w")).agg(F.sum("inputRows").alias("rows"), F.sum("durationMs").alias("ms"), F.sum("lateRows").alias("lateRows"), F.max("stateRows").alias("stateRows"))
    return rows.select("query", F.col("w.start").alias("since"), "rows", F.when(F.col("ms") > 0, F.col("rows") * 1000 / F.col("ms")).alias("rowsASecond"), "lateRows", "stateRows")
