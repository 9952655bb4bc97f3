"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset, a temporary folder in local mode and an error on a cluster."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="tickweave-tables-")
    return _LOCAL[app]


class Tables:
    """Tables of one job, dropped together at the end of the ``with`` block or one by one."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def __enter__(self) -> "Tables":
        return self

    def __exit__(self, *_) -> None:
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def write(self, rows: DataFrame, name: str) -> DataFrame:
        """Written as Parquet and read back: computed once, without lineage, there after executors are lost."""
        rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.root}/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.root}/{name}")

    def keep(self) -> "Tables":
        """For results that read the tables later: they go when the application ends."""
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
        return self

    def drop(self, name: str) -> None:
        self._delete(f"{self.root}/{name}")
