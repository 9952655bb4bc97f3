"""Symbol universes: top by volume, ordered unions, codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

PATTERN = "^[A-Z0-9]+USDT$"


def valid(df: DataFrame, symbol: str = "symbol", pattern: str = PATTERN) -> DataFrame:
    return df.filter(F.col(symbol).rlike(pattern))


def top_by_volume(stats: DataFrame, n: int, volume: str = "quoteVolume", symbol: str = "symbol") -> DataFrame:
    """symbol, pos: the ``n`` largest by volume, ties by name."""
    top = stats.filter(F.col(volume).isNotNull()).orderBy(F.desc(volume), symbol).limit(n)
    return top.select(F.col(symbol).alias("symbol"), F.row_number().over(W.Window.orderBy(F.desc(volume), symbol)).alias("pos"))  # n rows at most


def ordered_union(sources: list[DataFrame], pattern: str | None = PATTERN) -> DataFrame:
    """symbol, rank, pos: each symbol (upper-cased) at its first source and place; sources are symbol, pos."""
    both = None
    for rank, df in enumerate(sources):
        part = df.select(F.upper(F.trim("symbol")).alias("symbol"), F.lit(rank).alias("rank"), F.col("pos").cast("bigint").alias("pos"))
        both = part if both is None else both.unionByName(part)
    if pattern:
        both = valid(both, pattern=pattern)
    return both.groupBy("symbol").agg(F.min(F.struct("rank", "pos")).alias("_f")).select("symbol", "_f.rank", "_f.pos")


def frozen(context: list[str], top: DataFrame) -> DataFrame:
    """Context symbols first, then the top ones, without repeats."""
    first = top.sparkSession.createDataFrame([(s, n) for n, s in enumerate(context)], "symbol string, pos bigint")
    return ordered_union([first, top], None)


def codes(categories: DataFrame, symbol: str = "symbol") -> DataFrame:
    """symbol, symbolCode: place in sorted order. Categories are a dimension: one row a symbol."""
    return categories.select(symbol).filter(F.col(symbol).isNotNull()).distinct().withColumn("symbolCode", F.row_number().over(W.Window.orderBy(symbol)) - 1)


def encode(rows: DataFrame, table: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Adds symbolCode; unseen symbols get -1."""
    return rows.join(table, symbol, "left").withColumn("symbolCode", F.coalesce("symbolCode", F.lit(-1)))


def latest_of(rows: DataFrame, columns: list[str], by: list[str] = ["symbol"], order: tuple[str, ...] = ("t", "seq")) -> DataFrame:  # noqa: B006
    """The last row of each key."""
    return rows.groupBy(*by).agg(F.max(F.struct(*order, *columns)).alias("_l")).select(*by, *[F.col(f"_l.{c}").alias(c) for c in (*order, *columns)])
