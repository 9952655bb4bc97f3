"""Readers: JSON-lines snapshots and events, labels, datasets, tails of logs, symbol files, bars and series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from ..functions.coerce import safe_float, safe_int, safe_num_js
from ..functions.market import mid_price
from . import schemas


def _lines(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """line, file, seq (place in file order: the split's start in the file, then the line's number in the split) of the files under a folder."""
    got = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path)
    return got.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n")).alias("seq"))


def snapshots(spark: SparkSession, path: str, features: list[str] | None = None, with_map: bool = False) -> DataFrame:
    """symbol, t, price, source and the named features as doubles. Blank and broken lines, other types and rows without symbol, time or price are dropped."""
    raw = spark.read.schema(schemas.SNAPSHOT).option("recursiveFileLookup", True).option("pathGlobFilter", "snapshots_*.jsonl").json(path)
    got = raw.filter("type = 'snapshot'").select("symbol", F.col("time").alias("t"), safe_float(F.col("price")).alias("price"), "source", "features")
    got = got.filter("symbol IS NOT NULL AND t IS NOT NULL AND price IS NOT NULL")
    cols = [safe_float(F.col("features")[f]).alias(f) for f in (features or [])]
    return got.select("symbol", "t", "price", "source", *cols, *(["features"] if with_map else []))


def feature_names(rows: DataFrame) -> list[str]:
    """Every feature key that occurs, sorted: the first of two passes for an explicit schema."""
    keys = rows.select(F.explode(F.map_keys("features")).alias("k")).distinct()
    return sorted(r["k"] for r in keys.collect())  # one row a feature, some hundreds


def events(spark: SparkSession, path: str, event_type: str | None = None) -> DataFrame:
    """type, time, recvTime, data (payload as a map of strings; nested parts are JSON text) of raw event logs."""
    glob = f"events_{event_type or '*'}_*.jsonl"
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path)
    outer = F.from_json("value", schemas.EVENT)
    got = raw.select(outer.alias("r")).filter("r.type IS NOT NULL").select("r.type", "r.time", "r.recvTime", F.from_json("r.data", schemas.PAYLOAD).alias("data"))
    return got if event_type is None else got.filter(F.col("type") == event_type)


def event_prices(rows: DataFrame) -> DataFrame:
    """symbol, t, price per event type: trade price, book mid (one-sided: bid), mark price."""
    d = lambda c: safe_float(F.col(f"data.{c}"))
    price = F.when(F.col("type") == "bookTicker", F.coalesce(mid_price(d("b"), d("a")), d("a"))).otherwise(d("p"))
    t = F.coalesce("time", safe_int(F.col("data.E")), safe_int(F.col("data.T")), safe_int(F.col("data.t")))
    return rows.select(F.col("data.s").alias("symbol"), t.alias("t"), price.alias("price")).filter("symbol <> '' AND t IS NOT NULL AND price IS NOT NULL")


def depth_events(spark: SparkSession, path: str) -> DataFrame:
    """Order-book events in the form that the book operators take."""
    got = events(spark, path, "depthUpdate").select("time", F.col("data").alias("d"))
    whole = lambda k: safe_int(F.col(f"d.{k}"))
    levels = lambda k: F.from_json(f"d.{k}", schemas.LEVELS)
    return got.select(
        F.col("d.s").alias("symbol"), F.coalesce(whole("E"), "time").alias("t"), F.coalesce(whole("u"), F.lit(0).cast("bigint")).alias("seq"), F.lit("event").alias("kind"), whole("U").alias("firstId"), whole("u").alias("finalId"),
        whole("pu").alias("prevId"), whole("lastUpdateId").alias("lastUpdateId"), levels("b").alias("b"), levels("a").alias("a"),
    )


def dataset(spark: SparkSession, path: str) -> DataFrame:
    """A dataset by its extension: parquet, csv, or JSON lines."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    if path.endswith(".csv"):
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.json(path)


def tail(spark: SparkSession, path: str, glob: str, files: int = 6, lines: int = 500, block: int = 1 << 16) -> DataFrame:
    """The last ``lines`` lines of the last ``files`` files (by path): file, line. Files are only listed; of those wanted, blocks are read backwards from the end until enough line ends are found.

    What is read, through the driver, is bounded by files x lines asked for, whatever the size of the files.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "length")
    last = listed.orderBy(F.desc("path")).limit(files).collect()
    rows = [(r["path"], line) for r in last for line in _last_lines(spark, r["path"], r["length"], lines, block)]
    return spark.createDataFrame(rows, "file string, line string")


def _last_lines(spark: SparkSession, path: str, length: int, lines: int, block: int) -> list[str]:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        start, data = length, b""
        while start > 0 and data.count(b"\n") <= lines:
            size = min(block, start)
            start -= size
            stream.seek(start)
            data = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size)) + data
    finally:
        stream.close()
    found = data.removesuffix(b"\n").split(b"\n") if data else []
    return [x.removesuffix(b"\r").decode(errors="replace") for x in found[-lines:]]


def symbols(spark: SparkSession, path: str, pattern: str = "^[A-Z0-9]+USDT$") -> DataFrame:
    """symbol, pos: first word of each line that fits the pattern as written; blank lines are skipped."""
    rows = spark.read.text(path).withColumn("pos", F.monotonically_increasing_id())
    word = F.regexp_extract("value", r"^\s*(\S+)", 1)
    return rows.select(F.upper(word).alias("symbol"), "pos", word.alias("_w")).filter(F.col("_w").rlike(pattern)).drop("_w")


def env_config(spark: SparkSession, path: str) -> DataFrame:
    """key, value of KEY=VALUE lines; ``#`` starts a comment line."""
    rows = spark.read.text(path).filter(~F.col("value").rlike(r"^\s*(#|$)") & F.col("value").contains("="))
    return rows.select(F.trim(F.substring_index("value", "=", 1)).alias("key"), F.trim(F.expr("substring(value, instr(value, '=') + 1)")).alias("value"))


#: Event types and the settings that turn them on.
EVENT_FLAGS = (("aggTrade", "ENABLE_AGG_TRADES"), ("bookTicker", "ENABLE_BOOK_TICKER"), ("depthUpdate", "ENABLE_DEPTH"), ("markPriceUpdate", "ENABLE_MARK_PRICE"))


def flag(values: dict[str, str], key: str, default: bool = False) -> bool:
    """A setting that is on when it says true, in any case."""
    return values[key].lower() == "true" if key in values else default


def event_types(config: DataFrame) -> list[str]:
    """The raw event types that settings (key, value: a file of some lines) ask to log, sorted: those on the list, or all if there is none, whose flag is not off."""
    values = {r["key"]: r["value"] for r in config.collect()}
    if not flag(values, "LOG_RAW_EVENTS", True):
        return []
    listed = {v.strip() for v in values.get("LOG_RAW_EVENTS_TYPES", "").split(",") if v.strip()} or {t for t, _ in EVENT_FLAGS}
    return sorted(t for t, key in EVENT_FLAGS if t in listed and flag(values, key, True))


def pick_features(rows: DataFrame, names: list[str] | None = None, extra: str | None = None) -> DataFrame:
    """Rows with a ``features`` map: only the ``names`` given stay; ``extra``, another map column, fills what is missing or no number."""
    kept = F.col("features")
    if extra:
        kept = F.map_concat(F.map_filter(extra, lambda k, v: safe_float(F.col("features")[k]).isNull()), F.map_filter(kept, lambda k, v: safe_float(v).isNotNull() | ~F.array_contains(F.map_keys(extra), k)))
    if names is not None:
        kept = F.map_filter(kept, lambda k, v: k.isin(names))
    return rows.withColumn("features", kept)


def open_interest(rows: DataFrame) -> DataFrame:
    """Open-interest history from endpoint rows (symbol, timestamp, sumOpenInterest, openInterest): the sum, else the plain field; rows without a time are dropped."""
    col = lambda c: safe_num_js(F.col(c)) if c in rows.columns else F.lit(None).cast("double")
    got = rows.select("symbol", col("timestamp").cast("bigint").alias("t"), F.coalesce(col("sumOpenInterest"), col("openInterest")).alias("openInterest"))
    return got.filter("t IS NOT NULL")


def exchange_universe(rows: DataFrame, suffix: str = "USDT") -> DataFrame:
    """symbol, pos: the symbols of an exchange-information document (``symbols``: array of structs, or a row a symbol) that end in the quote asset, in its order."""
    if "symbols" in rows.columns:
        got = rows.select(F.posexplode("symbols").alias("pos", "s")).select(F.col("s.symbol").alias("symbol"), F.col("pos").cast("bigint").alias("pos"))
    else:
        got = rows.select("symbol", F.monotonically_increasing_id().alias("pos"))
    return got.filter(F.col("symbol").endswith(suffix))


#: What each polled endpoint gives, by the endpoint's field names.
POLLED = {
    "openInterest": {"openInterest": "openInterest"},
    "premiumIndex": {"markPrice": "markPrice", "indexPrice": "indexPrice", "fundingRate": "lastFundingRate", "nextFundingTime": "nextFundingTime"},
    "stats24h": {"changePct24h": "priceChangePercent", "high24h": "highPrice", "low24h": "lowPrice", "volume24h": "volume", "quoteVolume24h": "quoteVolume", "last": "lastPrice"},
}


def polled(rows: DataFrame, kind: str) -> DataFrame:
    """Answers of a polled endpoint (symbol, polledAt, body: JSON text) as a typed table at the poll's own clock; answers that are no JSON object are dropped.

    Works on a batch and on a stream. ``premiumIndex`` rows go into the mark table beside the mark-price events: ``unionByName`` both, the latest by arrival counts.
    """
    body = F.from_json("body", "MAP<STRING, STRING>")
    fields = [safe_num_js(F.col("_b")[theirs]).alias(ours) for ours, theirs in POLLED[kind].items()]
    return rows.withColumn("_b", body).filter("_b IS NOT NULL AND symbol IS NOT NULL").select("symbol", F.col("polledAt").cast("bigint").alias("t"), F.col("polledAt").cast("bigint").alias("recvTime"), *fields)


def funding(rows: DataFrame, period_ms: int = 28_800_000) -> DataFrame:
    """Funding series with the next funding time."""
    return rows.select("symbol", F.col("time").cast("bigint").alias("t"), safe_float(F.col("fundingRate")).alias("fundingRate")).withColumn("nextFundingTime", F.col("t") + period_ms)
