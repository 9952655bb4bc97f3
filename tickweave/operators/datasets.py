"""Training tables: labels joined with snapshot features, context features, completeness and targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import finite
from .asof import Side, asof_many, coalesce_context
from .labels import BARRIER_LABEL_COLUMNS, RETURN_LABEL_COLUMNS
from .windows import trend_at, vol_at

#: The feature names and prefixes of market microstructure.
MICRO_NAMES = ("bestBid", "bestAsk", "spreadPct", "imbalance", "microCompleteness")
MICRO_PREFIXES = ("depth", "flow", "liq", "agg")
LABEL_CODES = {"TP": 1, "SL": 0, "TIME": 2}
#: The label columns that a return dataset carries.
CARRIED = ("horizonMs", "returnPct", "midReturnPct", "longReturnPct", "shortReturnPct", "lagMs")
#: Columns that are never features: keys, targets and anything that a label holds, as that is known only after entry.
NOT_FEATURES = frozenset((
    "type", "symbol", "snapshotId", "entryTime", "seq", "entrySeq", "target", "targetField", "targetMode", "label", "absReturnPct", "eventType", "source", "time", "prediction",
    *RETURN_LABEL_COLUMNS, *BARRIER_LABEL_COLUMNS,
))


def is_micro(name: str) -> bool:
    return name in MICRO_NAMES or name.startswith(MICRO_PREFIXES)


def drop_micro(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.drop(*[c for c in df.columns if is_micro(c) and c not in keep])


def micro_completeness(df: DataFrame, features: list[str]) -> Column:
    """A finite ``microCompleteness`` wins; else the share of the micro columns that are filled (0 without any)."""
    micro = [c for c in features if is_micro(c)]
    share = sum((finite(F.col(c)).isNotNull().cast("int") for c in micro), F.lit(0)) / F.lit(float(len(micro))) if micro else F.lit(0.0)
    return F.coalesce(finite(F.col("microCompleteness")), share) if "microCompleteness" in df.columns else share


def context_features(snapshots: DataFrame, prices: DataFrame, symbols: list[str], windows_ms: dict[str, int], max_lag_ms: int = 300_000) -> DataFrame:
    """Adds price, age, trend and volatility of each context symbol as of every snapshot; only the age is given when it exceeds ``max_lag_ms``.

    Trend and volatility end at the context's last price and start at its first one inside the window before the snapshot's time.
    """
    # Looked up once a distinct time, in buckets of an hour: a context series is the same for all symbols.
    ticks = snapshots.select("t").filter("t IS NOT NULL").distinct()
    sides = [Side(prices.filter(F.col("symbol") == s).withColumn("_one", F.lit(1)), {"price": f"ctx_{s}_price"}, tolerance_ms=max_lag_ms, age=f"ctx_{s}_ageMs") for s in symbols]
    looked = asof_many(ticks.withColumn("_one", F.lit(1)), sides, ["_one"], bucket_ms=3_600_000).drop("_one")
    out = snapshots.join(looked, "t", "left").select(*snapshots.columns, *[c for c in looked.columns if c != "t"])
    for s in symbols:
        own, at = prices.filter(F.col("symbol") == s), ticks.withColumn("symbol", F.lit(s))
        usable = F.col(f"ctx_{s}_price") > 0
        out = out.withColumn(f"ctx_{s}_price", F.when(usable, F.col(f"ctx_{s}_price")))
        for w, ms in windows_ms.items():
            moved = trend_at(at, own, "_", ms, fallback=False).join(vol_at(at, own, "_", ms, 4), ["symbol", "t"]).drop("symbol")
            shown = F.when(F.col(f"ctx_{s}_price").isNotNull(), F.col("trend_")), F.when(F.col(f"ctx_{s}_price").isNotNull() & F.col("trend_").isNotNull(), F.col("vol_"))
            out = out.join(moved, "t", "left").withColumns({f"ctx_{s}_trend_{w}": shown[0], f"ctx_{s}_vol_{w}": shown[1]}).drop("trend_", "vol_")
    return out


def fill_context(df: DataFrame, names: list[str], prefix: str = "ctx_") -> DataFrame:
    return coalesce_context(df, names, prefix)


def target(mode: str = "return", field: str = "longReturnPct", vol_threshold_bps: float = 20.0, ret: str = "returnPct", mid: str = "midReturnPct") -> Column:
    """Training target: the field (else the return), its size, or whether the size reaches a threshold."""
    base = F.coalesce(finite(F.col(ret)), finite(F.col(mid)))
    if mode == "abs_return":
        return F.abs(base)
    if mode == "vol_binary":
        return F.when(base.isNotNull(), (F.abs(base) >= F.lit(vol_threshold_bps / 100)).cast("double"))
    return F.coalesce(finite(F.col(field)), base)


def build_dataset(snapshots: DataFrame, labels: DataFrame, features: list[str], mode: str = "all", min_micro: float = 0.25, target_mode: str = "return", target_field: str = "longReturnPct", vol_threshold_bps: float = 20.0) -> DataFrame:
    """Snapshots (symbol, t, features) with their label and target. ``micro`` keeps rows of enough completeness, ``regime`` drops the micro features; else ``microCompleteness`` is a feature, computed where it is not finite."""
    s = snapshots.select("symbol", F.col("t").alias("entryTime"), *features, micro_completeness(snapshots.select(*features), features).alias("_mc"))
    if mode == "micro":
        s = s.filter(F.col("_mc") >= F.lit(min_micro))
    plain = [f for f in features if f not in CARRIED and f != "microCompleteness" and not (mode == "regime" and is_micro(f))]
    cols = [c for c in CARRIED if c in labels.columns]
    field = F.col(target_field) if target_field in labels.columns else F.lit(None).cast("double")
    joined = s.select("symbol", "entryTime", *plain, "_mc").join(labels.select("symbol", "entryTime", *cols, field.alias("_field")), ["symbol", "entryTime"])
    size = F.abs(F.coalesce(finite(F.col("returnPct")), finite(F.col("midReturnPct"))))
    joined = joined.withColumns({"target": target(target_mode, "_field", vol_threshold_bps), "targetField": F.lit(target_field), "targetMode": F.lit(target_mode), "absReturnPct": size}).filter("target IS NOT NULL AND absReturnPct IS NOT NULL")
    kept = [F.col(f) for f in plain] + ([] if mode == "regime" else [F.col("_mc").alias("microCompleteness")])
    return joined.select("symbol", "entryTime", *cols, "target", "targetField", "targetMode", "absReturnPct", *kept)


def unmatched(snapshots: DataFrame, labels: DataFrame) -> DataFrame:
    """Snapshots without a label."""
    return snapshots.join(labels.select("symbol", F.col("entryTime").alias("t")), ["symbol", "t"], "left_anti")


def build_barrier_dataset(snapshots: DataFrame, labels: DataFrame, features: list[str], side: str = "long", min_micro: float = 0.25, by_seq: bool = False) -> DataFrame:
    """Snapshots with a barrier label as a class code; a row fails the completeness test only if it has one. ``by_seq``: a symbol may have several snapshots at one time, and each gets the label of its own ``seq``."""
    own = [F.col("seq").alias("entrySeq")] if by_seq else []
    s = snapshots.select("symbol", F.col("t").alias("entryTime"), *own, *features)
    if "microCompleteness" in features:
        mc = finite(F.col("microCompleteness"))
        s = s.filter(mc.isNull() | (mc >= F.lit(min_micro)))
    name = f"label{side.capitalize()}"
    code = F.lit(None).cast("int")
    for k, v in LABEL_CODES.items():
        code = F.when(F.col(name) == k, F.lit(v)).otherwise(code)
    keys = ["symbol", "entryTime", "entrySeq"] if by_seq else ["symbol", "entryTime"]
    return s.join(labels.select(*keys, "horizonMs", name), keys).withColumn("target", code).filter("target IS NOT NULL").withColumnRenamed(name, "label")


def feature_columns(df: DataFrame) -> list[str]:
    """Numeric columns that may be features."""
    return [c for c, kind in df.dtypes if kind in ("double", "float", "bigint", "int", "boolean") and c not in NOT_FEATURES]
