"""As-of joins: union of both sides and a running last value, without a join on time. Ties on time: backward takes the last by ``seq``, forward the first."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .framing import carried

DAY_MS = 86_400_000


@dataclass
class Side:
    """A table to look up: its columns (own name: new name), and what is wanted of it."""

    rows: DataFrame
    columns: dict[str, str]
    t: str = "t"
    seq: str = "seq"
    tolerance_ms: int | None = None
    age: str | None = None
    #: With ``left_seq``: rows of a left row's own time count up to its ``seq`` only, not all.
    upto_seq: bool = False


def asof_many(left: DataFrame, sides: list[Side], by: list[str] = ["symbol"], t: str = "t", bucket_ms: int = DAY_MS, left_seq: str | None = None) -> DataFrame:  # noqa: B006
    """Every left row with the columns of the latest row of each side whose time is at most its own (inclusive); nulls before the first.

    All sides share one exchange and one sort. With a tolerance, values older than it are null, while the age (if named) is given anyway.
    """
    names = [f"_r{n}" for n in range(len(sides))]
    key = [F.col(c) for c in by]
    both = left.select(*key, F.col(t).alias("_t"), F.lit(1).alias("_rank"), (F.col(left_seq) if left_seq else F.lit(0)).cast("bigint").alias("_seq"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_l"))
    for name, side in zip(names, sides):
        seq = F.col(side.seq).cast("bigint") if side.seq in side.rows.columns else F.lit(0).cast("bigint")
        value = F.struct(F.col(side.t).alias("_at"), *[F.col(a).alias(b) for a, b in side.columns.items()]).alias(name)
        rows = side.rows.filter(F.col(side.t).isNotNull()).select(*key, F.col(side.t).alias("_t"), F.lit(int(side.upto_seq)).alias("_rank"), seq.alias("_seq"), F.lit(0).alias("_side"), value)
        both = both.unionByName(rows, allowMissingColumns=True)
    both = both.withColumn("_bucket", F.floor(F.col("_t") / F.lit(bucket_ms)).cast("bigint"))
    got = carried(both, names, by, ["_t", "_rank", "_seq", "_side"]).filter("_side = 1")
    out = []
    for name, side in zip(names, sides):
        lag = F.col("_t") - F.col(f"{name}._at")
        fresh = F.lit(True) if side.tolerance_ms is None else lag <= F.lit(side.tolerance_ms)
        out += [F.when(fresh, F.col(f"{name}.{b}")).alias(b) for b in side.columns.values()]
        out += [lag.alias(side.age)] if side.age else []
    return got.select("_l.*", *out)


def asof_backward(left: DataFrame, right: DataFrame, columns: list[str], by: list[str] = ["symbol"], t: str = "t", right_t: str = "t", seq: str = "seq", tolerance_ms: int | None = None, prefix: str = "", age: str | None = None, bucket_ms: int = DAY_MS) -> DataFrame:  # noqa: B006
    """``asof_many`` with one side."""
    return asof_many(left, [Side(right, {c: prefix + c for c in columns}, right_t, seq, tolerance_ms, age)], by, t, bucket_ms)


def asof_forward(left: DataFrame, right: DataFrame, columns: list[str], by: list[str] = ["symbol"], t: str = "t", right_t: str = "t", seq: str = "seq", max_lag: str | None = None, prefix: str = "", lag: str = "lagMs", bucket_ms: int = DAY_MS) -> DataFrame:  # noqa: B006
    """Every left row with ``columns`` and the time of the first right row at or after its time; rows beyond the left column ``max_lag`` are dropped, as are rows without a match."""
    flip = lambda c: -F.col(c)  # noqa: E731  backward in negated time is forward
    back = right.withColumns({"_neg": flip(right_t), "_negseq": -F.col(seq) if seq in right.columns else F.lit(0), "_rt": F.col(right_t)})
    got = asof_backward(left.withColumn("_lt", flip(t)), back, [*columns, "_rt"], by, "_lt", "_neg", "_negseq", prefix=prefix, bucket_ms=bucket_ms)
    got = got.withColumn(lag, F.col(f"{prefix}_rt") - F.col(t)).filter(F.col(lag).isNotNull())
    return (got.filter(F.col(lag) <= F.col(max_lag)) if max_lag else got).drop("_lt").withColumnRenamed(f"{prefix}_rt", f"{prefix}t_found")


def coalesce_context(df: DataFrame, names: list[str], prefix: str) -> DataFrame:
    """Context values fill only what is missing or not finite."""
    from ..functions.coerce import finite

    have = set(df.columns)
    return df.withColumns({n: F.coalesce(finite(F.col(n)), F.col(prefix + n)) if n in have else F.col(prefix + n) for n in names}).drop(*[prefix + n for n in names])
