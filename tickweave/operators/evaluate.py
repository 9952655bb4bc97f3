"""Splits, samples and metrics for models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def regression_metrics(rows: DataFrame, y: str = "target", p: str = "prediction") -> DataFrame:
    """One row: n, mae, r2, corr (0 for a constant side or one row), signAccuracy, and the mean target where the prediction is positive or negative."""
    a, b = F.col(y), F.col(p)
    base = rows.filter(a.isNotNull() & b.isNotNull())
    got = base.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(a - b)).alias("mae"), F.sum((a - b) * (a - b)).alias("_sse"), F.var_pop(a).alias("_var"), F.stddev_pop(a).alias("_sa"), F.stddev_pop(b).alias("_sb"),
        F.covar_pop(a, b).alias("_cov"), F.avg((F.signum(a) == F.signum(b)).cast("double")).alias("signAccuracy"), F.avg(F.when(b > 0, a)).alias("meanWhenPositive"), F.avg(F.when(b < 0, a)).alias("meanWhenNegative"),
    )
    tot = F.col("_var") * F.col("n")
    r2 = F.when(tot > 0, 1 - F.col("_sse") / tot).otherwise(F.when(F.col("_sse") == 0, 1.0).otherwise(0.0))
    corr = F.when((F.col("n") >= 2) & (F.col("_sa") > 0) & (F.col("_sb") > 0), F.col("_cov") / (F.col("_sa") * F.col("_sb"))).otherwise(0.0)
    return got.select("n", "mae", r2.alias("r2"), corr.alias("corr"), "signAccuracy", "meanWhenPositive", "meanWhenNegative")


def confusion(rows: DataFrame, y: str = "target", p: str = "prediction") -> DataFrame:
    return rows.groupBy(F.col(y).cast("int").alias("actual"), F.col(p).cast("int").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def class_report(rows: DataFrame, y: str = "target", p: str = "prediction") -> DataFrame:
    """label, precision, recall, f1, support; an empty denominator gives 0."""
    c = confusion(rows, y, p)
    side = F.explode(F.array(F.struct(F.col("actual").alias("label"), F.lit(1).alias("s"), F.lit(0).alias("q")), F.struct(F.col("predicted").alias("label"), F.lit(0).alias("s"), F.lit(1).alias("q"))))
    per = c.withColumn("_k", side).select("_k.label", (F.col("n") * F.col("_k.s")).alias("support"), (F.col("n") * F.col("_k.q")).alias("called"), F.when((F.col("_k.s") == 1) & (F.col("actual") == F.col("predicted")), F.col("n")).otherwise(0).alias("hit"))
    got = per.groupBy("label").agg(F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("hit").alias("hit"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    pr, rc = ratio(F.col("hit"), F.col("called")), ratio(F.col("hit"), F.col("support"))
    return got.select("label", pr.alias("precision"), rc.alias("recall"), ratio(2 * pr * rc, pr + rc).alias("f1"), "support")


def kth_value(rows: DataFrame, value: Column, k: int) -> tuple[int, int]:
    """(the ``k``-th smallest, from 0, of a long column without nulls; how many are smaller), digit by digit: each pass counts at most 4,096 values of the next 12 bits."""
    u = value.bitwiseXOR(F.lit(-(2**63)))  # in unsigned order
    prefix, below, done = None, 0, 64
    while done > 0:
        width = min(12, done)
        part = rows if prefix is None else rows.filter(F.shiftrightunsigned(u, done) == F.lit(prefix))
        counts = {r["p"] % 2**64: r["n"] for r in part.groupBy(F.shiftrightunsigned(u, done - width).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
        done -= width
        for p in sorted(counts):
            if below + counts[p] > k:
                prefix = p if p < 2**63 else p - 2**64
                break
            below += counts[p]
        else:
            raise ValueError("k is beyond the rows")
    return (prefix % 2**64) - 2**63, below


def exact_median(rows: DataFrame, name: str) -> float | None:
    """The median of a column of finite doubles (the mean of the middle two of an even number), None without any; found by counting the digits of their bits, never by sorting. Reads ``rows`` nine times: give it a table."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.col(name) + F.lit(0.0)).cast("bigint")
    held = rows.filter(F.col(name).isNotNull()).select(F.col(name).alias("x"), F.when(bits < 0, bits.bitwiseXOR(F.lit(2**63 - 1))).otherwise(bits).alias("b"))
    n = held.count()
    if not n:
        return None
    low, below = kth_value(held, F.col("b"), (n - 1) // 2)
    at = held.agg(F.min(F.when(F.col("b") == F.lit(low), F.col("x"))).alias("x"), F.count_if(F.col("b") == F.lit(low)).alias("n"), F.min(F.when(F.col("b") > F.lit(low), F.col("x"))).alias("next")).first()
    return at["x"] if n % 2 or below + at["n"] > n // 2 else (at["x"] + at["next"]) / 2


def exact_sample(rows: DataFrame, fraction: float, key: list[str], seed: int = 42, max_rows: int = 0) -> DataFrame:
    """``round(fraction * n)`` rows (at most ``max_rows`` if positive): those with the smallest hash of the key. The hash of the last one is found by counting; only rows of that very hash are trimmed."""
    total = rows.count()
    n = round(min(max(fraction, 0.0), 1.0) * total)
    n = min(n, max_rows) if max_rows > 0 else n
    if n >= total:
        return rows
    if n <= 0:
        return rows.limit(0)
    h = F.xxhash64(F.lit(seed), *key)
    last, below = kth_value(rows.select(h.alias("h")), F.col("h"), n - 1)
    return rows.filter(h < F.lit(last)).unionByName(rows.filter(h == F.lit(last)).orderBy(*key).limit(n - below))


def _cut(rows: DataFrame, k: int, order: list[str]) -> dict:
    """The values of ``order`` at place ``k`` (from 0), column by column: counted for whole numbers, and read off the counts of the values that are left for others."""
    at = {}
    for name in order:
        kind = dict(rows.dtypes)[name]
        if kind in ("bigint", "int", "smallint", "tinyint"):
            nulls = rows.filter(F.col(name).isNull()).count()
            if k < nulls:
                at[name], rows = None, rows.filter(F.col(name).isNull())
                continue
            value, below = kth_value(rows.filter(F.col(name).isNotNull()).select(F.col(name).cast("bigint").alias("v")), F.col("v"), k - nulls)
            at[name], rows, k = value, rows.filter(F.col(name) == F.lit(value)), k - nulls - below
            continue
        for r in rows.groupBy(name).agg(F.count(F.lit(1)).alias("_n")).orderBy(name).toLocalIterator():  # values at one time
            if k < r["_n"]:
                at[name], rows = r[name], rows.filter(F.col(name).eqNullSafe(F.lit(r[name])))
                break
            k -= r["_n"]
    return at


def _before(rows: DataFrame, k: int, order: list[str]) -> tuple[DataFrame, DataFrame]:
    if k >= rows.count():
        return rows, rows.limit(0)
    at, kinds = _cut(rows.select(*order), k, order), dict(rows.dtypes)
    key, mark = F.struct(*order), F.struct(*[F.lit(at[c]).cast(kinds[c]).alias(c) for c in order])
    return rows.filter(key < mark), rows.filter(key >= mark)


def time_split(rows: DataFrame, test_fraction: float = 0.2, order: tuple[str, ...] = ("entryTime", "symbol", "seq"), embargo_ms: int = 0, least: int = 50) -> tuple[DataFrame, DataFrame]:
    """(train, test): the first rows by time and the rest; the fraction is held to 0.05 to 0.5. ``embargo_ms`` drops training rows that near the cut."""
    n = rows.count()
    if n < least:
        raise ValueError(f"{n} rows are too few to split")
    k = max(1, min(n - 1, int(n * (1 - min(max(test_fraction, 0.05), 0.5)))))
    train, test = _before(rows, k, list(order))
    if embargo_ms:
        cut = test.agg(F.min(order[0])).first()[0]
        train = train.filter(F.col(order[0]) < cut - embargo_ms)
    return train, test


def walk_forward(rows: DataFrame, folds: int = 4, min_train: float = 0.5, order: tuple[str, ...] = ("entryTime", "symbol", "seq")) -> list[tuple[DataFrame, DataFrame]]:
    """Expanding training ranges with the next step as test; none below 100 rows or steps of 5."""
    n = rows.count()
    first = int(n * min(max(min_train, 0.1), 0.95))
    step = (n - first) // max(1, folds)
    if n < 100 or step < 5:
        return []
    out = []
    for k in range(folds):
        train, rest = _before(rows, first + k * step, list(order))
        test = _before(rows, first + (k + 1) * step, list(order))[0] if k < folds - 1 else rows
        key = F.struct(*order)
        low = rest.agg(F.min(key).alias("m")).first()["m"]
        out.append((train, test.filter(key >= F.struct(*[F.lit(low[c]).alias(c) for c in order]))))
    return out


def filled(rows: DataFrame, features: list[str]) -> DataFrame:
    """Features as doubles: not finite becomes null, then 0 with an indicator ``{name}_missing``."""
    from ..functions.coerce import finite

    clean = {f: finite(F.col(f).cast("double")) for f in features}
    return rows.withColumns(clean).withColumns({f"{f}_missing": F.col(f).isNull().cast("double") for f in features}).fillna(0.0, subset=features)


def column_or_null(rows: DataFrame, name: str) -> Column:
    return F.col(name) if name in rows.columns else F.lit(None).cast("double")
