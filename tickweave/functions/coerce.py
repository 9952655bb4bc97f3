"""Coercions from JSON values and strings to numbers, and checks on them. All are column expressions; nothing throws under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?)$"


def finite(x: Column) -> Column:
    """``x`` where it is a finite number, else null."""
    return F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def is_finite_num(x: Column) -> Column:
    """True for finite numbers, numeric strings and booleans; false for anything else, null included."""
    s = F.trim(x.cast("string"))
    return F.coalesce(s.isin("true", "false") | (s.rlike(NUMBER) & (F.abs(s.try_cast("double")) < F.lit(float("inf")))), F.lit(False))


def _decimal(s: Column) -> Column:
    return F.when(s.rlike(NUMBER), finite(s.try_cast("double")))


def safe_num_js(x: Column, present: Column | None = None) -> Column:
    """Number of a JSON text value in the loose manner of the live feed: blank and JSON null are 0, ``0x`` and ``0b`` and ``0o`` prefixes count, not finite is null.

    ``present`` tells a JSON null (true) from a missing field (false); without it, null input is missing.
    """
    s = F.trim(x.cast("string"))
    low = F.lower(s)
    based = F.when(low.rlike("^0x[0-9a-f]+$"), F.conv(F.substring(low, 3, 64), 16, 10)).when(low.rlike("^0b[01]+$"), F.conv(F.substring(low, 3, 64), 2, 10)).when(low.rlike("^0o[0-7]+$"), F.conv(F.substring(low, 3, 64), 8, 10)).try_cast("double")
    flag = F.when(low == "true", F.lit(1.0)).when(low == "false", F.lit(0.0))
    value = F.when(s == "", F.lit(0.0)).otherwise(F.coalesce(flag, based, _decimal(s)))
    return value if present is None else F.when(x.isNull() & present, F.lit(0.0)).otherwise(value)


def safe_float(x: Column) -> Column:
    """Number of a value in the strict manner of the offline tools: null and blank are null, underscores between digits are allowed, booleans count, not finite is null."""
    s = F.trim(x.cast("string"))
    plain = F.regexp_replace(s, r"(?<=\d)_(?=\d)", "")
    return F.coalesce(F.when(F.lower(s) == "true", F.lit(1.0)).when(F.lower(s) == "false", F.lit(0.0)), _decimal(plain))


def safe_int(x: Column) -> Column:
    """Whole number; fractions of numeric columns are cut toward zero, fractional strings are null."""
    s = F.trim(x.cast("string"))
    return F.coalesce(F.when(s.rlike(r"^[+-]?\d+$"), s.try_cast("bigint")), F.when(s.rlike(NUMBER) & ~s.rlike(r"^[+-]?\d+$"), s.try_cast("double").try_cast("bigint")))


def parse_number_list(text: str | None, fallback: list[float] | None = None) -> list[float]:
    """Positive numbers of a comma list, unique and sorted."""
    out = set()
    for part in (text or "").split(","):
        try:
            v = float(part)
        except ValueError:
            continue
        if 0 < v < float("inf"):
            out.add(int(v) if v == int(v) else v)
    return sorted(out) or list(fallback or [])


def ensure_default_window(windows: list[int], default: int) -> list[int]:
    return sorted({*windows, default})


def parse_time(x: Column) -> Column:
    """Epoch milliseconds of a number of milliseconds or a date string (UTC); else null."""
    s = F.trim(x.cast("string"))
    return F.coalesce(F.when(s.rlike(r"^\d+$"), s.try_cast("bigint")), F.unix_millis(F.try_to_timestamp(s)))


def utc(t: Column) -> Column:
    """The UTC wall clock of epoch milliseconds, whatever the session's zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.timestamp_millis(t.cast("bigint")).cast("timestamp_ntz"))


def format_ts(t: Column) -> Column:
    """ISO-8601 in UTC; null and 0 give ``n/a``."""
    return F.when(F.coalesce(t, F.lit(0)) == 0, F.lit("n/a")).otherwise(F.date_format(utc(t), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))


def date_key(t: Column) -> Column:
    return F.date_format(utc(t), "yyyyMMdd")


def hour_key(t: Column) -> Column:
    return F.date_format(utc(t), "HH")


def snapshot_id(symbol: Column, t: Column) -> Column:
    return F.concat(F.lit("snap-"), symbol, F.lit("-"), t.cast("string"))
