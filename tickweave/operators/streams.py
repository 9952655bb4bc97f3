"""Trailing frames in one streamed pass: partitions sorted by key, bucket and time are read batch by batch, and the rows of one frame are held.

Sums come from differences of running sums, first values and extremes from the frame's ends, found by binary search. Held rows are gone through again only when as many new ones have come, so a row is touched twice on average
however wide its frame is; at most two frames and one batch are in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: From the columns of one key and bucket, in order, to the new columns.
Compute = Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]]


def numbers(column: pa.ChunkedArray) -> np.ndarray:
    """A column as numbers (null: NaN) or as objects."""
    kind = column.type
    if pa.types.is_integer(kind) and not column.null_count or pa.types.is_boolean(kind):
        return column.to_numpy()
    if pa.types.is_floating(kind) or pa.types.is_integer(kind) or pa.types.is_decimal(kind):
        return column.cast(pa.float64()).to_numpy()
    return np.array(column.to_pylist(), object)


def frame_starts(t: np.ndarray, width: int) -> np.ndarray:
    """Place of the first row within ``width`` before each row, both ends included."""
    return np.searchsorted(t, t - width, "left")


def frame_ends(t: np.ndarray) -> np.ndarray:
    """Place after the last row of each row's time."""
    return np.searchsorted(t, t, "right")


def sums(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Sums of ``x[lo:hi]``; NaN counts as nothing."""
    total = np.concatenate([[0], np.cumsum(np.nan_to_num(x.astype(np.longdouble)))])
    return (total[hi] - total[lo]).astype(float)


def extremes(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, of: np.ufunc) -> np.ndarray:
    """``of`` (fmin or fmax) over ``x[lo:hi]`` from a table of runs of powers of two."""
    levels, k = [x], 1
    while 2 * k <= len(x):
        levels.append(of(levels[-1][:-k], levels[-1][k:]))
        k *= 2
    size = hi - lo
    level = np.maximum(0, np.frexp(size.astype(float))[1] - 1)
    out = np.full(len(lo), np.nan)
    for n, row in enumerate(levels):
        at = np.flatnonzero((level == n) & (size > 0))
        out[at] = of(row[lo[at]], row[hi[at] - (1 << n)])
    return out


def _ready(table: pa.Table, by: list[str], t: str, width: int, compute: Compute, reads: list[str], more: bool) -> tuple[list[pa.Table], pa.Table | None]:
    """(finished rows with their new columns, what has to be held) of a stretch of sorted rows; the last time of the last key may go on in the next batch."""
    n = table.num_rows
    change = np.zeros(n, bool)
    for c in [*by, "_bucket"]:
        v = numbers(table.column(c))
        change[1:] |= v[1:] != v[:-1]
    cuts = [0, *np.flatnonzero(change).tolist(), n]
    done, held = [], None
    for a, b in zip(cuts, cuts[1:]):
        part = table.slice(a, b - a)
        at = part.column(t).to_numpy()
        upto = b - a
        if more and b == n:
            upto = int(np.searchsorted(at, at[-1], "left"))
            start = int(np.searchsorted(at, at[-1] - width, "left"))
            fresh = numbers(part.column("_new")).astype(bool)
            fresh[:upto] = False
            held = part.slice(start).set_column(part.schema.get_field_index("_new"), "_new", pa.array(fresh[start:]))
        got = compute({c: numbers(part.column(c)) for c in reads})
        keep = numbers(part.column("_new")).astype(bool) & ~numbers(part.column("_copy")).astype(bool)
        keep[upto:] = False
        out = part.drop_columns(["_new", "_bucket", "_copy"])
        for name, v in got.items():
            out = out.append_column(name, pa.array(v, pa.int64() if v.dtype.kind == "i" else pa.float64(), from_pandas=True))
        done.append(out.filter(pa.array(keep)))
    return done, held


def framed(rows: DataFrame, width: int, compute: Compute, reads: list[str], adds: str, order: list[str], by: list[str] = ["symbol"], t: str = "t") -> DataFrame:  # noqa: B006
    """Bucketed rows (``_bucket``, ``_copy``) with the columns ``adds`` that ``compute`` gives from the columns ``reads``; copies are dropped."""
    kept = [f for f in rows.schema if f.name not in ("_bucket", "_copy")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [adds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, fresh, waiting = None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            fresh.append(table.append_column("_new", pa.array(np.ones(table.num_rows, bool))))
            waiting += table.num_rows
            if held is not None and waiting < held.num_rows:
                continue
            done, held = _ready(pa.concat_tables([*([] if held is None else [held]), *fresh]).combine_chunks(), by, t, width, compute, reads, True)
            fresh, waiting = [], 0
            for out in done:
                yield from out.combine_chunks().to_batches()
        if held is not None or fresh:
            for out in _ready(pa.concat_tables([*([] if held is None else [held]), *fresh]).combine_chunks(), by, t, width, compute, reads, False)[0]:
                yield from out.combine_chunks().to_batches()

    return rows.repartition(*by, "_bucket").sortWithinPartitions(*by, "_bucket", *order).mapInArrow(run, schema)
