"""Gradient-boosted trees on tables, with missing values and several classes in one model.

1. Features are cut at approximate quantiles, all in one aggregate; every row is stored once as a byte a feature (the last byte value says missing), its target, and its margins so far.
2. A level of the trees of all classes is one pass: tasks add up gradients by (class, node, feature, bin) and send one row for each (class, node, feature); their sums give the best cut of each, and
   the driver gets one row for each class and node. Gradients are whole numbers of 2**-20, so the sums, and with them the trees, do not depend on how rows lie in tasks.
3. A cut tries missing values on both sides and keeps the better one; where a node has none, those that come later follow the larger side.
4. Every ``REFRESH`` rounds margins are written anew, so that a pass works through that many rounds of trees and no more.

A task holds 24 bytes for each (class, node of the level, feature, bin): 15 MB with three classes, six levels, 100 features and 64 bins.

Edge cases: values that are no finite numbers are missing; a feature of one value, or of none, is never cut; rows without a target take no part; without any row with one there is no model (ValueError);
one class only gives a constant; columns that are missing when scoring count as missing values; equal rows get equal predictions; an empty table is scored to an empty one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import finite
from .evaluate import column_or_null
from .tables import Tables

UNIT = float(2**20)
REFRESH = 10
MAX_CLASSES = 100
ACCURACY = 10_000  # of the quantiles
CURVATURE = 1e-3  # the least sum of it on a side


@dataclass
class Tree:
    """A complete binary tree in arrays by node: feature (-1: none), last bin that goes left, whether missing values go left, value."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> "Tree":
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, int), np.zeros(n, bool), np.zeros(n))

    def nodes(self, binned: np.ndarray, missing: int, levels: int) -> np.ndarray:
        """The node of each row after ``levels`` steps, or the leaf before."""
        at, rows = np.zeros(len(binned), int), np.arange(len(binned))
        for _ in range(levels):
            f = self.feature[at]
            b = binned[rows, np.maximum(f, 0)]
            left = np.where(b == missing, self.missing_left[at], b <= self.cut[at])
            at = np.where(f >= 0, 2 * at + 2 - left, at)
        return at


@dataclass
class Boosted:
    """A fitted model: ``rounds`` holds one tree for each output and round; ``classes`` is None for a regression."""

    features: list[str]
    edges: list[np.ndarray]
    bins: int
    depth: int
    base: np.ndarray
    scale: float = 1.0
    classes: list[float] | None = None
    rounds: list[list[Tree]] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for f, edges in enumerate(self.edges):
            out[:, f] = np.where(np.isfinite(x[:, f]), np.searchsorted(edges, x[:, f], "left"), self.bins)
        return out

    def add(self, margins: np.ndarray, binned: np.ndarray, first: int = 0) -> np.ndarray:
        """Margins (rows x outputs) with the trees from round ``first`` on added."""
        out = margins.copy()
        for trees in self.rounds[first:]:
            for k, tree in enumerate(trees):
                out[:, k] += tree.value[tree.nodes(binned, self.bins, self.depth)]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        m = self.add(np.tile(self.base, (len(x), 1)), self.binned(x))
        return m[:, 0] * self.scale if self.classes is None else np.asarray(self.classes, float)[m.argmax(1)]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Rows x classes, in the order of ``classes``."""
        m = self.add(np.tile(self.base, (len(x), 1)), self.binned(x))
        p = np.exp(m - m.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def to_json(self) -> str:
        trees = [[[t.feature.tolist(), t.cut.tolist(), t.missing_left.tolist(), t.value.tolist()] for t in trees] for trees in self.rounds]
        plain = {"features": self.features, "edges": [e.tolist() for e in self.edges], "bins": self.bins, "depth": self.depth, "base": self.base.tolist(), "scale": self.scale, "classes": self.classes}
        return json.dumps({**plain, "rounds": trees})

    @classmethod
    def from_json(cls, text: str) -> "Boosted":
        d = json.loads(text)
        rounds = [[Tree(np.array(f), np.array(c), np.array(m, bool), np.array(v)) for f, c, m, v in trees] for trees in d.pop("rounds")]
        return cls(**{**d, "edges": [np.array(e) for e in d["edges"]], "base": np.array(d["base"])}, rounds=rounds)


def _number(rows: DataFrame, name: str) -> Column:
    return finite(column_or_null(rows, name).cast("double"))


def _bytes(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def _stack(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([np.asarray(batch.column(n).to_numpy(zero_copy_only=False), float) for n in names], 1) if names else np.zeros((len(batch), 0))


def _gradients(model: Boosted, y: np.ndarray, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers (rows x outputs): downhill slope and curvature of the loss."""
    if model.classes is None:
        g, h = y[:, None] - margins, np.ones_like(margins)
    else:
        p = np.exp(margins - margins.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g, h = (y[:, None] == np.arange(p.shape[1])) - p, p * (1 - p)
    return np.rint(g * UNIT), np.rint(h * UNIT)


def _add_up(model: Boosted, growing: list[Tree], level: int, first: int):
    """Tasks: sums of slope, curvature and rows by (output, node, feature, bin)."""
    nf, nb, nodes, low = len(model.features), model.bins + 1, 2**level, 2**level - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(growing), nodes * nf * nb, 3), np.int64)
        for batch in batches:
            if not len(batch):
                continue
            binned = _bytes(batch.column("bins"), nf, np.uint8)
            g, h = _gradients(model, batch.column("y").to_numpy(zero_copy_only=False), model.add(_bytes(batch.column("margins"), len(growing), np.float64), binned, first))
            for k, tree in enumerate(growing):
                node = tree.nodes(binned, model.bins, level) - low
                here = node >= 0
                cell = ((node[here, None] * nf + np.arange(nf)) * nb + binned[here]).ravel()
                for c, w in enumerate((g[here, k], h[here, k], np.ones(here.sum()))):
                    sums[k, :, c] += np.bincount(cell, np.repeat(w, nf), nodes * nf * nb).astype(np.int64)
        sums = sums.reshape(len(growing), nodes, nf, nb, 3)
        k, node, f = np.nonzero(sums[..., 2].sum(-1))
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(node + low, pa.int32()), pa.array(f, pa.int32()), pa.array([s.tobytes() for s in sums[k, node, f]], pa.binary())], ["k", "node", "f", "sums"])

    return run


def best_cut(sums: np.ndarray, least: int, ridge: float) -> tuple[float, int, bool, np.ndarray]:
    """(gain, last bin on the left, missing values left, sums of the left side) for sums by (bin, [slope, curvature, rows]) whose last bin holds missing values; no gain: -1."""
    total, gone = sums.sum(0), sums[-1]
    right = np.cumsum(sums[:-1], 0)
    left = np.concatenate([right, right + gone])
    g, h, n = (left / [UNIT, UNIT, 1]).T
    gt, ht, nt = total / [UNIT, UNIT, 1]
    allowed = (n >= least) & (nt - n >= least) & (h >= CURVATURE) & (ht - h >= CURVATURE)
    gain = np.full(len(n), -1.0)
    gain[allowed] = g[allowed] ** 2 / (h[allowed] + ridge) + (gt - g[allowed]) ** 2 / (ht - h[allowed] + ridge) - gt**2 / (ht + ridge)
    at = int(gain.argmax())
    missing_left = at >= len(right) if gone[2] else 2 * n[at] >= nt
    return float(gain[at]), at % len(right), bool(missing_left), left[at]


def _cuts(least: int, ridge: float):
    """Owners of (output, node, feature): sums of all tasks, then the best cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for k, node, f, sums in zip(*(batch.column(i).to_pylist() for i in range(4))):
                part = np.frombuffer(sums, np.int64).reshape(-1, 3)
                held[k, node, f] = held[k, node, f] + part if (k, node, f) in held else part
        rows = []
        for (k, node, f), sums in held.items():
            gain, cut, missing_left, left = best_cut(sums, least, ridge)
            rows.append({"k": k, "node": node, "gain": gain, "rank": -f, "cut": cut, "missing_left": missing_left, "left": left.tolist(), "total": sums.sum(0).tolist()})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("k", pa.int32()), ("node", pa.int32()), ("gain", pa.float64()), ("rank", pa.int32()), ("cut", pa.int32()), ("missing_left", pa.bool_()), ("left", pa.list_(pa.int64())), ("total", pa.list_(pa.int64()))]))

    return run


def _grow(model: Boosted, table: DataFrame, first: int, rate: float, least: int, ridge: float) -> list[Tree]:
    trees = [Tree.empty(model.depth) for _ in model.base]
    value = lambda s: rate * (s[0] / UNIT) / (max(s[1] / UNIT, CURVATURE) + ridge)
    for level in range(model.depth):
        sums = table.mapInArrow(_add_up(model, trees, level, first), "k int, node int, f int, sums binary").repartition("k", "node", "f")
        cuts = sums.mapInArrow(_cuts(least, ridge), "k int, node int, gain double, rank int, cut int, missing_left boolean, left array<bigint>, total array<bigint>")
        grown = False
        for r in cuts.groupBy("k", "node").agg(F.max(F.struct("gain", "rank", "cut", "missing_left", "left", "total")).alias("b")).collect():
            b, tree, node = r["b"], trees[r["k"]], r["node"]
            left, total = np.array(b["left"], float), np.array(b["total"], float)
            if node == 0:
                tree.value[0] = value(total)
            if b["gain"] > 1e-9:
                grown = True
                tree.feature[node], tree.cut[node], tree.missing_left[node] = -b["rank"], b["cut"], b["missing_left"]
                tree.value[2 * node + 1], tree.value[2 * node + 2] = value(left), value(total - left)
        if not grown:
            break
    return trees


def fit(rows: DataFrame, features: list[str], target: str = "target", classes: bool = False, depth: int = 6, rate: float = 0.05, rounds: int = 50, bins: int = 64, least: int = 20, ridge: float = 0.0) -> Boosted:
    """Trees of ``depth`` levels on at most ``bins`` bins a feature (255 or fewer); a leaf has ``least`` rows or more. ``ridge`` draws leaves to 0."""
    if not 2 <= bins <= 255 or not features:
        raise ValueError("2 to 255 bins, and one feature or more")
    y = F.round(_number(rows, target), 12) if classes else _number(rows, target)
    names = [f"x{n}" for n in range(len(features))]
    clean = rows.select(y.alias("y"), *[_number(rows, f).alias(n) for f, n in zip(features, names)]).filter("y IS NOT NULL")
    probs = [n / bins for n in range(1, bins)]
    stats = clean.agg(F.count("y").alias("n"), F.avg("y").alias("mean"), F.stddev_pop("y").alias("std"), *[F.percentile_approx(n, probs, ACCURACY).alias(n) for n in names]).first()
    if not stats["n"]:
        raise ValueError("no row has a target")
    edges = [np.unique(np.array(stats[n] or [], float)) for n in names]
    if classes:
        found = clean.groupBy("y").agg(F.count(F.lit(1)).alias("n")).orderBy("y").limit(MAX_CLASSES + 1).collect()
        if len(found) > MAX_CLASSES:
            raise ValueError(f"more than {MAX_CLASSES} classes")
        kinds = [r["y"] for r in found]
        model = Boosted(features, edges, bins, depth, np.log(np.array([r["n"] for r in found]) / stats["n"]), classes=kinds)
    else:
        scale = float(stats["std"] or 0.0) or 1.0
        model = Boosted(features, edges, bins, depth, np.array([stats["mean"] / scale]), scale)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            binned = model.binned(_stack(batch, names))
            raw = batch.column("y").to_numpy(zero_copy_only=False)
            code = np.searchsorted(model.classes, raw).astype(float) if classes else raw / model.scale
            yield pa.RecordBatch.from_arrays([pa.array([b.tobytes() for b in binned], pa.binary()), pa.array(code, pa.float64()), pa.array([model.base.tobytes()] * len(batch), pa.binary())], ["bins", "y", "margins"])

    def renewed(first: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                m = model.add(_bytes(batch.column("margins"), len(model.base), np.float64), _bytes(batch.column("bins"), len(features), np.uint8), first)
                yield pa.RecordBatch.from_arrays([batch.column("bins"), batch.column("y"), pa.array([r.tobytes() for r in m], pa.binary())], ["bins", "y", "margins"])

        return run

    schema = "bins binary, y double, margins binary"
    with Tables(rows.sparkSession, "boosting") as tables:
        table, first = tables.write(clean.mapInArrow(encode, schema), "rows0"), 0
        for n in range(rounds):
            trees = _grow(model, table, first, rate, least, ridge)
            if all(t.feature[0] < 0 for t in trees):
                break  # nothing is left to part
            model.rounds.append(trees)
            if len(model.rounds) - first == REFRESH and n + 1 < rounds:
                table = tables.write(table.mapInArrow(renewed(first), schema), f"rows{n + 1}")
                tables.drop(f"rows{first}")
                first = len(model.rounds)
    return model


def _inputs(model: Boosted, rows: DataFrame) -> Column:
    return F.struct(*[_number(rows, f).alias(f"x{n}") for n, f in enumerate(model.features)])


def predict(model: Boosted, rows: DataFrame, name: str = "prediction") -> DataFrame:
    """Rows with the model's value or class in ``name`` (replaced if it is there); their own columns are unchanged."""

    @F.pandas_udf("double")
    def score(x: pd.DataFrame) -> pd.Series:
        return pd.Series(model.predict(x.to_numpy(float)))

    return rows.withColumn(name, score(_inputs(model, rows)))


def probabilities(model: Boosted, rows: DataFrame, name: str = "probabilities") -> DataFrame:
    """Rows with the classes' probabilities, in the order of ``model.classes``, as an array in ``name``; an error for a regression."""
    if model.classes is None:
        raise ValueError("a regression has no classes")

    @F.pandas_udf("array<double>")
    def score(x: pd.DataFrame) -> pd.Series:
        return pd.Series(list(model.probabilities(x.to_numpy(float))))

    return rows.withColumn(name, score(_inputs(model, rows)))
