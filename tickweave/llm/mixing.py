"""Mixing to target weights: token weights are raked to source, language and topic marginals, and documents are sampled by calibrated probabilities.

1. Every document gets a topic: the nearest of ``topics`` centres in a space of hashed word counts, by cosine. The centres are fitted by spherical k-means over all documents: each round is
   one pass over stored profiles in which tasks sum the vectors of each topic; it starts from the parts into which fixed random directions cut the documents around their mean.
2. Tokens (words) are summed by cell: source, language, topic. Iterative proportional fitting scales the cells in turn until each marginal matches its targets, for at most ``ROUNDS`` rounds or
   until no factor is further from 1 than ``TOLERANCE``. Up to ``MAX_CELLS`` cells this is done on the driver, beyond that by the same rule on the table of cells.
3. A cell's weight is its raked share over its natural one. Keep probabilities are min(1, scale * weight), with the scale found so that the expected tokens are the
   budget. A document stays if a hash of its id and text is under its probability, so the draw does not depend on the layout.

Default targets: sources by token share to the power ``temper``; languages and topics as they are.

Edge cases: null source, lang or text are values of their own (text: empty, the topic of an empty profile, weight one token); targets of values that do not occur are left out and the rest scaled up;
values without a target keep their natural share; repeated rows are drawn alike; rows of one id are drawn each by its text; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .hashing import chunks, texts_of, word_hashes

TOPICS = 8
WIDTH = 256
FIT_ROUNDS = 10
MAX_CELLS = 500_000
BUDGET = 0.8  # share of all tokens to keep
TEMPER = 0.7
ROUNDS = 100
TOLERANCE = 1e-9
SIDES = ("source", "lang", "topic")


def counts(column: pa.Array) -> np.ndarray:
    """Hashed word counts of the texts of a column, a row each."""
    raw, offsets = texts_of(column)
    out = np.zeros((len(column), WIDTH), np.int64)
    for lo, hi in chunks(offsets):
        h, _, _, row = word_hashes(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        out[lo:hi] = np.bincount(row * WIDTH + (h % np.uint64(WIDTH)).astype(np.int64), minlength=(hi - lo) * WIDTH).reshape(hi - lo, WIDTH)
    return out


def unit(levels: np.ndarray) -> np.ndarray:
    """Unit vectors of levels (16 times the logarithm of one more than a count, in a byte)."""
    out = levels.astype(np.float32)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norm, out=out, where=norm > 0)


def levels_of(count: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.round(16 * np.log1p(count))).astype(np.uint8)


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        count = counts(batch.column("_text"))
        keep = [k for k, name in enumerate(batch.schema.names) if name != "_text"]
        cols = [batch.column(k) for k in keep] + [pa.array([v.tobytes() for v in levels_of(count)], pa.binary()), pa.array(np.maximum(count.sum(1), 1))]
        yield pa.RecordBatch.from_arrays(cols, names=[batch.schema.names[k] for k in keep] + ["x", "tokens"])


def _vectors(column: pa.Array) -> np.ndarray:
    return unit(np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, WIDTH))


def _sums(place, topics: int):
    """Rows (topic, dim, v): the summed vectors of each topic that ``place`` gives, and in dim -1 the summed likeness."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((topics, WIDTH + 1))
        for batch in batches:
            x = _vectors(batch.column(0))
            score = place(x)
            at = score.argmax(1)
            for k in range(topics):
                total[k, 1:] += x[at == k].sum(0)
                total[k, 0] += score[at == k, k].sum()
        k, d = np.divmod(np.arange(total.size, dtype=np.int32), WIDTH + 1)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array((d - 1).astype(np.int32)), pa.array(total.ravel())], names=["topic", "dim", "v"])

    return run


def fit_topics(profiles: DataFrame, topics: int = TOPICS, rounds: int = FIT_ROUNDS, seed: int = 1) -> np.ndarray:
    """Centres by spherical k-means over all profiles (column ``x``)."""

    def pass_(place, k: int) -> np.ndarray:
        out = np.zeros((k, WIDTH + 1))
        for r in profiles.select("x").mapInArrow(_sums(place, k), "topic int, dim int, v double").groupBy("topic", "dim").agg(F.sum("v").alias("v")).collect():  # topics * (WIDTH + 1) rows
            out[r["topic"], r["dim"] + 1] = r["v"]
        return out

    mean = pass_(lambda x: np.zeros((len(x), 1), np.float32), 1)[0, 1:]
    mean = (mean / (np.linalg.norm(mean) or 1)).astype(np.float32)
    ways = np.random.default_rng(seed).standard_normal((WIDTH, topics)).astype(np.float32)
    got = pass_(lambda x: (x - (x @ mean)[:, None] * mean) @ ways, topics)
    centres, before = ways.T.copy(), -np.inf
    for _ in range(rounds):
        norm = np.linalg.norm(got[:, 1:], axis=1, keepdims=True)
        centres = np.where(norm > 0, got[:, 1:] / np.where(norm > 0, norm, 1), centres).astype(np.float32)
        got = pass_(lambda x, c=centres: x @ c.T, topics)
        if got[:, 0].sum() <= before * (1 + 1e-4):
            break
        before = got[:, 0].sum()
    return centres


def _assign(centres: np.ndarray):
    """Columns without ``_text`` and with topic and tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = counts(batch.column("_text"))
            keep = [k for k, name in enumerate(batch.schema.names) if name != "_text"]
            topic = (unit(levels_of(count)) @ centres.T).argmax(1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + [pa.array(topic), pa.array(np.maximum(count.sum(1), 1))], names=[batch.schema.names[k] for k in keep] + ["topic", "tokens"])

    return run


def rake(cells: np.ndarray, sides: list[np.ndarray], targets: list[np.ndarray], rounds: int = ROUNDS, tol: float = TOLERANCE) -> np.ndarray:
    """Iterative proportional fitting of cell masses; ``sides[k]`` gives each cell's value on side k, ``targets[k]`` the mass of each value."""
    w = cells.astype(float)
    for _ in range(rounds):
        worst = 0.0
        for side, target in zip(sides, targets):
            have = np.bincount(side, w, len(target))
            factor = np.divide(target, have, out=np.ones_like(have), where=have > 0)
            worst = max(worst, float(np.abs(factor[have > 0] - 1).max(initial=0)))
            w = w * factor[side]
        if worst < tol:
            break
    return w


def calibrate(weight: np.ndarray, tokens: np.ndarray, budget: float) -> float:
    """The scale s for which sum(min(1, s * weight) * tokens) = budget * sum(tokens)."""
    goal, order = budget * tokens.sum(), np.argsort(-weight)
    full, rest = 0.0, float((weight * tokens).sum())
    for k in order:  # largest weights reach 1 first
        s = (goal - full) / rest if rest > 0 else np.inf
        if s * weight[k] <= 1:
            return float(s)
        full, rest = full + tokens[k], rest - weight[k] * tokens[k]
    return float("inf")


def _key(name: str):
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("null"))  # null apart from any string


def goal_table(cells: DataFrame, side: str, wanted: dict | None, temper: float, total: float) -> DataFrame:
    """(value of a side, goal): the target share of every value that occurs; values without a target keep their own share."""
    shares = cells.groupBy(f"_{side}").agg((F.sum("mass") / F.lit(float(total))).alias("share"))
    if wanted is None:
        raw = F.pow("share", F.lit(temper)) if side == "source" else F.col("share")
        sums = shares.agg(F.sum(raw).alias("all"))
        return stored(shares.join(sums).select(f"_{side}", (raw / F.col("all")).alias("goal")), "goals")
    given = cells.sparkSession.createDataFrame([("null" if k is None else f"={k}", float(v)) for k, v in wanted.items()], f"_{side} string, wanted double")
    both = shares.join(given, f"_{side}", "left")
    sums = both.agg(F.coalesce(F.sum("wanted"), F.lit(0.0)).alias("all"), F.coalesce(F.sum(F.when(F.col("wanted").isNull(), F.col("share"))), F.lit(0.0)).alias("free"))
    goal = F.when(F.col("wanted").isNotNull() & (F.col("all") > 0), F.col("wanted") / F.col("all") * (1 - F.col("free"))).otherwise(F.col("share"))
    return stored(both.join(sums).select(f"_{side}", goal.alias("goal")), "goals")


NAMES = ["doc_id", "source", "lang", "topic", "tokens", "weight", "probability", "kept"]


def _draws(docs: DataFrame, topics: int, columns: dict, more: list) -> DataFrame:
    """doc_id, source, lang, u (uniform draw), tokens, topic, keys of the sides; ``more`` columns of ``docs`` too."""
    text = F.coalesce(F.col(columns.get("text_col", "text")), F.lit(""))
    id_ = F.col(columns.get("id_col", "doc_id")).cast("long")
    h = F.xxhash64(F.xxhash64(id_, text), F.lit("draw"))
    u = (F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))).alias("u")
    source, lang = (F.col(columns.get(f"{s}_col", s)).cast("string").alias(s) for s in ("source", "lang"))
    rows = docs.select(id_.alias("doc_id"), source, lang, u, *more, text.alias("_text"))
    profiles = stored(rows.select("_text").mapInArrow(_profiles, "x binary, tokens long"), "profiles")
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema if f.name != "_text")
    return rows.mapInArrow(_assign(fit_topics(profiles, topics)), kinds + "topic int, tokens long").withColumns({f"_{s}": _key(s) for s in SIDES})


def weigh(rows: DataFrame, targets: dict[str, dict] | None, budget: float, temper: float, max_cells: int) -> DataFrame | None:
    """``rows`` with weight, probability and kept; None for no rows."""
    spark, keys = rows.sparkSession, [f"_{s}" for s in SIDES]
    cells = stored(rows.groupBy(*keys).agg(F.sum("tokens").alias("mass")), "cells")
    total = cells.agg(F.sum("mass")).first()[0]
    if total is None:
        return None
    goals = {s: goal_table(cells, s, (targets or {}).get(s), temper, total) for s in SIDES}
    few = cells.count() <= max_cells
    if few:
        table = cells.toPandas()  # max_cells rows at most, and as many values of a side
        goal = {s: goals[s].toPandas() for s in SIDES}
        sides = [table[f"_{s}"].map({k: n for n, k in enumerate(goal[s][f"_{s}"])}).to_numpy() for s in SIDES]
        mass = table["mass"].to_numpy(float)
        weight = rake(mass / total, sides, [goal[s]["goal"].to_numpy() for s in SIDES]) * total / mass
        scale = calibrate(weight, mass, budget)
        table["weight"] = weight
        weighed = spark.createDataFrame(table.drop(columns="mass"))
    else:
        weighed, scale = rake_table(cells, goals, total, budget)
    weighed = stored(weighed, "weights")
    p = F.least(F.lit(1.0), F.col("weight") * F.lit(min(scale, 1e300)))
    return rows.join(F.broadcast(weighed) if few else weighed, keys).withColumn("probability", p).withColumn("kept", F.col("u") < F.col("probability"))


def mix_to_targets(docs: DataFrame, targets: dict[str, dict] | None = None, budget: float = BUDGET, temper: float = TEMPER, topics: int = TOPICS, max_cells: int = MAX_CELLS, **columns) -> DataFrame:
    """doc_id, source, lang, topic, tokens, weight (raked share over natural share), probability, kept."""
    got = weigh(_draws(docs, topics, columns, []), targets, budget, temper, max_cells)
    if got is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, source string, lang string, topic int, tokens long, weight double, probability double, kept boolean")
    return got.select(*NAMES)


def rake_table(cells: DataFrame, goals: dict[str, DataFrame], total: float, budget: float, rounds: int = ROUNDS, tol: float = TOLERANCE) -> tuple[DataFrame, float]:
    """``rake`` and ``calibrate`` as table operations, for cells that a driver should not hold."""
    now = cells.withColumn("w", F.col("mass") / F.lit(float(total)))
    for _ in range(rounds):
        worst = 0.0
        for s in SIDES:
            have = now.groupBy(f"_{s}").agg(F.sum("w").alias("have"))
            factor = stored(have.join(goals[s], f"_{s}").select(f"_{s}", F.when(F.col("have") > 0, F.col("goal") / F.col("have")).otherwise(1.0).alias("factor")), "factors")
            worst = max(worst, factor.agg(F.max(F.abs(F.col("factor") - 1))).first()[0])
            now = stored(now.join(factor, f"_{s}").withColumn("w", F.col("w") * F.col("factor")).drop("factor"), "rake")
        if worst < tol:
            break
    now = now.select(*[f"_{s}" for s in SIDES], "mass", (F.col("w") * F.lit(float(total)) / F.col("mass")).alias("weight"))
    low, high = 0.0, 1.0
    spent = lambda s: now.agg(F.sum(F.least(F.lit(1.0), F.lit(s) * F.col("weight")) * F.col("mass"))).first()[0]
    while spent(high) < budget * total * (1 - 1e-9) and high < 1e12:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if spent(mid) < budget * total else (low, mid)
    return now.drop("mass"), high


def sample_mixture(docs: DataFrame, targets: dict[str, dict] | None = None, budget: float = BUDGET, temper: float = TEMPER, topics: int = TOPICS, max_cells: int = MAX_CELLS, **columns) -> DataFrame:
    """The rows of ``docs`` that the mixture keeps, all columns."""
    got = weigh(_draws(docs, topics, columns, [F.struct(*docs.columns).alias("row")]), targets, budget, temper, max_cells)
    return docs.limit(0) if got is None else got.filter("kept").select("row.*")
